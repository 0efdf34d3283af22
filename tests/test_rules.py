"""Quality rules on the fixture rows, validator edges included."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.functions.dates import reformat_date, reformat_date_loose, text_to_key
from martloom.functions.text import lead_minus, round_half_up_text
from martloom.operators import rules as R
from martloom.operators.compare import frames_equal
from martloom.operators.integrity import duplicate_check, merge_registry, parse_reference, reference_check


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def one_column(spark, items):
    return spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, x string").orderBy("i")


PEOPLE = [
    ("1", "Emp", "20180512", "15000000"),
    ("002", "Emp1", "20180511", "15000000"),
    ("3", "Emp2", "20170512", "15000000"),
    ("ab", "Emp4", "20180516", "15000000"),
    ("", "Emp5", "20180516", "15000000"),
]
PEOPLE_SCHEMA = "id string, description string, DateField string, PROCESS_TIMESTAMP string"


@pytest.mark.parametrize("reject", [False, True])
def test_integer_rule_reports_and_optionally_rejects(spark, reject):
    people = spark.createDataFrame(PEOPLE, PEOPLE_SCHEMA)
    good, bad = R.apply_checks(people, [R.integer_check(R.parse_rules("id-INT").integer, reject)])
    expected = [p for p in PEOPLE if not (reject and p[0] == "ab")]
    assert frames_equal(good, spark.createDataFrame(expected, PEOPLE_SCHEMA))
    reason = "Integer fields not in proper format for column: id-INT"
    assert [tuple(r) for r in bad.collect()] == [("ab", "Emp4", "20180516", "15000000", reason)]


def test_length(spark):
    df = one_column(spark, ["abc", "abcd", None])
    assert values(df, R.length_ok("x", 3)) == [True, False, True]
    assert values(df, R.length_ok("x", 4)) == [True, True, True]


def test_decimal_edges(spark):
    df = one_column(spark, ["12.345", "123.4", "-12.3", "12.3-", "ab", "", None, "   "])
    assert values(df, R.decimal_ok("x", 4, 2)) == [True, False, True, True, False, True, True, False]


def test_decimal_rounding(spark):
    df = one_column(spark, ["12.345", "12.3-", "5", "ab", None, "12345678.5", "-0.005"])
    assert values(df, round_half_up_text("x", 2)) == ["12.35", "-12.30", "5.00", "ab", None, "12345678.50", "-0.01"]


def test_date_nullable(spark):
    df = one_column(spark, ["20180512", None, "", "0", "00000000", "2018051", "20180231"])
    assert values(df, F.coalesce(R.date_ok("x", "yyyyMMdd", True), F.lit(False))) == [True] * 5 + [False] * 2
    strict = values(df, F.coalesce(R.date_ok("x", "yyyyMMdd", False), F.lit(False)))
    assert strict == [True] + [False] * 6


def test_integer_edges(spark):
    df = one_column(spark, ["12-", " 12 ", "2147483648", "+5", "", None, "-2147483648", "--5", "-"])
    assert values(df, R.integer_ok("x")) == [True, False, False, True, True, True, True, False, False]
    assert values(df, lead_minus("x"))[0] == "-12"


def test_harmonise(spark):
    df = spark.createDataFrame([("20180512",), ("12May2018",), ("2018",), (None,)], "d string")
    kept, bad = R.apply_checks(df, [R.harmonise_check(["d#yyyyMMdd"])])
    assert values(kept, "d") == ["12May2018", "12May2018", "2018", None]
    assert values(bad, "d") == ["12May2018", "2018", None]
    kept, _ = R.apply_checks(df, [R.harmonise_check(["d#yyyyMMdd"], reject=True)])
    assert values(kept, "d") == ["12May2018", "12May2018"]


def test_derived_columns(spark):
    df = spark.createDataFrame([("20180512", 4), ("bad", 5)], "order_day string, n int")
    out, names = R.derive_columns(df, ["Y#order day#yyyyMMdd#yyyy", "copy#n", "half#n#n div 2"])
    assert names == ["Y", "copy", "half"]
    assert [tuple(r)[2:] for r in out.collect()] == [("2018", 4, 2), ("Unparsable", 5, 2)]


def test_remove_characters_keeps_names_and_nulls(spark):
    df = spark.createDataFrame([("a#b$c", "x#"), (None, "y")], "a string, b string")
    out = R.remove_characters(df, [("a", "#$"), ("missing", "x")])
    assert out.columns == ["a", "b"]
    assert [tuple(r) for r in out.collect()] == [("abc", "x#"), (None, "y")]


def test_duplicates_reject_every_copy(spark):
    df = spark.createDataFrame([(1, "p"), (1, "q"), (2, "r"), (None, "s"), (None, "t")], "a int, v string")
    good, bad = R.apply_checks(df, [duplicate_check(["a"], reject=True)])
    assert values(good, "a") == [2]
    assert sorted(values(bad, "v")) == ["p", "q", "s", "t"]
    kept, bad = R.apply_checks(df, [duplicate_check(["a"])])
    assert kept.count() == 5 and bad.count() == 4


def test_reference_keeps_multiplicity(spark):
    df = spark.createDataFrame([("a",), ("a",), ("z",), ("z",), (None,)], "k string")
    master = spark.createDataFrame([("a",), ("a",), (None,)], "m string")
    good, bad = R.apply_checks(df, [reference_check(master, [("k", "m")], "m.csv", reject=True)])
    assert sorted(map(str, values(good, "k"))) == ["None", "a", "a"]
    assert values(bad, "k") == ["z", "z"]


def test_registry(spark, rows):
    schema = "k string, PROCESS_TIMESTAMP string"
    stored = spark.createDataFrame([("k1", "100"), ("k2", "100")], schema)
    new = spark.createDataFrame([("k1", "200"), ("k3", "200")], schema)
    assert rows(merge_registry(stored, new, ["k"])) == [("k1", "200"), ("k2", "100"), ("k3", "200")]


def test_parse_rules_and_references():
    rules = R.parse_rules("a b-VARCHAR(10)|c-DECIMAL(4,2)|d e#DATE(yyyyMMdd,true)|f-INT")
    assert (rules.length[0].column, rules.length[0].size) == ("a_b", 10)
    assert (rules.decimal[0].precision, rules.decimal[0].scale) == (4, 2)
    assert (rules.date[0].column, rules.date[0].fmt, rules.date[0].nullable) == ("d_e", "yyyyMMdd", True)
    assert rules.integer[0].column == "f"
    assert parse_reference("m.csv|a-b&c d-e,n.csv|x-y") == [("m.csv", [("a", "b"), ("c_d", "e")]), ("n.csv", [("x", "y")])]
    with pytest.raises(ValueError):
        R.parse_rules("a-FLOAT(3)")


def test_later_rules_see_rewrites(spark, rows):
    df = spark.createDataFrame([("1.005", "x"), ("9", "7-"), ("bad", "8")], "amount string, n string")
    rules = R.parse_rules("amount-DECIMAL(5,2)|n-INT")
    good, bad = R.apply_checks(df, R.rule_checks(rules, df.columns, {"decimal": True, "integer": True}))
    assert rows(good) == [("9.00", "-7")]
    assert rows(bad, "amount", "n") == [("1.01", "x"), ("bad", "8")]


def test_not_null_and_unconfigured(spark):
    df = spark.createDataFrame([("a", None), ("b", "c")], "x string, y string")
    good, bad = R.apply_checks(df, [R.not_null_check(["y"], reject=True)])
    assert values(good, "x") == ["b"] and values(bad, "x") == ["a"]
    good, bad = R.apply_checks(df, [])
    assert good.count() == 2 and bad.count() == 0


def test_date_reformatting(spark):
    df = spark.createDataFrame([("01/02/2016",), ("1/2/2016",), ("x",), (None,)], "d string")
    assert values(df, reformat_date("d", "dd/MM/yyyy", "yyyyMMdd")) == ["20160201", "1/2/2016", "x", None]
    assert values(df, reformat_date_loose("d", "d/M/yyyy", "yyyyMMdd")) == ["20160201", "20160201", "x", None]
    assert values(df, text_to_key("d", "d/M/yyyy")) == ["20160201", "20160201", None, None]
    years = spark.createDataFrame([("Jan18",), ("Jan96",)], "m string")
    assert values(years, reformat_date_loose("m", "MMMyy", "yyyyMMdd")) == ["20180101", "19960101"]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.none(), st.text("0123456789.-+ ax", max_size=6)), min_size=1, max_size=30))
def test_good_and_rejected_make_up_the_input(spark, items):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "i int, x string")
    rules = R.parse_rules("x-VARCHAR(4)|x-DECIMAL(4,1)|x-INT")
    for check in (
        R.length_check(rules.length, True), R.decimal_check(rules.decimal, True), R.integer_check(rules.integer, True)
    ):
        good, bad = R.apply_checks(df, [check])
        assert sorted(values(good, "i") + values(bad, "i")) == list(range(len(items)))
