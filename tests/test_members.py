"""Dimension patterns, lookups and comparison."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.operators.compare import frame_diff, frames_equal
from martloom.operators.lookups import drop_members, flag_member, keep_members, lookup, not_in_or_null, union_conformed
from martloom.operators.members import (
    add_surrogate_id,
    first_member,
    flag_primary,
    placeholder_members,
    priority_union,
    unique_members,
)
from martloom.plans.facts import OrderFilter, disjoint_rates
from martloom.plans.members import ChannelRules, build_reference_dim, build_unit_dim, rule_channel
from martloom.session import broadcast_if_small, is_small


def test_unique_members(spark, rows):
    df = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), (None, 4)], "k string, v int")
    assert rows(unique_members(df, ["k"])) == [("a", 1)]
    dim = build_reference_dim(df, "k", "me", F.lit("20240101"))
    assert rows(dim) == [("a", 1, "20240101", "20240101", "me", "me")]


def test_unit_dim(spark, rows):
    df = spark.createDataFrame(
        [("g", "kg", "z", 1.0), ("l", "kg", "a", 2.0), ("x", "dup", "a", 3.0), ("y", "dup", "a", 4.0)],
        "from_unit string, to_unit string, component string, factor double",
    )
    assert rows(build_unit_dim(df)) == [(1, "l", "kg", "a", 2.0), (2, "g", "kg", "z", 1.0)]


def test_first_member_prunes_before_the_shuffle(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, o int, v string")
    out = first_member(df, ["k"], ["o"])
    assert out._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") == 2
    assert rows(out) == [("a", 1, "y"), ("b", 5, "z")]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 2)), min_size=1, max_size=25))
def test_exactly_one_primary_per_key(spark, items):
    df = spark.createDataFrame(items, "k string, v int")
    out = flag_primary(df, {"p": (["k"], ["v"])}).collect()
    assert Counter((r.k, r.v) for r in out) == Counter(items)
    for key in {k for k, _ in items}:
        primary = [r for r in out if r.k == key and r.p == "1"]
        assert len(primary) == 1 and primary[0].v == min(v for k, v in items if k == key)


def test_many_copies_unfold_in_chunks(spark):
    df = spark.range(25_000).select(F.lit("a").alias("k"), F.lit(1).alias("v"))
    out = flag_primary(df, {"p": (["k"], ["v"])})
    assert {(r.p, r["count"]) for r in out.groupBy("p").count().collect()} == {("1", 1), ("0", 24_999)}


def test_priority_union(spark, rows):
    schema = "k int, v string"
    a = spark.createDataFrame([(1, "a"), (1, "a"), (1, "A")], schema)
    b = spark.createDataFrame([(1, "b"), (2, "b"), (None, "b")], schema)
    c = spark.createDataFrame([(3, "c")], schema)
    # the NULL key of the second source hides every row of the third
    assert rows(priority_union([a, b, c], ["k"])) == [(1, "A"), (1, "a"), (2, "b")]
    assert rows(priority_union([a, b.where("k IS NOT NULL"), c], ["k"])) == [(1, "A"), (1, "a"), (2, "b"), (3, "c")]


def test_placeholders(spark, rows):
    codes = spark.createDataFrame([("x",), ("x",), ("y",), (None,)], "c string")
    master = spark.createDataFrame([("y",), (None,)], "m string")
    out = placeholder_members(codes, master, "c", "m", {"key": F.lit("none"), "name": F.col("_code")}, ["key", "name", "other"])
    assert rows(out) == [("none", "x", "")]


def test_surrogate_ids_follow_the_order(spark):
    df = spark.range(5000).selectExpr("(id * 7919) % 5000 AS v", "id")
    out = add_surrogate_id(df, ["v"]).collect()
    assert sorted((r.v, r.id) for r in out)[0] is not None
    assert [r[0] for r in sorted(out, key=lambda r: r.v)] == list(range(1, 5001))


def test_lookup(spark, rows):
    fact = spark.createDataFrame([(1, "7"), (2, "8"), (3, None)], "f int, code string")
    dim = spark.createDataFrame([("0007", "seven"), ("0007", "seven"), ("0009", "nine")], "key string, name string")
    out = lookup(fact, dim, {"key": F.lpad("code", 4, "0")}, {"name": "label"})
    assert rows(out) == [(1, "7", "seven"), (2, "8", None), (3, None, None)]


def test_member_filters(spark, rows):
    fact = spark.createDataFrame([("a",), ("b",), (None,)], "c string")
    members = spark.createDataFrame([("a",), ("a",), (None,)], "m string")
    assert rows(keep_members(fact, members, "c", "m")) == [("a",)]
    assert rows(drop_members(fact, members, "c", "m")) == [("b",), (None,)]
    assert rows(flag_member(fact, members, "c", "m", "hit")) == [("a", True), ("b", False), (None, False)]
    assert rows(fact.where(not_in_or_null("c", ["a"]))) == [("b",), (None,)]
    assert union_conformed(fact, members).count() == 6


def test_empty_code_lists_are_refused():
    with pytest.raises(ValueError, match="companies"):
        OrderFilter(("d",), ("i",), ())


def test_channel_rule(spark):
    df = spark.createDataFrame([("big", "x1"), ("mall", "zzz"), ("corner", "x1"), ("big", None)], "ch string, g string")
    out = [r[0] for r in df.select(rule_channel("ch", "g", ChannelRules(("big", "mall"), ("x1",), "cash", "shop"))).collect()]
    assert out == ["cash", "shop", None, None]


def test_rate_intervals_become_disjoint(spark):
    rates = spark.createDataFrame(
        [("c", "b", "201701", "201712", "1"), ("c", "b", "201706", "201806", "2"), ("c", "b", "201706", "201801", "3")],
        "category string, brand string, start_month string, end_month string, rate string",
    )
    out = sorted((r.start_month, r.rate, r.next_start) for r in disjoint_rates(rates).collect())
    assert out == [("201701", "1", "201706"), ("201706", "2", None)]


def test_frame_comparison(spark, rows):
    a = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    b = spark.createDataFrame([(1,), (None,)], "x int")
    assert rows(frame_diff(a, b)) == [(1, 2, 1)]
    assert not frames_equal(a, b) and frames_equal(a, b, bag=False)
    assert not frames_equal(a, b.toDF("y"))


def test_broadcast_is_measured(spark):
    df = spark.range(100).selectExpr("id", "repeat('x', 100) AS t")
    assert is_small(df) and not is_small(df, max_rows=99) and not is_small(df, max_bytes=5000)
    big = spark.range(1000).withColumnRenamed("id", "j")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for rows_allowed, expected in ((100, True), (99, False)):
            plan = big.join(broadcast_if_small(df, rows_allowed), F.col("j") == F.col("id"))
            assert ("Broadcast" in plan._jdf.queryExecution().executedPlan().toString()) is expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
