"""Calendar attributes and the period roll-up against plain Python."""

import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from martloom.operators.rollup import (
    CLOSED_GRAINS,
    GRAINS,
    attach_period_type,
    parse_measures,
    period_rollup,
    running_to_date,
    stamp,
)
from martloom.plans.calendar import (
    DELIVERED,
    build_calendar,
    days_from_text,
    days_spanned,
    deliver_calendar,
    trading_periods_from_text,
)
from martloom.session import stage


def span(spark, first, last):
    return spark.createDataFrame([(first,), (last,)], "date date")


@pytest.fixture(scope="module")
def calendar(spark):
    days = days_spanned(span(spark, dt.date(2017, 1, 1), dt.date(2018, 12, 31)), "date")
    return build_calendar(days).cache()


def day(calendar, date, *columns):
    return tuple(calendar.where(F.col("date") == date).select(*columns).first())


def test_month_ends_are_true(calendar):
    assert day(calendar, dt.date(2018, 4, 15), "mat_l3m_end", "ya_mat_end", "ya_l3m_end") == (
        dt.date(2018, 3, 31), dt.date(2017, 3, 31), dt.date(2017, 3, 31))
    assert day(calendar, dt.date(2018, 3, 31), "mat_l3m_end")[0] == dt.date(2018, 2, 28)


def test_starts(calendar):
    found = day(
        calendar, dt.date(2018, 4, 15), "mat_start", "l3m_start", "ya_l3m_start", "ya_mat_start", "first_day_last_quarter",
        "last_day_last_quarter", "first_day_last_year", "year_end", "last_30_day", "first_day_last_month",
    )
    assert found == tuple(
        dt.date(*d) for d in (
            (2017, 3, 1), (2018, 1, 1), (2017, 1, 1), (2016, 3, 1), (2018, 1, 1), (2018, 3, 31), (2017, 1, 1),
            (2017, 12, 31), (2018, 3, 16), (2018, 3, 1))
    )


def test_cycle_starts_on_the_21st(calendar):
    assert day(calendar, dt.date(2018, 1, 20), "moc_start_date")[0] == dt.date(2017, 12, 21)
    assert day(calendar, dt.date(2018, 1, 21), "moc_start_date")[0] == dt.date(2018, 1, 21)


def test_names(calendar):
    names = day(calendar, dt.date(2018, 2, 5), "calendar_quarter", "month_name", "qtr_end_name", "month_year_name", "qtr_year_name")
    assert names == ("Q1", "February", "Mar 2018", "Feb 2018", "Q1 2018")


def test_twelve_month_window(spark):
    days = days_spanned(span(spark, dt.date(2018, 4, 1), dt.date(2018, 4, 2)), "date")
    row = build_calendar(days, mat_months=12).first()
    assert (row.mat_start, row.ya_mat_start) == (dt.date(2017, 4, 1), dt.date(2016, 4, 1))


def test_delivery_from_text_calendar(spark):
    days = spark.createDataFrame([("01Jan2018", 1, "1"), ("bad", 1, "1")], "DATE string, tdp_no int, working_days string")
    periods = trading_periods_from_text(
        spark.createDataFrame([("201801", "2018Jan01", "2018Jan10")], "MOC_TDP_CODE string, FROM_DATE string, TO_DATE string"))
    out = deliver_calendar(build_calendar(days_from_text(days), periods))
    assert tuple(out.columns) == DELIVERED and len(DELIVERED) == 39
    row = out.collect()
    assert len(row) == 1
    assert (row[0]["TDP_START"], row[0]["TDP_END"], row[0]["TIME_KEY"]) == ("01Jan2018", "10Jan2018", "20180101")


FACTS = [
    ("a", dt.date(2017, 1, 5), 1), ("a", dt.date(2017, 1, 25), 2), ("a", dt.date(2017, 4, 30), 4), ("b", dt.date(2017, 12, 31), 8),
    ("b", dt.date(2018, 12, 15), 16), ("a", dt.date(2020, 1, 1), 32), ("b", None, 64),
]


def month_shift(d, n):
    m = d.year * 12 + d.month - 1 + n
    return dt.date(m // 12, m % 12 + 1, 1)


def expected(grain):
    """Brute force: every fact meets every distinct window."""
    days = [dt.date(2017, 1, 1) + dt.timedelta(i) for i in range(730)]

    def window(d):
        m = d.replace(day=1)
        q = dt.date(d.year, (d.month - 1) // 3 * 3 + 1, 1)
        end = m - dt.timedelta(1)
        return {
            "MONTH": (m, None), "QTD": (q, None), "YEAR": (dt.date(d.year, 1, 1), None),
            "L3M": (month_shift(m, -3), end), "MAT": (month_shift(m, -13), end),
            "L30D": (d - dt.timedelta(30), d),
            "MOC": ((m if d.day >= 21 else month_shift(m, -1)).replace(day=21), None),
        }[grain]

    out = defaultdict(int)
    windows = {(d, window(d)) for d in days}
    for key, when, value in FACTS:
        starts = {s for d, (s, e) in windows if when is not None and (d == when if e is None else s <= when <= e)}
        for start in starts or {None}:
            out[(key, start and start.strftime("%Y%m%d"))] += value
    return dict(out)


@pytest.mark.parametrize("grain", ["MONTH", "QTD", "YEAR", "L3M", "MAT", "L30D", "MOC"])
def test_grain_against_brute_force(spark, calendar, grain):
    facts = spark.createDataFrame(FACTS, "k string, d date, v int")
    out = period_rollup(facts, calendar, ["k"], {"v": "bigint"}, "d", [grain])
    assert {(r.k, r.time_key): r.v for r in out.collect()} == expected(grain)


def test_all_grains_agree_with_single_ones(spark, calendar, rows):
    facts = spark.createDataFrame(FACTS, "k string, d date, v int")
    every = period_rollup(facts, calendar, ["k"], ["v-bigint"], "d").cache()
    for grain in ("MTD", "QUARTER", "L3M", "L30D", "TDP"):
        single = period_rollup(facts, calendar, ["k"], ["v-bigint"], "d", [grain])
        assert rows(every.where(F.col("timeperiod_type") == grain)) == rows(single)
    assert {r[0] for r in every.select("timeperiod_type").distinct().collect()} == {"DAYS", *GRAINS}
    assert every.where("timeperiod_type = 'DAYS'").count() == len(FACTS)


def test_closed_periods_need_the_next_period(spark, calendar):
    facts = spark.createDataFrame([("a", dt.date(2018, 12, 5), 1), ("a", dt.date(2018, 11, 5), 2)], "k string, d date, v int")
    out = period_rollup(facts, calendar, ["k"], {"v": "bigint"}, "d", {"MONTH": CLOSED_GRAINS["MONTH"]})
    assert {r.time_key: r.v for r in out.collect()} == {"20181101": 2, None: 1}


def test_repeated_calendar_days_do_not_multiply(spark, calendar):
    facts = spark.createDataFrame(FACTS, "k string, d date, v int")
    doubled = calendar.unionByName(calendar)
    for grain in ("MONTH", "L30D"):
        once = period_rollup(facts, calendar, ["k"], {"v": "bigint"}, "d", [grain])
        twice = period_rollup(facts, doubled, ["k"], {"v": "bigint"}, "d", [grain])
        assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_text_dates_no_keys_and_day_keys(spark, calendar):
    facts = spark.createDataFrame([("x", "p", "20170105", "1.5"), ("y", "q", "bad", "2")], "k string, j string, d string, v string")
    total = period_rollup(facts, calendar, [], {"v": "decimal(9,2)"}, "d", ["YEAR"])
    assert {(r.time_key, float(r.v)) for r in total.collect()} == {("20170101", 1.5), (None, 2.0)}
    both = period_rollup(facts, calendar, ["k"], {"v": "decimal(9,2)"}, "d", ["DAYS", "YEAR"], day_keys=["k", "j"])
    assert {(r.k, r.j) for r in both.where("timeperiod_type = 'DAYS'").collect()} == {("x", "p"), ("y", "q")}
    with pytest.raises(ValueError):
        period_rollup(facts, calendar, ["k"], {"v": "int"}, "d", ["WEEK"])


def test_fact_moves_in_two_exchanges(spark, calendar, tmp_path):
    spark.range(1000).selectExpr("id % 7 AS k", "date'2017-01-01' + cast(id % 700 as int) AS d", "id AS v").write.mode(
        "overwrite").parquet(str(tmp_path / "facts"))
    facts = spark.read.parquet(str(tmp_path / "facts"))
    out = period_rollup(facts, calendar, ["k"], {"v": "bigint"}, "d", ["L3M", "MAT"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(k") == 2
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_mixed_grains_scan_the_fact_once(spark, calendar, tmp_path):
    path = str(tmp_path / "facts")
    spark.range(100).selectExpr("id % 7 AS k", "date'2017-01-01' + cast(id as int) AS d", "id AS v").write.parquet(path)
    # a stored calendar: the plan text of a cached one holds plans of its own
    out = period_rollup(spark.read.parquet(path), stage(calendar, "cal"), ["k"], {"v": "bigint"}, "d", list(GRAINS))
    out.collect()
    final = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan parquet [k") == 1 and final.count("ReusedExchange [k") == 1


def test_period_type_ids_and_stamp(spark):
    rolled = spark.createDataFrame([("MTD", 1), ("ODD", 2)], "timeperiod_type string, v int")
    types = spark.createDataFrame([("Mtd", "7"), ("Mtd", "7")], "timeperiod_type string, timeperiod_type_id string")
    out = stamp(attach_period_type(rolled, types), "me", modified=True)
    assert {(r.v, r.timeperiod_type_id) for r in out.collect()} == {(1, "7"), (2, None)}
    assert out.columns[-4:] == ["created_date", "created_by", "modified_date", "modified_by"]


def test_running_total(spark):
    facts = spark.createDataFrame(FACTS[:5], "k string, d date, v int")
    out = running_to_date(facts, ["k"], {"v": "bigint"}, "d")
    assert {(r.k, r.time_key, r.v) for r in out.collect()} == {
        ("a", "20170105", 1), ("a", "20170125", 3), ("a", "20170430", 7), ("b", "20171231", 8), ("b", "20181215", 16)}


def test_measure_parsing():
    assert parse_measures(["a b-DECIMAL(19,6)", "c-INT"]) == {"a_b": "DECIMAL(19,6)", "c": "INT"}
