"""Calendar and period roll-up queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.rollup import (
    CLOSED_GRAINS,
    DAYS,
    GRAINS,
    attach_period_type,
    period_rollup,
    running_to_date,
)
from martloom.plans.calendar import DELIVERED, deliver_calendar
from workload.common import cal_sql, calendar, make_calendar, rounded, table

AMOUNT = "decimal(19,6)"


def dim_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = deliver_calendar(make_calendar(spark, sf_dir, "orders"))
    return out.toDF(*[c.strip("#").lower() for c in out.columns])


def _text(expr: str) -> str:
    return f"strftime({expr}, '%d%b%Y')"


_CAL_COLUMNS = {
    "time_key": "strftime(d, '%Y%m%d')",
    "date": _text("d"),
    "calendar_quarter": "'Q' || quarter(d)",
    "calendar_week": "CAST(weekofyear(d) AS VARCHAR)",
    "calendar_month": "strftime(d, '%Y%m')",
    "year": "strftime(d, '%Y')",
    "mat_start": _text("m - INTERVAL 13 MONTH"),
    "l3m_start": _text("m - INTERVAL 3 MONTH"),
    "ya_l3m_start": _text("m - INTERVAL 15 MONTH"),
    "ya_l3m_end": _text("m - INTERVAL 12 MONTH - INTERVAL 1 DAY"),
    "ya_mat_start": _text("m - INTERVAL 25 MONTH"),
    "ya_mat_end": _text("m - INTERVAL 12 MONTH - INTERVAL 1 DAY"),
    "mat_l3m_end": _text("m - INTERVAL 1 DAY"),
    "country_week": "''",
    "country_month": "''",
    "tdp": "CAST(tdp_no AS VARCHAR)",
    "working_days": "CASE WHEN dayofweek(d) IN (0, 6) THEN '0' ELSE '1' END",
    "first_day_month": _text("m"),
    "fiscal_year": "''",
    "fiscal_period": "''",
    "tdp_start": _text("tdp_start"),
    "tdp_end": _text("tdp_end"),
    "first_day_quarter": _text("q"),
    "first_day_year": _text("y"),
    "moc_start_date": _text("moc_start"),
    "moc_end_date": _text("d"),
    "days_month": "CAST(day(last_day(d)) AS VARCHAR)",
    "days_qurter": "CAST(date_diff('day', q, CAST(q + INTERVAL 3 MONTH AS DATE)) AS VARCHAR)",
    "days_year": "CAST(date_diff('day', y, CAST(y + INTERVAL 1 YEAR AS DATE)) AS VARCHAR)",
    "month_name": "strftime(d, '%B')",
    "qtr_end_name": "strftime(q + INTERVAL 2 MONTH, '%b %Y')",
    "month_year_name": "strftime(d, '%b %Y')",
    "qtr_year_name": "'Q' || quarter(d) || ' ' || strftime(d, '%Y')",
    "last_30_day": _text("d - INTERVAL 30 DAY"),
    "year_end": _text("y - INTERVAL 1 DAY"),
    "first_day_last_month": _text("m - INTERVAL 1 MONTH"),
    "first_day_last_year": _text("y - INTERVAL 1 YEAR"),
    "first_day_last_quarter": _text("q - INTERVAL 3 MONTH"),
    "last_day_last_quarter": _text("q - INTERVAL 1 DAY"),
}
assert [c.strip("#").lower() for c in DELIVERED] == list(_CAL_COLUMNS)
DIM_CALENDAR_SQL = f"WITH {cal_sql('orders')} SELECT {', '.join(f'{e} AS {n}' for n, e in _CAL_COLUMNS.items())} FROM cal"


# --- single grains ------------------------------------------------------------------


def _segment_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return orders.join(customers, orders.o_custkey == customers.c_custkey)


def _by_segment(grain: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        facts = _segment_orders(spark, sf_dir)
        cal = calendar(spark, sf_dir, "orders")
        out = period_rollup(facts, cal, ["c_mktsegment"], {"o_totalprice": AMOUNT}, "o_orderdate", [grain])
        return rounded(out.withColumnRenamed("o_totalprice", "total"), "total")

    return run


def _by_flag(grain: str):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cal = calendar(spark, sf_dir, "lineitem")
        out = period_rollup(
            table(spark, sf_dir, "lineitem"), cal, ["l_returnflag"],
            [f"l_quantity-{AMOUNT}", f"l_extendedprice-{AMOUNT}"], "l_shipdate", [grain],
        )
        return rounded(out, "l_quantity", "l_extendedprice")

    return run


def _segment_sql(grain: str, part: str) -> str:
    return f"""SELECT c_mktsegment, '{grain}' AS timeperiod_type,
        strftime(date_trunc('{part}', o_orderdate), '%Y%m%d') AS time_key,
        CAST(round(sum(CAST(o_totalprice AS DECIMAL(19,6))), 4) AS DOUBLE) AS total
        FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""


_FLAG_SUMS = """CAST(round(sum(CAST(l_quantity AS DECIMAL(19,6))), 4) AS DOUBLE) AS l_quantity,
        CAST(round(sum(CAST(l_extendedprice AS DECIMAL(19,6))), 4) AS DOUBLE) AS l_extendedprice"""


def _flag_sql(grain: str, part: str) -> str:
    return f"""SELECT l_returnflag, '{grain}' AS timeperiod_type,
        strftime(date_trunc('{part}', l_shipdate), '%Y%m%d') AS time_key, {_FLAG_SUMS}
        FROM lineitem GROUP BY ALL"""


def _flag_window_sql(grain: str, months: int) -> str:
    return f"""WITH {cal_sql('lineitem')},
        win AS (SELECT DISTINCT m - INTERVAL {months} MONTH AS lo, m AS hi FROM cal)
        SELECT l_returnflag, '{grain}' AS timeperiod_type, strftime(lo, '%Y%m%d') AS time_key, {_FLAG_SUMS}
        FROM lineitem LEFT JOIN win ON l_shipdate >= lo AND l_shipdate < hi GROUP BY l_returnflag, lo"""


def rollup_l30d(spark: SparkSession, sf_dir: str) -> DataFrame:
    cal = calendar(spark, sf_dir, "events")
    out = period_rollup(table(spark, sf_dir, "events"), cal, ["event_type"], {"value": AMOUNT}, "ts", ["L30D"])
    return rounded(out, "value")


ROLLUP_L30D_SQL = f"""WITH {cal_sql('events')}
    SELECT event_type, 'L30D' AS timeperiod_type, strftime(d - INTERVAL 30 DAY, '%Y%m%d') AS time_key,
           CAST(round(sum(CAST(value AS DECIMAL(19,6))), 4) AS DOUBLE) AS value
    FROM events LEFT JOIN cal ON CAST(ts AS DATE) BETWEEN CAST(d - INTERVAL 30 DAY AS DATE) AND d
    GROUP BY event_type, d"""


def _order_status(grains: list[str]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        cal = calendar(spark, sf_dir, "orders")
        out = period_rollup(
            table(spark, sf_dir, "orders"), cal, ["o_orderstatus"], {"o_totalprice": AMOUNT}, "o_orderdate", grains
        )
        return rounded(out, "o_totalprice")

    return run


_STATUS_SUM = "CAST(round(sum(CAST(o_totalprice AS DECIMAL(19,6))), 4) AS DOUBLE) AS o_totalprice"


def _status_cal_sql(grain: str, start: str) -> str:
    return f"""SELECT o_orderstatus, '{grain}' AS timeperiod_type, strftime({start}, '%Y%m%d') AS time_key, {_STATUS_SUM}
        FROM orders LEFT JOIN cal ON CAST(o_orderdate AS DATE) = d GROUP BY ALL"""


def _status_window_sql(grain: str, start: str, end: str) -> str:
    return f"""SELECT o_orderstatus, '{grain}' AS timeperiod_type, strftime(lo, '%Y%m%d') AS time_key, {_STATUS_SUM}
        FROM orders LEFT JOIN (SELECT DISTINCT CAST({start} AS DATE) AS lo, CAST({end} AS DATE) AS hi FROM cal) w
        ON CAST(o_orderdate AS DATE) BETWEEN lo AND hi GROUP BY ALL"""


_STATUS_PARTS = {
    "MTD": _status_cal_sql("MTD", "m"),
    "MONTH": _status_cal_sql("MONTH", "m"),
    "QTD": _status_cal_sql("QTD", "q"),
    "QUARTER": _status_cal_sql("QUARTER", "q"),
    "YTD": _status_cal_sql("YTD", "y"),
    "YEAR": _status_cal_sql("YEAR", "y"),
    "TDP": _status_cal_sql("TDP", "tdp_start"),
    "MOC": _status_cal_sql("MOC", "moc_start"),
    "L3M": _status_window_sql("L3M", "m - INTERVAL 3 MONTH", "m - INTERVAL 1 DAY"),
    "MAT": _status_window_sql("MAT", "m - INTERVAL 13 MONTH", "m - INTERVAL 1 DAY"),
    "L30D": _status_window_sql("L30D", "d - INTERVAL 30 DAY", "d"),
    "DAYS": """SELECT o_orderstatus, 'DAYS' AS timeperiod_type, strftime(o_orderdate, '%Y%m%d') AS time_key,
        CAST(round(CAST(o_totalprice AS DECIMAL(19,6)), 4) AS DOUBLE) AS o_totalprice FROM orders""",
}

# Ids of the period-type dimension, in label order.
PERIOD_TYPE_IDS = {g: i + 1 for i, g in enumerate([DAYS, *GRAINS])}


def rollup_all_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    types = spark.createDataFrame(
        [(g.lower(), str(i)) for g, i in PERIOD_TYPE_IDS.items()], "timeperiod_type string, timeperiod_type_id string"
    )
    rolled = _order_status([DAYS, *GRAINS])(spark, sf_dir)
    return attach_period_type(rolled, types).withColumn("created_by", F.lit("mart"))


ROLLUP_ALL_SQL = f"""WITH {cal_sql('orders')}, parts AS ({' UNION ALL '.join(_STATUS_PARTS.values())}),
    types AS (SELECT * FROM (VALUES {', '.join(f"('{g}', '{i}')" for g, i in PERIOD_TYPE_IDS.items())})
              t(label, timeperiod_type_id))
    SELECT o_orderstatus, time_key, o_totalprice, timeperiod_type_id, 'mart' AS created_by
    FROM parts LEFT JOIN types ON timeperiod_type = label"""


def rollup_closed_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Closed months, quarters and years, attached to the calendar rows of the period after."""
    grains = {g: CLOSED_GRAINS[g] for g in ("MONTH", "QUARTER", "YEAR")}
    return _order_status(grains)(spark, sf_dir)


ROLLUP_CLOSED_SQL = f"""WITH {cal_sql('orders')}
    {_status_window_sql('MONTH', "m - INTERVAL 1 MONTH", "m - INTERVAL 1 DAY")} UNION ALL
    {_status_window_sql('QUARTER', "q - INTERVAL 3 MONTH", "q - INTERVAL 1 DAY")} UNION ALL
    {_status_window_sql('YEAR', "y - INTERVAL 1 YEAR", "y - INTERVAL 1 DAY")}"""


def rollup_by_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    """High-cardinality keys: every part over month and rolling grains."""
    cal = calendar(spark, sf_dir, "lineitem")
    out = period_rollup(
        table(spark, sf_dir, "lineitem"), cal, ["l_partkey"], {"l_quantity": AMOUNT}, "l_shipdate", ["MONTH", "L3M"]
    )
    return rounded(out, "l_quantity")


ROLLUP_BY_PART_SQL = f"""WITH {cal_sql('lineitem')},
    win AS (SELECT DISTINCT m - INTERVAL 3 MONTH AS lo, m AS hi FROM cal)
    SELECT l_partkey, 'MONTH' AS timeperiod_type, strftime(date_trunc('month', l_shipdate), '%Y%m%d') AS time_key,
           CAST(round(sum(CAST(l_quantity AS DECIMAL(19,6))), 4) AS DOUBLE) AS l_quantity FROM lineitem GROUP BY ALL
    UNION ALL
    SELECT l_partkey, 'L3M', strftime(lo, '%Y%m%d'),
           CAST(round(sum(CAST(l_quantity AS DECIMAL(19,6))), 4) AS DOUBLE)
    FROM lineitem LEFT JOIN win ON l_shipdate >= lo AND l_shipdate < hi GROUP BY l_partkey, lo"""


def running_ytd(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = running_to_date(table(spark, sf_dir, "orders"), ["o_orderpriority"], {"o_totalprice": AMOUNT}, "o_orderdate")
    return rounded(out, "o_totalprice")


RUNNING_YTD_SQL = """WITH daily AS (SELECT o_orderpriority, CAST(o_orderdate AS DATE) AS day,
        sum(CAST(o_totalprice AS DECIMAL(19,6))) AS v FROM orders GROUP BY ALL)
    SELECT o_orderpriority, strftime(date_trunc('year', day), '%Y%m%d') AS period_key, strftime(day, '%Y%m%d') AS time_key,
           CAST(round(sum(v) OVER (PARTITION BY o_orderpriority, date_trunc('year', day) ORDER BY day
                      ROWS UNBOUNDED PRECEDING), 4) AS DOUBLE) AS o_totalprice FROM daily"""


def region_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: order value by region over month, quarter and year."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    regions = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    facts = (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    cal = calendar(spark, sf_dir, "orders")
    out = period_rollup(facts, cal, ["r_name"], {"o_totalprice": AMOUNT}, "o_orderdate", ["MTD", "QTD", "YTD"])
    return rounded(out.withColumnRenamed("o_totalprice", "total"), "total")


REGION_SALES_SQL = " UNION ALL ".join(
    f"""SELECT r_name, '{g}' AS timeperiod_type, strftime(date_trunc('{p}', o_orderdate), '%Y%m%d') AS time_key,
    CAST(round(sum(CAST(o_totalprice AS DECIMAL(19,6))), 4) AS DOUBLE) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY ALL"""
    for g, p in (("MTD", "month"), ("QTD", "quarter"), ("YTD", "year"))
)

QUERIES = {
    "dim_calendar": dim_calendar,
    "region_sales": region_sales,
    "rollup_mtd": _by_segment("MTD"),
    "rollup_qtd": _by_segment("QTD"),
    "rollup_ytd": _by_segment("YTD"),
    "rollup_month": _by_flag("MONTH"),
    "rollup_quarter": _by_flag("QUARTER"),
    "rollup_year": _by_flag("YEAR"),
    "rollup_l3m": _by_flag("L3M"),
    "rollup_mat": _by_flag("MAT"),
    "rollup_l30d": rollup_l30d,
    "rollup_moc": _order_status(["MOC"]),
    "rollup_tdp": _order_status(["TDP"]),
    "rollup_days": _order_status([DAYS]),
    "rollup_all_grains": rollup_all_grains,
    "rollup_closed_periods": rollup_closed_periods,
    "rollup_by_part": rollup_by_part,
    "running_ytd": running_ytd,
}

ORACLE = {
    "dim_calendar": DIM_CALENDAR_SQL,
    "region_sales": REGION_SALES_SQL,
    "rollup_mtd": _segment_sql("MTD", "month"),
    "rollup_qtd": _segment_sql("QTD", "quarter"),
    "rollup_ytd": _segment_sql("YTD", "year"),
    "rollup_month": _flag_sql("MONTH", "month"),
    "rollup_quarter": _flag_sql("QUARTER", "quarter"),
    "rollup_year": _flag_sql("YEAR", "year"),
    "rollup_l3m": _flag_window_sql("L3M", 3),
    "rollup_mat": _flag_window_sql("MAT", 13),
    "rollup_l30d": ROLLUP_L30D_SQL,
    "rollup_moc": f"WITH {cal_sql('orders')} {_STATUS_PARTS['MOC']}",
    "rollup_tdp": f"WITH {cal_sql('orders')} {_STATUS_PARTS['TDP']}",
    "rollup_days": _STATUS_PARTS["DAYS"],
    "rollup_all_grains": ROLLUP_ALL_SQL,
    "rollup_closed_periods": ROLLUP_CLOSED_SQL,
    "rollup_by_part": ROLLUP_BY_PART_SQL,
    "running_ytd": RUNNING_YTD_SQL,
}
