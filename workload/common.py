"""Table access and the shared calendar dimension of the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.plans.calendar import build_calendar, days_spanned
from martloom.session import stage

_calendars: dict[tuple[str, str, str], DataFrame] = {}

# Trading periods of ten days (the last one of a month takes the rest): 36 a year.
TDP_NO = "(month(date) - 1) * 3 + least(floor((day(date) - 1) / 10), 2) + 1"

DATE_COLUMNS = {"orders": "o_orderdate", "lineitem": "l_shipdate", "events": "ts"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def make_calendar(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Calendar over the whole years of a table's dates, with ten-day trading periods."""
    days = days_spanned(table(spark, sf_dir, name).select(DATE_COLUMNS[name]), DATE_COLUMNS[name], whole_years=True)
    days = days.withColumns(
        {
            "tdp_no": F.expr(TDP_NO).cast("int"),
            "working_days": F.when(F.dayofweek("date").isin(1, 7), "0").otherwise("1"),
        }
    )
    code = F.concat(F.date_format("date", "yyyy"), F.lpad(F.col("tdp_no").cast("string"), 2, "0"))
    periods = days.groupBy(code.alias("tdp_code")).agg(F.min("date").alias("tdp_start"), F.max("date").alias("tdp_end"))
    return build_calendar(days, periods)


def calendar(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The stored calendar dimension: built and written once per session and table."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _calendars:
        _calendars[key] = stage(make_calendar(spark, sf_dir, name), f"calendar-{name}")
    return _calendars[key]


def rounded(df: DataFrame, *columns: str, scale: int = 4) -> DataFrame:
    """Exact decimals delivered as doubles of fixed scale."""
    return df.withColumns({c: F.round(F.col(c), scale).cast("double") for c in columns})


def cal_sql(name: str) -> str:
    """The same calendar as a chain of SQL common table expressions (``cal``)."""
    column = DATE_COLUMNS[name]
    return f"""
    span AS (SELECT date_trunc('year', min({column})) AS lo,
                    date_trunc('year', max({column})) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS hi FROM {name}),
    days AS (SELECT CAST(unnest(generate_series(CAST(lo AS TIMESTAMP), CAST(hi AS TIMESTAMP), INTERVAL 1 DAY)) AS DATE) AS d
             FROM span),
    days2 AS (SELECT d, CAST((month(d) - 1) * 3 + least((day(d) - 1) // 10, 2) + 1 AS INTEGER) AS tdp_no,
                     CAST(date_trunc('month', d) AS DATE) AS m, CAST(date_trunc('quarter', d) AS DATE) AS q,
                     CAST(date_trunc('year', d) AS DATE) AS y FROM days),
    cal AS (SELECT *, min(d) OVER (PARTITION BY year(d), tdp_no) AS tdp_start,
                   max(d) OVER (PARTITION BY year(d), tdp_no) AS tdp_end,
                   CAST((CASE WHEN day(d) < 21 THEN m - INTERVAL 1 MONTH ELSE m END) + INTERVAL 20 DAY AS DATE) AS moc_start
            FROM days2)"""
