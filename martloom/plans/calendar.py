"""The calendar dimension: one row per day, plus its text form for delivery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.calendar import calendar_attributes
from martloom.functions.dates import TEXT_FORMAT, as_col, date_key, parse_date

# Delivered column order and names.
DELIVERED = (
    "TIME_KEY", "DATE", "CALENDAR_QUARTER", "CALENDAR_WEEK", "CALENDAR_MONTH", "YEAR",
    "MAT_START", "L3M_START", "YA_L3M_START", "YA_L3M_END", "YA_MAT_START", "YA_MAT_END", "MAT_L3M_END",
    "COUNTRY_WEEK", "COUNTRY_MONTH", "TDP", "WORKING_DAYS", "FIRST_DAY_MONTH", "FISCAL_YEAR", "FISCAL_PERIOD",
    "TDP_START", "TDP_END", "FIRST_DAY_QUARTER", "FIRST_DAY_YEAR", "MOC_START_DATE", "MOC_END_DATE",
    "#DAYS_MONTH", "#DAYS_QURTER", "#DAYS_YEAR", "MONTH_NAME", "QTR_END_NAME", "MONTH_YEAR_NAME",
    "QTR_YEAR_NAME", "LAST_30_DAY", "YEAR_END", "FIRST_DAY_LAST_MONTH", "FIRST_DAY_LAST_YEAR",
    "FIRST_DAY_LAST_QUARTER", "LAST_DAY_LAST_QUARTER",
)
DELIVERED_RENAMES = {"#DAYS_MONTH": "days_month", "#DAYS_QURTER": "days_quarter", "#DAYS_YEAR": "days_year"}
EMPTY_PLACEHOLDERS = ("COUNTRY_WEEK", "COUNTRY_MONTH", "FISCAL_YEAR", "FISCAL_PERIOD")


def days_spanned(df: DataFrame, date_col: Column | str, whole_years: bool = False) -> DataFrame:
    """One row ``date`` per day between the first and the last date of ``df``.

    The span is one aggregate with map-side combine; only min and max move.
    """
    d = F.to_date(as_col(date_col))
    first, last = F.min(d), F.max(d)
    if whole_years:
        first, last = F.trunc(first, "YEAR"), F.date_sub(F.add_months(F.trunc(last, "YEAR"), 12), 1)
    return df.agg(F.sequence(first, last, F.expr("interval 1 day")).alias("days")).select(F.explode("days").alias("date"))


def days_from_text(df: DataFrame, column: str = "DATE", fmt: str = TEXT_FORMAT) -> DataFrame:
    """The days of a text calendar, one row each; unparsed rows are left out of the calendar."""
    day = parse_date(column, fmt)
    return df.withColumn("date", day).where(F.col("date").isNotNull()).dropDuplicates(["date"])


def trading_periods_from_text(df: DataFrame, fmt: str = "yyyyMMMdd") -> DataFrame:
    """Trading-period bounds from ``MOC_TDP_CODE, FROM_DATE, TO_DATE`` text."""
    return df.select(
        F.col("MOC_TDP_CODE").alias("tdp_code"),
        parse_date("FROM_DATE", fmt).alias("tdp_start"),
        parse_date("TO_DATE", fmt).alias("tdp_end"),
    )


def build_calendar(
    days: DataFrame,
    trading_periods: DataFrame | None = None,
    mat_months: int = 13,
) -> DataFrame:
    """Attach every calendar attribute to ``days`` (column ``date``).

    ``trading_periods`` has ``tdp_code, tdp_start, tdp_end``; it is looked up by
    year and two-digit period number, so ``days`` must then carry ``tdp_no``.
    Optional input columns ``tdp_no`` and ``working_days`` are passed through.
    """
    attributes = calendar_attributes("date", mat_months)
    text = F.lit(None).cast("string")
    extra = {
        "tdp": F.col("tdp_no").cast("string") if "tdp_no" in days.columns else text,
        "working_days": F.col("working_days").cast("string") if "working_days" in days.columns else text,
    }
    out = days.select(*[c.alias(n) for n, c in {**attributes, **extra}.items()])
    if trading_periods is None:
        none = F.lit(None).cast("date")
        return out.withColumns({"tdp_start": none, "tdp_end": none})
    periods = trading_periods.select(
        F.col("tdp_code").cast("string").alias("tdp_code"), "tdp_start", "tdp_end"
    ).dropDuplicates(["tdp_code"])
    code = F.concat(F.col("year"), F.lpad("tdp", 2, "0"))
    return out.withColumn("tdp_code", code).join(periods, "tdp_code", "left").drop("tdp_code")


def deliver_calendar(calendar: DataFrame, fmt: str = TEXT_FORMAT) -> DataFrame:
    """The 39 delivered columns, dates as text."""
    out = []
    for name in DELIVERED:
        if name in EMPTY_PLACEHOLDERS:
            out.append(F.lit("").alias(name))
            continue
        source = DELIVERED_RENAMES.get(name, name.lower())
        column = F.col(source)
        if dict(calendar.dtypes)[source] == "date":
            column = F.date_format(column, fmt)
        out.append(column.cast("string").alias(name))
    return calendar.select(*out)


__all__ = [
    "build_calendar", "date_key", "days_from_text", "days_spanned", "deliver_calendar", "trading_periods_from_text",
]
