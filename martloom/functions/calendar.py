"""Retail-calendar attributes of one date, as native date arithmetic.

Ends of earlier periods are true month ends. ``mat_months`` is the length of
the moving annual window: 13 keeps the established figures, 12 is the plain year.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.dates import as_col, date_key

# Fixed value: the sales cycle starts on this day of the month.
CYCLE_START_DAY = 21
# Fixed value: the "last 30 days" window reaches back this many days.
LAST_DAYS_SPAN = 30


def month_start(d: Column) -> Column:
    return F.trunc(d, "MM")


def quarter_start(d: Column) -> Column:
    return F.trunc(d, "QUARTER")


def year_start(d: Column) -> Column:
    return F.trunc(d, "YEAR")


def cycle_start(d: Column) -> Column:
    """Start of the sales cycle a day belongs to."""
    first = F.when(F.dayofmonth(d) < CYCLE_START_DAY, F.add_months(month_start(d), -1)).otherwise(month_start(d))
    return F.date_add(first, CYCLE_START_DAY - 1)


def calendar_attributes(date_col: Column | str, mat_months: int = 13) -> dict[str, Column]:
    """Every attribute that depends on the date alone, in output order."""
    d = as_col(date_col)
    m, q, y = month_start(d), quarter_start(d), year_start(d)
    quarter_name = F.concat(F.lit("Q"), F.quarter(d).cast("string"))
    year_text = F.date_format(d, "yyyy")
    return {
        "time_key": date_key(d),
        "date": d,
        "calendar_quarter": quarter_name,
        "calendar_week": F.weekofyear(d),
        "calendar_month": F.date_format(d, "yyyyMM"),
        "year": year_text,
        "mat_start": F.add_months(m, -mat_months),
        "l3m_start": F.add_months(m, -3),
        "ya_l3m_start": F.add_months(m, -15),
        "ya_l3m_end": F.last_day(F.add_months(m, -13)),
        "ya_mat_start": F.add_months(m, -12 - mat_months),
        "ya_mat_end": F.last_day(F.add_months(m, -13)),
        "mat_l3m_end": F.last_day(F.add_months(m, -1)),
        "first_day_month": m,
        "first_day_quarter": q,
        "first_day_year": y,
        "moc_start_date": cycle_start(d),
        "moc_end_date": d,
        "days_month": F.dayofmonth(F.last_day(d)),
        "days_quarter": F.datediff(F.add_months(q, 3), q),
        "days_year": F.datediff(F.add_months(y, 12), y),
        "month_name": F.date_format(d, "MMMM"),
        "qtr_end_name": F.date_format(F.add_months(q, 2), "MMM yyyy"),
        "month_year_name": F.date_format(d, "MMM yyyy"),
        "qtr_year_name": F.concat(quarter_name, F.lit(" "), year_text),
        "last_30_day": F.date_sub(d, LAST_DAYS_SPAN),
        "year_end": F.date_sub(y, 1),
        "first_day_last_month": F.add_months(m, -1),
        "first_day_last_year": F.add_months(y, -12),
        "first_day_last_quarter": F.add_months(q, -3),
        "last_day_last_quarter": F.date_sub(q, 1),
    }
