"""Date parsing and reformatting on text columns.

Three flavours are needed side by side: strict with a length guard, strict
without one, and reformatting that hands the input back when it cannot parse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_FORMAT = "yyyyMMdd"
TEXT_FORMAT = "ddMMMyyyy"
UNPARSABLE = "Unparsable"


def as_col(value: Column | str) -> Column:
    """A column by plain name (any characters) or an expression as it is."""
    return F.col(f"`{value}`") if isinstance(value, str) else value


# Fixed value: a two-digit year lies at most this many years ahead of today.
YEARS_AHEAD = 20


def parse_date(value: Column | str, fmt: str) -> Column:
    """Date or NULL; no look at the length (``d/M/yyyy`` takes ``1/1/2016``).

    Two-digit years fall into the hundred years that end ``YEARS_AHEAD`` years from
    today, where the parser alone would put all of them after 2000.
    """
    parsed = F.try_to_date(as_col(value), fmt)
    if "yy" not in fmt.replace("yyyy", ""):
        return parsed
    limit = F.add_months(F.current_date(), 12 * YEARS_AHEAD)
    return F.when(parsed >= limit, F.add_months(parsed, -1200)).otherwise(parsed)


def parse_date_exact(value: Column | str, fmt: str) -> Column:
    """Date or NULL; the text must also be exactly as long as the pattern."""
    c = as_col(value)
    return F.when(F.length(c) == len(fmt), parse_date(c, fmt))


def reformat_date(value: Column | str, in_fmt: str, out_fmt: str) -> Column:
    """Guarded reformat; text that does not parse comes back unchanged."""
    c = as_col(value)
    return F.coalesce(F.date_format(parse_date_exact(c, in_fmt), out_fmt), c)


def reformat_date_loose(value: Column | str, in_fmt: str, out_fmt: str) -> Column:
    """Reformat without the length guard; unparsed text comes back unchanged."""
    c = as_col(value)
    return F.coalesce(F.date_format(parse_date(c, in_fmt), out_fmt), c)


def date_part_text(value: Column | str, in_fmt: str, out_fmt: str) -> Column:
    """Reformat for a partition column; failures share one visible partition."""
    return F.coalesce(F.date_format(parse_date(value, in_fmt), out_fmt), F.lit(UNPARSABLE))


def date_key(value: Column | str) -> Column:
    """``yyyyMMdd`` text of a date column; NULL stays NULL."""
    return F.date_format(as_col(value), KEY_FORMAT)


def text_to_key(value: Column | str, in_fmt: str) -> Column:
    """``yyyyMMdd`` text of a text date, NULL when it does not parse."""
    return F.date_format(parse_date(value, in_fmt), KEY_FORMAT)


def today_key() -> Column:
    """The current date as ``yyyyMMdd`` text."""
    return F.date_format(F.current_date(), KEY_FORMAT)
