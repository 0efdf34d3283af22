"""Text and number normalisation used by the quality rules and the builders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from martloom.functions.dates import as_col

# Widths of the zero-padded business keys.
CUSTOMER_KEY_WIDTH = 10
PRODUCT_KEY_WIDTH = 18
ORDER_LINE_WIDTH = 6


def is_blank(value: Column | str) -> Column:
    """NULL or the empty string (spaces are not blank)."""
    c = as_col(value)
    return c.isNull() | (c == "")


def lead_minus(value: Column | str) -> Column:
    """Move one trailing minus to the front: ``12-`` becomes ``-12``."""
    c = as_col(value)
    return F.when(c.endswith("-"), F.concat(F.lit("-"), c.substr(F.lit(1), F.length(c) - 1))).otherwise(c)


def strip_chars(value: Column | str, chars: str) -> Column:
    """Remove every character of the class ``[chars]``."""
    return F.regexp_replace(as_col(value), f"[{chars}]", "")


# What a number can begin with. Testing it first spares a thrown exception per
# unparsable value, which costs far more than the parsing itself.
NUMBER_START = r"^\s*[+-]?(?:\d|\.\d|NaN|Infinity)"


def guarded_cast(value: Column | str, data_type: str) -> Column:
    """``try_cast`` of text that may often be no number at all."""
    c = as_col(value)
    return F.when(c.rlike(NUMBER_START), c.try_cast(data_type))


def try_decimal(value: Column | str, precision: int = 38, scale: int = 6) -> Column:
    """Decimal or NULL, whatever the input type."""
    return as_col(value).try_cast(f"decimal({precision},{scale})")


def round_half_up_text(value: Column | str, scale: int) -> Column:
    """Text rounded half up to ``scale`` with zeros padded; unparsed text is unchanged."""
    c = as_col(value)
    number = guarded_cast(lead_minus(F.trim(c)), f"decimal(38,{scale})")
    return F.coalesce(number.cast("string"), c)


def pad_key(value: Column | str, width: int) -> Column:
    """Zero-padded key text."""
    return F.lpad(as_col(value).cast("string"), width, "0")


def customer_key(value: Column | str) -> Column:
    return pad_key(value, CUSTOMER_KEY_WIDTH)


def product_key(value: Column | str) -> Column:
    return pad_key(value, PRODUCT_KEY_WIDTH)


def combination_code(*parts: Column | str) -> Column:
    """Key parts joined by ``_``; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("_"))
        pieces.append(as_col(part))
    return F.concat(*pieces)
