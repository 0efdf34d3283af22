"""Checks and tables that look across rows: duplicates, references, key registry."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import as_col
from martloom.operators.rules import ALIVE, Check, column_name
from martloom.session import broadcast_if_small, stage

# The reasons written to the reject stream.
DUPLICATE_REASON = "Duplicate record found for combination : {keys}"
REFERENCE_REASON = (
    "Referential Integrity failed while comparing with master {master}"
    " on at least one of the following conditions {pairs}"
)
STAMP = "PROCESS_TIMESTAMP"


def _null_safe(pairs: Sequence[tuple[Column, Column]]) -> Column:
    return reduce(lambda a, b: a & b, (left.eqNullSafe(right) for left, right in pairs))


def mark_matches(df: DataFrame, keys_df: DataFrame, pairs: Sequence[tuple[str, str]], marker: str) -> DataFrame:
    """Left-join distinct key rows null-safely and flag the rows that matched.

    ``keys_df`` must be unique on its key columns, so rows keep their multiplicity.
    A small key side is broadcast and ``df`` does not move; otherwise this is a
    shuffled join whose hot keys adaptive execution can split, as the key side
    has one row per key.
    """
    renamed = keys_df.select(*[as_col(k).alias(f"_key{i}") for i, (_, k) in enumerate(pairs)], F.lit(True).alias(marker))
    on = _null_safe([(df[f"`{c}`"], renamed[f"_key{i}"]) for i, (c, _) in enumerate(pairs)])
    joined = df.join(broadcast_if_small(renamed), on, "left")
    return joined.drop(*[f"_key{i}" for i in range(len(pairs))]).withColumn(marker, F.coalesce(marker, F.lit(False)))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key combinations held by more than one row; NULLs count as equal.

    Counts are combined map-side, so a key on a third of all rows costs one row
    per map task.
    """
    return df.groupBy(*[as_col(k) for k in keys]).count().where("count > 1").drop("count")


def mark_repeated(df: DataFrame, keys: Sequence[str], marker: str = "_repeated") -> DataFrame:
    """Flag every row whose key occurs more than once (among live rows, inside a rule chain)."""
    counted = df.where(ALIVE) if ALIVE in df.columns else df
    found = stage(repeated_keys(counted, keys), "repeated-keys")
    return mark_matches(df, found, [(k, k) for k in keys], marker)


def duplicate_check(keys: Sequence[str], reject: bool = False) -> Check:
    """All rows of a repeated key fail; none of them is kept as the good one."""
    names = [column_name(k) for k in keys]
    return Check(
        DUPLICATE_REASON.format(keys=",".join(names)),
        ~F.col("_repeated"),
        reject,
        attach=lambda df: mark_repeated(df, names),
        helpers=("_repeated",),
    )


def reference_check(
    master: DataFrame, pairs: Sequence[tuple[str, str]], master_name: str, reject: bool = False
) -> Check:
    """Rows must find their key in ``master``; ``pairs`` are (column, master column)."""
    pairs = [(column_name(a), column_name(b)) for a, b in pairs]
    keys = master.select(*[as_col(b) for b in dict.fromkeys(b for _, b in pairs)]).distinct()
    reason = REFERENCE_REASON.format(master=master_name, pairs=",".join(f"{a}-{b}" for a, b in pairs))
    return Check(
        reason,
        F.col("_referenced"),
        reject,
        attach=lambda df: mark_matches(df, keys, pairs, "_referenced"),
        helpers=("_referenced",),
    )


def split_by_reference(
    df: DataFrame, master: DataFrame, pairs: Sequence[tuple[str, str]]
) -> tuple[DataFrame, DataFrame]:
    """(rows found in master, rows not found), both with full multiplicity."""
    keys = master.select(*[as_col(b).alias(f"_m{i}") for i, (_, b) in enumerate(pairs)]).distinct()
    keys = broadcast_if_small(keys)
    on = _null_safe([(df[f"`{a}`"], keys[f"_m{i}"]) for i, (a, _) in enumerate(pairs)])
    return df.join(keys, on, "left_semi"), df.join(keys, on, "left_anti")


def parse_reference(text: str) -> list[tuple[str, list[tuple[str, str]]]]:
    """``file|a-b&c-d,file2|…`` as (file, [(column, master column)])."""
    out = []
    for item in filter(None, text.split(",")):
        path, columns = item.split("|")
        out.append((path.strip(), [tuple(column_name(c) for c in pair.split("-")) for pair in columns.split("&")]))
    return out


def merge_registry(stored: DataFrame | None, batch: DataFrame, keys: Sequence[str], stamp: str = STAMP) -> DataFrame:
    """Latest stamp per key over the stored registry and the new rows."""
    names = [column_name(k) for k in keys]
    columns = [as_col(k) for k in names]
    rows = batch.select(*columns, as_col(stamp))
    if stored is not None:
        rows = stored.select(*columns, as_col(stamp)).unionByName(rows)
    return rows.groupBy(*columns).agg(F.max(as_col(stamp)).alias(stamp))
