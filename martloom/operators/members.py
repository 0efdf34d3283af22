"""Dimension patterns: unique members, first member, primary flags, priority union,
placeholder members and surrogate ids.

None of them puts a whole key group into one task: groups are reduced map-side,
and only one row per key is ever compared with its rivals.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.dates import as_col
from martloom.session import broadcast_if_small, stage

ROW = "_row"


def unique_members(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not NULL and occurs exactly once.

    One aggregate does it: where the count is 1, "any value" of the other columns
    is the row itself, so nothing is joined back.
    """
    rest = [c for c in df.columns if c not in keys]
    known = reduce(lambda a, b: a & b, (as_col(k).isNotNull() for k in keys))
    grouped = df.where(known).groupBy(*[as_col(k) for k in keys]).agg(
        F.count("*").alias("_n"), *[F.first(as_col(c)).alias(c) for c in rest]
    )
    return grouped.where("_n = 1").select(*[as_col(c) for c in df.columns])


def first_member(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key by ``order``.

    Written as ``row_number() = 1`` so that Spark keeps only the leading row of each
    key in every map task before the shuffle. Pass a total order for a stable result.
    """
    window = Window.partitionBy(*[as_col(k) for k in keys]).orderBy(*[as_col(o) for o in order])
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def _primary_rows(rows: DataFrame, keys: Sequence[str], order: Sequence[str], rest: Sequence[str]) -> DataFrame:
    """The row number (``_row``) of the primary row of each key.

    The least order value of a key is found over narrow columns, with one candidate per
    key and map task sent on. The rows that share it, as a rule one per key, are then
    told apart by the remaining columns.
    """
    key_cols = [as_col(k) for k in keys]
    columns = dict.fromkeys([*keys, *order])
    narrow = rows.select(*[as_col(c) for c in columns], ROW)
    first = first_member(narrow, keys, [*order, ROW])
    if not rest:
        return first.select(ROW)
    lead = first.select(*[as_col(c).alias(f"_o{i}") for i, c in enumerate(columns)])
    lead = broadcast_if_small(stage(lead, "primary-lead"))
    on = reduce(lambda a, b: a & b, (rows[f"`{c}`"].eqNullSafe(lead[f"_o{i}"]) for i, c in enumerate(columns)))
    tied = stage(rows.join(lead, on, "left_semi"), "primary-tied")
    window = Window.partitionBy(*key_cols).orderBy(*[as_col(c) for c in rest], ROW)
    return tied.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").select(ROW)


def flag_primary(
    df: DataFrame, flags: Mapping[str, tuple[Sequence[str], Sequence[str]]]
) -> DataFrame:
    """Add ``'1'/'0'`` columns that mark one primary row per key.

    ``flags`` maps a new column to (key columns, order columns). Ties are broken by
    the remaining columns, exact copies by the number a row gets when the members are
    written, so exactly one is primary. Keys compare null-safely. A key with a third of
    all rows stays spread out: each task sends on one candidate for it, and the primary
    rows' numbers are measured and joined back.
    """
    columns = df.columns
    rows = stage(df.withColumn(ROW, F.monotonically_increasing_id()), "flag-members")
    out = rows
    for name, (keys, order) in flags.items():
        rest = [c for c in columns if c not in (*keys, *order)]
        primary = stage(_primary_rows(rows, keys, order, rest).withColumnRenamed(ROW, f"_at_{name}"), "primary-rows")
        out = out.join(broadcast_if_small(primary), F.col(ROW) == F.col(f"_at_{name}"), "left")
    return out.select(
        *[as_col(c) for c in columns], *[F.when(F.col(f"_at_{n}").isNotNull(), "1").otherwise("0").alias(n) for n in flags]
    )


def priority_union(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Distinct rows of the first source, then of each later source for keys not seen before.

    A key belongs to the lowest-numbered source that has it. That owner is one
    aggregate over keys; rows then meet it by an equi-join. Rows of later sources
    with a NULL key are left out, as a null-aware anti join leaves them out; if any
    earlier source has a NULL key, so is every row of the later ones.
    """
    tagged = [s.withColumn("_source", F.lit(i)) for i, s in enumerate(sources)]
    rows = reduce(DataFrame.unionByName, tagged).distinct()
    any_null = reduce(lambda a, b: a | b, (as_col(k).isNull() for k in keys))
    key_cols = [as_col(k) for k in keys]
    owners = rows.groupBy(*[c.alias(f"_k{i}") for i, c in enumerate(key_cols)]).agg(F.min("_source").alias("_owner"))
    blocked = rows.where(any_null).agg(F.min("_source")).scalar()
    on = reduce(lambda a, b: a & b, (as_col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)))
    owned = rows.join(owners, on).where("_source = _owner")
    allowed = (F.col("_source") == 0) | (~any_null & (F.col("_source") <= F.coalesce(blocked, F.lit(len(sources)))))
    return owned.where(allowed).select(*[as_col(c) for c in sources[0].columns])


def placeholder_members(
    codes: DataFrame, master: DataFrame, code: str, master_code: str, fill: Mapping[str, Column], columns: Sequence[str]
) -> DataFrame:
    """One row per code that ``master`` lacks, ``fill`` in the named columns and ``''`` elsewhere."""
    known = master.select(as_col(master_code).alias("_known")).where("_known IS NOT NULL").distinct()
    wanted = codes.select(as_col(code).alias("_code")).where("_code IS NOT NULL").distinct()
    missing = wanted.join(known, F.col("_code") == F.col("_known"), "left_anti")
    return missing.select(*[fill.get(c, F.lit("")).alias(c) for c in columns])


def add_surrogate_id(df: DataFrame, order: Sequence[str], name: str = "id") -> DataFrame:
    """Consecutive ids 1..n in ``order`` without sorting everything in one task.

    The rows are range-partitioned and sorted, written once with their partition
    and position, and shifted by the number of rows in earlier partitions. Only one
    row per partition takes part in the running count. Ties fall to the other columns.
    """
    full = [as_col(c) for c in dict.fromkeys([*order, *df.columns])]
    placed = df.repartitionByRange(*full).sortWithinPartitions(*full)
    # the lower 33 bits of the generated id count rows inside the partition
    numbered = placed.select(
        "*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("_pos")
    )
    written = stage(numbered, "surrogate-id")
    sizes = written.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    numbered = written.join(F.broadcast(offsets), "_part")
    return numbered.select((F.col("_offset") + F.col("_pos") + 1).alias(name), *[as_col(c) for c in df.columns])
