"""Star-schema lookups and filters used by the fact builders."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.functions.dates import as_col


def lookup(
    fact: DataFrame,
    dim: DataFrame,
    on: Mapping[str, Column | str] | Sequence[str],
    take: Mapping[str, str] | Sequence[str],
    residual: Column | None = None,
    how: str = "left",
    unique: bool = False,
    salts: int = 0,
    heavy: Sequence[str] = (),
) -> DataFrame:
    """Join ``dim`` attributes onto ``fact`` by (computed) keys.

    ``on`` maps a dimension column to the fact expression it equals; ``take`` maps
    dimension columns to result names. The dimension is cut to these columns and
    de-duplicated (``unique`` skips that for dimensions known to have one row per
    key), so repeated dimension rows do not multiply facts; two different values for
    one key still both match. Broadcast or shuffle is Spark's size-checked choice.
    Computed keys become real columns first, which keeps the join an equi-join.

    With ``salts`` a shuffled join does not gather the facts of one key in one task: facts
    with a NULL in their key, which match nothing, and facts whose first key is in ``heavy``
    (default members and the like) are dealt over so many salts, and the dimension rows of
    ``heavy`` are repeated once per salt.
    """
    on = {c: c for c in on} if not isinstance(on, Mapping) else dict(on)
    take = {c: c for c in take} if not isinstance(take, Mapping) else dict(take)
    side = dim.select(
        *[as_col(d).alias(f"_d{i}") for i, d in enumerate(on)], *[as_col(d).alias(t) for d, t in take.items()]
    )
    if not unique:
        side = side.distinct()
    keyed = fact.select("*", *[as_col(f).alias(f"_f{i}") for i, f in enumerate(on.values())])
    condition = reduce(lambda a, b: a & b, (F.col(f"_f{i}") == F.col(f"_d{i}") for i in range(len(on))))
    if salts > 1:
        spread = reduce(lambda a, b: a | b, (F.col(f"_f{i}").isNull() for i in range(len(on))))
        every = F.array(F.lit(0))
        if heavy:
            spread = spread | F.col("_f0").isin(*heavy)
            every = F.when(F.col("_d0").isin(*heavy), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(every)
        # by content, so that a repeated task deals its rows the same way
        salt = F.pmod(F.xxhash64(*[as_col(c) for c in fact.columns]), F.lit(salts)).cast("int")
        keyed = keyed.withColumn("_fs", F.when(spread, salt).otherwise(0))
        side = side.withColumn("_ds", F.explode(every))
        condition = condition & (F.col("_fs") == F.col("_ds"))
    if residual is not None:
        condition = condition & residual
    joined = keyed.join(side, condition, how)
    return joined.drop(*[f"_f{i}" for i in range(len(on))], *[f"_d{i}" for i in range(len(on))], "_fs", "_ds")


def flag_member(fact: DataFrame, members: DataFrame, column: str, member: str, name: str) -> DataFrame:
    """Boolean column: does ``column`` occur in the list held by ``members``?"""
    keys = members.select(as_col(member).alias("_m")).where("_m IS NOT NULL").distinct()
    joined = fact.join(keys, as_col(column) == F.col("_m"), "left")
    return joined.withColumn(name, F.col("_m").isNotNull()).drop("_m")


def keep_members(fact: DataFrame, members: DataFrame, column: str, member: Column | str) -> DataFrame:
    """Rows whose ``column`` occurs in ``members`` (left semi join)."""
    keys = members.select(as_col(member).alias("_m"))
    return fact.join(keys, as_col(column) == F.col("_m"), "left_semi")


def drop_members(fact: DataFrame, members: DataFrame, column: str, member: Column | str) -> DataFrame:
    """Rows whose ``column`` does not occur in ``members`` (left anti join; NULLs stay)."""
    keys = members.select(as_col(member).alias("_m")).where("_m IS NOT NULL")
    return fact.join(keys, as_col(column) == F.col("_m"), "left_anti")


def conform(df: DataFrame, columns: Mapping[str, Column | str]) -> DataFrame:
    """Project to the target names in the given order."""
    return df.select(*[as_col(source).alias(name) for name, source in columns.items()])


def union_conformed(*frames: DataFrame) -> DataFrame:
    """UNION ALL by position after the frames were conformed to the first one's names."""
    names = frames[0].columns
    return reduce(DataFrame.unionByName, (f.toDF(*names) for f in frames))


def not_in_or_null(column: Column | str, values: Sequence[str]) -> Column:
    """``NOT IN (…) OR IS NULL``."""
    c = as_col(column)
    return c.isNull() | ~c.isin(*values)
