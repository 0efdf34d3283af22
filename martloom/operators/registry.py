"""A key registry whose batches write what they touch.

Keys are hashed into buckets, the partitions of a versioned table. A batch appends its
keys to the buckets it touches; a bucket that has collected ``COMPACT`` deltas is
rewritten as one. So the bytes written follow the batch and not the registry, the
stored version is never deleted before the new one is in place, and a look-up reads
only the buckets of the batch. A NULL in a key is a value like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.dates import as_col
from martloom.operators.integrity import STAMP, mark_matches, merge_registry
from martloom.operators.rules import column_name
from martloom.session import stage
from martloom.sinks.snapshots import Snapshot, before_note, commit, read_snapshot, snapshot

BUCKET = "_bucket"
BUCKETS = 256
COMPACT = 8
BATCH = "batch"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*[as_col(k).cast("string") for k in keys]), F.lit(buckets)).cast("int")


def _folder(bucket: int) -> str:
    return f"{BUCKET}={bucket}"


def _touched(rows: DataFrame) -> list[str]:
    """Buckets the rows fall into; as many as there are buckets at most."""
    return sorted(_folder(r[0]) for r in rows.select(BUCKET).distinct().collect())


def read_keys(
    spark: SparkSession, path: str, keys: Sequence[str], stamp: str = STAMP, at: Snapshot | None = None,
    only: Sequence[str] | None = None, expire_before: str | None = None,
) -> DataFrame | None:
    """Latest stamp per stored key, leaving out stamps below ``expire_before``; None if nothing is stored."""
    stored = read_snapshot(spark, path, at, only)
    if stored is None:
        return None
    latest = merge_registry(None, stored, keys, stamp)
    return latest if expire_before is None else latest.where(as_col(stamp) >= F.lit(expire_before))


def update_keys(
    spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], stamp: str = STAMP, buckets: int = BUCKETS,
    batch: int | None = None, expire_before: str | None = None,
) -> Snapshot:
    """Fold the keys of a batch into the registry.

    With a ``batch`` number the update is done once: run again, it finds its own commit
    and changes nothing. Expired keys go when their bucket is rewritten.
    """
    base = snapshot(spark, path)
    if batch is not None and int(base.note.get(BATCH, -1)) >= batch:
        return base
    names = [column_name(k) for k in keys]
    new = merge_registry(None, rows, keys, stamp).withColumn(BUCKET, bucket_of(names, buckets))
    new = stage(new, "registry-batch")
    touched = _touched(new)
    full = [f for f in touched if len(base.partitions.get(f, ())) >= COMPACT - 1]
    out = new
    if full:
        stored = read_snapshot(spark, path, base, full)
        in_full = F.concat(F.lit(f"{BUCKET}="), F.col(BUCKET).cast("string")).isin(*full)
        merged = merge_registry(stored, new.where(in_full), keys, stamp).withColumn(BUCKET, bucket_of(names, buckets))
        if expire_before is not None:
            merged = merged.where(as_col(stamp) >= F.lit(expire_before))
        out = new.where(~in_full).unionByName(merged)
    note = {**base.note, **({BATCH: str(batch)} if batch is not None else {})}
    return commit(spark, path, out, [BUCKET], "append", note, base, emptied=full, rewritten=full)


def mark_stored(
    df: DataFrame, path: str, keys: Sequence[str], marker: str, stamp: str = STAMP, buckets: int = BUCKETS,
    batch: int | None = None, expire_before: str | None = None,
) -> DataFrame:
    """Flag rows whose key is stored, by a batch before ``batch`` where that is given.

    Only the buckets of the rows are read.
    """
    spark = df.sparkSession
    names = [column_name(k) for k in keys]
    at = snapshot(spark, path) if batch is None else before_note(spark, path, BATCH, batch)
    wanted = stage(df.select(*[as_col(k) for k in names]).distinct().withColumn(BUCKET, bucket_of(names, buckets)), "registry-wanted")
    stored = read_keys(spark, path, keys, stamp, at, _touched(wanted), expire_before)
    if stored is None:
        return df.withColumn(marker, F.lit(False))
    known = stage(stored.select(*[as_col(k) for k in names]), "registry-known")
    return mark_matches(df, known, [(k, k) for k in names], marker)
