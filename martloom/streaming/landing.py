"""Landing files as a stream: the same checks, one micro-batch at a time.

Every output of a batch is written under its batch number by partition
replacement, so a batch that runs again after a failure replaces its own rows
instead of adding them twice. Keys seen by earlier batches are kept in a versioned,
bucketed key table (``operators.registry``): a batch reads the buckets its own keys
fall into, as they were before it, and adds its keys in one commit under its number.
"""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from martloom.operators.integrity import DUPLICATE_REASON, STAMP, mark_repeated
from martloom.operators.registry import mark_stored, update_keys
from martloom.operators.rules import Check, column_name, derive_columns, outcomes, rejects, survivors
from martloom.plans.ingest import IngestConfig, audit_counts, audit_rows, build_checks, by_header
from martloom.session import stage
from martloom.sinks.writers import write_table
from martloom.sources import files
from martloom.sources.landing import FILE, LandingFile, landing_rows, probe_headers

BATCH = "batch_id"
DAY_MILLIS = 86_400_000


def read_landing_stream(
    spark: SparkSession, path: str, config: IngestConfig, files_per_batch: int | None = None
) -> DataFrame:
    """A stream of landing rows (text columns by position) with the file path as ``_file``."""
    reader = spark.readStream.option("header", config.header)
    reader = reader.option("sep", config.delimiter).option("pathGlobFilter", "*.csv")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return landing_rows(reader, path, config.columns, config.check_width)


def keys_path(config: IngestConfig) -> str:
    """Where the keys seen by earlier batches are kept."""
    return f"{config.registry_path or config.lake_path + '_registry'}/{config.dataset}-seen"


def stored_duplicate_check(config: IngestConfig, batch_id: int, expire_before: str | None) -> Check:
    """Rows fail whose key repeats in the batch or was seen by an earlier one, kept there or not."""
    names = [column_name(k) for k in config.duplicate_keys]

    def attach(df: DataFrame) -> DataFrame:
        marked = mark_stored(df, keys_path(config), names, "_stored", STAMP, config.key_buckets, batch_id, expire_before)
        return mark_repeated(marked, names)

    return Check(
        DUPLICATE_REASON.format(keys=",".join(names)), ~(F.col("_repeated") | F.col("_stored")),
        config.reject.get("duplicate", False), attach=attach, helpers=("_repeated", "_stored"),
    )


def write_batch(rows: DataFrame, batch_id: int, config: IngestConfig, start: int | None = None) -> None:
    """Check one micro-batch and write good rows, rejects, audit rows and keys.

    Files whose first line does not fit are refused whole, as in a batch run.
    """
    spark = rows.sparkSession
    start = start if start is not None else int(time.time() * 1000)
    rows = stage(rows, f"batch-{config.dataset}")
    paths = sorted(r[0] for r in rows.select(FILE).distinct().collect())  # files of one batch
    there = [p for p in paths if files.exists(spark, p)]
    _, refused = by_header(probe_headers(spark, there, config.delimiter), config)
    wrong = {f.path for f in refused}
    if wrong:
        rows = rows.where(~F.col(FILE).isin(*wrong))
    if config.stamp:
        rows = rows.withColumn(STAMP, F.lit(str(start)))
    expire_before = str(start - config.key_days * DAY_MILLIS) if config.key_days else None
    stored = bool(config.stored_keys and config.duplicate_keys)
    duplicates = stored_duplicate_check(config, batch_id, expire_before) if stored else None
    found = outcomes(rows, build_checks(spark, config, duplicates)).staged(f"checked-{config.dataset}")
    good, partitions = derive_columns(survivors(found).drop(FILE), config.derive)
    listed = [LandingFile(p, ()) for p in paths if p not in wrong]
    audits = [audit_rows(spark, config, listed, audit_counts(found), start)] if listed else []
    if refused:
        audits.append(audit_rows(spark, config, refused, None, start))
    number = F.lit(batch_id)
    for df, path, parts in (
        (good, config.lake_path, partitions),
        (rejects(found), f"{config.error_path}/records", []),
        (reduce(DataFrame.unionByName, audits) if audits else None, f"{config.error_path}/audit", []),
    ):
        if df is not None:
            write_table(df.withColumn(BATCH, number), path, [BATCH, *parts], "overwrite", config.fmt)
    if config.registry_keys and config.registry_path:
        update_keys(spark, f"{config.registry_path}/{config.dataset}", good, config.registry_keys, buckets=config.key_buckets, batch=batch_id)
    if stored:
        seen = rows.withColumn(STAMP, F.lit(str(start)))
        update_keys(spark, keys_path(config), seen, config.duplicate_keys, STAMP, config.key_buckets, batch_id, expire_before)


def run_batches(stream: DataFrame, config: IngestConfig, progress_path: str, once: bool = True) -> StreamingQuery:
    """Start the stream; ``once`` takes what is there and stops.

    Referential checks see one batch at a time, duplicate checks too unless
    ``storedKeys`` is set.
    """
    writer = stream.writeStream.option("checkpointLocation", progress_path)
    writer = writer.foreachBatch(lambda rows, batch_id: write_batch(rows, batch_id, config))
    return (writer.trigger(availableNow=True) if once else writer).start()
