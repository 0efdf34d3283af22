"""Batch writers.

Output is laid out by a rebalance rather than a plain hash of the partition
columns: adaptive execution then splits a partition value that holds a third of
all rows over several tasks and merges the small ones, so neither a giant file
nor a swarm of tiny ones comes out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Names of the date partition columns.
DATE_PARTITIONS = ("num_years", "num_month", "num_date")


def write_table(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "append",
    fmt: str = "parquet",
    single_file: bool = False,
    files: int | None = None,
) -> None:
    """Write with any number of partition columns.

    ``overwrite`` with partition columns replaces only the partitions present in
    ``df``; without them it replaces the table. ``single_file`` is for small
    dimensions, ``files`` fixes the number of output tasks.
    """
    if single_file:
        # a shuffle, so that the work before the write keeps its parallelism
        df = df.repartition(1)
    elif files is not None:
        df = df.repartition(files)
    elif partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.save(path)


def replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet") -> None:
    """Replace exactly the partitions ``df`` has rows for; all others stay.

    New files are staged by the commit protocol and swapped in at job commit, so a
    failed job leaves the old partitions in place.
    """
    write_table(df, path, partition_by, "overwrite", fmt)


def with_date_partitions(df: DataFrame, date_col: str) -> DataFrame:
    """Add year, month and day text columns for partitioning."""
    formats = ("yyyy", "MM", "dd")
    return df.withColumns({n: F.date_format(date_col, f) for n, f in zip(DATE_PARTITIONS, formats, strict=True)})


def write_grains(rolled: DataFrame, path: str, mode: str = "overwrite", fmt: str = "parquet") -> None:
    """One folder per grain from one pass over the rolled-up fact."""
    write_table(rolled, path, ["timeperiod_type"], mode, fmt)


def append_run(df: DataFrame, path: str, run_date: str, fmt: str = "parquet") -> None:
    """Append rejects or audit rows under the date of the run."""
    write_table(df.withColumn("run_date", F.lit(run_date)), path, ["run_date"], "append", fmt)
