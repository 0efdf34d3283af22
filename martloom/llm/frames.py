"""Small DataFrame helpers the operators share."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from martloom.session import stage

__all__ = ["clear", "components", "per_row", "ship", "running_total", "stage", "table", "unused"]


_shipped: set[str] = set()

# Texts differ in length by orders of magnitude, so batches are bounded by bytes: a worker
# and the off-heap vectors behind it then hold a few MB (or one longer text) at a time.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, as ``--py-files`` would,
    and bound Arrow batches by bytes where the session allows much larger ones."""
    if int("".join(filter(str.isdigit, spark.conf.get(BATCH)))) > 4 * BATCH_BYTES:
        spark.conf.set(BATCH, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    bundle = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(bundle, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(bundle))
    _shipped.add(context.applicationId)


def per_row(work: Callable[[pa.Array], pa.Array], schema: str):
    """A column function of one text column that works on whole Arrow arrays."""

    def run(column: pa.Array) -> pa.Array:
        return work(column)

    ship(SparkSession.getActiveSession())
    run.__name__ = work.__name__
    return F.arrow_udf(run, schema)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def clear(df: DataFrame, *made: str) -> DataFrame:
    """Drop input columns that carry the name of a column about to be made."""
    names = {m.lower() for m in made}
    return df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in names))


def unused(df: DataFrame, stem: str) -> str:
    """A column name that ``df`` does not have."""
    names = {c.lower() for c in df.columns}
    while stem.lower() in names:
        stem += "_"
    return stem


def running_total(
    df: DataFrame, group: str, order: list[str], value: Column, out: str, rows: int | None = None, per_bucket: int = 128
) -> DataFrame:
    """Sum of ``value`` over the earlier rows of a group, for groups of any size.

    Rows are ordered by the first 15 hex digits of the MD5 of the first ``order`` column
    and then by these columns.
    The hash range of a group is cut into buckets of about ``per_bucket`` rows at the
    mean, buckets into spans of 256; sums of spans, of buckets and of rows are added.
    No task holds a group: the rows of a bucket meet, then 256 bucket sums, then the
    span sums of a group (its rows / 32,768).
    """
    if rows is None:
        rows = df.count()
    bits = max(8, (max(1, rows) // per_bucket).bit_length())
    digits = F.substring(F.md5(F.coalesce(F.col(f"`{order[0]}`").cast("string"), F.lit("")).cast("binary")), 1, 15)
    hashed = F.conv(digits, 16, 10).cast("long")
    df = df.withColumn("_h", hashed).withColumn("_v", value).withColumn("_b", F.shiftrightunsigned("_h", 60 - bits))
    key = F.coalesce(F.concat(F.lit("+"), F.col(f"`{group}`").cast("string")), F.lit("-"))
    df = df.withColumn("_g", key)
    sums = df.groupBy("_g", "_b").agg(F.sum("_v").alias("_s")).withColumn("_p", F.shiftright("_b", 8))
    zero = F.lit(0).cast("long")

    def earlier(keys: list[str], by: list) -> Window:
        return Window.partitionBy(*keys).orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)

    spans = sums.groupBy("_g", "_p").agg(F.sum("_s").alias("_t"))
    spans = spans.withColumn("_t", F.coalesce(F.sum("_t").over(earlier(["_g"], ["_p"])), zero))
    starts = sums.withColumn("_s", F.coalesce(F.sum("_s").over(earlier(["_g", "_p"], ["_b"])), zero)).join(spans, ["_g", "_p"])
    starts = starts.select("_g", "_b", (F.col("_s") + F.col("_t")).alias("_start"))
    local = earlier(["_g", "_b"], ["_h", *(F.col(f"`{c}`") for c in order)])
    df = df.withColumn("_v", F.coalesce(F.sum("_v").over(local), zero))
    df = df.join(starts, ["_g", "_b"])
    return df.withColumn(out, F.col("_v") + F.col("_start")).drop("_g", "_b", "_h", "_v", "_start")


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Smallest node of each connected component: rows ``node``, ``root``.

    ``edges`` has columns ``u`` and ``v`` (long, any order). Alternates the large-star
    and small-star steps, each a join of narrow edges with their grouped minima, on
    tables written between rounds, until a round changes nothing.
    """
    edges = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    edges = stage(edges, label)

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    seen = mark(edges)
    while seen[0]:
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")
        )
        edges = stage(small.select("e.u", "e.v").where("u <> v").distinct(), label)
        now = mark(edges)
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
