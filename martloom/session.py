"""Session settings and the two scale helpers every plan leans on.

``broadcast_if_small`` is the only place the library hints a broadcast: the
side is measured first and left unhinted when it is over the bound, so Spark
falls back to a shuffled join that adaptive execution can split on skew.

``stage`` cuts lineage by writing a table into the shared checkpoint folder.
Unlike a cached block it survives the loss of an executor, and unlike an RDD
checkpoint it stays columnar, so later reads still prune columns.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Wide facts make generated methods larger than the JVM compiles by default; left
# interpreted, they run about three times slower.
JVM_OPTIONS = "-XX:-DontCompileHugeMethods"

SETTINGS = {
    "spark.driver.extraJavaOptions": JVM_OPTIONS,
    "spark.executor.extraJavaOptions": JVM_OPTIONS,
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}

BROADCAST_MAX_ROWS = 2_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def build_session(app_name: str = "martloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the library's settings; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A local session without the setting gets a temporary folder of its own; a
    cluster session without it is an error, since a machine-local folder would
    be invisible to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="martloom-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once under the checkpoint root and return the written table."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/stage/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Measure a join side: rows and text bytes, as one aggregate with map-side combine."""
    width = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(8))
    row = df.select(width.alias("w")).agg(F.count("*").alias("n"), F.sum("w").alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Hint a broadcast only after measuring the side; otherwise return it unhinted."""
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df
