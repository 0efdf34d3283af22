"""Dataset configuration: ``{"dataset": [["key", "value"], …]}`` in JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.dates import as_col


def config_pairs(spark: SparkSession, path: str, dataset: str) -> DataFrame:
    """``position, key, value`` rows of one dataset, in file order."""
    entries = spark.read.json(path, multiLine=True).select(F.posexplode(as_col(dataset)).alias("position", "entry"))
    return entries.select("position", F.col("entry")[0].alias("key"), F.col("entry")[1].alias("value"))


def load_config(spark: SparkSession, path: str, dataset: str) -> dict[str, str]:
    """The dataset's settings as a mapping; the last value of a repeated key wins."""
    return dict(load_steps(spark, path, dataset))


def load_steps(spark: SparkSession, path: str, dataset: str) -> list[tuple[str, str]]:
    """The dataset's settings as ordered pairs. Configuration is driver-sized by nature."""
    rows = config_pairs(spark, path, dataset).orderBy("position").collect()
    return [(r["key"], r["value"]) for r in rows]
