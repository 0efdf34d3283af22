"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing, shards.

Each stage takes the documents its predecessor kept. ``run`` writes every stage's rows
as Parquet under the shared checkpoint folder and reads them again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.contamination import contaminated
from martloom.llm.curriculum import planned, training_order
from martloom.llm.differencing import sharded
from martloom.llm.frames import stage, table
from martloom.llm.host_rules import host_rules
from martloom.llm.part_enum import similar_components
from martloom.session import broadcast_if_small


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that meet the rules their host's grade asks for."""
    return host_rules(docs).where("kept").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component (five-word shingles, Jaccard 0.8
    or more); rows that repeat an id stand together, rows without an id stay."""
    found = similar_components(docs, width=5, percent=80)
    gone = stage(found.where("id <> component").select(F.col("id").alias("doc_id")).distinct(), "duplicates")
    return docs.join(broadcast_if_small(gone), "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return contaminated(docs, table(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0).select(docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, once for each run the mix takes of them."""
    return training_order(planned(docs)).select(docs.columns)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and their slot in it."""
    return sharded(docs)


STAGES = [
    ("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing),
    ("sharding", sharding),
]

ORACLE_SQL = None  # alignment and differencing have no SQL; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, work) in enumerate(STAGES):
        docs = work(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stage(docs, f"pipeline-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLE = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
