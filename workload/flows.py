"""File-based flows: ingestion, restatement, grain layout, pipelines and the streaming form.

Landing files are written by Spark from the given tables into a fresh folder under
the checkpoint root, so the work grows with the tables.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.operators.registry import read_keys
from martloom.operators.rollup import period_rollup
from martloom.plans.ingest import IngestConfig, ingest
from martloom.plans.pipeline import run_pipeline, run_queries
from martloom.session import checkpoint_root
from martloom.sinks.writers import replace_partitions, with_date_partitions, write_grains, write_table
from martloom.sources.config import load_config, load_steps
from martloom.sources.landing import read_delimited
from martloom.streaming.landing import read_landing_stream, run_batches
from workload.common import calendar, rounded, table
from workload.facts import DUCK, SPARK, render

COLUMNS = ["order_no", "cust", "amount", "order_day", "line_count", "status"]
_LANDING = {
    "order_no": "CAST(o_orderkey AS {text})",
    "cust": "CASE WHEN o_orderkey % 29 = 0 THEN 'C-toolongid' ELSE concat('C', o_custkey) END",
    "amount": "CASE o_orderkey % 7 WHEN 0 THEN concat(CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS {text}), '-')"
    " WHEN 1 THEN 'n/a' ELSE CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS {text}) END",
    "order_day": "CASE WHEN o_orderkey % 10 = 3 THEN '20010231' ELSE {day} END",
    "line_count": "CASE WHEN o_orderkey % 12 = 5 THEN '3-' WHEN o_orderkey % 12 = 6 THEN 'many' ELSE '4' END",
    "status": "o_orderstatus",
}
RULES = "cust-VARCHAR(8)|amount-DECIMAL(10,2)|order_day#DATE(yyyyMMdd,true)|line_count-INT"


def _fresh(spark: SparkSession, label: str) -> str:
    return f"{checkpoint_root(spark)}/flows/{label}-{uuid.uuid4().hex}"


def _land(df: DataFrame, folder: str, name: str) -> None:
    """Write ``df`` as delimited files whose names start with ``name``."""
    df.write.option("header", True).mode("append").csv(f"{folder}/{name}")


def _settings(root: str, **extra: str) -> dict[str, str]:
    return {
        "processClass": "Transaction", "LandingPath": f"{root}/landing", "UDLpath": f"{root}/lake", "ErrorPath": f"{root}/errors",
        "schema": ",".join(COLUMNS), "header": "true", "delimiter": ",", "mode": "append", "SchemaValidationColumn": RULES,
        "rejectLengthData": "true", "rejectDecimalData": "true", "rejectDateData": "false", "rejectInteger": "true",
        "SplitDateColumn": "yyyy#order_day#yyyyMMdd#yyyy", **extra,
    }


def _ingested(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """Two status groups as landing folders plus one folder with a wrong header; returns the audit."""
    root = _fresh(spark, "ingest")
    rows = table(spark, sf_dir, "orders").selectExpr(*render(_LANDING, SPARK))
    _land(rows.where("status <> 'P'"), f"{root}/landing", "orders_main.csv")
    _land(rows.where("status = 'P'").drop("line_count"), f"{root}/landing", "orders_short.csv")
    settings = _settings(root, LandingFileName="orders_*/part-", mappingPrimaryKey="status", mappingFilePath=f"{root}/registry")
    config = IngestConfig.from_map(settings, "Orders")
    return root, ingest(spark, config, "20240101", 1700000000000)


def ingest_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows of the ingested landing files, read back from the lake."""
    root, _ = _ingested(spark, sf_dir)
    return spark.read.parquet(f"{root}/lake").select(*COLUMNS, F.col("yyyy").cast("string").alias("yyyy"))


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _ingested(spark, sf_dir)
    rows = spark.read.parquet(f"{root}/errors/records")
    return rows.select(*COLUMNS, F.col("Rejection_Reason").alias("reason"))


def ingest_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit totals by status; files are as many as the writer made."""
    _, audit = _ingested(spark, sf_dir)
    return audit.groupBy(F.col("Status").alias("status"), F.col("Reason").alias("reason")).agg(
        F.sum("InputRowCount").alias("rows_in"), F.sum("RejectedRowCount").alias("rows_rejected"),
        F.sum("OutputRowCount").alias("rows_out"),
    )


def ingest_registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    root, _ = _ingested(spark, sf_dir)
    return read_keys(spark, f"{root}/registry/Orders", ["status"]).withColumnRenamed("PROCESS_TIMESTAMP", "stamp")


_INGEST_SQL = f"""d AS (SELECT {', '.join(render(_LANDING, DUCK))}, o_orderkey, o_orderdate FROM orders WHERE o_orderstatus <> 'P'),
    c AS (SELECT *, o_orderkey % 29 = 0 AS bad1, o_orderkey % 7 = 1 AS bad2, o_orderkey % 10 = 3 AS bad3, o_orderkey % 12 = 6 AS bad4,
        CASE o_orderkey % 7 WHEN 0 THEN '-' || left(amount, -1) ELSE amount END AS amount2,
        CASE WHEN line_count = '3-' THEN '-3' ELSE line_count END AS line2 FROM d),
    r AS (SELECT order_no, cust, amount, order_day, line_count, status, 'Some Columns of :''cust-VARCHAR(8)'' exceeds max length' AS reason FROM c WHERE bad1
        UNION ALL SELECT order_no, cust, amount, order_day, line_count, status, 'Decimal columns amount-DECIMAL(10,2) not in proper format' FROM c WHERE NOT bad1 AND bad2
        UNION ALL SELECT order_no, cust, amount2, order_day, line_count, status, 'Date fields: order_day#DATE(yyyyMMdd,true) not in proper format' FROM c WHERE NOT bad1 AND NOT bad2 AND bad3
        UNION ALL SELECT order_no, cust, amount2, order_day, line_count, status, 'Integer fields not in proper format for column: line_count-INT' FROM c WHERE NOT bad1 AND NOT bad2 AND bad4),
    g AS (SELECT * FROM c WHERE NOT bad1 AND NOT bad2 AND NOT bad4)"""
INGEST_LAKE_SQL = f"""WITH {_INGEST_SQL} SELECT order_no, cust, amount2 AS amount, order_day, line2 AS line_count, status,
    CASE WHEN bad3 THEN 'Unparsable' ELSE strftime(o_orderdate, '%Y') END AS yyyy FROM g"""
INGEST_REJECTS_SQL = f"WITH {_INGEST_SQL} SELECT * FROM r"
INGEST_AUDIT_SQL = f"""WITH {_INGEST_SQL} SELECT 'PROCESSED' AS status, 'NA' AS reason, (SELECT count(*) FROM c) AS rows_in,
    (SELECT count(*) FROM r) AS rows_rejected, (SELECT count(*) FROM g) AS rows_out
    UNION ALL SELECT 'REJECTED', 'HEADER MISMATCH', 0, 0, 0"""
INGEST_REGISTRY_SQL = f"WITH {_INGEST_SQL} SELECT DISTINCT status, '1700000000000' AS stamp FROM g"


def ingest_restatement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Restating folders, known by name, replace exactly the year partitions they have rows for.

    Each lands in many files; of two restatements of a year the later one stays, whole.
    """
    root = _fresh(spark, "restate")
    rows = table(spark, sf_dir, "orders").selectExpr(*render(_LANDING, SPARK))
    year = rows.where("substr(order_day, 1, 4) = '1999' AND order_day <> '20010231'")
    _land(rows, f"{root}/landing", "orders_1.csv")
    for i, status in ((2, "O"), (3, "F")):
        again = year.where(F.col("status") == status).withColumn("status", F.lit("restated"))
        _land(again.repartition(4), f"{root}/landing", f"orders_{i}_RESTATEMENT.csv")
    plain = _settings(root, LandingFileName="orders_*/part-", SchemaValidationColumn="NA")
    ingest(spark, IngestConfig.from_map(plain, "Orders"), "20240101")
    return spark.read.parquet(f"{root}/lake").select(*COLUMNS, F.col("yyyy").cast("string").alias("yyyy"))


RESTATEMENT_SQL = f"""WITH d AS (SELECT {', '.join(render(_LANDING, DUCK))} FROM orders),
    k AS (SELECT *, CASE WHEN order_day = '20010231' THEN 'Unparsable' ELSE substr(order_day, 1, 4) END AS yyyy FROM d)
    SELECT * FROM k WHERE yyyy <> '1999' UNION ALL
    SELECT * REPLACE ('restated' AS status) FROM k WHERE yyyy = '1999' AND status = 'F'"""


def partition_replace(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date-partitioned table whose later months are rewritten."""
    path = _fresh(spark, "replace")
    orders = with_date_partitions(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus"), "o_orderdate")
    parts = ["num_years", "num_month"]
    write_table(orders.drop("num_date"), path, parts)
    late = orders.drop("num_date").where("num_years = '2000' AND num_month >= '07'")
    replace_partitions(late.withColumn("o_orderstatus", F.lit("N")), path, parts)
    back = spark.read.parquet(path)
    return back.select(
        "o_orderkey", "o_orderstatus", F.col("num_years").cast("string").alias("num_years"),
        F.lpad(F.col("num_month").cast("string"), 2, "0").alias("num_month"),
    )


PARTITION_REPLACE_SQL = """SELECT o_orderkey, CASE WHEN year(o_orderdate) = 2000 AND month(o_orderdate) >= 7 THEN 'N' ELSE o_orderstatus END AS o_orderstatus,
    strftime(o_orderdate, '%Y') AS num_years, strftime(o_orderdate, '%m') AS num_month FROM orders"""


def grain_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder per grain, read back with partition pruning."""
    path = _fresh(spark, "grains")
    rolled = period_rollup(
        table(spark, sf_dir, "orders"), calendar(spark, sf_dir, "orders"), ["o_orderpriority"],
        {"o_totalprice": "decimal(19,6)"}, "o_orderdate", ["MONTH", "QUARTER", "YEAR"],
    )
    write_grains(rolled, path)
    back = spark.read.parquet(path).where("timeperiod_type <> 'QUARTER'")
    return rounded(back, "o_totalprice").select("o_orderpriority", "time_key", "o_totalprice", "timeperiod_type")


GRAIN_LAYOUT_SQL = " UNION ALL ".join(
    f"""SELECT o_orderpriority, strftime(date_trunc('{p}', o_orderdate), '%Y%m%d') AS time_key,
    CAST(round(sum(CAST(o_totalprice AS DECIMAL(19,6))), 4) AS DOUBLE) AS o_totalprice, '{g}' AS timeperiod_type FROM orders GROUP BY ALL"""
    for g, p in (("MONTH", "month"), ("YEAR", "year"))
)


def _write_config(spark: SparkSession, path: str, config: dict) -> None:
    spark.createDataFrame([(json.dumps(config),)], "value string").coalesce(1).write.text(path)


def config_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """READ, QUERY and WRITE steps from a JSON configuration, result read back."""
    root = _fresh(spark, "pipeline")
    _land(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), root, "orders")
    _land(table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment"), root, "customer")
    steps = [
        ["READ|flow_orders", f"{root}/orders"], ["READ|flow_customers", f"{root}/customer"],
        ["QUERY|flow_joined", "SELECT c_mktsegment, CAST(o_totalprice AS DECIMAL(19,2)) AS v FROM flow_orders JOIN flow_customers ON o_custkey = c_custkey"],
        ["QUERY|flow_totals", "SELECT c_mktsegment, count(*) AS n, sum(v) AS total FROM flow_joined GROUP BY c_mktsegment"],
        ["WRITE|flow_totals", f"{root}/out"],
    ]
    _write_config(spark, f"{root}/config", {"Flow": steps})
    run_pipeline(spark, load_steps(spark, f"{root}/config", "Flow"))
    back = read_delimited(spark, f"{root}/out")
    return back.select("c_mktsegment", F.col("n").cast("bigint").alias("n"), F.col("total").cast("double").alias("total"))


CONFIG_STEPS_SQL = """SELECT c_mktsegment, count(*) AS n, CAST(sum(CAST(o_totalprice AS DECIMAL(19,2))) AS DOUBLE) AS total
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL"""


def query_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The variant with a list of data files and one query per key."""
    root = _fresh(spark, "queries")
    _land(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag"), root, "lines")
    settings = [
        ["DataFiles", f"{root}/lines#set_lines"],
        ["set_typed", "SELECT l_returnflag, CAST(l_quantity AS DOUBLE) AS q FROM set_lines"],
        ["set_result", "SELECT l_returnflag, sum(q) AS qty, count(*) AS n FROM set_typed GROUP BY l_returnflag"],
    ]
    _write_config(spark, f"{root}/config", {"Set": settings})
    assert load_config(spark, f"{root}/config", "Set")["DataFiles"]
    return run_queries(spark, load_steps(spark, f"{root}/config", "Set"))["set_result"]


QUERY_SET_SQL = "SELECT l_returnflag, sum(l_quantity) AS qty, count(*) AS n FROM lineitem GROUP BY ALL"


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ingestion rules under Structured Streaming: files arrive, batches are checked and written."""
    root = _fresh(spark, "stream")
    rows = table(spark, sf_dir, "orders").selectExpr(*render(_LANDING, SPARK))
    for i, status in enumerate(("F", "O", "P")):
        _land(rows.where(F.col("status") == status), f"{root}/landing", f"drop{i}")
    config = IngestConfig.from_map(_settings(root), "Orders")
    stream = read_landing_stream(spark, f"{root}/landing/*", config, files_per_batch=4)
    query = run_batches(stream, config, f"{root}/progress")
    query.awaitTermination()
    good = spark.read.parquet(f"{root}/lake").select(*COLUMNS, F.lit("").alias("reason"))
    bad = spark.read.parquet(f"{root}/errors/records").select(*COLUMNS, F.col("Rejection_Reason").alias("reason"))
    return good.unionByName(bad)


STREAM_SQL = f"""WITH {_INGEST_SQL.replace(" WHERE o_orderstatus <> 'P'", "")}
    SELECT order_no, cust, amount2 AS amount, order_day, line2 AS line_count, status, '' AS reason FROM g UNION ALL SELECT * FROM r"""

QUERIES = {
    "ingest_roundtrip": ingest_lake,
    "ingest_rejects": ingest_rejects,
    "ingest_audit": ingest_audit,
    "ingest_registry": ingest_registry,
    "ingest_restatement": ingest_restatement,
    "partition_replace": partition_replace,
    "grain_layout": grain_layout,
    "config_steps": config_steps,
    "query_set": query_set,
    "stream_ingest": stream_ingest,
}

ORACLE = {
    "ingest_roundtrip": INGEST_LAKE_SQL,
    "ingest_rejects": INGEST_REJECTS_SQL,
    "ingest_audit": INGEST_AUDIT_SQL,
    "ingest_registry": INGEST_REGISTRY_SQL,
    "ingest_restatement": RESTATEMENT_SQL,
    "partition_replace": PARTITION_REPLACE_SQL,
    "grain_layout": GRAIN_LAYOUT_SQL,
    "config_steps": CONFIG_STEPS_SQL,
    "query_set": QUERY_SET_SQL,
    "stream_ingest": STREAM_SQL,
}
