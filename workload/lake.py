"""Queries on the lake side: stored keys, restatements, file formats, mappings, step graphs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.functions.dates import today_key
from martloom.operators.registry import read_keys, update_keys
from martloom.operators.rollup import stamp
from martloom.plans.calendar import build_calendar, days_from_text, deliver_calendar, trading_periods_from_text
from martloom.plans.ingest import IngestConfig, ingest
from martloom.plans.outputs import write_period_outputs
from martloom.plans.pipeline import run_graph
from martloom.sinks.snapshots import commit, read_snapshot
from martloom.sinks.writers import replace_partitions, with_date_partitions, write_table
from martloom.sources import files
from martloom.sources.landing import (
    FILE,
    file_date,
    latest_by_file_date,
    list_files,
    order_by_file_date,
    read_delimited,
    read_landing,
)
from martloom.streaming.landing import read_landing_stream, run_batches
from workload.common import cal_sql, calendar, rounded, table
from workload.facts import DUCK, SPARK, render
from workload.flows import _fresh, _land
from workload.rollups import _STATUS_PARTS, DIM_CALENDAR_SQL


def _land_named(df: DataFrame, root: str, folder: str, stem: str) -> None:
    """Write ``df`` as delimited files ``<stem>-<number>.csv`` in ``folder``."""
    spark = df.sparkSession
    _land(df, f"{root}/written", stem)
    for i, path in enumerate(files.matching(spark, f"{root}/written/{stem}/part-*")):
        files.move(spark, path, f"{folder}/{stem}-{i:05d}.csv")


def _settings(root: str, columns: Sequence[str], **extra: str) -> dict[str, str]:
    return {
        "processClass": "Transaction", "LandingPath": f"{root}/landing", "UDLpath": f"{root}/lake", "ErrorPath": f"{root}/errors",
        "schema": ",".join(columns), "header": "true", "delimiter": ",", "mode": "append", **extra,
    }


# --- stream against stored keys -------------------------------------------------------

_KEYED = {
    "order_no": "CAST(o_orderkey AS {text})",
    "cust": "CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE concat('C', o_custkey) END",
    "band": "concat('b', o_orderkey % 7)",
    "delivery": "CAST(o_orderkey % 3 AS {text})",
}
KEYS_REASON = "Duplicate record found for combination : cust,band"


def stream_stored_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three deliveries as three runs of a stream; keys of earlier runs are duplicates."""
    root = _fresh(spark, "stored-keys")
    rows = table(spark, sf_dir, "orders").selectExpr(*render(_KEYED, SPARK))
    config = IngestConfig.from_map(
        _settings(root, list(_KEYED), checkDuplicates="true", duplicateRow="cust,band", rejectDuplicateData="true", storedKeys="true", keyBuckets="16"), "Orders"
    )
    for k in range(3):
        _land(rows.where(F.col("delivery") == str(k)), f"{root}/landing", f"drop{k}")
        stream = read_landing_stream(spark, f"{root}/landing/*", config)
        run_batches(stream, config, f"{root}/progress").awaitTermination()
    good = spark.read.parquet(f"{root}/lake").select(*_KEYED, F.lit("").alias("reason"))
    bad = spark.read.parquet(f"{root}/errors/records").select(*_KEYED, F.col("Rejection_Reason").alias("reason"))
    return good.unionByName(bad)


STREAM_STORED_SQL = f"""WITH d AS (SELECT {', '.join(render(_KEYED, DUCK))} FROM orders),
    c AS (SELECT *, count(*) OVER (PARTITION BY cust, band, delivery) AS n, min(delivery) OVER (PARTITION BY cust, band) AS first FROM d)
    SELECT order_no, cust, band, delivery, CASE WHEN n > 1 OR first < delivery THEN '{KEYS_REASON}' ELSE '' END AS reason FROM c"""


def registry_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Last event of each user and type, folded in over nine batches."""
    path = f"{_fresh(spark, 'registry')}/users"
    events = table(spark, sf_dir, "events").withColumn("PROCESS_TIMESTAMP", F.date_format("ts", "yyyyMMddHHmmss"))
    for k in range(9):
        update_keys(spark, path, events.where(F.col("event_id") % 9 == k), ["user_id", "event_type"], buckets=8, batch=k)
    return read_keys(spark, path, ["user_id", "event_type"]).withColumnRenamed("PROCESS_TIMESTAMP", "last_seen")


REGISTRY_SQL = """SELECT user_id, event_type, max(strftime(ts, '%Y%m%d%H%M%S')) AS last_seen FROM events GROUP BY ALL"""


# --- restatement and layouts -----------------------------------------------------------


def restate_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year of months restated in one commit, then a month added to; all versions by manifest."""
    path = f"{_fresh(spark, 'snapshot')}/orders"
    orders = with_date_partitions(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_orderstatus"), "o_orderdate")
    orders = orders.drop("num_date", "o_orderdate")
    parts = ["num_years", "num_month"]
    commit(spark, path, orders, parts)
    open_ = orders.where("num_years = '1999' AND o_orderstatus = 'O'")
    commit(spark, path, open_.withColumn("o_orderstatus", F.lit("R")), parts)
    more = orders.where("num_years = '2000' AND num_month = '03' AND o_orderstatus = 'F'")
    commit(spark, path, more.withColumn("o_orderstatus", F.lit("A")), parts, "append")
    old = read_snapshot(spark, path, 1).groupBy(F.lit(None).cast("bigint").alias("o_orderkey"), "o_orderstatus", "num_years").agg(
        F.lit(None).cast("string").alias("num_month"), F.count("*").alias("n")
    )
    return read_snapshot(spark, path).withColumn("n", F.lit(1).cast("bigint")).unionByName(old)


RESTATE_SQL = """WITH o AS (SELECT o_orderkey, o_orderstatus, strftime(o_orderdate, '%Y') AS num_years, strftime(o_orderdate, '%m') AS num_month FROM orders),
    restated AS (SELECT DISTINCT num_month FROM o WHERE num_years = '1999' AND o_orderstatus = 'O')
    SELECT *, 1 AS n FROM o WHERE num_years <> '1999' OR num_month NOT IN (SELECT num_month FROM restated)
    UNION ALL SELECT * REPLACE ('R' AS o_orderstatus), 1 FROM o WHERE num_years = '1999' AND o_orderstatus = 'O'
    UNION ALL SELECT * REPLACE ('A' AS o_orderstatus), 1 FROM o WHERE num_years = '2000' AND num_month = '03' AND o_orderstatus = 'F'
    UNION ALL SELECT NULL, o_orderstatus, num_years, NULL, count(*) FROM o GROUP BY o_orderstatus, num_years"""

_DATED = {
    "order_no": "CAST(o_orderkey AS {text})",
    "day": "{day}",
    "kind": "o_orderstatus",
}


def ingest_dated_restatement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dated plain files, a dated restatement between them and an undated one after all of them."""
    root = _fresh(spark, "dated")
    rows = table(spark, sf_dir, "orders").selectExpr(*render(_DATED, SPARK))
    year = F.substring("day", 1, 4)
    for stem, part in (
        ("orders_20240101", rows.where(year < "1998")),
        ("orders_RESTATEMENT_20240201", rows.where((year == "1996") & (F.col("kind") == "F")).withColumn("kind", F.lit("r1"))),
        ("orders_20240301", rows.where((year >= "1998") | ((year == "1996") & (F.col("kind") == "P")))),
        ("orders_RESTATEMENT_year", rows.where((year == "1999") & (F.col("kind") == "O")).withColumn("kind", F.lit("r2"))),
    ):
        _land_named(part, root, f"{root}/landing", stem)
    settings = _settings(root, list(_DATED), SplitDateColumn="yyyy#day#yyyyMMdd#yyyy", LandingFileName="orders", versioned="true")
    ingest(spark, IngestConfig.from_map(settings, "Orders"), "20240101")
    return read_snapshot(spark, f"{root}/lake").select(*_DATED, F.col("yyyy").cast("string").alias("yyyy"))


DATED_SQL = f"""WITH d AS (SELECT {', '.join(render(_DATED, DUCK))}, strftime(o_orderdate, '%Y') AS yyyy FROM orders),
    plain AS (SELECT * FROM d WHERE yyyy < '1998' AND yyyy <> '1996' UNION ALL
              SELECT * REPLACE ('r1' AS kind) FROM d WHERE yyyy = '1996' AND kind = 'F' UNION ALL
              SELECT * FROM d WHERE yyyy >= '1998' OR (yyyy = '1996' AND kind = 'P'))
    SELECT * FROM plain WHERE yyyy <> '1999' UNION ALL SELECT * REPLACE ('r2' AS kind) FROM d WHERE yyyy = '1999' AND kind = 'O'"""


def date_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year, month and day folders; the last ten days are rewritten."""
    path = _fresh(spark, "dates")
    events = with_date_partitions(table(spark, sf_dir, "events").select("event_id", "event_type", "ts"), "ts").drop("ts")
    parts = ["num_years", "num_month", "num_date"]
    write_table(events, path, parts)
    replace_partitions(events.where("num_date > '20' AND event_id % 2 = 0").withColumn("event_type", F.lit("again")), path, parts)
    back = spark.read.option("recursiveFileLookup", False).parquet(path)
    two = {c: F.lpad(F.col(c).cast("string"), 2, "0") for c in parts[1:]}
    return back.withColumns({"num_years": F.col("num_years").cast("string"), **two}).select("event_id", "event_type", *parts)


DATE_LAYOUT_SQL = """SELECT event_id, CASE WHEN day(ts) > 20 THEN 'again' ELSE event_type END AS event_type,
    strftime(ts, '%Y') AS num_years, strftime(ts, '%m') AS num_month, strftime(ts, '%d') AS num_date
    FROM events WHERE day(ts) <= 20 OR event_id % 2 = 0"""


def write_layouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A single file and a fixed number of write tasks, counted after reading back."""
    root = _fresh(spark, "layouts")
    write_table(table(spark, sf_dir, "supplier").select("s_suppkey"), f"{root}/one", fmt="csv", single_file=True)
    write_table(table(spark, sf_dir, "orders").select("o_orderkey"), f"{root}/five", files=5)
    one, five = read_delimited(spark, f"{root}/one"), spark.read.parquet(f"{root}/five")
    out = None
    for name, df in (("single", one), ("fixed", five)):
        counted = df.select(F.col("_metadata.file_path").alias("f")).agg(
            F.lit(name).alias("layout"), F.countDistinct("f").alias("n_files"), F.count("*").alias("n_rows")
        )
        out = counted if out is None else out.unionByName(counted)
    return out


LAYOUTS_SQL = """SELECT 'single' AS layout, 1 AS n_files, count(*) AS n_rows FROM supplier
    UNION ALL SELECT 'fixed', 5, count(*) FROM orders"""


def period_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twelve outputs of one fact: days with their own keys and eleven summed grains."""
    path = _fresh(spark, "periods")
    write_period_outputs(
        table(spark, sf_dir, "orders"), calendar(spark, sf_dir, "orders"), path, ["o_orderstatus"],
        {"o_totalprice": "decimal(19,6)"}, "o_orderdate", day_keys=["o_orderkey", "o_orderpriority"],
    )
    days, summed = spark.read.parquet(f"{path}/Days"), spark.read.parquet(f"{path}/Agg")
    columns = ["o_orderkey", "o_orderpriority", "o_orderstatus", "timeperiod_type", "time_key", "o_totalprice"]
    out = days.unionByName(summed, allowMissingColumns=True)
    return rounded(out.select(*columns), "o_totalprice")


PERIOD_OUTPUTS_SQL = f"""WITH {cal_sql('orders')}, parts AS ({' UNION ALL '.join(s for g, s in _STATUS_PARTS.items() if g != 'DAYS')})
    SELECT NULL AS o_orderkey, NULL AS o_orderpriority, o_orderstatus, timeperiod_type, time_key, o_totalprice FROM parts
    UNION ALL SELECT o_orderkey, o_orderpriority, NULL, 'DAYS', strftime(o_orderdate, '%Y%m%d'),
        CAST(round(CAST(o_totalprice AS DECIMAL(19,6)), 4) AS DOUBLE) FROM orders"""


# --- readers -----------------------------------------------------------------------------

_PART = ["p_partkey", "p_brand", "p_size", "p_retailprice"]


def read_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A delimited dimension under a declared schema."""
    root = _fresh(spark, "typed")
    _land(table(spark, sf_dir, "part").select(*_PART), root, "parts")
    schema = T.StructType([
        T.StructField("key", T.LongType()), T.StructField("brand", T.StringType()), T.StructField("size", T.ShortType()),
        T.StructField("price", T.DecimalType(15, 2)),
    ])
    back = read_delimited(spark, f"{root}/parts", schema)
    sums = back.groupBy("brand").agg(F.count("key").alias("n"), F.max("size").cast("int").alias("largest"), F.sum("price").alias("price"))
    return rounded(sums, "price", scale=2)


READ_TYPED_SQL = """SELECT p_brand AS brand, count(p_partkey) AS n, max(p_size) AS largest,
    CAST(round(sum(CAST(p_retailprice AS DECIMAL(15,2))), 2) AS DOUBLE) AS price FROM part GROUP BY ALL"""


def read_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same file with types from its data; the types are part of the result."""
    root = _fresh(spark, "inferred")
    _land(table(spark, sf_dir, "part").select(*_PART), root, "parts")
    back = read_delimited(spark, f"{root}/parts", infer=True)
    kinds = F.concat_ws(",", *[F.typeof(F.col(c)) for c in _PART])
    return back.select("p_partkey", "p_size", "p_retailprice", kinds.alias("kinds"))


READ_INFERRED_SQL = "SELECT p_partkey, p_size, p_retailprice, 'int,string,int,double' AS kinds FROM part"


def latest_file_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three dated deliveries of customers; a customer's newest file counts. Also the files' order."""
    root = _fresh(spark, "filedates")
    customers = table(spark, sf_dir, "customer").selectExpr("CAST(c_custkey AS STRING) AS cust", "c_mktsegment AS segment", "c_custkey")
    for date, keep in (("20240110", 1), ("20231231", 2), ("20240301", 3)):
        part = customers.where(F.col("c_custkey") % keep == 0).selectExpr("cust", f"concat(segment, '-{date}') AS segment")
        _land_named(part, root, f"{root}/landing", f"cust_{date}")
    paths = order_by_file_date(list_files(spark, f"{root}/landing", "cust_"))
    rows = read_landing(spark, paths, ["cust", "segment"])
    dates = [p.rsplit("_", 1)[1][:8] for p in paths]
    place = {d: i + 1 for i, d in enumerate(dict.fromkeys(dates))}
    order = F.create_map(*[x for d, i in place.items() for x in (F.lit(d), F.lit(i))])
    placed = rows.withColumn("file_order", order[file_date(F.col(FILE))])
    return latest_by_file_date(placed, ["cust"])


LATEST_SQL = """SELECT CAST(c_custkey AS VARCHAR) AS cust,
    concat(c_mktsegment, CASE WHEN c_custkey % 3 = 0 THEN '-20240301' ELSE '-20240110' END) AS segment,
    CASE WHEN c_custkey % 3 = 0 THEN 3 ELSE 2 END AS file_order FROM customer"""

_NARROW = {"order_no": "CAST(o_orderkey AS {text})", "cust": "CAST(o_custkey AS {text})", "status": "o_orderstatus"}


def ingest_strict_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names of the first line must agree: files with two columns swapped are refused."""
    root = _fresh(spark, "strict")
    rows = table(spark, sf_dir, "orders").selectExpr(*render(_NARROW, SPARK))
    _land(rows.where("status <> 'P'"), f"{root}/landing", "orders_a.csv")
    _land(rows.where("status = 'P'").select("cust", "order_no", "status"), f"{root}/landing", "orders_b.csv")
    settings = _settings(root, list(_NARROW), LandingFileName="orders_*/part-", strictHeader="true")
    audit = ingest(spark, IngestConfig.from_map(settings, "Orders"), "20240101")
    return audit.groupBy(F.col("Status").alias("status"), F.col("Reason").alias("reason")).agg(F.sum("OutputRowCount").alias("rows_out"))


STRICT_SQL = """SELECT 'PROCESSED' AS status, 'NA' AS reason, count(*) AS rows_out FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT 'REJECTED', 'HEADER MISMATCH', 0"""


def ingest_ragged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records with two or four of three fields, rejected by a width check."""
    root = _fresh(spark, "ragged")
    line = "concat_ws(',', o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 <> 3 THEN o_orderstatus END, CASE WHEN o_orderkey % 10 = 4 THEN 'more' END)"
    lines = table(spark, sf_dir, "orders").selectExpr(f"{line} AS `order_no,cust,status`")
    # one column whose text has the delimiters in it
    lines.write.option("header", True).option("sep", "\x01").option("quote", "\x02").csv(f"{root}/landing/orders.csv")
    settings = _settings(root, list(_NARROW), LandingFileName="orders*/part-", checkWidth="true")
    audit = ingest(spark, IngestConfig.from_map(settings, "Orders"), "20240101")
    bad = spark.read.parquet(f"{root}/errors/records").groupBy(F.col("Rejection_Reason").alias("what")).agg(F.count("*").alias("n"))
    counts = audit.agg(*[F.sum(c).alias(c) for c in ("InputRowCount", "RejectedRowCount", "OutputRowCount")])
    counts = counts.selectExpr("stack(3, 'in', InputRowCount, 'rejected', RejectedRowCount, 'out', OutputRowCount) AS (what, n)")
    return counts.unionByName(bad).unionByName(spark.read.parquet(f"{root}/lake").selectExpr("status AS what", "1 AS n").groupBy("what").agg(F.sum("n").alias("n")))


RAGGED_SQL = """WITH o AS (SELECT *, o_orderkey % 10 IN (3, 4) AS bad FROM orders)
    SELECT 'in' AS what, count(*) AS n FROM o UNION ALL SELECT 'rejected', count(*) FROM o WHERE bad UNION ALL SELECT 'out', count(*) FROM o WHERE NOT bad
    UNION ALL SELECT 'Wrong number of fields', count(*) FROM o WHERE bad
    UNION ALL SELECT o_orderstatus, count(*) FROM o WHERE NOT bad GROUP BY o_orderstatus"""

_MAPPING = {
    "slot": "CASE WHEN s_suppkey % 3 = 0 THEN concat('G', CAST(floor(s_suppkey / 6) AS BIGINT)) ELSE concat('S', s_suppkey) END",
    "supplier": "CAST(s_suppkey AS {text})",
    "nation": "CAST(s_nationkey AS {text})",
}
MAPPING_REASON = "Duplicate record found for combination : slot"


def ingest_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``Mapping`` class: duplicates checked, first file only, no stamp, one output file."""
    root = _fresh(spark, "mapping")
    rows = table(spark, sf_dir, "supplier").selectExpr(*render(_MAPPING, SPARK))
    write_table(rows, f"{root}/written/a", fmt="csv", single_file=True)
    write_table(rows.withColumn("slot", F.concat(F.lit("later "), "slot")), f"{root}/written/b", fmt="csv", single_file=True)
    for name in "ab":
        (path,) = files.matching(spark, f"{root}/written/{name}/part-*")
        files.move(spark, path, f"{root}/landing/map_{name}.csv")
    settings = _settings(
        root, list(_MAPPING), processClass="Mapping", LandingFileName="map_", duplicateRow="slot", rejectDuplicateData="true", SingleFile="true"
    )
    ingest(spark, IngestConfig.from_map(settings, "Slots"), "20240101")
    good = spark.read.parquet(f"{root}/lake")
    assert good.columns == list(_MAPPING)
    bad = spark.read.parquet(f"{root}/errors/records").select(*_MAPPING, F.col("Rejection_Reason").alias("reason"))
    return good.withColumn("reason", F.lit("")).unionByName(bad)


MAPPING_SQL = f"""WITH m AS (SELECT {', '.join(render(_MAPPING, DUCK))} FROM supplier)
    SELECT *, CASE WHEN count(*) OVER (PARTITION BY slot) > 1 THEN '{MAPPING_REASON}' ELSE '' END AS reason FROM m"""


def calendar_from_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The calendar from a landed working-day calendar and landed trading periods, both text."""
    root = _fresh(spark, "textcalendar")
    cal = calendar(spark, sf_dir, "orders")
    days = cal.select(
        F.date_format("date", "ddMMMyyyy").alias("DATE"), F.col("tdp").alias("TDP_No"), F.col("working_days").alias("WORKING_DAYS")
    )
    periods = cal.select(
        F.concat(F.col("year"), F.lpad("tdp", 2, "0")).alias("MOC_TDP_CODE"), F.date_format("tdp_start", "yyyyMMMdd").alias("FROM_DATE"),
        F.date_format("tdp_end", "yyyyMMMdd").alias("TO_DATE"),
    ).distinct()
    _land(days, root, "days")
    _land(periods, root, "periods")
    read = days_from_text(read_delimited(spark, f"{root}/days"))
    read = read.select("date", F.col("TDP_No").cast("int").alias("tdp_no"), F.col("WORKING_DAYS").alias("working_days"))
    out = deliver_calendar(build_calendar(read, trading_periods_from_text(read_delimited(spark, f"{root}/periods"))))
    return out.toDF(*[c.strip("#").lower() for c in out.columns])


# --- step graph and stamps ------------------------------------------------------------------


def query_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps in no order: queries before what they read, a shared view, a result of two branches."""
    root = _fresh(spark, "graph")
    _land(table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_returnflag"), root, "lines")
    _land(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority"), root, "orders")
    steps = [
        ("QUERY|graph_out", "SELECT p.l_returnflag AS flag, p.prio, p.qty, t.n FROM graph_by_prio p JOIN graph_totals t ON p.l_returnflag = t.l_returnflag"),
        ("QUERY|graph_totals", "WITH k AS (SELECT l_returnflag FROM graph_joined) SELECT l_returnflag, count(*) AS n FROM k GROUP BY l_returnflag"),
        ("QUERY|graph_by_prio", "SELECT l_returnflag, o_orderpriority AS prio, sum(q) AS qty FROM graph_joined GROUP BY l_returnflag, o_orderpriority"),
        ("QUERY|graph_joined", "SELECT l_returnflag, o_orderpriority, CAST(l_quantity AS DOUBLE) AS q FROM graph_lines JOIN graph_orders ON l_orderkey = o_orderkey"),
        ("READ|graph_orders", f"{root}/orders"), ("READ|graph_lines", f"{root}/lines"),
    ]
    return run_graph(spark, steps)["graph_out"]


QUERY_GRAPH_SQL = """WITH j AS (SELECT l_returnflag, o_orderpriority, l_quantity AS q FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    t AS (SELECT l_returnflag, count(*) AS n FROM j GROUP BY ALL)
    SELECT j.l_returnflag AS flag, o_orderpriority AS prio, sum(q) AS qty, any_value(n) AS n FROM j JOIN t USING (l_returnflag) GROUP BY ALL"""


def audit_stamp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit columns with today's date on a dimension."""
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return stamp(nations, "mart", modified=True).withColumn("today", today_key())


AUDIT_STAMP_SQL = """SELECT n_nationkey, n_name, strftime(current_date, '%Y%m%d') AS created_date, 'mart' AS created_by,
    strftime(current_date, '%Y%m%d') AS modified_date, 'mart' AS modified_by, strftime(current_date, '%Y%m%d') AS today FROM nation"""

QUERIES = {
    "stream_stored_keys": stream_stored_keys,
    "registry_buckets": registry_buckets,
    "restate_snapshot": restate_snapshot,
    "ingest_dated_restatement": ingest_dated_restatement,
    "date_layout": date_layout,
    "write_layouts": write_layouts,
    "period_outputs": period_outputs,
    "read_typed": read_typed,
    "read_inferred": read_inferred,
    "latest_file_wins": latest_file_wins,
    "ingest_strict_header": ingest_strict_header,
    "ingest_ragged": ingest_ragged,
    "ingest_mapping": ingest_mapping,
    "calendar_from_text": calendar_from_text,
    "query_graph": query_graph,
    "audit_stamp": audit_stamp,
}

ORACLE = {
    "stream_stored_keys": STREAM_STORED_SQL,
    "registry_buckets": REGISTRY_SQL,
    "restate_snapshot": RESTATE_SQL,
    "ingest_dated_restatement": DATED_SQL,
    "date_layout": DATE_LAYOUT_SQL,
    "write_layouts": LAYOUTS_SQL,
    "period_outputs": PERIOD_OUTPUTS_SQL,
    "read_typed": READ_TYPED_SQL,
    "read_inferred": READ_INFERRED_SQL,
    "latest_file_wins": LATEST_SQL,
    "ingest_strict_header": STRICT_SQL,
    "ingest_ragged": RAGGED_SQL,
    "ingest_mapping": MAPPING_SQL,
    "calendar_from_text": DIM_CALENDAR_SQL,
    "query_graph": QUERY_GRAPH_SQL,
    "audit_stamp": AUDIT_STAMP_SQL,
}
