"""Ingestion, writers, pipelines and streaming on small landing folders."""

import json

import pytest
from pyspark.sql import functions as F

from martloom.operators.registry import read_keys
from martloom.plans.ingest import IngestConfig, ingest
from martloom.plans.pipeline import run_pipeline, run_queries
from martloom.sinks.snapshots import read_snapshot, snapshot
from martloom.sinks.writers import replace_partitions, with_date_partitions, write_table
from martloom.sources.config import config_pairs, load_config, load_steps
from martloom.sources.landing import (
    LandingFile,
    file_date,
    header_matches,
    list_files,
    order_by_file_date,
    probe_headers,
    read_delimited,
    write_runs,
)
from martloom.streaming.landing import keys_path, read_landing_stream, run_batches, write_batch


def put(folder, name, *lines):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")


def config(root, dataset="Orders", **extra):
    settings = {
        "processClass": "Transaction", "LandingPath": "/landing", "UDLpath": "/lake", "ErrorPath": "/errors",
        "LandingFileName": "orders", "schema": "id,amount,order date", "header": "true", "delimiter": ",", "mode": "append",
        "SchemaValidationColumn": "id-INT|amount-DECIMAL(10,2)|order_date#DATE(yyyyMMdd,true)",
        "rejectInteger": "true", "rejectDecimalData": "true", "rejectDateData": "false",
        "SplitDateColumn": "YYYY#order date#yyyyMMdd#yyyy|MM#order date#yyyyMMdd#MM", **extra,
    }
    return IngestConfig.from_map(settings, dataset, str(root))


HEADER = "id,amount,order date"


def test_ingest_audit_rejects_and_layout(spark, tmp_path, rows):
    put(tmp_path / "landing", "orders_20180101.csv", HEADER, "1,5,20180512", "x,5,20180512", "2,abc,bad", "7-,1.005,20190101")
    put(tmp_path / "landing", "orders_20180102.csv", "id,amount", "1,2")
    put(tmp_path / "landing", "orders_notes.txt", "not a landing file")
    audit = ingest(spark, config(tmp_path, mappingPrimaryKey="id", mappingFilePath="/registry"), "20240101", 123)
    found = {r.InputFile.rsplit("/", 1)[-1]: r for r in audit.collect()}
    good = found["orders_20180101.csv"]
    assert (good.Status, good.Reason, good.InputRowCount, good.RejectedRowCount, good.OutputRowCount) == ("PROCESSED", "NA", 4, 2, 2)
    bad = found["orders_20180102.csv"]
    assert (bad.Status, bad.Reason, bad.InputRowCount, bad.OutputRowCount) == ("REJECTED", "HEADER MISMATCH", 0, 0)
    lake = spark.read.parquet(str(tmp_path / "lake"))
    assert rows(lake, "id", "amount", "order_date", "PROCESS_TIMESTAMP") == [
        ("-7", "1.01", "20190101", "123"), ("1", "5.00", "20180512", "123")]
    assert (tmp_path / "lake" / "YYYY=2018" / "MM=05").is_dir()
    errors = spark.read.parquet(str(tmp_path / "errors" / "records"))
    assert sorted(r.id for r in errors.collect()) == ["2", "x"]
    stored = lambda: rows(read_keys(spark, str(tmp_path / "registry" / "Orders"), ["id"]))
    assert stored() == [("-7", "123"), ("1", "123")]
    ingest(spark, config(tmp_path, mappingPrimaryKey="id", mappingFilePath="/registry"), "20240102", 456)
    assert stored() == [("-7", "456"), ("1", "456")]


def test_restatement_replaces_only_its_partitions(spark, tmp_path, rows):
    put(tmp_path / "landing", "orders_1.csv", HEADER, "1,5,20180512", "2,5,20180512", "3,5,20190101")
    put(tmp_path / "landing", "orders_2_RESTATEMENT_x.csv", HEADER, "9,9,20180531")
    ingest(spark, config(tmp_path), "20240101")
    assert rows(spark.read.parquet(str(tmp_path / "lake")), "id") == [("3",), ("9",)]


def test_parts_of_a_restatement_stay_together_and_later_ones_win(spark, tmp_path, rows):
    put(tmp_path / "landing", "orders_1.csv", HEADER, "1,5,20180512", "3,5,20190101", "4,5,20200101")
    put(tmp_path / "landing", "orders_1_RESTATEMENT_p1.csv", HEADER, "10,9,20180531", "11,9,20180502")
    put(tmp_path / "landing", "orders_1_RESTATEMENT_p2.csv", HEADER, "12,9,20180501")
    put(tmp_path / "landing", "orders_RESTATEMENT_20240201-a.csv", HEADER, "20,9,20190131")
    put(tmp_path / "landing", "orders_RESTATEMENT_20240101-a.csv", HEADER, "30,9,20190131")
    put(tmp_path / "landing", "orders_RESTATEMENT_20240201-b.csv", HEADER, "21,9,20190101")
    audit = ingest(spark, config(tmp_path), "20240101")
    assert rows(spark.read.parquet(str(tmp_path / "lake")), "id") == [("10",), ("11",), ("12",), ("20",), ("21",), ("4",)]
    assert audit.count() == 6


def test_a_marked_folder_restates(spark, tmp_path, rows):
    put(tmp_path / "landing" / "orders_1.csv", "part-0.csv", HEADER, "1,5,20180512")
    put(tmp_path / "landing" / "orders_1_RESTATEMENT.csv", "part-0.csv", HEADER, "2,5,20180512")
    put(tmp_path / "landing" / "orders_1_RESTATEMENT.csv", "part-1.csv", HEADER, "3,5,20180513")
    ingest(spark, config(tmp_path, LandingFileName="orders_*/part-"), "20240101")
    assert rows(spark.read.parquet(str(tmp_path / "lake")), "id") == [("2",), ("3",)]


def test_overwrite_takes_all_files(spark, tmp_path, rows):
    put(tmp_path / "landing", "orders_1.csv", HEADER, "1,5,20180512")
    put(tmp_path / "landing", "orders_2.csv", HEADER, "2,5,20180512")
    ingest(spark, config(tmp_path, mode="overwrite", SplitDateColumn="NA"), "20240101")
    assert rows(spark.read.parquet(str(tmp_path / "lake")), "id") == [("1",), ("2",)]


def test_any_file_name_and_no_job_per_file(spark, tmp_path, rows):
    names = ["orders 1.csv", "orders%202.csv", "orders+3.csv", "orders[4].csv", "orders\u00e9 5.csv"]
    for i, name in enumerate(names):
        put(tmp_path / "landing", name, HEADER, f"{i},5,20180512")
    audit = ingest(spark, config(tmp_path), "20240101")
    assert rows(spark.read.parquet(str(tmp_path / "lake")), "id") == [(str(i),) for i in range(5)]
    assert rows(audit, "InputRowCount", "OutputRowCount") == [(1, 1)] * 5
    assert sorted(r.InputFile.rsplit("/", 1)[-1] for r in audit.collect()) == sorted(names)
    paths = list_files(spark, str(tmp_path / "landing"), "orders")
    spark.sparkContext.setJobGroup("probe", "headers")
    found = probe_headers(spark, paths)
    assert [f.columns for f in found] == [("id", "amount", "order date")] * 5
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("probe")
    spark.sparkContext.setJobGroup("", "")


def test_mapping_class_checks_duplicates_and_takes_one_file(spark, tmp_path, rows):
    put(tmp_path / "landing", "orders_1.csv", HEADER, "1,5,20180512", "1,6,20180512", "2,5,20180512")
    put(tmp_path / "landing", "orders_2.csv", HEADER, "3,5,20180512")
    audit = ingest(spark, config(tmp_path, processClass="Mapping", duplicateRow="id", rejectDuplicateData="true"), "20240101")
    assert audit.count() == 1
    lake = spark.read.parquet(str(tmp_path / "lake"))
    assert lake.columns == ["id", "amount", "order_date"] and rows(lake, "id") == [("2",)]


def test_reference_check_in_ingest(spark, tmp_path, rows):
    put(tmp_path / "landing", "orders_1.csv", HEADER, "1,5,20180512", "2,5,20180512")
    put(tmp_path / "masters", "ids.csv", "master id,name", "2,two", "2,again")
    ingest(spark, config(tmp_path, ReferentialString="/masters/ids.csv|id-master id", RejectReferentialData="true"), "20240101")
    assert rows(spark.read.parquet(str(tmp_path / "lake")), "id") == [("2",)]


def test_empty_landing_folder(spark, tmp_path):
    put(tmp_path / "landing", "orders_readme.txt", "nothing")
    assert ingest(spark, config(tmp_path), "20240101").count() == 0


def test_headers_and_runs():
    assert header_matches(["a ", "b c"], ["x", "y"]) and not header_matches(["a"], ["a", "b"])
    assert header_matches(["a ", "b c"], ["a", "b_c"], strict=True) and not header_matches(["b_c", "a"], ["a", "b_c"], strict=True)
    files = [LandingFile(f"/l/{n}.csv", ()) for n in ("a", "b", "c_restatement_1", "d_RESTATEMENT_2", "e")]
    runs = [(mode, [f.name for f in run]) for mode, run in write_runs(files, "append")]
    assert runs == [
        ("append", ["a.csv", "b.csv", "e.csv"]), ("overwrite", ["c_restatement_1.csv"]), ("overwrite", ["d_RESTATEMENT_2.csv"])]
    files = [LandingFile(f"/l/{n}.csv", ()) for n in ("o_RESTATEMENT", "o_20240101", "o_RESTATEMENT_20240102", "o_20240103", "o_RESTATEMENT_2")]
    runs = [(mode, [f.name for f in run]) for mode, run in write_runs(files, "append")]
    assert runs == [
        ("append", ["o_20240101.csv"]), ("overwrite", ["o_RESTATEMENT_20240102.csv"]), ("append", ["o_20240103.csv"]),
        ("overwrite", ["o_RESTATEMENT.csv", "o_RESTATEMENT_2.csv"])]


def test_an_undated_restatement_comes_after_dated_files(spark, tmp_path, rows):
    put(tmp_path / "landing", "orders_20240101.csv", HEADER, "1,5,20180512", "2,5,20190512")
    put(tmp_path / "landing", "orders_RESTATEMENT.csv", HEADER, "10,9,20180531")
    ingest(spark, config(tmp_path, SplitDateColumn="YYYY#order date#yyyyMMdd#yyyy"), "20240101")
    assert rows(spark.read.parquet(str(tmp_path / "lake")), "id") == [("10",), ("2",)]


def test_numbered_restatements_of_one_name_are_one_delivery(spark, tmp_path, rows):
    put(tmp_path / "landing", "orders_1.csv", HEADER, "1,5,20180512")
    put(tmp_path / "landing", "orders_RESTATEMENT_1.csv", HEADER, "2,5,20180512")
    put(tmp_path / "landing", "orders_RESTATEMENT_2.csv", HEADER, "3,5,20180513")
    ingest(spark, config(tmp_path), "20240101")
    assert rows(spark.read.parquet(str(tmp_path / "lake")), "id") == [("2",), ("3",)]


def test_a_versioned_lake_shows_a_restatement_at_once(spark, tmp_path, rows):
    settings = config(tmp_path, versioned="true")
    put(tmp_path / "landing", "orders_1.csv", HEADER, "1,5,20180512", "2,5,20190512", "3,5,20200101")
    put(tmp_path / "landing", "orders_2_RESTATEMENT.csv", HEADER, "8,9,20180531", "9,9,20190501")
    ingest(spark, settings, "20240101")
    lake = str(tmp_path / "lake")
    assert rows(read_snapshot(spark, lake), "id") == [("3",), ("8",), ("9",)]
    assert rows(read_snapshot(spark, lake, 1), "id") == [("1",), ("2",), ("3",)]


def test_ragged_records_are_rejected_when_asked(spark, tmp_path, rows):
    put(tmp_path / "landing", "orders_1.csv", HEADER, "1,5,20180512", "2,5", "3,5,20180512,more", '4,"5",20180512')
    audit = ingest(spark, config(tmp_path, checkWidth="true"), "20240101")
    assert rows(audit, "InputRowCount", "RejectedRowCount", "OutputRowCount") == [(4, 2, 2)]
    assert rows(spark.read.parquet(str(tmp_path / "lake")), "id") == [("1",), ("4",)]
    errors = spark.read.parquet(str(tmp_path / "errors" / "records"))
    assert rows(errors, "id", "Rejection_Reason") == [("2", "Wrong number of fields"), ("3", "Wrong number of fields")]
    assert "_ragged" not in errors.columns
    ingest(spark, config(tmp_path, UDLpath="/plain", ErrorPath="/none"), "20240101")
    assert spark.read.parquet(str(tmp_path / "plain")).count() == 4


def test_a_first_line_without_an_end_is_refused(spark, tmp_path):
    put(tmp_path / "landing", "orders_1.csv", "x" * 100_000)
    with pytest.raises(ValueError, match="first line"):
        ingest(spark, config(tmp_path), "20240101")


def test_file_order(spark):
    assert order_by_file_date(["/x/a_20190101.csv", "/x/b_20180101.csv"]) == ["/x/b_20180101.csv", "/x/a_20190101.csv"]
    with pytest.raises(ValueError):
        order_by_file_date(["/x/none.csv"])
    df = spark.createDataFrame([("/x_20990101/a_20190101.csv",)], "f string")
    assert df.select(file_date(F.col("f"))).first()[0] == "20190101"


def test_readers(spark, tmp_path):
    put(tmp_path, "a.csv", "k;v", "007;1.5")
    assert read_delimited(spark, str(tmp_path / "a.csv"), delimiter=";").first()["k"] == "007"
    assert read_delimited(spark, str(tmp_path / "a.csv"), ["x", "y"], delimiter=";").columns == ["x", "y"]
    inferred = read_delimited(spark, str(tmp_path / "a.csv"), delimiter=";", infer=True)
    assert dict(inferred.dtypes) == {"k": "int", "v": "double"}
    assert list_files(spark, str(tmp_path), "a") and list_files(spark, str(tmp_path), "a")[0].endswith("a.csv")


def test_replace_partitions_and_date_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    df = spark.sql("SELECT id, date'2018-01-30' + cast(id as int) AS d FROM range(4)")
    parted = with_date_partitions(df, "d")
    write_table(parted, path, ["num_years", "num_month", "num_date"])
    replace_partitions(parted.where("id = 3").withColumn("id", F.lit(30).cast("bigint")), path, ["num_years", "num_month", "num_date"])
    assert rows(spark.read.parquet(path), "id") == [(0,), (1,), (2,), (30,)]
    write_table(df, str(tmp_path / "one"), fmt="csv", single_file=True, mode="overwrite")
    assert len(list((tmp_path / "one").glob("part-*"))) == 1
    write_table(df, str(tmp_path / "three"), files=3, mode="overwrite")
    assert len(list((tmp_path / "three").glob("part-*"))) == 3


def test_config_and_pipeline(spark, tmp_path, rows):
    put(tmp_path, "o.csv", "id,amount", "a,1", "a,2", "b,5")
    steps = [["READ|o", str(tmp_path / "o.csv")], ["QUERY|t", "SELECT id, SUM(CAST(amount AS INT)) s FROM o GROUP BY id"],
             ["WRITE|t", str(tmp_path / "out")]]
    (tmp_path / "c.json").write_text(json.dumps({"P": steps, "Q": [["k", "1"], ["k", "2"]]}))
    assert load_steps(spark, str(tmp_path / "c.json"), "P") == [tuple(s) for s in steps]
    assert load_config(spark, str(tmp_path / "c.json"), "Q") == {"k": "2"}
    assert config_pairs(spark, str(tmp_path / "c.json"), "Q").count() == 2
    run_pipeline(spark, load_steps(spark, str(tmp_path / "c.json"), "P"))
    assert rows(read_delimited(spark, str(tmp_path / "out"))) == [("a", "3"), ("b", "5")]
    tables = run_queries(spark, {"DataFiles": f"{tmp_path}/o.csv#oo", "x": "SELECT max(id) AS m FROM oo", "y": "SELECT m FROM x"})
    assert rows(tables["y"]) == [("b",)]


def test_stream_refuses_wrong_headers_and_writes_whole_audit_rows(spark, tmp_path, rows):
    settings = config(tmp_path, mappingPrimaryKey="id", mappingFilePath="/registry")
    put(tmp_path / "landing", "orders 1.csv", HEADER, "1,5,20180512", "x,5,20180512")
    put(tmp_path / "landing", "orders_2.csv", "id,amount", "2,5")
    stream = read_landing_stream(spark, str(tmp_path / "landing"), settings)
    run_batches(stream, settings, str(tmp_path / "progress")).awaitTermination()
    audit = spark.read.parquet(str(tmp_path / "errors" / "audit"))
    found = rows(audit.withColumn("f", F.element_at(F.split("InputFile", "/"), -1)), "f", "Status", "Reason", "InputRowCount", "RejectedRowCount", "OutputRowCount")
    assert found == [("orders 1.csv", "PROCESSED", "NA", 2, 1, 1), ("orders_2.csv", "REJECTED", "HEADER MISMATCH", 0, 0, 0)]
    assert audit.where("StartTime > 0 AND EndTime >= StartTime AND DataSet = 'Orders'").count() == 2
    assert rows(read_keys(spark, str(tmp_path / "registry" / "Orders"), ["id"]), "id") == [("1",)]


def test_stream_rejects_keys_of_earlier_batches(spark, tmp_path, rows):
    settings = config(tmp_path, duplicateRow="id", checkDuplicates="true", rejectDuplicateData="true", storedKeys="true", keyDays="2")
    schema = "id string, amount string, order_date string, _file string"
    batch = lambda *ids: spark.createDataFrame([(i, "1", "20180512", "f") for i in ids], schema)
    day = 86_400_000
    good = lambda: rows(spark.read.parquet(str(tmp_path / "lake")), "id", "batch_id")
    write_batch(batch("1", "2", "2", None), 0, settings, start=10 * day)
    assert good() == [("1", 0), (None, 0)]
    write_batch(batch("1", "2", "3", None), 1, settings, start=10 * day + 5)
    assert good() == [("1", 0), ("3", 1), (None, 0)]
    before = snapshot(spark, keys_path(settings))
    write_batch(batch("1", "2", "3", None), 1, settings, start=10 * day + 9)  # runs again
    assert good() == [("1", 0), ("3", 1), (None, 0)] and snapshot(spark, keys_path(settings)) == before
    write_batch(batch("1", "4"), 2, settings, start=13 * day)  # the key is out of date
    assert good() == [("1", 0), ("1", 2), ("3", 1), ("4", 2), (None, 0)]
    rejected = spark.read.parquet(str(tmp_path / "errors" / "records"))
    assert rows(rejected, "id", "batch_id") == [("1", 1), ("2", 0), ("2", 0), ("2", 1), (None, 1)]


def test_stream_and_replayed_batch(spark, tmp_path, rows):
    settings = config(tmp_path)
    put(tmp_path / "landing", "orders_1.csv", HEADER, "1,5,20180512", "x,5,20180512")
    put(tmp_path / "landing", "orders_2.csv", HEADER, "2,5,20190512")
    stream = read_landing_stream(spark, str(tmp_path / "landing"), settings, files_per_batch=1)
    run_batches(stream, settings, str(tmp_path / "progress")).awaitTermination()
    lake = str(tmp_path / "lake")
    assert rows(spark.read.parquet(lake), "id", "batch_id") in ([("1", 0), ("2", 1)], [("1", 1), ("2", 0)])
    batch = spark.createDataFrame([("5", "1", "20180512", "f")], "id string, amount string, order_date string, _file string")
    write_batch(batch, 7, settings)
    write_batch(batch, 7, settings)
    assert spark.read.parquet(lake).where("batch_id = 7").count() == 1
    assert spark.read.parquet(str(tmp_path / "errors" / "records")).count() == 1
    put(tmp_path / "landing", "orders_3.csv", HEADER, "3,5,20180512")
    run_batches(read_landing_stream(spark, str(tmp_path / "landing"), settings), settings, str(tmp_path / "progress")).awaitTermination()
    assert spark.read.parquet(lake).where("id = '3'").count() == 1
