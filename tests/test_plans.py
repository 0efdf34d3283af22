"""Plans that must hold at size: primary flags, salted lookups, step graphs, period outputs."""

import pytest
from pyspark.sql import functions as F

from martloom.operators.lookups import lookup
from martloom.operators.members import flag_primary
from martloom.operators.rollup import period_rollup
from martloom.plans.calendar import build_calendar, days_spanned
from martloom.plans.outputs import write_period_outputs
from martloom.plans.pipeline import ordered_steps, run_graph, tables_read
from martloom.sources.landing import file_date, latest_by_file_date


def plan_of(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def one_file(spark):
    """Joins without broadcast and without run-time changes of partitions."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    for key, value in zip(old, ("-1", "false", "16"), strict=True):
        spark.conf.set(key, value)
    yield
    for key, value in old.items():
        spark.conf.set(key, value)


def test_primary_flags_of_a_hot_key_with_ties_and_copies(spark):
    rows = [("hot", 1, "b"), ("hot", 1, "a"), ("hot", 1, "a"), (None, 2, "z"), (None, 2, None)] + [("hot", k, "x") for k in range(2, 3000)]
    out = flag_primary(spark.createDataFrame(rows, "k string, v int, w string"), {"p": (["k"], ["v"]), "q": (["w"], ["v"])})
    assert "SortAggregate" not in plan_of(out) and out.count() == len(rows)
    assert sorted(map(tuple, out.where("p = '1'").select("k", "v", "w").collect()), key=repr) == [("hot", 1, "a"), (None, 2, None)]
    assert out.where("q = '1'").groupBy("w").count().where("count <> 1").count() == 0 and out.where("q = '1'").count() == 5


def test_primary_flags_without_other_columns(spark):
    out = flag_primary(spark.createDataFrame([(1, 5), (1, 5), (2, 7)], "k int, v int"), {"p": (["k"], ["v"])})
    assert sorted(map(tuple, out.collect())) == [(1, 5, "0"), (1, 5, "1"), (2, 7, "1")]
    assert flag_primary(out.limit(0).drop("p"), {"p": (["k"], ["v"])}).collect() == []


def test_facts_with_unknown_and_default_keys_are_spread(spark, one_file):
    key = F.when(F.col("id") % 10 < 5, F.lit(None).cast("string")).when(F.col("id") % 10 < 9, F.lit("rest")).otherwise(F.concat(F.lit("k"), F.col("id")))
    fact = spark.range(40_000).select("id", key.alias("k"))
    dim = spark.range(40_000).select(F.concat(F.lit("k"), F.col("id")).alias("code"), F.col("id").alias("v"))
    dim = dim.union(spark.createDataFrame([("rest", -1), ("rest", -2)], "code string, v long"))
    plain = lookup(fact, dim, {"code": "k"}, ["v"])
    salted = lookup(fact, dim, {"code": "k"}, ["v"], salts=256, heavy=["rest"])
    assert plain.exceptAll(salted).count() == 0 and salted.exceptAll(plain).count() == 0

    def sizes(df):
        found = df.groupBy(F.spark_partition_id().alias("p")).count().collect()
        return sorted(r["count"] for r in found)

    spread = sizes(salted)
    assert len(spread) == 16 and spread[-1] < 3 * spread[8]
    assert sizes(plain)[-1] > 3 * spread[-1]


def test_steps_run_in_the_order_of_what_they_read(spark, tmp_path, rows):
    (tmp_path / "a.csv").write_text("k,v\n1,2\n1,3\n2,5\n")
    steps = [
        ("WRITE|last", str(tmp_path / "out")), ("QUERY|last", "SELECT x.k, s, n FROM sums x JOIN counts y ON x.k = y.k"),
        ("QUERY|counts", "WITH a AS (SELECT k FROM typed) SELECT k, count(*) AS n FROM a GROUP BY k"),
        ("QUERY|sums", "SELECT k, (SELECT max(v) FROM typed) + sum(v) AS s FROM typed GROUP BY k"),
        ("QUERY|typed", "SELECT CAST(k AS INT) AS k, CAST(v AS INT) AS v FROM a"), ("READ|a", str(tmp_path / "a.csv")),
    ]
    order, often = ordered_steps(spark, steps)
    place = {key.split("|")[1]: i for i, (key, _) in enumerate(order[:-1])}
    assert place["a"] < place["typed"] < min(place["sums"], place["counts"]) <= max(place["sums"], place["counts"]) < place["last"]
    assert often["typed"] == 2 and order[-1][0] == "WRITE|last"
    tables = run_graph(spark, steps)
    assert rows(tables["last"]) == [(1, 10, 2), (2, 10, 1)]
    assert "view-typed" in plan_of(tables["last"])
    assert tables_read(spark, "SELECT 'a FROM b' AS t FROM `odd name` WHERE x IN (SELECT y FROM c)") == {"odd name", "c"}


def test_circles_and_names_made_twice_are_refused(spark):
    with pytest.raises(ValueError, match="read each other"):
        ordered_steps(spark, [("QUERY|a", "SELECT * FROM b"), ("QUERY|b", "SELECT * FROM a")])
    with pytest.raises(ValueError, match="two steps"):
        ordered_steps(spark, [("QUERY|a", "SELECT 1"), ("READ|a", "/x")])


def test_twelve_outputs_from_one_evaluation(spark, tmp_path, rows):
    days = spark.sql("SELECT explode(sequence(date'2018-01-01', date'2018-12-31', interval 1 day)) AS date")
    periods = spark.createDataFrame([("201801", "x")], "tdp_code string, n string").select(
        "tdp_code", F.to_date(F.lit("2018-01-01")).alias("tdp_start"), F.to_date(F.lit("2018-01-10")).alias("tdp_end"))
    calendar = build_calendar(days_spanned(days, "date", True).withColumn("tdp_no", F.lit(1)), periods)
    counted = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(k):
        counted.add(1)
        return k

    fact = spark.range(100).select(
        F.concat(F.lit("k"), F.col("id") % 3).alias("k"), F.col("id").cast("string").alias("line"), F.expr("date'2018-02-01' + cast(id as int)").alias("d"),
        F.lit("1.5").alias("v")).withColumn("k", seen("k"))
    types = spark.createDataFrame([("days", "1"), ("month", "2")], "timeperiod_type string, timeperiod_type_id string")
    write_period_outputs(fact, calendar, str(tmp_path), ["k"], ["v-DECIMAL(10,2)"], "d", day_keys=["line"], period_types=types, created_by="mart")
    assert counted.value == 100
    assert sorted(p.name for p in (tmp_path / "Agg").glob("timeperiod_type=*")) == sorted(
        f"timeperiod_type={g}" for g in ("MTD", "MONTH", "QTD", "QUARTER", "YTD", "YEAR", "L3M", "MAT", "TDP", "MOC", "L30D"))
    days_out = spark.read.parquet(str(tmp_path / "Days"))
    assert days_out.count() == 100 and "line" in days_out.columns and "k" not in days_out.columns
    assert rows(days_out.select("timeperiod_type_id", "created_by").distinct()) == [("1", "mart")]
    year = spark.read.parquet(str(tmp_path / "Agg")).where("timeperiod_type = 'YEAR'")
    assert rows(year.select(F.sum("v").cast("double"))) == [(150.0,)]


def test_a_single_plain_grain_shuffles_once(spark):
    days = spark.sql("SELECT explode(sequence(date'2018-01-01', date'2018-12-31', interval 1 day)) AS date")
    calendar = build_calendar(days_spanned(days, "date", True))
    fact = spark.range(1000).select((F.col("id") % 5).alias("k"), F.expr("date'2017-12-01' + cast(id % 400 as int)").alias("d"), F.col("id").alias("v"))
    out = period_rollup(fact, calendar, ["k"], {"v": "decimal(10,0)"}, "d", ["QUARTER", "QTD"])
    assert plan_of(out).split("== Initial Plan ==")[0].count("Exchange hashpartitioning(k") == 1
    found = {(r["timeperiod_type"], r["time_key"]): r["s"] for r in out.groupBy("timeperiod_type", "time_key").agg(F.sum("v").cast("long").alias("s")).collect()}
    assert found["QTD", "20180401"] == found["QUARTER", "20180401"] and sum(v for (g, _), v in found.items() if g == "QTD") == 499_500
    assert ("QTD", None) in found


def test_latest_file_wins(spark, rows):
    df = spark.createDataFrame([("a", 1, "/x_20240101.csv"), ("a", 2, "/y_20240301.csv"), ("b", 3, "/z_20231201.csv")], "k string, v int, _file string")
    assert rows(latest_by_file_date(df, ["k"])) == [("a", 2), ("b", 3)]
    assert df.select(file_date(F.col("_file"))).first()[0] == "20240101"
