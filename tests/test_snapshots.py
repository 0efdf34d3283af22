"""Versioned tables and the bucketed key registry."""

import pytest
from pyspark.sql import functions as F

from martloom.operators import registry
from martloom.sinks import snapshots, writers
from martloom.sources import files


def frame(spark, *pairs):
    return spark.createDataFrame(list(pairs), "id long, part string")


def test_partitions_change_at_once_and_old_versions_stay(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    assert snapshots.read_snapshot(spark, path) is None
    snapshots.commit(spark, path, frame(spark, (1, "a"), (2, "b"), (3, None), (4, "x/y=1 [z]")), ["part"])
    snapshots.commit(spark, path, frame(spark, (10, "a"), (11, None), (12, "c")), ["part"])
    assert rows(snapshots.read_snapshot(spark, path)) == [(10, "a"), (11, None), (12, "c"), (2, "b"), (4, "x/y=1 [z]")]
    assert rows(snapshots.read_snapshot(spark, path, 1)) == [(1, "a"), (2, "b"), (3, None), (4, "x/y=1 [z]")]
    snapshots.commit(spark, path, frame(spark, (20, "a")), ["part"], "append")
    assert rows(snapshots.read_snapshot(spark, path, only=["part=a"])) == [(10, "a"), (20, "a")]
    snapshots.commit(spark, path, frame(spark, (30, "z")), ["part"], "overwrite")
    assert rows(snapshots.read_snapshot(spark, path)) == [(30, "z")]
    assert snapshots.forget(spark, path) > 0 and snapshots.versions(spark, path) == [4]
    assert rows(snapshots.read_snapshot(spark, path)) == [(30, "z")]


def test_a_run_that_stops_midway_leaves_the_old_table(spark, tmp_path, rows, monkeypatch):
    path = str(tmp_path / "t")
    snapshots.commit(spark, path, frame(spark, (1, "a"), (2, "b")), ["part"])
    broken = frame(spark, (8, "a"), (9, "b")).withColumn("id", F.expr("IF(id = 9, raise_error('stop'), id)").cast("long"))
    with pytest.raises(Exception, match="stop"):
        snapshots.commit(spark, path, broken, ["part"])
    assert rows(snapshots.read_snapshot(spark, path)) == [(1, "a"), (2, "b")]
    monkeypatch.setattr(files, "write_new", lambda *_: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):  # all files written, the manifest not
        snapshots.commit(spark, path, frame(spark, (8, "a"), (9, "b")), ["part"])
    monkeypatch.undo()
    assert rows(snapshots.read_snapshot(spark, path)) == [(1, "a"), (2, "b")]
    snapshots.commit(spark, path, frame(spark, (8, "a")), ["part"])
    assert rows(snapshots.read_snapshot(spark, path)) == [(2, "b"), (8, "a")]


def test_of_two_commits_on_one_version_one_is_refused(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    base = snapshots.commit(spark, path, frame(spark, (1, "a")), ["part"])
    snapshots.commit(spark, path, frame(spark, (2, "b")), ["part"], base=base)
    with pytest.raises(files.AlreadyThereError):
        snapshots.commit(spark, path, frame(spark, (3, "c")), ["part"], base=base)
    assert rows(snapshots.read_snapshot(spark, path)) == [(1, "a"), (2, "b")]
    assert not [n for n in files.names(spark, f"{path}/_manifests") if n.endswith(".tmp")]


def test_tables_without_partitions(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    snapshots.commit(spark, path, frame(spark, (1, "a")))
    snapshots.commit(spark, path, frame(spark, (2, "b")), mode="append")
    assert rows(snapshots.read_snapshot(spark, path)) == [(1, "a"), (2, "b")]
    snapshots.commit(spark, path, frame(spark, (3, "c")))
    assert rows(snapshots.read_snapshot(spark, path)) == [(3, "c")]


def keys(spark, stamp, *ids):
    return spark.createDataFrame([(i, f"s{i}", stamp) for i in ids], "id long, name string, PROCESS_TIMESTAMP string")


def test_a_batch_writes_only_the_buckets_it_touches(spark, tmp_path, rows):
    path = str(tmp_path / "r")
    first = registry.update_keys(spark, path, keys(spark, "100", *range(50), None), ["id"], buckets=16)
    second = registry.update_keys(spark, path, keys(spark, "200", 3, None), ["id"], buckets=16)
    changed = [p for p in second.partitions if second.partitions[p] != first.partitions.get(p)]
    assert 1 <= len(changed) <= 2 and set(second.partitions) == set(first.partitions)
    found = dict(rows(registry.read_keys(spark, path, ["id"])))
    assert found == {k: "200" if k in (3, None) else "100" for k in [*range(50), None]}


def test_deltas_are_folded_and_expired_keys_go(spark, tmp_path, rows, monkeypatch):
    monkeypatch.setattr(registry, "COMPACT", 3)
    path = str(tmp_path / "r")
    for k in range(7):
        last = registry.update_keys(spark, path, keys(spark, f"{200 + k}", 1, 10 + k), ["id"], buckets=1, expire_before=f"{197 + k}")
        assert len(next(iter(last.partitions.values()))) < 3
    assert dict(rows(registry.read_keys(spark, path, ["id"], expire_before="203"))) == {1: "206", **{10 + k: f"{200 + k}" for k in range(3, 7)}}
    assert 10 not in dict(rows(registry.read_keys(spark, path, ["id"])))


def test_a_batch_number_counts_once(spark, tmp_path, rows):
    path = str(tmp_path / "r")
    registry.update_keys(spark, path, keys(spark, "1", 1), ["id"], batch=4)
    done = registry.update_keys(spark, path, keys(spark, "2", 2), ["id"], batch=5)
    assert registry.update_keys(spark, path, keys(spark, "9", 9), ["id"], batch=5) == done
    marked = registry.mark_stored(keys(spark, "3", 1, 2, 9, None), path, ["id"], "stored", batch=5)
    assert rows(marked, "id", "stored") == [(1, True), (2, False), (9, False), (None, False)]
    marked = registry.mark_stored(keys(spark, "3", 1, 2, 9, None), path, ["id"], "stored")
    assert rows(marked, "id", "stored") == [(1, True), (2, True), (9, False), (None, False)]


def test_write_table_still_lays_out_partitions(spark, tmp_path):
    writers.write_table(frame(spark, (1, "a")), str(tmp_path / "w"), ["part"])
    assert files.matching(spark, f"{tmp_path}/w/part=*")
