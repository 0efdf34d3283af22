import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from martloom.llm import differencing, host_rules, licences, pu_quality, queries, warc
from tests.llm.test_operators import SF, frame


def softplus(z):
    return np.log1p(np.exp(z))


def risk(z, n, prior):
    """The parts of the unbiased risk with the logistic loss: positives, and negatives among the unlabelled."""
    return prior * softplus(-z[:n]).mean(), softplus(z[n:]).mean() - prior * softplus(z[:n]).mean()


@pytest.mark.parametrize("shift", [0.0, 2.5])
def test_the_gradient_is_that_of_the_non_negative_risk(monkeypatch, shift):
    rng = np.random.default_rng(1)
    kept = []
    plain = pu_quality._descend

    def descend(x, gradient, fit):
        kept.append(gradient)
        return plain(x, gradient, pu_quality.Fit(steps=1))

    monkeypatch.setattr(pu_quality, "_descend", descend)
    monkeypatch.setattr(pu_quality, "class_prior", lambda *_: 0.6)
    positive, unlabelled = rng.normal(1, 1, (30, pu_quality.FEATURES)), rng.normal(0, 1, (50, pu_quality.FEATURES))
    pu_quality.fitted(positive, unlabelled, pu_quality.Fit())
    z = rng.normal(0, 1, 80)
    z[:30] += shift
    z[30:] -= shift
    trusted, negative = risk(z, 30, 0.6)
    assert (negative < 0) == (shift > 0)
    target = (lambda y: sum(risk(y, 30, 0.6))) if negative >= 0 else (lambda y: -risk(y, 30, 0.6)[1])  # driven up again
    step = 1e-6
    numeric = np.array([(target(z + step * e) - target(z - step * e)) / (2 * step) for e in np.eye(80)])
    assert np.allclose(kept[-1](z), numeric, atol=1e-6)


@pytest.mark.parametrize("share", [0.2, 0.5, 0.8])
def test_the_class_prior_is_near_the_share_of_positives(share):
    rng = np.random.default_rng(int(10 * share))
    wide = pu_quality.FEATURES
    kind = lambda n, at: rng.normal(at, 1, (n, wide)) * 0.5
    n = 3000
    unlabelled = np.concatenate([kind(int(n * share), 0.7), kind(n - int(n * share), -0.7)])
    found = pu_quality.class_prior(kind(1500, 0.7), rng.permutation(unlabelled), pu_quality.Fit())
    assert abs(found - share) < 0.12


def test_shards_of_the_table_against_brute_force(spark):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries.op10_differencing_shards(spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    places, loads, of_text = {}, {}, {}
    for r in rows:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 16, zlib.crc32(raw), "bytes", None)
        places.setdefault(r["shard"], []).append(r["slot"])
        loads[r["shard"]] = loads.get(r["shard"], 0) + r["size"]
        assert of_text.setdefault(raw, r["shard"]) == r["shard"]
    assert sorted(places) == list(range(40)) and all(sorted(s) == list(range(len(s))) for s in places.values())
    groups = {}
    for text in docs.values():
        raw = text.encode()
        groups[raw] = groups.get(raw, 0) + len(raw) + 16
    mean, largest = sum(loads.values()) / 40, max(groups.values())
    assert max(loads.values()) <= max(mean * 1.02 + 16, largest)
    assert min(loads.values()) >= mean - largest


@pytest.mark.parametrize("bins", [8, 1 << 14])
def test_both_sides_of_the_bins_keep_groups_and_balance(spark, monkeypatch, bins):
    monkeypatch.setattr(differencing, "BINS", bins)
    rng = np.random.default_rng(3)
    texts = ["x" * int(n) + f"#{k % 150}" for k, n in enumerate(rng.integers(10, 400, 150).tolist() * 2)]
    out = differencing.sharded(frame(spark, list(enumerate(texts))), shards=4).collect()
    of = {}
    for r in out:
        assert of.setdefault(r["text"], r["shard"]) == r["shard"]
    loads = [sum(r["size"] for r in out if r["shard"] == s) for s in range(4)]
    assert sum(loads) == sum(len(t) + 16 for t in texts) and (bins < 150 or max(loads) - min(loads) < 900)


def test_the_manifest_lies_in_the_archive_and_comes_last(spark, tmp_path):
    rows = [(1, "u", "<p>a"), (1, "u", "<p>b"), (2, "v", "<p>a"), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    names = []
    for run in "ab":
        archive = warc.Archive(f"file://{tmp_path}/{run}")
        stored = warc.write_archive(pages.repartition(3), archive)
        assert (tmp_path / run / "_manifest").is_dir() and not list((tmp_path / run).glob("*.tmp"))
        again = spark.read.schema(warc.MANIFEST).json(f"{archive.root}/_manifest")
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, stored.collect()))
        names.append(sorted((r["name"], r["sha256"]) for r in stored.collect()))
        assert warc.read_archive(spark, archive.root).count() == 4
    assert names[0] == names[1]  # rows equal in id and url have an order of their own


def test_helper_names_as_input_columns(spark):
    text = "one two three " * 5
    docs = spark.createDataFrame([(1, text, "h", 4, 5)], "doc_id long, text string, source string, _m int, _form int")
    row = host_rules.host_rules(docs).collect()[0]
    assert (row["_m"], row["_form"], row["n_words"]) == (4, 5, 15)
    row = licences.licensed(docs).collect()[0]
    assert (row["_m"], row["_form"]) == (4, 5)
    assert licences.licensed(docs.limit(0)).select(F.size("licenses")).collect() == []
