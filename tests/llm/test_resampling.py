import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import arrays, queries, resampling
from tests.llm.test_operators import SF, fold, frame

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text):
    words = WORD.findall(fold(text))
    return words, words + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]


def brute(rows, target, draw=resampling.Draw()):
    """(doc_id, n_features, weight, score, rank) of each row, in plain Python."""
    bucket = lambda f: zlib.crc32(f.encode()) % draw.buckets
    s = Counter(bucket(f) for _, t in rows for f in features(t)[1])
    t = Counter(bucket(f) for x in target for f in features(x)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + draw.buckets) / ((s[b] + 1) * (big_t + draw.buckets))))
    out = []
    for doc, text in rows:
        words, found = features(text)
        weight = sum(gain(bucket(f)) for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"{draw.seed}:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc, len(found), weight, score, len(words)])
    enough = sorted((r for r in out if r[4] >= draw.least_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    ranks = {id(r): k + 1 for k, r in enumerate(enough[: draw.percent * len(enough) // 100])}
    return [(*r[:4], ranks.get(id(r))) for r in out]


def rows_of(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=repr)


@given(st.lists(st.text(st.sampled_from("aAzZ09 .\n-é日\x7f"), max_size=40), max_size=8))
@settings(max_examples=80, deadline=None)
def test_crcs_of_a_block(texts):
    seen = []
    for block in arrays.blocks(pa.array(texts, pa.string()), 30):
        found = resampling.Features(block)
        crc = found.crcs()
        for row in range(len(found.words)):
            seen.append(sorted(crc[found.which[found.row == row]].tolist()))
    assert seen == [sorted(zlib.crc32(f.encode()) for f in features(t)[1]) for t in texts]


def test_crcs_of_long_words():
    rng = np.random.default_rng(3)
    texts = [" ".join("x" * int(n) for n in rng.integers(1, 400, 60)), "é" * 100_000 + " b", "y" * 63 + " " + "z" * 64]
    for text in texts:
        (block,) = arrays.blocks(pa.array([text]))
        found = resampling.Features(block)
        assert sorted(found.crcs()[found.which].tolist()) == sorted(zlib.crc32(f.encode()) for f in features(text)[1])


def test_whole_table_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert rows_of(queries.op13_importance_resampling(spark, SF)) == sorted(brute(docs, target), key=repr)


def test_odd_rows(spark):
    long = " ".join(f"w{k % 50}" for k in range(60_000))
    text = " ".join(f"v{k}" for k in range(30))
    rows = [(1, None), (2, ""), (3, " .\n"), (4, "one"), (5, text), (5, text), (None, text), (None, text), (6, long), (7, text.upper()), (8, "ü" * 9000)]
    rows += [(k, f"{text} {k}") for k in range(20, 40)]
    target = spark.createDataFrame([(1, text), (2, None)], "item_id long, text string")
    got = resampling.resampled(frame(spark, rows), target, columns=["doc_id"])
    want = brute(rows, [text, None], resampling.Draw())
    # rows that agree in everything share their ranks in either order
    assert rows_of(got) == sorted(want, key=repr)
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == list(range(1, 25 * 26 // 100 + 1))


def test_clashing_columns_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c", 5, 6, "x", "y")], "doc_id long, text string, weight int, id int, m string, c0 string")
    target = spark.createDataFrame([], "item_id long, text string")
    got = resampling.resampled(docs, target).collect()[0]
    assert (got["id"], got["m"], got["c0"], got["n_features"], got["rank"]) == (6, "x", "y", 5, None)
    assert resampling.resampled(docs.limit(0), target).collect() == []
    assert got["weight"] == brute([(1, "a b c")], [])[0][2]
