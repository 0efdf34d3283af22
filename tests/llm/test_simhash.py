import itertools
import re

import numpy as np
import pytest
import xxhash

from martloom.llm import queries, simhash
from tests.llm.test_operators import SF, WORD, fold, frame, near_copies


def brute_print(text, width=3):
    words = WORD.findall(fold(text))
    if not words:
        return 0
    runs = [" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    keys = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(k >> b & 1 for k in keys) > len(keys))


def brute_roots(prints, radius=3):
    nodes = np.array(sorted(set(prints)), np.uint64)
    root = {int(x): int(x) for x in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, x in enumerate(nodes):
        for y in nodes[k + 1 :][np.bitwise_count(nodes[k + 1 :] ^ x) <= radius]:
            a, b = find(int(x)), find(int(y))
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def brute(rows):
    prints = [brute_print(t) for _, t in rows]
    root = brute_roots(prints)
    least = {}
    for (doc, _), p in zip(rows, prints, strict=True):
        if doc is not None:
            least[root[p]] = min(least.get(root[p], doc), doc)
    return sorted(((doc, f"{p:016x}", least.get(root[p])) for (doc, _), p in zip(rows, prints, strict=True)), key=repr)


def families(n, size, most, seed):
    """Fingerprints in families whose members differ from a centre in a few bits."""
    rng = np.random.default_rng(seed)
    out = set()
    for _ in range(n):
        centre = int(rng.integers(0, 2**63)) * 2 + int(rng.integers(0, 2))
        for _ in range(size):
            own = centre
            for b in rng.integers(0, 64, rng.integers(0, most + 1)):
                own ^= 1 << int(b)
            out.add(own)
    return sorted(out)


def roots_of(spark, prints, **how):
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    got = simhash.similar_prints(spark.createDataFrame(signed, "print long"), **how).collect()
    return {r["node"] % (1 << 64): r["root"] % (1 << 64) for r in got}


def classes(root, prints):
    groups = {}
    for p in prints:
        groups.setdefault(root.get(p, p), set()).add(p)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("parts,cell,common", [(None, 2048, 1024), (2, 4, 1024), (3, 8, 4), (4, 6, 64), (4, 2048, 1)])
def test_no_link_is_lost(spark, monkeypatch, parts, cell, common):
    monkeypatch.setattr(simhash, "CELL", cell)
    monkeypatch.setattr(simhash, "COMMON", common)
    prints = families(40, 6, 4, 1) + families(2, 120, 5, 2) + [0, 1, 7, 15]
    prints = sorted(set(prints))
    assert classes(roots_of(spark, prints, parts=parts), prints) == classes(brute_roots(prints), prints)


def test_thresholds_keep_the_pigeonhole_sum_and_leave_common_values_out():
    rng = np.random.default_rng(4)
    prints = rng.integers(0, 2**63, 500, dtype=np.uint64) | np.uint64(0xFFFF)
    parts = tuple(tuple(range(16 * k, 16 * k + 16)) for k in range(4))
    many = tuple(np.array(v, np.uint64) for v in ([0xFFFF], [], [], []))
    layout = simhash.Layout(parts, many, tuple(np.array(c, np.int64) for c in ([90_000], [], [], [])), 100_000, 3)
    got = simhash.thresholds(prints, layout)
    assert (got.sum(axis=0) == 0).all() and (got[0] == -1).all() and (got.max(axis=0) == 1).all()


def test_correlated_bits_share_a_partition():
    rng = np.random.default_rng(1)
    own = rng.integers(0, 2, (4000, 64))
    for a, b in ((0, 40), (0, 63), (5, 33)):
        own[:, b] = own[:, a]
    joint = own.T @ own
    for number in (2, 3, 4):
        parts = simhash.correlated_parts(joint, 4000, number)
        assert sorted(b for p in parts for b in p) == list(range(64)) and max(map(len, parts)) - min(map(len, parts)) <= 1
        where = {b: k for k, p in enumerate(parts) for b in p}
        assert where[0] == where[40] == where[63] and where[5] == where[33]


def test_number_of_partitions_follows_the_input():
    assert [simhash.cheapest_number(n, 3) for n in (10, 10**5, 10**8, 10**11)] == [4, 4, 3, 2]


def test_forest_connects_the_same():
    rng = np.random.default_rng(2)
    u, v = rng.integers(-50, 50, (2, 120))
    a, b = simhash.forest(u, v)
    nodes = set(u.tolist()) | set(v.tolist())

    def parts(links):
        root = {x: x for x in nodes}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for x, y in links:
            root[find(x)] = find(y)
        return {frozenset(y for y in nodes if find(y) == find(x)) for x in nodes}

    assert parts(zip(u.tolist(), v.tolist(), strict=True)) == parts(zip(a.tolist(), b.tolist(), strict=True)) and len(a) < len(nodes)


def test_whole_table_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = queries.op11_simhash_pigeonhole(spark, SF)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(docs)


def test_odd_rows(spark):
    texts = near_copies(40, 200, 6, 7) + [None, "", " \n\t", "a", "A b", "a B", "x" * 5000, "ü " * 40, "1 2 3", "1 2  3"]
    rows = [(k + 5, t) for k, t in enumerate(texts)] + [(5, texts[0]), (None, texts[1]), (None, "nowhere else seen"), (9000, " ".join(f"w{k % 97}" for k in range(90_000)))]
    got = simhash.simhash_components(frame(spark, rows)).collect()
    have = sorted(((r["id"], f"{r['print'] % (1 << 64):016x}", r["component"]) for r in got), key=repr)
    assert have == brute(rows)


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(4, "a b c d", 1, 2, 3), (3, "a b c d", 1, 2, 3)], "doc_id long, text string, print int, component int, root int")
    assert sorted((r["id"], r["component"]) for r in simhash.simhash_components(docs).collect()) == [(3, 3), (4, 3)]
    assert simhash.simhash_components(docs.limit(0)).collect() == []


def test_split_takes_the_same_words():
    for c in range(0x20):
        assert b"a%cb".replace(b"%c", bytes([c])).split() == [w.encode() for w in WORD.findall(f"a{chr(c)}b")]
    assert re.match(WORD, "\x85") and "\x85".encode().split() and "\xa0".encode().split() == ["\xa0".encode()]
    assert len(list(itertools.chain(" a".encode().split()))) == 1
