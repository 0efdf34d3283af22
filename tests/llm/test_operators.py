import base64
import collections
import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from martloom.llm import arrays, contamination, crf_language, crf_private, curriculum, differencing, host_rules, part_enum, pu_quality, warc
from martloom.llm.frames import components

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([tuple(r) + (None,) * (5 - len(r)) if schema == SCHEMA else r for r in rows], schema)


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, width=4):
    words = WORD.findall(fold(text))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute_components(texts, width=4, percent=85):
    ids = sorted(texts)
    sets = {i: shingles(texts[i], width) for i in ids}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(ids, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            u, v = find(a), find(b)
            root[max(u, v)] = min(u, v)
    return {i: (len(sets[i]), find(i)) for i in ids}


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (5, "A b"), (6, "a B"), (7, "ü " * 30), (8, "x" * 5000), (9, "1 2 3 4 5 6 7 8 9 10"), (9, "1 2 3 4 5 6 7 8 9 10")]


def near_copies(n, size, edits, seed):
    rng = np.random.default_rng(seed)
    base = [f"w{k}" for k in rng.integers(0, 10**6, size)]
    out = []
    for _ in range(n):
        own = list(base)
        for at in rng.integers(0, size, rng.integers(0, edits)):
            own[at] = f"e{rng.integers(10**9)}"
        out.append(" ".join(own))
    return out


@given(st.lists(st.text(st.sampled_from("aAbB \n\té日"), max_size=30), max_size=6))
@settings(max_examples=60, deadline=None)
def test_words_and_sets_of_a_block(texts):
    rows = []
    for block in arrays.blocks(pa.array(texts, pa.string()), 20):
        found = arrays.words(block)
        rows += [block.data[a:b].tobytes().decode() for a, b in zip(found.start, found.end, strict=True)]
        elements, size = part_enum.sets_of(block, 4)
        assert size.tolist() == [len(shingles(t)) for t in texts[block.first : block.first + len(size)]]
    assert rows == [w for t in texts for w in WORD.findall(t)]


@pytest.mark.parametrize("small,few", [(16, 4096), (3, 20), (3, 0)])
def test_part_enum_loses_no_link(spark, monkeypatch, small, few):
    monkeypatch.setattr(part_enum, "SMALL", small)
    monkeypatch.setattr(part_enum, "FEW_PAIRS", few)
    monkeypatch.setattr(part_enum, "BLOCK", 8)
    texts = near_copies(40, 60, 6, 1) + near_copies(25, 12, 3, 2) + near_copies(12, 300, 30, 3) + ["a b c d e"] * 5
    texts += near_copies(8, 1100, 60, 4) + near_copies(4, 900, 400, 5)
    rows = [(k + 100, t) for k, t in enumerate(texts)] + ODD[:8]
    got = {r["id"]: (r["n_shingles"], r["component"]) for r in part_enum.similar_components(frame(spark, rows)).collect()}
    assert got == brute_components(dict(rows))


def test_part_enum_links_through_rows_without_an_id(spark):
    words = [f"w{k}" for k in range(100)]
    copy = lambda *at: " ".join("changed" if k in at else w for k, w in enumerate(words))
    alone = [copy().replace("w", "v"), copy(50).replace("w", "v")]
    rows = [(1, copy()), (None, copy(50)), (None, copy(50)), (2, copy(50, 20)), (None, alone[0]), (None, alone[1]), (7, "x y z")]
    rows += [(None, alone[0].replace("v", "u")), (9, alone[1].replace("v", "u"))]
    want = {i: c for i, (_, c) in brute_components(dict(enumerate(t for _, t in rows))).items()}
    assert want[0] == want[1] == want[3] and len(shingles(rows[0][1]) & shingles(rows[3][1])) < 0.85 * len(shingles(rows[0][1]) | shingles(rows[3][1]))
    got = [(r["id"], r["component"]) for r in part_enum.similar_components(frame(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(1, 1), (2, 1), (None, 1), (None, 1), (None, None), (None, None), (7, 7), (None, 9), (9, 9)], key=str)


def test_part_enum_signatures_meet():
    rng = np.random.default_rng(5)
    for size in (7, 8, 13, 40, 200, 900):
        for _ in range(20):
            own = rng.integers(1, 2**63, size, dtype=np.uint64)
            far = size
            while 100 * (2 * far - size) < 85 * size or far > size:
                far -= 1 if far > size * 0.9 else 0
                if 100 * far >= 85 * (2 * size - far):
                    break
            gone = next(g for g in range(size, -1, -1) if 100 * (size - g) >= 85 * (size + g))
            other = np.concatenate([own[gone:], rng.integers(1, 2**63, gone, dtype=np.uint64)])
            elements = np.concatenate([np.sort(own), np.sort(other)])
            row, sig = part_enum.signatures(elements, np.array([size, size]), 85)
            assert set(sig[row == 0]) & set(sig[row == 1]) or set(own) == set(other)


@pytest.mark.parametrize("size", [7, 30, 100, 300, 1000, 3000])
def test_part_enum_signs_each_element_about_once(size):
    rng = np.random.default_rng(size)
    sizes = rng.integers(size, 2 * size, max(8, 20_000 // size))
    elements = rng.integers(1, 2**63, sizes.sum(), dtype=np.uint64)
    for percent in (80, 85, 90):
        row, _ = part_enum.signatures(elements, sizes, percent)
        assert len(row) < 0.8 * len(elements)


def test_part_enum_signatures_meet_at_four_fifths():
    rng = np.random.default_rng(9)
    for size in (5, 8, 9, 13, 40, 77, 200, 900, 2500):
        for common in (None, size // 2):
            for _ in range(12):
                own = rng.integers(1, 2**63, size, dtype=np.uint64)
                gone = next(g for g in range(size, -1, -1) if 100 * (size - g) >= 80 * (size + g))
                less = int(rng.integers(0, 2)) * next(g for g in range(size, -1, -1) if 100 * (size - g) >= 80 * size)
                other = own[less:] if less else np.concatenate([own[gone:], rng.integers(1, 2**63, gone, dtype=np.uint64)])
                often = np.sort(own[-common:]) if common else None
                elements = np.concatenate([np.sort(own), np.sort(other)])
                row, sig = part_enum.signatures(elements, np.array([size, len(other)]), 80, often)
                assert set(sig[row == 0]) & set(sig[row == 1]) or set(own) == set(other)


def test_part_enum_deals_common_shingles_to_one_partition(spark):
    passage = " ".join(f"p{k}" for k in range(60))
    rows = [(k, f"{passage} " + " ".join(f"w{k}x{i}" for i in range(400))) for k in range(80)]
    texts = frame(spark, rows).select("text")
    common = part_enum.common_shingles(texts, 5, 80)
    assert len(common) == 56
    met = {}
    for often in (None, common):
        blocks = [(part_enum.sets_of(b, 5)) for b in arrays.blocks(pa.array([t for _, t in rows]))]
        (elements, size), = blocks
        _, sig = part_enum.signatures(elements, size, 80, often)
        _, n = np.unique(sig, return_counts=True)
        met[often is None] = int((n * (n - 1)).sum())
    assert met[False] < met[True] / 4


def test_parities_bound_the_difference_from_below():
    rng = np.random.default_rng(5)
    for n, gone in ((3, 1), (40, 6), (900, 70), (5000, 400)):
        whole = rng.integers(0, 1 << 63, n + gone, dtype=np.uint64)
        sets = [whole[:n], whole[gone:], whole[:0]]
        odd = part_enum.parities_of(np.concatenate(sets), np.array([len(x) for x in sets]))
        apart = sum(int(x).bit_count() for x in (odd[0] ^ odd[1]).view(np.uint64))
        assert 0 < apart <= 2 * gone and (apart - 2 * gone) % 2 == 0
        assert not odd[2].any()


def test_wide_parities_bound_the_difference_from_below():
    rng = np.random.default_rng(6)
    for n, gone in ((513, 20), (900, 300), (1100, 90), (5000, 900)):
        whole = rng.integers(0, 1 << 63, n + gone, dtype=np.uint64)
        sets = [whole[:n], whole[gone:], whole[: n - gone], whole[:3]]
        wide = part_enum.wide_parities_of(np.concatenate(sets), np.array([len(x) for x in sets]))
        assert wide[3] is None and len(wide[0]) * 8 >= n
        apart = part_enum.parities_apart(wide[0], wide[1])
        assert 0.5 * gone < apart <= 2 * gone and (apart - 2 * gone) % 2 == 0
        if wide[2] is not None:
            assert part_enum.parities_apart(wide[0], wide[2]) == part_enum.parities_apart(wide[2], wide[0]) <= gone


def test_components(spark):
    edges = [(1, 2), (2, 3), (10, 11), (3, 9), (12, 11), (5, 5)]
    got = components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {(r["node"], r["root"]) for r in got} == {(2, 1), (3, 1), (9, 1), (11, 10), (12, 10)}


def measure(text):
    words = WORD.findall(text or "")
    windows = collections.Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    twice = {i + k for i in range(len(words) - 4) for k in range(5) if windows[tuple(words[i : i + 5])] > 1}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(twice))


def test_host_rules(spark):
    clean = " ".join(f"word{k}" for k in range(30))
    rows = [(k, f"{clean} {k}", "en", "good") for k in range(300)] + [(k, "no good", "en", "bad") for k in range(300, 700)]
    rows += [(700, clean, "en", "bad"), (701, clean, "en", None), (702, "a b c d e\n" * 40, "en", "good"), (703, None, "en", "good")]
    rows += [(704, clean.replace(" ", "*** "), "en", "bad")]
    got = {r["doc_id"]: r for r in host_rules.host_rules(frame(spark, rows).withColumn("KEPT", F.lit(1))).collect()}
    for i, text, *_ in rows:
        assert tuple(got[i][c] for c in host_rules.COUNTS) == measure(text)
    assert got[0]["kept"] and got[701]["kept"] and not got[700]["kept"] and not got[702]["kept"] and not got[703]["kept"]
    assert got[703]["base_failed"] and not got[700]["base_failed"] and got[701]["host_rate"] is None
    assert not host_rules.host_rules(frame(spark, [])).collect()
    mean, strength = host_rules.prior(2, 200, 100, 20000, 100.0, 20.0)
    assert mean == 0.5 and strength == 1.0


def smith_waterman(a, b):
    best, above = 0, [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, above[j - 1] + (2 if x == y else -1), above[j] - 1, row[-1] - 1))
        best, above = max(best, max(row)), row
    return best


def leak_words(text):
    return re.findall(r"(?:[a-z0-9]|[^\x00-\x7f])+", fold(text))


def test_decontamination_against_brute_force(spark):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    tests = {r["item_id"]: leak_words(r["text"]) for r in items.collect()}
    edited = {}
    for k, (item, words) in enumerate(sorted(tests.items())[:12]):
        own = [w if j % 7 else "changed" for j, w in enumerate(words)]
        edited[10_000 + k] = "some words before this " + " ".join(own) + " and some words after it"
    texts |= edited
    rows = frame(spark, list(texts.items()))
    got = {(r["doc_id"], r["l"]["item_id"]): r["l"]["score"] for r in contamination.contaminated(rows, items).select("doc_id", F.explode("leaks").alias("l")).collect()}
    want = {}
    for i, text in texts.items():
        words = leak_words(text)
        if len(words) < 4000:
            bag = set(words)
            for j, item in tests.items():
                if len(bag & set(item)) * 2 >= min(len(set(item)), 25):
                    score = smith_waterman(item, words)
                    if score >= 2 * min(0.5 * len(item), 25):
                        want[i, j] = round(score / (2 * len(item)), 4)
    assert {k for k in got if k[0] in edited} >= {(10_000 + k, j) for k, j in enumerate(sorted(tests)[:12])}
    assert {k: v for k, v in got.items() if len(leak_words(texts[k[0]])) < 4000} == want


def test_decontamination_recall_by_rate_of_edits():
    """Of copies that reach the threshold by arithmetic, edited at random or at every n-th word, all but a few are found."""
    rng = np.random.default_rng(11)
    rows = [(j, [f"v{x}" for x in rng.integers(0, 3000, n)]) for j, n in enumerate((40, 40, 40, 60, 25, 12) * 3)]
    items, rules = contamination.read_items([(j, " ".join(w)) for j, w in rows]), contamination.Alignment()
    texts, due = [], []
    for j, words in rows:
        for rate in (0.05, 0.1, 0.2, 0.25, 0.3, 1 / 3, 0.4):
            for how in ("change", "drop", "insert", "every"):
                own = []
                for k, w in enumerate(words):
                    hit = (k + 1) % round(1 / rate) == 0 if how == "every" else rng.random() < rate
                    own += [f"e{len(texts)}"] if hit and how in ("change", "every") else [] if hit and how == "drop" else [w, "more"] if hit and how == "insert" else [w]
                texts.append(" ".join([f"f{x}" for x in rng.integers(0, 3000, 40)] + own + [f"g{x}" for x in rng.integers(0, 3000, 40)]))
                if smith_waterman(words, leak_words(texts[-1])) >= 2 * min(rules.share * len(words), rules.enough):
                    due.append((len(texts) - 1, j, how, rate))
    found = contamination.leaks(pa.array(texts), items, rules).to_pylist()
    missed = [d for d in due if d[1] not in [leak["item_id"] for leak in found[d[0]]]]
    assert len(due) > 250 and len(missed) <= 0.01 * len(due), missed
    assert not [d for d in missed if d[2] == "every"]  # every third word included
    clean = contamination.leaks(pa.array([" ".join(f"v{x}" for x in rng.integers(0, 3000, 2000)) for _ in range(40)]), items, rules)
    assert clean.to_pylist() == [[]] * 40


def test_decontamination_of_a_test_set_in_blocks(spark, monkeypatch):
    docs, items = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "benchmark"))
    docs = docs.unionByName(docs.limit(5)).withColumn("key", F.lit(1))
    pick = lambda df: sorted((r["doc_id"], r["key"], [tuple(x) for x in r["leaks"]]) for r in df.select("doc_id", "key", F.array_sort("leaks").alias("leaks")).collect())
    whole = pick(contamination.contaminated(docs, items))
    monkeypatch.setattr(contamination, "ITEMS", 30)
    assert pick(contamination.contaminated(docs, items)) == whole and any(r[2] for r in whole)


def test_decontamination_of_passages_shared_by_many(spark):
    items = spark.read.parquet(f"{SF}/benchmark.parquet").where("text is not null")
    tests = {r["item_id"]: leak_words(r["text"]) for r in items.collect()}
    tests = {j: words for j, words in sorted(tests.items()) if len(words) >= 20}
    tests = dict(list(tests.items())[:6]) | {9001: "six words that are an item".split(), 9002: "only three words".split()}
    items = items.unionByName(spark.createDataFrame([(j, " ".join(tests[j])) for j in (9001, 9002)], items.select("item_id", "text").schema), allowMissingColumns=True)
    texts, want = {}, set()
    for k in range(120):
        for j, words in tests.items():
            short = len(words) < 20
            for own in (words if short else [w if (p + k) % 7 else f"changed{k}" for p, w in enumerate(words)], words[: -(-len(words) * 6 // 10)] if j != 9002 else words):
                want.add((len(texts), j))
                texts[len(texts)] = f"words {k} before " + " ".join(own) + f" and {k} after"
    texts[len(texts)] = "nothing " + " ".join(tests[9001][:2] + ["of", "it"] + tests[9001][3:4])
    out = contamination.contaminated(frame(spark, list(texts.items())), items).select("doc_id", F.explode("leaks").alias("l")).collect()
    assert {(r["doc_id"], r["l"]["item_id"]) for r in out} >= want and {r["doc_id"] for r in out} == {i for i, _ in want}
    for r in out[::37]:
        item = tests[r["l"]["item_id"]]
        assert r["l"]["score"] == round(smith_waterman(item, leak_words(texts[r["doc_id"]])) / (2 * len(item)), 4)


def test_decontamination_of_seeds_all_items_share(monkeypatch):
    """A phrase of all items in a long text: places come in pieces, and the bound leaves none to align."""
    rng = np.random.default_rng(3)
    items = contamination.read_items([(j, "what is the right answer " + " ".join(f"w{x}" for x in rng.integers(0, 500, 30))) for j in range(50)])
    copy = "w1 w2 what is the right answer " * 40
    texts = [copy, None, copy + " ".join(f"w{x}" for x in range(500)), "what is the right answer"]
    rules = contamination.Alignment()
    whole = contamination.leaks(pa.array(texts), items, rules)
    assert whole.to_pylist() == [[]] * 4
    monkeypatch.setattr(contamination, "PIECE", 64)
    item = items.words[7]
    sizes = [len(list(contamination._places(items, np.arange(len(items.seeds)))))]
    assert sizes[0] > 1 and contamination.leaks(pa.array(texts), items, rules) == whole and len(item) == 35


def test_decontamination_edges(spark):
    rows = frame(spark, ODD).withColumn("Leaks", F.lit(0))
    items = spark.createDataFrame([(1, None), (2, "a"), (3, "q r s t u v w x")], "item_id long, text string")
    out = contamination.contaminated(rows, items)
    assert out.columns.count("leaks") == 1 and out.where(F.size("leaks") > 0).count() == 0 and out.count() == len(ODD)
    assert contamination.contaminated(rows, items.limit(0)).where(F.size("leaks") > 0).count() == 0
    assert contamination.contaminated(rows.limit(0), items).count() == 0


def test_curriculum(spark):
    rows = [(k, "w " * (k % 17), None, f"s{k % 4}" if k % 5 else None) for k in range(400)] + [(1, "w w", None, "s1")] * 3 + [(900, None, None, "s9")]
    plan = curriculum.planned(frame(spark, rows).withColumn("TAKEN", F.lit(1)))
    got = plan.collect()
    assert len(got) == len(rows) and plan.columns.count("taken") == 1
    by = collections.defaultdict(list)
    for r in got:
        by[r["source"]].append(r)
        assert 0 <= r["taken"] <= 2 * r["size"] and sum(p["taken"] for p in r["passes"]) == r["taken"]
    total = sum(r["size"] for r in got)
    assert abs(sum(own[0]["target"] for own in by.values()) - 1.5 * total) < 1e-6 * total
    for own in by.values():
        assert sum(r["taken"] for r in own) == int(own[0]["target"])
    runs = curriculum.training_order(plan).collect()
    spots = [r["position"] for r in runs]
    assert spots == sorted(spots) and all(0 <= p <= 1 for p in spots)
    assert curriculum.training_order(curriculum.planned(frame(spark, []))).count() == 0


def test_curriculum_inverts_its_schedule(spark):
    for schedule in curriculum.Mix().schedules:
        shares = spark.range(0, 101).select((F.col("id") / 100).alias("c")).withColumn("t", curriculum.time_of(F.col("c"), schedule)).collect()
        t0, r0 = zip(*schedule, strict=True)
        grid = np.linspace(0, 1, 20001)
        rate = np.interp(grid, t0, r0)
        area = np.concatenate([[0], np.cumsum((rate[1:] + rate[:-1]) / 2)])
        for r in shares:
            assert abs(np.interp(r["t"], grid, area / area[-1]) - r["c"]) < 1e-4


def test_differencing(spark):
    two = np.bincount(differencing.difference([8, 7, 6, 5, 4], 2), [8, 7, 6, 5, 4])
    assert sorted(two) == [14, 16]  # what differencing reaches here
    loads = np.bincount(differencing.difference(list(range(1, 400)), 8), np.arange(1, 400))
    assert loads.max() - loads.min() <= 1
    rows = [(k, f"text {k} " * (k % 23)) for k in range(500)] + [(k, "copy") for k in range(500, 900)] + [(7, None), (7, None), (8, "")]
    out = differencing.sharded(frame(spark, rows).withColumn("SLOT", F.lit(1)), shards=5)
    got = out.collect()
    assert len(got) == len(rows) and out.columns.count("slot") == 1
    shards = collections.defaultdict(list)
    text_of = collections.defaultdict(set)
    for r in got:
        assert r["size"] == len((r["text"] or "").encode()) + 16
        shards[r["shard"]].append(r)
        text_of[r["text"] or ""].add(r["shard"])
    assert all(len(s) == 1 for s in text_of.values())
    assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in shards.values())
    sizes = [sum(r["size"] for r in own) for own in shards.values()]
    assert max(sizes) - min(sizes) <= 16
    assert differencing.sharded(frame(spark, [])).count() == 0


def test_warc_round_trip(spark, tmp_path):
    pages = [(5, "http://a", "same"), (3, "http://b", "same"), (9, None, "same"), (1, "u\r\nX: y", None), (2, "u", ""), (4, "u", "<p>\r\n\r\nü</p>"), (4, "u", "other")]
    pages += [(100 + k, f"http://p/{k}", f"page {k} " * 200) for k in range(60)] + [(None, "n", "same")]
    df = spark.createDataFrame([(*p, 1) for p in pages], "page_id long, url string, html string, digest int")
    names = set()
    for run in ("a", "b"):
        archive = warc.Archive(f"file://{tmp_path}/{run}", roll_bytes=2000)
        manifest = warc.write_archive(df, archive)
        files = {(r["name"], r["sha256"]) for r in manifest.collect()}
        names.add(frozenset(files))
        assert len(files) > 3 and {n for n, _ in files} == {p.name for p in (tmp_path / run).iterdir() if p.name != "_manifest"}
    assert len(names) == 1
    got = collections.Counter((r["page_id"], r["record_type"], r["refers_to"], r["payload_digest"], r["payload_bytes"]) for r in warc.read_archive(spark, archive.root, manifest).collect())
    first = {}
    for i, _, html in sorted(pages, key=lambda p: (p[0] is None, p[0])):
        first.setdefault(html or "", i)
    want = collections.Counter()
    for i, _, html in pages:
        body = (html or "").encode()
        origin = first[html or ""]
        want[i, "response" if i == origin else "revisit", None if i == origin else origin, base64.b32encode(hashlib.sha1(body).digest()).decode(), len(body)] += 1
    assert got == want
    empty = warc.Archive(f"file://{tmp_path}/c")
    assert warc.read_archive(spark, empty.root, warc.write_archive(df.limit(0), empty)).count() == 0


def _held(df, parts, at):
    return df.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts)) == at)


def _learn(df, parts, at):
    return df.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts)) != at)


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = pu_quality.train(_learn(docs, 4, 2), _learn(labels, 4, 2).where("quality = 1").select("doc_id"), "doc_id", "text")
    assert 0.75 < model.prior < 0.95
    rates = pu_quality.scored(_held(docs, 4, 2), model).join(labels, "doc_id").groupBy("quality").agg(F.avg("predicted").alias("p"))
    rates = {r["quality"]: r["p"] for r in rates.collect()}
    assert rates[1] > 0.98 and rates[0] < 0.3
    out = pu_quality.scored(frame(spark, ODD).withColumn("Score", F.lit(1)), model)
    assert out.where("score between 0 and 1").count() == len(ODD) and out.columns.count("score") == 1
    nothing = pu_quality.train(docs.limit(0), labels.limit(0).select("doc_id"), "doc_id", "text")
    assert {r["score"] for r in pu_quality.scored(frame(spark, ODD), nothing).collect()} == {0.5}


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    field = crf_language.train(_learn(docs, 5, 0))
    out = crf_language.labelled(_held(docs, 5, 0), field)
    assert out.where("lang = lang_pred").count() >= 0.97 * out.count()
    odd = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in crf_language.labelled(frame(spark, ODD), field).collect()}
    assert odd[1] == odd[2] == odd[3] == odd[9] == ("und", 0.0) and odd[4][0] in field.labels
    none = crf_language.train(frame(spark, [(1, "a b", None)]))
    assert {r["lang_pred"] for r in crf_language.labelled(frame(spark, ODD), none).collect()} == {"und"}
    pieces = {r["lang"]: r["t"] for r in docs.where("length(text) > 800").groupBy("lang").agg(F.min_by(F.substring("text", 1, 400), "doc_id").alias("t")).collect()}
    mixed = pieces["de"] + " " + pieces["es"]
    _, found, posterior = next(crf_language.label_words(pa.array([mixed]), field))
    best = posterior.argmax(axis=1)
    half = len(crf_language.arrays.words(next(arrays.blocks(pa.array([pieces["de"]]))), ~crf_language._LETTER).start)
    assert (best[:half] == field.labels.index("de")).mean() > 0.9 and (best[half:] == field.labels.index("es")).mean() > 0.9


def test_forward_backward_against_enumeration(monkeypatch):
    monkeypatch.setattr(crf_language, "SPAN", 4)
    rng, counts, k = np.random.default_rng(0), [5, 0, 1, 6], 3
    logits, step, start = rng.normal(size=(12, k)), rng.normal(size=(k, k)), rng.normal(size=k)
    got, moves = crf_language.expected(logits, np.array(counts), step, start)
    at, want, real = 0, np.zeros((12, k)), np.zeros((k, k))
    for n in counts:
        total, mine, pairs = 0.0, np.zeros((n, k)), np.zeros((k, k))
        for y in itertools.product(range(k), repeat=n) if n else ():
            w = np.exp(start[y[0]] + sum(logits[at + i, y[i]] for i in range(n)) + sum(step[a, b] for a, b in zip(y, y[1:], strict=False)))
            total += w
            for i in range(n):
                mine[i, y[i]] += w
            for a, b in zip(y, y[1:], strict=False):
                pairs[a, b] += w
        if n:
            want[at : at + n], real = mine / total, real + pairs / total
        at += n
    assert np.allclose(got, want) and np.allclose(moves, real)


def test_viterbi_against_enumeration():
    rng, k = np.random.default_rng(1), 4
    step = rng.normal(size=(k, k))
    size = np.array([1, 3, 5])
    logits = rng.normal(size=(3, 5, k))
    for r, path in enumerate(crf_private.viterbi(logits, size, step)):
        n = size[r]
        score = lambda y, r=r: step[0, y[0]] + step[y[-1], 0] + sum(logits[r, i, c] for i, c in enumerate(y)) + sum(step[a, b] for a, b in zip(y, y[1:], strict=False))
        assert tuple(path[:n]) == max(itertools.product(range(k), repeat=int(n)), key=score)


def test_private_data(spark):
    text = "Mail a.b@c-d.example.com, host 10.0.0.256 or 192.0.2.1; card 4111 1111 1111 1111 not 4111 1111 1111 1112. Call +1 (499) 555-6503!"
    rows = [(20, text), (21, "phone: (555) 010-7788 , mobile (017) 555-7713 please"), (22, "number 9807915762804490 of 1999")]
    out = {r["doc_id"]: r for r in crf_private.searched(frame(spark, rows + ODD).withColumn("All_Spans", F.lit(1))).collect()}
    base = [(s["kind"], text[s["start"] : s["end"]]) for s in out[20]["base_spans"]]
    assert base == [("email", "a.b@c-d.example.com"), ("ip", "192.0.2.1"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (499) 555-6503")]
    assert {s["kind"] for s in out[21]["all_spans"]} == {"phone"} and not out[21]["base_spans"] and not out[22]["all_spans"]
    assert all(not out[i]["all_spans"] for i in range(1, 10))
    for r in out.values():
        assert set(map(tuple, r["base_spans"])) <= set(map(tuple, r["all_spans"]))
    assert crf_private.searched(frame(spark, [])).count() == 0


def test_private_table_has_no_values_of_the_given_documents(spark):
    rows = [re.sub(r"\[\w+ ([^\]]+)\]", r"\1", r) for r in crf_private.LABELLED]
    values = {w for r in rows for w in re.findall(r"[0-9a-f]{15,}", r)} | {w for r in crf_private.LABELLED for w in re.findall(r"\[\w+ ([^\]]+)\]", r)}
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    assert len(values) > 20 and not [v for v in sorted(values) if docs.where(F.col("text").contains(v)).take(1)]


def test_private_field_on_values_outside_its_table(spark):
    """Made-up plain runs and tokens stay outside; phones and mail addresses are found."""
    rng = np.random.default_rng(11)
    runs = ["".join(map(str, rng.integers(0, 10, 16))) for _ in range(60)]
    tokens = [hashlib.sha1(f"token {k}".encode()).hexdigest() for k in range(60)]
    texts = [f"numbers {r} here" for r in runs if not crf_private.luhn(r)] + [f'token = "{t}" here' for t in tokens]
    outside = len(texts)
    texts += [f"phone: (555) 01{k}-77{k}8 , ask" for k in range(10)] + [f"write to some.one{k}@mail{k}.example.net please" for k in range(10)]
    out = {r["doc_id"]: r["all_spans"] for r in crf_private.searched(frame(spark, list(enumerate(texts)))).collect()}
    assert not [texts[i] for i in range(outside) if out[i]]
    assert not [texts[i] for i in range(outside, len(texts)) if [s["kind"] for s in out[i]] != ["phone" if i < outside + 10 else "email"]]
