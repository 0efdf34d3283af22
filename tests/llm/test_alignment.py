import hashlib
import random
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from martloom.llm import alignment, queries
from tests.llm.test_operators import SF, frame

ODD = [None, "", " ", "a", "  two  blanks ", "tab\tand\nline\r\n", "<|endoftext|> said <s> and </s> or <unk>", "naïve Ünïcode 日本語 😀🏽", "▁ own mark",
       "ﬁ ligature ｆｕｌｌ", "a\u0000b", "1234567890" * 30, "x" * 3000, "́ combining é", "don't we'll", "   lead and trail   "]


def ids(text):
    pair = alignment.loaded()
    a = pair.first.encode(" " + text, add_special_tokens=False).ids
    b = pair.second.encode(text)
    raw = (" " + text).encode()
    if not text or b"".join(pair.bytes_a[k] for k in a) != raw or b"".join(pair.bytes_b[k] for k in b) != raw:
        return [], []
    return a, b


def brute_groups(text):
    """Groups as (ids of A, ids of B), from the sets of end offsets."""
    pair = alignment.loaded()
    a, b = ids(text or "")
    ends = [[sum(len(t[k]) for k in side[: n + 1]) for n in range(len(side))] for side, t in ((a, pair.bytes_a), (b, pair.bytes_b))]
    both = sorted(set(ends[0]) & set(ends[1]))
    out = []
    low = 0
    for high in both:
        out.append(tuple(tuple(k for k, e in zip(side, end, strict=True) if low < e <= high) for side, end in zip((a, b), ends, strict=True)))
        low = high
    return out


def brute(rows):
    found = [(doc, brute_groups(t)) for doc, t in rows]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for _, groups in found]
    count = Counter(pair for own in links for pair in own)
    most = Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = []
    for (doc, groups), own in zip(found, links, strict=True):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            doc, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(own.values()),
            sum(n for (x, y), n in own.items() if count[x, y] == most[x]), sum(n * count[p] for p, n in own.items()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=repr)


def collected(df):
    return sorted((tuple(r) for r in df.select("doc_id", *alignment.MADE).collect()), key=repr)


@given(st.data())
@settings(max_examples=200, deadline=None)
def test_groups_are_the_common_ends(data):
    total = data.draw(st.integers(0, 60))
    inner = st.sets(st.integers(1, max(1, total - 1)))
    a, b = ([*sorted(x for x in data.draw(inner) if x < total), total] if total else [] for _ in range(2))
    upto_a, upto_b = alignment.groups(a, b)
    assert [a[k - 1] for k in upto_a] == [b[k - 1] for k in upto_b] == sorted(set(a) & set(b))


def test_long_one_to_one_stretches():
    a = list(range(1, 5000))
    b = [x for x in a if x not in (700, 701, 3000)]
    upto_a, upto_b = alignment.groups(a, b)
    assert [a[k - 1] for k in upto_a] == b and upto_b == list(range(1, len(b) + 1))


@given(st.lists(st.text(st.sampled_from("ab AZ.\n'日é 1"), max_size=60), max_size=5))
@settings(max_examples=60, deadline=None)
def test_groups_of_texts(texts):
    found = alignment.Aligned(alignment.loaded(), texts)
    want = [brute_groups(t) for t in texts]
    assert found.n_groups.tolist() == [len(w) for w in want]
    assert found.in_a.tolist() == [len(a) for w in want for a, _ in w] and found.in_b.tolist() == [len(b) for w in want for _, b in w]


def test_pieces_encode_like_the_whole(monkeypatch):
    rng = random.Random(5)
    pair = alignment.loaded()
    words = ["the", "a", "Über", "naïve", "42", "it's", "日本", "x\n", "end.", "", "ZZ", "I", "(see", "'s", "--", "\u00a0", "a\u0301", "\u0301b", "<s>", "\t", "3,400", "#"]
    for _ in range(400):
        text = " ".join(rng.choice(words) for _ in range(rng.randint(1, 60)))
        found = alignment.Aligned(pair, [text])
        assert [found.ids_a.tolist(), found.ids_b.tolist()] == [list(x) for x in ids(text)]
    assert pair.cuts and len(pair.pieces("some words, more words. and ever more of them")) == 9
    monkeypatch.setattr(alignment, "REMEMBERED", 10)
    pair.looked_up(["one two three"])
    assert len(pair.known) == 3


def test_large_groups_count_like_small_ones(monkeypatch):
    text = "日本語 " * 40 + "1234567" * 9
    found = alignment.Aligned(alignment.loaded(), [text, None or "", text[:50]])
    want = [x.tolist() for x in found.pairs()]
    monkeypatch.setattr(alignment, "WIDE", 0)
    assert [x.tolist() for x in found.pairs()] == want


def test_words_with_any_letters_are_pieces_of_their_own():
    pair = alignment.loaded()
    words = ["der", "ähnliche", "Éclat", "é", "ñandú,", "日本", "слово", "£5", "ende"]
    assert pair.cuts and pair.pieces(" ".join(words)) == words
    for blank in "\u00a0\u3000\u200b\u180e\ufeff\u0085\x1c\x00\t":
        assert pair.pieces(f"a {blank} b {blank}c") == [f"a {blank} b {blank}c"]


def test_blanks_beside_odd_characters():
    rng = random.Random(6)
    pair = alignment.loaded()
    odd = [*"é日ßЖ😀\u0301\u200d\u00a0\u00ad\u2007\u2028\u3000\u200b\u180e\ufeff\ufffd\u0085\x1c\x7f", "a", "'s", "1", "½", ".", "\n", "\t", "", "ñandú"]
    for _ in range(600):
        text = " ".join(rng.choice(odd) + rng.choice(odd) for _ in range(rng.randint(1, 30)))
        found = alignment.Aligned(pair, [text])
        assert [found.ids_a.tolist(), found.ids_b.tolist()] == [list(x) for x in ids(text)]


def test_pieces_that_come_up_again_are_not_encoded_again(monkeypatch):
    pair, asked = alignment.loaded(), []
    pair.forget()
    encode = pair.encode
    monkeypatch.setattr(alignment, "REMEMBERED", 40)
    monkeypatch.setattr(pair, "encode", lambda texts: [asked.extend(t.split(" ") for t in texts), encode(texts)][1])
    common = "the Über naïve words éclat"
    for k in range(30):
        text = f"{common} one{k} zwei{k} trois{k}ß"
        found = alignment.Aligned(pair, [text, common])
        assert [found.ids_a.tolist(), found.ids_b.tolist()] == [[*x, *y] for x, y in zip(ids(text), ids(common), strict=True)]
        assert found.digests() == [hashlib.sha256(said(t)).hexdigest() for t in (text, common)]
        assert len(pair.known) <= 48
    words = Counter(w for some in asked for w in some)
    assert all(words[w] == 1 for w in common.split(" "))
    monkeypatch.setattr(alignment, "LINKED", 0)
    pair.looked_up(["one two"])
    assert len(pair.known) == 2


def said(text):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in brute_groups(text)).encode()


@pytest.mark.parametrize("joined", [1, 20, 1 << 12])
def test_pieces_that_do_not_come_back_spoil_only_their_texts(monkeypatch, joined):
    pair = alignment.loaded()
    pair.forget()
    monkeypatch.setattr(alignment, "JOINED", joined)
    texts = ["some words before", "a broken▁ one here", "▁", "", "größere Wörter danach", "a one here", "x" * 50 + " y"]
    found = alignment.Aligned(pair, texts)
    assert found.n_a.tolist() == [len(ids(t)[0]) for t in texts] and found.n_b.tolist() == [len(ids(t)[1]) for t in texts]
    assert found.n_a[[1, 2, 3]].tolist() == [0, 0, 0] and found.n_a[[0, 4, 5, 6]].all()
    assert found.digests() == [hashlib.sha256(said(t)).hexdigest() if k not in (1, 2, 3) else "" for k, t in enumerate(texts)]


def test_large_groups_of_pieces_that_are_learnt_anew(monkeypatch):
    pair = alignment.loaded()
    text = "日本語 " * 40 + "1234567" * 9
    want = [x.tolist() for x in alignment.Aligned(pair, [text, text[:50]]).pairs()]
    pair.forget()
    monkeypatch.setattr(alignment, "WIDE", 0)
    assert [x.tolist() for x in alignment.Aligned(pair, [text, text[:50]]).pairs()] == want


@pytest.mark.parametrize("hot", [1 << 20, 40, 0])
def test_odd_rows(spark, hot):
    rows = list(enumerate(ODD)) + [(3, "a"), (None, "naïve Ünïcode"), (None, None), (50, "the same words " * 9), (51, "the same words " * 9)]
    assert collected(alignment.token_alignment(frame(spark, rows), hot=hot)) == brute(rows)


def test_long_texts(spark):
    prose = " ".join(f"word{k % 613} {'ab'[k % 2] * (k % 9)}," for k in range(40_000))
    rows = [(1, prose), (2, "z" * 200_000), (3, "9 " * 50_000)]
    got = {r["doc_id"]: r for r in alignment.token_alignment(frame(spark, rows)).collect()}
    for doc, text in rows:
        a, b = ids(text)
        assert (got[doc]["n_a"], got[doc]["n_b"]) == (len(a), len(b)) and len(a)
        assert 0 < got[doc]["n_groups"] <= min(len(a), len(b))


def test_whole_table_against_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    short = [(d, t) for d, t in docs if len(t or "") < 4000]  # the brute force is quadratic in a text
    got = alignment.token_alignment(spark.createDataFrame(short, "doc_id long, text string"))
    assert collected(got) == brute(short)
    whole = queries.op12_token_alignment(spark, SF)
    numbers = {r["doc_id"]: (r["n_a"], r["n_b"], r["n_groups"], r["groups_sha256"]) for r in whole.collect()}
    assert numbers == {d: (len(ids(t)[0]), len(ids(t)[1]), n, s) for d, t in docs for n, s in [numbers[d][2:]]}


def test_groups_as_rows(spark):
    text = "Alignment of naïve tokens, 日本."
    row = alignment.alignments(frame(spark, [(1, text)])).collect()[0]["aligned"]
    a, b, out = iter(row["ids_a"]), iter(row["ids_b"]), []
    for x, y in zip(row["in_a"], row["in_b"], strict=True):
        out.append((tuple(next(a) for _ in range(x)), tuple(next(b) for _ in range(y))))
    assert out == brute_groups(text)


def test_clashing_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a b", 1, 2, 3, "x")], "doc_id long, text string, n_a int, at int, t int, aligned string")
    row = alignment.token_alignment(docs).collect()[0]
    assert (row["at"], row["t"], row["aligned"], row["n_a"]) == (2, 3, "x", len(ids("a b")[0]))
    assert alignment.token_alignment(docs.limit(0)).collect() == []


def test_bytes_of_tokens():
    pair = alignment.loaded()
    assert pair.bytes_a[pair.first.token_to_id("Ġthe")] == b" the" and len(pair.bytes_a) == 50257
    assert pair.bytes_b[3] == b"\x00" and sum(map(len, pair.bytes_b[3:259])) == 256
    assert pa.array([1]).type == pa.int64()
