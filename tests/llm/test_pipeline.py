import corpus_pipeline
from martloom.llm import queries
from tests.llm.test_operators import SF, brute_components, frame, measure, near_copies, shingles


def test_first_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = {r["doc_id"]: r for r in docs.collect()}
    kept = {r["doc_id"] for r in corpus_pipeline.quality(spark, docs, SF).collect()}
    for i, r in rows.items():
        n, chars, symbols, lines, repeated = measure(r["text"])
        base = n < 10 or 100 * repeated > 20 * n
        more = 100 * symbols > 25 * chars or 100 * lines > 30 * n
        assert (i in kept) == (not base and not more)  # every host of this table has the middle grade
    left = docs.where(docs.doc_id.isin(sorted(kept)))
    want = {i for i, (_, c) in brute_components({i: rows[i]["text"] for i in kept}).items() if i == c}
    assert {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, left, SF).collect()} == want


def test_run(spark):
    out = corpus_pipeline.run(spark, SF)
    assert out.count() > 100 and out.where("shard is null or shard not between 0 and 39").count() == 0
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "mixing", "sharding"]


def test_stages_of_an_empty_table(spark):
    docs = frame(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_every_operator_has_a_query():
    assert {q.split("_")[0] for q in queries.QUERIES} >= {f"op{n}" for n in range(1, 11)}


def test_near_duplicates_of_five_words_and_four_fifths(spark):
    """A pair at 5 words and 0.8 or more that four words and 0.85 part, and a pair below 0.8."""
    words = [f"w{k}" for k in range(100)]
    apart = lambda *at: " ".join("changed" if k in at else w for k, w in enumerate(words))
    texts = {1: apart(), 2: apart(20, 24), 5: apart(10, 50, 90).replace("w", "v"), 6: apart().replace("w", "v")}
    five = {i: shingles(t, 5) for i, t in texts.items()}
    four = {i: shingles(t, 4) for i, t in texts.items()}
    share = lambda sets, a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    assert share(five, 1, 2) >= 0.8 and share(four, 1, 2) < 0.85 and share(five, 5, 6) < 0.8
    left = corpus_pipeline.near_duplicates(spark, frame(spark, list(texts.items())), SF).collect()
    assert {r["doc_id"] for r in left} == {1, 5, 6}
    copies = near_copies(40, 60, 6, 1) + near_copies(25, 14, 3, 2) + near_copies(12, 300, 30, 3)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    texts = {r["doc_id"]: r["text"] for r in docs} | {10**6 + k: t for k, t in enumerate(copies)}
    want = {i for i, (_, c) in brute_components(texts, 5, 80).items() if i == c}
    left = corpus_pipeline.near_duplicates(spark, frame(spark, list(texts.items())), SF).collect()
    assert {r["doc_id"] for r in left} == want
