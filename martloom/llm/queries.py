"""Registered queries of the subpackage and the SQL they must agree with."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm import alignment, contamination, crf_language, crf_private, curriculum, differencing, host_rules, licences, part_enum, pu_quality, resampling, simhash, warc
from martloom.llm.frames import table

WORD = r"[^\x20\x09-\x0D]+"


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = host_rules.host_rules(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return rows.select("doc_id", *host_rules.COUNTS, "base_failed", "kept")


def op7_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    learn = _remainder(5) != 0
    field = crf_language.train(docs.where(learn))
    return crf_language.labelled(docs, field).select("doc_id", (~learn).alias("held_out"), "lang_pred", "score")


def op8_crf_private(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = crf_private.searched(table(spark, sf_dir, "documents").select("doc_id", "text"))
    count = lambda kind: F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    digest = F.sha2(crf_private.span_text("base_spans").cast("binary"), 256)
    return rows.select(
        "doc_id", *(count(k) for k in crf_private.KINDS), digest.alias("base_sha256"), crf_private.span_text("all_spans").alias("spans")
    )


def op9_part_enum_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = part_enum.similar_components(table(spark, sf_dir, "documents"))
    return rows.select(F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"))


def _remainder(parts: int):
    """crc32 of the id as text, modulo ``parts``."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(parts))


def op1_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels")
    learn = _remainder(4) != 2
    positive = labels.where(learn & (F.col("quality") == 1)).select("doc_id")
    model = pu_quality.train(docs.where(learn), positive, "doc_id", "text")
    rows = pu_quality.scored(docs, model)
    return rows.select("doc_id", (~learn).alias("held_out"), "score", "predicted")


def op2_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = curriculum.placed(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return rows.select("doc_id", "size", "source_size", "target", "taken", F.round("position", 9).alias("position"), "rank")


def op3_warc_archive(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.new_archive(spark)
    warc.write_archive(table(spark, sf_dir, "pages"), archive)
    rows = warc.read_archive(spark, archive.root, payloads=False)
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = contamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op5_licence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = licences.licensed(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return rows.select("doc_id", *(F.array_join(c, ",").alias(c) for c in ("sentences", "licenses")), "n_other")


def op10_differencing_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = differencing.sharded(table(spark, sf_dir, "documents"), columns=["doc_id"])
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op11_simhash_pigeonhole(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.simhash_components(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return rows.select(F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.token_alignment(table(spark, sf_dir, "documents"), columns=["doc_id"])


def op13_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), columns=["doc_id"])


QUERIES = {
    "op1_pu_quality": op1_pu_quality,
    "op2_curriculum_mix": op2_curriculum_mix,
    "op3_warc_archive": op3_warc_archive,
    "op4_decontaminate": op4_decontaminate,
    "op5_licence_rules": op5_licence_rules,
    "op6_host_rules": op6_host_rules,
    "op7_crf_language": op7_crf_language,
    "op8_crf_private": op8_crf_private,
    "op9_part_enum_join": op9_part_enum_join,
    "op10_differencing_shards": op10_differencing_shards,
    "op11_simhash_pigeonhole": op11_simhash_pigeonhole,
    "op12_token_alignment": op12_token_alignment,
    "op13_importance_resampling": op13_importance_resampling,
}

# The repeated words of a text: positions covered by a 5-word window found twice or more.
MEASURED_SQL = rf"""
    docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
    split AS (SELECT *, regexp_extract_all(t, '{WORD}') AS w FROM docs),
    grams AS (SELECT r, unnest(range(1, len(w) - 3)) AS p, w FROM split WHERE len(w) >= 5),
    named AS (SELECT r, p, w[p:p + 4] AS g FROM grams),
    twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, g) AS k FROM named) WHERE k > 1),
    covered AS (SELECT r, count(DISTINCT p + o) AS n FROM twice, range(5) AS s(o) GROUP BY r),
    lines AS (SELECT r, count(*) - count(DISTINCT l) AS n
              FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM docs) WHERE regexp_matches(l, '{WORD}') GROUP BY r),
    measured AS (SELECT d.r, d.doc_id, d.source, CAST(len(d.w) AS BIGINT) AS n_words,
                        CAST(length(array_to_string(d.w, '')) AS BIGINT) AS word_chars,
                        CAST(length(regexp_replace(d.t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                        coalesce(l.n, 0) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
                 FROM split d LEFT JOIN lines l USING (r) LEFT JOIN covered c USING (r)),
    ruled AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
                     100 * n_symbols > 25 * word_chars OR 100 * n_dup_lines > 30 * n_words AS more_failed FROM measured)"""

# Host rates shrunk by a beta prior fitted by moments; grades at 0.02 and 0.9.
KEPT_SQL = """
    hosts AS (SELECT source, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (base_failed OR more_failed) AS DOUBLE) AS f
              FROM ruled WHERE source IS NOT NULL GROUP BY source),
    sums AS (SELECT count(*) AS k, sum(n) AS n, sum(f) / sum(n) AS m, sum(n * n) AS n2, sum(f * f / n) AS f2 FROM hosts),
    fitted AS (SELECT m, CASE WHEN k >= 2 AND m > 0 AND m < 1 AND f2 - n * m * m > (k - 1) * m * (1 - m)
                                   AND n - n2 / n > k - 1
                              THEN greatest(1.0, m * (1 - m) * (n - n2 / n - (k - 1)) / (f2 - n * m * m - (k - 1) * m * (1 - m)) - 1)
                              ELSE 20.0 END AS s FROM sums),
    rated AS (SELECT source, (f + m * s) / (n + s) AS rate FROM hosts, fitted),
    graded AS (SELECT r.*, NOT r.base_failed AND CASE WHEN coalesce(h.rate, 0) >= 0.9 THEN FALSE
                                                      WHEN coalesce(h.rate, 0) >= 0.02 THEN NOT r.more_failed
                                                      ELSE TRUE END AS kept
               FROM ruled r LEFT JOIN rated h USING (source))"""

_COUNTS = "n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"


def shingle_sql(source: str) -> str:
    """Shingle sets and components of ``source`` (columns doc_id, text), each set by its smallest document."""
    return rf"""
    spelt AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM {source}),
    shingled AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                     ELSE list_transform(range(1, len(w) - 2), lambda p: array_to_string(w[p:p + 3], ' ')) END)) AS g FROM spelt),
    classes AS (SELECT min(doc_id) AS c, g, len(g) AS n FROM shingled WHERE len(g) > 0 GROUP BY g),
    items AS (SELECT c, n, unnest(g) AS e FROM classes),
    pairs AS (SELECT a.c AS u, b.c AS v FROM items a JOIN items b ON a.e = b.e AND a.c < b.c AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
              GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    edges AS (SELECT u, v FROM pairs UNION ALL SELECT v, u FROM pairs),
    reach AS (SELECT c AS u, c AS v FROM classes UNION SELECT r.u, e.v FROM reach r JOIN edges e ON r.v = e.u),
    rooted AS (SELECT u AS c, min(v) AS root FROM reach GROUP BY u),
    joined AS (SELECT s.doc_id, CAST(len(s.g) AS BIGINT) AS n_shingles, coalesce(r.root, s.doc_id) AS component_id
               FROM shingled s LEFT JOIN classes k ON s.g = k.g LEFT JOIN rooted r ON k.c = r.c)"""


# Targets by water filling: the level at which the sources not yet full take what is left.
MIX_SQL = rf"""
    sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size FROM documents),
    sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS s FROM sized GROUP BY source),
    ranked AS (SELECT *, [2.0, 3.0, 1.0][1 + row_number() OVER (ORDER BY source NULLS LAST) % 3]::DOUBLE AS w,
                      row_number() OVER (ORDER BY source NULLS LAST) AS k, 2.0::DOUBLE * s AS cap FROM sources),
    filled AS (SELECT *, cap / w AS fills_at,
                      (1.5::DOUBLE * sum(s) OVER () - coalesce(sum(cap) OVER e, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER e, 0)) AS level
               FROM ranked WINDOW e AS (ORDER BY cap / w, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    leveled AS (SELECT source, s, cap, w, (SELECT arg_min(level, (fills_at, k)) FROM filled WHERE fills_at >= level) AS l FROM ranked),
    aimed AS (SELECT source, s, least(cap, coalesce(l, 1e300) * w) AS target, row_number() OVER (ORDER BY source NULLS LAST) AS k FROM leveled),
    queued AS (SELECT d.*, a.s, a.target, a.k, coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY substr(md5(doc_id::VARCHAR), 1, 15), doc_id, size
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
               FROM sized d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source),
    runs AS (SELECT doc_id, k, p, CAST(least(floor(target) - s * p - before, size) AS BIGINT) AS taken,
                    least((s * p + before) / greatest(target, 1.0::DOUBLE), 1.0::DOUBLE) AS share FROM queued, (VALUES (0), (1)) AS passes(p)),
    timed AS (SELECT doc_id, p, taken, CASE (k - 1) % """ + str(len(curriculum.Mix().schedules)) + " " + " ".join(
    f"WHEN {i} THEN {curriculum.time_sql('share', schedule)}" for i, schedule in enumerate(curriculum.Mix().schedules)
) + """ END AS position FROM runs WHERE taken > 0),
    firsts AS (SELECT doc_id, sum(taken) AS taken, min(position) AS position, min(rank) AS rank
               FROM (SELECT *, row_number() OVER (ORDER BY position, p, doc_id) AS rank FROM timed) GROUP BY doc_id)"""

# Word runs, the CRC-32 of each different one bit by bit, and gains of their buckets.
RESAMPLING_SQL = r"""
    said AS (SELECT 0 AS k, doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
             UNION ALL
             SELECT 1, item_id, row_number() OVER (), regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
    runs AS (SELECT k, r, f, count(*) AS n
             FROM (SELECT k, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda p: w[p] || ' ' || w[p + 1]))) AS f FROM said) GROUP BY k, r, f),
    spelt AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM runs)),
    bits AS (SELECT f, list_transform(range(0, 4 * len(x)), lambda i:
                    (CAST('0x' || substr(x, 1 + 2 * CAST(i // 8 AS BIGINT), 2) AS BIGINT) >> CAST(i % 8 AS BIGINT)) & 1) AS b FROM spelt),
    summed AS (SELECT f, xor(list_reduce(list_concat([4294967295::BIGINT], b),
                      lambda c, z: xor(c >> 1, 3988292384 * (xor(c, z) & 1))), 4294967295::BIGINT) % 10000 AS bucket FROM bits),
    held AS (SELECT bucket, coalesce(sum(n) FILTER (k = 0), 0)::DOUBLE AS s, coalesce(sum(n) FILTER (k = 1), 0)::DOUBLE AS t
             FROM runs JOIN summed USING (f) GROUP BY bucket),
    whole AS (SELECT sum(s) AS s, sum(t) AS t FROM held),
    gain AS (SELECT bucket, CAST(floor(1000 * ln((h.t + 1) * (w.s + 10000) / ((h.s + 1) * (w.t + 10000)))) AS BIGINT) AS g FROM held h, whole w),
    weighed AS (SELECT r, CAST(sum(n) AS BIGINT) AS n, CAST(sum(n * g) AS BIGINT) AS g FROM runs JOIN summed USING (f) JOIN gain USING (bucket)
                WHERE k = 0 GROUP BY r),
    scored AS (SELECT doc_id, len(w) AS words, coalesce(n, 0) AS n_features,
                      CASE WHEN n IS NULL THEN 0 ELSE (g - ((g % n) + n) % n) // n END AS weight,
                      CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) AS h
               FROM said LEFT JOIN weighed USING (r) WHERE k = 0),
    noisy AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM scored),
    placed AS (SELECT *, row_number() OVER (PARTITION BY words >= 20 ORDER BY score DESC, doc_id) AS place,
                      count(*) OVER (PARTITION BY words >= 20) AS enough FROM noisy)"""

ORACLE = {
    "op2_curriculum_mix": f"""WITH {MIX_SQL}
        SELECT doc_id, size, s AS source_size, target, CAST(coalesce(taken, 0) AS BIGINT) AS taken, round(position, 9) AS position, rank
        FROM queued LEFT JOIN firsts USING (doc_id)""",
    "op3_warc_archive": """WITH paid AS (SELECT page_id, encode(coalesce(html, '')) AS p FROM pages),
        summed AS (SELECT page_id, octet_length(p) AS n, sha1(p) AS h FROM paid),
        firsts AS (SELECT h, min(page_id) AS f FROM summed GROUP BY h)
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes,
               array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                   1 + ((CAST('0x' || substr(s.h, 1 + 5 * (k // 4), 5) AS BIGINT) >> CAST(5 * (3 - k % 4) AS INTEGER)) & 31), 1)), '') AS payload_digest,
               CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> f THEN f END AS refers_to
        FROM summed s JOIN firsts USING (h)""",
    "op5_licence_rules": f"""WITH {licences.sql('documents')} SELECT doc_id, array_to_string(sentences, ',') AS sentences,
        array_to_string(licenses, ',') AS licenses, n_other FROM scanned""",
    "op6_host_rules": f"WITH {MEASURED_SQL}, {KEPT_SQL} SELECT doc_id, {_COUNTS}, kept FROM graded",
    "op9_part_enum_join": f"WITH RECURSIVE {shingle_sql('documents')} SELECT doc_id, n_shingles, component_id FROM joined",
    "op13_importance_resampling": f"""WITH {RESAMPLING_SQL} SELECT doc_id, n_features, CAST(weight AS BIGINT) AS weight,
        CAST(score AS BIGINT) AS score, CASE WHEN words >= 20 AND place <= 25 * enough // 100 THEN place END AS rank FROM placed""",
}
