"""Language of code-switched text by a linear-chain conditional random field.

Every word has a label. Its features are byte n-grams of two to four, those at a word's
border being its affixes, and the class of the word in a lexicon of words that belong
to one language; labels follow each other with learned transitions. Forward-backward
gives each word's label probabilities. A text's language is the one with most expected
words, its score their share.

The field is fitted on passages of labelled documents: about ``per_language`` documents
of each language, drawn by a hash of their id, one passage each; sequences are spliced
from passages of different languages so that transitions are seen.

Words are runs of letters (and whatever is not ASCII), A-Z and the accented capitals of
Latin-1 folded. Null texts and texts without a letter are ``und`` with score 0, as is
everything if no language was learned. Repeated rows are labelled each time. Input
columns named like an output are replaced.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.frames import clear, per_row

HASHED = 1 << 15
SPAN = 32  # words after which the chain is cut into blocks that run side by side
_LETTER = np.array([b >= 128 or chr(b).isalpha() for b in range(256)])
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_FOLD[~_LETTER] = 0


@dataclass(frozen=True)
class Fit:
    per_language: int = 400  # documents, one passage each
    passage: int = 60  # words
    sequence: int = 40
    sequences: int = 1500
    steps: int = 40
    rate: float = 0.1
    decay: float = 1e-4
    lexicon: int = 2000  # words of each language at most
    seed: int = 11


@dataclass(frozen=True)
class Field:
    labels: list[str]
    gram: np.ndarray  # HASHED x labels
    lexicon: np.ndarray  # sorted word keys
    member: np.ndarray  # their language
    word: np.ndarray  # languages + 1 x labels, the last for words in no lexicon
    step: np.ndarray  # labels x labels
    start: np.ndarray


def _spelling(block: arrays.Block) -> tuple[arrays.Block, arrays.Words]:
    """Folded letters of a block, a border byte before, between and after its rows."""
    rows = len(block.at) - 1
    row = np.repeat(np.arange(rows), np.diff(block.at))
    data = np.zeros(len(block.data) + rows + 1, np.uint8)
    spelt = _FOLD[block.data]
    accent = np.zeros(len(spelt), bool)
    accent[1:] = (spelt[:-1] == 0xC3) & (spelt[1:] >= 0x80) & (spelt[1:] <= 0x9E)
    spelt[accent] += 32
    data[np.arange(len(spelt)) + row + 1] = spelt
    at = block.at + np.arange(rows + 1)
    own = arrays.Block(block.first, data[1:], at)
    return arrays.Block(block.first, data, at), arrays.words(own, ~_LETTER)


def _grams(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers, three for each letter, and the first letter of each word.

    ``data`` begins with a border byte, so word positions are moved by one.
    """
    size = end - start
    first = np.concatenate([[0], np.cumsum(size)])
    p = np.arange(first[-1]) + np.repeat(start - first[:-1], size) + 1
    z = np.append(data, np.uint8(0)).astype(np.uint32)
    two = z[p] * np.uint32(0x9E3779B1) ^ z[p + 1] * np.uint32(0x85EBCA77)
    three = two ^ z[p - 1] * np.uint32(0xC2B2AE3D)
    four = three ^ np.where(z[p - 1] > 0, z[np.maximum(p - 2, 0)] + np.uint32(1), np.uint32(0)) * np.uint32(0x27D4EB2F)
    out = np.stack([two, three ^ np.uint32(0x165667B1), four ^ np.uint32(0x5BD1E995)])
    out = (out ^ (out >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return ((out >> np.uint32(17)) & np.uint32(HASHED - 1)).astype(np.int64), first


def _members(keys: np.ndarray, field: Field) -> np.ndarray:
    """Lexicon of each word; the number of languages for a word in none."""
    if not len(field.lexicon):
        return np.full(len(keys), len(field.labels))
    at = np.minimum(np.searchsorted(field.lexicon, keys), len(field.lexicon) - 1)
    return np.where(field.lexicon[at] == keys, field.member[at], len(field.labels))


def _emissions(grams: np.ndarray, first: np.ndarray, member: np.ndarray, field: Field) -> np.ndarray:
    each = field.gram[grams[0]] + field.gram[grams[1]] + field.gram[grams[2]]
    return np.add.reduceat(each, first[:-1], axis=0) + field.word[member] if len(first) > 1 else np.zeros((0, len(field.labels)))


def expected(logits: np.ndarray, count: np.ndarray, step: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of all words, and the expected transitions.

    The words of each chain follow each other; ``count`` has the words of each chain.
    Chains are cut into blocks of ``SPAN`` words: the product of a block's transition
    matrices carries probabilities over it, so all blocks run at once and only their
    ends in order.
    """
    n, k = logits.shape
    chains = np.flatnonzero(count)
    count = count[chains]
    spans = -(-count // SPAN)
    base = np.concatenate([[0], np.cumsum(spans)])
    total = int(base[-1])
    place = np.arange(n) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    slot = (np.repeat(base[:-1], count) + place // SPAN) * SPAN + place % SPAN
    weight = np.ones((total * SPAN, k))
    weight[slot] = np.exp(logits - logits.max(axis=1, keepdims=True))
    real = np.zeros(total * SPAN, bool)
    real[slot] = True
    weight, real = weight.reshape(total, SPAN, k), real.reshape(total, SPAN)
    head = np.zeros(total, bool)
    head[base[:-1]] = True
    move, stay = np.exp(step), np.eye(k)

    def matrix(t: int) -> np.ndarray:
        a = np.where(real[:, t, None, None], move, stay)
        if t == 0:
            a = np.where(head[:, None, None], stay, a)
        return a * weight[:, t, None, :]

    product = np.broadcast_to(stay, (total, k, k)).copy()
    for t in range(SPAN):
        product = product @ matrix(t)
        product /= product.max(axis=(1, 2), keepdims=True)
    into, out = np.empty((total, k)), np.empty((total, k))
    carried, back = np.tile(np.exp(start - start.max()), (len(chains), 1)), np.ones((len(chains), k))
    for b in range(int(spans.max(initial=0))):
        on = np.flatnonzero(spans > b)
        into[base[on] + b] = carried[on]
        v = np.einsum("ci,cij->cj", carried[on], product[base[on] + b])
        carried[on] = v / v.max(axis=1, keepdims=True)
        at = base[on + 1] - 1 - b
        out[at] = back[on]
        v = np.einsum("cij,cj->ci", product[at], back[on])
        back[on] = v / v.max(axis=1, keepdims=True)
    alpha = np.empty((total, SPAN + 1, k))
    alpha[:, 0] = into
    for t in range(SPAN):
        v = np.einsum("ci,cij->cj", alpha[:, t], matrix(t))
        alpha[:, t + 1] = v / v.sum(axis=1, keepdims=True)
    posterior, moves, beta = np.empty((total, SPAN, k)), np.zeros((k, k)), out
    for t in range(SPAN - 1, -1, -1):
        v = alpha[:, t + 1] * beta
        posterior[:, t] = v / v.sum(axis=1, keepdims=True)
        a = matrix(t)
        pair = alpha[:, t, :, None] * a * beta[:, None, :]
        inner = real[:, t] & ~head if t == 0 else real[:, t]
        pair = pair[inner]
        moves += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        v = np.einsum("cij,cj->ci", a, beta)
        beta = v / v.max(axis=1, keepdims=True)
    return posterior.reshape(-1, k)[slot], moves


def fitted(passages: list[tuple[str, str]], fit: Fit) -> Field:
    """The field of greatest likelihood on sequences spliced from (language, passage)."""
    labels = sorted({lang for lang, _ in passages})
    k = len(labels)
    lang = np.array([labels.index(x) for x, _ in passages], np.int64)
    empty = Field(labels, np.zeros((HASHED, k)), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros((k + 1, k)), np.zeros((k, k)), np.zeros(k))
    if not passages:
        return empty
    block = next(arrays.blocks(pa.array([t for _, t in passages], pa.string()), 1 << 62))
    block, found = _spelling(block)
    if not len(found.start):
        return empty
    keys = arrays.word_keys(arrays.Block(0, block.data[1:], block.at), found)
    names, which = np.unique(keys, return_inverse=True)
    uses = np.zeros((len(names), k))
    np.add.at(uses, (which, lang[found.row]), 1)
    uses /= np.maximum(uses.sum(axis=0), 1)
    own = uses.argmax(axis=1)
    sure = (np.bincount(which) >= 4) & (uses.max(axis=1) > 0.8 * uses.sum(axis=1))
    for j in range(k):
        mine = np.flatnonzero(sure & (own == j))
        sure[mine[np.argsort(-uses[mine, j], kind="stable")[fit.lexicon :]]] = False
    rng = np.random.default_rng(fit.seed)
    has = np.flatnonzero(found.count)
    by = [has[lang[has] == j] for j in range(k)]
    by = [x for x in by if len(x)]
    word, count = [], []
    for _ in range(fit.sequences):
        size, here = 0, []
        pieces = [fit.sequence] if rng.random() < 0.5 else rng.multinomial(fit.sequence, [1 / 3] * 3).tolist()
        for want in pieces:
            source = rng.choice(by[rng.integers(len(by))])
            take = min(want, int(found.count[source]))
            at = found.first[source] + rng.integers(found.count[source] - take + 1)
            here += range(at, at + take)
            size += take
        if size:
            word += here
            count.append(size)
    word, count = np.array(word), np.array(count)
    gold = lang[found.row[word]]
    grams, first = _grams(block.data, found.start[word], found.end[word])
    letters = np.diff(first)
    chain = np.repeat(np.arange(len(count)), count)
    inner = np.flatnonzero(chain[1:] == chain[:-1])
    real_moves = np.zeros((k, k))
    np.add.at(real_moves, (gold[inner], gold[inner + 1]), 1)
    heads = np.concatenate([[0], np.cumsum(count)[:-1]])
    field = Field(labels, empty.gram, names[sure], own[sure], empty.word, empty.step, empty.start)
    member = _members(keys[word], field)
    member[rng.random(len(member)) < 0.3] = k  # so that affixes carry unknown words
    truth = np.eye(k)[gold]
    theta = [field.gram.copy(), field.word.copy(), field.step.copy(), field.start.copy()]
    first_moment, second = [np.zeros_like(x) for x in theta], [np.zeros_like(x) for x in theta]
    for t in range(1, fit.steps + 1):
        field = Field(labels, theta[0], field.lexicon, field.member, theta[1], theta[2], theta[3])
        posterior, moves = expected(_emissions(grams, first, member, field), count, field.step, field.start)
        error = posterior - truth
        spread = np.repeat(error, letters, axis=0)
        gram = np.stack([sum(np.bincount(g, spread[:, j], HASHED) for g in grams) for j in range(k)], axis=1)
        words = np.stack([np.bincount(member, error[:, j], k + 1) for j in range(k)], axis=1)
        gradient = [gram, words, moves - real_moves, error[heads].sum(axis=0)]
        for x, g, m, v in zip(theta, gradient, first_moment, second, strict=True):
            g = g / len(word) + fit.decay * x
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= fit.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Field(labels, theta[0].astype(np.float32), field.lexicon, field.member, theta[1], theta[2], theta[3])


def label_words(column: pa.Array, field: Field):
    """For each block: its first row, its words and their label probabilities."""
    for block in arrays.blocks(column):
        spelt, found = _spelling(block)
        if not len(found.start):
            yield block, found, np.zeros((0, len(field.labels)))
            continue
        keys = arrays.word_keys(arrays.Block(0, spelt.data[1:], spelt.at), found)
        grams, first = _grams(spelt.data, found.start, found.end)
        logits = _emissions(grams, first, _members(keys, field), field)
        yield block, found, expected(logits, found.count, field.step, field.start)[0]


_PLAIN = re.compile(rb"[A-Za-z]")


def _has_letter(text: bytes) -> bool:
    return bool(_PLAIN.search(text)) or any(unicodedata.category(c)[0] == "L" for c in text.decode(errors="replace"))


def _predict(field: Field):
    def predict(column: pa.Array) -> pa.Array:
        names, scores = np.full(len(column), "und", object), np.zeros(len(column))
        if field.labels:
            for block, found, posterior in label_words(column, field):
                rows = len(block.at) - 1
                sums = np.stack([np.bincount(found.row, posterior[:, j], rows) for j in range(len(field.labels))], axis=1)
                raw = block.data.tobytes()
                for i in np.flatnonzero(found.count).tolist():
                    if _has_letter(raw[block.at[i] : block.at[i + 1]]):
                        j = int(sums[i].argmax())
                        names[block.first + i] = field.labels[j]
                        scores[block.first + i] = min(1.0, sums[i, j] / found.count[i])
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores)], names=["lang_pred", "score"])

    return predict


def _passage(words: int):
    def passage(column: pa.Array) -> pa.Array:
        """Some words of each text, from a place that depends on the text alone."""
        out = []
        for text in column.to_pylist():
            own = (text or "").split()
            at = len(own) * 7919 % max(1, len(own) - words + 1) if own else 0
            out.append(" ".join(own[at : at + words]))
        return pa.array(out, pa.string())

    return passage


def train(rows: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", fit: Fit | None = None) -> Field:
    """Fit on rows with a language; the driver gets about ``per_language`` passages of each."""
    fit = fit or Fit()
    rows = rows.where(F.col(f"`{lang}`").isNotNull())
    rows = rows.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{lang}`").cast("string").alias("lang"), arrays.text_column(text).alias("t"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64("id", F.lit("draw")), F.lit(1_000_000))
    most = F.create_map(*(x for k, n in sizes.items() for x in (F.lit(k), F.lit(int(1_000_000 * fit.per_language / n) + 1)))) if sizes else None
    if most is None:
        return fitted([], fit)
    drawn = rows.where(draw < F.element_at(most, F.col("lang")))
    got = drawn.select("id", "lang", per_row(_passage(fit.passage), "string")("t").alias("p")).collect()
    return fitted([(r["lang"], r["p"]) for r in sorted(got, key=lambda r: (r["lang"], r["id"] is None, r["id"], r["p"]))], fit)


def labelled(df: DataFrame, field: Field, text: str = "text") -> DataFrame:
    """``df`` with ``lang_pred`` and ``score``."""
    found = per_row(_predict(field), "lang_pred string, score double")(arrays.text_column(text))
    rest = clear(df, "lang_pred", "score").columns
    df = df.select(*(F.col(f"`{c}`") for c in rest), found.alias("_found"))
    return df.select(*(F.col(f"`{c}`") for c in rest), "_found.lang_pred", "_found.score")
