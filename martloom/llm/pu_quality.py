"""Document quality by positive-unlabelled learning.

Trusted positives and unlabelled web text give a linear scorer that minimises the
non-negative unbiased risk: pi * E_p[loss(+)] + max(0, E_u[loss(-)] - pi * E_p[loss(-)]),
with the logistic loss. The class prior pi is estimated first, from a plain
positive-against-unlabelled scorer: the smallest ratio of the unlabelled share to the
positive share above any score, on rows that scorer has not seen. Labels of negatives
are not used.

Features are those of the whole text and do not know its language: shares of the
pairs of byte classes, and shares of upper-case letters, digits, symbols, blanks and
line ends, word length, distinct words and distinct word pairs, and length.

Rows are drawn for fitting by a hash of their id, about ``max_positive`` and
``max_unlabelled`` of them however large the tables are. A null or empty text has the
features of no text and gets the score the model gives these. Repeated rows are scored
each time and may be drawn each time. Without positives or without unlabelled rows
every score is 0.5. Input columns named like an output are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.frames import clear, per_row

# byte classes: each ASCII sign its own, then letters, digits, blanks and the rest
_CLASS = np.zeros(256, np.int64)
_SIGNS = [b for b in range(33, 127) if not chr(b).isalnum()]
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = 0 if _b >= 128 else 1 if _c.islower() else 2 if _c.isupper() else 3 if _c.isdigit() else 4 if _b == 10 else 5
_CLASS[_SIGNS] = 6 + np.arange(len(_SIGNS)) % 26
CLASSES = 32
PLAIN = 10
FEATURES = CLASSES * CLASSES + PLAIN


@dataclass(frozen=True)
class Fit:
    """Bounds of the sample and settings of the descent."""

    max_positive: int = 3000
    max_unlabelled: int = 6000
    steps: int = 600
    rate: float = 0.02
    decay: float = 1e-4
    seed: int = 7


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    prior: float


def features(column: pa.Array) -> np.ndarray:
    """One row of features for each text."""
    out = np.zeros((len(column), FEATURES), np.float32)
    for block in arrays.blocks(column):
        rows = len(block.at) - 1
        size = np.diff(block.at)
        row = np.repeat(np.arange(rows), size)
        kind = _CLASS[block.data]
        part = out[block.first : block.first + rows]
        if len(kind) > 1:
            same = row[1:] == row[:-1]
            pair = (row[1:] * CLASSES + kind[:-1]) * CLASSES + kind[1:]
            counts = np.bincount(pair[same], minlength=rows * CLASSES * CLASSES).reshape(rows, -1)
            part[:, : CLASSES * CLASSES] = np.sqrt(counts / np.maximum(size, 1)[:, None])
        each = np.bincount(row * CLASSES + kind, minlength=rows * CLASSES).reshape(rows, CLASSES) / np.maximum(size, 1)[:, None]
        found = arrays.words(block)
        keys = arrays.word_keys(block, found)
        distinct = _distinct(found.row, keys, rows)
        inside = arrays.within_rows(found, 2)
        pairs = _distinct(found.row[: len(inside)][inside], arrays.shingle_keys(keys, 2)[inside], rows)
        n = np.maximum(found.count, 1)
        letters = np.bincount(found.row, found.end - found.start, rows)
        part[:, CLASSES * CLASSES :] = np.column_stack(
            [
                each[:, 2] / np.maximum(each[:, 1] + each[:, 2], 1e-9), each[:, 3], each[:, 6:].sum(axis=1), each[:, 4], each[:, 5],
                letters / n / 10, distinct / n, pairs / np.maximum(n - 1, 1), np.log1p(found.count) / 10, found.count == 0,
            ]
        )
    return out


def _distinct(row: np.ndarray, keys: np.ndarray, rows: int) -> np.ndarray:
    """Distinct keys of each row."""
    order = np.lexsort((keys, row))
    r, k = row[order], keys[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (k[1:] != k[:-1])
    return np.bincount(r[new], minlength=rows)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _descend(x: np.ndarray, gradient, fit: Fit) -> tuple[np.ndarray, float]:
    """Adam on a linear scorer; ``gradient`` maps scores to their loss derivative."""
    w = np.zeros(x.shape[1] + 1)
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, fit.steps + 1):
        g = gradient(x @ w[:-1] + w[-1])
        step = np.append(x.T @ g + fit.decay * w[:-1], g.sum())
        m, v = 0.9 * m + 0.1 * step, 0.999 * v + 0.001 * step * step
        w -= fit.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def class_prior(positive: np.ndarray, unlabelled: np.ndarray, fit: Fit) -> float:
    """Share of positives among the unlabelled, from rows not used for the scorer."""
    p, u = len(positive) // 2, len(unlabelled) // 2
    x = np.concatenate([positive[:p], unlabelled[:u]])
    y = np.repeat([1.0, 0.0], [p, u])
    weight = np.repeat([0.5 / max(p, 1), 0.5 / max(u, 1)], [p, u])
    w, b = _descend(x, lambda z: weight * (_sigmoid(z) - y), fit)
    sp, su = np.sort(positive[p:] @ w + b), np.sort(unlabelled[u:] @ w + b)
    cuts = np.quantile(sp, np.linspace(0.02, 0.9, 45))
    above_p = 1 - np.searchsorted(sp, cuts) / len(sp)
    above_u = 1 - np.searchsorted(su, cuts) / len(su)
    slack = np.sqrt(np.maximum(above_u * (1 - above_u), 1e-9) / len(su)) + np.sqrt(np.maximum(above_p * (1 - above_p), 1e-9) / len(sp))
    return float(np.clip(((above_u + slack) / above_p).min(), 0.05, 0.95))


def fitted(positive: np.ndarray, unlabelled: np.ndarray, fit: Fit) -> Model:
    """The scorer of least non-negative risk, with its prior."""
    if len(positive) < 2 or len(unlabelled) < 2:
        return Model(np.zeros(FEATURES), np.ones(FEATURES), np.zeros(FEATURES), 0.0, 0.5)
    both = np.concatenate([positive, unlabelled]).astype(np.float64)
    mean, scale = both.mean(axis=0), np.maximum(both.std(axis=0), 0.02)
    p, u = (positive - mean) / scale, (unlabelled - mean) / scale
    rng = np.random.default_rng(fit.seed)
    p, u = np.clip(p[rng.permutation(len(p))], -8, 8), np.clip(u[rng.permutation(len(u))], -8, 8)
    prior = class_prior(p, u, fit)
    x, n = np.concatenate([p, u]), len(p)

    def gradient(z: np.ndarray) -> np.ndarray:
        s = _sigmoid(z)
        g = np.zeros(len(z))
        g[:n] = prior * (s[:n] - 1) / n
        negative = np.log1p(np.exp(np.clip(z, -40, 40)))
        part = negative[n:].mean() - prior * negative[:n].mean()
        sign = 1.0 if part >= 0 else -1.0  # below zero the negative part is driven up again
        if sign < 0:
            g[:] = 0
        g[:n] -= sign * prior * s[:n] / n
        g[n:] += sign * s[n:] / (len(z) - n)
        return g

    w, b = _descend(x, gradient, fit)
    return Model(mean, scale, w, b, prior)


def score(x: np.ndarray, model: Model) -> np.ndarray:
    return _sigmoid(np.clip((x - model.mean) / model.scale, -8, 8) @ model.weight + model.bias)


def _drawn(rows: DataFrame, most: int) -> DataFrame:
    """About ``most`` rows, drawn by a hash of the id; all if there are fewer."""
    n = rows.count()
    return rows.where(F.pmod(F.xxhash64("_id", F.lit("draw")), F.lit(1_000_000)) < int(1_000_000 * most / n)) if n > most else rows


def _collected(rows: DataFrame, most: int) -> np.ndarray:
    vectors = per_row(_as_list, "array<float>")
    got = _drawn(rows, most).select("_id", vectors("_text").alias("x")).toArrow()
    got = got.sort_by([("_id", "ascending")])["x"].combine_chunks()
    return got.flatten().to_numpy().reshape(-1, FEATURES)


def _as_list(column: pa.Array) -> pa.Array:
    x = features(column)
    at = np.arange(len(x) + 1, dtype=np.int32) * FEATURES
    return pa.ListArray.from_arrays(pa.array(at), pa.array(x.ravel()))


def train(rows: DataFrame, positive: DataFrame, id_col: str, text: str, fit: Fit | None = None) -> Model:
    """Fit on ``rows`` (the text allowed for learning); ``positive`` has the trusted ids.

    The unlabelled rows are drawn from all of ``rows``.
    """
    fit = fit or Fit()
    rows = rows.select(F.col(f"`{id_col}`").alias("_id"), arrays.text_column(text).alias("_text"))
    trusted = positive.select(F.col(positive.columns[0]).alias("_id")).distinct()
    trusted = _drawn(trusted, fit.max_positive)
    chosen = rows.join(F.broadcast(trusted), "_id", "left_semi")  # about max_positive ids
    return fitted(_collected(chosen, fit.max_positive), _collected(rows, fit.max_unlabelled), fit)


def scored(df: DataFrame, model: Model, text: str = "text", cut: float = 0.7) -> DataFrame:
    """``df`` with ``score`` and ``predicted`` (1 from ``cut`` on)."""

    def work(column: pa.Array) -> pa.Array:
        out = np.empty(len(column))
        for at in range(0, len(column), 512):
            out[at : at + 512] = score(features(column.slice(at, 512)), model)
        return pa.array(out)

    value: Column = per_row(work, "double")(arrays.text_column(text))
    rest = clear(df, "score", "predicted").columns
    df = df.select(*(F.col(f"`{c}`") for c in rest), value.alias("score"))
    return df.withColumn("predicted", (F.col("score") >= cut).cast("int"))
