"""Quality rules judged by host: document rules, shrunken host rates, verdicts.

Each document is measured on its whole text. Its rule failures are counted per host
and shrunk towards the rate of all hosts with a beta prior fitted to the hosts by
moments; the shrunken rate grades the host, and the grade decides which rules its
documents have to meet:

* every document must pass the base rules (enough words, little repetition);
* on a host whose shrunken rate of failing any rule is ``strict_rate`` or more, a
  document must pass the other rules too (symbols, repeated lines);
* on a host at ``drop_rate`` or more, no document stays.

A null text has no words. A document without a host has no verdict but its own base
rules. Repeated rows count each time. Input columns named like an output are
replaced. An empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.frames import clear, per_row, stage, unused
from martloom.session import broadcast_if_small

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = b"#*$%&|<>"


@dataclass(frozen=True)
class RuleLimits:
    """Limits of the document rules and of the host grades."""

    min_words: int = 10
    max_repeat_pct: int = 20
    max_symbol_pct: int = 25  # symbols per hundred word characters
    max_dup_line_pct: int = 30  # repeated lines per hundred words
    strict_rate: float = 0.02
    drop_rate: float = 0.9
    prior_strength: float = 20.0  # documents the prior weighs when the hosts do not differ


_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[list(SYMBOLS)] = 1
_STARTS = np.zeros(256, np.int64)  # bytes that begin a code point
_STARTS[[b for b in range(256) if b & 0xC0 != 0x80]] = 1


def _repeated(ids: np.ndarray, width: int = 5) -> int:
    """Words that lie in a window of ``width`` ids found twice or more."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    key, size, distinct = ids.astype(np.int64), int(ids.max()) + 1, int(ids.max()) + 1
    for k in range(1, width):
        if size * distinct >= 1 << 62:  # rank again so that keys stay exact
            key = np.unique(key, return_inverse=True)[1]
            size = int(key.max()) + 1
        key = key[: len(ids) - k] * distinct + ids[k:]
        size *= distinct
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = ranked[1:] == ranked[:-1]
    if not same.any():
        return 0
    twice = np.zeros(n, bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    for k in range(width):
        covered[k : k + n] |= twice
    return int(covered.sum())


def _dup_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip(b" \t\r\x0b\x0c")]
    return len(lines) - len(set(lines))


def measure(column: pa.Array) -> pa.StructArray:
    """The five counts of each text; lines and windows are compared exactly."""
    out = np.zeros((len(column), len(COUNTS)), np.int64)
    for block in arrays.blocks(column):
        found = arrays.words(block)
        rows = slice(block.first, block.first + len(block.at) - 1)
        out[rows, 0] = found.count
        starts = np.concatenate([[0], np.cumsum(_STARTS[block.data] * ~arrays.SEPARATOR[block.data])])
        out[rows, 1] = starts[block.at[1:]] - starts[block.at[:-1]]
        marks = np.concatenate([[0], np.cumsum(_SYMBOL[block.data])])
        out[rows, 2] = marks[block.at[1:]] - marks[block.at[:-1]]
        raw = block.data.tobytes()
        start, end = found.start.tolist(), found.end.tolist()
        for i, (a, b) in enumerate(zip(block.at[:-1].tolist(), block.at[1:].tolist(), strict=True)):
            text = raw[a:b]
            if b"\n" in text:
                out[block.first + i, 3] = _dup_lines(text)
            n, first = int(found.count[i]), int(found.first[i])
            if n > 5:
                seen: dict[bytes, int] = {}
                mine = [raw[s:e] for s, e in zip(start[first : first + n], end[first : first + n], strict=True)]
                ids = np.fromiter((seen.setdefault(w, len(seen)) for w in mine), np.int64, n)
                if len(seen) < n:
                    out[block.first + i, 4] = _repeated(ids)
    return pa.StructArray.from_arrays([pa.array(out[:, k]) for k in range(len(COUNTS))], names=list(COUNTS))


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the five counts; other columns stay in the JVM."""
    count = per_row(measure, ", ".join(f"{c} long" for c in COUNTS))
    df = clear(df, *COUNTS) if text not in COUNTS else df
    spare = unused(df, "_m")
    df = df.withColumn(spare, count(arrays.text_column(text)))
    return df.select("*", *(F.col(f"{spare}.{c}").alias(c) for c in COUNTS)).drop(spare)


def judged(df: DataFrame, limits: RuleLimits) -> DataFrame:
    """Rule results of measured rows: ``base_failed`` and ``rules_failed``."""
    base = (F.col("n_words") < limits.min_words) | (100 * F.col("n_repeat_words") > limits.max_repeat_pct * F.col("n_words"))
    more = (100 * F.col("n_symbols") > limits.max_symbol_pct * F.col("word_chars")) | (
        100 * F.col("n_dup_lines") > limits.max_dup_line_pct * F.col("n_words")
    )
    return df.withColumn("base_failed", base).withColumn("rules_failed", base | more)


def host_rates(rows: DataFrame, host: str, limits: RuleLimits) -> DataFrame:
    """Shrunken failure rate of each host: ``host``, ``n_docs``, ``n_failed``, ``rate``.

    The prior's mean is the pooled rate; its strength follows from how much more the
    host rates vary than chance would let them (method of moments).
    """
    hosts = rows.where(F.col(f"`{host}`").isNotNull()).groupBy(F.col(f"`{host}`").alias("host"))
    hosts = stage(hosts.agg(F.count("*").alias("n_docs"), F.sum(F.col("rules_failed").cast("long")).alias("n_failed")), "host-rates")
    moments = hosts.agg(
        F.count("*").alias("k"), F.sum("n_docs").alias("n"), F.sum("n_failed").alias("f"),
        F.sum(F.col("n_docs").cast("double") * F.col("n_docs")).alias("n2"),
        F.sum(F.pow(F.col("n_failed") / F.col("n_docs"), F.lit(2)) * F.col("n_docs")).alias("f2"),
    ).first()
    mean, strength = prior(moments["k"], moments["n"], moments["f"], moments["n2"], moments["f2"], limits.prior_strength)
    rate = (F.col("n_failed") + F.lit(mean * strength)) / (F.col("n_docs") + F.lit(strength))
    return hosts.withColumn("rate", rate)


def prior(k: int, n: int, f: int, n2: float, f2: float, strength: float) -> tuple[float, float]:
    """Mean and strength of the beta prior from sums over hosts: number, documents,
    failures, squared documents and documents times squared rate."""
    if not k or not n:
        return 0.0, strength
    mean = f / n
    spread = max(0.0, f2 - n * mean * mean)  # weighted sum of squares of the rates
    chance = (k - 1) * mean * (1 - mean)
    room = n - n2 / n
    if k < 2 or chance <= 0 or room <= 0 or spread <= chance:
        return mean, strength
    between = (spread - chance) / (room - (k - 1)) if room > k - 1 else 0.0
    return mean, max(1.0, mean * (1 - mean) / between - 1) if between > 0 else strength


def host_rules(
    df: DataFrame, text: str = "text", host: str = "source", limits: RuleLimits | None = None, columns: list[str] | None = None
) -> DataFrame:
    """``columns`` of each row (default: all) with its counts, ``base_failed``,
    ``host_rate`` (null without a host) and ``kept``.

    The measured rows are written once and read twice, for the rates and the verdicts,
    so texts are measured only once; ask for few columns where texts are not needed.
    """
    limits = limits or RuleLimits()
    columns = list(columns if columns is not None else df.columns)
    made = (*COUNTS, "base_failed", "rules_failed", "host_rate", "kept", "_host")
    df = df.withColumn("_text", arrays.text_column(text)).withColumn("_host", F.col(f"`{host}`").cast("string"))
    rest = clear(df, *(c for c in made if c != "_host"))
    rows = measured(rest, "_text")
    kept = [c for c in columns if c.lower() not in {m.lower() for m in made}]
    rows = judged(rows.select(*(F.col(f"`{c}`") for c in kept), "_host", *COUNTS), limits)
    rows = stage(rows, "host-rules")
    rates = host_rates(rows, "_host", limits).select(F.col("host").alias("_host"), F.col("rate").alias("host_rate"))
    rows = rows.join(broadcast_if_small(rates), "_host", "left")
    rate = F.coalesce(F.col("host_rate"), F.lit(0.0))
    verdict = F.when(rate >= limits.drop_rate, False).when(rate >= limits.strict_rate, ~F.col("rules_failed")).otherwise(True)
    return rows.withColumn("kept", ~F.col("base_failed") & verdict).drop("_host", "rules_failed")
