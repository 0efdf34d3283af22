"""Benchmark decontamination: word-pair seeds, then Smith-Waterman alignment.

Words are runs of letters and digits (and whatever is not ASCII), A-Z folded. Every
test item gives its pairs of neighbouring words as seeds, and all of them are looked up
in each text. How many other documents hold a seed says nothing about a copy, so no seed
is left out as common: where three different seeds of an item (or all that the shortest
copy that counts has) lie near each other, there is a candidate region. Even with every
third word changed, a copy that scores enough has such pairs. What keeps alignments few is
a bound: words of the region that the item has count 2, all others -1; no
alignment scores more than the largest sum of neighbouring words. Runs of words without
such a sum are cut off, the rest is aligned with the item (match 2, mismatch and gap -1).
A region is a leak if its score reaches ``share`` of the item's own score, or that of
``enough`` words. A copy with a word set between any two words keeps no pair and is not found.

Items are read in blocks of ``ITEMS``. A single block is sent to the tasks and run
against all rows. Of a larger test set each block is a pass of its own that writes the
leaks it finds by a key of the text, and the passes are joined with the rows at the end;
neither the driver nor a task holds more than one block. Within a document all is done in its task.

Null and empty texts have no leak. An item with fewer words than a seed never matches;
a null item is left out. A repeated row or item gives its matches each time. An input
column named like an output is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.frames import clear, per_row, ship, stage
from martloom.session import broadcast_if_small

ITEMS = 2000
PIECE = 1 << 20  # seed places, and words of regions, that are looked at together
WIDTH = 2
LEAK = "array<struct<item_id: long, score: double, end_word: long>>"
_LEAK_ARROW = pa.list_(pa.struct([("item_id", pa.int64()), ("score", pa.float64()), ("end_word", pa.int64())]))


@dataclass(frozen=True)
class Alignment:
    """What is a candidate and what is a leak."""

    seeds: int = 3  # different seeds of an item in a region
    share: float = 0.5
    enough: int = 25
    slack: int = 8  # words a region is widened by


@dataclass(frozen=True)
class Items:
    """A block of test items as arrays: words, seeds and where the seeds occur."""

    ids: np.ndarray
    words: list[np.ndarray]
    seeds: np.ndarray  # sorted keys
    first: np.ndarray  # of each seed into item / place
    item: np.ndarray
    place: np.ndarray
    sieve: np.ndarray  # which low 20 bits occur among the seeds
    size: np.ndarray  # words of each item
    own: np.ndarray  # sorted keys of (item, word)


def read_items(rows: list[tuple[int, str]]) -> Items:
    ids = np.array([i for i, _ in rows], np.int64)
    block = next(arrays.blocks(pa.array([t for _, t in rows], pa.string()), 1 << 62))
    found = arrays.words(block, arrays.PUNCTUATION)
    keys = arrays.word_keys(block, found, fold=True)
    inside = arrays.within_rows(found, WIDTH)
    at = np.flatnonzero(inside)
    seeds, which = np.unique(arrays.shingle_keys(keys, WIDTH)[at], return_inverse=True)
    order = np.argsort(which, kind="stable")
    first = np.searchsorted(which[order], np.arange(len(seeds) + 1))
    item = found.row[at][order]
    words = [keys[a : a + n] for a, n in zip(found.first.tolist(), found.count.tolist(), strict=True)]
    place = at[order] - found.first[item]
    own = np.unique(_owned(found.row, keys))
    return Items(ids, words, seeds, first, item, place, _sieve(seeds), found.count, own)


def _owned(item: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """One key for an item and a word."""
    return arrays.mix(keys ^ arrays.mix(item.astype(np.uint64) + np.uint64(1)))


def _sieve(seeds: np.ndarray) -> np.ndarray:
    out = np.zeros(1 << 20, bool)
    out[(seeds & np.uint64(0xFFFFF)).astype(np.int64)] = True
    return out


def _hits(block: arrays.Block, seeds: np.ndarray, sieve: np.ndarray):
    """Words of a block, their keys, and the (word, seed) hits within rows."""
    found = arrays.words(block, arrays.PUNCTUATION)
    keys = arrays.word_keys(block, found, fold=True)
    runs = arrays.shingle_keys(keys, WIDTH)
    at = np.flatnonzero(sieve[(runs & np.uint64(0xFFFFF)).astype(np.int64)] & arrays.within_rows(found, WIDTH))
    which = np.searchsorted(seeds, runs[at])
    which[which == len(seeds)] = 0
    real = seeds[which] == runs[at] if len(seeds) else np.zeros(len(at), bool)
    return found, keys, at[real], which[real]


def _places(items: Items, which: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(hit, place among the items' seeds) of hits of the seeds ``which``, for a range of
    items at a time, so that about ``PIECE`` are held."""
    n = len(items.ids)
    key = np.repeat(np.arange(len(items.seeds)), np.diff(items.first)) * n + items.item
    ranges = [(0, n)]
    while ranges:
        low, high = ranges.pop()
        a, b = np.searchsorted(key, which * n + low), np.searchsorted(key, which * n + high)
        times = b - a
        total = int(times.sum())
        if total > PIECE and high - low > 1:
            ranges += [((low + high) // 2, high), (low, (low + high) // 2)]
        elif total:
            hit = np.repeat(np.arange(len(which)), times)
            yield hit, np.arange(total) - np.repeat(np.cumsum(times) - times, times) + a[hit]


def _needed(items: Items, rules: Alignment) -> np.ndarray:
    """Different seeds a region of each item must have: not more than the shortest copy of
    neighbouring words that is a leak."""
    shortest = np.ceil(np.minimum(rules.share * items.size, rules.enough)).astype(np.int64)
    return np.clip(shortest - WIDTH + 1, 1, rules.seeds)


def _regions(found: arrays.Words, items: Items, at: np.ndarray, which: np.ndarray, rules: Alignment) -> Iterator[np.ndarray]:
    """Row, item, first word and end of the candidate regions of a block, as columns."""
    needed = _needed(items, rules)
    for hit, spot in _places(items, which):
        word, item, place = at[hit], items.item[spot], items.place[spot]
        row = found.row[word]
        order = np.lexsort((word, item, row))
        row, item, place, word = (z[order] for z in (row, item, place, word))
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (word[1:] - word[:-1] > items.size[item[1:]] + rules.slack)
        group, start = np.cumsum(new) - 1, np.flatnonzero(new)
        kinds = np.unique(group * (int(place.max()) + 1) + place) // (int(place.max()) + 1)
        row, item, lag = row[start], item[start], word - place
        low = np.maximum(found.first[row], np.minimum.reduceat(lag, start) - rules.slack)
        high = np.maximum.reduceat(lag, start) + items.size[item] + rules.slack
        high = np.minimum(found.first[row] + found.count[row], high)
        yield np.stack([row, item, low, high])[:, np.bincount(kinds) >= needed[item]]


def _promising(regions: np.ndarray, keys: np.ndarray, items: Items, rules: Alignment) -> Iterator[tuple[int, int, int, int]]:
    """The parts of regions (row, item, first word, end) in which an alignment can be a leak."""
    size = regions[3] - regions[2]
    part = (np.cumsum(size) - size) // PIECE
    for k in np.unique(part):
        row, item, low, high = regions[:, part == k]
        n = high - low
        piece = np.repeat(np.arange(len(n)), n)
        word = np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)
        key = _owned(item[piece], keys[word])
        spot = np.minimum(np.searchsorted(items.own, key), len(items.own) - 1)
        total = np.concatenate([[0], np.cumsum(np.where(items.own[spot] == key, 2, -1))])
        apart = piece * (4 * len(word) + 4)  # keeps running extremes of one region from the next
        least = np.minimum.accumulate(total[:-1] - apart)
        most = np.maximum.accumulate((total[1:] - apart)[::-1])[::-1]
        good = most - least >= 2 * np.minimum(rules.share * items.size[item], rules.enough)[piece]
        opens, ends = good.copy(), good.copy()
        opens[1:] &= ~good[:-1] | (piece[1:] != piece[:-1])
        ends[:-1] &= ~good[1:] | (piece[1:] != piece[:-1])
        own = piece[opens]
        yield from zip(row[own].tolist(), item[own].tolist(), word[opens].tolist(), (word[ends] + 1).tolist(), strict=True)


def align(region: np.ndarray, item: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best local score of each pair of padded word rows, and where it ends in the region.

    Pads differ between region (1) and item (0) and so never match.
    """
    n, wide = region.shape
    step = np.arange(wide + 1, dtype=np.int32)
    above = np.zeros((n, wide + 1), np.int32)
    best, end = np.zeros(n, np.int32), np.zeros(n, np.int64)
    row = np.empty_like(above)
    for k in range(item.shape[1]):
        row[:, 0] = 0
        row[:, 1:] = above[:, :-1] + np.where(region == item[:, k, None], 2, -1)
        np.maximum(row, above - 1, out=row)
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row + step, axis=1) - step
        at = row.argmax(axis=1)
        top = row[np.arange(n), at]
        better = top > best
        best[better], end[better] = top[better], at[better]
        above, row = row, above
    return best, end


def leaks(column: pa.Array, items: Items, rules: Alignment) -> pa.Array:
    """The leaks of each text, one per item at most (the best region)."""
    rows = len(column)
    jobs: list[tuple[int, int, int, np.ndarray]] = []  # row, item, first word of the region, region
    for block in arrays.blocks(column):
        found, keys, at, which = _hits(block, items.seeds, items.sieve)
        if not len(at):
            continue
        for regions in _regions(found, items, at, which, rules):
            for r, i, low, high in _promising(regions, keys, items, rules):
                jobs.append((block.first + r, i, low - int(found.first[r]), keys[low:high]))
    best: dict[tuple[int, int], tuple[float, int]] = {}
    jobs.sort(key=lambda j: len(j[3]))
    k = 0
    while k < len(jobs):
        wide = len(jobs[k][3]) * 5 // 4 + 16
        few = max(1, min(256, (1 << 20) // wide))
        part = [j for j in jobs[k : k + few] if len(j[3]) <= wide]
        k += len(part)
        deep, wide = max(len(items.words[j[1]]) for j in part), len(part[-1][3])
        region, item = np.ones((len(part), wide), np.uint64), np.zeros((len(part), deep), np.uint64)
        for x, (_, i, _, own) in enumerate(part):
            region[x, : len(own)] = own
            item[x, : len(items.words[i])] = items.words[i]
        score, end = align(region, item)
        for (r, i, low, _), s, e in zip(part, score.tolist(), end.tolist(), strict=True):
            n = len(items.words[i])
            if s >= 2 * min(rules.share * n, rules.enough) and s / (2 * n) > best.get((r, i), (0.0, 0))[0]:
                best[r, i] = (s / (2 * n), low + e)
    out: list[list[dict]] = [[] for _ in range(rows)]
    for (r, i), (s, e) in sorted(best.items()):
        out[r].append({"item_id": int(items.ids[i]), "score": round(s, 4), "end_word": e})
    return pa.array(out, _LEAK_ARROW)


def _find(items, rules: Alignment):
    def find(column: pa.Array) -> pa.Array:
        return leaks(column, items.value, rules)

    return find


def _item_blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int, str]]]:
    wanted = benchmark.select(F.col(f"`{item_id}`").cast("long"), arrays.text_column(text)).dropna()
    rows = []
    for r in wanted.toLocalIterator():
        rows.append((r[0], r[1]))
        if len(rows) == ITEMS:
            yield rows
            rows = []
    if rows:
        yield rows


def contaminated(
    df: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    rules: Alignment | None = None,
) -> DataFrame:
    """``df`` with ``leaks``: item, score (of the item's own) and end of each leak."""
    rules = rules or Alignment()
    spark = df.sparkSession
    ship(spark)
    rest = clear(df, "leaks").columns
    names = [f"c{k}" for k in range(len(rest))]
    rows = df.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(rest, names, strict=True)), arrays.text_column(text).alias("t"))
    none = F.expr(f"cast(array() as {LEAK})")
    passes: list[DataFrame] = []
    blocks = _item_blocks(benchmark, item_id, item_text)
    block, following = next(blocks, None), next(blocks, None)
    while block is not None:
        items = read_items(block)
        if len(items.seeds):
            held = spark.sparkContext.broadcast(items)
            found = per_row(_find(held, rules), LEAK)("t")
            if following is None and not passes:  # the whole test set is one block
                return rows.select(*(F.col(n).alias(c) for c, n in zip(rest, names, strict=True)), found.alias("leaks"))
            # equal texts have equal leaks, so a key of the text stands for its rows
            wrote = rows.select(_text_key("t").alias("key"), found.alias("leaks")).where(F.size("leaks") > 0).dropDuplicates(["key"])
            passes.append(stage(wrote, "decontamination"))
            held.unpersist()
        block, following = following, next(blocks, None)
    if not passes:
        return rows.select(*(F.col(n).alias(c) for c, n in zip(rest, names, strict=True)), none.alias("leaks"))
    every = reduce(DataFrame.unionByName, passes).groupBy("key").agg(F.array_sort(F.flatten(F.collect_list("leaks"))).alias("leaks"))
    out = rows.withColumn("key", _text_key("t")).join(broadcast_if_small(stage(every, "decontamination")), "key", "left")
    return out.select(*(F.col(n).alias(c) for c, n in zip(rest, names, strict=True)), F.coalesce("leaks", none).alias("leaks"))


def _text_key(column: str):
    return F.struct(F.xxhash64(column), F.octet_length(column), F.crc32(F.col(column).cast("binary")))
