"""Near-duplicate components by SimHash fingerprints and the general pigeonhole principle.

A fingerprint bit is 1 if it is set in more than half of the XXH64 keys of a text's
word shingles. Two fingerprints link if they differ in ``radius`` bits at most. Equal
fingerprints are one node from the start.

The 64 bits are grouped into partitions of correlated bits. Where the thresholds of a
fingerprint's partitions sum to ``radius`` - partitions + 1, each fingerprint within the
radius lies within the threshold of one partition at least; a threshold of -1 leaves a
partition out. So each fingerprint chooses its own thresholds: a dynamic program takes
those with the least cost of probes and estimated candidates. Candidates are estimated
from the values that hold many fingerprints (a bounded table) and an even spread of the
others. Common partitions are so left out and rare ones probed further.

A fingerprint is indexed under each partition value and probes the values within its
thresholds. Probes meet the index in one sorted shuffle and are verified there; a task
returns a spanning forest of the links it finds, never all pairs. Values with more than
``CELL`` probes or entries are dealt over cells, each probe meeting each entry once, so
one value never fills a task and nothing is left out.

Words are runs of anything but blank and the controls 9 to 13, A-Z count as a-z. A text
of fewer words than a shingle has all of them as its shingle; null texts and texts
without words have fingerprint 0, which links like any other. Each row counts, repeated
ids included; a null id is never the smallest unless its whole component has none.
Input columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.frames import components, per_row, ship, stage
from martloom.session import broadcast_if_small

BITS = 64
SEED = 42
PROBE, VERIFY = 1.0, 0.02  # relative cost of a shuffled row and of a compared pair
COMMON = 1024  # partition values with more than 1/COMMON of all entries are counted exactly
CELL = 2048
PAIRS = 1 << 20
INDEX, ASKS = 1, 2  # kinds of signature rows; a row may be both


@dataclass(frozen=True)
class Layout:
    """Bits of each partition, its common values with their counts, and all fingerprints."""

    parts: tuple[tuple[int, ...], ...]
    values: tuple[np.ndarray, ...]
    counts: tuple[np.ndarray, ...]
    n: int
    radius: int


def _shingle_keys(raw: bytes, width: int) -> np.ndarray:
    words = raw.lower().split()
    n = len(words) - width + 1
    if not words:
        return np.zeros(0, np.uint64)
    text, key = b" ".join(words), xxhash.xxh64_intdigest
    if n <= 1:
        return np.array([key(text, SEED)], np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(size + 1) - 1
    spans = zip((end - size)[:n].tolist(), end[width - 1 :].tolist(), strict=True)
    return np.fromiter((key(text[a:b], SEED) for a, b in spans), np.uint64, n)


def fingerprint(raw: bytes, width: int = 3) -> int:
    """The fingerprint of a UTF-8 text."""
    keys = _shingle_keys(raw, width)
    set_bits = np.zeros(BITS, np.int64)
    for low in range(0, len(keys), 1 << 16):
        part = keys[low : low + (1 << 16)].view(np.uint8).reshape(-1, 8)
        set_bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * set_bits > len(keys), bitorder="little").view(np.uint64)[0])


def _fingerprints(width: int):
    def fingerprints(column: pa.Array) -> pa.Array:
        out = np.zeros(len(column), np.uint64)
        for block in arrays.blocks(column):
            raw = block.data.tobytes()
            for k, (a, b) in enumerate(zip(block.at[:-1].tolist(), block.at[1:].tolist(), strict=True)):
                out[block.first + k] = fingerprint(raw[a:b], width)
        return pa.array(out.view(np.int64))

    return fingerprints


def _bits(prints: np.ndarray) -> np.ndarray:
    return np.unpackbits(prints.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def _joint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((BITS, BITS), np.int64)
    for batch in batches:
        bits = _bits(batch.column(0).to_numpy()).astype(np.float32)
        for low in range(0, len(bits), 1 << 20):  # float32 counts exactly up to 2^24
            some = bits[low : low + (1 << 20)]
            total += (some.T @ some).astype(np.int64)
    at = np.arange(BITS * BITS)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], names=["at", "n"])


def correlated_parts(joint: np.ndarray, n: int, parts: int) -> tuple[tuple[int, ...], ...]:
    """The bits dealt into partitions of even size, each grown around its most correlated bits."""
    p = np.diag(joint) / max(n, 1)
    spread = np.sqrt(np.outer(p * (1 - p), p * (1 - p)))
    tie = np.abs(np.divide(joint / max(n, 1) - np.outer(p, p), spread, out=np.zeros_like(spread), where=spread > 0))
    np.fill_diagonal(tie, 0)
    left, out = list(range(BITS)), []
    for k in range(parts):
        size = BITS * (k + 1) // parts - BITS * k // parts
        start = max(left, key=lambda b: (np.sort(tie[b, left])[-size:].sum(), -b))
        group = [start]
        while len(group) < size:
            group.append(max((b for b in left if b not in group), key=lambda b: (tie[b, group].sum(), -b)))
        left = [b for b in left if b not in group]
        out.append(tuple(sorted(group)))
    return tuple(out)


def _around(bits: int, threshold: int) -> int:
    """How many values lie within ``threshold`` of one."""
    return sum(comb(bits, k) for k in range(threshold + 1))


def cheapest_number(n: int, radius: int) -> int:
    """The number of partitions whose probes and candidates cost least if values spread evenly."""

    def cost(parts: int) -> float:
        bits = BITS // parts
        base, more = divmod(radius - parts + 1, parts)
        around = [_around(bits, base + (k < more)) for k in range(parts)]
        return sum(a * (PROBE + VERIFY * n / 2**bits) for a in around)

    return min(range(2, radius + 2), key=cost)


def part_values(prints: np.ndarray, part: tuple[int, ...]) -> np.ndarray:
    out = np.zeros(len(prints), np.uint64)
    for k, b in enumerate(part):
        out |= (prints >> np.uint64(b) & np.uint64(1)) << np.uint64(k)
    return out


def thresholds(prints: np.ndarray, layout: Layout) -> np.ndarray:
    """The cheapest thresholds of each fingerprint, one row per partition.

    Dynamic program over partitions and the sum of the thresholds so far.
    """
    parts, choices = len(layout.parts), range(-1, layout.radius + 1)
    rows = len(prints)
    best = {0: np.zeros(rows)}
    taken = []
    for k, part in enumerate(layout.parts):
        value, costs = part_values(prints, part), {-1: np.zeros(rows)}
        even = max(0, layout.n - int(layout.counts[k].sum())) / 2 ** len(part)
        held = np.zeros((layout.radius + 1, rows))
        for low in range(0, rows, 4096):
            apart = np.bitwise_count(value[low : low + 4096, None] ^ layout.values[k][None, :])
            for t in range(layout.radius + 1):
                held[t, low : low + 4096] = (apart <= t) @ layout.counts[k].astype(float)
        for t in range(layout.radius + 1):
            around = _around(len(part), t)
            costs[t] = PROBE * around + VERIFY * (even * around + held[t])
        new, choice = {}, {}
        for total, cost in best.items():
            for t in choices:
                sum_, c = total + t, cost + costs[t]
                if sum_ not in new:
                    new[sum_], choice[sum_] = c, np.full(rows, t)
                else:
                    better = c < new[sum_]
                    new[sum_] = np.where(better, c, new[sum_])
                    choice[sum_] = np.where(better, t, choice[sum_])
        best = new
        taken.append(choice)
    out = np.zeros((parts, rows), np.int64)
    left = np.full(rows, layout.radius - parts + 1)
    for k in range(parts - 1, -1, -1):
        for total, choice in taken[k].items():
            here = left == total
            out[k, here] = choice[here]
        left = left - out[k]
    return out


def _keys(part: int, values: np.ndarray) -> np.ndarray:
    return (np.uint64(part) << np.uint64(40) | values).view(np.int64)


def _sign(layout: Layout):
    """Signature rows: the index entries and probes of each fingerprint."""
    masks = []
    for part in layout.parts:
        by_size = [np.array([sum(1 << b for b in c) for c in combinations(range(len(part)), k)], np.uint64) for k in range(layout.radius + 1)]
        masks.append([np.concatenate(by_size[1 : t + 1]) if t else by_size[1][:0] for t in range(layout.radius + 1)])

    def rows(key: np.ndarray, kind: np.ndarray, prints: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(kind.astype(np.int8)), pa.array(prints.view(np.int64))], names=["key", "kind", "print"])

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            chosen = thresholds(prints, layout)
            for k, part in enumerate(layout.parts):
                value = part_values(prints, part)
                yield rows(_keys(k, value), np.where(chosen[k] >= 0, INDEX | ASKS, INDEX), prints)
                for t in range(1, layout.radius + 1):
                    near = masks[k][t]
                    mine = np.flatnonzero(chosen[k] == t)
                    step = max(1, (1 << 18) // len(near))
                    for low in range(0, len(mine), step):
                        some = mine[low : low + step]
                        probed = (value[some, None] ^ near[None, :]).ravel()
                        yield rows(_keys(k, probed), np.full(len(probed), ASKS), np.repeat(prints[some], len(near)))

    return sign


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as connect what the given links connect: each node to its smallest one."""
    nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _links(cell: np.ndarray, kind: np.ndarray, prints: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    """Links of whole cells; rows are sorted by cell."""
    asks, index = np.flatnonzero(kind & ASKS), np.flatnonzero(kind & INDEX)
    if not len(asks) or not len(index):
        return
    first = np.searchsorted(cell[index], cell[asks], "left")
    many = np.searchsorted(cell[index], cell[asks], "right") - first
    upto = np.cumsum(many)
    low = 0
    while low < len(asks):
        done = upto[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(upto, done + PAIRS, "right")))
        n = many[low:high]
        left = np.repeat(asks[low:high], n)
        right = index[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[low:high], n)]
        x, y = prints[left], prints[right]
        near = (np.bitwise_count(x ^ y) <= radius) & (x != y)
        if near.any():
            u, v = forest(x[near].view(np.int64), y[near].view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])
        low = high


def _meet(radius: int):
    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by cell. Keeps the rows of one unfinished cell between batches."""
        held = [np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros(0, np.uint64)]
        for batch in batches:
            new = [batch.column(0).to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy().view(np.uint64)]
            cell, kind, prints = (np.concatenate(z) for z in zip(held, new, strict=True))
            if not len(cell):
                continue
            whole = int(np.searchsorted(cell, cell[-1], "left"))
            yield from _links(cell[:whole], kind[:whole], prints[:whole], radius)
            held = [cell[whole:], kind[whole:], prints[whole:]]
        yield from _links(*held, radius)

    return meet


def _dealt(signed: DataFrame) -> DataFrame:
    """Signature rows with their cell. Large values are dealt over a grid of probes by
    entries; those without probes or without entries fall away, as they have no pair."""
    asks, index = F.col("kind").bitwiseAND(ASKS) != 0, F.col("kind").bitwiseAND(INDEX) != 0
    sizes = signed.groupBy("key").agg(F.count_if(asks).alias("asks"), F.count_if(index).alias("entries"))
    large = stage(sizes.where((F.col("asks") > CELL) | (F.col("entries") > CELL)), "simhash-large")
    rows = signed.join(broadcast_if_small(large), "key", "left")
    slot = F.xxhash64("print", "key")
    wide, tall = F.ceil(F.col("asks") / CELL), F.ceil(F.col("entries") / CELL)  # columns of probes, lines of entries

    def places(kind: int, mine, own, across) -> F.Column:
        spread = F.sequence(F.lit(0).cast("long"), F.greatest(across, F.lit(1)) - 1)
        mine = mine & (F.col("asks") > 0) & (F.col("entries") > 0)
        at = lambda other: F.struct(
            F.lit(kind).cast("byte").alias("kind"),
            (F.struct(F.pmod(slot, own).alias("a"), other.alias("b")) if kind == ASKS else F.struct(other.alias("a"), F.pmod(slot, own).alias("b"))).alias("at"),
        )
        return F.when(mine, F.transform(spread, at)).otherwise(F.array().cast("array<struct<kind:tinyint,at:struct<a:bigint,b:bigint>>>"))

    grid = F.concat(places(ASKS, asks, F.greatest(wide, F.lit(1)), tall), places(INDEX, index, F.greatest(tall, F.lit(1)), wide))
    alone = rows.where("asks IS NULL").select(F.col("key").alias("cell"), "kind", "print")
    spread = rows.where("asks IS NOT NULL").select("key", "print", F.explode(grid).alias("g"))
    return alone.union(spread.select(F.xxhash64("key", "g.at.a", "g.at.b"), "g.kind", "print"))


def _layout(distinct: DataFrame, n: int, radius: int, parts: int | None) -> Layout:
    number = parts or cheapest_number(n, radius)
    joint = np.zeros((BITS, BITS), np.int64)
    found = distinct.select("print").mapInArrow(_joint, "at long, n long").groupBy("at").agg(F.sum("n").alias("n"))
    for r in found.collect():  # 64 x 64 counts
        joint[divmod(r["at"], BITS)] = r["n"]
    groups = correlated_parts(joint, n, number)

    def valued(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy().view(np.uint64)
            for k, part in enumerate(groups):
                yield pa.RecordBatch.from_arrays([pa.array(_keys(k, part_values(prints, part)))], names=["key"])

    held = distinct.select("print").mapInArrow(valued, "key long").groupBy("key").agg(F.count("*").alias("n"))
    common = held.where(F.col("n") * COMMON > n * number).collect()  # fewer than COMMON rows
    values, counts = [], []
    for k in range(number):
        mine = sorted((r["key"] & (1 << 40) - 1, r["n"]) for r in common if r["key"] >> 40 == k)
        values.append(np.array([v for v, _ in mine], np.uint64))
        counts.append(np.array([c for _, c in mine], np.int64))
    return Layout(groups, tuple(values), tuple(counts), n, radius)


def similar_prints(distinct: DataFrame, radius: int = 3, parts: int | None = None) -> DataFrame:
    """``node`` and ``root`` of the linked fingerprints of ``distinct`` (column ``print``, no repeats)."""
    ship(distinct.sparkSession)
    layout = _layout(distinct, distinct.count(), radius, parts)
    signed = stage(distinct.select("print").mapInArrow(_sign(layout), "key long, kind byte, print long"), "simhash-signed")
    dealt = _dealt(signed).repartition("cell").sortWithinPartitions("cell")
    links = stage(dealt.mapInArrow(_meet(radius), "u long, v long"), "simhash-links")
    return components(links, "simhash-roots")


def simhash_components(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 3, radius: int = 3, parts: int | None = None
) -> DataFrame:
    """``id``, ``print`` (long) and ``component`` (smallest id reachable) of each row of ``df``."""
    made = per_row(_fingerprints(width), "long")
    rows = stage(df.select(F.col(f"`{id_col}`").alias("id"), made(arrays.text_column(text)).alias("print")), "simhash-rows")
    distinct = stage(rows.groupBy("print").agg(F.min("id").alias("least"), F.count("*").alias("n")), "simhash-distinct")
    roots = similar_prints(distinct, radius, parts)
    named = distinct.join(roots, distinct["print"] == roots["node"], "left").select("print", "least", "n", F.coalesce("root", "print").alias("root"), "node")
    named = stage(named, "simhash-named")
    linked = named.select("root").where("node IS NOT NULL").distinct().withColumnRenamed("root", "some")
    shared = named.join(linked, named["root"] == linked["some"], "left").where("n > 1 OR some IS NOT NULL")
    least = shared.groupBy("root").agg(F.min("least").alias("component"))
    shared = shared.join(least, "root").select("print", F.struct("component").alias("found"))
    out = rows.join(broadcast_if_small(stage(shared, "simhash-shared")), "print", "left")
    return out.select("id", "print", F.when(F.col("found").isNull(), F.col("id")).otherwise(F.col("found.component")).alias("component"))
