"""Exact Jaccard self-join of shingle sets by PartEnum signatures.

A document is the set of its distinct word shingles (64-bit keys). Sizes are cut into
bands so that two sets that link lie in one band or in neighbouring ones. For each
band the feature domain is dealt into partitions, more than half as many as two linked
sets of that band can differ by elements, and each partition into three parts. So
there is a partition in which two linked sets differ by one element at most, and they
agree on two of its parts; the key of a set's share of two parts of a partition is a
signature. A set signs in its own band and, if it may link with a larger set, in the
next one. Bands in which linked sets are equal need no signature.

Where three parts of a partition would hold fewer than four elements each (thresholds
below 85 %), partitions are not cut: there is one more than two linked sets can differ by
elements, the subsets are single partitions, and the share of one is a signature. That
takes fewer signatures, of fewer elements each; so that these are not those that many
documents hold, the shingles of common passages are all dealt to one partition (any
deal of the domain is right, the counts behind this one are kept to a bounded size).

Two sets may agree only where both are empty. A band has partitions to spare; a set
with empty shares in more partitions than that signs again under another deal of the
domain, as often as needed (both sets of a pair that could be missed do so). Uncut
bands have the spare that makes the expected number of signatures least.

Equal sets are one node from the start. Signatures are met in one sorted shuffle:
each member is paired with the group's first member, all pairs are taken among its
first ``SMALL`` members, and pairs are verified on the sets. In
larger groups only the members outside the group's main component are still open;
they are compared with the members in blocks, and a block yields at most one link
between an open member and a component. So no link between two components is lost
and no group is expanded into pairs.

Each set carries the parities of its elements over 512 hashed places. Two sets differ
by at least as many elements as their parities differ in places, so pairs that cannot
link are dropped inside the joins that would emit them, before any set is sent. Sets of
more elements than places carry parities over as many places as they have elements too;
of two such sets the wider parities are folded to the narrower ones.

Nodes are 64-bit keys of whole sets, shingles 64-bit keys of words.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache, reduce
from math import comb, exp
from statistics import NormalDist
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.frames import components, per_row, ship, stage
from martloom.session import broadcast_if_small

SMALL = 16
FEW_PAIRS = 4096
BLOCK = 256
CELL_ELEMENTS = 1 << 17
DEALS = 8
HELD = 1 << 16  # counters of a task that looks for common shingles
SHARE = 256
COMMON = 4096
PARITY = [f"o{i}" for i in range(8)]
NARROW = 64 * len(PARITY)
NODE_FIELDS = ", ".join(f"{c} long" for c in ("n_shingles", "node", *PARITY)) + ", wide binary"


class Bands(NamedTuple):
    top: np.ndarray  # upper size of each band
    parts: np.ndarray  # its number of partitions, 0 where linked sets are equal
    spare: np.ndarray  # how many of them may be empty in a set
    cut: int  # parts of a partition


def _again(parts: int, empty: float, spare: int) -> float:
    """Chance that more than ``spare`` of ``parts`` partitions are empty."""
    if parts > 60:
        spread = NormalDist(parts * empty, max(1e-9, (parts * empty * (1 - empty)) ** 0.5))
        return 1 - spread.cdf(spare + 0.5)
    return max(0.0, 1 - sum(comb(parts, k) * empty**k * (1 - empty) ** (parts - k) for k in range(spare + 1)))


def _least_spare(base: int, smallest: int, top: int) -> int:
    """The spare partitions of an uncut band with the fewest expected signatures over its sizes."""
    sizes = [smallest + (top - smallest) * k / 4 for k in range(5)]

    def expected(spare: int) -> float:
        parts = base + spare
        often = [min(0.999, _again(parts, exp(-n / parts), spare)) for n in sizes]
        return parts * sum((1 - t**DEALS) / (1 - t) / n for t, n in zip(often, sizes, strict=True))

    return min(range(0, base // 2 + 2, max(1, base // 256)), key=expected)


@cache
def bands(percent: int, doublings: int) -> Bands:
    """Bands up to a size of 2 to the ``doublings`` and one more."""
    cut = 3 if (100 + percent) >= 12 * (100 - percent) else 1
    top, low = [], 1
    while not top or top[-1] < 1 << doublings or len(top) < 2:
        high = max(low, low * 5 // 4 if cut > 1 else low * 7 // 5, low * 100 // percent)
        top.append(high)
        low = high + 1
    top = np.array(top, np.int64)
    apart = 2 * top * (100 - percent) // (100 + percent)
    if cut > 1:
        parts = apart // 2 + 1
        spare = parts // 32
    else:
        parts = apart + 1
        # sets of the band before that may link with larger ones sign here too
        smallest = np.maximum(1, np.concatenate([[1], top[:-1]]) * percent // 100)
        spare = np.array([_least_spare(int(p), int(n), int(t)) for p, n, t in zip(parts, smallest, top, strict=True)], np.int64)
    return Bands(top, np.where(apart > 0, parts + spare, 0), spare, cut)


def sets_of(block: arrays.Block, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle keys of each row, row by row in order, and the row sizes."""
    found = arrays.words(block)
    keys = arrays.word_keys(block, found, fold=True)
    rows = len(block.at) - 1
    size = np.maximum(found.count - width + 1, np.minimum(found.count, 1))
    out = np.empty(int(size.sum()), np.uint64)
    at = np.concatenate([[0], np.cumsum(size)])
    out[np.repeat(found.count >= width, size)] = arrays.shingle_keys(keys, width)[arrays.within_rows(found, width)]
    for n in range(1, width):
        short = np.flatnonzero(found.count == n)
        if len(short):
            runs = arrays.shingle_keys(keys, n)[found.first[short]]
            out[at[short]] = arrays.mix(runs + np.uint64(n))
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a > 1:
            out[a:b].sort()
    row = np.repeat(np.arange(rows), size)
    new = np.ones(len(out), bool)
    new[1:] = (out[1:] != out[:-1]) | (row[1:] != row[:-1])
    return out[new], np.bincount(row[new], minlength=rows)


def nodes_of(elements: np.ndarray, size: np.ndarray) -> np.ndarray:
    """One key for each row's whole set; 0 for the empty set."""
    at = np.concatenate([[0], np.cumsum(size)])
    spread = np.concatenate([[np.uint64(0)], np.cumsum(arrays.mix(elements ^ np.uint64(0x5851F42D4C957F2D)), dtype=np.uint64)])
    key = arrays.mix(spread[at[1:]] - spread[at[:-1]] + size.astype(np.uint64))
    return np.where(size > 0, key, np.uint64(0)).view(np.int64)


def parities_of(elements: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Parities of each row's elements over the hashed places, packed into 64-bit columns."""
    bits = 64 * len(PARITY)
    place = (arrays.mix(elements ^ np.uint64(0x8EBC6AF09C88C6E3)) >> np.uint64(32)).astype(np.int64) % bits
    at = np.concatenate([[0], np.cumsum(size)])
    out = np.zeros((len(size), len(PARITY)), np.int64)
    for low in range(0, len(size), 1024):
        n = size[low : low + 1024]
        cell = np.repeat(np.arange(len(n)), n) * bits + place[at[low] : at[low + len(n)]]
        odd = (np.bincount(cell, minlength=len(n) * bits) & 1).astype(np.uint8).reshape(len(n), bits)
        out[low : low + len(n)] = np.packbits(odd, axis=1).view(np.int64)
    return out


def wide_parities_of(elements: np.ndarray, size: np.ndarray) -> list[bytes | None]:
    """Parities over a power of two of places, not fewer than a row's elements; None for rows
    that the narrow parities are enough for."""
    hashed = arrays.mix(elements ^ np.uint64(0x2545F4914F6CDD1D))
    out: list[bytes | None] = [None] * len(size)
    at = np.concatenate([[0], np.cumsum(size)])
    for k in np.flatnonzero(size > NARROW).tolist():
        bits = 1 << (int(size[k]) - 1).bit_length()
        odd = np.bincount((hashed[at[k] : at[k + 1]] & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
        out[k] = np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()
    return out


def parities_apart(x: bytes, y: bytes) -> int:
    """In how many places parities differ, the wider ones folded first."""
    if len(x) > len(y):
        x, y = y, x
    a, b, bits = int.from_bytes(x, "little"), int.from_bytes(y, "little"), 8 * len(y)
    while bits > 8 * len(x):
        bits //= 2
        b = (b >> bits) ^ (b & ((1 << bits) - 1))
    return (a ^ b).bit_count()


def signatures(elements: np.ndarray, size: np.ndarray, percent: int, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows and signatures of the sets of a block; ``common`` has shingles of many sets, in order."""
    top, parts, spare, cut = bands(percent, (int(size.max(initial=1)) * 2).bit_length())
    at = np.concatenate([[0], np.cumsum(size)])
    own = np.searchsorted(top, size)
    rows = np.flatnonzero(size > 0)
    next_too = rows[size[rows] * 100 // percent > top[own[rows]]]
    row = np.concatenate([rows, next_too])
    band = np.concatenate([own[rows], own[next_too] + 1])
    out_row, out_key = [], []
    signs = parts[band] > 0
    row, band = row[signs], band[signs]
    often = np.zeros(len(elements), bool)
    if cut == 1 and common is not None and len(common):
        often = common[np.minimum(np.searchsorted(common, elements), len(common) - 1)] == elements
    subsets = ((0, 1), (0, 2), (1, 2)) if cut == 3 else ((0,),)
    for deal in range(DEALS):
        if not len(row):
            break
        n = size[row]
        first = np.concatenate([[0], np.cumsum(n)])
        pick = np.arange(first[-1]) - np.repeat(first[:-1] - at[row], n)
        mixed = arrays.mix(elements[pick] ^ np.uint64(0xD6E8FEB86659FD93 * (deal + 1) % (1 << 64)))
        count = parts[band]
        base = np.concatenate([[0], np.cumsum(count)])
        part = ((mixed >> np.uint64(32)) * np.repeat(count, n).astype(np.uint64)) >> np.uint64(32)
        part[often[pick]] = deal % 2
        cell = np.repeat(base[:-1], n) + part.astype(np.int64)
        if cut > 1:
            cell = cell * cut + ((mixed & np.uint64(0xFFFFFFFF)) % np.uint64(cut)).astype(np.int64)
        share = arrays.mix(mixed)
        low = np.bincount(cell, (share & np.uint64(0xFFFFFFFF)).astype(np.float64), cut * base[-1]).astype(np.uint64)
        high = np.bincount(cell, (share >> np.uint64(32)).astype(np.float64), cut * base[-1]).astype(np.uint64)
        total = (low + (high << np.uint64(32))).reshape(-1, cut)
        filled = np.bincount(cell, minlength=cut * base[-1]).reshape(-1, cut) > 0
        owner = np.repeat(np.arange(len(row)), count)
        place = np.arange(base[-1]) - np.repeat(base[:-1], count)
        tag = (np.repeat(band, count) * DEALS + deal).astype(np.uint64) << np.uint64(32) | place.astype(np.uint64)
        poor = np.zeros(len(owner), bool)
        for k, some in enumerate(subsets):
            say = filled[:, some].any(axis=1)
            poor |= ~say
            say |= deal == DEALS - 1
            key = arrays.mix(total[:, some].sum(axis=1, dtype=np.uint64) ^ arrays.mix(tag * np.uint64(3) + np.uint64(k)))
            out_row.append(row[owner[say]])
            out_key.append(key[say])
        again = np.bincount(owner[poor], minlength=len(row)) > spare[band]
        row, band = row[again], band[again]
    if not out_row:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(out_row), np.concatenate(out_key).view(np.int64)


def _counted(width: int):
    """Shingles of many texts of a task with lower bounds of their number of texts.

    Frequent items in bounded space: over ``HELD`` counters, the smallest kept one is
    taken off all.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for block in arrays.blocks(batch.column(0)):
                elements, _ = sets_of(block, width)
                new, n = np.unique(elements, return_counts=True)
                keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
                times = np.bincount(at, np.concatenate([times, n]), len(keys)).astype(np.int64)
                if len(keys) > HELD:
                    times = times - np.partition(times, len(times) - HELD - 1)[len(times) - HELD - 1]
                    keys, times = keys[times > 0], times[times > 0]
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(times)], names=["element", "n"])

    return counted


def common_shingles(texts: DataFrame, width: int, rows: int) -> np.ndarray:
    """Shingles that clearly more than 1/``SHARE`` of the rows hold, at most ``COMMON`` of them."""
    found = texts.mapInArrow(_counted(width), "element long, n long").where("n > 1")
    found = found.groupBy("element").agg(F.sum("n").alias("n")).where(F.col("n") * SHARE > rows)
    found = found.where("n > 16").orderBy(F.col("n").desc(), "element").limit(COMMON).collect()
    return np.sort(np.array([r["element"] for r in found], np.int64).view(np.uint64))


def _nodes(width: int):
    def nodes(column: pa.Array) -> pa.Array:
        size, key = np.zeros(len(column), np.int64), np.zeros(len(column), np.int64)
        odd = np.zeros((len(column), len(PARITY)), np.int64)
        wide: list[bytes | None] = []
        for block in arrays.blocks(column):
            elements, sizes = sets_of(block, width)
            rows = slice(block.first, block.first + len(sizes))
            size[rows], key[rows], odd[rows] = sizes, nodes_of(elements, sizes), parities_of(elements, sizes)
            wide += wide_parities_of(elements, sizes)
        fields = [pa.array(f) for f in (size, key, *(np.ascontiguousarray(o) for o in odd.T))]
        return pa.StructArray.from_arrays([*fields, pa.array(wide, pa.binary())], names=["n_shingles", "node", *PARITY, "wide"])

    return nodes


def _sign(width: int, percent: int, common: np.ndarray | None = None):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()  # sets this task has signed; as many as it has rows at most
        for batch in batches:
            for block in arrays.blocks(batch.column(0)):
                elements, size = sets_of(block, width)
                node = nodes_of(elements, size)
                fresh = np.zeros(len(size), bool)
                for i, key in enumerate(node.tolist()):
                    if key and key not in seen:
                        seen.add(key)
                        fresh[i] = True
                keep = np.repeat(fresh, size)
                row, sig = signatures(elements[keep], size[fresh], percent, common)
                yield pa.RecordBatch.from_arrays([pa.array(sig), pa.array(node[fresh][row])], names=["sig", "node"])

    return sign


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (sig, node): pairs (``a`` > or < ``b``) of kind 0 and members of
    large groups, (sig, node), of kind 1. Keeps ``SMALL`` rows between batches."""
    sig, node, place, pivot = (np.zeros(0, np.int64) for _ in range(4))
    for batch in batches:
        s, x = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(s):
            continue
        same = np.zeros(len(s), bool)
        same[1:] = (s[1:] == s[:-1]) & (x[1:] == x[:-1])
        same[0] = len(sig) > 0 and sig[-1] == s[0] and node[-1] == x[0]
        s, x = s[~same], x[~same]
        if not len(s):
            continue
        opens = np.ones(len(s), bool)
        opens[1:] = s[1:] != s[:-1]
        carried = len(sig) > 0 and sig[-1] == s[0]
        opens[0] = not carried
        start = np.maximum.accumulate(np.where(opens, np.arange(len(s)), -1))
        p = np.arange(len(s)) - start
        v = x[np.maximum(start, 0)]
        if carried:
            mine = start < 0
            p[mine] = np.arange(mine.sum()) + place[-1] + 1
            v[mine] = pivot[-1]
        k = len(sig)
        sig, node, place, pivot = (np.concatenate(z) for z in ((sig, s), (node, x), (place, p), (pivot, v)))
        new = np.arange(k, len(sig))
        left, right = [], []
        for back in range(1, SMALL):
            mine = new[(place[new] >= back) & (place[new] < SMALL)]
            if not len(mine):
                break
            left.append(node[mine])
            right.append(node[mine - back])
        far = new[place[new] >= SMALL]
        left.append(node[far])
        right.append(pivot[far])
        many = new[place[new] == SMALL]
        held = np.concatenate([far, (many[:, None] - np.arange(1, SMALL + 1)).ravel()]) if len(many) else far
        a, b = np.concatenate(left), np.concatenate(right)
        a, b = np.minimum(a, b), np.maximum(a, b)
        if len(a) + len(held):
            kind = np.concatenate([np.zeros(len(a), np.int8), np.ones(len(held), np.int8)])
            out = [kind, np.concatenate([a, sig[held]]), np.concatenate([b, node[held]])]
            yield pa.RecordBatch.from_arrays([pa.array(z) for z in out], names=["kind", "a", "b"])
        sig, node, place, pivot = (z[-SMALL - 1 :] for z in (sig, node, place, pivot))


def _verify(percent: int):
    def verify(group: pa.Table) -> pa.Table:
        sets, pairs = {}, []
        for a, b, s in zip(group["a"].to_pylist(), group["b"].to_pylist(), group["elements"], strict=True):
            if s.is_valid:
                sets[a] = s.values.to_numpy()
            else:
                pairs.append((a, b))
        linked = []
        for a, b in pairs:
            x, y = sets[a], sets[b]
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = len(np.intersect1d(x, y, assume_unique=True))
                if 100 * both >= percent * (len(x) + len(y) - both):
                    linked.append((a, b))
        u, v = zip(*linked, strict=True) if linked else ((), ())
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return verify


def _open_links(percent: int):
    def open_links(group: pa.Table) -> pa.Table:
        """Links of open members with members of other components, in one block."""
        outside = np.array(group["outside"].to_pylist(), bool)
        node, root = group["node"].to_numpy(), group["root"].to_numpy()
        lists = group["elements"].combine_chunks()
        if isinstance(lists, pa.ChunkedArray):
            lists = pa.concat_arrays(lists.chunks)
        flat, size = lists.flatten().to_numpy(), lists.value_lengths().to_numpy().astype(np.int64)
        row = np.repeat(np.arange(len(size)), size)
        out, ins = np.flatnonzero(outside), np.flatnonzero(~outside)
        spot = np.empty(len(size), np.int64)
        spot[out], spot[ins] = np.arange(len(out)), np.arange(len(ins))
        keys, column = np.unique(flat, return_inverse=True)
        useful = np.intersect1d(column[outside[row]], column[~outside[row]])
        rank = np.full(len(keys), -1, np.int64)
        rank[useful] = np.arange(len(useful))
        both = np.zeros((len(out), len(ins)), np.float32)
        at = rank[column]
        for low in range(0, len(useful), 4096):
            wide = min(4096, len(useful) - low)
            hit = (at >= low) & (at < low + wide)
            x, y = np.zeros((len(out), wide), np.float32), np.zeros((len(ins), wide), np.float32)
            h = hit & outside[row]
            x[spot[row[h]], at[h] - low] = 1
            h = hit & ~outside[row]
            y[spot[row[h]], at[h] - low] = 1
            both += x @ y.T
        both = both.astype(np.int64)
        union = size[out][:, None] + size[ins][None, :] - both
        i, j = np.nonzero((100 * both >= percent * union) & (root[out][:, None] != root[ins][None, :]))
        links = {(int(node[out[p]]), int(root[ins[q]])): int(node[ins[q]]) for p, q in zip(i.tolist(), j.tolist(), strict=True)}
        return pa.table({"u": pa.array([u for u, _ in links], pa.int64()), "v": pa.array(list(links.values()), pa.int64())})

    return open_links


def _elements(width: int):
    def elements(column: pa.Array) -> pa.Array:
        parts, size = [], np.zeros(len(column), np.int64)
        for block in arrays.blocks(column):
            found, sizes = sets_of(block, width)
            parts.append(found)
            size[block.first : block.first + len(sizes)] = sizes
        at = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
        return pa.ListArray.from_arrays(pa.array(at), pa.array(flat.view(np.int64)))

    return elements


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Verified pairs. Nodes near each other share cells of bounded size, so a set is
    sent once to a cell and not once for each pair."""
    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("other")).union(pairs.select("b", "a"))
    near = ends.groupBy("node").agg(F.least("node", F.min("other")).alias("near"))
    near = near.join(sets.select("node", F.size("elements").cast("long").alias("n")), "node")
    room = near.groupBy("near").agg(F.ceil(F.sum("n") / CELL_ELEMENTS).alias("cells"))
    near = near.join(room, "near").select("node", F.xxhash64("near", F.pmod(F.xxhash64("node"), "cells")).alias("home"))
    near = stage(near, "part-enum-homes")
    placed = pairs.join(near.select(F.col("node").alias("a"), F.col("home").alias("ha")), "a")
    placed = placed.join(near.select(F.col("node").alias("b"), F.col("home").alias("hb")), "b")
    placed = stage(placed.select("a", "b", F.xxhash64("ha", "hb").alias("cell")), "part-enum-placed")
    sent = placed.select("cell", F.col("a").alias("node")).union(placed.select("cell", "b")).distinct()
    sent = sets.join(broadcast_if_small(stage(sent, "part-enum-sent")), "node").select("cell", F.col("node").alias("a"), F.lit(None).cast("long").alias("b"), "elements")
    rows = placed.select("cell", "a", "b", F.lit(None).cast("array<long>").alias("elements")).union(sent)
    return rows.groupBy("cell").applyInArrow(_verify(percent), "u long, v long")


def _may_link(percent: int) -> Column:
    """Sizes ``x_n``, ``y_n`` and parities of two sets allow a link."""
    apart = reduce(lambda p, q: p + q, (F.bit_count(F.col(f"x_{o}").bitwiseXOR(F.col(f"y_{o}"))) for o in PARITY))
    sizes = 100 * F.least("x_n", "y_n") >= percent * F.greatest("x_n", "y_n")
    return sizes & ((100 + percent) * apart <= (100 - percent) * (F.col("x_n") + F.col("y_n")))


def _side(nodes: DataFrame, key: str, mark: str) -> DataFrame:
    """Node (as ``key``), size and parities under names that begin with ``mark``."""
    return nodes.select(F.col("node").alias(key), *[F.col(c).alias(f"{mark}_{c}") for c in ("n", *PARITY)])


def _fitting(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and parities allow a link."""
    pairs = pairs.join(_side(nodes, "a", "x"), "a").join(_side(nodes, "b", "y"), "b")
    return pairs.where(_may_link(percent)).select("a", "b")


def _apart(percent: int):
    def apart(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs of large sets (a, b, x, y, sum of sizes) whose wide parities allow a link."""
        for batch in batches:
            rows = zip(*(batch.column(k).to_pylist() for k in (2, 3, 4)), strict=True)
            keep = [(100 + percent) * parities_apart(x, y) <= (100 - percent) * n for x, y, n in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return apart


def _widely_fitting(pairs: DataFrame, wide: DataFrame, percent: int) -> DataFrame:
    """The pairs whose wide parities allow a link, where both sets have them."""
    side = broadcast_if_small(wide)
    left = side.select(F.col("node").alias("a"), F.col("wide").alias("x"), F.col("n").alias("xn"))
    right = side.select(F.col("node").alias("b"), F.col("wide").alias("y"), F.col("n").alias("yn"))
    both = stage(pairs.join(left, "a", "left").join(right, "b", "left").select("a", "b", "x", "y", (F.col("xn") + F.col("yn")).alias("n")), "part-enum-wide")
    large = both.where("n IS NOT NULL").mapInArrow(_apart(percent), "a long, b long")
    return both.where("n IS NULL").select("a", "b").union(large)


def _mains(members: DataFrame) -> DataFrame:
    """Main component, its members and all members of each group of several components."""
    shares = members.groupBy("sig", "root").agg(F.count("*").alias("k"))
    groups = shares.groupBy("sig").agg(
        F.max_by("root", F.struct("k", "root")).alias("main"), F.max("k").alias("most"), F.sum("k").alias("g")
    )
    return groups.where("most < g")


def _gathered(wide: DataFrame) -> DataFrame:
    """Groups that overlap put together where that takes fewer comparisons.

    Near copies meet in many groups of nearly the same members; one block-wise pass
    over their union looks at each pair once.
    """
    heads = wide.groupBy("sig").agg(F.min("node").alias("head"), F.first("g").alias("g"), F.first("most").alias("most"))
    heads = stage(heads, "part-enum-heads")
    edges = wide.select("sig", "node").join(heads, "sig").select(F.col("node").alias("u"), F.col("head").alias("v"))
    roots = components(edges, "part-enum-unions")
    heads = heads.join(roots, heads["head"] == roots["node"], "left").withColumn("union", F.coalesce("root", "head"))
    whole = wide.select("sig", "node", F.col("root").alias("r")).join(heads.select("sig", "union"), "sig")
    whole = stage(whole.select(F.col("union").alias("sig"), "node", F.col("r").alias("root")).distinct(), "part-enum-wholes")
    cost = F.col("g") * (F.col("g") - F.col("most"))
    apart = heads.groupBy("union").agg(F.sum(cost).alias("apart"))
    together = _mains(whole).withColumn("together", cost)
    better = stage(
        together.join(apart, together["sig"] == apart["union"]).where("together <= apart").select("union", "main", "most", "g"),
        "part-enum-unions",
    )
    own = heads.select("sig", "union").join(better.select("union"), "union", "left_anti").select("sig")
    single = wide.join(own, "sig").select("sig", "node", "root", "most", "g", "outside")
    joint = whole.join(better, whole["sig"] == better["union"]).withColumn("outside", F.col("root") != F.col("main"))
    return single.unionByName(joint.select("sig", "node", "root", "most", "g", "outside"))


def _open(
    members: DataFrame, roots: DataFrame, nodes: DataFrame, wide_odd: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int
) -> DataFrame:
    """Links that large groups still have between their open members and the rest.

    Where these are up to ``FEW_PAIRS`` pairs, a pair is looked at once for all its
    groups; larger groups are compared block by block.
    """
    members = members.join(roots, "node", "left").select("sig", "node", F.coalesce("root", "node").alias("root"))
    members = stage(members, "part-enum-members")
    groups = _mains(members).withColumn("few", F.col("g") * (F.col("g") - F.col("most")) <= FEW_PAIRS)
    wide = members.join(groups, "sig").withColumn("outside", F.col("root") != F.col("main"))
    wide = stage(wide, "part-enum-open")

    left = wide.where("few AND outside").select("sig", F.col("node").alias("u"), F.col("root").alias("ru"))
    right = wide.where("few").select("sig", F.col("node").alias("v"), F.col("root").alias("rv"))
    left, right = left.join(_side(nodes, "u", "x"), "u"), right.join(_side(nodes, "v", "y"), "v")
    near = left.join(right, "sig").where((F.col("ru") != F.col("rv")) & _may_link(percent))
    near = near.select(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b")).distinct()
    near = stage(_widely_fitting(near.join(pairs, ["a", "b"], "left_anti"), wide_odd, percent), "part-enum-near")
    found = _links(near, sets, percent)

    many = _gathered(wide.where("NOT few"))
    many = many.withColumn("ob", F.ceil((F.col("g") - F.col("most")) / BLOCK)).withColumn("mb", F.ceil(F.col("g") / BLOCK))
    slot = F.xxhash64("node")
    as_member = many.select(
        "sig", "node", "root", F.lit(False).alias("outside"), F.pmod(slot, "mb").alias("m"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("ob") - 1)).alias("o"),
    )
    as_open = many.where("outside").select(
        "sig", "node", "root", F.lit(True).alias("outside"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("mb") - 1)).alias("m"), F.pmod(slot, "ob").alias("o"),
    )
    rows = as_member.unionByName(as_open).withColumn("cell", F.xxhash64("sig", "m", "o"))
    rows = stage(rows.select("cell", "node", "root", "outside"), "part-enum-cells")
    rows = sets.join(broadcast_if_small(rows), "node").select("cell", "node", "root", "outside", "elements")
    return found.union(rows.groupBy("cell").applyInArrow(_open_links(percent), "u long, v long"))


def shingle_sets(df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 4) -> DataFrame:
    """``id``, ``n_shingles``, ``node`` (key of the set, 0 for the empty set) and the set's
    parities of each row."""
    made = per_row(_nodes(width), NODE_FIELDS)
    rows = df.select(F.col(f"`{id_col}`").alias("id"), arrays.text_column(text).alias("_t"))
    return rows.select("id", made("_t").alias("_s")).select("id", "_s.*")  # with the wide parities of large sets


def similar_components(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85
) -> DataFrame:
    """``id``, ``n_shingles``, ``component`` (smallest id reachable) of each row of ``df``.

    Sets link when 100 * intersection >= ``percent`` * union. Null and empty texts have
    the empty set and link with nothing: their component is their own id. Rows with
    equal sets are linked; a repeated id counts as a row each time; a null id is never
    the smallest unless all ids of the component are null. Ids are integers.
    """
    spark = df.sparkSession
    ship(spark)
    rows = stage(shingle_sets(df, id_col, text, width), "part-enum-rows")
    texts = df.select(arrays.text_column(text).alias("_t"))
    uncut = bands(percent, 1).cut == 1
    common = common_shingles(texts, width, rows.count()) if uncut else None
    signed = texts.mapInArrow(_sign(width, percent, common), "sig long, node long")
    signed = signed.repartition("sig").sortWithinPartitions("sig", "node")
    met = stage(signed.mapInArrow(_meet, "kind byte, a long, b long"), "part-enum-met")
    members = met.where("kind = 1").select(F.col("a").alias("sig"), F.col("b").alias("node"))
    nodes = rows.where("node <> 0").groupBy("node").agg(
        F.min("id").alias("least"), F.max("n_shingles").alias("n"), *[F.max(o).alias(o) for o in PARITY]
    )
    nodes = stage(nodes, "part-enum-nodes")
    wide = rows.where("wide IS NOT NULL").select("node", "wide", F.col("n_shingles").alias("n")).dropDuplicates(["node"])
    wide = stage(wide, "part-enum-parities")
    pairs = _fitting(met.where("kind = 0").select("a", "b").distinct(), nodes, percent)
    pairs = stage(_widely_fitting(pairs, wide, percent), "part-enum-pairs")

    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).union(members.select("node")).distinct()
    carriers = nodes.join(wanted, "node").select(F.col("least").alias("_id"), F.col("node").alias("_node"))
    carriers = stage(carriers, "part-enum-carriers")
    chosen = df.select(F.col(f"`{id_col}`").alias("_id"), arrays.text_column(text).alias("_t"))
    chosen = chosen.join(broadcast_if_small(carriers), "_id")
    taken = per_row(_elements(width), "array<long>")
    keyed = per_row(_nodes(width), NODE_FIELDS)
    sets = chosen.select("_node", keyed("_t").alias("_k"), taken("_t").alias("elements")).where("_node = _k.node")
    sets = sets.select("_node", "elements")
    lost = carriers.where("_id is null").select("_node")
    if lost.take(1):  # sets that only rows without an id have: one of these rows carries each
        texts = df.where(F.col(f"`{id_col}`").isNull()).select(arrays.text_column(text).alias("_t"))
        texts = texts.select("_t", keyed("_t")["node"].alias("_node")).join(broadcast_if_small(lost), "_node")
        texts = texts.groupBy("_node").agg(F.first("_t").alias("_t"))
        sets = sets.union(texts.select("_node", taken("_t").alias("elements")))
    sets = stage(sets.select(F.col("_node").alias("node"), "elements"), "part-enum-sets")
    if sets.count() > carriers.count():  # rows that repeat an id
        sets = stage(sets.dropDuplicates(["node"]), "part-enum-sets")

    links = stage(_links(pairs, sets, percent), "part-enum-links")
    roots = components(links, "part-enum-roots")
    more = stage(_open(members, roots, nodes, wide, pairs, sets, percent), "part-enum-more")
    edges = roots.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more)
    roots = components(edges, "part-enum-roots")

    named = stage(nodes.join(roots, "node", "left").select("node", "least", F.coalesce("root", "node").alias("root")), "part-enum-named")
    least = named.groupBy("root").agg(F.min("least").alias("component"))
    named = named.join(least, "root").select("node", "component")
    out = rows.join(named, "node", "left")
    return out.select("id", "n_shingles", F.coalesce("component", "id").alias("component"))
