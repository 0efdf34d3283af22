"""Byte-balanced shards of indivisible groups by Karmarkar-Karp differencing.

Documents with equal texts are a group and stay together. Groups heavier than the
mean load of a bin are items of their own, fewer than there are bins; all others meet
in bins by a hash of their text. So at most twice ``BINS`` items are left however many
documents there are, and the differencing of these items runs on their sizes alone:
the two partial partitions of largest spread are laid over each other, heaviest parts
on lightest, until one is left.

A null text weighs as an empty one and groups with it. Repeated rows are members of
their group. An empty table gives an empty result. Input columns named like an output
are replaced. A group heavier than a shard's share makes its shard as heavy as itself.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.frames import clear, running_total, stage

BINS = 8192
OVERHEAD = 16
MADE = ("size", "text_crc32", "shard", "slot")


def difference(sizes: list[int], ways: int) -> np.ndarray:
    """Part (0 to ``ways`` - 1) of each size by largest differencing."""
    n = len(sizes)
    loads = {}
    heap = []
    for i, size in enumerate(sizes):
        loads[i] = np.zeros(ways, np.int64)
        loads[i][0] = size
        heap.append((-int(size), i))
    heapq.heapify(heap)
    merges = []
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        both = loads.pop(a) + loads.pop(b)[::-1]
        order = np.argsort(-both, kind="stable")
        node = n + len(merges)
        merges.append((a, b, order))
        loads[node] = both[order] - both.min()
        heapq.heappush(heap, (-int(loads[node][0]), node))
    part = np.zeros(n, np.int64)
    label = {heap[0][1]: np.arange(ways)} if heap else {}
    for k in range(len(merges) - 1, -1, -1):
        a, b, order = merges[k]
        own = np.empty(ways, np.int64)
        own[order] = label.pop(n + k)
        label[a], label[b] = own, own[::-1]
    for i, own in label.items():
        part[i] = own[0]
    return part


def sharded(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", shards: int = 40, columns: list[str] | None = None
) -> DataFrame:
    """``columns`` of each row (default: all) with ``size`` (UTF-8 bytes + 16),
    ``text_crc32``, ``shard`` and ``slot`` (0, 1, … within the shard)."""
    spark = df.sparkSession
    keep = clear(df.select(*(F.col(f"`{c}`") for c in (columns if columns is not None else df.columns))), *MADE).columns
    body = F.coalesce(arrays.text_column(text), F.lit(""))
    rows = df.select(
        *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)), F.col(f"`{id_col}`").alias("_id"),
        (F.octet_length(body) + OVERHEAD).cast("long").alias("size"), F.crc32(body.cast("binary")).alias("text_crc32"),
        F.unhex(F.sha2(body.cast("binary"), 256)).alias("_text"),
    ).withColumn("_bin", F.pmod(F.xxhash64("_text"), F.lit(BINS)))
    if not any(c.lower() == text.lower() for c in keep):
        rows = stage(rows, "shard-sizes")
    groups = stage(rows.groupBy("_bin", "_text").agg(F.sum("size").alias("w"), F.count("*").alias("k")), "shard-groups")
    total, n = groups.agg(F.sum("w"), F.sum("k")).first()
    heavy = F.col("w") * BINS > F.lit(total or 0)
    single = groups.where(heavy).select("_bin", "_text", "w")
    binned = groups.where(~heavy).groupBy("_bin").agg(F.sum("w").alias("w")).select("_bin", F.lit(None).cast("binary").alias("_text"), "w")
    items = [tuple(r) for r in single.union(binned).collect()]  # at most 2 * BINS
    items.sort(key=lambda x: (-x[2], x[0], bytes(x[1] or b"")))
    part = difference([w for *_, w in items], shards).tolist()
    of_bin = [(b, p) for (b, t, _), p in zip(items, part, strict=True) if t is None]
    of_text = [(t, p) for (_, t, _), p in zip(items, part, strict=True) if t is not None]
    rows = rows.join(F.broadcast(spark.createDataFrame(of_bin, "_bin long, _of_bin int")), "_bin", "left")
    rows = rows.join(F.broadcast(spark.createDataFrame(of_text, "_text binary, _of_text int")), "_text", "left")
    rows = rows.withColumn("shard", F.coalesce("_of_text", "_of_bin"))
    rows = running_total(rows, "shard", ["_id", "_text"], F.lit(1).cast("long"), "slot", rows=n or 0)
    return rows.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(keep)), *MADE)
