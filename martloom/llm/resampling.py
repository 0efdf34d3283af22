"""Importance resampling towards a target set by hashed word runs.

A document's features are its runs of one and two words, each named by the CRC-32 of
its bytes modulo ``buckets``. A bucket's gain is the logarithm of its smoothed rate in
the target over its smoothed rate in the corpus; a document weighs the mean gain of its
features. Documents are drawn without replacement by the Gumbel trick: noise from a
hash of the id is added to the weight, and the highest scores are kept. Ranks come from
a range sort and the sizes of the earlier ranges, so no task holds all rows.

CRCs are taken over byte matrices: the distinct features of a block are grouped by
equal length into ``uint8`` matrices, all CRCs of a matrix advance column by column,
and the buckets are scattered back to the features. Features over ``WIDE`` bytes, whose
matrices would hold hardly a row, are summed one by one, with the same values.

Words are runs of ASCII letters and digits and of all other code points; A-Z count as
a-z. A null or empty text has no feature, weight 0 and is never drawn. Repeated rows are
scored and ranked each time; equal scores fall to the smaller id, null ids come last.
Input columns named like an output are replaced. Empty tables give no rows; with an
empty target all gains follow from the smoothing alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.frames import clear, per_row, ship, stage

MADE = ("n_features", "weight", "score", "rank")
WIDE = 64
POLYNOMIAL = 0xEDB88320  # of CRC-32, bits reversed


@dataclass(frozen=True)
class Draw:
    percent: int = 25  # of the documents with enough words
    least_words: int = 20
    buckets: int = 10000
    seed: int = 7


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(POLYNOMIAL) ^ (table >> 1), table >> 1).astype(np.uint32)
    return table


TABLE = _crc_table()


class Features:
    """The distinct features of a block and where they occur.

    Feature ``k`` is the bytes ``first[k] : first[k] + size[k]`` and, for a pair of
    words, a blank and the bytes from ``second[k]`` on; ``total[k]`` is its length.
    ``which`` names the feature of each occurrence, ``row`` the row it lies in.
    """

    def __init__(self, block: arrays.Block):
        data = block.data
        upper = (data >= 65) & (data <= 90)
        self.data = np.where(upper, data + 32, data).astype(np.uint8)
        found = arrays.words(block, arrays.PUNCTUATION)
        self.words = found.count
        keys = arrays.word_keys(block, found, fold=True)
        _, one, word = np.unique(keys, return_index=True, return_inverse=True)
        inside = np.flatnonzero(arrays.within_rows(found, 2))
        pair = word[inside] * np.int64(len(one)) + word[inside + 1] if len(inside) else inside
        _, two, run = np.unique(pair, return_index=True, return_inverse=True)
        two = inside[two]
        length = found.end - found.start
        self.first = found.start[np.concatenate([one, two])]
        self.size = length[np.concatenate([one, two])]
        self.second = np.concatenate([np.zeros(len(one), np.int64), found.start[two + 1]])
        self.total = np.concatenate([length[one], length[two] + 1 + length[two + 1]])
        self.which = np.concatenate([word, run + len(one)])
        self.row = np.concatenate([found.row, found.row[inside]])

    def crcs(self) -> np.ndarray:
        """The CRC-32 of each distinct feature."""
        out = np.empty(len(self.total), np.uint32)
        order = np.argsort(self.total, kind="stable")
        for group in np.split(order, np.flatnonzero(np.diff(self.total[order])) + 1):
            if not len(group):
                continue
            length = int(self.total[group[0]])
            if length > WIDE:
                out[group] = [self._one(k) for k in group]
                continue
            size, place = self.size[group], np.arange(length)[:, None]
            at = np.where(place < size, self.first[group] + place, self.second[group] + place - size - 1)
            matrix = self.data[at]  # one line per byte position
            matrix[place == size] = 32
            crc = np.full(len(group), 0xFFFFFFFF, np.uint32)
            for column in matrix:
                crc = TABLE[(crc ^ column) & np.uint32(255)] ^ (crc >> np.uint32(8))
            out[group] = ~crc
        return out

    def _one(self, k: int) -> int:
        first, size, rest = int(self.first[k]), int(self.size[k]), int(self.total[k] - self.size[k])
        crc = zlib.crc32(self.data[first : first + size])
        if rest:
            second = int(self.second[k])
            crc = zlib.crc32(self.data[second : second + rest - 1], zlib.crc32(b" ", crc))
        return crc


def _count(buckets: int):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for block in arrays.blocks(batch.column(0)):
                found = Features(block)
                times = np.bincount(found.which, minlength=len(found.total))
                total += np.bincount(found.crcs() % np.uint32(buckets), times, buckets).astype(np.int64)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    return count


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = 10000) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    ship(df.sparkSession)
    counted = df.select(arrays.text_column(text).alias("_t")).mapInArrow(_count(buckets), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # a row per bucket at most
        out[r["bucket"]] = r["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the logarithm of each bucket's rate in the target over the corpus."""
    s, t, n = corpus.astype(float), target.astype(float), float(len(corpus))
    return np.floor(1000 * np.log((t + 1) * (s.sum() + n) / ((s + 1) * (t.sum() + n)))).astype(np.int64)


def _weigh(gain: np.ndarray):
    def weigh(column: pa.Array) -> pa.Array:
        words, features, weight = (np.zeros(len(column), np.int64) for _ in range(3))
        for block in arrays.blocks(column):
            found = Features(block)
            rows = len(found.words)
            own = gain[found.crcs() % np.uint32(len(gain))]
            n = np.bincount(found.row, minlength=rows)
            total = np.bincount(found.row, own[found.which], rows).astype(np.int64)
            here = slice(block.first, block.first + rows)
            words[here], features[here], weight[here] = found.words, n, total // np.maximum(n, 1)
        return pa.StructArray.from_arrays([pa.array(x) for x in (words, features, weight)], names=["words", "features", "weight"])

    return weigh


def resampled(
    df: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text",
    draw: Draw | None = None, columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of each row (default: all) with ``n_features``, ``weight``, ``score`` and
    ``rank``, 1 for the highest score of the documents drawn, null for the others."""
    draw = draw or Draw()
    gain = gains(bucket_counts(df, text, draw.buckets), bucket_counts(target, target_text, draw.buckets))
    keep = clear(df.select(*(F.col(f"`{c}`") for c in (columns if columns is not None else df.columns))), *MADE).columns
    made = per_row(_weigh(gain), "struct<words long, features long, weight long>")
    rows = df.select(
        *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)), F.col(f"`{id_col}`").alias("id"), made(arrays.text_column(text)).alias("m")
    )
    name = F.concat(F.lit(f"{draw.seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    noise = F.conv(F.substring(F.sha2(name.cast("binary"), 256), 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((noise + 0.5) / F.lit(4294967296.0))))
    rows = rows.withColumn("score", F.col("m.weight") + noise).withColumn("at", F.monotonically_increasing_id())
    rows = stage(rows, "resampling-scores")
    enough = F.col("m.words") >= draw.least_words
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("at")]
    placed = rows.where(enough).repartitionByRange(*order).sortWithinPartitions(*order)
    # the lower 33 bits of the generated id count rows inside the partition
    placed = placed.withColumn("part", F.spark_partition_id())
    placed = stage(placed.withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "resampling-order")
    sizes = placed.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # a row per partition
    most = placed.count() * draw.percent // 100
    rank = F.col("start") + F.col("place") + 1
    placed = placed.join(F.broadcast(starts), "part").withColumn("rank", F.when(rank <= most, rank))
    every = placed.drop("part", "place", "start").unionByName(rows.where(~enough).withColumn("rank", F.lit(None).cast("long")))
    return every.select(
        *(F.col(f"c{k}").alias(c) for k, c in enumerate(keep)), F.col("m.features").alias("n_features"), F.col("m.weight").alias("weight"),
        "score", "rank",
    )
