"""Numpy helpers over the UTF-8 bytes of an Arrow text column.

Words are maximal runs of anything but blank and the controls 9 to 13. All of these
separators are single bytes and never part of a longer code point, so word borders
can be found in the bytes of a whole batch at once. A batch is walked in blocks of
about ``BLOCK`` bytes of whole rows; a row longer than that is a block of its own,
so memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
PIECE = 1 << 20

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[32, 9, 10, 11, 12, 13]] = True
# for words of letters, digits and whatever is not ASCII
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])

_rng = np.random.default_rng(20240607)
_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64)
_CODE_FOLDED = _CODE.copy()
_CODE_FOLDED[65:91] = _CODE[97:123]
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = [_powers(_BASE, PIECE), _powers(_INVERSE, PIECE)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys (the splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Block(NamedTuple):
    first: int  # row of the batch the block starts with
    data: np.ndarray  # bytes of all rows
    at: np.ndarray  # rows + 1 offsets into data


def blocks(column: pa.Array, size: int = BLOCK) -> Iterator[Block]:
    """The rows of a text column in blocks of whole rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(at, at[row] + size, "right")) - 1)
        end = min(end, n)
        yield Block(row, raw[at[row] : at[end]], at[row : end + 1] - at[row])
        row = end


class Words(NamedTuple):
    start: np.ndarray  # byte positions in the block
    end: np.ndarray
    row: np.ndarray  # row in the block
    count: np.ndarray  # words of each row
    first: np.ndarray  # index of the first word of each row


def words(block: Block, separator: np.ndarray = SEPARATOR) -> Words:
    """Borders of all words of a block; ``separator`` marks the bytes between words."""
    rows = len(block.at) - 1
    inside = ~separator[block.data]
    before = np.zeros(len(inside), bool)
    before[1:] = inside[:-1]
    begins = block.at[:-1]
    before[begins[begins < len(inside)]] = False
    after = np.zeros(len(inside), bool)
    after[:-1] = inside[1:]
    ends = block.at[1:]
    after[ends[ends > 0] - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    first = np.searchsorted(start, block.at)
    count = np.diff(first)
    return Words(start, end, np.repeat(np.arange(rows), count), count, first[:-1])


def word_keys(block: Block, found: Words, fold: bool = False) -> np.ndarray:
    """A 64-bit key of each word; with ``fold`` A-Z count as a-z.

    The key is a polynomial over the bytes, taken from running sums of pieces cut
    between words, and then mixed.
    """
    out = np.empty(len(found.start), np.uint64)
    code = _CODE_FOLDED if fold else _CODE
    i = 0
    while i < len(out):
        low = found.start[i]
        j = max(i + 1, int(np.searchsorted(found.end, low + PIECE, "right")))
        high = found.end[j - 1]
        if high - low > len(_POWERS[0]):
            up, down = _powers(_BASE, high - low), _powers(_INVERSE, high - low)
        else:
            up, down = _POWERS
        total = np.zeros(high - low + 1, np.uint64)
        np.cumsum(code[block.data[low:high]] * up[: high - low], out=total[1:])
        s, e = found.start[i:j] - low, found.end[i:j] - low
        out[i:j] = (total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


_ROLES = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(_BASE)) | np.uint64(1)


def shingle_keys(keys: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit key of each run of ``width`` words, row borders not regarded."""
    n = len(keys) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = keys[:n] * _ROLES[0]
    for k in range(1, width):
        out = out + keys[k : k + n] * _ROLES[k]
    return mix(out)


def within_rows(found: Words, width: int) -> np.ndarray:
    """Which runs of ``width`` words lie in one row."""
    n = max(0, len(found.row) - width + 1)
    return found.row[:n] == found.row[width - 1 : width - 1 + n]


def text_column(name: str = "text"):
    """The named column as text."""
    from pyspark.sql import functions as F

    return F.col(f"`{name}`").cast("string")
