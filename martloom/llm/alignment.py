"""Alignment of the tokens of two tokenizers, and counts of the id pairs it links.

Both tokenizers cut the bytes of a blank and the text. Offsets where a token of each
ends cut the tokens into groups; all tokens of a group are linked with each other.
Groups are found by diagonal run skipping: at the current index shift the two arrays of
token ends are compared in stretches that double while they agree and halve after that,
so a one-to-one stretch is jumped in few comparisons; the irregular group behind it is
resolved by advancing the shorter side, and the shift is updated.

A text is cut before it is encoded, at single blanks between visible characters,
where neither tokenizer has a token across and both have a token's end; so no group
reaches over a cut, and encoding, alignment, id pairs and the digest's text are made once
for each different piece that a worker remembers. Memory follows ``REMEMBERED``,
``LINKED`` and the longest text.
Each row keeps its different id pairs. Their counts over all rows are one aggregate with
map-side combine. The counts are then looked up twice: those of the commonest pairs, at
most ``HOT`` of them, in every task's memory, the others by a join on the pair.

Null and empty texts, and texts that either tokenizer does not give back byte for byte,
have no tokens: all numbers are 0, the digest is ''. Strings of special tokens are
ordinary text. Each row counts as one document, repeated rows too. Input columns named
like an output are replaced.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from itertools import chain, compress, pairwise, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.frames import clear, ship, stage

FOLDER = "/opt/tokenizers"
NAMES = ("byte_bpe_50k.json", "piece_bpe_32k.model")
MADE = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
CHUNK = 1 << 18
REMEMBERED = 3 << 17  # pieces
LONGEST = 1 << 24  # characters of remembered pieces
LINKED = 1 << 23  # different id pairs of remembered pieces
JOINED = 1 << 12  # characters of pieces encoded as one text
WIDE = 1024  # links from which a group's different ids are counted before they are paired
HOT = 1 << 20
# no control character and nothing that a version of Unicode calls white space or a format mark
VISIBLE = "[^\\x00- \\x7f-\\xa0\\u1680\\u180e\\u2000-\\u206f\\u3000\\ufeff]"
CUT = re.compile(f" (?<={VISIBLE} )(?={VISIBLE})")
WHOLE = re.compile(f"(?={VISIBLE}).*(?<={VISIBLE})", re.DOTALL)


def _byte_letters() -> dict[str, int]:
    """The letter of each byte in a byte-level vocabulary: printable Latin-1 as it is, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


class Pair:
    """The two tokenizers, the bytes of their tokens and the digits of their ids."""

    def __init__(self, folder: str, names: tuple[str, str]):
        import sentencepiece
        import tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        self.first = tokenizers.Tokenizer.from_file(f"{folder}/{names[0]}")
        self.first.encode_special_tokens = True
        self.second = sentencepiece.SentencePieceProcessor(model_file=f"{folder}/{names[1]}")
        letters, entries = _byte_letters(), self.first.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, k in entries.items():
            self.bytes_a[k] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else entry.encode()
        pieces = [self.second.id_to_piece(k) for k in range(self.second.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.second.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)
        ]
        self.size_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.size_b = np.array([len(x) for x in self.bytes_b], np.int64)
        # pieces are only right if no token has a blank behind a visible character
        self.cuts = not any(re.search(f"{VISIBLE} ", x.decode(errors="replace")) for x in [*self.bytes_a, *self.bytes_b])
        most = max(len(self.bytes_a), len(self.bytes_b))
        wide = len(str(most))
        self.digits = np.zeros((most, wide + 1), np.uint8)  # the last column is for a separator
        for k in range(most):
            text = str(k).encode()
            self.digits[k, : len(text)] = list(text)

        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.length = 0
        self.whole = Grown(bool)  # do both tokenizers give the piece back
        self.a, self.b, self.in_a, self.in_b = (Lists(np.int32) for _ in range(4))
        self.keys, self.times = Lists(), Lists()  # the different id pairs of a piece and their links
        self.links = Grown()
        self.spelt: list[bytes] = []  # the groups of a piece as text
        self.again = Grown(bool)  # pieces that came up again since there was room for them

    def make_room(self) -> None:
        """Forget the pieces that did not come up again, or all if the others fill half the room."""
        was = dict(vars(self))
        kept = np.flatnonzero(self.again.all)
        some = self.again.all.tolist()
        names = list(compress(self.known, some))  # in the order of their numbers
        length = sum(map(len, names))
        full = 2 * len(names) > REMEMBERED or 2 * length > LONGEST or 2 * self.keys.sizes(kept).sum() > LINKED
        self.forget()
        if full or not names:
            return
        self.known, self.length = dict(zip(names, range(len(names)), strict=True)), length
        for name in ("a", "b", "in_a", "in_b", "keys", "times"):
            getattr(self, name).add(was[name].take(kept), was[name].sizes(kept))
        self.whole.add(was["whole"].all[kept])
        self.links.add(was["links"].all[kept])
        self.again.add(np.zeros(len(kept), bool))
        self.spelt = list(compress(was["spelt"], some))

    def pieces(self, text: str) -> list[str]:
        """The text cut at blanks that both tokenizers begin a token with; the blanks go."""
        return (CUT.split(text) if self.cuts else [text]) if text else []

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray] | None]:
        """Ids by both tokenizers, None where the bytes do not come back."""
        first = [e.ids for e in self.first.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]
        second = self.second.encode(texts, num_threads=1)
        out: list[tuple[np.ndarray, np.ndarray] | None] = []
        for text, x, y in zip(texts, first, second, strict=True):
            raw = b" " + text.encode()
            same = b"".join(map(self.bytes_a.__getitem__, x)) == raw == b"".join(map(self.bytes_b.__getitem__, y))
            out.append((np.array(x, np.int64), np.array(y, np.int64)) if same else None)
        return out

    def encode_joined(self, plain: list[str]) -> tuple[list[str], list[str], list[np.ndarray]]:
        """Pieces that begin and end with a visible character encoded as texts of about
        ``JOINED`` characters, with blanks between them that neither tokenizer reaches over:
        the pieces so encoded, those of texts that do not come back, and the ids of both sides."""
        upto = np.cumsum(np.array([len(p) + 1 for p in plain], np.int64))
        starts = np.flatnonzero(np.diff(upto // JOINED, prepend=-1)).tolist()
        some = [plain[a:b] for a, b in pairwise([*starts, len(plain)])]
        found = self.encode([" ".join(own) for own in some])
        held = [own for own, f in zip(some, found, strict=True) if f is not None]
        lost = [own for own, f in zip(some, found, strict=True) if f is None]
        ids = [np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found if f is not None)]) for k in (0, 1)]
        return list(chain.from_iterable(held)), list(chain.from_iterable(lost)), ids

    def learn(self, pieces: list[str]) -> None:
        """Encode and align pieces that are not known yet."""
        plain = [p for p in pieces if WHOLE.fullmatch(p)] if self.cuts else []
        taken = set(plain)
        plain, lost, joined = self.encode_joined(plain)
        single = [*lost, *(p for p in pieces if p not in taken)]
        found = self.encode(single)
        ends = np.cumsum(np.fromiter(map(len, map(str.encode, plain)), np.int64, len(plain)) + 1)
        sizes, ids = [], []
        for k, size in enumerate((self.size_a, self.size_b)):
            own = [0 if f is None else len(f[k]) for f in found]
            sizes.append(np.concatenate([np.diff(np.searchsorted(np.cumsum(size[joined[k]]), ends, "right"), prepend=0), np.array(own, np.int64)]))
            ids.append(np.concatenate([joined[k], *(f[k] for f in found if f is not None)]))
        a, b = ids
        upto_a, upto_b = (np.array(x, np.int64) for x in groups(np.cumsum(self.size_a[a]).tolist(), np.cumsum(self.size_b[b]).tolist()))
        many = np.diff(np.searchsorted(upto_a, np.cumsum(sizes[0]), "right"), prepend=0)
        in_a, in_b = np.diff(upto_a, prepend=0), np.diff(upto_b, prepend=0)
        row = np.repeat(np.arange(len(many)), many)
        of, keys, times = self.linked(row, a, b, in_a, in_b)
        linked = np.bincount(of, minlength=len(many))
        self.a.add(a, sizes[0])
        self.b.add(b, sizes[1])
        self.in_a.add(in_a, many)
        self.in_b.add(in_b, many)
        self.keys.add(keys, linked)
        self.times.add(times, linked)
        self.links.add(np.bincount(row, in_a * in_b, len(many)).astype(np.int64))
        self.spelt += self.spell(a, b, in_a, in_b, sizes[0] + sizes[1])
        self.whole.add(np.concatenate([np.ones(len(plain), bool), np.array([f is not None for f in found], bool)]))
        self.known.update(zip([*plain, *single], range(len(self.known), len(self.known) + len(pieces)), strict=True))
        self.again.add(np.zeros(len(pieces), bool))
        self.length += sum(map(len, pieces))

    def linked(self, row: np.ndarray, ids_a: np.ndarray, ids_b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, id pair and number of links of the different pairs of each row's groups, in order."""
        many, second = in_a * in_b, len(self.bytes_b)
        first_a, first_b = np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b
        few = np.flatnonzero(many <= WIDE)
        n = many[few]
        own = np.repeat(few, n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        a = ids_a[first_a[own] + at // in_b[own]]
        b = ids_b[first_b[own] + at % in_b[own]]
        rows, keys, times = [row[own]], [a * second + b], [np.ones(len(own), np.int64)]
        for g in np.flatnonzero(many > WIDE):
            x, nx = np.unique(ids_a[first_a[g] : first_a[g] + in_a[g]], return_counts=True)
            y, ny = np.unique(ids_b[first_b[g] : first_b[g] + in_b[g]], return_counts=True)
            keys.append((x[:, None] * second + y).ravel())
            times.append((nx[:, None] * ny).ravel())
            rows.append(np.full(len(keys[-1]), row[g]))
        return self.summed(*(np.concatenate(z) for z in (rows, keys, times)))

    def summed(self, row: np.ndarray, key: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The different id pairs of each row with the sum of their links, in order."""
        space = len(self.bytes_a) * len(self.bytes_b)
        every = row * space + key
        order = np.argsort(every)
        every = every[order]
        starts = np.flatnonzero(np.diff(every, prepend=-1))
        total = np.add.reduceat(links[order], starts) if len(starts) else np.zeros(0, np.int64)
        return every[starts] // space, every[starts] % space, total

    def spell(self, ids_a: np.ndarray, ids_b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray, tokens: np.ndarray) -> list[bytes]:
        """The groups of pieces with so many ``tokens`` (of both sides) as text."""
        before_b, upto_a = np.cumsum(in_b) - in_b, np.cumsum(in_a)
        place_a = np.arange(len(ids_a)) + np.repeat(before_b, in_a)
        place_b = np.arange(len(ids_b)) + np.repeat(upto_a, in_b)
        ids = np.empty(len(ids_a) + len(ids_b), np.int64)
        mark = np.full(len(ids), ord(","), np.uint8)
        ids[place_a], ids[place_b] = ids_a, ids_b
        mark[place_a[upto_a - 1]] = ord("|")
        mark[place_b[np.cumsum(in_b) - 1]] = ord(";")
        upto = np.cumsum(tokens)
        mark[upto[tokens > 0] - 1] = 0
        text = self.digits[ids]
        text[:, -1] = mark
        said = text != 0
        raw = text[said].tobytes()
        ends = np.concatenate([[0], np.cumsum(said.sum(axis=1))])[upto].tolist()
        return [raw[a:b] for a, b in zip([0, *ends[:-1]], ends, strict=True)]

    def looked_up(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of all texts, one after the other, and how many each text has;
        none for texts that one tokenizer does not give back."""
        if len(self.known) > REMEMBERED or self.length > LONGEST or self.keys.flat.n > LINKED:
            self.make_room()
        parts = [self.pieces(t) for t in texts]
        flat = list(chain.from_iterable(parts))
        every = dict.fromkeys(flat)  # smaller than what is known, so it is asked for each occurrence
        number = np.fromiter(map(self.known.get, every, repeat(-1)), np.int64, len(every))
        missing = number < 0
        self.again.held[number[~missing]] = True
        if missing.any():
            new = list(compress(every, missing.tolist()))
            self.learn(new)
            number[missing] = np.fromiter(map(self.known.__getitem__, new), np.int64, len(new))
        every = dict(zip(every, range(len(every)), strict=True))
        found = number[np.fromiter(map(every.__getitem__, flat), np.int64, len(flat))]
        many = np.array([len(some) for some in parts], np.int64)
        whole = self.whole.all[found]
        if whole.all():
            return found, many
        row = np.repeat(np.arange(len(texts)), many)
        broken = np.bincount(row, ~whole, len(texts)) > 0
        return found[~broken[row]], np.where(broken, 0, many)


class Grown:
    """An array that numbers are appended to."""

    def __init__(self, kind: type = np.int64) -> None:
        self.held, self.n = np.zeros(1024, kind), 0

    @property
    def all(self) -> np.ndarray:
        return self.held[: self.n]

    def add(self, more: np.ndarray) -> None:
        n = self.n + len(more)
        if n > len(self.held):
            held = np.empty(2 * n, self.held.dtype)
            held[: self.n] = self.all
            self.held = held
        self.held[self.n : n] = more
        self.n = n


class Lists:
    """Lists of numbers in one array, with those of any selection in its order."""

    def __init__(self, kind: type = np.int64) -> None:
        self.flat, self.at = Grown(kind), Grown()
        self.at.add(np.zeros(1, np.int64))

    def add(self, flat: np.ndarray, size: np.ndarray) -> None:
        self.flat.add(flat)
        self.at.add(self.at.all[-1] + np.cumsum(size))

    def sizes(self, which: np.ndarray) -> np.ndarray:
        return self.at.all[which + 1] - self.at.all[which]

    def take(self, which: np.ndarray) -> np.ndarray:
        """The numbers of the lists ``which``."""
        size = self.sizes(which)
        return self.flat.all[np.repeat(self.at.all[which] - (np.cumsum(size) - size), size) + np.arange(size.sum())]


_pairs: dict[tuple[str, tuple[str, str]], Pair] = {}


def loaded(folder: str = FOLDER, names: tuple[str, str] = NAMES) -> Pair:
    """The tokenizers, read once per worker."""
    if (folder, names) not in _pairs:
        _pairs[folder, names] = Pair(folder, names)
    return _pairs[folder, names]


def groups(a: list[int], b: list[int]) -> tuple[list[int], list[int]]:
    """How many tokens of each side lie before the end of each group.

    ``a`` and ``b`` are ascending ends with the same last value.
    """
    upto_a, upto_b = [], []
    i, shift, n, m = 0, 0, len(a), len(b)
    while i < n:
        j = i + shift
        if a[i] == b[j]:
            start, step, grows = i, 1, True
            while step:
                if i + step <= n and j + step <= m and a[i : i + step] == b[j : j + step]:
                    i += step
                    j += step
                    step = 2 * step if grows else step // 2
                else:
                    grows = False
                    step //= 2
            upto_a.extend(range(start + 1, i + 1))
            upto_b.extend(range(start + shift + 1, j + 1))
            continue
        x, y = a[i], b[j]
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i += 1
        upto_a.append(i)
        upto_b.append(j + 1)
        shift = j + 1 - i
    return upto_a, upto_b


class Aligned:
    """The groups of several texts: ids of both sides and tokens of each group."""

    def __init__(self, pair: Pair, texts: list[str]):
        self.pair = pair
        self.which, self.many = pair.looked_up(texts)
        self.lists = {"ids_a": pair.a, "ids_b": pair.b, "in_a": pair.in_a, "in_b": pair.in_b, "keys": pair.keys, "times": pair.times}
        self.spelt = pair.spelt  # also when the worker forgets
        self.row = np.repeat(np.arange(len(texts)), self.many)
        held = (*(x.sizes(self.which) for x in (pair.a, pair.b, pair.in_a)), pair.links.all[self.which])
        self.n_a, self.n_b, self.n_groups, self.n_links = (np.bincount(self.row, x, len(texts)).astype(np.int64) for x in held)

    ids_a = property(lambda self: self.lists["ids_a"].take(self.which))
    ids_b = property(lambda self: self.lists["ids_b"].take(self.which))
    in_a = property(lambda self: self.lists["in_a"].take(self.which))
    in_b = property(lambda self: self.lists["in_b"].take(self.which))

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, id pair and number of links of the different pairs of each row, in order."""
        space = len(self.spelt)
        every, often = np.unique(self.row * space + self.which, return_counts=True)
        which = every % max(1, space)
        size = self.lists["keys"].sizes(which)
        row, times = np.repeat(every // max(1, space), size), np.repeat(often, size)
        return self.pair.summed(row, self.lists["keys"].take(which), self.lists["times"].take(which) * times)

    def digests(self) -> list[str]:
        """SHA-256 of each row's groups as text, '' for rows without tokens."""
        said = list(map(self.spelt.__getitem__, self.which.tolist()))
        ends = np.cumsum(self.many).tolist()
        return [hashlib.sha256(b";".join(said[a:b])).hexdigest() if b > a else "" for a, b in zip([0, *ends[:-1]], ends, strict=True)]


def _chunks(column: pa.Array) -> Iterator[list[str]]:
    """Texts in lists of about ``CHUNK`` characters."""
    some, held = [], 0
    for value in column:
        text = value.as_py() or ""
        some.append(text)
        held += len(text)
        if held >= CHUNK:
            yield some
            some, held = [], 0
    if some:
        yield some


def _lists(values: list[np.ndarray], rows: list[np.ndarray], n: int, kind: pa.DataType) -> pa.ListArray:
    flat = np.concatenate([np.zeros(0, np.int64), *values])
    at = np.concatenate([[0], np.cumsum(np.bincount(np.concatenate([np.zeros(0, np.int64), *rows]), minlength=n))])
    return pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(flat).cast(kind))


ALIGNED = "n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<{0}>, times array<{0}>"
GROUPS = ", ids_a array<int>, ids_b array<int>, in_a array<int>, in_b array<int>"


def _align(folder: str, names: tuple[str, str], kind: pa.DataType, with_groups: bool):
    def align(column: pa.Array) -> pa.Array:
        pair, n = loaded(folder, names), len(column)
        numbers = {k: [] for k in ("n_a", "n_b", "n_groups", "n_links")}
        digests, rows, keys, times, sides, low = [], [], [], [], [[], [], [], []], 0
        for texts in _chunks(column):
            found = Aligned(pair, texts)
            for k, held in numbers.items():
                held.append(getattr(found, k))
            digests += found.digests()
            row, key, links = found.pairs()
            rows.append(row + low)
            keys.append(key)
            times.append(links)
            if with_groups:
                of = np.arange(len(texts)) + low
                for held, values, sizes in zip(
                    sides, (found.ids_a, found.ids_b, found.in_a, found.in_b), (found.n_a, found.n_b, found.n_groups, found.n_groups), strict=True
                ):
                    held.append((values, np.repeat(of, sizes)))
            low += len(texts)
        whole = [pa.array(np.concatenate([np.zeros(0, np.int64), *held])) for held in numbers.values()]
        out = [*whole, pa.array(digests, pa.string()), _lists(keys, rows, n, kind), _lists(times, rows, n, kind)]
        names_ = [*numbers, "groups_sha256", "pairs", "times"]
        if with_groups:
            out += [_lists([v for v, _ in held], [r for _, r in held], n, pa.int32()) for held in sides]
            names_ += ["ids_a", "ids_b", "in_a", "in_b"]
        return pa.StructArray.from_arrays(out, names=names_)

    return align


def _spell(kind: str, with_groups: bool) -> str:
    return ALIGNED.format(kind) + (GROUPS if with_groups else "")


def alignments(df: DataFrame, text: str = "text", folder: str = FOLDER, names: tuple[str, str] = NAMES, with_groups: bool = True) -> DataFrame:
    """The columns of ``df`` with a struct ``aligned``: numbers, digest, different id pairs
    (first id times the size of the second vocabulary plus second id) with their links,
    and, if asked for, the ids of both sides and each group's number of tokens on both."""
    ship(df.sparkSession)
    pair = loaded(folder, names)
    small = len(pair.bytes_a) * len(pair.bytes_b) < 1 << 31
    work = _align(folder, names, pa.int32() if small else pa.int64(), with_groups)

    def align(column: pa.Array) -> pa.Array:
        return work(column)

    kept = clear(df, "aligned").columns
    made = F.arrow_udf(align, _spell("int" if small else "long", with_groups))(arrays.text_column(text))
    return df.select(*(F.col(f"`{c}`") for c in kept), made.alias("aligned"))


def pair_counts(aligned: DataFrame, second: int) -> DataFrame:
    """``pair``, ``docs`` (rows that hold it linked) and ``best`` (no pair of its first id has more)."""
    counts = aligned.select(F.explode("aligned.pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("docs"))
    counts = stage(counts.withColumn("first", (F.col("pair") / second).cast("long")), "alignment-counts")
    most = counts.groupBy("first").agg(F.max("docs").alias("most"))  # a row per id of the vocabulary
    return stage(counts.join(F.broadcast(most), "first").select("pair", "docs", (F.col("docs") == F.col("most")).alias("best")), "alignment-pairs")


def _least_docs(counts: DataFrame, hot: int) -> int:
    """The smallest power of two such that at most ``hot`` pairs are in as many documents."""
    sizes = counts.groupBy(F.floor(F.log2(F.col("docs").cast("double") + 0.5)).alias("k")).agg(F.count("*").alias("n")).collect()
    by_size = sorted(((r["k"], r["n"]) for r in sizes), reverse=True)
    total, least = 0, by_size[0][0] + 1 if by_size else 0
    for k, n in by_size:
        total += n
        if total > hot:
            return 1 << least
        least = k
    return 1  # all pairs fit


def _look_up(hot):
    def look_up(pairs: pa.Array, times: pa.Array) -> pa.Array:
        known, docs, best = hot.value
        n = len(pairs)
        size = pairs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        row = np.repeat(np.arange(n), size)
        key = pairs.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        links = times.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        at = np.minimum(np.searchsorted(known, key), max(0, len(known) - 1))
        seen = known[at] == key if len(known) else np.zeros(len(key), bool)
        r, k, t = row[seen], at[seen], links[seen]
        total, firsts = np.zeros(n, np.int64), np.zeros(n, np.int64)
        np.add.at(total, r, t * docs[k])
        np.add.at(firsts, r, t * best[k])
        rest = ~seen
        return pa.StructArray.from_arrays(
            [pa.array(firsts), pa.array(total), _lists([key[rest]], [row[rest]], n, pa.int64()), _lists([links[rest]], [row[rest]], n, pa.int64())],
            names=["n_best", "count_sum", "pairs", "times"],
        )

    return look_up


def token_alignment(
    df: DataFrame, text: str = "text", folder: str = FOLDER, names: tuple[str, str] = NAMES, columns: list[str] | None = None, hot: int = HOT
) -> DataFrame:
    """``columns`` of each row (default: all) with the numbers of its alignment, ``n_best``
    (links whose pair no other pair of their first id exceeds in documents), ``count_sum``
    (documents of the pair, summed over links) and ``groups_sha256``."""
    spark = df.sparkSession
    second = len(loaded(folder, names).bytes_b)
    keep = clear(df.select(*(F.col(f"`{c}`") for c in (columns if columns is not None else df.columns))), *MADE).columns
    rows = df.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)), arrays.text_column(text).alias("t"))
    rows = alignments(rows, "t", folder, names, with_groups=False).drop("t").withColumn("at", F.monotonically_increasing_id())
    rows = stage(rows, "alignment-rows")
    counts = pair_counts(rows, second)
    least = _least_docs(counts, hot)
    common = counts.where(F.col("docs") >= least).toArrow().sort_by("pair")  # at most ``hot`` rows
    held = spark.sparkContext.broadcast(
        tuple(common[c].to_numpy().astype(np.int64) for c in ("pair", "docs")) + (common["best"].to_numpy(zero_copy_only=False).astype(np.int64),)
    )
    found = F.arrow_udf(_look_up(held), "n_best long, count_sum long, pairs array<long>, times array<long>")
    rows = rows.withColumn("found", found("aligned.pairs", "aligned.times"))
    best, total = F.col("found.n_best"), F.col("found.count_sum")
    if least > 1:
        rows = stage(rows.withColumn("aligned", F.col("aligned").dropFields("pairs", "times")), "alignment-found")
        rare = rows.select("at", F.explode(F.arrays_zip("found.pairs", "found.times")).alias("z")).select("at", "z.pairs", "z.times")
        rare = rare.join(counts.where(F.col("docs") < least), F.col("pairs") == F.col("pair"))
        rare = rare.groupBy("at").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("docs")).alias("more_sum")
        )
        rows = rows.join(rare, "at", "left")
        zero = F.lit(0).cast("long")
        best, total = best + F.coalesce("more_best", zero), total + F.coalesce("more_sum", zero)
    numbers = [F.col(f"aligned.{c}").alias(c) for c in ("n_a", "n_b", "n_groups", "n_links")]
    return rows.select(
        *(F.col(f"c{k}").alias(c) for k, c in enumerate(keep)), *numbers, best.alias("n_best"), total.alias("count_sum"),
        F.col("aligned.groups_sha256").alias("groups_sha256"),
    )
