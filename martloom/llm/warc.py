"""A deterministic, sharded WARC writer and its reader.

Pages are range-sorted by id; each task writes its range as gzip members, one per
record, and starts a new file when the compressed bytes of the current one reach the
limit. Headers, record ids and digests are made anew from the page, so a task that
runs again writes the same bytes. A file is written under a temporary name and renamed
when it is complete; the manifest lists the files of the tasks that ended. It is the
last thing to get its name in the archive, and readers open only what it lists.

Of records with equal payloads of at least ``min_bytes`` the one with the smallest page
id is a response and the others revisit it. Which page that is comes from a narrow
table that is sorted in front of the pages it concerns, so the html is shuffled once.

A null html is an empty payload, a null url a URN. A null page id is the largest and
is written without an id header. Of rows equal in id and payload the first is the response.
Other columns are not read. An empty table gives an empty manifest.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.llm.frames import ship, stage
from martloom.session import checkpoint_root
from martloom.sources import files

MANIFEST_NAME = "_manifest"
MANIFEST = "name string, records long, bytes long, sha256 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
CHUNK = 1 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


@dataclass(frozen=True)
class Archive:
    """Where and how an archive is written."""

    root: str
    roll_bytes: int = 256 << 20  # compressed bytes after which a file is closed
    min_bytes: int = 0  # smallest payload that may become a revisit
    date: str = "2024-01-01T00:00:00Z"
    level: int = 1


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    """One WARC/1.1 record; a revisit carries the HTTP head alone."""
    digest = digest_of(payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = head if revisit else head + payload
    target = "".join(c for c in url or f"urn:page:{page_id}" if c not in "\r\n")
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Target-URI", target),
        ("WARC-Date", date),
        ("WARC-Record-ID", record_id(page_id, digest)),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("WARC-Block-Digest", f"sha1:{digest_of(block)}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("X-Payload-Length", str(len(payload))),
    ]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if revisit:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("X-Refers-To-Page", str(refers_to))]
    fields.append(("Content-Length", str(len(block))))
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return text.encode() + block + b"\r\n\r\n"


class _Roll:
    """The files one task writes."""

    def __init__(self, archive: Archive, part: int):
        self.archive, self.part, self.files, self.out = archive, part, [], None
        self.fs, self.path = pa.fs.FileSystem.from_uri(archive.root)
        self.attempt = uuid.uuid4().hex

    def add(self, data: bytes) -> None:
        if self.out is None:
            self.name = f"part-{self.part:05d}-{len(self.files):05d}.warc.gz"
            self.out = self.fs.open_output_stream(f"{self.path}/.{self.name}.{self.attempt}", compression=None)
            self.hash, self.size, self.records = hashlib.sha256(), 0, 0
        squeeze = zlib.compressobj(self.archive.level, zlib.DEFLATED, 31)
        for piece in (squeeze.compress(data), squeeze.flush()):
            self.out.write(piece)
            self.hash.update(piece)
            self.size += len(piece)
        self.records += 1
        if self.size >= self.archive.roll_bytes:
            self.close()

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.fs.move(f"{self.path}/.{self.name}.{self.attempt}", f"{self.path}/{self.name}")
            self.files.append((self.name, self.records, self.size, self.hash.hexdigest()))
            self.out = None


def _write(archive: Archive):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        roll = _Roll(archive, TaskContext.get().partitionId())
        page, originals = None, {}
        for batch in batches:
            for page_id, url, html, digest, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if digest is not None:  # the response of this page's payload, sorted before the page
                    if page_id != page:
                        page, originals = page_id, {}
                    originals[digest] = refers_to
                    continue
                payload = (html or "").encode()
                own = digest_of(payload)
                first = page_id != page
                if first:
                    page, originals = page_id, {}
                seen = own in originals
                refers = originals.get(own)
                roll.add(record(page_id, url, payload, refers, seen, archive.date))
                if len(payload) >= archive.min_bytes:
                    originals.setdefault(own, page_id)
        roll.close()
        columns = list(zip(*roll.files, strict=True)) or [[], [], [], []]
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["name", "records", "bytes", "sha256"]
        )

    return write


def write_archive(pages: DataFrame, archive: Archive, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write the pages below ``archive.root``; returns the stored manifest."""
    spark = pages.sparkSession
    ship(spark)
    fs, path = pa.fs.FileSystem.from_uri(archive.root)
    fs.create_dir(path)
    key, body = F.col(f"`{page_id}`").cast("long"), F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))
    sums = pages.select(key.alias("page_id"), F.unhex(F.sha1(body.cast("binary"))).alias("d"), F.octet_length(body).alias("n"))
    sums = stage(sums.where(F.col("n") >= archive.min_bytes), "warc-digests")
    first = sums.groupBy("d").agg(F.min("page_id").alias("first"), F.count("*").alias("k")).where("k > 1")
    again = sums.join(first, "d").where("page_id > first OR (page_id IS NULL AND first IS NOT NULL)").distinct()
    notes = again.select(
        "page_id", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), _base32("d").alias("digest"),
        F.col("first").alias("refers_to"),
    )
    rows = pages.select(
        key.alias("page_id"), F.col(f"`{url}`").cast("string").alias("url"), body.alias("html"),
        F.lit(None).cast("string").alias("digest"), F.lit(None).cast("long").alias("refers_to"),
    ).unionByName(notes)
    order = F.col("page_id").asc_nulls_last()
    # rows equal in id and url are told apart by their payload
    rows = rows.repartitionByRange(order).sortWithinPartitions(order, F.col("digest").asc_nulls_last(), "url", F.xxhash64("html"), "html")
    manifest = stage(rows.mapInArrow(_write(archive), MANIFEST), "warc-manifest")
    # last of all, in one rename: an archive without its manifest is not complete
    temporary = f"{archive.root}/_{uuid.uuid4().hex}.tmp"
    manifest.write.json(temporary)
    files.move(spark, temporary, f"{archive.root}/{MANIFEST_NAME}")
    return manifest


def _base32(column: str):
    """Upper-case base32 of a 20-byte binary column: eight groups of 20 bits."""
    digits = F.hex(F.col(column))
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    out = []
    for k in range(8):
        bits = F.conv(F.substring(digits, 5 * k + 1, 5), 16, 10).cast("int")
        out += [F.substr(letters, F.shiftright(bits, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def members(stream) -> Iterator[bytes]:
    """The gzip members of a file, one at a time."""
    inflate, parts = zlib.decompressobj(31), []
    data = stream.read(CHUNK)
    while data:
        parts.append(inflate.decompress(data))
        data = inflate.unused_data
        if inflate.eof:
            yield b"".join(parts)
            inflate, parts = zlib.decompressobj(31), []
        data = data or stream.read(CHUNK)
    if parts and any(parts):
        raise ValueError("the archive ends within a record")


def parse(data: bytes) -> tuple:
    """Fields of one record; digests and lengths are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if not lines[0].startswith("WARC/") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    if fields["WARC-Block-Digest"] != f"sha1:{digest_of(block)}":
        raise ValueError(f"block digest of {fields['WARC-Record-ID']} differs")
    kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    payload = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if digest_of(payload) != digest or len(payload) != int(fields["X-Payload-Length"]):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} differs")
    number = lambda name: int(fields[name]) if name in fields else None
    return number("X-Page-ID"), fields["WARC-Target-URI"], int(fields["X-Payload-Length"]), digest, kind, number("X-Refers-To-Page"), payload


def _read(root: str, payloads: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = pa.fs.FileSystem.from_uri(root)
        names = [x.split(" ")[0] for x in RECORDS.split(", ")]
        kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary())

        def out(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with fs.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data in members(stream):
                        row = parse(data)
                        rows.append(row if payloads else (*row[:6], None))
                        held += len(data)
                        if held > 8 * CHUNK:
                            yield out(rows)
                            rows, held = [], 0
                if rows:
                    yield out(rows)

    return read


def read_archive(spark: SparkSession, root: str, manifest: DataFrame | None = None, payloads: bool = True) -> DataFrame:
    """The records of the files the archive's manifest lists; a file is read as a stream."""
    ship(spark)
    if manifest is None:
        manifest = spark.read.schema(MANIFEST).json(f"{root}/{MANIFEST_NAME}")
    many = max(1, manifest.count())
    names = manifest.select("name").repartition(min(many, 10_000))
    return names.mapInArrow(_read(root, payloads), RECORDS)


def new_archive(spark: SparkSession) -> Archive:
    """An archive in a new folder below the shared checkpoint folder."""
    return Archive(_uri(f"{checkpoint_root(spark)}/warc-{uuid.uuid4().hex}"))


def _uri(path: str) -> str:
    return path if "://" in path else f"file://{path}" if path.startswith("/") else path
