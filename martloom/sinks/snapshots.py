"""Versioned tables: partitions written beside each other, one manifest swapped at the end.

A commit writes its rows into new folders ``<partition>/_version=<token>`` and then
adds a numbered manifest that says which folders make up the table. The manifest gets
its name by a rename that never overwrites. Until then readers resolve the previous
manifest, so a run that stops midway leaves the old table whole, and any number of
partitions change at once. Of two commits on the same version one is refused.

A manifest has a line per partition, never per file or row. Older versions stay
readable until ``forget`` removes them.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.sinks.writers import write_table
from martloom.sources import files
from martloom.sources.landing import literal_path

VERSION = "_version"
MANIFESTS = "_manifests"


@dataclass(frozen=True)
class Snapshot:
    """What one manifest says; version 0 is the table before its first commit."""

    version: int = 0
    partitions: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()
    schema: str = ""
    note: Mapping[str, str] = field(default_factory=dict)

    def folders(self) -> list[str]:
        return [f"{p}/{VERSION}={t}".lstrip("/") for p, tokens in self.partitions.items() for t in tokens]


def _manifest(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/{MANIFESTS}/{version:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    found = (re.fullmatch(r"(\d{12})\.json", n) for n in files.names(spark, f"{path.rstrip('/')}/{MANIFESTS}"))
    return [int(m[1]) for m in found if m]


def snapshot(spark: SparkSession, path: str, version: int | None = None) -> Snapshot:
    """The manifest of a version, by default the latest."""
    if version is None:
        version = max(versions(spark, path), default=0)
    if version == 0:
        return Snapshot()
    said = json.loads(files.read_text(spark, _manifest(path, version)))
    partitions = {p: tuple(t) for p, t in said["partitions"].items()}
    return Snapshot(version, partitions, tuple(said["partition_by"]), said["schema"], said["note"])


def before_note(spark: SparkSession, path: str, key: str, value: int) -> Snapshot:
    """The latest version whose number under ``key`` in the note is below ``value``.

    A batch that runs again so sees the table as it saw it the first time.
    """
    for version in sorted(versions(spark, path), reverse=True):
        found = snapshot(spark, path, version)
        if int(found.note.get(key, -1)) < value:
            return found
    return Snapshot()


def read_snapshot(
    spark: SparkSession, path: str, version: int | Snapshot | None = None, only: Iterable[str] | None = None
) -> DataFrame | None:
    """The rows of a version, or of its partitions named in ``only``; None before the first commit."""
    found = version if isinstance(version, Snapshot) else snapshot(spark, path, version)
    if not found.schema:
        return None
    schema = T.StructType.fromJson(json.loads(found.schema))
    wanted = set(only) if only is not None else None
    kept = Snapshot(found.version, {p: t for p, t in found.partitions.items() if wanted is None or p in wanted})
    folders = [literal_path(f"{path.rstrip('/')}/{f}") for f in kept.folders()]
    if not folders:
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField(VERSION, T.StringType())]))
    return reader.option("basePath", path.rstrip("/")).parquet(*folders).drop(VERSION)


def commit(
    spark: SparkSession,
    path: str,
    df: DataFrame,
    partition_by: Sequence[str] = (),
    mode: str = "replace",
    note: Mapping[str, str] | None = None,
    base: Snapshot | None = None,
    emptied: Iterable[str] = (),
    rewritten: Iterable[str] | None = None,
) -> Snapshot:
    """Write ``df`` and make it part of the table.

    ``replace`` swaps the partitions ``df`` has rows for, ``append`` adds to them,
    ``overwrite`` swaps the whole table. With ``rewritten`` the partitions named there
    are swapped and all others appended to. Partitions in ``emptied`` go even without new rows.
    ``base`` is the version the work was based on (default: the latest).
    """
    base = base if base is not None else snapshot(spark, path)
    root = files.qualified(spark, path).rstrip("/")
    token = uuid.uuid4().hex
    # partition values come back from folder names, so they are cast by this schema
    write_table(df.withColumn(VERSION, F.lit(token)), path, [*partition_by, VERSION])
    steps = "/".join(["*=*"] * len(partition_by) + [f"{VERSION}={token}"])
    wrote = [p.rsplit("/", 1)[0][len(root) :].strip("/") for p in files.matching(spark, f"{root}/{steps}")]
    partitions = {} if mode == "overwrite" else dict(base.partitions)
    for gone in emptied:
        partitions.pop(gone, None)
    swapped = set(rewritten) if rewritten is not None else set(wrote) if mode == "replace" else set()
    for partition in wrote:
        older = () if partition in swapped else partitions.get(partition, ())
        partitions[partition] = (*older, token)
    out = Snapshot(base.version + 1, partitions, tuple(partition_by), json.dumps(df.schema.jsonValue()), dict(note or {}))
    said = {"partitions": out.partitions, "partition_by": out.partition_by, "schema": out.schema, "note": out.note}
    files.write_new(spark, _manifest(path, out.version), json.dumps(said))
    return out


def forget(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Remove manifests before the last ``keep`` and the folders no kept manifest names.

    For a time without writers: folders of a commit in progress have no manifest yet.
    Returns the number of folders removed.
    """
    known = sorted(versions(spark, path))
    kept, gone = known[-keep:], known[:-keep]
    named = {f for v in kept for f in snapshot(spark, path, v).folders()}
    dropped = {f for v in gone for f in snapshot(spark, path, v).folders()} - named
    for version in gone:
        files.remove(spark, _manifest(path, version))
    for folder in sorted(dropped):
        files.remove(spark, f"{path.rstrip('/')}/{folder}")
    return len(dropped)
