"""Delimited landing files: discovery, header probing and one multi-file scan."""

from __future__ import annotations

import csv
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.operators.members import first_member
from martloom.operators.rules import RAGGED

# What file names say about their content.
RESTATEMENT_MARK = r"_RESTATEMENT(?=[_./]|$)"
FILE_DATE = r"_(\d{8})[^_/]*$"
PART_SUFFIX = r"[_-]p(?:art)?[_-]?\d+(?=\.|$)"

FILE = "_file"
RAW = "_raw"
PROBE_THREADS = 16
HEADER_BYTES = 1 << 16


def text_schema(columns: Sequence[str]) -> T.StructType:
    """All columns nullable text."""
    return T.StructType([T.StructField(c, T.StringType(), True) for c in columns])


def read_delimited(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType | Sequence[str] | None = None,
    header: bool = True,
    delimiter: str = ",",
    infer: bool = False,
) -> DataFrame:
    """CSV with a declared schema, with names for all-text columns, from its header, or inferred.

    A declared schema is applied by position. Inference reads the data twice and
    drops leading zeros of keys, so it is opt-in.
    """
    reader = spark.read.option("header", header).option("sep", delimiter)
    if schema is not None:
        schema = schema if isinstance(schema, T.StructType) else text_schema(schema)
        return reader.schema(schema).csv(path)
    return reader.option("inferSchema", infer).csv(path)


@dataclass(frozen=True)
class LandingFile:
    path: str
    columns: tuple[str, ...]
    folder: str = ""

    @property
    def name(self) -> str:
        return self.path.rsplit("/", 1)[-1]

    @property
    def label(self) -> str:
        """The part of the path below the landing folder; just the name where that is unknown."""
        start = self.path.find(f"/{self.folder.strip('/')}/") if self.folder.strip("/") else -1
        return self.path[start + len(self.folder.strip("/")) + 2 :] if start >= 0 else self.name

    @property
    def restates(self) -> bool:
        return re.search(RESTATEMENT_MARK, self.label, re.IGNORECASE) is not None

    @property
    def delivery(self) -> tuple[str, str]:
        """File date and name of the delivery, equal for the parts of one delivery.

        The files of a marked folder are one delivery. Elsewhere parts share their name
        up to ``_p<number>`` or ``_part<number>``, or restating files the name up to the mark
        and the date, if there is one.
        """
        steps = self.label.split("/")
        for k, step in enumerate(steps[:-1]):
            if re.search(RESTATEMENT_MARK, step, re.IGNORECASE):
                date = re.search(FILE_DATE, step)
                return date[1] if date else "", "/".join(steps[: k + 1])
        date = re.search(FILE_DATE, self.label)
        mark = re.search(RESTATEMENT_MARK, self.label, re.IGNORECASE)
        if mark:
            return date[1] if date else "", self.label[: mark.end()]
        return date[1] if date else "", re.sub(PART_SUFFIX, "", self.label, count=1, flags=re.IGNORECASE)


def file_path() -> Column:
    """The path of a row's file, decoded, so that it can be read again and joined on."""
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def literal_path(path: str) -> str:
    """``path`` with the characters escaped that a reader would take for a pattern."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def list_files(spark: SparkSession, folder: str, prefix: str = "") -> list[str]:
    """Paths of the ``.csv`` files in ``folder`` whose name starts with ``prefix``, by name.

    Only file metadata is read: the content column is never asked for.
    """
    files = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/{prefix}*")
    paths = files.select(file_path().alias("path")).collect()
    return sorted(r["path"] for r in paths if ".csv" in r["path"].rsplit("/", 1)[-1].lower())


def order_by_file_date(paths: Iterable[str]) -> list[str]:
    """Paths by the 8-digit date at the end of their names."""
    dated = []
    for path in paths:
        match = re.search(FILE_DATE, path)
        if match is None:
            raise ValueError(f"no date in file name: {path}")
        dated.append((match[1], path))
    return [path for _, path in sorted(dated)]


def file_date(file: Column) -> Column:
    """The same date as a column, for latest-file-wins logic."""
    return F.regexp_extract(file, FILE_DATE, 1)


def latest_by_file_date(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows of each key from the file with the latest date in its name (column ``_file``).

    One row per key: of rows of the same file the first by the other columns.
    """
    order = [file_date(F.col(FILE)).desc(), *[F.col(f"`{c}`") for c in df.columns if c not in (*keys, FILE)]]
    return first_member(df, keys, order).drop(FILE)


def probe_headers(
    spark: SparkSession, paths: Sequence[str], delimiter: str = ",", folder: str = ""
) -> list[LandingFile]:
    """The fields of each file's first line that is not blank, read through the file system.

    No Spark job is started, whatever the number of files; at most ``HEADER_BYTES`` of a
    file reach the driver, and a first line longer than that is refused.
    """
    hadoop = spark._jvm.org.apache.hadoop
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    codecs = hadoop.io.compress.CompressionCodecFactory(conf)
    io = spark._jvm.org.apache.commons.io

    def probe(path: str) -> LandingFile:
        file = hadoop.fs.Path(path)
        stream = file.getFileSystem(conf).open(file)
        try:
            codec = codecs.getCodec(file)
            plain = stream if codec is None else codec.createInputStream(stream)
            head = io.IOUtils.toString(io.input.BoundedInputStream(plain, HEADER_BYTES), "UTF-8")
        finally:
            stream.close()
        lines = [line for line in re.split(r"\r\n|\n|\r", head) if line.strip()]
        if len(head) >= HEADER_BYTES // 4 and len(lines) < 2 and len(head.encode()) >= HEADER_BYTES:
            raise ValueError(f"no end of the first line within {HEADER_BYTES} bytes: {path}")
        fields = next(csv.reader([lines[0].lstrip("\ufeff")], delimiter=delimiter)) if lines else []
        return LandingFile(path, tuple(fields), folder)

    with ThreadPoolExecutor(PROBE_THREADS) as pool:
        return list(pool.map(probe, paths))


def header_matches(found: Sequence[str], expected: Sequence[str], strict: bool = False) -> bool:
    """Equal column counts; with ``strict`` also equal names in equal order."""
    clean = [c.strip().replace(" ", "_") for c in found]
    wanted = [c.strip().replace(" ", "_") for c in expected]
    return clean == wanted if strict else len(clean) == len(wanted)


def landing_rows(reader, path: str | Sequence[str], columns: Sequence[str], check_width: bool = False) -> DataFrame:
    """Text columns by position and ``_file`` from a batch or stream reader."""
    schema = text_schema(columns)
    if not check_width:
        return reader.schema(schema).csv(path).select("*", file_path().alias(FILE))
    # the reader fills this column only where the number of fields differs
    reader = reader.option("columnNameOfCorruptRecord", RAW)
    rows = reader.schema(T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])).csv(path)
    return rows.select(*[F.col(f"`{c}`") for c in columns], F.col(RAW).isNotNull().alias(RAGGED), file_path().alias(FILE))


def read_landing(
    spark: SparkSession,
    paths: Sequence[str],
    columns: Sequence[str],
    header: bool = True,
    delimiter: str = ",",
    stamp: str | None = None,
    check_width: bool = False,
) -> DataFrame:
    """All files in one scan, text columns by position, with the file path as ``_file``.

    Missing fields are NULL and surplus ones are dropped; with ``check_width`` such records
    are marked in ``_ragged``.
    """
    reader = spark.read.option("header", header).option("sep", delimiter)
    df = landing_rows(reader, [literal_path(p) for p in paths], columns, check_width)
    return df if stamp is None else df.withColumn("PROCESS_TIMESTAMP", F.lit(stamp))


def write_runs(files: Sequence[LandingFile], mode: str) -> list[tuple[str, list[LandingFile]]]:
    """Files that are written together: (mode, files), by file date and name.

    A restating delivery overwrites in one run over all its files, so its parts do not
    replace each other; later deliveries replace earlier ones. A restatement without a
    date comes after all files it can restate, dated or not. With mode ``overwrite``
    all other files are one delivery as well, written first.
    """
    runs: list[tuple[str, list[LandingFile]]] = []
    last: tuple[str, str] | None = None
    first = mode == "overwrite"

    def late(file: LandingFile) -> bool:
        return file.restates and (first or not file.delivery[0])

    for file in sorted(files, key=lambda f: (late(f), f.delivery, f.label)):
        key = file.delivery if file.restates else None
        if runs and key == last:
            runs[-1][1].append(file)
        else:
            runs.append(("overwrite" if file.restates else mode, [file]))
        last = key
    return runs
