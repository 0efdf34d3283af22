"""Landing files to the harmonised lake: one pass over the data, four outputs.

Per run of files the landing data is parsed and checked once and written as a
staged table in the checkpoint folder. Good rows, rejects, the key registry and
the audit then read just the columns they need from it.
"""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martloom.functions.dates import TEXT_FORMAT
from martloom.operators.integrity import STAMP, duplicate_check, parse_reference, reference_check
from martloom.operators.registry import BUCKETS, update_keys
from martloom.operators.rules import (
    Check,
    Outcomes,
    column_name,
    count_outcomes,
    derive_columns,
    harmonise_check,
    not_null_check,
    outcomes,
    parse_rules,
    rejects,
    rule_checks,
    survivors,
    width_check,
)
from martloom.session import stage
from martloom.sinks.snapshots import commit
from martloom.sinks.writers import append_run, write_table
from martloom.sources.landing import (
    FILE,
    LandingFile,
    header_matches,
    list_files,
    probe_headers,
    read_delimited,
    read_landing,
    write_runs,
)

# Audit columns, states and the "not configured" mark.
AUDIT_SCHEMA = (
    "DataSet string, InputFile string, Status string, Reason string, InputRowCount bigint,"
    " RejectedRowCount bigint, OutputRowCount bigint, StartTime bigint, EndTime bigint"
)
PROCESSED, REJECTED = "PROCESSED", "REJECTED"
NO_REASON, HEADER_REASON = "NA", "HEADER MISMATCH"
UNSET = "NA"


@dataclass(frozen=True)
class IngestConfig:
    """Everything one dataset needs; ``from_map`` reads the configuration keys."""

    dataset: str
    landing_path: str
    lake_path: str
    error_path: str
    columns: tuple[str, ...]
    file_prefix: str = ""
    header: bool = True
    delimiter: str = ","
    mode: str = "append"
    rules: str = ""
    length_offset: int = 0
    reject: Mapping[str, bool] = field(default_factory=dict)
    duplicate_keys: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    harmonise: tuple[str, ...] = ()
    harmonised_format: str = TEXT_FORMAT
    references: str = ""
    base_path: str = ""
    derive: tuple[str, ...] = ()
    registry_keys: tuple[str, ...] = ()
    registry_path: str | None = None
    single_file: bool = False
    date_folder: str | None = None
    first_file_only: bool = False
    stamp: bool = True
    strict_header: bool = False
    fmt: str = "parquet"
    versioned: bool = False
    check_width: bool = False
    stored_keys: bool = False
    key_days: int = 0
    key_buckets: int = BUCKETS

    @classmethod
    def from_map(cls, settings: Mapping[str, str], dataset: str, base_path: str = "") -> IngestConfig:
        """From the fixed configuration keys; the process class decides on stamps, duplicates and file choice.

        ``Mapping`` datasets check duplicates, carry no stamp and take the first file.
        ``Transaction`` datasets are stamped, derive partition columns, keep a key
        registry, and check duplicates only with ``checkDuplicates`` set to true.
        """

        def text(key: str, default: str = "") -> str:
            value = settings.get(key, UNSET)
            return default if value == UNSET else value

        def true(key: str) -> bool:
            return text(key).lower() == "true"

        def split(key: str, sep: str = ",") -> tuple[str, ...]:
            return tuple(p.strip() for p in text(key).split(sep) if p.strip())

        mapping = text("processClass") == "Mapping"
        check_duplicates = mapping or true("checkDuplicates")
        return cls(
            dataset=dataset,
            landing_path=base_path + text("LandingPath"),
            lake_path=base_path + text("UDLpath"),
            error_path=base_path + text("ErrorPath"),
            columns=tuple(column_name(c) for c in text("schema").split(",")),
            file_prefix=text("LandingFileName"),
            header=text("header", "true").lower() == "true",
            delimiter=text("delimiter", ","),
            mode=text("mode", "append"),
            rules=text("SchemaValidationColumn"),
            length_offset=int(text("lengthOffset", "0")),
            reject={
                "duplicate": true("rejectDuplicateData"),
                "length": true("rejectLengthData"),
                "decimal": true("rejectDecimalData"),
                "date": true("rejectDateData"),
                "integer": true("rejectInteger"),
                "harmonise": true("rejectDateHarmonize"),
                "reference": true("RejectReferentialData"),
                "not_null": true("rejectNullData"),
            },
            duplicate_keys=split("duplicateRow") if check_duplicates else (),
            not_null=tuple(column_name(c) for c in split("NotNullColumn")),
            harmonise=split("HarmonizeDateColumn"),
            harmonised_format=text("HarmonizedDateFormat", TEXT_FORMAT),
            references=text("ReferentialString"),
            base_path=base_path,
            derive=() if mapping else split("SplitDateColumn", "|"),
            registry_keys=() if mapping else split("mappingPrimaryKey"),
            registry_path=(base_path + text("mappingFilePath")) if text("mappingFilePath") else None,
            single_file=mapping and true("SingleFile"),
            date_folder=text("DateFolder") or None,
            first_file_only=mapping,
            stamp=not mapping,
            strict_header=true("strictHeader"),
            fmt=text("format", "parquet"),
            versioned=true("versioned"),
            check_width=true("checkWidth"),
            stored_keys=true("storedKeys"),
            key_days=int(text("keyDays", "0")),
            key_buckets=int(text("keyBuckets", str(BUCKETS))),
        )


def build_checks(spark: SparkSession, config: IngestConfig, duplicates: Check | None = None) -> list[Check]:
    """The checks in their fixed order; later ones see what earlier ones left.

    ``duplicates`` takes the place of the check for keys repeated in the rows themselves.
    """
    reject = config.reject
    checks: list[Check] = [width_check()] if config.check_width else []
    if config.duplicate_keys:
        checks.append(duplicates or duplicate_check(config.duplicate_keys, reject.get("duplicate", False)))
    if config.not_null:
        checks.append(not_null_check(config.not_null, reject.get("not_null", False)))
    checks += rule_checks(parse_rules(config.rules), config.columns, reject, config.length_offset)
    if config.harmonise:
        checks.append(harmonise_check(config.harmonise, config.harmonised_format, reject.get("harmonise", False)))
    for path, pairs in parse_reference(config.references):
        master = read_delimited(spark, config.base_path + path)
        master = master.toDF(*[column_name(c) for c in master.columns])
        checks.append(reference_check(master, pairs, config.base_path + path, reject.get("reference", False)))
    return checks


def audit_counts(found: Outcomes) -> DataFrame:
    """Rows in, reject rows and rows out per file, in one aggregate over the outcomes."""
    return count_outcomes(found, FILE).toDF(FILE, "InputRowCount", "RejectedRowCount", "OutputRowCount")


def audit_rows(
    spark: SparkSession, config: IngestConfig, files: Sequence[LandingFile], counts: DataFrame | None, start: int
) -> DataFrame:
    """One audit row per file: counts for processed files, a reason for refused ones."""
    listed = spark.createDataFrame([(f.path,) for f in files], "InputFile string")
    if counts is None:
        status, reason, counted = REJECTED, HEADER_REASON, listed
    else:
        status, reason = PROCESSED, NO_REASON
        counted = listed.join(counts.withColumnRenamed(FILE, "InputFile"), "InputFile", "left")
    known = set(counted.columns)
    row_counts = ("InputRowCount", "RejectedRowCount", "OutputRowCount")
    values = {c: F.coalesce(c, F.lit(0)) if c in known else F.lit(0) for c in row_counts}
    return counted.select(
        F.lit(config.dataset).alias("DataSet"),
        "InputFile",
        F.lit(status).alias("Status"),
        F.lit(reason).alias("Reason"),
        *[v.cast("bigint").alias(c) for c, v in values.items()],
        F.lit(start).cast("bigint").alias("StartTime"),
        F.lit(int(time.time() * 1000)).cast("bigint").alias("EndTime"),
    )


def write_lake(spark: SparkSession, config: IngestConfig, rows: DataFrame, partitions: Sequence[str], mode: str) -> None:
    """Write good rows; a versioned lake shows all of a run's partitions at once or none."""
    if config.versioned:
        how = "append" if mode == "append" else "replace" if partitions else "overwrite"
        commit(spark, config.lake_path, rows, partitions, how)
    else:
        write_table(rows, config.lake_path, partitions, mode, config.fmt, config.single_file)


def by_header(files: Sequence[LandingFile], config: IngestConfig) -> tuple[list[LandingFile], list[LandingFile]]:
    """(files whose first line fits the configured columns, refused files)."""
    fits = [header_matches(f.columns, config.columns, config.strict_header and config.header) for f in files]
    return [f for f, ok in zip(files, fits, strict=True) if ok], [f for f, ok in zip(files, fits, strict=True) if not ok]


def ingest(spark: SparkSession, config: IngestConfig, run_date: str, start: int | None = None) -> DataFrame:
    """Ingest every file of a dataset; returns the audit rows that were written.

    Files with the wrong number of columns are refused whole. Errors are raised,
    not swallowed.
    """
    start = start if start is not None else int(time.time() * 1000)
    folder = config.landing_path + (f"/{config.date_folder}" if config.date_folder else "")
    paths = list_files(spark, folder, config.file_prefix)
    files = probe_headers(spark, paths[:1] if config.first_file_only else paths, config.delimiter, folder)
    good, refused = by_header(files, config)
    audits = []
    if refused:
        audits.append(audit_rows(spark, config, refused, None, start))
    checks = build_checks(spark, config)
    for mode, run in write_runs(good, config.mode):
        landing = read_landing(
            spark, [f.path for f in run], config.columns, config.header, config.delimiter, str(start) if config.stamp else None,
            config.check_width,
        )
        found = outcomes(landing, checks).staged(f"outcomes-{config.dataset}")
        rows, partitions = derive_columns(survivors(found).drop(FILE), config.derive)
        if config.registry_keys and config.registry_path:
            update_keys(spark, f"{config.registry_path}/{config.dataset}", rows, config.registry_keys, buckets=config.key_buckets)
        write_lake(spark, config, rows, partitions, mode)
        append_run(rejects(found), f"{config.error_path}/records", run_date)
        audits.append(audit_rows(spark, config, run, audit_counts(found), start))
    if not audits:
        return spark.createDataFrame([], AUDIT_SCHEMA)
    audit = stage(reduce(DataFrame.unionByName, audits), "audit")
    append_run(audit, f"{config.error_path}/audit", run_date)
    return audit


__all__ = ["IngestConfig", "STAMP", "audit_counts", "audit_rows", "build_checks", "by_header", "ingest", "write_lake"]
