"""READ / QUERY / WRITE pipelines from configuration, in the given order or by what reads what."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Mapping, Sequence
from graphlib import CycleError, TopologicalSorter

from pyspark.sql import DataFrame, SparkSession

from martloom.session import stage
from martloom.sinks.writers import write_table
from martloom.sources.landing import read_delimited


def run_pipeline(
    spark: SparkSession,
    steps: Sequence[tuple[str, str]],
    read_format: str = "csv",
    write_format: str = "csv",
    write_mode: str = "error",
    prepare: Callable[[str, DataFrame], DataFrame] | None = None,
) -> dict[str, DataFrame]:
    """Run ``("READ|t", path)``, ``("QUERY|t", sql)`` and ``("WRITE|t", path)`` in order.

    Each name becomes a temporary view for the steps after it, after ``prepare`` if given.
    Returns the frames by name.
    """
    tables: dict[str, DataFrame] = {}
    for key, value in steps:
        action, _, name = (part.strip() for part in key.partition("|"))
        action = action.upper()
        if action == "READ":
            tables[name] = (
                read_delimited(spark, value) if read_format == "csv" else spark.read.format(read_format).load(value)
            )
        elif action == "QUERY":
            tables[name] = spark.sql(value)
        elif action == "WRITE":
            write_table(spark.table(name), value, mode=write_mode, fmt=write_format)
            continue
        else:
            continue
        if prepare is not None:
            tables[name] = prepare(name, tables[name])
        tables[name].createOrReplaceTempView(name)
    return tables


def tables_read(spark: SparkSession, sql: str) -> set[str]:
    """The names a query reads, as Spark's own parser sees them (its own WITH names included)."""
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(sql).toString()
    return {n.strip() for n in re.findall(r"UnresolvedRelation \[([^\]]*)\]", plan)}


def ordered_steps(spark: SparkSession, steps: Sequence[tuple[str, str]]) -> tuple[list[tuple[str, str]], Counter]:
    """The steps so that each comes after what it reads, and how often each name is read.

    Steps that do not depend on each other keep their order. A name made twice and a
    circle of names are refused.
    """
    made: dict[str, tuple[str, str]] = {}
    writes: list[tuple[str, str]] = []
    for key, value in steps:
        action, _, name = (part.strip() for part in key.partition("|"))
        if action.upper() == "WRITE":
            writes.append((key, value))
        elif action.upper() in ("READ", "QUERY"):
            if name in made:
                raise ValueError(f"two steps make {name}")
            made[name] = (key, value)
    reads = {
        name: sorted(tables_read(spark, value) & made.keys()) if key.strip().upper().startswith("QUERY") else []
        for name, (key, value) in made.items()
    }
    try:
        order = list(TopologicalSorter(reads).static_order())
    except CycleError as error:
        raise ValueError(f"steps read each other: {' <- '.join(error.args[1])}") from error
    often = Counter(n for names in reads.values() for n in names)
    often.update(key.partition("|")[2].strip() for key, _ in writes)
    return [made[n] for n in order] + writes, often


def run_graph(
    spark: SparkSession,
    steps: Sequence[tuple[str, str]],
    read_format: str = "csv",
    write_format: str = "csv",
    write_mode: str = "error",
) -> dict[str, DataFrame]:
    """Run the steps of :func:`run_pipeline` from a map in any order.

    A name that several steps read is written once and read back, so its sources are
    scanned once.
    """
    order, often = ordered_steps(spark, steps)

    def once(name: str, df: DataFrame) -> DataFrame:
        return stage(df, f"view-{name}") if often[name] > 1 else df

    return run_pipeline(spark, order, read_format, write_format, write_mode, once)


def run_queries(spark: SparkSession, settings: Mapping[str, str] | Sequence[tuple[str, str]]) -> dict[str, DataFrame]:
    """Variant with ``DataFiles = path#table,…`` and every other key a query, in any order."""
    pairs = list(settings.items()) if isinstance(settings, Mapping) else list(settings)
    files = dict(pairs).get("DataFiles", "")
    reads = [(f"READ|{t.strip()}", p.strip()) for p, t in (item.split("#") for item in files.split(",") if item)]
    queries = [(f"QUERY|{k}", v) for k, v in pairs if k not in ("DataFiles", "OutputFiles")]
    return run_graph(spark, reads + queries)
