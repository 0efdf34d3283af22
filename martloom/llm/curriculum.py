"""Mixing sources to target weights along a time-varying curriculum.

Each source has a target in words and a schedule, its rate over the training time
0 to 1 as straight lines between knots. The integral of the schedule is the source's
cumulative demand; a document that starts after ``c`` words of its source is trained
at the time by which the source has asked for ``c`` words, so positions come from
inverting that integral. A source whose target exceeds its words runs through its
documents again. Documents of a source run in the order of a hash of their id.

A null text has no words; null is a source of its own, the last one. Documents
without words are not taken. A repeated row counts as one document each time. Input
columns named like an output are replaced. Without rows or words, targets are 0.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.llm import arrays
from martloom.llm.frames import clear, per_row, running_total, stage
from martloom.session import broadcast_if_small

MADE = ("size", "source_size", "target", "taken", "passes")
Schedule = tuple[tuple[float, float], ...]


@dataclass(frozen=True)
class Mix:
    """Weights and schedules are dealt to the sources in code point order, repeating."""

    weights: tuple[int, ...] = (3, 1, 2)
    share: float = 1.5  # words to take, of all words
    most: int = 2  # runs through a source at most
    schedules: tuple[Schedule, ...] = (
        ((0.0, 1.5), (1.0, 0.5)),
        ((0.0, 1.0), (1.0, 1.0)),
        ((0.0, 0.5), (0.5, 1.0), (1.0, 1.5)),
    )


def count_words(column: pa.Array) -> pa.Array:
    out = np.zeros(len(column), np.int64)
    for block in arrays.blocks(column):
        out[block.first : block.first + len(block.at) - 1] = arrays.words(block).count
    return pa.array(out)


def _dealt(rank: Column, values: list[Column]) -> Column:
    return F.element_at(F.array(*values), (F.pmod(rank - 1, F.lit(len(values))) + 1).cast("int"))


def targets(rows: DataFrame, mix: Mix) -> DataFrame:
    """``skey``, ``rank``, ``source_size`` and ``target`` of each source.

    A target is the smaller of ``most`` times the source's words and its weight times
    a level; the level is found with the sources in order of the level at which each
    is full. The windows run over one row per source.
    """
    sources = rows.groupBy("skey").agg(F.sum("size").alias("source_size"))
    # "+name" sorts by code point before "-", the null source
    sources = sources.withColumn("rank", F.row_number().over(Window.orderBy("skey")))
    sources = sources.withColumn("weight", _dealt(F.col("rank"), [F.lit(float(w)) for w in mix.weights]))
    sources = sources.withColumn("full", F.lit(float(mix.most)) * F.col("source_size"))
    sources = stage(sources.withColumn("fills_at", F.col("full") / F.col("weight")), "mix-sources")
    earlier = Window.orderBy("fills_at", "rank").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    left = F.lit(mix.share) * F.sum("source_size").over(everything) - F.coalesce(F.sum("full").over(earlier), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    levels = sources.select("fills_at", "rank", (left / open_weight).alias("level")).where("fills_at >= level")
    level = levels.agg(F.min_by("level", F.struct("fills_at", "rank"))).first()[0]
    target = F.col("full") if level is None else F.least("full", F.lit(level) * F.col("weight"))
    return sources.select("skey", "rank", "source_size", target.alias("target"))


def time_of(share: Column, schedule: Schedule) -> Column:
    """The time by which a schedule has asked for ``share`` (0 to 1) of its words."""
    areas = [(t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(schedule, schedule[1:], strict=False)]
    asked, total, out = 0.0, sum(areas), F.lit(1.0)
    pieces = []
    for (t0, r0), (t1, r1), area in zip(schedule, schedule[1:], areas, strict=False):
        x = F.greatest(share * total - asked, F.lit(0.0))
        root = F.sqrt(F.greatest(F.lit(r0 * r0) + x * (2 * (r1 - r0) / (t1 - t0)), F.lit(0.0)))
        time = t0 + F.when(x > 0, 2 * x / (r0 + root)).otherwise(0.0)
        asked += area
        pieces.append((asked / total, F.least(time, F.lit(t1))))
    for upto, time in reversed(pieces):
        out = F.when(share <= upto, time).otherwise(out)
    return out


def planned(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
    mix: Mix | None = None, columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of each row (default: all) with ``size``, ``source_size``, ``target``,
    ``taken`` and ``passes``, an array of (pass, taken, position) of its runs."""
    mix = mix or Mix()
    keep = clear(df.select(*(F.col(f"`{c}`") for c in (columns if columns is not None else df.columns))), *MADE).columns
    key = F.coalesce(F.concat(F.lit("+"), F.col(f"`{source}`").cast("string")), F.lit("-"))
    size = per_row(count_words, "long")(arrays.text_column(text))
    rows = df.select(
        *(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(keep)), F.col(f"`{id_col}`").alias("_id"), key.alias("skey"), size.alias("size")
    )
    if not any(c.lower() == text.lower() for c in keep):
        rows = stage(rows, "mix-sizes")
    sources = stage(targets(rows, mix), "mix-targets")
    rows = running_total(rows, "skey", ["_id", "size"], F.col("size"), "before")
    rows = rows.join(broadcast_if_small(sources), "skey")
    runs = []
    for k in range(mix.most):
        start = F.col("source_size") * k + F.col("before")
        taken = F.greatest(F.least(F.floor("target") - start, F.col("size")), F.lit(0).cast("long"))
        share = F.least(start / F.greatest("target", F.lit(1.0)), F.lit(1.0))
        position = _dealt(F.col("rank"), [time_of(share, s) for s in mix.schedules])
        runs.append(F.struct(F.lit(k).alias("pass"), taken.alias("taken"), position.alias("position")))
    rows = rows.withColumn("passes", F.filter(F.array(*runs), lambda r: r["taken"] > 0))
    total = F.aggregate("passes", F.lit(0).cast("long"), lambda a, r: a + r["taken"])
    return rows.select(
        *(F.col(f"c{k}").alias(c) for k, c in enumerate(keep)), "size", "source_size", "target", total.alias("taken"), "passes"
    )


def training_order(plan: DataFrame) -> DataFrame:
    """One row for each run of a document, range-sorted by training position.

    The rows of ``planned`` with ``pass``, ``taken`` and ``position`` of the run. Equal
    positions fall to the earlier pass, then to a hash of the row, so reruns agree.
    """
    rest = clear(plan, "passes", "taken", "pass", "position").columns
    runs = plan.select(*(F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(rest)), F.explode("passes").alias("run"))
    tie = F.xxhash64(*(f"c{k}" for k in range(len(rest)))) if rest else F.lit(0)
    runs = runs.orderBy("run.position", "run.pass", tie)
    return runs.select(*(F.col(f"c{k}").alias(c) for k, c in enumerate(rest)), "run.pass", "run.taken", "run.position")


def placed(
    df: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source",
    mix: Mix | None = None, columns: list[str] | None = None,
) -> DataFrame:
    """``columns`` of each row (default: all) with ``size``, ``source_size``, ``target``, and
    what its placed runs give: ``taken`` words, ``position`` and ``rank`` of its first run.

    Runs are numbered over the whole mix in training order: a range sort, the number of
    rows in earlier ranges, and the place in the own one. Rows that are not taken have
    neither position nor rank.
    """
    plan = planned(df, id_col, text, source, mix, columns)
    keep = clear(plan, "passes", "taken", "position", "rank").columns
    names = [f"c{k}" for k in range(len(keep))]
    rows = plan.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)), "passes")
    rows = stage(rows.withColumn("at", F.monotonically_increasing_id()), "mix-plan")
    # equal positions fall to the earlier pass and the smaller id; the rest tells rows apart
    id_at = next((n for c, n in zip(keep, names, strict=True) if c == id_col), None)
    first = F.col(id_at) if id_at else F.lit(0)
    runs = rows.select("at", first.alias("id"), F.xxhash64(*names).alias("tie"), F.explode("passes").alias("run"))
    order = ["position", "pass", "id", "tie", "at"]
    runs = runs.select("at", "id", "tie", "run.pass", "run.taken", "run.position").repartitionByRange(*order).sortWithinPartitions(*order)
    # the lower 33 bits of the generated id count rows inside the partition
    runs = runs.withColumn("part", F.spark_partition_id())
    runs = stage(runs.withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "mix-order")
    sizes = runs.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))  # a row per partition
    ranked = runs.join(F.broadcast(starts), "part").withColumn("rank", F.col("start") + F.col("place") + 1)
    each = ranked.groupBy("at").agg(F.sum("taken").alias("taken"), F.min("position").alias("position"), F.min("rank").alias("rank"))
    out = rows.drop("passes").join(each, "at", "left")
    taken = F.coalesce("taken", F.lit(0).cast("long"))
    return out.select(*(F.col(n).alias(c) for c, n in zip(keep, names, strict=True)), taken.alias("taken"), "position", "rank")


def time_sql(share: str, schedule: Schedule) -> str:
    """:func:`time_of` as SQL, step by step the same."""
    areas = [(t1 - t0) * (r0 + r1) / 2 for (t0, r0), (t1, r1) in zip(schedule, schedule[1:], strict=False)]
    asked, total, cases = 0.0, sum(areas), []
    number = lambda x: f"CAST({x!r} AS DOUBLE)"
    for (t0, r0), (t1, r1), area in zip(schedule, schedule[1:], areas, strict=False):
        x = f"greatest({share} * {number(total)} - {number(asked)}, {number(0.0)})"
        root = f"sqrt(greatest({number(r0 * r0)} + {x} * {number(2 * (r1 - r0) / (t1 - t0))}, {number(0.0)}))"
        time = f"{number(t0)} + CASE WHEN {x} > 0 THEN 2 * {x} / ({number(r0)} + {root}) ELSE {number(0.0)} END"
        asked += area
        cases.append(f"WHEN {share} <= {number(asked / total)} THEN least({time}, {number(t1)})")
    return f"CASE {' '.join(cases)} ELSE 1.0 END"
