"""Period roll-up: one fact, many time grains, two shuffles.

Plan shape
----------
1. The fact is summed to (keys, day) or, when every grain is aligned to months,
   to (keys, month). Map-side combine means a key that holds a third of all rows
   sends at most one row per map task and day.
2. These totals are shuffled once by the keys. From here each key owns at most
   one row per calendar day, however hot it was in the fact.
3. Totals meet a *bridge* from the calendar that lists, for each day or month,
   the starts of all windows covering it. The windows are exploded and summed
   inside the task: rows already sit with their key, so the 31-fold (last 30
   days) and 13-fold (moving annual) fan-outs never cross the network.

A single plain grain (one start per day) needs neither windows nor a second shuffle:
each fact takes its start from the calendar and is summed once.

Every fact counts once per window start. Facts outside the calendar or outside
every window stay in a bucket whose ``time_key`` is NULL.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martloom.functions.dates import KEY_FORMAT, as_col, parse_date
from martloom.session import stage


@dataclass(frozen=True)
class Grain:
    """A roll-up level: windows ``start .. end`` of the calendar, or plain ``start``."""

    label: str
    start: str
    end: str | None = None
    monthly: bool = True


# Labels and the calendar columns they are keyed by.
GRAINS = {
    g.label: g
    for g in (
        Grain("MTD", "first_day_month"),
        Grain("MONTH", "first_day_month"),
        Grain("QTD", "first_day_quarter"),
        Grain("QUARTER", "first_day_quarter"),
        Grain("YTD", "first_day_year"),
        Grain("YEAR", "first_day_year"),
        Grain("L3M", "l3m_start", "mat_l3m_end"),
        Grain("MAT", "mat_start", "mat_l3m_end"),
        Grain("TDP", "tdp_start", monthly=False),
        Grain("MOC", "moc_start_date", monthly=False),
        Grain("L30D", "last_30_day", "date", monthly=False),
    )
}
DAYS = "DAYS"

# Calendars up to this many days (274 years) are broadcast; longer ones are joined by shuffle.
MAX_CALENDAR_ROWS = 100_000

# Windows that attach a closed period to the days of the period after it.
CLOSED_GRAINS = {
    **{k: GRAINS[k] for k in ("MTD", "QTD", "YTD", "L3M", "MAT")},
    "MONTH": Grain("MONTH", "first_day_last_month", "mat_l3m_end"),
    "QUARTER": Grain("QUARTER", "first_day_last_quarter", "last_day_last_quarter"),
    "YEAR": Grain("YEAR", "first_day_last_year", "year_end"),
}

Measures = Mapping[str, str] | Sequence[str]


def parse_measures(measures: Measures) -> dict[str, str]:
    """``{"col": "type"}`` from a mapping or from ``"col-TYPE"`` strings."""
    if isinstance(measures, Mapping):
        return dict(measures)
    pairs = (m.rsplit("-", 1) for m in measures)
    return {name.strip().replace(" ", "_"): kind.strip() for name, kind in pairs}


def _day(fact: DataFrame, date_col: str, date_format: str | None) -> Column:
    if dict(fact.dtypes)[date_col] == "string":
        return parse_date(date_col, date_format or KEY_FORMAT)
    return F.to_date(as_col(date_col))


def _nowhere(n_slots: int) -> Column:
    """One empty window per slot, for facts that no window covers."""
    entry = [F.struct(F.lit(i).alias("_slot"), F.lit(None).cast("date").alias("_start")) for i in range(n_slots)]
    return F.array(*entry)


def _window_bridge(calendar: DataFrame, unit: Column, slots: Sequence[tuple[str, str | None]], step: str) -> DataFrame:
    """(unit, windows): the starts of all windows that cover a day or month.

    Only calendar rows take part, and one small shuffle groups them by unit.
    """
    plain, spans = [], []
    for i, (start, end) in enumerate(slots):
        if end is None:
            plain.append(F.struct(F.lit(i).alias("_slot"), F.col(start).alias("_start")))
            continue
        lo, hi = F.col(start), F.col(end)
        if step == "month":
            lo, hi = F.trunc(lo, "MM"), F.trunc(hi, "MM")
        covered = F.sequence(lo, hi, F.expr(f"interval 1 {step}"))
        spans.append(F.struct(F.lit(i).alias("_slot"), F.col(start).alias("_start"), covered.alias("_covered")))
    parts = []
    if plain:
        parts.append(calendar.select(unit.alias("_unit"), F.explode(F.array(*plain)).alias("_w")))
    if spans:
        span = calendar.select(F.explode(F.array(*spans)).alias("_s"))
        parts.append(
            span.select(
                F.explode("_s._covered").alias("_unit"), F.struct("_s._slot", "_s._start").alias("_w")
            )
        )
    rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    grouped = rows.where("_unit IS NOT NULL AND _w._start IS NOT NULL").groupBy("_unit").agg(
        F.collect_set("_w").alias("_windows")
    )
    absent = F.filter(
        _nowhere(len(slots)), lambda n: ~F.exists("_windows", lambda w: w["_slot"] == n["_slot"])
    )
    return grouped.select("_unit", F.concat("_windows", absent).alias("_windows"))


def _sum_windows(
    totals: DataFrame, bridge: DataFrame, keys: Sequence[str], measures: Iterable[str], n_slots: int
) -> DataFrame:
    placed = totals.join(bridge, "_unit", "left")
    spread = placed.withColumn("_w", F.explode(F.coalesce("_windows", _nowhere(n_slots))))
    return spread.groupBy(*[as_col(k) for k in keys], "_w._slot", "_w._start").agg(
        *[F.sum(as_col(m)).alias(m) for m in measures]
    )


def _label(summed: DataFrame, slots: Sequence[tuple[str, str | None]], grains: Sequence[Grain]) -> DataFrame:
    """Name the slots; grains that share a window (month and to-date) fan out here."""
    names = [[g.label for g in grains if (g.start, g.end) == slot] for slot in slots]
    labels = F.array(*[F.array(*[F.lit(n) for n in group]) for group in names])
    return summed.withColumn("timeperiod_type", F.explode(F.element_at(labels, F.col("_slot") + 1))).drop("_slot")


def period_rollup(
    fact: DataFrame,
    calendar: DataFrame,
    keys: Sequence[str],
    measures: Measures,
    date_col: str,
    grains: Iterable[str] | Mapping[str, Grain] | None = None,
    date_format: str | None = None,
    day_keys: Sequence[str] | None = None,
) -> DataFrame:
    """Sum ``measures`` per ``keys`` for every grain.

    Returns ``keys, timeperiod_type, time_key`` (text ``yyyyMMdd``) and the measures,
    cast to their declared types before they are summed. ``DAYS`` rows are the facts themselves, cast but not
    summed, with ``day_keys`` (default ``keys``) for identification.
    """
    measures = parse_measures(measures)
    wanted = dict(grains) if isinstance(grains, Mapping) else {
        g: GRAINS.get(g) for g in (grains if grains is not None else [DAYS, *GRAINS])
    }
    unknown = [g for g, spec in wanted.items() if spec is None and g != DAYS]
    if unknown:
        raise ValueError(f"unknown grains: {unknown}")
    specs = [g for g in wanted.values() if g is not None]
    cast = {m: as_col(m).try_cast(t) for m, t in measures.items()}
    out: DataFrame | None = None

    if specs and DAYS in wanted:
        # both halves read the fact: it is evaluated once, cut to what they need
        needed = dict.fromkeys([*keys, *(day_keys or keys), date_col, *measures])
        fact = stage(fact.select(*[as_col(c) for c in needed]), "rollup-fact")
    if specs:
        out = _summed_grains(fact, calendar, keys, cast, date_col, date_format, specs)
    if DAYS in wanted:
        days = fact.select(
            *[as_col(k) for k in (day_keys or keys)],
            F.lit(DAYS).alias("timeperiod_type"),
            F.date_format(_day(fact, date_col, date_format), KEY_FORMAT).alias("time_key"),
            *[c.alias(m) for m, c in cast.items()],
        )
        if out is not None:
            # sums widen decimals; the facts follow so that both halves share one schema
            days = days.withColumns({m: as_col(m).cast(dict(out.dtypes)[m]) for m in measures})
        out = days if out is None else out.unionByName(days, allowMissingColumns=True)
    if out is None:
        raise ValueError("no grains requested")
    return out


def _summed_grains(
    fact: DataFrame,
    calendar: DataFrame,
    keys: Sequence[str],
    cast: Mapping[str, Column],
    date_col: str,
    date_format: str | None,
    specs: Sequence[Grain],
) -> DataFrame:
    monthly = [g for g in specs if g.monthly]
    daily = [g for g in specs if not g.monthly]
    key_cols = [as_col(k) for k in keys]
    names = list(cast)
    sums = [F.sum(as_col(m)).alias(m) for m in names]
    facts = fact.select(*key_cols, _day(fact, date_col, date_format).alias("_unit"), *[c.alias(m) for m, c in cast.items()])
    # the bridges hold at most one row per calendar row, so its length bounds them all
    small = calendar.count() <= MAX_CALENDAR_ROWS
    hint = F.broadcast if small else (lambda df: df)
    day_month = hint(calendar.select(F.col("date").alias("_unit"), F.col("first_day_month").alias("_month")).distinct())

    def to_month(df: DataFrame) -> DataFrame:
        return df.join(day_month, "_unit", "left").drop("_unit").withColumnRenamed("_month", "_unit")

    starts = {(g.start, g.end) for g in specs}
    if len(starts) == 1 and specs[0].end is None:
        by_day = hint(calendar.select(F.col("date").alias("_unit"), F.col(specs[0].start).alias("_start")).distinct())
        summed = facts.join(by_day, "_unit", "left").groupBy(*key_cols, "_start").agg(*sums)
        summed = _label(summed.withColumn("_slot", F.lit(0)), list(starts), specs)
        return summed.select(
            *key_cols, "timeperiod_type", F.date_format("_start", KEY_FORMAT).alias("time_key"), *[as_col(m) for m in names]
        )

    if not daily:
        totals = to_month(facts)
    else:
        totals = facts
    totals = totals.groupBy(*key_cols, "_unit").agg(*sums)
    totals = totals.repartition(*key_cols) if keys else totals.repartition(1)

    parts = []
    if daily:
        slots = list(dict.fromkeys((g.start, g.end) for g in daily))
        bridge = hint(_window_bridge(calendar, F.col("date"), slots, "day"))
        parts.append(_label(_sum_windows(totals, bridge, keys, names, len(slots)), slots, daily))
    if monthly:
        months = to_month(totals).groupBy(*key_cols, "_unit").agg(*sums) if daily else totals
        slots = list(dict.fromkeys((g.start, g.end) for g in monthly))
        bridge = hint(_window_bridge(calendar, F.col("first_day_month"), slots, "month"))
        parts.append(_label(_sum_windows(months, bridge, keys, names, len(slots)), slots, monthly))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(
        *key_cols, "timeperiod_type", F.date_format("_start", KEY_FORMAT).alias("time_key"), *[as_col(m) for m in names]
    )


def attach_period_type(rolled: DataFrame, period_types: DataFrame, keep_label: bool = False) -> DataFrame:
    """Add ``timeperiod_type_id`` by label, whatever the case of the dimension's text."""
    ids = period_types.select(
        F.upper("timeperiod_type").alias("timeperiod_type"), "timeperiod_type_id"
    ).dropDuplicates(["timeperiod_type"])
    out = rolled.join(ids, "timeperiod_type", "left")
    return out if keep_label else out.drop("timeperiod_type")


def stamp(df: DataFrame, created_by: str, modified: bool = False) -> DataFrame:
    """Audit columns with today's date."""
    today = F.date_format(F.current_date(), KEY_FORMAT)
    out = df.withColumns({"created_date": today, "created_by": F.lit(created_by)})
    return out.withColumns({"modified_date": today, "modified_by": F.lit(created_by)}) if modified else out


def running_to_date(
    fact: DataFrame, keys: Sequence[str], measures: Measures, date_col: str, period: str = "YEAR"
) -> DataFrame:
    """A running total per day inside each period (``YEAR``, ``QUARTER`` or ``MM``).

    The window runs over daily totals, so a partition holds at most 366 rows per key.
    """
    measures = parse_measures(measures)
    key_cols = [as_col(k) for k in keys]
    daily = fact.groupBy(*key_cols, F.to_date(as_col(date_col)).alias("day")).agg(
        *[F.sum(as_col(m).try_cast(t)).alias(m) for m, t in measures.items()]
    )
    dated = daily.withColumn("period_start", F.trunc("day", period))
    window = Window.partitionBy(*key_cols, "period_start").orderBy("day")
    window = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dated.select(
        *key_cols,
        F.date_format("period_start", KEY_FORMAT).alias("period_key"),
        F.date_format("day", KEY_FORMAT).alias("time_key"),
        *[F.sum(as_col(m)).over(window).alias(m) for m in measures],
    )
