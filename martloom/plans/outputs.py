"""All period outputs of one fact: the facts by day and the summed grains, each in its folder."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame

from martloom.functions.dates import as_col
from martloom.operators.rollup import DAYS, GRAINS, Measures, attach_period_type, parse_measures, period_rollup, stamp
from martloom.session import stage
from martloom.sinks.writers import write_grains, write_table

# Folders of the outputs.
DAYS_FOLDER, GRAINS_FOLDER = "Days", "Agg"


def write_period_outputs(
    fact: DataFrame,
    calendar: DataFrame,
    path: str,
    keys: Sequence[str],
    measures: Measures,
    date_col: str,
    grains: Iterable[str] | None = None,
    date_format: str | None = None,
    day_keys: Sequence[str] | None = None,
    period_types: DataFrame | None = None,
    created_by: str | None = None,
    mode: str = "overwrite",
) -> None:
    """Write ``Days`` with its own keys and ``Agg``, one folder per summed grain.

    The fact's plan runs once: its needed columns are written under the checkpoint
    folder and both outputs read them. All summed grains are one pass and one write.
    ``DAYS`` among ``grains`` asks for the first output; default are all grains.
    """
    wanted = list(grains) if grains is not None else [DAYS, *GRAINS]
    measures = parse_measures(measures)
    needed = dict.fromkeys([*keys, *(day_keys or keys), date_col, *measures])
    once = stage(fact.select(*[as_col(c) for c in needed]), "period-fact")

    def finished(df: DataFrame) -> DataFrame:
        if period_types is not None:
            df = attach_period_type(df, period_types, keep_label=True)
        return df if created_by is None else stamp(df, created_by)

    if DAYS in wanted:
        days = period_rollup(once, calendar, day_keys or keys, measures, date_col, [DAYS], date_format)
        write_table(finished(days), f"{path}/{DAYS_FOLDER}", mode=mode)
    summed = [g for g in wanted if g != DAYS]
    if summed:
        rolled = period_rollup(once, calendar, keys, measures, date_col, summed, date_format)
        write_grains(finished(rolled), f"{path}/{GRAINS_FOLDER}", mode)
