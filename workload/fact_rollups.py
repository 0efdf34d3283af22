"""The roll-up step of the fact jobs: each fact over the grains its job writes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from martloom.operators.rollup import CLOSED_GRAINS, DAYS, GRAINS, period_rollup
from workload import facts
from workload.common import cal_sql, calendar, rounded

SUM_TYPE = "decimal(28,6)"

# Plain and windowed grains of the newer jobs; the older ones attach closed periods.
ALL_GRAINS = [DAYS, *GRAINS]
CLOSED = [DAYS, *CLOSED_GRAINS]

# label -> (first day, last day) as SQL over the calendar rows; plain grains take each day's own period
_PLAIN = {
    "MTD": "m", "MONTH": "m", "QTD": "q", "QUARTER": "q", "YTD": "y", "YEAR": "y", "TDP": "tdp_start", "MOC": "moc_start",
}
_WINDOWS = {
    "L3M": ("m - INTERVAL 3 MONTH", "m - INTERVAL 1 DAY"), "MAT": ("m - INTERVAL 13 MONTH", "m - INTERVAL 1 DAY"),
    "L30D": ("d - INTERVAL 30 DAY", "d"),
}
_CLOSED_WINDOWS = {
    "MONTH": ("m - INTERVAL 1 MONTH", "m - INTERVAL 1 DAY"), "QUARTER": ("q - INTERVAL 3 MONTH", "q - INTERVAL 1 DAY"),
    "YEAR": ("y - INTERVAL 1 YEAR", "y - INTERVAL 1 DAY"),
}


def _rolled(
    fact: Callable[[SparkSession, str], DataFrame], keys: Sequence[str], measures: Sequence[str], grains: Sequence[str], closed: bool
) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        chosen = {g: None if g == DAYS else (CLOSED_GRAINS if closed else GRAINS)[g] for g in grains}
        out = period_rollup(
            fact(spark, sf_dir), calendar(spark, sf_dir, "orders"), list(keys), dict.fromkeys(measures, SUM_TYPE), "time_key", chosen, "yyyyMMdd"
        )
        return rounded(out, *measures, scale=2)

    run.__name__ = f"{fact.__name__}_periods"
    return run


def _rolled_sql(fact_sql: str, keys: Sequence[str], measures: Sequence[str], grains: Sequence[str], closed: bool) -> str:
    """One branch per grain: an equality or range join of the days with the calendar's windows."""
    by = ", ".join(keys)
    sums = ", ".join(f"CAST(round(sum(CAST({m} AS DECIMAL(28,6))), 2) AS DOUBLE) AS {m}" for m in measures)
    windows = {**_WINDOWS, **(_CLOSED_WINDOWS if closed else {})}
    parts = []
    for grain in grains:
        if grain == DAYS:
            own = ", ".join(f"CAST(round(CAST({m} AS DECIMAL(28,6)), 2) AS DOUBLE) AS {m}" for m in measures)
            parts.append(f"SELECT {by}, 'DAYS' AS timeperiod_type, strftime(day, '%Y%m%d') AS time_key, {own} FROM dated")
        elif grain in windows:
            lo, hi = windows[grain]
            parts.append(f"""SELECT {by}, '{grain}' AS timeperiod_type, strftime(lo, '%Y%m%d') AS time_key, {sums} FROM dated
                LEFT JOIN (SELECT DISTINCT CAST({lo} AS DATE) AS lo, CAST({hi} AS DATE) AS hi FROM cal) w ON day BETWEEN lo AND hi GROUP BY {by}, lo""")
        else:
            start = _PLAIN[grain]
            parts.append(f"""SELECT {by}, '{grain}' AS timeperiod_type, strftime({start}, '%Y%m%d') AS time_key, {sums} FROM dated
                LEFT JOIN cal ON day = d GROUP BY {by}, {start}""")
    return f"""WITH {cal_sql('orders')}, fact AS ({fact_sql}),
    dated AS (SELECT * EXCLUDE (time_key), CAST(try_strptime(time_key, '%Y%m%d') AS DATE) AS day FROM fact)
    {' UNION ALL '.join(parts)}"""


def _without(grains: Sequence[str], *gone: str) -> list[str]:
    return [g for g in grains if g not in gone]


# name -> (fact, its SQL, keys, measures, grains the job writes, closed periods)
JOBS = {
    "fact_allocation_rollup": (
        facts.fact_allocation, facts.FACT_ALLOCATION_SQL, ["country_key", "currency_key"], ["allocation_gsv", "allocation_vol"],
        _without(ALL_GRAINS, "MTD", "TDP", "L30D"), False,
    ),
    "fact_forecast_rollup": (
        facts.fact_forecast, facts.FACT_FORECAST_SQL, ["country_key"], ["gross_volume", "captive_volume", "fc_gsv", "fc_vol"], ALL_GRAINS, False,
    ),
    "fact_finance_periods": (
        facts.fact_finance_measures, facts.FACT_FINANCE_SQL, ["country_key"], facts._MEASURES, ALL_GRAINS, False,
    ),
    "fact_plan_rollup": (
        facts.fact_plan, facts.FACT_PLAN_SQL, ["country_key"], ["sales_volume", "gsv_local", "turn_over"], CLOSED, True,
    ),
    "fact_media_plan_rollup": (
        facts.fact_union_sources, facts.FACT_UNION_SQL, ["cluster_key", "media_product_key"], ["sales_volume", "gsv_local", "turn_over"], CLOSED, True,
    ),
    "fact_achievement_rollup": (
        facts.fact_semi, facts.FACT_SEMI_SQL, ["price_list"], ["moc_tot"], _without(ALL_GRAINS, "MOC", "TDP", "L30D"), False,
    ),
    "fact_volumetric_rollup": (
        facts.fact_defaults, facts.FACT_DEFAULTS_SQL, ["cluster_key", "media_product_key"], ["value_offtake", "sales_volume", "value_growth"], CLOSED, True,
    ),
    "fact_voice_rollup": (
        facts.fact_label_lookup, facts.FACT_LABEL_SQL, ["cluster_key", "media_key"], ["targets"], CLOSED, True,
    ),
    "fact_spend_rollup": (
        facts.fact_spend_target, facts.FACT_SPEND_SQL, ["cluster_key", "media_key"], ["actual_spends"], CLOSED, True,
    ),
}

QUERIES = {name: _rolled(job[0], *job[2:]) for name, job in JOBS.items()}
ORACLE = {name: _rolled_sql(job[1], *job[2:]) for name, job in JOBS.items()}
