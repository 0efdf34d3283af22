"""All registered queries in one place."""

from __future__ import annotations

from workload import fact_rollups, facts, flows, lake, members, quality, rollups

_MODULES = (rollups, quality, members, facts, fact_rollups, flows, lake)

QUERIES = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
ORACLE = {name: sql for module in _MODULES for name, sql in module.ORACLE.items()}
