"""All queries and their SQL, by name."""

from __future__ import annotations

from workload import archive, scoring, web

GROUPS = (scoring, web, archive)


def queries() -> dict:
    return {name: run for group in GROUPS for name, run in group.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: text for group in GROUPS for name, text in group.ORACLES.items()}
