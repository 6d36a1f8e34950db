"""All plans: queries by name, and their SQL."""

from __future__ import annotations

from turnwright.plans import ends, joins, lifecycle, scalars, sequences, tables

PARTS = (joins, scalars, sequences, tables, ends, lifecycle)


def queries() -> dict:
    return {name: query for part in PARTS for name, query in part.plans.queries.items()}


def oracle_sql() -> dict[str, str]:
    return {name: sql for part in PARTS for name, sql in part.plans.sql.items()}
