"""DuckDB oracle SQL for the data-quality reports: one filter per rule,
unioned (the Spark jobs evaluate all rules of a table in one scan)."""

from __future__ import annotations

from emporium.oracle.sqlkit import fold
from emporium.plans.quality import CHECKS, FOREIGN_KEYS, NOT_NULLS, UNIQUES

SQL: dict[str, str] = {}

SQL["dq_checks"] = "\nUNION ALL\n".join(
    f"SELECT '{rule}' AS rule, '{table}' AS table_name, CAST({key} AS VARCHAR) AS row_key, "
    f"CAST({val} AS VARCHAR) AS value FROM {table} WHERE NOT COALESCE(({cond}), TRUE)"
    for rule, table, key, cond, val in CHECKS)

SQL["dq_not_null"] = "\nUNION ALL\n".join(
    f"SELECT 'not_null:{c}' AS rule, '{table}' AS table_name, CAST({key} AS VARCHAR) AS row_key, "
    f"CAST({key} AS VARCHAR) AS value FROM {table} WHERE {c} IS NULL"
    for table, key, cols in NOT_NULLS for c in cols)


def _unique(rule, table, cols, ci):
    keys = ", ".join(fold(c) if ci else c for c in cols)
    label = " || '|' || ".join(f"CAST(min({c}) AS VARCHAR)" for c in cols)
    return (f"SELECT '{rule}' AS rule, '{table}' AS table_name, {label} AS row_key, "
            f"CAST(count(*) AS VARCHAR) AS value FROM {table} GROUP BY {keys} HAVING count(*) > 1")


SQL["dq_unique"] = "\nUNION ALL\n".join(_unique(*u) for u in UNIQUES)

SQL["dq_orphans"] = "\nUNION ALL\n".join(
    f"SELECT '{rule}' AS rule, '{child}' AS table_name, CAST(c.{ckey} AS VARCHAR) AS row_key, "
    f"CAST(c.{fk} AS VARCHAR) AS value FROM {child} c WHERE c.{fk} IS NOT NULL "
    f"AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pkey} = c.{fk})"
    for rule, child, ckey, fk, parent, pkey in FOREIGN_KEYS)
