"""Key-wise overlays: the set forms of upsert, REPLACE, INSERT IGNORE, DELETE.

Parquet files are immutable and ``MERGE INTO`` needs a table format, so a
mutation is computed as a new version of the table: the untouched rows of
the target plus the new or changed rows.  Each function is one shuffle on
the key (anti/semi/outer join) and returns the full new state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, new: DataFrame, keys: list[str], update_cols: list[str] | None = None) -> DataFrame:
    """``INSERT ... ON DUPLICATE KEY UPDATE``: new keys are inserted; for
    existing keys only ``update_cols`` (default: all non-key columns of
    ``new``) take the new values, other target columns are kept."""
    cols = target.columns
    upd = update_cols if update_cols is not None else [c for c in new.columns if c not in keys]
    n = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in upd], F.lit(True).alias("_hit"))
    j = target.join(n, keys, "full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in upd:
            out.append(F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.col(c))
    return j.select(*out)


def replace_rows(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``REPLACE INTO``: rows of ``new`` win whole; target rows whose key is
    absent from ``new`` stay."""
    return target.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*target.columns))


def insert_ignore(target: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``INSERT IGNORE``: rows of ``new`` whose key already exists are skipped."""
    fresh = new.join(target.select(*keys), keys, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def delete_where(target: DataFrame, predicate) -> DataFrame:
    """``DELETE ... WHERE p``: rows where p is true go; NULL keeps the row."""
    return target.where(~F.coalesce(predicate, F.lit(False)))


def delete_keys(target: DataFrame, doomed: DataFrame, keys: list[str]) -> DataFrame:
    """``DELETE ... WHERE k IN (SELECT ...)``."""
    return target.join(doomed.select(*keys), keys, "left_anti")


def update_where(target: DataFrame, predicate, assignments: dict) -> DataFrame:
    """``UPDATE t SET c = e WHERE p`` on every row at once.  The predicate is
    fixed before any assignment; assignments apply left to right (MySQL)."""
    out = target.withColumn("_upd", F.coalesce(predicate, F.lit(False)))
    for c, e in assignments.items():
        out = out.withColumn(c, F.when(F.col("_upd"), e).otherwise(F.col(c)))
    return out.drop("_upd")
