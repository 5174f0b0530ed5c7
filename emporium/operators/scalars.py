"""Attach one-row aggregates to every row.

Each column of the one-row aggregate becomes an uncorrelated scalar
subquery (``DataFrame.scalar()``): Spark computes it once (merging
subqueries over the same aggregate) and uses the value as a literal, so
there is no join, no broadcast of a relation and no shuffle of the left
side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def attach_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    return df.select("*", *[one_row.select(c).scalar().alias(c) for c in one_row.columns])
