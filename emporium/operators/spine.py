"""Calendar spine: one row per day of a range, for zero-filled daily reports.

The range bounds are columns of a one-row DataFrame (literals or a global
aggregate), so the spine has as many rows as days in the range — bounded
by the calendar, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def day_spine(spark: SparkSession, start, end, name: str = "day", bounds: DataFrame | None = None) -> DataFrame:
    src = bounds if bounds is not None else spark.range(1)
    return src.select(F.explode(F.sequence(F.to_date(start), F.to_date(end))).alias(name))
