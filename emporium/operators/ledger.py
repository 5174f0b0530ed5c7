"""Running totals with a floor at zero, without collecting groups.

A trigger that does ``x = GREATEST(0, x + d)`` per event is not a plain
sum.  With P_k = x0 + d1 + ... + dk the floored value after n events is
(reflection at zero, Lindley's recursion)

    x_n = P_n - min(0, min_{1<=k<=n} P_k)        for x0 >= 0.

The running sums come from :func:`emporium.operators.scan.keyed_running`
(a hot key is split over many tasks); the minimum and the total are then
ordinary aggregates with map-side partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.operators.scan import keyed_running


def floored_totals(events: DataFrame, start: DataFrame, key: str, delta: str,
                   order: list[str], start_col: str = "start") -> DataFrame:
    """``events(key, delta, order...)`` and ``start(key, start)`` ->
    ``(key, final)`` for every key with at least one event."""
    ev = events.select(key, delta, *order)
    run = keyed_running(ev, [key], order, sums={"_run": delta})
    g = run.groupBy(key).agg(F.sum(delta).alias("_sum"), F.min("_run").alias("_minrun"))
    g = g.join(start.select(key, start_col), key, "left").withColumn(
        "_s0", F.coalesce(F.col(start_col), F.lit(0)))
    # min_k P_k = x0 + min_k (running sum up to k)
    final = F.col("_s0") + F.col("_sum") - F.least(F.lit(0), F.col("_s0") + F.col("_minrun"))
    return g.select(key, final.alias("final"))
