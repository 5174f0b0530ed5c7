"""Running aggregates per key that do not put a whole key into one task.

``Window.partitionBy(key).orderBy(t)`` sends every row of a key to one
task.  When one product or customer holds a third of all rows, that task
holds a third of the data.  ``keyed_running`` computes the same columns
(inclusive running sums, row number within the key, previous value within
the key) as a two-level scan:

1. range-partition on ``(key, order...)`` — the bounds are sampled, so a
   hot key's ordered rows are split over many partitions, each holding a
   contiguous stretch of that key ("chunk" = key x partition);
2. materialise the chunks once with ``checkpoint()`` in the cluster's
   shared checkpoint folder (both uses below must see the same chunks, and
   a lost executor must not re-sample different bounds);
3. local windows per chunk (``partitionBy(key, chunk)``: balanced);
4. one summary row per chunk (sum, count, last row), and offsets per chunk
   from a window over the *chunk* table — at most one row per
   (key, partition), so a hot key has at most ``partitions`` rows there;
5. join the offsets back on (key, chunk) and add them.

Keys are carried as one non-null struct so NULL key values group and join
like any other value.

A sum that met only NULLs so far is NULL, as in a window over the whole key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emporium.session import ensure_checkpoint_dir

_K, _C = "_scan_key", "_scan_chunk"


def _partitions(spark, partitions: int | None) -> int:
    if partitions:
        return partitions
    conf = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        return int(conf)
    except (TypeError, ValueError):
        return spark.sparkContext.defaultParallelism


def _windowed(df: DataFrame, keys: list[str], order: list[str], sums: dict, rank: str | None, lags: dict) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    run = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(*df.columns, *[F.sum(c).over(run).alias(o) for o, c in sums.items()],
                     *([F.row_number().over(w).cast("bigint").alias(rank)] if rank else []),
                     *[F.lag(c).over(w).alias(o) for o, c in lags.items()])


def keyed_running(df: DataFrame, keys: list[str], order: list[str], *,
                  sums: dict[str, str] | None = None, rank: str | None = None,
                  lags: dict[str, str] | None = None, partitions: int | None = None,
                  whole: int | None = None) -> DataFrame:
    """Add per-key running columns over rows ordered by ``order``.

    ``sums``: ``{out: col}`` inclusive running sum of ``col``;
    ``rank``: name of a 1-based row number within the key;
    ``lags``: ``{out: col}`` value of ``col`` on the previous row of the key
    (NULL on the key's first row).  ``order`` should be a total order within
    a key (e.g. ``(ts, request_id)``) for the results to be deterministic.

    ``whole``: keys of up to that many rows are done by one window each (one
    shuffle, nothing stored), only the larger ones in chunks.  ``df`` is then
    read twice more, so it should be stored.

    The chunk id is always materialised before its two uses: evaluated
    lazily, ``spark_partition_id()`` is only the range partition while the
    plan keeps that exchange's partitioning, and AQE may change how a
    shuffle is read at run time (a forced chunked run at sf0.1 disagreed
    between the two uses without the checkpoint).
    """
    sums, lags = dict(sums or {}), dict(lags or {})
    spark = df.sparkSession
    if whole:
        ensure_checkpoint_dir(spark)
        same = [F.col(k).eqNullSafe(F.col(f"_big_{k}")) for k in keys]
        big = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > whole)
               .select(*[F.col(k).alias(f"_big_{k}") for k in keys]).checkpoint(eager=True))  # rows / whole at most
        if big.isEmpty():
            return _windowed(df, keys, order, sums, rank, lags)
        small = _windowed(df.join(F.broadcast(big), same, "left_anti"), keys, order, sums, rank, lags)
        return small.unionByName(keyed_running(df.join(F.broadcast(big), same, "left_semi"), keys, order, sums=sums,
                                               rank=rank, lags=lags, partitions=partitions))
    ensure_checkpoint_dir(spark)
    n = _partitions(spark, partitions)
    sum_types = {o: df.select(F.sum(c)).schema.fields[0].dataType for o, c in sums.items()}
    base = df.withColumn(_K, F.struct(*[F.col(k) for k in keys]))
    chunked = (base.repartitionByRange(n, F.col(_K), *[F.col(c) for c in order])
               .withColumn(_C, F.spark_partition_id())
               .checkpoint(eager=True))

    wl = Window.partitionBy(_K, _C).orderBy(*order)
    wl_run = wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = chunked
    for o, c in sums.items():
        local = local.withColumn(f"_l_{o}", F.sum(c).over(wl_run))
    local = local.withColumn("_l_rn", F.row_number().over(wl))
    for o, c in lags.items():
        local = local.withColumn(f"_l_{o}", F.lag(c).over(wl))

    last = F.struct(*[F.col(c) for c in order])
    summary = chunked.groupBy(_K, _C).agg(
        F.count(F.lit(1)).alias("_t_n"),
        *[F.sum(c).alias(f"_t_{o}") for o, c in sums.items()],
        *[F.max_by(F.col(c), last).alias(f"_t_{o}") for o, c in lags.items()])
    wc = Window.partitionBy(_K).orderBy(_C)
    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    offsets = summary.select(
        _K, _C, F.coalesce(F.sum("_t_n").over(before), F.lit(0)).alias("_o_n"),
        *[F.sum(f"_t_{o}").over(before).alias(f"_o_{o}") for o in sums],
        *[F.lag(f"_t_{o}").over(wc).alias(f"_o_{o}") for o in lags])

    out = local.join(offsets, [_K, _C])
    for o in sums:
        out = out.withColumn(o, F.when(F.col(f"_o_{o}").isNull(), F.col(f"_l_{o}"))
                             .otherwise(F.col(f"_o_{o}") + F.coalesce(F.col(f"_l_{o}"), F.lit(0))).cast(sum_types[o]))
    if rank:
        out = out.withColumn(rank, F.col("_o_n") + F.col("_l_rn"))
    for o in lags:
        out = out.withColumn(o, F.when(F.col("_l_rn") == 1, F.col(f"_o_{o}")).otherwise(F.col(f"_l_{o}")))
    added = list(sums) + ([rank] if rank else []) + list(lags)
    return out.select(*df.columns, *added)
