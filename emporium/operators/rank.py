"""Ordering operators that stay distributed.

``global_row_number`` numbers all rows of a DataFrame by a total order
without the single-partition window Spark plans for
``row_number() OVER (ORDER BY ...)``:

1. range-partition on the order keys (sampled bounds, so balanced when the
   keys are unique) and sort inside each partition;
2. materialise that once with ``checkpoint()`` into the cluster's shared
   checkpoint folder, so both uses below see the same partitions;
3. count rows per partition (one row per partition, broadcast: bounded by
   the partition count), turn the counts into offsets;
4. row number = partition offset + position inside the partition.

``top_k`` is the constant-k form (Spark plans TakeOrderedAndProject).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from emporium.session import ensure_checkpoint_dir


def spread(df: DataFrame, rows: int, per_task: int, *keys: str) -> DataFrame:
    """``df`` dealt out by ``keys`` so that a task gets about ``per_task`` of its
    ``rows``, however well they compress (AQE merges partitions by stored bytes)."""
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-rows // per_task)), *keys)


def global_row_number(df: DataFrame, order: list[Column], name: str = "row_number",
                      partitions: int | None = None) -> DataFrame:
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_df = (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
                 .withColumn("_part", F.spark_partition_id())
                 .withColumn("_mono", F.monotonically_increasing_id()))
    # Reliable checkpoint: written to the shared folder, survives executor loss.
    sorted_df = sorted_df.checkpoint(eager=True)
    counts = sorted_df.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition -> tiny; a single-partition window here is fine
    w = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(w), F.lit(0)).alias("_offset"))
    first_mono = F.shiftleft(F.col("_part").cast("bigint"), 33)
    return (sorted_df.join(F.broadcast(offsets), "_part")
            .withColumn(name, F.col("_offset") + (F.col("_mono") - first_mono) + 1)
            .drop("_part", "_mono", "_offset"))


def top_k(df: DataFrame, k: int, order: list[Column]) -> DataFrame:
    """Constant top-k: planned as TakeOrderedAndProject (per-task heaps)."""
    return df.orderBy(*order).limit(k)


def top_k_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int,
                  name: str = "rank") -> DataFrame:
    """``row_number() <= k`` per key; Spark inserts a partial WindowGroupLimit
    before the shuffle, so even a hot key sends at most k rows per task."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= k)
