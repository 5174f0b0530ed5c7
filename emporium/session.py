"""Spark session helpers.

Jobs never build their own session; they take one.  ``get_spark`` is for
tests, the bench and local runs.  On a cluster the session comes from the
launcher and only the settings below that are *unset* get a default.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Defaults that matter for correctness (UTC clock, ANSI decimals) or for
# the plan shape (AQE re-planning, skew-join splitting).
_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "emporium") -> SparkSession:
    master = master or os.environ.get("EMPORIUM_MASTER", "local[8]")
    b = SparkSession.builder.master(master).appName(app)
    for k, v in _DEFAULTS.items():
        b = b.config(k, v)
    b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
    b = b.config("spark.driver.memory", os.environ.get("EMPORIUM_DRIVER_MEM", "8g"))
    b = b.config("spark.sql.execution.arrow.pyspark.enabled", "true")
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session; a scratch folder is made
    only for a local session (tests) without one.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None)
    if cur:
        if spark.sparkContext.getCheckpointDir() is None:
            spark.sparkContext.setCheckpointDir(cur)
        return cur
    existing = spark.sparkContext.getCheckpointDir()
    if existing:
        return existing
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    path = tempfile.mkdtemp(prefix="emporium-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path
