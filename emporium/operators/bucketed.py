"""Keyed tables in hash buckets: a change rewrites only the buckets it touches.

Version ``n`` of a table is the folder ``v=<n>`` with one folder
``bucket=<b>`` for every bucket that version changed; it counts as published
once Spark's commit has written its ``_SUCCESS`` marker.  The current rows of a
bucket are those of its last published version, so a change of a few keys costs
their buckets, not the table; a version that is written again (a re-run
micro-batch) starts from the versions before it and replaces itself.

A row's bucket is the hash of its key over a fixed number of buckets, the same
for all changes of a table; choose it so that a bucket suits one task (unique
keys spread evenly).  Changes hold one row per key.  Rows with a null in the key all
lie in the bucket of that hash and are only ever added, as ``overlay`` does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emporium.operators import overlay

BUCKETS = 64


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any store that Spark reads (none if it is not there)."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def versions(spark: SparkSession, folder: str) -> dict[int, list[int]]:
    """Published versions and the buckets that each of them wrote."""
    out = {}
    for name in listed(spark, folder):
        if name.startswith("v="):
            inside = listed(spark, f"{folder}/{name}")
            if "_SUCCESS" in inside:
                out[int(name[2:])] = sorted(int(x.removeprefix("bucket=")) for x in inside if x.startswith("bucket="))
    return dict(sorted(out.items()))


def _current(spark: SparkSession, folder: str, before: int | None) -> dict[int, int]:
    """Bucket -> its last version (below ``before``)."""
    last: dict[int, int] = {}
    for n, buckets in versions(spark, folder).items():
        if before is None or n < before:
            last |= dict.fromkeys(buckets, n)
    return last


def _rows(spark: SparkSession, folder: str, last: dict[int, int], schema) -> DataFrame:
    paths = [f"{folder}/v={n:012d}/bucket={b}" for b, n in sorted(last.items())]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read(spark: SparkSession, folder: str, schema) -> DataFrame:
    """The table's current rows."""
    return _rows(spark, folder, _current(spark, folder, None), schema)


def _change(how: Callable[[DataFrame, DataFrame], DataFrame], folder: str, change: DataFrame, keys: list[str],
            version: int | None, buckets: int) -> None:
    spark, schema = change.sparkSession, change.schema
    published = versions(spark, folder)
    n = max(published, default=-1) + 1 if version is None else version
    bucketed = change.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
    touched = {r.bucket for r in bucketed.select("bucket").distinct().collect()}  # at most `buckets` numbers
    last = {b: v for b, v in _current(spark, folder, n).items() if b in touched}
    new = how(_rows(spark, folder, last, schema), change) if last else change
    (new.withColumn("bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
     .repartition(max(1, len(touched)), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{folder}/v={n:012d}"))


def upsert(folder: str, change: DataFrame, keys: list[str], version: int | None = None, buckets: int = BUCKETS) -> None:
    """Publishes the table with the rows of ``change`` added or, by key, updated."""
    _change(lambda old, new: overlay.upsert(old, new, keys), folder, change, keys, version, buckets)


def replace_rows(folder: str, change: DataFrame, keys: list[str], version: int | None = None, buckets: int = BUCKETS) -> None:
    """Publishes the table with the rows of ``change`` in place of those of equal key."""
    _change(lambda old, new: overlay.replace_rows(old, new, keys), folder, change, keys, version, buckets)


def insert_ignore(folder: str, change: DataFrame, keys: list[str], version: int | None = None, buckets: int = BUCKETS) -> None:
    """Publishes the table with those rows of ``change`` whose key is new."""
    _change(lambda old, new: overlay.insert_ignore(old, new, keys), folder, change, keys, version, buckets)
