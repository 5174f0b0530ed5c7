"""Reports appended by run date, published idempotently.

A run's rows go to ``<folder>/run_date=<date>/version=<n>``, an immutable
Parquet folder that counts as published once Spark's commit has written its
``_SUCCESS`` marker.  Readers take the last published version of every run, so
a run that is repeated replaces its own rows (also by none), a run that failed
leaves nothing to see, and other runs are never rewritten.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _versions(spark: SparkSession, folder: str) -> dict[str, list[tuple[int, bool]]]:
    """``(version, published)`` of every run date."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    root = path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    out: dict[str, list[tuple[int, bool]]] = {}
    for run in fs.listStatus(root) if fs.exists(root) else []:
        date = run.getPath().getName().removeprefix("run_date=")
        for version in fs.listStatus(run.getPath()):
            n = int(version.getPath().getName().removeprefix("version="))
            out.setdefault(date, []).append((n, fs.exists(path(version.getPath(), "_SUCCESS"))))
    return out


def publish(report: DataFrame, folder: str, run_date: str) -> None:
    """Publishes the rows of the run of ``run_date`` (``yyyy-mm-dd``)."""
    taken = _versions(report.sparkSession, folder).get(run_date, [])
    report.write.parquet(f"{folder}/run_date={run_date}/version={max((n for n, _ in taken), default=0) + 1}")


def history(spark: SparkSession, folder: str) -> DataFrame:
    """All published runs with their ``run_date``; needs one run at least.
    Filters on ``run_date`` prune folders."""
    last = {date: max((n for n, done in versions if done), default=0) for date, versions in _versions(spark, folder).items()}
    paths = [f"{folder}/run_date={date}/version={n}" for date, n in sorted(last.items()) if n]
    return spark.read.option("basePath", folder).parquet(*paths).drop("version")
