"""Bucketed tables: same rows as a whole-table overlay, few buckets rewritten."""

from pyspark.sql import functions as F

from emporium.operators import bucketed, overlay


def _files(spark, folder, version):
    return len(spark.read.parquet(f"{folder}/v={version:012d}").inputFiles())


def test_change_rewrites_its_buckets_only(spark, tmp_path):
    folder = str(tmp_path / "t")
    base = spark.range(2000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("x"))
    bucketed.upsert(folder, base, ["k"], buckets=16)
    change = spark.createDataFrame([(7, -1), (5000, 5)], base.schema)
    bucketed.upsert(folder, change, ["k"], buckets=16)
    touched = bucketed.versions(spark, folder)
    assert touched[0] == list(range(16)) and 1 <= len(touched[1]) <= 2
    assert _files(spark, folder, 0) == 16 and _files(spark, folder, 1) == len(touched[1])
    want = sorted(map(tuple, overlay.upsert(base, change, ["k"]).collect()))
    assert sorted(map(tuple, bucketed.read(spark, folder, base.schema).collect())) == want


def test_rerun_replace_and_ignore(spark, tmp_path):
    folder = str(tmp_path / "t")
    row = "k long, x long"
    old = spark.createDataFrame([(1, 10), (2, 20), (3, 30)], row)
    new = spark.createDataFrame([(2, 21), (4, 40)], row)
    rows = lambda: sorted(map(tuple, bucketed.read(spark, folder, old.schema).collect()))
    assert rows() == []
    bucketed.upsert(folder, old, ["k"], version=0)
    for _ in range(2):  # a micro-batch run again starts from the version before it
        bucketed.replace_rows(folder, new, ["k"], version=1)
        assert rows() == [(1, 10), (2, 21), (3, 30), (4, 40)]
    bucketed.insert_ignore(folder, spark.createDataFrame([(1, 99), (5, 50)], row), ["k"])
    assert rows() == [(1, 10), (2, 21), (3, 30), (4, 40), (5, 50)]
    bucketed.upsert(folder, old.limit(0), ["k"])  # an empty change keeps everything
    assert len(rows()) == 5


def test_unpublished_version_is_not_read(spark, tmp_path):
    folder = str(tmp_path / "t")
    old = spark.createDataFrame([(1, 10)], "k long, x long")
    bucketed.upsert(folder, old, ["k"])
    bucketed.upsert(folder, spark.createDataFrame([(1, 11)], old.schema), ["k"])
    (tmp_path / "t" / f"v={1:012d}" / "_SUCCESS").unlink()
    assert [tuple(r) for r in bucketed.read(spark, folder, old.schema).collect()] == [(1, 10)]
