"""Reports by run date: repeated, empty and failed runs."""

import os
import shutil

from emporium.operators import report_sink


def _rows(spark, folder):
    return sorted((str(r.run_date), r.k) for r in report_sink.history(spark, folder).collect())


def test_runs_are_published_once(spark, tmp_path):
    folder, of = str(tmp_path / "report"), lambda *k: spark.createDataFrame([(x,) for x in k], "k long")
    report_sink.publish(of(1, 2), folder, "2026-01-01")
    report_sink.publish(of(1, 3), folder, "2026-01-01")  # the same run again
    report_sink.publish(of(9), folder, "2026-01-02")
    assert _rows(spark, folder) == [("2026-01-01", 1), ("2026-01-01", 3), ("2026-01-02", 9)]
    report_sink.publish(of(), folder, "2026-01-02")  # again, without rows
    assert _rows(spark, folder) == [("2026-01-01", 1), ("2026-01-01", 3)]
    # A run that did not commit is not seen, and its version is not taken again.
    last = f"{folder}/run_date=2026-01-01/version=2"
    shutil.copytree(last, f"{folder}/run_date=2026-01-01/version=3")
    os.remove(f"{folder}/run_date=2026-01-01/version=3/_SUCCESS")
    assert _rows(spark, folder) == [("2026-01-01", 1), ("2026-01-01", 3)]
    report_sink.publish(of(5), folder, "2026-01-01")
    assert _rows(spark, folder) == [("2026-01-01", 5)]
