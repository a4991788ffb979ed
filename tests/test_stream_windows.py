"""W2 with managed state: closed windows, late rows, and a restart between files."""

import datetime as dt
import time

import pytest

from ledgerlens.streaming.windows import closed_windows

DAY0 = dt.datetime(2024, 1, 4)          # a window of whole weeks since 1970 begins here


def day(n):
    return DAY0 + dt.timedelta(days=n)


def land(spark, src, files):
    for rows in files:
        spark.createDataFrame(rows, "ts timestamp, value double").coalesce(1).write.mode("append").parquet(src)
        time.sleep(1.1)                 # files are read in the order of their times


@pytest.fixture()
def run(spark, tmp_path):
    src = str(tmp_path / "events")
    edges = spark.createDataFrame([([0.0, 1.0, 2.0],)], "edges array<double>")

    def go(files):
        land(spark, src, files)
        schema = spark.read.parquet(src).schema
        out, late = closed_windows(spark, src, "*.parquet", schema, edges, str(tmp_path / "sink"), str(tmp_path / "ck"))
        return sorted(((r.window_start - DAY0).days, r.bin, r.n) for r in out.collect()), late
    return go


def test_windows_leave_when_the_watermark_passes(run):
    files = [[(day(0), 0.5), (day(1), 1.5), (day(6), 0.5), (day(3), 9.0)], [(day(8), 0.5)], [(day(9), 1.5), (day(5), 1.5)],
             [(day(16), 0.5)]]
    # day 5 is late: the batch before it had moved the watermark to day 7
    assert run(files) == ([(0, 0, 2), (0, 1, 1), (7, 0, 1), (7, 1, 1)], 1)


def test_a_restart_goes_on_where_the_run_before_ended(run):
    assert run([[(day(0), 0.5), (day(1), 0.5)], [(day(2), 1.5)]]) == ([], 0)
    assert run([[(day(4), 0.5)], [(day(15), 0.5)]]) == ([(0, 0, 3), (0, 1, 1)], 0)
    assert run([[(day(30), 0.5)]]) == ([(0, 0, 3), (0, 1, 1), (14, 0, 1)], 0)
