"""The key-ordered table: same rows as the filter and aggregate of S6, from the blocks of the range only."""

from __future__ import annotations

import datetime as dt
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from fuelsight.sources import ranges as R
from fuelsight.sources.readers import read_range

SCHEMA = "vin string, ts timestamp_ntz, version long, value double"


@pytest.fixture(scope="module")
def table(spark):
    """Three loads of a table in which one vehicle holds a third of all rows; later loads replace some of the rows."""
    df = spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("V"), F.lpad((F.col("id") % 40).cast("string"), 2, "0"))).alias("vin"),
        F.timestamp_add("HOUR", F.col("id") % 700, F.lit("2024-01-01").cast("timestamp_ntz")).alias("ts"),
        F.col("id").alias("version"), (F.col("id") * 0.5).alias("value"))
    path = tempfile.mkdtemp(prefix="runs-") + "/t"
    for i in range(3):
        R.write_run(df.where(F.col("id") % 3 == i) if i == 0 else df.where(F.pmod(F.xxhash64("version"), F.lit(2)) == i - 1),
                    path, rows_per_file=700, rows_per_block=50)
    return path, df


def rows_of(df):
    return sorted(tuple(r) for r in df.select("vin", "ts", "version", "value").collect())


def test_equals_filter_and_aggregate(spark, table):
    path, df = table
    assert rows_of(R.read_runs(spark, path)) == rows_of(read_range(df, None, None))
    for start, end in (("2024-01-05", "2024-01-11"), (None, "2024-01-02"), ("2024-01-29", None), ("2030-01-01", None)):
        assert rows_of(R.read_runs(spark, path, start, end)) == rows_of(read_range(df, start, end))
    some = R.read_runs(spark, path, "2024-01-05", "2024-01-20", keys=["HOT", "V07", "none"])
    assert rows_of(some) == rows_of(read_range(df.where("vin IN ('HOT', 'V07')"), "2024-01-05", "2024-01-20"))
    assert rows_of(R.read_runs(spark, path, key_from="V10", key_to="V20")) == rows_of(read_range(df.where("vin >= 'V10' AND vin < 'V20'")))
    every = R.read_runs(spark, path, keys=["V07"], latest=False)
    # the first load holds no V07 that the other two do not hold as well
    assert every.count() == df.where("vin = 'V07'").count() + df.where("vin = 'V07' AND version % 3 = 0").count()


def touched(reader):
    """(blocks read, blocks there) of the tasks that a reader plans."""
    per_file = {}
    for task in reader.partitions():
        for file, groups, _ in R.blocks(task, reader.path, reader.key, reader.ts):
            per_file.setdefault(file, set()).update(groups)
    fs, _ = R.file_system(reader.path)
    there = sum(R.pq.read_metadata(r["file"], filesystem=fs).num_row_groups for d in R.directories(reader.path) for r in d["files"])
    return sum(map(len, per_file.values())), there


def test_only_blocks_of_the_range_are_read(table):
    path, _ = table
    every, there = touched(R.RangeReader(path, {}))
    assert every == there > 150
    one, _ = touched(R.RangeReader(path, {"keys": '["V07"]', "start": "2024-01-05", "end": "2024-01-06"}))
    assert 0 < one <= 8
    hot, _ = touched(R.RangeReader(path, {"keys": '["HOT"]', "start": "2024-01-05", "end": "2024-01-06"}))
    assert 0 < hot <= there // 8  # a day of the vehicle with a third of the rows
    assert touched(R.RangeReader(path, {"keys": '["none"]'}))[0] <= 3


def test_pushed_filters_narrow_the_range(spark, table):
    path, df = table
    reader = R.PushingReader(path, {})
    left = list(reader.pushFilters([R.EqualTo(("vin",), "V07"), R.GreaterThanOrEqual(("ts",), dt.datetime(2024, 1, 5)),
                                    R.LessThan(("ts",), dt.datetime(2024, 1, 6)), R.EqualTo(("value",), 1.0)]))
    assert len(left) == 4 and 0 < touched(reader)[0] <= 8
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        got = R.read_runs(spark, path).where("vin = 'V07' AND ts >= timestamp_ntz'2024-01-05' AND ts < timestamp_ntz'2024-01-09'")
        assert rows_of(got) == rows_of(read_range(df.where("vin = 'V07'"), "2024-01-05", "2024-01-09"))
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_tasks_split_the_hot_vehicle_and_nothing_is_shuffled(spark, table):
    path, _ = table
    tasks = R.RangeReader(path, {"keys": '["HOT"]'}).partitions()
    assert len(tasks) > 2 and all(a.high == b.low for a, b in zip(tasks, tasks[1:]))
    plan = R.read_runs(spark, path)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_unfinished_runs_are_not_seen(spark, table):
    path, df = table
    before = rows_of(R.read_runs(spark, path))
    bad = df.withColumn("value", F.when(F.col("version") == 5999, F.raise_error(F.lit("broken"))).otherwise(F.col("value") + 1))
    with pytest.raises(Exception, match="broken"):
        R.write_run(bad, path, rows_per_file=700, rows_per_block=50)
    assert rows_of(R.read_runs(spark, path)) == before


def test_edge_cases(spark):
    path = tempfile.mkdtemp(prefix="runs-") + "/t"
    with pytest.raises(Exception, match="no finished run"):
        R.read_runs(spark, path).count()
    one = spark.createDataFrame([("V", dt.datetime(2024, 1, 1), 1, 2.0)] * 3, SCHEMA)
    R.write_run(one.limit(0), path)
    assert R.read_runs(spark, path).count() == 0
    R.write_run(one, path)  # repeated rows: one is kept
    assert rows_of(R.read_runs(spark, path)) == rows_of(one.limit(1))
    with pytest.raises(ValueError, match="no key"):
        R.write_run(spark.createDataFrame([(None, dt.datetime(2024, 1, 1), 1, 2.0)], SCHEMA), path)
    newer = spark.createDataFrame([("V", dt.datetime(2024, 1, 1), 7, None), ("V", dt.datetime(1960, 1, 1), 1, 9.0)], SCHEMA)
    R.write_run(newer, path)
    assert [(r.version, r.value) for r in R.read_runs(spark, path).orderBy("ts").collect()] == [(1, 9.0), (7, None)]
    assert os.path.isdir(path)
