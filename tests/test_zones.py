"""The resume by zone map: same rows, fewer parts."""

from __future__ import annotations

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from fuelsight import schemas as S
from fuelsight.operators import zones as Z
from fuelsight.operators.incremental import after_checkpoint
from fuelsight.sources.commits import Store

START = dt.datetime(2024, 1, 1)
MARKS = "vin string, stype string, per100 int"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


def days(spark, first, last, vins=6):
    """Three readings of the odometer and of the injection a day; every vehicle drives 40 km a day."""
    rows = []
    for v in range(vins):
        for d in range(first, last):
            for h in (6, 12, 18):
                at = START + dt.timedelta(days=d, hours=h, minutes=v)
                rows += [(f"V{v}", at, S.ODOMETER, 40.0 * d + h), (f"V{v}", at, S.INJECTION, 1.0)]
    return spark.createDataFrame(rows, S.SIGNAL)


def test_only_parts_from_the_restart_on_are_read(spark):
    store = Store(spark, tempfile.mkdtemp(prefix="zones-"))
    Z.add_signals(store, days(spark, 0, 20), buckets=4)
    Z.add_signals(store, days(spark, 20, 30), buckets=4)
    signals = days(spark, 0, 30)
    marks = spark.createDataFrame([(f"V{v}", S.INJECTION, 9 + v % 2) for v in range(6)], MARKS)  # day 22 or later
    assert rows_of(Z.after_checkpoint_zoned(store, marks, S.INJECTION, 4)) == rows_of(after_checkpoint(signals, marks, S.INJECTION))
    there = len(store.manifest()["tables"][Z.SIGNALS]["parts"])
    first, _, parts = Z.resume_parts(store, marks, S.INJECTION, 4)
    assert 0 < len(first) <= there * 9 // 30 and 0 < len(parts) <= there * 9 // 30
    assert {p.split("_")[1] for p in parts} <= {str((START + dt.timedelta(days=d)).date()) for d in range(21, 30)}


def test_an_unmarked_vehicle_brings_its_bucket_only(spark):
    store = Store(spark, tempfile.mkdtemp(prefix="zones-"))
    signals = days(spark, 0, 20)
    Z.add_signals(store, signals, buckets=4)
    marks = spark.createDataFrame([(f"V{v}", S.INJECTION, 7) for v in range(1, 6)], MARKS)
    assert rows_of(Z.after_checkpoint_zoned(store, marks, S.INJECTION, 4)) == rows_of(after_checkpoint(signals, marks, S.INJECTION))
    buckets = spark.createDataFrame([("V0",)], "vin string").select(Z._bucket(4)).first()[0]
    _, _, parts = Z.resume_parts(store, marks, S.INJECTION, 4)
    early = {p.split("_")[0] for p in parts if p.split("_")[1] < "2024-01-10"}
    assert early == {str(buckets)}


def test_a_day_that_comes_again_and_edge_cases(spark):
    store = Store(spark, tempfile.mkdtemp(prefix="zones-"))
    Z.add_signals(store, days(spark, 0, 5), buckets=4)
    again = days(spark, 4, 5).withColumn("value", F.col("value") + 1).where("vin <> 'none'")
    Z.add_signals(store, again, buckets=4)
    odd = spark.createDataFrame([(None, START, S.ODOMETER, 900.0), ("W", None, S.ODOMETER, 900.0), ("W", START, S.ODOMETER, None)], S.SIGNAL)
    Z.add_signals(store, odd.withColumn("ts", F.col("ts") - F.expr("INTERVAL 5 DAYS")), buckets=4)
    signals = days(spark, 0, 4).unionByName(again).unionByName(odd.withColumn("ts", F.col("ts") - F.expr("INTERVAL 5 DAYS")))
    for marks in ([], [("V1", S.INJECTION, 1), ("V2", "other", 9)]):
        m = spark.createDataFrame(marks, MARKS)
        assert rows_of(Z.after_checkpoint_zoned(store, m, S.INJECTION, 4)) == rows_of(after_checkpoint(signals, m, S.INJECTION))
