"""Windowed detectors: stream = batch, alert payloads, the two-query runner."""

from __future__ import annotations

import json
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL, T
from fuelsight import fixtures as FX
from fuelsight import schemas as S
from fuelsight.streaming.detectors import (fuel_summary, low_fuel_alerts, low_fuel_windows,
                                           run_detectors, stream_signals)


def _split_files(spark, df, bounds, prefix):
    src = tempfile.mkdtemp(prefix=prefix)
    for i in range(len(bounds) - 1):
        part = df.where((F.col("ts") >= F.lit(bounds[i]).cast("timestamp_ntz"))
                        & (F.col("ts") < F.lit(bounds[i + 1]).cast("timestamp_ntz")))
        part.coalesce(1).write.parquet(os.path.join(src, f"b={i}"))
    return src


def test_low_fuel_reference_defaults_on_dense_rows(spark, signals_df):
    rows = [("V1", f"2024-01-01 10:00:{s:02d}", S.FUEL_LEVEL, 8.0 if s >= 20 else 30.0) for s in range(0, 60, 2)]
    out = low_fuel_windows(signals_df(rows)).collect()
    starts = sorted(str(r.window_start) for r in out)
    # 30 s windows sliding by 10 s: only windows made of readings >= 20 s fall below 10
    assert starts[0] == "2024-01-01 10:00:20" and all(r.avg_level < 10 for r in out)
    alert = low_fuel_alerts(low_fuel_windows(signals_df(rows))).first()
    body = json.loads(alert.payload)
    assert body["msgType"] == "lowFuel" and body["msgPara"][0]["type"] == "currentFuel"


def test_low_fuel_stream_equals_batch(spark):
    sig = FX.load(spark, SF_SMALL)["signals"]
    closing = spark.createDataFrame([("ZZZ", T("2024-03-01 00:00:00"), S.FUEL_LEVEL, 50.0)], S.SIGNAL)
    src = _split_files(spark, sig.unionByName(closing), ["2024-01-01", "2024-01-15", "2024-02-01", "2024-04-01"],
                       "lowfuel-")
    stream = (spark.readStream.schema(S.SIGNAL).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    q = (low_fuel_windows(stream, "6 hours", "2 hours", 20.0, watermark="1 hour")
         .writeStream.format("memory").queryName("lowfuel_stream").outputMode("append")
         .option("checkpointLocation", tempfile.mkdtemp()).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = sorted(map(tuple, spark.table("lowfuel_stream").collect()))
    want = sorted(map(tuple, low_fuel_windows(sig, "6 hours", "2 hours", 20.0).collect()))
    assert got == want and len(want) > 0


def test_fuel_summary_votes_and_last_level(spark, signals_df):
    rows = [("V1", "2024-01-01 10:00:00", S.FUEL_LEVEL, 40), ("V1", "2024-01-01 10:00:03", S.FUEL_LEVEL, 38),
            ("V1", "2024-01-01 10:00:01", S.SPEED, 0), ("V1", "2024-01-01 10:00:02", S.SPEED, 20),
            ("V1", "2024-01-01 10:00:04", S.SPEED, 30)]
    r = fuel_summary(signals_df(rows)).first()
    assert (r.mean_level, r.last_level, r.is_drive) == (39.0, 38.0, True)


def test_run_detectors_end_to_end(spark):
    env = FX.derive(spark, SF_SMALL)["envelopes"]
    src = tempfile.mkdtemp(prefix="env-src-")
    env.repartition(3).write.mode("overwrite").parquet(src)
    raw = spark.readStream.schema(S.ENVELOPE).option("maxFilesPerTrigger", 1).parquet(src)
    out, ckpt = tempfile.mkdtemp(prefix="alerts-"), tempfile.mkdtemp(prefix="ckpt-")
    queries = run_detectors(stream_signals(raw), out, ckpt, "1 hour", trigger={"availableNow": True},
                            low_fuel={"window": "6 hours", "slide": "2 hours", "threshold": 20.0})
    for q in queries:
        q.awaitTermination(300)
    refuel = spark.read.parquet(os.path.join(out, "refuel"))
    assert refuel.count() > 0 and "payload" in refuel.columns
    assert spark.read.parquet(os.path.join(out, "low_fuel")).count() > 0


def test_late_and_unusable_levels_are_kept(spark):
    rows = [("V1", "20240101100001000", "2024-01-01 10:00:00", "5"), ("V1", "20240101120000000", "2024-01-01 10:00:02", "6"),
            ("V1", "20240101100009000", "2024-01-01 10:00:04", "none")]
    env = [(v, t, json.dumps([{"ts": r, "stype": S.FUEL_LEVEL, "value": None if x == "none" else float(x)}])) for v, t, r, x in rows]
    src = tempfile.mkdtemp(prefix="late-")
    spark.createDataFrame(env, S.ENVELOPE).write.mode("overwrite").parquet(src)
    out, ckpt = tempfile.mkdtemp(prefix="late-out-"), tempfile.mkdtemp(prefix="late-ckpt-")
    for q in run_detectors(stream_signals(spark.readStream.schema(S.ENVELOPE).parquet(src)), out, ckpt, "1 hour", trigger={"availableNow": True}):
        q.awaitTermination(300)
    assert [r.value for r in spark.read.parquet(f"{out}/late").collect()] == [6.0]
    assert spark.read.parquet(f"{out}/unusable").count() == 1
    assert not os.path.exists(f"{out}/refuel")  # no folder for an epoch without rows


def test_fuel_summary_stream_equals_batch(spark):
    sig = FX.load(spark, SF_SMALL)["signals"]
    closing = spark.createDataFrame([("ZZZ", T("2024-03-01 00:00:00"), S.FUEL_LEVEL, 50.0)], S.SIGNAL)
    src = _split_files(spark, sig.unionByName(closing), ["2024-01-01", "2024-01-15", "2024-02-01", "2024-04-01"],
                       "summary-")
    stream = (spark.readStream.schema(S.SIGNAL).option("maxFilesPerTrigger", 1)
              .option("recursiveFileLookup", "true").parquet(src))
    q = (fuel_summary(stream, "1 day", watermark="1 hour").writeStream.format("memory")
         .queryName("summary_stream").outputMode("append")
         .option("checkpointLocation", tempfile.mkdtemp()).trigger(availableNow=True).start())
    q.awaitTermination(300)
    got = sorted(map(tuple, spark.table("summary_stream").collect()))
    want = sorted(map(tuple, fuel_summary(sig, "1 day").collect()))
    assert got == want and len(want) > 0
