"""Timestamp parsing, envelope unpacking, partitioned writes, KPI sinks, range reads."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL, T
from fuelsight import fixtures as FX
from fuelsight import schemas as S
from fuelsight.functions.predicates import default_range, in_range
from fuelsight.functions.timefmt import add_date_parts, date_of_parts, epoch_millis, parse_ts, register_functions
from fuelsight.operators import kpi
from fuelsight.operators.etl import drop_future_readings, explode_envelopes, split_envelopes
from fuelsight.sources.readers import parse_signals, read_range, read_signals
from fuelsight.sources.sinks import etl_job, to_json_lines, write_by_date, write_kpi


def test_parse_both_spellings(spark):
    df = spark.createDataFrame([("2017-10-31 12:32:27",), ("20171031123227890",), ("20171231235959",),
                                ("2024-12-31 00:00:00.123456",), ("not a time",), (None,),
                                ("2024-01-01T10:00:00.5",), ("20240101100000123456",)], "s string")
    want = [dt.datetime(2017, 10, 31, 12, 32, 27), dt.datetime(2017, 10, 31, 12, 32, 27, 890000),
            dt.datetime(2017, 12, 31, 23, 59, 59), dt.datetime(2024, 12, 31, 0, 0, 0, 123456), None, None,
            dt.datetime(2024, 1, 1, 10, 0, 0, 500000), dt.datetime(2024, 1, 1, 10, 0, 0, 123456)]
    assert [r[0] for r in df.select(parse_ts(F.col("s"))).collect()] == want
    assert [r[0] for r in df.select(parse_ts("s")).collect()] == want


def test_date_helpers(spark):
    df = spark.createDataFrame([(T("2024-03-05 12:00:01.250"),)], "ts timestamp_ntz")
    r = add_date_parts(df).select("year", "month", "day", epoch_millis(F.col("ts")).alias("ms"),
                                  date_of_parts(F.col("year"), F.col("month"), F.col("day")).alias("d")).first()
    assert (r.year, r.month, r.day, r.d) == (2024, 3, 5, "2024-03-05")
    assert r.ms == int(dt.datetime(2024, 3, 5, 12, 0, 1, 250000, tzinfo=dt.timezone.utc).timestamp() * 1000)
    names = register_functions(spark)
    assert "fs_parse_ts" in names
    row = spark.sql("SELECT fs_date_of_parts(2024, 1, 9) AS a, fs_parse_ts('20240109010203') AS b").first()
    assert row.a == "2024-01-09" and row.b == dt.datetime(2024, 1, 9, 1, 2, 3)


def test_default_range():
    assert default_range([], today=dt.date(2024, 1, 10)) == (dt.date(2024, 1, 9), dt.date(2024, 1, 10))
    assert default_range(["2024-01-01", "2024-01-03"]) == (dt.date(2024, 1, 1), dt.date(2024, 1, 3))


def test_explode_and_drop_future(spark):
    payload = json.dumps([{"ts": "2024-01-01 10:00:00.000000", "stype": S.FUEL_LEVEL, "value": 40.0},
                          {"ts": "20240101100005000", "stype": S.SPEED, "value": 3.0}])
    env = spark.createDataFrame([("V1", "20240101100002000", payload)], S.ENVELOPE)
    rows = explode_envelopes(env).collect()
    assert [(r.vin, r.stype, r.value) for r in rows] == [("V1", S.FUEL_LEVEL, 40.0), ("V1", S.SPEED, 3.0)]
    kept = drop_future_readings(explode_envelopes(env)).collect()
    assert [r.stype for r in kept] == [S.FUEL_LEVEL]
    # the same envelope as one JSON string column (Kafka / text form)
    text = env.select(F.to_json(F.struct("FR", "TS", "DT")).alias("value"))
    assert explode_envelopes(text).count() == 2


def test_envelopes_are_parsed_once(spark):
    """Filters on parsed times do not parse uploads a second time; null, empty and odd payloads keep their meaning."""
    env = spark.createDataFrame([("V1", "20240101100002000", p) for p in (
        None, "[]", "[{", "[null]", '[{"ts": "2024-01-01T10:00:01.1234567Z", "stype": "a", "value": 1.0}, {"ts": "noon", "stype": "b"}]')], S.ENVELOPE)
    rows = explode_envelopes(env)
    got = [tuple(r)[1:4] for r in rows.collect()]
    assert sorted(got, key=str) == sorted([(None, None, None), (T("2024-01-01 10:00:01.123456"), "a", 1.0), (None, "b", None)], key=str)
    kept = drop_future_readings(rows)
    assert [r.stype for r in kept.collect()] == ["a"]
    good, bad = split_envelopes(env)
    assert [r.stype for r in good.collect()] == ["a"]
    assert sorted(r.reason for r in bad.collect()) == ["payload", "payload", "payload", "payload", "time"]
    for df, parses in ((kept, 1), (drop_future_readings(good), 3), (bad, 3)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(") == parses


def test_parse_signal_strings(spark):
    df = spark.createDataFrame([('{"VIN":"V1","timestamp":"20240101100000","stype":"fuelLevel","value":5}',)],
                               "value string")
    r = parse_signals(df).first()
    assert (r.vin, r.ts, r.stype, r.value) == ("V1", dt.datetime(2024, 1, 1, 10), "fuelLevel", 5.0)


def test_write_by_date_roundtrip_and_partition_pruning(spark):
    sig = FX.load(spark, SF_SMALL)["signals"]
    paths = {}
    for fmt in ("parquet", "json"):
        path = paths[fmt] = tempfile.mkdtemp(prefix=f"bydate-{fmt}-")
        write_by_date(sig, path, "ts", fmt=fmt, mode="overwrite")
        back = read_signals(spark, path, fmt) if fmt == "json" else spark.read.parquet(path)
        back = back.select("vin", "ts", "stype", "value")
        assert back.exceptAll(sig).count() == 0 and sig.exceptAll(back).count() == 0
        days = sorted(os.listdir(os.path.join(path, "year=2024", "month=1")))
        assert days[0] == "day=1" and len(days) >= 28
    pruned = in_range(spark.read.parquet(paths["parquet"]), "2024-01-05", "2024-01-07", partitioned=True)
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_etl_job_writes_two_zones(spark):
    env = FX.derive(spark, SF_SMALL)["envelopes"]
    raw, clean = tempfile.mkdtemp(prefix="raw-"), tempfile.mkdtemp(prefix="clean-")
    etl_job(env, raw, clean, tempfile.mkdtemp(prefix="bad-"))
    assert spark.read.parquet(raw).count() == env.count()
    expected = drop_future_readings(explode_envelopes(env)).count()
    assert spark.read.parquet(clean).count() == expected


def test_etl_keeps_what_it_cannot_read(spark):
    good = '[{"ts": "2024-01-01 00:00:00.123456789Z", "stype": "fuelLevel", "value": "3.5"}]'
    rows = [("V1", "20240101000001000", good), ("V1", "garbage", good), ("V1", "20240101000001000", "[{"), ("V1", "20240101000001000", None),
            (None, "20240101000001000", good), ("V1", "20240101000001000", good.replace("3.5", "x")),
            ("V1", "20240101000001000", good.replace("2024-01-01", "noon"))]
    env = spark.createDataFrame(rows, S.ENVELOPE)
    raw, clean, bad = (tempfile.mkdtemp(prefix=f"{n}-") + "/t" for n in ("raw", "clean", "bad"))
    for _ in range(2):  # the same load again replaces its rows
        etl_job(env, raw, clean, bad, load="a")
    read = spark.read.parquet(clean).collect()
    assert [(r.vin, r.ts, r.value) for r in read] == [("V1", T("2024-01-01 00:00:00.123456"), 3.5)]
    reasons = sorted(r.reason for r in spark.read.parquet(bad).collect())
    assert reasons == ["payload", "payload", "send_time", "time", "value", "vin"]
    etl_job(env, raw, clean, bad, load="b")
    assert spark.read.parquet(clean).count() == 2


def test_write_kpi_append_and_truncate(spark):
    kd = kpi.daily_kpis(FX.load(spark, SF_SMALL)["signals"])
    path = tempfile.mkdtemp(prefix="kpi-") + "/day"
    write_kpi(kd, "day", target=path)
    write_kpi(kd, "day", target=path)
    assert spark.read.parquet(path).count() == 2 * kd.count()
    write_kpi(kd, "day", target=path, mode="truncate")
    assert spark.read.parquet(path).count() == kd.count()


def test_json_lines(spark):
    df = spark.createDataFrame([("V1", T("2024-01-01 00:00:00.123456"), "x", 1.0)], S.SIGNAL)
    doc = json.loads(to_json_lines(df).first().value)
    assert doc["vin"] == "V1" and doc["ts"].endswith(".123456")


def test_read_range_keeps_newest_version(spark):
    df = spark.createDataFrame([
        ("V1", T("2024-01-05 00:00:00"), 1, "old"), ("V1", T("2024-01-05 00:00:00"), 2, "new"),
        ("V1", T("2024-01-04 00:00:00"), 9, "out"), ("V2", T("2024-01-06 00:00:00"), 1, "only"),
    ], "vin string, ts timestamp_ntz, version int, data string")
    got = sorted((r.vin, r.data) for r in read_range(df, "2024-01-05", "2024-01-07", ("vin", "ts")).collect())
    assert got == [("V1", "new"), ("V2", "only")]
    assert read_range(df, "2024-01-05", "2024-01-07", latest=False).count() == 3
    # the default key is (vin, date): one row per vehicle and date, not one per vehicle
    more = df.unionByName(df.withColumn("ts", F.col("ts") + F.expr("INTERVAL 1 DAY")))
    assert read_range(more, "2024-01-04", "2024-01-09").count() == 5


def test_split_corrupt_rows(spark):
    from fuelsight.sources.readers import split_corrupt
    df = spark.createDataFrame([("V1", "2024-01-01 00:00:00", "fuelLevel", 1.0),
                                ("V1", "garbage", "fuelLevel", 1.0), (None, "2024-01-01 00:00:00", "x", 1.0)],
                               "vin string, ts string, stype string, value double")
    typed = df.withColumn("ts", parse_ts(F.col("ts")))
    good, bad = split_corrupt(typed)
    assert good.count() == 1 and bad.count() == 2


def test_parse_ts_round_trips_both_spellings(spark):
    import random
    rnd = random.Random(5)
    base = dt.datetime(2000, 1, 1)
    stamps = [base + dt.timedelta(microseconds=rnd.randrange(0, 40 * 365 * 86400 * 10**6)) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in stamps], "ts timestamp_ntz")
    out = df.select(
        "ts",
        parse_ts(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("iso"),
        parse_ts(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")).alias("iso_t"),
        parse_ts(F.date_format("ts", "yyyyMMddHHmmssSSS")).alias("compact"),
    ).collect()
    for r in out:
        assert r.iso == r.ts and r.iso_t == r.ts
        assert r.compact == r.ts.replace(microsecond=r.ts.microsecond // 1000 * 1000)


def test_readings_of_other_types_leave_before_their_times_are_parsed(spark):
    env = FX.load(spark, SF_SMALL)["envelopes"]
    nothing = spark.createDataFrame([("V", "20240101000001000", None), ("V", "20240101000001000", "[]"), ("V", "20240101000001000", "[{"),
                                     ("V", "20240101000001000", '[null, {"ts": "noon", "stype": "fuelLevel"}, {"ts": "2024-01-01 00:00:00"}]')], env.schema)
    env = env.unionByName(nothing)
    all_of_it = explode_envelopes(env).where(F.col("stype") == S.FUEL_LEVEL)
    levels = explode_envelopes(env, [S.FUEL_LEVEL])
    assert levels.count() > 4 and levels.exceptAll(all_of_it).count() == 0 and all_of_it.exceptAll(levels).count() == 0
