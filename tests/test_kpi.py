"""Hand-made cases for the per-day / per-100-km KPIs."""

from __future__ import annotations

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fuelsight import fixtures as FX
from fuelsight import schemas as S
from fuelsight.operators import algebra, kpi
from fuelsight.operators.asof import asof_running_max
from fuelsight.operators.wide import to_second_rows

SP, RPM, INJ, AC, ODO = S.SPEED, S.RPM, S.INJECTION, S.AIRCON, S.ODOMETER


def facts(df, key="now_date"):
    return {(r["vin"], str(r[key]), r["data_key"]): r["data_value"] for r in df.collect()}


def test_second_rows_sum_samples_of_one_second(signals_df):
    sig = signals_df([
        ("V1", "2024-01-01 10:00:00.1", SP, 0), ("V1", "2024-01-01 10:00:00.5", SP, 0),
        ("V1", "2024-01-01 10:00:00.2", RPM, 400), ("V1", "2024-01-01 10:00:00.7", RPM, 400),
        ("V1", "2024-01-01 10:00:00.3", INJ, 1.5), ("V1", "2024-01-01 10:00:00.8", INJ, 2.5),
        ("V1", "2024-01-01 10:00:01.0", SP, 5), ("V1", "2024-01-01 10:00:01.0", RPM, 900),
        ("V1", "2024-01-01 10:00:01.0", INJ, 4.0),
    ])
    wide = {r["sec"]: r for r in to_second_rows(sig).collect()}
    assert len(wide) == 2
    first = wide[min(wide)]
    assert (first["speed"], first["rpm"], first["fuel"]) == (0.0, 800.0, 4.0)
    idle = facts(kpi.fuel_by_day(to_second_rows(sig), "idle"))
    driving = facts(kpi.fuel_by_day(to_second_rows(sig), "driving"))
    assert idle == {("V1", "2024-01-01", "D002"): 4.0}
    assert driving == {("V1", "2024-01-01", "D003"): 4.0}


def test_engine_off_is_neither_idle_nor_driving(signals_df):
    sig = signals_df([("V1", "2024-01-01 10:00:00", SP, 0), ("V1", "2024-01-01 10:00:00", RPM, 0),
                      ("V1", "2024-01-01 10:00:00", INJ, 3.0)])
    wide = to_second_rows(sig)
    assert kpi.fuel_by_day(wide, "idle").count() == 0
    assert kpi.fuel_by_day(wide, "driving").count() == 0


def test_total_fuel_keeps_largest_sample_per_tenth(signals_df):
    sig = signals_df([
        ("V1", "2024-01-01 10:00:00.01", INJ, 2.0), ("V1", "2024-01-01 10:00:00.05", INJ, 3.0),
        ("V1", "2024-01-01 10:00:00.15", INJ, 1.0), ("V1", "2024-01-02 00:00:00.00", INJ, 7.0),
    ])
    got = facts(kpi.total_fuel_by_day(sig))
    assert got == {("V1", "2024-01-01", "D001"): 4.0, ("V1", "2024-01-02", "D001"): 7.0}
    fused = facts(kpi.daily_kpis(sig, rate=1.0))
    assert fused[("V1", "2024-01-01", "D001")] == 4.0


def test_total_fuel_day_range_is_half_open(signals_df):
    sig = signals_df([("V1", "2024-01-01 00:00:00", INJ, 1.0), ("V1", "2024-01-02 00:00:00", INJ, 2.0)])
    got = facts(kpi.total_fuel_by_day(sig, "2024-01-01", "2024-01-02"))
    assert got == {("V1", "2024-01-01", "D001"): 1.0}


def test_mileage_is_max_minus_min_per_calendar_day(signals_df):
    sig = signals_df([("V1", "2024-01-01 08:00:00", ODO, 100), ("V1", "2024-01-01 20:00:00", ODO, 180),
                      ("V1", "2024-01-02 09:00:00", ODO, 185)])
    got = facts(kpi.mileage_by_day(sig))
    assert got == {("V1", "2024-01-01", "D006"): 80.0, ("V1", "2024-01-02", "D006"): 0.0}


def test_aircon_rate_votes_and_missing_state(spark, signals_df):
    base = "2024-01-01 10:00:00"
    sig = signals_df([
        ("V1", base, AC, 1), ("V1", base, AC, 0), ("V1", base, INJ, 2.0),   # tie -> on
        ("V1", "2024-01-01 10:00:01", AC, 0), ("V1", "2024-01-01 10:00:01", INJ, 1.0),  # off
        ("V1", "2024-01-01 10:00:02", INJ, 1.0),                            # no sample -> on
    ])
    r = kpi.aircon_rate(sig).collect()[0]
    assert (r["on_ms"], r["off_ms"], r["on_fuel"], r["off_fuel"]) == (200, 100, 3.0, 1.0)
    on_h, off_h = 200 / 3.6e6, 100 / 3.6e6
    assert abs(r["rate"] - ((3.0 / on_h - 1.0 / off_h) * on_h / 4.0)) < 1e-12
    only_on = signals_df([("V1", base, AC, 1), ("V1", base, INJ, 2.0)])
    assert kpi.aircon_rate(only_on).collect()[0]["rate"] is None


def test_aircon_day_state_options(signals_df):
    sig = signals_df([
        ("V1", "2024-01-01 10:00:00", AC, 1), ("V1", "2024-01-01 10:00:00", INJ, 2.0),
        ("V1", "2024-01-01 10:00:01", AC, 0), ("V1", "2024-01-01 10:00:01", INJ, 3.0),
    ])
    wide = to_second_rows(sig)
    assert facts(kpi.aircon_by_day(wide, 0.5))[("V1", "2024-01-01", "D004")] == 1.0
    assert facts(kpi.aircon_by_day(wide, None, "off"))[("V1", "2024-01-01", "D004")] == 3.0
    assert facts(kpi.aircon_by_day(wide, None, "all"))[("V1", "2024-01-01", "D004")] == 5.0


def test_fused_daily_equals_separate_operators(spark):
    sig = FX.load(spark, SF_SMALL)["signals"]
    fused = facts(kpi.daily_kpis(sig))
    separate = facts(kpi.daily_kpis_separate(sig))
    assert fused.keys() == separate.keys()
    for k, v in fused.items():
        assert abs(v - separate[k]) <= 1e-9 * max(1.0, abs(v))


def test_other_fuel_needs_all_four_inputs(spark):
    rows = [("V1", dt.date(2024, 1, 1), c, v) for c, v in
            [("D001", 10.0), ("D002", 1.0), ("D003", 2.0), ("D004", 3.0)]]
    rows += [("V1", dt.date(2024, 1, 2), c, v) for c, v in [("D001", 10.0), ("D002", 1.0), ("D003", 2.0)]]
    kd = spark.createDataFrame(rows, S.KPI_DAY)
    got = facts(algebra.other_fuel(kd, "day"))
    assert got == {("V1", "2024-01-01", "D005"): 4.0}


def test_lifetime_totals_map_each_code_to_its_own_input(spark):
    rows = [("V1", dt.date(2024, 1, d), c, float(d)) for d in (1, 2)
            for c in ("D001", "D002", "D003", "D004", "D005", "D006")]
    kd = spark.createDataFrame(rows, S.KPI_DAY)
    got = {(r["vin"], r["attribute_type"]): r["attribute_value"] for r in algebra.lifetime_totals(kd).collect()}
    assert got == {("V1", c): 3.0 for c in ("C001", "C002", "C003", "C004", "C005")}
    km = spark.createDataFrame([("V1", 0, "KM001", 4.0), ("V1", 100, "KM001", 6.0)], S.KPI_KM)
    assert algebra.avg_fuel_per_100km(km).collect()[0]["attribute_value"] == 5.0


def test_asof_bucket_sees_equal_timestamps_and_drops_unknown(signals_df):
    sig = signals_df([
        ("V1", "2024-01-01 09:00:00", INJ, 1.0),            # before any odometer: dropped
        ("V1", "2024-01-01 10:00:00", ODO, 150), ("V1", "2024-01-01 10:00:00", INJ, 2.0),
        ("V1", "2024-01-01 12:30:00", ODO, 120),            # lower reading: running max stays
        ("V1", "2024-01-01 12:30:00", INJ, 3.0),
        ("V1", "2024-01-02 12:00:00", ODO, 260), ("V1", "2024-01-02 12:00:01", INJ, 4.0),
    ])
    got = facts(kpi.total_fuel_by_km(sig, complete_only=False), "mileage")
    assert got == {("V1", "100", "KM001"): 500.0, ("V1", "200", "KM001"): 400.0}
    done = facts(kpi.total_fuel_by_km(sig), "mileage")
    assert done == {("V1", "100", "KM001"): 500.0}


def test_complete_only_rerun_after_checkpoint_adds_nothing(spark):
    fx = FX.load(spark, SF_SMALL)
    sig = fx["signals"]
    first = kpi.total_fuel_by_km(sig)
    keys = {(r["vin"], r["mileage"]) for r in first.collect()}
    # advance the checkpoint to each vehicle's first unfinished bucket and rerun
    ckpt = first.groupBy("vin").agg((F.max("mileage") / 100 + 1).cast("int").alias("per100")) \
        .select("vin", F.lit(S.INJECTION).alias("stype"), "per100")
    again = {(r["vin"], r["mileage"]) for r in kpi.total_fuel_by_km(sig, ckpt).collect()}
    assert not (again & keys)


def test_asof_running_max_matches_plain_window(spark):
    rnd = random.Random(7)
    rows = []
    for v in ("A", "B", "C"):
        for _ in range(300):
            t = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rnd.randrange(0, 4 * 86400))
            rows.append((v, t, rnd.choice([None, float(rnd.randrange(0, 1000))])))
    df = spark.createDataFrame(rows, "k string, ts timestamp_ntz, x double")
    ours = asof_running_max(df, ["k"], "ts", "x", "m", chunk_seconds=7200)
    w = Window.partitionBy("k").orderBy("ts").rangeBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn("m", F.max("x").over(w))
    assert sorted(map(tuple, ours.select("k", "ts", "x", "m").collect()), key=repr) == \
        sorted(map(tuple, plain.select("k", "ts", "x", "m").collect()), key=repr)


def test_km_bucket_same_second_vs_asof(signals_df):
    sig = signals_df([
        ("V1", "2024-01-01 10:00:00", ODO, 250), ("V1", "2024-01-01 10:00:00", SP, 5),
        ("V1", "2024-01-01 10:00:00", RPM, 900), ("V1", "2024-01-01 10:00:00", INJ, 1.0),
        ("V1", "2024-01-01 10:00:01", SP, 5), ("V1", "2024-01-01 10:00:01", RPM, 900),
        ("V1", "2024-01-01 10:00:01", INJ, 2.0),                      # no odometer in this second
        ("V1", "2024-01-01 09:59:59", SP, 5), ("V1", "2024-01-01 09:59:59", RPM, 900),
        ("V1", "2024-01-01 09:59:59", INJ, 4.0),                      # before the first odometer
    ])
    same = facts(kpi.fuel_by_km(to_second_rows(sig, with_km=True), "driving"), "mileage")
    asof = facts(kpi.fuel_by_km(to_second_rows(sig, with_km=True, bucket="asof"), "driving"), "mileage")
    assert same == {("V1", "200", "KM003"): 1.0, ("V1", "0", "KM003"): 6.0}
    assert asof == {("V1", "200", "KM003"): 3.0, ("V1", "0", "KM003"): 4.0}
