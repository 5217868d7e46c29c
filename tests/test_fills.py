"""Fill intervals, interval join strategies, per-fill KPIs and the distributed rank."""

from __future__ import annotations

import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL, T
from fuelsight import fixtures as FX
from fuelsight import schemas as S
from fuelsight.operators import fills
from fuelsight.operators.ranking import rank_within

INJ, ODO, RPM, SUP = S.INJECTION, S.ODOMETER, S.RPM, S.FUEL_SUPPLY


def fills_df(spark, rows):
    return spark.createDataFrame([(v, T(t), g, gr, p) for v, t, g, gr, p in rows], S.FILL)


def assigned(df):
    return sorted((r["vin"], str(r["ts"]), r["gas_id"]) for r in df.collect())


def test_interval_bounds_and_degenerate_vehicles(spark, signals_df):
    f = fills_df(spark, [
        ("V1", "2024-01-01 00:00:00", 1, "92", 6.0), ("V1", "2024-01-03 00:00:00", 2, "95", 6.5),
        ("V2", "2024-01-01 00:00:00", 3, "92", 6.0),                                   # one fill only
        ("V3", "2024-01-01 00:00:00", 5, "98", 7.0), ("V3", "2024-01-01 00:00:00", 4, "92", 6.0),
        ("V3", "2024-01-02 00:00:00", 6, "95", 6.0),                                   # two at one instant
    ])
    sig = signals_df([
        ("V1", "2024-01-01 00:00:00", INJ, 1), ("V1", "2024-01-02 12:00:00", INJ, 1),
        ("V1", "2024-01-03 00:00:00", INJ, 1), ("V1", "2023-12-31 23:00:00", INJ, 1),
        ("V2", "2024-01-01 05:00:00", INJ, 1), ("V9", "2024-01-01 05:00:00", INJ, 1),
        ("V3", "2024-01-01 00:00:00", INJ, 1), ("V3", "2024-01-01 10:00:00", INJ, 1),
    ])
    iv = fills.fill_intervals(f)
    assert sorted((r["vin"], r["gas_id"]) for r in iv.collect()) == [("V1", 1), ("V3", 4), ("V3", 5)]
    want = [("V1", "2024-01-01 00:00:00", 1), ("V1", "2024-01-02 12:00:00", 1),
            ("V3", "2024-01-01 00:00:00", 5), ("V3", "2024-01-01 10:00:00", 5)]
    for strategy in ("range", "asof"):
        assert assigned(fills.assign_fill_interval(sig, iv, strategy)) == want, strategy


def test_range_and_asof_agree_on_fixture(spark):
    fx = FX.load(spark, SF_SMALL)
    iv = fills.fill_intervals(fills.new_fills(fx["fills"], fx["processed_fills"]))
    sig = fx["signals"].where(F.col("stype").isin(INJ, ODO))
    a = fills.assign_fill_interval(sig, iv, "range")
    b = fills.assign_fill_interval(sig, iv, "asof", chunk_seconds=1800)
    assert a.count() > 0
    assert sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


def test_new_fills_respects_marks_and_no_mark(spark):
    f = fills_df(spark, [("V1", "2024-01-01 00:00:00", 1, "92", 6.0), ("V1", "2024-01-05 00:00:00", 2, "92", 6.0),
                         ("V2", "2024-01-01 00:00:00", 3, "95", 6.0)])
    marks = spark.createDataFrame([("V1", T("2024-01-02 00:00:00")), ("V1", T("2024-01-01 00:00:00"))],
                                  S.PROCESSED_FILL)
    got = sorted((r["vin"], r["gas_id"]) for r in fills.new_fills(f, marks).collect())
    assert got == [("V1", 2), ("V2", 3)]


def test_per_fill_kpis(spark, signals_df):
    f = fills_df(spark, [("V1", "2024-01-01 00:00:00", 1, "92", 8.0), ("V1", "2024-01-02 00:00:00", 2, "92", 8.0)])
    sig = signals_df([
        ("V1", "2024-01-01 01:00:00", INJ, 0.5), ("V1", "2024-01-01 02:00:00", INJ, 1.5),
        ("V1", "2024-01-01 01:00:00", ODO, 1000), ("V1", "2024-01-01 02:00:00", ODO, 1050),
        ("V1", "2024-01-01 01:00:00", RPM, 800), ("V1", "2024-01-01 01:30:00", RPM, 0),
        ("V1", "2024-01-01 02:00:00", RPM, 900),
        ("V1", "2024-01-01 01:00:00", SUP, 0), ("V1", "2024-01-01 02:00:00", SUP, 4),
        ("V1", "2024-01-01 03:00:00", SUP, 2),
    ])
    cost = cost_row = fills.cost_per_km(sig, f).collect()
    assert len(cost) == 1 and cost_row[0]["data_key"] == "FF003"
    assert cost[0]["data_value"] == (200.0 / 50.0) * 8.0
    speed = fills.average_speed(sig, f, sample_ms=10).collect()[0]
    assert abs(speed["data_value"] - 50.0 / (2 * 10 / 3.6e6)) < 1e-6
    heat = fills.fuel_heating(sig, f).collect()[0]
    assert heat["data_value"] == (0.25 + 0.5) / 2          # 1/0 is skipped
    rank = fills.economy_ranking(fills.cost_per_km(sig, f)).collect()
    assert [(r["rank"], r["cost_per_km"]) for r in rank] == [(1, 32.0)]


def test_zero_distance_gives_null_cost(spark, signals_df):
    f = fills_df(spark, [("V1", "2024-01-01 00:00:00", 1, "92", 8.0), ("V1", "2024-01-02 00:00:00", 2, "92", 8.0)])
    sig = signals_df([("V1", "2024-01-01 01:00:00", INJ, 1.0), ("V1", "2024-01-01 01:00:00", ODO, 10)])
    row = fills.cost_per_km(sig, f).collect()[0]
    assert row["data_value"] is None
    assert fills.economy_ranking(fills.cost_per_km(sig, f)).count() == 0


def test_distributed_rank_equals_window_rank(spark):
    rnd = random.Random(3)
    rows = [(i, rnd.choice(["92", "95", "98"]) if i % 5 else "92", float(rnd.randrange(0, 40)))
            for i in range(2000)]
    df = spark.createDataFrame(rows, "id long, g string, x double")
    ours = rank_within(df, "g", "x", "r", num_slices=7)
    w = Window.partitionBy("g").orderBy("x")
    plain = df.withColumn("r", F.rank().over(w))
    assert sorted(map(tuple, ours.select("id", "r").collect())) == \
        sorted(map(tuple, plain.select("id", "r").collect()))


def test_rank_keeps_rows_without_a_group(spark):
    df = spark.createDataFrame([(1, None, 2.0), (2, None, 1.0), (3, "92", 5.0), (4, "92", 5.0), (5, "92", 6.0)], "id long, g string, x double")
    got = rank_within(df, "g", "x", "r", num_slices=3)
    assert dict(got.dtypes)["r"] == "bigint"
    assert sorted((r.id, r.r) for r in got.collect()) == [(1, 2), (2, 1), (3, 1), (4, 1), (5, 3)]


def test_chunked_lead_equals_plain_lead(spark):
    from fuelsight.operators.asof import next_time
    import datetime as dt
    rnd = random.Random(11)
    rows = []
    for v in ("A", "B"):
        for i in range(400):
            t = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 6 * 24 * 60))
            rows.append((v, t, rnd.randrange(0, 5)))
    df = spark.createDataFrame(rows, "vin string, ts timestamp_ntz, g int")
    ours = next_time(df, ["vin"], "ts", "g", "nxt", chunk_seconds=3 * 3600)
    w = Window.partitionBy("vin").orderBy("ts", "g")
    plain = df.withColumn("nxt", F.lead("ts").over(w))
    key = ["vin", "ts", "g", "nxt"]
    # rows equal in (vin, ts, g) are interchangeable; compare as multisets
    assert sorted(map(tuple, ours.select(*key).collect()), key=repr) == \
        sorted(map(tuple, plain.select(*key).collect()), key=repr)


def test_fused_fill_kpis_equal_separate_operators(spark):
    fx = FX.load(spark, SF_SMALL)
    args = (fx["signals"], fx["fills"], fx["processed_fills"])
    fused = fills.fill_kpis(*args)
    separate = (fills.average_speed(*args).unionByName(fills.fuel_heating(*args))
                .unionByName(fills.cost_per_km(*args)))
    assert sorted(map(tuple, fused.collect()), key=repr) == sorted(map(tuple, separate.collect()), key=repr)
    plan = fused._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert sum("Join" in line and "_day" in line for line in plan.splitlines()) == 1
