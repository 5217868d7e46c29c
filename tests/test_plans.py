"""Physical-plan assertions: pushdown, single scans, no Python outside T8."""

from __future__ import annotations

import inspect
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from fuelsight import fixtures as FX
from fuelsight.operators import algebra, fills, kpi
from fuelsight.streaming.replay import refuel_events

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_kpi_filters_reach_the_parquet_scan(spark):
    sig = FX.load(spark, SF_SMALL)["signals"]
    plan = plan_of(kpi.total_fuel_by_day(sig))
    assert "PushedFilters: [IsNotNull(stype), EqualTo(stype,InsFuelInjection)]" in plan
    assert "ReadSchema: struct<vin:string,ts:timestamp_ntz,stype:string,value:double>" in plan


def test_kpis_stay_in_the_jvm(spark):
    fx = FX.load(spark, SF_SMALL)
    plans = [kpi.daily_kpis(fx["signals"]), kpi.km_kpis(fx["signals"]),
             fills.cost_per_km(fx["signals"], fx["fills"], fx["processed_fills"]),
             fills.economy_ranking(fills.cost_per_km(fx["signals"], fx["fills"], fx["processed_fills"]))]
    for df in plans:
        plan = plan_of(df)
        assert not any(n in plan for n in PYTHON_NODES), plan[:500]


def test_fused_daily_kpis_scan_once(spark):
    sig = FX.load(spark, SF_SMALL)["signals"]
    plan = plan_of(kpi.daily_kpis(sig, rate=0.5))
    assert plan.count("FileScan parquet") == 1


def test_other_fuel_is_one_shuffle(spark):
    kd_path = tempfile.mkdtemp(prefix="kd-") + "/kd"
    kpi.daily_kpis(FX.load(spark, SF_SMALL)["signals"], rate=0.5).write.parquet(kd_path)
    plan = plan_of(algebra.other_fuel(spark.read.parquet(kd_path), "day"))
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan


def test_refuel_replay_shuffles_steps_then_readings_then_summaries(spark):
    plan = plan_of(refuel_events(FX.load(spark, SF_SMALL)["signals"], "5 seconds"))
    assert plan.count("MapInArrow") == 2 and plan.count("Exchange hashpartitioning") == 3
    assert "Join" not in plan and "Window" not in plan


def test_refuel_replay_spreads_a_hot_vehicle(spark, tmp_path):
    """One vehicle with all levels: its chunks are replayed by many tasks."""
    from fuelsight.streaming import replay
    levels = spark.range(20000).select(F.lit("V1").alias("vin"), (F.col("id") * 60_000_000).alias("t_us"), F.lit(1.0).alias("level"))
    dealt = levels.withColumn("chunk", F.floor(F.col("t_us") / 86_400_000_000)).repartition(8, "vin", "chunk")
    share = dealt.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0] / 20000
    assert share < 0.5
    assert "\"vin\", \"chunk\").sortWithin" in inspect.getsource(replay.chunk_summaries)


def test_fill_interval_join_has_day_equi_key(spark):
    fx = FX.load(spark, SF_SMALL)
    df = fills.interval_readings(fx["signals"], fx["fills"], fx["processed_fills"], ["InsFuelInjection"])
    plan = plan_of(df)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    join_line = next(line for line in plan.splitlines() if "Join" in line and "_day" in line)
    assert "vin" in join_line


def _no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")


def _reset(spark):
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_window_after_the_checkpoint_join_is_dealt_by_chunk(spark):
    fx = FX.load(spark, SF_SMALL)
    _no_broadcast(spark)
    try:
        plan = kpi.total_fuel_by_km(fx["signals"], fx["km_checkpoint"])._jdf.queryExecution().executedPlan().toString()
    finally:
        _reset(spark)
    window = plan.index("Window [max(")
    below = plan[window:plan.index("SortMergeJoin", window)]
    assert "Exchange hashpartitioning(vin" in below and "_chunk" in below[below.index("Exchange hashpartitioning"):][:80]


def test_fill_kpis_read_only_the_folders_of_the_open_intervals(spark):
    fx = FX.load(spark, SF_SMALL)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        plan = fills.fill_kpis(fx["signals_by_day"], fx["fills"], fx["processed_fills"])._jdf.queryExecution().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [x for x in plan.split("FileScan parquet")[1:] if "ReadSchema: struct<vin:string,ts:timestamp_ntz" in x]
    assert scans and all("make_date" in x.split("PartitionFilters: [")[1].split("PushedFilters")[0] for x in scans)
