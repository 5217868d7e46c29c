"""Properties from the test strategy, checked on the sf0.01 fixture."""

from __future__ import annotations

import os
import shutil

from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL
from fuelsight import fixtures as FX
from fuelsight import schemas as S
from fuelsight.operators import fills, kpi
from fuelsight.operators.wide import to_second_rows


def test_idle_plus_driving_never_exceed_total(spark):
    sig = FX.load(spark, SF_MID)["signals"]
    kd = kpi.daily_kpis(sig)
    piv = kd.groupBy("vin", "now_date").agg(
        *[F.sum(F.when(F.col("data_key") == c, F.col("data_value"))).alias(c) for c in ("D001", "D002", "D003")])
    bad = piv.where(F.coalesce(F.col("D002"), F.lit(0.0)) + F.coalesce(F.col("D003"), F.lit(0.0))
                    > F.col("D001") + 1e-9)
    assert bad.count() == 0


def test_each_reading_falls_in_at_most_one_interval(spark):
    fx = FX.load(spark, SF_MID)
    iv = fills.fill_intervals(fills.new_fills(fx["fills"], fx["processed_fills"]))
    rows = fills.assign_fill_interval(fx["signals"], iv)
    assert rows.groupBy("vin", "ts", "stype").count().where("count > 1").count() == 0


def test_bucket_totals_add_up_to_the_fuel_sum(spark):
    sig = FX.load(spark, SF_MID)["signals"]
    inj = sig.where(F.col("stype") == S.INJECTION)
    total = inj.agg(F.sum("value")).first()[0]
    # as-of buckets (every reading here has an odometer reading at its instant)
    km = kpi.total_fuel_by_km(sig, complete_only=False)
    assert abs(km.agg(F.sum("data_value")).first()[0] / 100 - total) < 1e-6
    # same-second and as-of second rows carry all of the fuel, split over buckets
    for bucket in ("same_second", "asof"):
        wide = to_second_rows(sig, with_km=True, bucket=bucket)
        assert abs(wide.agg(F.sum("fuel")).first()[0] - total) < 1e-6


def test_only_the_fixtures_asked_for_are_written(spark, tmp_path):
    shutil.copy(f"{SF_SMALL}/events.parquet", tmp_path / "events.parquet")
    fx = FX.load(spark, str(tmp_path))
    assert fx["signals"].count() == 7 * fx["events"].count() and fx["signals_by_day"].columns[-1] == "day"
    assert [n for n in os.listdir(fx._root.removeprefix("file:")) if not n.startswith(".")] == ["signals"]
    assert FX.load(spark, str(tmp_path)) is fx and set(fx) > {"events", "dense_signals_by_day", "envelopes"}
