"""Batch jobs end to end, including resume after checkpoint / marks."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from fuelsight import fixtures as FX
from fuelsight import schemas as S
from fuelsight.operators import algebra, kpi
from fuelsight.plans import jobs


def test_daily_job_writes_kpis_and_other_fuel(spark):
    sig = FX.load(spark, SF_SMALL)["signals"]
    out = os.path.join(tempfile.mkdtemp(prefix="daily-"), "kpi_day")
    jobs.daily_job(sig, out, "2024-01-01", "2024-02-01")
    got = spark.read.parquet(out)
    counts = {r["data_key"]: r["count"] for r in got.groupBy("data_key").count().collect()}
    assert set(counts) == {"D001", "D002", "D003", "D004", "D005", "D006"}
    assert counts["D005"] == algebra.other_fuel(kpi.daily_kpis(sig), "day").count()
    # a rerun of part of the range replaces those days instead of appending them again
    total = got.count()
    jobs.daily_job(sig, out, "2024-01-10", "2024-01-12")
    assert spark.read.parquet(out).count() == total


def test_km_job_resumes_without_repeating_buckets(spark):
    fx = FX.load(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="km-")
    out, ck = os.path.join(root, "kpi_km"), os.path.join(root, "checkpoint")
    fx["km_checkpoint"].write.parquet(f"{ck}/run=start")
    jobs.km_job(fx["signals"], spark.read.parquet(ck), out, ck)
    first = spark.read.parquet(out).where(F.col("data_key") == S.KM_TOTAL_FUEL)
    n_first = first.count()
    assert n_first > 0
    jobs.km_job(fx["signals"], spark.read.parquet(ck), out, ck)
    total = spark.read.parquet(out).where(F.col("data_key") == S.KM_TOTAL_FUEL)
    assert total.count() == n_first
    # all five codes: the second run adds nothing, and no bucket is there twice
    all_codes = spark.read.parquet(out)
    assert {r[0] for r in all_codes.select("data_key").distinct().collect()} == {f"KM00{i}" for i in range(1, 6)}
    assert all_codes.groupBy("vin", "mileage", "data_key").count().where("count > 1").count() == 0


def test_km_job_broken_off_before_its_marks_is_repeated(spark):
    fx = FX.load(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="km-broken-")
    out, ck = os.path.join(root, "kpi_km"), os.path.join(root, "checkpoint")
    fx["km_checkpoint"].write.parquet(f"{ck}/run=start")
    jobs.km_job(fx["signals"], spark.read.parquet(ck), out, os.path.join(root, "lost"))  # its marks do not arrive
    n = spark.read.parquet(out).count()
    jobs.km_job(fx["signals"], spark.read.parquet(ck), out, ck)
    assert spark.read.parquet(out).count() == n


def test_fill_job_processes_each_interval_once(spark):
    fx = FX.load(spark, SF_SMALL)
    root = tempfile.mkdtemp(prefix="fill-")
    out, marks = os.path.join(root, "kpi_fill"), os.path.join(root, "marks")
    fx["processed_fills"].write.parquet(f"{marks}/run=start")
    jobs.fill_job(fx["signals"], fx["fills"], spark.read.parquet(marks), out, marks)
    n = spark.read.parquet(out).count()
    assert n > 0
    jobs.fill_job(fx["signals"], fx["fills"], spark.read.parquet(marks), out, marks)
    facts = spark.read.parquet(out)
    assert facts.count() == n
    jobs.ranking_job(facts, os.path.join(root, "ranking"))
    assert spark.read.parquet(os.path.join(root, "ranking")).count() > 0


def test_attribute_job(spark):
    sig = FX.load(spark, SF_SMALL)["signals"]
    out = os.path.join(tempfile.mkdtemp(prefix="attr-"), "attr")
    jobs.attribute_job(kpi.daily_kpis(sig), kpi.total_fuel_by_km(sig), out)
    types = {r[0] for r in spark.read.parquet(out).select("attribute_type").distinct().collect()}
    assert types == {"C001", "C002", "C003", "C004", "C005", "C006"}
