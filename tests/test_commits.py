"""One commit for facts and marks: faults between any two writes, merges by bucket, totals kept up to date."""

from __future__ import annotations

import os
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from fuelsight import fixtures as FX
from fuelsight.operators import algebra, kpi
from fuelsight.plans import commit_jobs as J
from fuelsight.plans import jobs
from fuelsight.sources import commits as C


def new_store(spark):
    return C.Store(spark, tempfile.mkdtemp(prefix="store-"))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


class Fault(Exception):
    pass


def failing(monkeypatch, at):
    """The ``at``-th write of a run fails: half of the time before, then after it has been done (1 is the first append)."""
    count = {"n": 0}

    def wrap(method):
        def run(self, *args, **kwargs):
            count["n"] += 1
            if count["n"] == at:
                raise Fault
            out = method(self, *args, **kwargs)
            count["n"] += 1
            if count["n"] == at:
                raise Fault
            return out
        return run

    for name in ("append", "replace", "merge"):
        monkeypatch.setattr(C.Transaction, name, wrap(getattr(C.Transaction, name)))
    original = C.Store.put_new

    def put_new(self, name, text):
        count["n"] += 1
        if count["n"] == at:
            raise Fault
        return original(self, name, text)

    monkeypatch.setattr(C.Store, "put_new", put_new)


def test_km_job_survives_a_fault_at_every_write(spark, monkeypatch):
    fx = FX.load(spark, SF_SMALL)
    clean = new_store(spark)
    J.start_marks(clean, J.KM_MARKS, fx["km_checkpoint"])
    J.km_commit_job(fx["signals"], clean)
    want = {t: rows_of(clean.read(t)) for t in (J.KM_FACTS, J.KM_MARKS)}
    store = new_store(spark)
    J.start_marks(store, J.KM_MARKS, fx["km_checkpoint"])
    before = store.manifest()
    for at in range(1, 6):  # before and after each append, and before the commit
        with monkeypatch.context() as m:
            failing(m, at)
            with pytest.raises(Fault):
                J.km_commit_job(fx["signals"], store)
        assert store.manifest() == before
    J.km_commit_job(fx["signals"], store)
    assert {t: rows_of(store.read(t)) for t in want} == want
    J.km_commit_job(fx["signals"], store)  # nothing is new
    assert rows_of(store.read(J.KM_FACTS)) == want[J.KM_FACTS]
    assert len(store.vacuum()) == 4 and {t: rows_of(store.read(t)) for t in [J.KM_FACTS]} == {J.KM_FACTS: want[J.KM_FACTS]}


def test_fill_job_processes_each_interval_once(spark):
    fx = FX.load(spark, SF_SMALL)
    store = new_store(spark)
    J.start_marks(store, J.FILL_MARKS, fx["processed_fills"])
    J.fill_commit_job(fx["signals"], fx["fills"], store)
    first = rows_of(store.read(J.FILL_FACTS))
    J.fill_commit_job(fx["signals"], fx["fills"], store)
    assert first and rows_of(store.read(J.FILL_FACTS)) == first
    assert len(rows_of(store.read(J.FILL_FACTS, version=2))) == len(first) and store.versions() == [1, 2, 3]


def test_a_fill_run_without_new_intervals_leaves_the_readings_alone(spark):
    fx, store = FX.load(spark, SF_SMALL), new_store(spark)
    J.start_marks(store, J.FILL_MARKS, fx["processed_fills"])
    J.fill_commit_job(fx["signals"], fx["fills"], store)
    first = rows_of(store.read(J.FILL_FACTS))
    sizes = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")  # as with more intervals than are broadcast
    for name in sizes:
        spark.conf.set(name, "-1")
    try:
        broken = fx["signals"].withColumn("ts", F.raise_error("a reading was read").cast("timestamp_ntz"))
        J.fill_commit_job(broken, fx["fills"], store)
    finally:
        for name in sizes:
            spark.conf.unset(name)
    assert first and rows_of(store.read(J.FILL_FACTS)) == first and store.versions() == [1, 2, 3]


def test_of_two_runs_one_commits(spark):
    store = new_store(spark)
    a, b = store.begin(), store.begin()
    a.append("t", spark.range(3))
    b.append("t", spark.range(5))
    assert a.commit() == 1
    with pytest.raises(C.ConcurrentCommit):
        b.commit()
    b.abort()
    assert store.read("t").count() == 3 and store.read("other") is None
    assert not [f for f in os.listdir(f"{store.root}/_manifest") if f.startswith(".") and not f.endswith(".crc")]


def test_an_upsert_keeps_the_files_of_other_buckets(spark):
    store = new_store(spark)
    rng = random.Random(1)
    state = {}
    for round_ in range(4):
        rows = [(f"V{rng.randrange(300 if round_ == 0 else 3)}", rng.choice(["C001", "C002"]), float(rng.randrange(99)), rng.randrange(1000))
                for _ in range(400 if round_ == 0 else 6)]
        for v, a, x, n in rows:
            if (n, x) > state.get((v, a), (-1, 0.0)):
                state[v, a] = (n, x)
        before = store.manifest()["tables"].get("attr", {"parts": {}})["parts"]
        tx = store.begin()
        tx.upsert("attr", spark.createDataFrame(rows, "vin string, attribute_type string, attribute_value double, version long"), ("vin", "attribute_type"), "version", 16)
        tx.commit()
        after = store.manifest()["tables"]["attr"]["parts"]
        if round_:
            changed = {k for k in after if after[k] != before.get(k)}
            assert 0 < len(changed) <= 6 and len(after) == len(before) == 16
        assert rows_of(store.read("attr")) == sorted(((v, a, x, n) for (v, a), (n, x) in state.items()), key=repr)
    nothing = spark.createDataFrame([], "vin string, attribute_type string, attribute_value double, version long")
    before = store.manifest()["tables"]
    tx = store.begin()
    tx.upsert("attr", nothing, ("vin", "attribute_type"), "version", 16)
    tx.commit()
    assert store.manifest()["tables"] == before


def test_lifetime_totals_equal_the_full_recompute(spark):
    """Random days replaced by other facts, and one emptied; only their old facts are read."""
    facts = kpi.daily_kpis(FX.load(spark, SF_SMALL)["signals"], rate=0.5).persist()
    days = sorted(str(r[0]) for r in facts.select("now_date").distinct().collect())
    store = new_store(spark)
    J.lifetime_commit_job(facts, store)
    assert rows_of(J.lifetime_of(store)) == rows_of(algebra.lifetime_totals(facts))
    rng = random.Random(3)
    current = facts
    for round_ in range(3):
        some = rng.sample(days, 2)
        fresh = (facts.where(F.col("now_date").cast("string").isin(some)).withColumn("data_value", F.col("data_value") * (round_ + 2) - 0.25)
                 .where(F.pmod(F.xxhash64("vin"), F.lit(3)) != round_))
        if round_ == 2:
            fresh = fresh.limit(0)
        current = current.where(~F.col("now_date").cast("string").isin(some)).unionByName(fresh)
        before = store.manifest()["tables"][J.DAY_FACTS]["parts"]
        J.lifetime_commit_job(fresh, store, some)
        after = store.manifest()["tables"][J.DAY_FACTS]["parts"]
        assert all(after[d] == before[d] for d in days if d not in some and d in before)
        assert rows_of(J.lifetime_of(store)) == rows_of(algebra.lifetime_totals(current))
        assert rows_of(store.read(J.DAY_FACTS)) == rows_of(current)
    facts.unpersist()  # the session's other tests read the same table


def test_a_km_run_computes_the_restart_times_once(spark, monkeypatch):
    """They are staged, one row per vehicle, so that the readings' joins know their size."""
    fx, store, staged = FX.load(spark, SF_SMALL), new_store(spark), []
    J.start_marks(store, J.KM_MARKS, fx["km_checkpoint"])

    def stage(df, name, real=jobs._stage):
        staged.append((name, df._jdf.queryExecution().optimizedPlan().toString()))
        return real(df, name)

    monkeypatch.setattr(jobs, "_stage", stage)
    J.km_commit_job(fx["signals"], store)
    (first, _), (second, plan) = staged
    assert (first, second) == ("km-starts", "kpi-km-run") and "restart_ts" in plan and "reach_ts" not in plan
