"""Refuel state machine (T8): rule edges, batch replay, stream = batch."""

from __future__ import annotations

import os
import tempfile

import numpy as np
from pyspark.sql import functions as F

from conftest import SF_MID, SF_SMALL, T
from fuelsight import fixtures as FX
from fuelsight import schemas as S
from fuelsight.streaming.refuel import RefuelMachine, refuel_events_stream
from fuelsight.streaming.replay import refuel_events


def run(levels, step_us=None, spacing_us=1_000_000):
    t = np.arange(len(levels), dtype="int64") * spacing_us
    m = RefuelMachine()
    return m.push(t, np.array(levels, dtype="float64"), step_us)


def test_rise_of_exactly_ten_is_no_event():
    assert run([20, 25, 30, 30, 30, 30]) == []


def test_rise_above_ten_with_plateau_emits_once():
    # fires at the fifth reading: last three 31, 31.5, 31.8 are within 1
    ev = run([20, 25, 31, 31.5, 31.8, 31.9])
    assert len(ev) == 1
    mass, amount, start, end = ev[0]
    assert (mass, amount, start, end) == (31.0, 11.0, 0, 4_000_000)


def test_buffer_of_four_is_no_event_five_is():
    assert run([20, 31, 31.5, 31.8]) == []
    assert len(run([20, 31, 31.5, 31.8, 31.9])) == 1


def test_plateau_step_of_exactly_one_is_no_event():
    assert run([20, 25, 31, 32, 33, 34]) == []


def test_dip_below_first_value_resets_buffer():
    # 19 is below both last and first: buffer restarts at 19
    ev = run([20, 25, 19, 25, 30, 30.5, 30.8])
    assert len(ev) == 1 and ev[0][1] == 30 - 19


def test_steps_feed_last_reading_and_keep_newest_open():
    # two readings per 5-s step; only the later one of each step counts
    levels = [99, 20, 99, 25, 99, 31, 99, 31.2, 99, 31.4, 99, 31.5]
    ev = run(levels, step_us=5_000_000, spacing_us=2_500_000)
    assert len(ev) == 1 and ev[0][:2] == (31.0, 11.0)
    # the newest step stays open: the same readings minus the last step emit nothing
    assert run(levels[:10], step_us=5_000_000, spacing_us=2_500_000) == []


def test_batch_replay_on_fixture_counts(spark):
    sig = FX.load(spark, SF_MID)["signals"]
    assert refuel_events(sig, None).count() == 566
    assert refuel_events(sig, "5 seconds").count() == 566


def test_stream_equals_batch(spark):
    sig = FX.load(spark, SF_SMALL)["signals"].where(F.col("stype") == S.FUEL_LEVEL)
    src = tempfile.mkdtemp(prefix="refuel-src-")
    # three input files in time order -> three micro-batches
    bounds = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-02-01"]
    for i in range(3):
        part = sig.where((F.col("ts") >= F.lit(bounds[i]).cast("timestamp_ntz"))
                         & (F.col("ts") < F.lit(bounds[i + 1]).cast("timestamp_ntz")))
        part.coalesce(1).write.parquet(os.path.join(src, f"batch={i}"))
    for step in (None, "5 seconds"):
        stream = (spark.readStream.schema(S.SIGNAL).option("maxFilesPerTrigger", 1)
                  .option("recursiveFileLookup", "true").parquet(src))
        name = f"refuel_{'all' if step is None else 'step'}"
        q = (refuel_events_stream(stream, step).writeStream.format("memory").queryName(name)
             .outputMode("append").option("checkpointLocation", tempfile.mkdtemp())
             .trigger(availableNow=True).start())
        q.awaitTermination(300)
        got = sorted(map(tuple, spark.table(name).collect()))
        want = sorted(map(tuple, refuel_events(sig, step).collect()))
        assert got == want and len(want) > 0


def test_stream_restart_from_checkpoint_equals_batch(spark):
    """Stop after two files, add the third, restart on the same checkpoint."""
    sig = FX.load(spark, SF_SMALL)["signals"].where(F.col("stype") == S.FUEL_LEVEL)
    src, ckpt = tempfile.mkdtemp(prefix="refuel-restart-"), tempfile.mkdtemp(prefix="refuel-ckpt-")
    out = tempfile.mkdtemp(prefix="refuel-out-")
    bounds = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-02-01"]

    def add_file(i):
        part = sig.where((F.col("ts") >= F.lit(bounds[i]).cast("timestamp_ntz"))
                         & (F.col("ts") < F.lit(bounds[i + 1]).cast("timestamp_ntz")))
        part.coalesce(1).write.parquet(os.path.join(src, f"batch={i}"))

    def run_once():
        stream = (spark.readStream.schema(S.SIGNAL).option("maxFilesPerTrigger", 1)
                  .option("recursiveFileLookup", "true").parquet(src))
        q = (refuel_events_stream(stream, "5 seconds").writeStream
             .foreachBatch(lambda b, e: b.write.mode("overwrite").parquet(os.path.join(out, f"epoch={e}")))
             .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
        q.awaitTermination(300)

    add_file(0)
    add_file(1)
    run_once()
    add_file(2)
    run_once()
    got = sorted(map(tuple, spark.read.parquet(out).drop("epoch").collect()))
    want = sorted(map(tuple, refuel_events(sig, "5 seconds").collect()))
    assert got == want and len(want) > 0


def _literal_rule(levels, times):
    """The rule with an explicit list buffer, exactly as stated."""
    buf, events = [], []
    for t, x in zip(times, levels):
        if buf and x < buf[-1][1] and x < buf[0][1]:
            buf = []
        buf.append((t, x))
        if len(buf) > 4:
            (ft, f), (lt, last) = buf[0], buf[-1]
            l2, l3 = buf[-2][1], buf[-3][1]
            if last - f > 10 and abs(last - l2) < 1 and abs(l2 - l3) < 1:
                events.append((l3, l3 - f, ft, lt))
                buf = []
    return events


from hypothesis import given, settings, strategies as st  # noqa: E402


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([0.0, 5.0, 9.5, 10.0, 12.0, 20.0, 20.5, 21.0, 30.0, 30.25, 30.5, 31.0, 45.0, 60.0]),
                min_size=0, max_size=60))
def test_compact_state_equals_list_buffer(levels):
    times = list(range(len(levels)))
    assert run(levels, spacing_us=1) == _literal_rule(levels, times)
    # step mode (2 readings per step): the machine sees the later reading of each
    # complete step; the newest step stays open and is not fed
    fed = levels[1::2]
    if len(levels) % 2 == 0:
        fed = fed[:-1]
    stepped = run(levels, step_us=2, spacing_us=1)
    assert [e[:2] for e in stepped] == [e[:2] for e in _literal_rule(fed, list(range(len(fed))))]


def test_a_null_level_does_not_blind_a_vehicle(spark, signals_df):
    from fuelsight.streaming.refuel import unusable_levels
    levels = [20, 20, 20, 20, 40, 40.5, 40.6, 40.7]
    rows = [("V1", f"2024-01-01 00:{i:02d}:00", S.FUEL_LEVEL, float(x)) for i, x in enumerate(levels, 10)]
    clean = signals_df(rows)
    bad = spark.createDataFrame([("V1", T("2024-01-01 00:00:00"), S.FUEL_LEVEL, None), ("V1", None, S.FUEL_LEVEL, 20.0),
                                 ("V1", T("2024-01-01 00:12:30"), S.FUEL_LEVEL, float("nan"))], S.SIGNAL)
    want = [tuple(r) for r in refuel_events(clean, step=None).collect()]
    assert len(want) == 1
    assert [tuple(r) for r in refuel_events(clean.unionByName(bad), step=None).collect()] == want
    assert unusable_levels(clean.unionByName(bad)).count() == 3


def test_chunked_replay_equals_one_pass(spark, signals_df):
    """Random levels that seldom reset, in chunks of four minutes, so that entry states matter over many chunks."""
    rng = np.random.default_rng(11)
    rows, want = [], []
    for v in range(6):
        levels = np.cumsum(rng.choice([0.0, 0.0, 0.5, 1.5, 4.0, -0.5], 200, p=[0.5, 0.2, 0.1, 0.1, 0.05, 0.05])) + 20
        times = np.cumsum(rng.integers(1, 20, 200))
        rows += [(f"V{v}", f"2024-01-01 {t // 3600:02d}:{t // 60 % 60:02d}:{t % 60:02d}", S.FUEL_LEVEL, float(x)) for t, x in zip(times, levels)]
        machine = RefuelMachine()
        want += [(f"V{v}", *e[:2]) for e in machine.push(times.astype("int64"), levels, None)]
    got = refuel_events(signals_df(rows), step=None, chunk_seconds=240).collect()
    assert len(want) > 5 and sorted((r.vin, r.fuel_mass, r.fill_amount) for r in got) == sorted(want)
