"""The replay by summaries against the machine that reads one level after the other."""

from __future__ import annotations

import datetime as dt
import os

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fuelsight import schemas as S
from fuelsight.session import shared_dir
from fuelsight.streaming import replay as R
from fuelsight.streaming.refuel import RefuelMachine

LEVELS = st.lists(st.sampled_from([0.0, 9.5, 10.0, 12.0, 20.0, 20.5, 21.0, 30.0, 30.25, 30.5, 31.0, 45.0, 45.5, 60.0]), min_size=1, max_size=120)


def composed(levels, cuts):
    """Events and the state by summaries of the pieces between ``cuts``; the newest reading of each piece is fed as it is."""
    machine, out = RefuelMachine(), []
    t, x = np.arange(len(levels), dtype=np.int64), np.array(levels, dtype=np.float64)
    edges = sorted({0, len(levels), *(c % len(levels) for c in cuts)})
    for a, b in zip(edges, edges[1:]):
        names = [f.name for f in R._SUMMARY]
        s = dict(zip(names, R._Chunk(t[a:b], x[a:b]).row("v", a), strict=True))
        if s["n"] > R._WHOLE:
            R.compose(machine, s, out)
            machine._feed(s["last_t"], s["last_x"], out)
        else:
            for y, z in zip(s["head_t"], s["head_x"], strict=True):
                machine._feed(y, z, out)
    return out, machine


def same_state(a, b):
    return (a.n, a.l) == (b.n, b.l) and (a.n == 0 or (a.f, a.f_t) == (b.f, b.f_t))


@settings(max_examples=1500, deadline=None)
@given(LEVELS, st.lists(st.integers(0, 120), max_size=6))
def test_summaries_equal_the_machine(levels, cuts):
    machine = RefuelMachine()
    want = machine.push(np.arange(len(levels), dtype=np.int64), np.array(levels, dtype=np.float64), None)
    got, state = composed(levels, cuts)
    assert got == want and same_state(state, machine)


def test_long_random_walks():
    rng = np.random.default_rng(4)
    for kind in range(4):
        steps = [[0.0, 0.5, -0.5, 4.0, -6.0], [0.0, 0.0, -0.1], [0.1, 0.2, 0.0], [0.0, 0.3, -0.3, 25.0, -24.0]][kind]
        levels = (50 + np.cumsum(rng.choice(steps, 6000))).tolist()
        machine = RefuelMachine()
        want = machine.push(np.arange(6000, dtype=np.int64), np.array(levels), None)
        got, state = composed(levels, rng.integers(0, 6000, 9).tolist())
        assert got == want and same_state(state, machine)


def test_a_falling_chunk_is_summarised_in_few_numbers():
    x = np.linspace(60, 5, 20_000)
    s = dict(zip([f.name for f in R._SUMMARY], R._Chunk(np.arange(20_000), x).row("v", 0), strict=True))
    assert len(s["min_k"]) < 6 and len(s["rise_k"]) < 6 and len(s["node_n"]) < 12


def frame(spark, series):
    """``{vin: levels}`` as readings a minute apart."""
    start = dt.datetime(2024, 1, 1)
    rows = [(v, start + dt.timedelta(minutes=i), S.FUEL_LEVEL, float(x)) for v, xs in series.items() for i, x in enumerate(xs)]
    return spark.createDataFrame(rows, S.SIGNAL)


def test_a_buffer_open_across_thirty_chunks(spark):
    """The minimum stands in the first of 40 chunks, the plateau that emits it in the last but one."""
    rng = np.random.default_rng(2)
    slow = [20.0] + [25.0 + 3 * (i % 2) for i in range(38 * 30)] + [40.0, 40.1, 40.2, 40.3] + [40.0] * 60
    random = {f"R{k}": (40 + np.cumsum(rng.choice([0, 0, 0.2, -0.2, 15, -15], 900))).tolist() for k in range(5)}
    df = frame(spark, {"SLOW": slow, **random})
    before = set(os.listdir(shared_dir(spark).removeprefix("file:")))
    got = R.refuel_events(df, step=None, chunk_seconds=1800).collect()
    assert set(os.listdir(shared_dir(spark).removeprefix("file:"))) == before  # no staged table
    want = []
    for v, xs in {"SLOW": slow, **random}.items():
        t = np.arange(len(xs), dtype=np.int64)
        want += [(v, m, a, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=b), dt.datetime(2024, 1, 1) + dt.timedelta(minutes=e))
                 for m, a, b, e in RefuelMachine().push(t, np.array(xs), None)]
    assert sorted(tuple(r)[:5] for r in got) == sorted(want)
    slow_events = [r for r in got if r.vin == "SLOW"]
    assert len(slow_events) == 1 and (slow_events[0].fill_end_time - slow_events[0].fill_start_time) > dt.timedelta(minutes=30 * 30)


def test_the_newest_step_stays_open(spark):
    df = frame(spark, {"V": [20, 20, 20, 20, 20, 40, 40, 40]})
    assert R.refuel_events(df, "1 minute", 120).count() == 0  # the third 40 may still change
    assert R.refuel_events(df, None, 120).count() == 1
    more = df.unionByName(frame(spark, {"V": [0] * 9}).where(F.minute("ts") == 8))
    assert R.refuel_events(more, "1 minute", 120).count() == 1


def test_one_shuffle_for_readings_one_for_summaries(spark):
    df = frame(spark, {"V": [20.0] * 10})
    plan = R.refuel_events(df, None)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2


def test_empty_table_and_ties(spark):
    df = frame(spark, {"V": [20.0] * 10})
    assert R.refuel_events(df.limit(0)).count() == 0
    twice = df.union(df)
    assert R.refuel_events(twice, None, 60).collect() == R.refuel_events(twice.repartition(5), None, 3600).collect()
