"""Detectors with timers: streams out of order equal the batch forms."""

from __future__ import annotations

import datetime as dt
import json
import os
import tempfile

import numpy as np
import pandas as pd
import pytest

from fuelsight import schemas as S
from fuelsight.session import stateful_conf
from fuelsight.streaming.detectors import low_fuel_windows
from fuelsight.streaming.replay import refuel_events
from fuelsight.streaming.detectors import low_fuel_alerts, stream_signals
from fuelsight.streaming.timed import PaneProcessor, RefuelProcessor, low_fuel_panes, low_fuel_panes_stream, refuel_events_timed, run_detectors_once

START = dt.datetime(2024, 1, 1)


@pytest.fixture
def stateful(spark):
    for k, v in stateful_conf().items():
        spark.conf.set(k, v)
    yield spark
    for k in stateful_conf():
        spark.conf.unset(k)


def readings(spark, rows):
    """``(vin, minute, level)`` as signals."""
    return spark.createDataFrame([(v, None if m is None else START + dt.timedelta(minutes=m), S.FUEL_LEVEL, None if x is None else float(x)) for v, m, x in rows], S.SIGNAL)


def stream_of(spark, batches):
    """A stream of one file per batch, in this order."""
    src = tempfile.mkdtemp(prefix="timed-src-")
    for i, rows in enumerate(batches):
        path = os.path.join(src, f"b={i}")
        readings(spark, rows).coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            os.utime(os.path.join(path, name), (1_700_000_000 + i, 1_700_000_000 + i))
    return spark.readStream.schema(S.SIGNAL).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)


def run(df, checkpoint=None):
    out = tempfile.mkdtemp(prefix="timed-out-")
    q = (df.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint or tempfile.mkdtemp())
         .outputMode("append").trigger(availableNow=True).start())
    assert q.awaitTermination(300) and q.exception() is None
    return sorted(tuple(r) for r in df.sparkSession.read.schema(df.schema).parquet(out).collect())


def walk(seed, vins=4, n=300):
    """Levels every minute with fills, several vehicles, in time order."""
    rng = np.random.default_rng(seed)
    rows = []
    for v in range(vins):
        level = 30 + np.cumsum(rng.choice([0, 0, 0.2, -0.3, 15, -14], n, p=[0.5, 0.2, 0.1, 0.15, 0.025, 0.025]))
        rows += [(f"V{v}", m, float(x)) for m, x in enumerate(level)]
    return rows


def shuffled_batches(rows, size, delay, seed):
    """Batches whose rows are at most ``delay`` minutes out of order."""
    rng = np.random.default_rng(seed)
    order = sorted(rows, key=lambda r: r[1] + rng.uniform(0, delay))
    return [order[i : i + size] for i in range(0, len(order), size)]


CLOSING = [("closing", 100_000, 50.0)]


def test_shuffled_stream_equals_the_replay(stateful):
    rows = walk(1)
    for step, expected in ((None, rows), ("5 minutes", rows)):
        batches = shuffled_batches(rows, 400, 25, 7)
        assert [r for b in batches for r in b] != rows
        got = run(refuel_events_timed(stream_of(stateful, [*batches, CLOSING]), step, "30 minutes"))
        # the replay leaves a vehicle's newest step open: a later reading closes it there
        ended = expected + [(f"V{v}", 90_000, 0.0) for v in range(4)] if step else expected
        want = sorted(tuple(r) for r in refuel_events(readings(stateful, ended), step).collect())
        assert got == want and len(want) > 3


def test_a_timer_closes_the_open_step(stateful):
    rows = [("V", m, x) for m, x in enumerate([20, 20, 20, 20, 20, 40, 40, 40.0])]
    assert run(refuel_events_timed(stream_of(stateful, [rows]), "1 minute", "2 minutes")) == []
    got = run(refuel_events_timed(stream_of(stateful, [rows, [("other", 30, 1.0)]]), "1 minute", "2 minutes"))
    assert [r[:3] for r in got] == [("V", 40.0, 20.0)]


def test_an_idle_vehicle_begins_anew(stateful):
    rows = [("V", 0, 20.0), *(("V", 5000 + m, 40.0) for m in range(6))]
    batches = [rows[:1], [("other", 3000, 1.0)], [("other", 3001, 1.0)], rows[1:], CLOSING]
    assert len(run(refuel_events_timed(stream_of(stateful, batches), None, "1 minute"))) == 1
    assert run(refuel_events_timed(stream_of(stateful, batches), None, "1 minute", idle="1 day")) == []


def test_unusable_levels_do_not_reach_the_state(stateful):
    rows = [("V", m, x) for m, x in enumerate([20, 20, 20, 20, 20, 40, 40, 40.0])]
    dirty = [*rows, ("V", 3, None), ("V", 4, float("nan")), ("V", None, 90.0), (None, 1, 90.0)]
    assert len(run(refuel_events_timed(stream_of(stateful, [dirty, CLOSING]), None, "2 minutes"))) == 1


@pytest.mark.parametrize(("window", "slide"), [("30 minutes", "10 minutes"), ("360 minutes", "1 minute"), ("25 minutes", "10 minutes")])
def test_panes_equal_windows(stateful, window, slide):
    rows = [(v, m, x) for v, m, x in walk(3, 3, 200) if m % 50 < 20 or v == "V1"]
    rows += [("V0", 700, 5.0), ("V2", 701, 6.5), ("V2", 701, 6.5)]
    want = sorted(tuple(r) for r in low_fuel_windows(readings(stateful, rows), window, slide, 29.0).collect())
    batch = sorted(tuple(r) for r in low_fuel_panes(readings(stateful, rows), window, slide, 29.0).collect())
    stream = run(low_fuel_panes_stream(stream_of(stateful, [*shuffled_batches(rows, 150, 20, 5), CLOSING]), window, slide, 29.0, "30 minutes"))
    assert len(want) > 5
    for got in (batch, stream):
        assert [r[:3] for r in got] == [r[:3] for r in want]
        assert np.allclose([r[3] for r in got], [r[3] for r in want], rtol=0, atol=1e-9)


def test_state_does_not_grow_with_the_overlap(stateful):
    """Ten readings make at most ten panes per vehicle, at three windows per reading and at 360."""
    sizes = []
    for slide in ("120 minutes", "1 minute"):
        df = low_fuel_panes_stream(stream_of(stateful, [[("V", m * 7, 5.0) for m in range(10)]]), "360 minutes", slide, 20.0, "1 day")
        q = (df.writeStream.format("noop").option("checkpointLocation", tempfile.mkdtemp()).outputMode("append").trigger(availableNow=True).start())
        q.awaitTermination(300)
        sizes.append(max(o["numRowsTotal"] for p in q.recentProgress for o in p["stateOperators"]))
    assert max(sizes) <= 16  # panes, and a few rows of timers


def test_sparse_panes_are_not_dealt_to_their_windows(stateful):
    """A reading in 360 windows makes a few rows, not 360, before the threshold is asked; those below it all come out."""
    rows = [("A", 0, 50.0), ("A", 100, 5.0), ("A", 90 * 24 * 60, 5.0), ("B", -1441, 5.0), ("B", 700, 60.0)]
    df = readings(stateful, rows)
    got = low_fuel_panes(df, "6 hours", "1 minute", 20.0)
    want = sorted(tuple(r) for r in low_fuel_windows(df, "6 hours", "1 minute", 20.0).collect())
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) == 100 + 360 + 360
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    above = plan.split("Window ")[0]
    assert "Aggregate" not in above and "Generate explode(sequence(" in above


@pytest.mark.parametrize("window,slide", [("30 minutes", "10 minutes"), ("50 minutes", "20 minutes"), ("6 hours", "1 minute")])
def test_panes_equal_windows_over_many_stretches(stateful, window, slide):
    rng = np.random.default_rng(7)
    rows = [(f"V{i % 3}", int(m), float(rng.integers(0, 60))) for i, m in enumerate(rng.integers(-3000, 3000, 300))]
    df = readings(stateful, rows)
    want = sorted(tuple(r) for r in low_fuel_windows(df, window, slide, 29.0).collect())
    got = sorted(tuple(r) for r in low_fuel_panes(df, window, slide, 29.0).collect())
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want])


def test_panes_of_odd_values_and_empty_tables(stateful):
    rows = [("V", 0, 5.0), ("V", 1, float("nan")), ("V", 2, None), ("W", 0, 4.0), ("W", 40, float("inf")), (None, 1, 3.0)]
    usable = [r for r in rows if r[0] is not None]
    want = sorted(tuple(r) for r in low_fuel_windows(readings(stateful, usable), "30 minutes", "10 minutes", 20.0).collect())
    assert sorted(tuple(r) for r in low_fuel_panes(readings(stateful, rows), "30 minutes", "10 minutes", 20.0).collect()) == want
    assert run(low_fuel_panes_stream(stream_of(stateful, [rows, CLOSING]), "30 minutes", "10 minutes", 20.0, "1 hour")) == want
    assert low_fuel_panes(readings(stateful, rows).limit(0), "30 minutes", "10 minutes", 20.0).count() == 0


def envelope(vin, sent, levels):
    """An upload: ``levels`` as (minute, level), level None for text that is no number."""
    at = START + dt.timedelta(minutes=sent)
    body = [{"ts": str(START + dt.timedelta(minutes=m)), "stype": S.FUEL_LEVEL, "value": x} for m, x in levels]
    return vin, at.strftime("%Y%m%d%H%M%S") + "000", json.dumps(body)


def test_all_detectors_with_one_scan(stateful):
    rows = walk(6, 3, 240)
    uploads = [envelope(v, m + 1, [(m, x)]) for v, m, x in rows]
    uploads += [envelope("V0", 500, [(10, 1.0)]), envelope("V1", 30, [(29, None)]), envelope("closing", 90_001, [(90_000, 50.0)])]
    src = tempfile.mkdtemp(prefix="once-src-")
    for i, lo in enumerate(range(0, len(uploads), 250)):
        path = os.path.join(src, f"b={i}")
        stateful.createDataFrame(sorted(uploads, key=lambda u: u[1])[lo : lo + 250], S.ENVELOPE).coalesce(1).write.parquet(path)
        for name in os.listdir(path):
            os.utime(os.path.join(path, name), (1_700_000_000 + i, 1_700_000_000 + i))
    stream = stream_signals(stateful.readStream.schema(S.ENVELOPE).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src))
    out = tempfile.mkdtemp(prefix="once-out-")
    q = run_detectors_once(stream, out, tempfile.mkdtemp(), "1 hour", {"availableNow": True}, "30 minutes", "10 minutes", 29.0, None)
    assert q.awaitTermination(300) and q.exception() is None
    assert {len(p["sources"]) for p in q.recentProgress} == {1}
    assert sum(p["numInputRows"] for p in q.recentProgress) == len(uploads)  # every upload is read once
    sig = readings(stateful, rows)
    want = sorted(tuple(r) for r in refuel_events(sig, None).collect())
    got = stateful.read.parquet(f"{out}/refuel").drop("epoch", "payload")
    assert sorted(tuple(r) for r in got.collect()) == want and len(want) > 1
    windows = low_fuel_alerts(low_fuel_windows(sig, "30 minutes", "10 minutes", 29.0))
    low = stateful.read.parquet(f"{out}/low_fuel").drop("epoch")
    assert sorted((r.vin, r.window_start) for r in low.collect()) == sorted((r.vin, r.window_start) for r in windows.collect())
    late = stateful.read.parquet(f"{out}/late").collect()
    assert [(r.vin, r.value, r.ts) for r in late] == [("V0", 1.0, START + dt.timedelta(minutes=10))]
    unusable = stateful.read.parquet(f"{out}/unusable").collect()
    assert [(r.vin, r.value, r.ts) for r in unusable] == [("V1", None, START + dt.timedelta(minutes=29))]


class Held:
    """A value of the state that counts the questions put to it."""

    def __init__(self):
        self.value, self.calls = None, 0

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None


class Handle:
    def __init__(self):
        self.held, self.timers = Held(), []

    def getValueState(self, name, schema):
        return self.held

    def registerTimer(self, at):
        self.timers.append(at)


class Watermark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


@pytest.mark.parametrize("kind", ["refuel", "panes"])
def test_the_state_is_asked_once_for_all_rows_of_a_vehicle(kind):
    minutes = np.arange(50, dtype=np.int64)
    if kind == "refuel":
        one = RefuelProcessor(None, None)
        part = pd.DataFrame({"t_us": minutes[::-1] * 60_000_000, "level": [40.0] * 20 + [20.0] * 30})
    else:
        one = PaneProcessor(60_000_000, 30, 10, 30.0)
        part = pd.DataFrame({"pane": minutes[::-1], "value": [40.0] * 20 + [20.0] * 30})
    handle = Handle()
    one.init(handle)
    assert list(one.handleInputRows(("V",), iter([part[:25], part[25:]]), Watermark(0))) == []
    assert handle.held.calls == 2 and len(handle.timers) == 1
    rows = pd.concat(one.handleExpiredTimer(("V",), Watermark(3_600_000), None))
    assert handle.held.calls == 4
    if kind == "refuel":
        assert rows[["fuel_mass", "fill_amount"]].values.tolist() == [[40.0, 20.0]]
    else:
        assert rows[["start", "avg_level"]].values.tolist() == [[-20, 20.0], [-10, 20.0], [0, 20.0], [10, (20 * 20 + 10 * 40) / 30]]
