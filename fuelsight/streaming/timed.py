"""Stream detectors with event-time timers (T6, T8): late readings are put in order, and time closes what is open.

Both keep keyed state through ``transformWithStateInPandas``, which needs the RocksDB state store
(:func:`fuelsight.session.stateful_conf`).  A reading counts if it comes within ``delay`` of the newest reading
of the fleet (the watermark); later ones are left out by Spark, and
:func:`fuelsight.streaming.detectors.late_readings` tells them.  What the watermark has passed can no longer change, so it is evaluated
in time order whatever the order of arrival, and a stream in any order within ``delay`` gives the rows of the batch form.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from .. import schemas as S
from ..operators.wide import epoch_micros
from ..sources.sinks import write_alerts
from .detectors import LOW_FUEL_SLIDE, LOW_FUEL_THRESHOLD, LOW_FUEL_WINDOW, MICRO_BATCH, low_fuel_alerts
from .refuel import OUT_SCHEMA, RefuelMachine, _events_frame, _step_us, refuel_payload, usable_level

_MACHINE = "n long, f double, f_t long, l3 double, l2 double, l double, l_t long"


def _frame(rows: list[tuple], columns: list[str]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=columns)


def _alarm(handle, at: int | None, due: int) -> int:
    """A timer at the earliest time at which there is something to do; a later one that is set already only finds less left."""
    if at is None or due < at:
        handle.registerTimer(due)
        return due
    return at


class RefuelProcessor(StatefulProcessor):
    """T8 per vehicle: readings wait in a buffer until the watermark has passed them (with ``step_us``: the end of their step).

    Each question to the state is a round trip to the JVM, so a vehicle's machine, buffer and alarm are one value: read once and
    written once for its rows of a micro-batch, and for a timer.
    """

    def __init__(self, step_us: int | None, idle_ms: int | None):
        self.step_us, self.idle_ms = step_us, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.held = handle.getValueState("refuel", f"{_MACHINE}, at long, t binary, level binary")

    def _load(self) -> tuple[tuple | None, int | None, np.ndarray, np.ndarray]:
        held = self.held.get()
        if held is None:
            return None, None, np.zeros(0, np.int64), np.zeros(0)
        *machine, at, t, level = held
        return None if machine[0] is None else tuple(machine), at, np.frombuffer(t, np.int64), np.frombuffer(level, np.float64)

    def _store(self, machine: tuple | None, at: int | None, t: np.ndarray, level: np.ndarray) -> None:
        if machine is None and at is None and not len(t):
            self.held.clear()
        else:
            self.held.update((*(machine or [None] * 7), at, t.tobytes(), level.tobytes()))

    def _due(self, t):
        """The watermark (ms) from which on a reading of ``t`` (us) can be taken: none of its time, or of its step, can still come."""
        return -(-t // 1000) if self.step_us is None else -(-(t // self.step_us + 1) * self.step_us // 1000)

    def _settle(self, watermark: int) -> list:
        """Takes every reading that the watermark allows; the others wait on."""
        state, at, t, level = self._load()
        at = None
        order = np.lexsort((level, t))
        t, level = t[order], level[order]
        n = int((self._due(t) <= watermark).sum())  # a time's due time grows with it
        events: list = []
        if n:
            machine = RefuelMachine(None if state is None else (*state, None, None, None))
            ready = list(zip(t[:n].tolist(), level[:n].tolist(), strict=True))
            if self.step_us is not None:  # the last reading of each step
                ready = list({t // self.step_us: (t, x) for t, x in ready}.values())
            for one, x in ready:
                machine._feed(one, x, events)
            state, t, level = machine.state()[:7], t[n:], level[n:]
        if len(t):
            at = _alarm(self.handle, at, self._due(int(t[0])))
        elif self.idle_ms is not None and state is not None:
            last = state[6] // 1000 + self.idle_ms
            if last <= watermark:
                state = None
            else:
                at = _alarm(self.handle, at, last)
        self._store(state, at, t, level)
        return events

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        parts = [(part["t_us"].to_numpy(dtype=np.int64), part["level"].to_numpy(dtype=np.float64)) for part in rows]
        earliest = min((int(t.min()) for t, _ in parts if len(t)), default=None)
        if earliest is not None:
            machine, at, t, level = self._load()
            at = _alarm(self.handle, at, max(self._due(earliest), timerValues.getCurrentWatermarkInMs()))
            self._store(machine, at, np.concatenate([t, *(p[0] for p in parts)]), np.concatenate([level, *(p[1] for p in parts)]))
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        events = self._settle(timerValues.getCurrentWatermarkInMs())
        if events:
            yield _events_frame(key[0], events)


def _millis(duration: str | None) -> int | None:
    if duration is None:
        return None
    us = _step_us(duration) if duration.split()[1].rstrip("s") in ("second", "minute", "hour") else int(float(duration.split()[0]) * 86_400_000_000)
    return us // 1000


def refuel_events_timed(signals_stream: DataFrame, step: str | None = "5 seconds", delay: str = "1 hour", idle: str | None = None) -> DataFrame:
    """T8 over a stream in any order within ``delay``: the events of the batch replay, once the watermark has passed them.

    The newest step of a vehicle is closed by time, not only by its next reading.  ``idle`` (seconds to days)
    ends a vehicle's state when nothing has come for so long: it then begins with an empty buffer.
    """
    lv = signals_stream.where((F.col("stype") == S.FUEL_LEVEL) & usable_level()).select(
        "vin", F.col("ts").cast("timestamp").alias("_ets"), epoch_micros("ts").alias("t_us"), F.col("value").alias("level"))
    return lv.withWatermark("_ets", delay).groupBy("vin").transformWithStateInPandas(
        RefuelProcessor(_step_us(step), _millis(idle)), OUT_SCHEMA, "Append", "EventTime")


class PaneProcessor(StatefulProcessor):
    """T6 per vehicle: one (sum, count) per pane that has readings; a window adds the panes that enter and takes off those that leave.

    A vehicle's panes, its next window and its alarm are one value of the state, as in :class:`RefuelProcessor`.
    """

    def __init__(self, pane_us: int, per_window: int, per_slide: int, threshold: float):
        self.pane_us, self.per_window, self.per_slide, self.threshold = pane_us, per_window, per_slide, threshold

    def init(self, handle) -> None:
        self.handle = handle
        # ``next``: the first window (in panes) that has not been judged
        self.held = handle.getValueState("panes", "next long, at long, pane binary, total binary, number binary, odd binary")

    def _load(self) -> tuple[int | None, int | None, dict[int, tuple[float, int, int]]]:
        held = self.held.get()
        if held is None:
            return None, None, {}
        pane, total, number, odd = (np.frombuffer(b, t).tolist() for b, t in zip(held[2:], (np.int64, np.float64, np.int64, np.int64), strict=True))
        return held[0], held[1], dict(zip(pane, zip(total, number, odd, strict=True), strict=True))

    def _store(self, following: int | None, at: int | None, panes: dict[int, tuple[float, int, int]]) -> None:
        columns = list(zip(*panes.values(), strict=True)) or [(), (), ()]
        self.held.update((following, at, np.array(list(panes), np.int64).tobytes(), np.array(columns[0], np.float64).tobytes(),
                          np.array(columns[1], np.int64).tobytes(), np.array(columns[2], np.int64).tobytes()))

    def _first(self, pane: int) -> int:
        """The earliest window that holds a pane."""
        return -(-(pane - self.per_window + 1) // self.per_slide) * self.per_slide

    def _end_ms(self, start: int) -> int:
        return -(-(start + self.per_window) * self.pane_us // 1000)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found: dict[int, list] = {}
        for part in rows:
            at, values = part["pane"].to_numpy(dtype=np.int64), part["value"].to_numpy(dtype=np.float64)
            order = np.argsort(at, kind="stable")
            at, values = at[order], values[order]
            edges = np.flatnonzero(np.diff(at)) + 1
            for pane, some in zip(at[[0, *edges]].tolist() if len(at) else [], np.split(values, edges), strict=False):
                plain = np.isfinite(some)
                one = found.setdefault(pane, [0.0, 0, 0])
                one[0] += math.fsum(some[plain])
                one[1] += int(plain.sum())
                one[2] += int((~plain).sum())
        if found:
            following, alarm, panes = self._load()
            for pane, (total, number, odd) in found.items():
                t, n, o = panes.get(pane, (0.0, 0, 0))
                panes[pane] = (total + t, number + n, odd + o)
            start = self._first(min(found))
            start = start if following is None else max(start, following)
            alarm = _alarm(self.handle, alarm, max(self._end_ms(start), timerValues.getCurrentWatermarkInMs()))
            self._store(following, alarm, panes)
        yield from ()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        watermark = timerValues.getCurrentWatermarkInMs()
        before, _, held = self._load()
        panes = sorted((k, *v) for k, v in held.items())
        start = self._first(panes[0][0]) if panes else 0
        if before is not None:
            start = max(start, before)
        out, low, high, total, number, odd = [], 0, 0, 0.0, 0, 0
        while low < len(panes) and self._end_ms(start) <= watermark:
            while high < len(panes) and panes[high][0] < start + self.per_window:
                total, number, odd, high = total + panes[high][1], number + panes[high][2], odd + panes[high][3], high + 1
            while low < high and panes[low][0] < start:
                total, number, odd, low = total - panes[low][1], number - panes[low][2], odd - panes[low][3], low + 1
            if low == high:
                total = 0.0  # no pane in the window: nothing of a rounding error is carried on
            if number and not odd and total / number < self.threshold:
                out.append((key[0], start, total / number))
            following = start + self.per_slide
            if low == high and high < len(panes):  # nothing until the window that holds the next pane
                following = max(following, self._first(panes[high][0]))
            start = following
        rest = {p: (t, n, o) for p, t, n, o in panes if p >= start}
        alarm = None
        if rest:
            alarm = _alarm(self.handle, None, self._end_ms(max(start, self._first(min(rest)))))
        self._store(start, alarm, rest)
        if out:
            yield _frame(out, ["vin", "start", "avg_level"])


def _levels(signals: DataFrame) -> DataFrame:
    return signals.where((F.col("stype") == S.FUEL_LEVEL) & F.col("vin").isNotNull() & F.col("ts").isNotNull() & F.col("value").isNotNull())


def _pane_sizes(window: str, slide: str) -> tuple[int, int, int]:
    """Microseconds of a pane, panes of a window and of a slide: the pane is the largest that divides both."""
    w, s = _millis(window) * 1000, _millis(slide) * 1000
    pane = math.gcd(w, s)
    return pane, w // pane, s // pane


def _bounds(rows: DataFrame, pane_us: int, window: str) -> DataFrame:
    start = F.timestamp_add("MICROSECOND", F.col("start") * pane_us, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return rows.select("vin", start.alias("window_start"), (start + F.expr(f"INTERVAL {window}")).alias("window_end"), "avg_level")


def _pane_of(pane_us: int) -> Column:
    return F.floor(epoch_micros("ts") / pane_us)


#: Windows' starts are dealt to tasks in stretches of so many windows' lengths.
STRETCH = 4


def low_fuel_panes(signals: DataFrame, window: str, slide: str, threshold: float) -> DataFrame:
    """T6 in batch by panes: readings are added up per pane first, and a mean is taken only where the panes of a window change.

    The rows of :func:`fuelsight.streaming.detectors.low_fuel_windows` of known vehicles (a window with a level that is not a number, or infinite, is not below).  With a window of 360 slides that one copies
    each reading 360 times before its partial aggregate.  Here a pane marks the first window that holds it and the first that does not; the windows from a mark to the next hold
    the same panes, so they share one mean, and only those below the threshold are written out.  A vehicle is dealt in stretches of ``STRETCH`` windows' length.
    """
    pane, per_window, per_slide = _pane_sizes(window, slide)
    panes = _levels(signals).groupBy("vin", _pane_of(pane).alias("pane")).agg(F.sum("value").alias("total"), F.count("value").alias("number"))
    long = -(-STRETCH * per_window // per_slide) * per_slide  # panes of a stretch: whole slides, and a pane is in two of them at most
    first = F.ceil((F.col("pane") - per_window + 1) / per_slide) * per_slide
    last = F.floor(F.col("pane") / per_slide) * per_slide
    held = panes.withColumn("first", first).withColumn("last", last).where("first <= last")
    held = held.withColumn("part", F.explode(F.sequence(F.floor(F.col("first") / long), F.floor(F.col("last") / long))))
    enters = F.greatest(F.col("first"), F.col("part") * long)
    leaves = F.least(F.col("last") + per_slide, (F.col("part") + 1) * long)

    def row(at: Column, total: Column, number: Column, mark: bool) -> Column:
        return F.struct(at.alias("at"), total.alias("total"), number.alias("number"), F.lit(mark).alias("mark"))

    none, zero = F.lit(None).cast("double"), F.lit(0).cast("long")
    rows = held.select("vin", "part", F.inline(F.array(row(F.col("pane"), F.col("total"), F.col("number"), False), row(enters, none, zero, True),
                                                       row(leaves, none, zero, True))))
    rows = rows.repartition("vin", "part").groupBy("vin", "part", "at").agg(F.sum("total").alias("total"), F.sum("number").alias("number"), F.max("mark").alias("mark"))
    mine = Window.partitionBy("vin", "part").orderBy("at")
    window_at = mine.rangeBetween(0, per_window - 1)
    marks = rows.withColumn("total", F.sum("total").over(window_at)).withColumn("number", F.sum("number").over(window_at)).where("mark")
    means = marks.select("vin", "at", F.lead("at").over(mine).alias("next"), F.when(F.col("number") > 0, F.col("total") / F.col("number")).alias("avg_level"))
    means = means.where((F.col("avg_level") < threshold) & F.col("next").isNotNull())
    starts = F.sequence(F.col("at"), F.col("next") - per_slide, F.lit(per_slide).cast("long"))
    return _bounds(means.select("vin", F.explode(starts).alias("start"), "avg_level"), pane, window)


def low_fuel_panes_stream(signals_stream: DataFrame, window: str, slide: str, threshold: float, delay: str) -> DataFrame:
    """T6 over a stream, state by panes: each reading changes one pane, and a timer at a window's end judges it.

    A vehicle's state is the panes that have readings within a window and ``delay``, however many windows overlap.
    """
    pane, per_window, per_slide = _pane_sizes(window, slide)
    lv = _levels(signals_stream).select("vin", F.col("ts").cast("timestamp").alias("_ets"), _pane_of(pane).alias("pane"), "value")
    found = lv.withWatermark("_ets", delay).groupBy("vin").transformWithStateInPandas(
        PaneProcessor(pane, per_window, per_slide, threshold), "vin string, start long, avg_level double", "Append", "EventTime")
    return _bounds(found, pane, window)


_FOUND = ["kind", "vin", "start_us", "end_us", "value", "amount"]


class DetectorProcessor(StatefulProcessor):
    """Both detectors on one pass of a vehicle's levels; ``late`` and ``unusable`` ones go through as they are."""

    def __init__(self, refuel: RefuelProcessor, panes: PaneProcessor):
        self.refuel, self.panes = refuel, panes

    def init(self, handle) -> None:
        self.refuel.init(handle)
        self.panes.init(handle)

    def _rows(self, vin: str, refuels: Iterator[pd.DataFrame], windows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rows: list[tuple] = []
        for part in refuels:
            start, end = (part[c].astype("datetime64[us]").astype("int64") for c in ("fill_start_time", "fill_end_time"))
            rows += [("refuel", vin, s, e, m, a) for s, e, m, a in zip(start, end, part["fuel_mass"], part["fill_amount"], strict=True)]
        pane, per_window = self.panes.pane_us, self.panes.per_window
        for part in windows:
            rows += [("low_fuel", vin, s * pane, (s + per_window) * pane, x, None) for s, x in zip(part["start"], part["avg_level"], strict=True)]
        if rows:
            yield _frame(rows, _FOUND)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        usable = []
        for part in rows:
            aside = part[part["kind"] != "level"]
            if len(aside):
                yield _frame([(k, key[0], None if pd.isna(t) else int(t), None if pd.isna(u) else int(u), x, None)
                              for k, t, u, x in zip(aside["kind"], aside["t_us"], aside["sent_us"], aside["value"], strict=True)], _FOUND)
            usable.append(part[part["kind"] == "level"])
        yield from self._rows(key[0], self.refuel.handleInputRows(key, (p.assign(level=p["value"]) for p in usable), timerValues),
                              self.panes.handleInputRows(key, iter(usable), timerValues))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._rows(key[0], self.refuel.handleExpiredTimer(key, timerValues, expiredTimerInfo),
                              self.panes.handleExpiredTimer(key, timerValues, expiredTimerInfo))


def run_detectors_once(signals_stream: DataFrame, out_dir: str, checkpoint_dir: str, delay: str, trigger: dict | None = None,
                       window: str = LOW_FUEL_WINDOW, slide: str = LOW_FUEL_SLIDE, threshold: float = LOW_FUEL_THRESHOLD,
                       refuel_step: str | None = MICRO_BATCH) -> StreamingQuery:
    """T9 with one scan: the tables of :func:`fuelsight.streaming.detectors.run_detectors` from one query.

    The stream is read and parsed once, both detectors share one keyed state, and each micro-batch is dealt to the tables
    ``low_fuel``, ``refuel``, ``late`` and ``unusable``, a folder per epoch that a repeated batch replaces.  A reading sent more than
    ``delay`` after it was read is ``late`` (if the stream has send times), and not in the other tables.
    """
    micros = epoch_micros("ts")
    known = F.col("vin").isNotNull() & F.col("ts").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value")
    kind = F.when(~known, "unusable")
    sent = F.lit(None).cast("long")
    if "send_ts" in signals_stream.columns:
        sent = epoch_micros("send_ts")
        kind = kind.when(F.col("send_ts") - F.expr(f"INTERVAL {delay}") > F.col("ts"), "late")
    pane, per_window, per_slide = _pane_sizes(window, slide)
    lv = signals_stream.where(F.col("stype") == S.FUEL_LEVEL).select(
        "vin", kind.otherwise("level").alias("kind"), micros.alias("t_us"), sent.alias("sent_us"), _pane_of(pane).alias("pane"), "value",
        # what only passes through has no event time, so the watermark does not drop it
        F.when(kind.isNull(), F.col("ts").cast("timestamp")).alias("_ets"))
    processor = DetectorProcessor(RefuelProcessor(_step_us(refuel_step), None), PaneProcessor(pane, per_window, per_slide, threshold))
    found = lv.withWatermark("_ets", delay).groupBy("vin").transformWithStateInPandas(
        processor, "kind string, vin string, start_us long, end_us long, value double, amount double", "Append", "EventTime")

    def wall(name: str) -> Column:
        return F.timestamp_add("MICROSECOND", F.col(name), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))

    def tables(rows: DataFrame) -> dict[str, DataFrame]:
        def of(k: str) -> DataFrame:
            return rows.where(F.col("kind") == k)

        reading = [wall("start_us").alias("ts"), F.lit(S.FUEL_LEVEL).alias("stype"), "value"]
        return {
            "low_fuel": low_fuel_alerts(of("low_fuel").select("vin", wall("start_us").alias("window_start"), wall("end_us").alias("window_end"),
                                                              F.col("value").alias("avg_level"))),
            "refuel": refuel_payload(of("refuel").select(
                "vin", F.col("value").alias("fuel_mass"), F.col("amount").alias("fill_amount"), wall("start_us").alias("fill_start_time"),
                wall("end_us").alias("fill_end_time"), F.lit(0.0).alias("gps_latitude"), F.lit(0.0).alias("gps_longitude"))),
            "unusable": of("unusable").select("vin", *reading),
            "late": of("late").select("vin", *reading, wall("end_us").alias("send_ts"))}

    def write(batch: DataFrame, epoch_id: int) -> None:
        batch.persist()
        for name, rows in tables(batch).items():
            if not rows.isEmpty():  # no folder for an epoch without rows
                write_alerts(rows, f"{out_dir}/{name}/epoch={epoch_id}", mode="overwrite")
        batch.unpersist()

    return (found.writeStream.outputMode("append").foreachBatch(write).option("checkpointLocation", checkpoint_dir)
            .trigger(**(trigger or {"processingTime": MICRO_BATCH})).start())
