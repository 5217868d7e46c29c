"""Refuelling detector (T8): a per-vehicle state machine over tank levels.

Rule, with ``L`` the buffer of (time, level) since the last reset and ``x``
the next level:

1. if ``L`` is not empty and ``x < last(L)`` and ``x < first(L)``: empty ``L``;
   then append ``x``;
2. with ``f = first``, ``l = last`` and ``l2``, ``l3`` the two before last: if
   ``l - f > 10`` and ``len(L) > 4`` and ``|l - l2| < 1`` and ``|l2 - l3| < 1``,
   emit a refuel of ``l3 - f`` from ``time(f)`` to ``time(l)`` leaving ``l3``
   in the tank, and empty ``L``.

Only ``first``, the last three levels and the length matter, so the state
is seven numbers however long the buffer grows (D26: it starts empty).

With ``step`` the machine sees one level per vehicle and step — the last
reading of each step, as the streaming job did per micro-batch.  The newest
step stays open (in the state) until a reading of a later step arrives; the
batch replay leaves it open as well, so both forms emit the same events.

Batch replay composes summaries of (vehicle, chunk of time) pieces (:mod:`.replay`).  The streaming form uses
``applyInPandasWithState`` with the same machine; ``read_stream(max_per_trigger=...)`` bounds a micro-batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.wide import epoch_micros

OUT_SCHEMA = ("vin string, fuel_mass double, fill_amount double, "
              "fill_start_time timestamp_ntz, fill_end_time timestamp_ntz, "
              "gps_latitude double, gps_longitude double")
STATE_SCHEMA = ("n long, f double, f_t long, l3 double, l2 double, l double, l_t long, "
                "open_step long, open_t long, open_v double")

# --- fixed values of the detection rule ---
RISE = 10.0
MIN_LEN = 4
PLATEAU = 1.0


class RefuelMachine:
    """The rule above on compact state; ``push`` returns emitted events."""

    def __init__(self, state: tuple | None = None):
        if state is None:
            state = (0, 0.0, 0, 0.0, 0.0, 0.0, 0, None, None, None)
        (self.n, self.f, self.f_t, self.l3, self.l2, self.l, self.l_t,
         self.open_step, self.open_t, self.open_v) = state

    def state(self) -> tuple:
        return (self.n, self.f, self.f_t, self.l3, self.l2, self.l, self.l_t,
                self.open_step, self.open_t, self.open_v)

    def _feed(self, t: int, x: float, out: list) -> None:
        if self.n > 0 and x < self.l and x < self.f:
            self.n = 0
        if self.n == 0:
            self.f, self.f_t = x, t
        self.l3, self.l2, self.l, self.l_t = self.l2, self.l, x, t
        self.n += 1
        if (self.n > MIN_LEN and self.l - self.f > RISE
                and abs(self.l - self.l2) < PLATEAU and abs(self.l2 - self.l3) < PLATEAU):
            out.append((self.l3, self.l3 - self.f, self.f_t, self.l_t))
            self.n = 0

    def push(self, ts_us: np.ndarray, levels: np.ndarray, step_us: int | None) -> list:
        out: list = []
        if step_us is None:
            for t, x in zip(ts_us.tolist(), levels.tolist()):
                self._feed(t, x, out)
            return out
        steps = (ts_us // step_us).tolist()
        for s, t, x in zip(steps, ts_us.tolist(), levels.tolist()):
            if self.open_step is None:
                self.open_step, self.open_t, self.open_v = s, t, x
            elif s == self.open_step:
                if t >= self.open_t:
                    self.open_t, self.open_v = t, x
            elif s > self.open_step:
                self._feed(self.open_t, self.open_v, out)
                self.open_step, self.open_t, self.open_v = s, t, x
            else:
                # a reading of an already closed step: taken in arrival order
                self._feed(t, x, out)
        return out


def _step_us(step: str | None) -> int | None:
    if step is None:
        return None
    num, unit = step.split()
    mult = {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600}[unit]
    return int(float(num) * mult * 1_000_000)


def _events_frame(vin: str, events: list) -> pd.DataFrame:
    cols = ["vin", "fuel_mass", "fill_amount", "fill_start_time", "fill_end_time",
            "gps_latitude", "gps_longitude"]
    if not events:
        return pd.DataFrame({c: pd.Series(dtype="float64") for c in cols}).astype(
            {"vin": "object", "fill_start_time": "datetime64[us]", "fill_end_time": "datetime64[us]"})
    arr = np.array(events, dtype="float64")
    return pd.DataFrame({
        "vin": vin,
        "fuel_mass": arr[:, 0],
        "fill_amount": arr[:, 1],
        "fill_start_time": pd.to_datetime(arr[:, 2].astype("int64"), unit="us"),
        "fill_end_time": pd.to_datetime(arr[:, 3].astype("int64"), unit="us"),
        "gps_latitude": 0.0,
        "gps_longitude": 0.0,
    })


def usable_level() -> Column:
    """A tank level that the machine can compare: a vehicle, a time and a number."""
    return F.col("vin").isNotNull() & F.col("ts").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value")


def unusable_levels(signals: DataFrame) -> DataFrame:
    """Side output: the tank-level readings that the detector leaves out."""
    return signals.where((F.col("stype") == S.FUEL_LEVEL) & ~usable_level())


def level_samples(df: DataFrame, step: str | None) -> DataFrame:
    """Tank-level readings as (vin, t_us, level); with ``step`` already reduced
    on Spark to the last reading of each (vehicle, step) — a grouped aggregate
    with a partial step, so the Python side sees at most one row per step."""
    lv = df.where((F.col("stype") == S.FUEL_LEVEL) & usable_level()).select(
        "vin", epoch_micros("ts").alias("t_us"),
        F.col("value").alias("level"))
    us = _step_us(step)
    if us is None:
        return lv
    # max_by on primitives keeps this a hash aggregate (a struct max would
    # force a sort-based one); equal timestamps give any one of the readings
    return (lv.groupBy("vin", F.floor(F.col("t_us") / us).alias("_step"))
            .agg(F.max("t_us").alias("t_us"), F.max_by("level", "t_us").alias("level"))
            .drop("_step"))


def refuel_events_stream(signals_stream: DataFrame, step: str | None = "5 seconds") -> DataFrame:
    """T8 streaming form: same machine, state kept per vehicle between micro-batches."""
    us = _step_us(step)
    lv = signals_stream.where((F.col("stype") == S.FUEL_LEVEL) & usable_level()).select(
        "vin", epoch_micros("ts").alias("t_us"),
        F.col("value").alias("level"))

    def update(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        machine = RefuelMachine(state.get if state.exists else None)
        t_us, levels = [], []  # two numbers per reading; the frames themselves are not kept
        for pdf in batches:
            t_us.append(pdf["t_us"].to_numpy(dtype="int64"))
            levels.append(pdf["level"].to_numpy(dtype="float64"))
        t, x = np.concatenate(t_us), np.concatenate(levels)
        order = np.argsort(t, kind="stable")
        events = machine.push(t[order], x[order], us)
        state.update(machine.state())
        if events:  # an empty frame per vehicle and micro-batch costs more than the rule
            yield _events_frame(key[0], events)

    return lv.groupBy("vin").applyInPandasWithState(
        update, OUT_SCHEMA, STATE_SCHEMA, "append", "NoTimeout")


def refuel_payload(events: DataFrame) -> DataFrame:
    """The alert's JSON body (camelCase keys as the receiving service expects)."""
    body = F.struct(
        F.col("vin").alias("vin"), F.col("fuel_mass").alias("fuelMass"),
        F.col("fill_amount").alias("fillAmount"),
        F.date_format("fill_start_time", "yyyy-MM-dd HH:mm:ss").alias("fillStartTime"),
        F.date_format("fill_end_time", "yyyy-MM-dd HH:mm:ss").alias("fillEndTime"),
        F.col("gps_latitude").alias("gpsLatitude"), F.col("gps_longitude").alias("gpsLongitude"))
    return events.withColumn("payload", F.to_json(body))
