"""Telemetry fixtures derived, on Spark, from the driver's ``events`` table.

One event stands for one upload of one vehicle; it fans out into seven
readings at the same instant (see FIXTURES.md).  Everything here is a lazy
projection of ``events`` — no data passes through the driver — so the
fixtures grow with the input table.
"""

from __future__ import annotations

import hashlib
import os
import threading
import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import schemas as S

EPOCH = "2024-01-01 00:00:00"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def vin_of(user_id: Column) -> Column:
    return F.concat(F.lit("VIN"), F.lpad(user_id.cast("string"), 5, "0"))


def _base(events: DataFrame) -> DataFrame:
    """Columns every fixture is computed from."""
    sec = F.timestamp_diff("SECOND", F.lit(EPOCH).cast("timestamp_ntz"), F.col("ts"))
    return events.select(
        vin_of(F.col("user_id")).alias("vin"),
        F.col("event_id"),
        F.col("ts"),
        F.col("event_type").alias("et"),
        F.col("value").alias("v"),
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        F.col("user_id").alias("u"),
        sec.alias("s"),
    )


def signals_from_events(events: DataFrame) -> DataFrame:
    """Long signal table (vin, ts, stype, value): seven readings per event."""
    b = _base(events)
    hour = F.floor(F.col("s") / 3600) % 144
    readings = [
        (S.SPEED, F.when(F.col("et") == "error", 0).otherwise(F.col("k"))),
        (S.RPM, F.when(F.col("et") == "signup", 0).otherwise(800 + 20 * F.col("k"))),
        (S.INJECTION, F.floor(F.col("v")) * 0.25),
        (S.AIRCON, F.col("k") % 2),
        (S.ODOMETER, F.floor(F.col("s") / 360) + F.col("u") * 10),
        (S.FUEL_LEVEL, F.when(hour < 96, 60).otherwise(60 - (hour - 96))),
        (S.FUEL_SUPPLY, F.element_at(F.array(*[F.lit(x) for x in (0, 1, 2, 4, 8)]), F.col("k") % 5 + 1)),
    ]
    arr = F.array(*[
        F.struct(F.lit(name).alias("stype"), expr.cast("double").alias("value"))
        for name, expr in readings
    ])
    return b.select("vin", "ts", F.inline(arr))


def dense_signals_from(events: DataFrame) -> DataFrame:
    """A denser and dirtier signal table: five instants per event, 0, 100, 150, 1000 and 1100 ms after it.

    Injection at all five (two share a tenth of a second; null where event number + instant
    is divisible by 9); speed, rotation and supply factor at 0 and 1000 ms only; the odometer at 0 ms of even
    events, so many seconds have none (null for every 14th event); a level at 0 ms (null for every 10th event);
    air-con at 0 ms, for every 3rd event with its opposite at the same instant (a tie).
    """
    b = _base(events)
    hour = F.floor(F.col("s") / 3600) % 144
    n = F.col("event_id")
    level = F.when(hour < 96, 60).otherwise(60 - (hour - 96))
    supply = F.element_at(F.array(*[F.lit(float(x)) for x in (0, 1, 2, 4, 8)]), F.col("k") % 5 + 1)
    rows = []

    def add(ms: int, stype: str, value, present=None, null=None):
        value = value.cast("double") if null is None else F.when(~null, value.cast("double"))
        row = F.struct(F.lit(ms).alias("ms"), F.lit(stype).alias("stype"), value.alias("value"))
        rows.append(row if present is None else F.when(present, row))

    for j, ms in enumerate((0, 100, 150, 1000, 1100)):
        add(ms, S.INJECTION, F.floor("v") * 0.25 + j * 0.5, null=(n + j) % 9 == 0)
    for ms in (0, 1000):
        add(ms, S.SPEED, F.when(F.col("et") == "error", 0).otherwise(F.col("k")))
        add(ms, S.RPM, F.when(F.col("et") == "signup", 0).otherwise(800 + 20 * F.col("k")))
        add(ms, S.FUEL_SUPPLY, supply)
    add(0, S.ODOMETER, F.floor(F.col("s") / 360) + F.col("u") * 10, present=n % 2 == 0, null=n % 14 == 0)
    add(0, S.FUEL_LEVEL, level, null=n % 10 == 0)
    add(0, S.AIRCON, F.col("k") % 2)
    add(0, S.AIRCON, 1 - F.col("k") % 2, present=n % 3 == 0)
    out = b.select("vin", "ts", F.explode(F.array_compact(F.array(*rows))).alias("r"))
    micros = F.col("r.ms") * 1000
    return out.select("vin", F.timestamp_add("MICROSECOND", micros, F.col("ts")).alias("ts"), "r.stype", "r.value")


def fills_from_events(events: DataFrame) -> DataFrame:
    """Refuelling records: one per ``purchase`` event."""
    b = _base(events).where(F.col("et") == "purchase")
    grade = F.element_at(F.array(F.lit("92"), F.lit("95"), F.lit("98")), F.col("k") % 3 + 1)
    return b.select(
        "vin",
        F.col("ts").alias("fill_start_time"),
        F.col("k").alias("gas_id"),
        grade.alias("fill_grade"),
        (F.lit(6.0) + 0.25 * (F.col("k") % 4)).cast("double").alias("price"),
    )


def _even_vehicle(vin: Column) -> Column:
    return F.substring(vin, -5, 5).cast("int") % 2 == 0


def processed_fills_from(fills: DataFrame) -> DataFrame:
    """Processed-fill marks for even vehicles only (odd ones have no mark)."""
    return (
        fills.where((F.col("fill_start_time") < F.lit("2024-01-08").cast("timestamp_ntz"))
                    & _even_vehicle(F.col("vin")))
        .groupBy("vin").agg(F.max("fill_start_time").alias("fill_ts"))
    )


def km_checkpoint_from(events: DataFrame) -> DataFrame:
    """Even vehicles have finished 100-km buckets 0..9 of the fuel total."""
    vins = events.select(vin_of(F.col("user_id")).alias("vin")).distinct()
    return vins.where(_even_vehicle(F.col("vin"))).select(
        "vin", F.lit(S.INJECTION).alias("stype"), F.lit(10).alias("per100"))


def envelopes_from(events: DataFrame) -> DataFrame:
    """Upload envelopes: one per (vehicle, instant), payload = its readings.

    Send time is one second after the readings, except ``click`` events,
    whose send time is one second *before* (those readings must be dropped).
    The send time uses the compact spelling, the readings the ISO one.
    """
    b = _base(events)
    sig = signals_from_events(events)
    shift = F.when(F.col("et") == "click", F.lit(-1)).otherwise(F.lit(1))
    sends = b.select("vin", "ts", F.timestamp_add("SECOND", shift, F.col("ts")).alias("send_ts"))
    reading = F.struct(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "stype", "value")
    payload = sig.groupBy("vin", "ts").agg(F.to_json(F.collect_list(reading)).alias("DT"))
    return payload.join(sends, ["vin", "ts"]).select(
        F.col("vin").alias("FR"),
        F.date_format("send_ts", "yyyyMMddHHmmssSSS").alias("TS"),
        "DT",
    )


def dirty_envelopes_from(events: DataFrame) -> DataFrame:
    """Uploads as :func:`envelopes_from` makes them, one reading each, some of them broken.

    By the event's number: every 5th has no usable send time, every 7th no JSON payload,
    every 11th a reading without a usable time, every 13th one with a
    value that is no number, every 17th no vehicle; all others are sound, with quoted
    values and nine fraction digits.
    """
    b = _base(events)
    n = F.col("event_id")
    ts = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    reading = F.to_json(F.array(F.struct(
        F.when(n % 11 == 0, F.lit("noon")).otherwise(F.concat(ts, F.lit("999Z"))).alias("ts"), F.lit(S.INJECTION).alias("stype"),
        F.when(n % 13 == 0, F.lit("high")).otherwise((F.floor("v") * 0.25).cast("string")).alias("value"))))
    send = F.date_format(F.timestamp_add("SECOND", F.lit(1), F.col("ts")), "yyyyMMddHHmmssSSS")
    return b.select(F.when(n % 17 != 0, F.col("vin")).alias("FR"), F.when(n % 5 == 0, F.lit("yesterday")).otherwise(send).alias("TS"),
                    F.when(n % 7 == 0, F.lit("[{")).otherwise(reading).alias("DT"))


def derive(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All fixtures of one scale factor as lazy projections of ``events``."""
    events = read_table(spark, sf_dir, "events")
    fills = fills_from_events(events)
    return {
        "events": events,
        "signals": signals_from_events(events),
        "dense_signals": dense_signals_from(events),
        "fills": fills,
        "processed_fills": processed_fills_from(fills),
        "km_checkpoint": km_checkpoint_from(events),
        "envelopes": envelopes_from(events),
        "dirty_envelopes": dirty_envelopes_from(events),
    }


_LOCK = threading.Lock()
_LOADED: dict[tuple[str, str], _Written] = {}


def _stamp(spark: SparkSession, sf_dir: str) -> str:
    """Identity of the derived tables: input and all code that derives and writes them."""
    from .functions import timefmt
    from .operators import etl
    from .sources import sinks

    code = hashlib.sha1()
    for path in (__file__, S.__file__, timefmt.__file__, etl.__file__, sinks.__file__):
        with open(path, "rb") as f:
            code.update(f.read())
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(os.path.join(sf_dir, "events.parquet"))
    st = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
    key = f"{sf_dir}:{st.getLen()}:{st.getModificationTime()}:{code.hexdigest()}"
    return hashlib.sha1(key.encode()).hexdigest()[:16]


def _publish(spark: SparkSession, write, path: str) -> None:
    """Write to a private folder, then rename it into place (atomic on a
    shared file system); a concurrent writer that got there first wins."""
    from .session import path_exists
    jvm = spark.sparkContext._jvm
    tmp = f"{path}.tmp-{uuid.uuid4().hex[:12]}"
    write(tmp)
    dst = jvm.org.apache.hadoop.fs.Path(path)
    fs = dst.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not path_exists(spark, path):
        fs.rename(jvm.org.apache.hadoop.fs.Path(tmp), dst)


class _Written(Mapping):
    """The fixtures by name: a derived table is written when it is first asked for, and only that one."""

    def __init__(self, spark: SparkSession, derived: dict[str, DataFrame], root: str):
        self._spark, self._derived, self._root = spark, derived, root
        self._back: dict[str, DataFrame] = {"events": derived["events"]}
        self._names = [*derived, *(f"{n}_by_day" for n in derived if n.endswith("signals"))]

    def __getitem__(self, name: str) -> DataFrame:
        with _LOCK:
            if name not in self._back:
                if name not in self._names:
                    raise KeyError(name)
                self._write(name.removesuffix("_by_day"))
            return self._back[name]

    def __iter__(self):
        return iter(self._names)

    def __len__(self) -> int:
        return len(self._names)

    def _write(self, name: str) -> None:
        from .session import path_exists
        from .sources.sinks import write_by_date

        df, path = self._derived[name], os.path.join(self._root, name)
        by_day = name.endswith("signals")
        if not path_exists(self._spark, os.path.join(path, "_SUCCESS")):
            if by_day:
                _publish(self._spark, lambda p: write_by_date(df, p, "ts", mode="overwrite", sort_by=("vin", "ts")), path)
            else:
                _publish(self._spark, lambda p: df.write.mode("overwrite").parquet(p), path)
        if by_day:
            schema = T.StructType(S.SIGNAL.fields + [
                T.StructField(c, T.IntegerType()) for c in ("year", "month", "day")])
            self._back[f"{name}_by_day"] = self._spark.read.schema(schema).parquet(path)
            self._back[name] = self._back[f"{name}_by_day"].select("vin", "ts", "stype", "value")
        else:
            self._back[name] = self._spark.read.schema(df.schema).parquet(path)


def load(spark: SparkSession, sf_dir: str, materialize: bool = True) -> Mapping[str, DataFrame]:
    """All fixtures of one scale factor.

    With ``materialize`` a derived table is written once per session, when it is first
    asked for, to the shared folder the way the ETL lays out its cleaned zone — signals
    partitioned by ``year/month/day`` and sorted by (vin, ts) inside each
    file — and read back from there, so KPI queries scan a signal table with
    partition pruning and ``stype`` filters pushed into Parquet instead of
    re-deriving the fan-out from ``events`` every time.
    """
    if not materialize:
        return derive(spark, sf_dir)
    from .session import shared_dir

    root = os.path.join(shared_dir(spark), f"fixtures-{_stamp(spark, sf_dir)}")
    key = (spark.sparkContext.applicationId, root)
    with _LOCK:
        if key not in _LOADED:
            _LOADED[key] = _Written(spark, derive(spark, sf_dir), root)
        return _LOADED[key]
