"""Resuming without the odometer's history (I1): a zone map tells which files can matter.

The ETL keeps readings in a store (:mod:`fuelsight.sources.commits`), one part per (hash bucket of vehicles, day), and
beside it one row per part: how far the odometers had come in it and when it begins and ends.  A resume compares the rows
with the marks, bucket by bucket, twice: parts whose odometers have not reached the least advanced vehicle of their
bucket cannot hold a restart; and parts that end before the earliest restart of their bucket hold nothing to read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..sources.commits import Store
from .incremental import last_bucket, restart_times

SIGNALS, ZONES, VEHICLES = "signals", "signal_zones", "vehicles"
BUCKETS = 256


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("vin"), F.lit(buckets)).cast("int")


def add_signals(store: Store, signals: DataFrame, buckets: int = BUCKETS) -> int:
    """Adds readings, replacing the (bucket, day) parts that they have rows in, with their zone rows and vehicles; one commit."""
    tx = store.begin()
    zone = F.concat_ws("_", _bucket(buckets), F.coalesce(F.to_date("ts").cast("string"), F.lit("none")))
    rows = signals.withColumn("zone", zone)
    odometer = F.when(F.col("stype") == S.ODOMETER, F.col("value"))
    zones = rows.groupBy("zone").agg(F.max(odometer).alias("odo_max"), F.max("ts").alias("ts_max"), F.lit(tx.base["version"]).alias("version"))
    tx.replace(SIGNALS, rows, "zone")
    tx.upsert(ZONES, zones, ("zone",), "version")
    tx.merge(VEHICLES, signals.select("vin").distinct(), ("vin",), DataFrame.distinct)
    return tx.commit()


def _names(zones: DataFrame) -> list[str]:
    """Names of parts: a few bytes for each (bucket, day) that is needed, no readings."""
    return [r[0] for r in zones.select("zone").collect()]


def resume_parts(store: Store, checkpoint: DataFrame, stype: str, buckets: int = BUCKETS) -> tuple[list[str], DataFrame, list[str]]:
    """Parts that hold the restart times, those times, and the parts to read from there on."""
    zones = store.read(ZONES).withColumn("bucket", F.substring_index("zone", "_", 1).cast("int"))
    done = last_bucket(checkpoint, stype).select("vin", "km")
    least = (store.read(VEHICLES).join(done, "vin", "left").groupBy(_bucket(buckets).alias("bucket"))
             .agg(F.min(F.coalesce("km", F.lit(0))).alias("least")))  # a vehicle without a mark starts at 0
    first = _names(zones.join(least, "bucket").where(F.col("odo_max") >= F.col("least")))
    starts = restart_times(store.read(SIGNALS, first).drop("zone"), checkpoint, stype)
    earliest = starts.groupBy(_bucket(buckets).alias("bucket")).agg(F.min("restart_ts").alias("earliest"))
    return first, starts, _names(zones.join(earliest, "bucket").where(F.col("ts_max") >= F.col("earliest")))


def after_checkpoint_zoned(store: Store, checkpoint: DataFrame, stype: str, buckets: int = BUCKETS) -> DataFrame:
    """The rows of :func:`fuelsight.operators.incremental.after_checkpoint`, from the parts that can hold some."""
    _, starts, parts = resume_parts(store, checkpoint, stype, buckets)
    rows = store.read(SIGNALS, parts).drop("zone")
    return rows.join(starts, "vin").where(F.col("ts") >= F.col("restart_ts")).drop("restart_ts")
