"""Windowed stream detectors (T6, T7) with their batch twins, and the runner.

Windows follow event time (D24).  ``withWatermark`` needs a session-zone
timestamp, so streaming forms convert the wall-clock ``timestamp_ntz`` with
the session zone (UTC in our sessions) and convert window bounds back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..operators.etl import drop_future_readings, explode_envelopes
from ..sources.sinks import write_alerts
from .refuel import refuel_events_stream, refuel_payload, unusable_levels

# --- fixed values: the reference detector's window, slide and threshold ---
LOW_FUEL_WINDOW = "30 seconds"
LOW_FUEL_SLIDE = "10 seconds"
LOW_FUEL_THRESHOLD = 10.0
MICRO_BATCH = "5 seconds"
RATE_PER_PARTITION = 100


def rate_cap(partitions: int, per_second: int = RATE_PER_PARTITION, trigger_seconds: int = 5) -> int:
    """The reference's ingest cap (records per second per partition) as a
    per-trigger cap for ``maxOffsetsPerTrigger`` / ``read_stream(max_per_trigger=...)``."""
    return per_second * trigger_seconds * partitions


def low_fuel_windows(signals: DataFrame, window: str = LOW_FUEL_WINDOW, slide: str = LOW_FUEL_SLIDE,
                     threshold: float = LOW_FUEL_THRESHOLD, watermark: str | None = None) -> DataFrame:
    """Mean tank level per vehicle and sliding window, kept when below ``threshold``.

    The window aggregate is a hash aggregate keyed by (vehicle, window): a
    partial aggregate before the shuffle, and in streaming an incremental
    state per open window (the add/remove of the reference's inverse reduce).
    """
    lv = signals.where(F.col("stype") == S.FUEL_LEVEL)
    ts = F.col("ts")
    if watermark is not None:
        lv = lv.withColumn("_ets", F.col("ts").cast("timestamp")).withWatermark("_ets", watermark)
        ts = F.col("_ets")
    agg = lv.groupBy("vin", F.window(ts, window, slide).alias("w")).agg(F.avg("value").alias("avg_level"))
    return agg.where(F.col("avg_level") < threshold).select(
        "vin", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
        F.col("w.end").cast("timestamp_ntz").alias("window_end"), "avg_level")


def low_fuel_alerts(windows: DataFrame) -> DataFrame:
    """Alert rows ``msg_type, vin, msg_para`` plus the JSON ``payload``."""
    para = F.array(F.struct(F.lit("currentFuel").alias("type"), F.col("avg_level").alias("value")))
    out = windows.select(F.lit("lowFuel").alias("msg_type"), "vin", para.alias("msg_para"),
                         "window_start", "window_end")
    body = F.struct(F.col("msg_type").alias("msgType"), "vin", F.col("msg_para").alias("msgPara"))
    return out.withColumn("payload", F.to_json(body))


def fuel_summary(signals: DataFrame, step: str = MICRO_BATCH, watermark: str | None = None) -> DataFrame:
    """Per vehicle and step: mean level (over level rows only), last level
    (the latest reading that has one; ``max_by`` keeps it a hash aggregate), and
    ``is_drive`` = moving samples outnumber standing ones (D25)."""
    rows = signals.where(F.col("stype").isin(S.FUEL_LEVEL, S.SPEED))
    ts = F.col("ts")
    if watermark is not None:
        rows = rows.withColumn("_ets", F.col("ts").cast("timestamp")).withWatermark("_ets", watermark)
        ts = F.col("_ets")
    is_level = F.col("stype") == S.FUEL_LEVEL
    vote = F.when(F.col("stype") == S.SPEED, F.when(F.col("value") > 0, 1).otherwise(-1)).otherwise(0)
    agg = rows.groupBy("vin", F.window(ts, step).alias("w")).agg(
        F.avg(F.when(is_level, F.col("value"))).alias("mean_level"),
        F.max_by(F.col("value"), F.when(is_level & F.col("value").isNotNull(), F.col("ts"))).alias("last_level"),
        F.sum(vote).alias("_votes"),
    )
    return agg.select("vin", F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                      F.col("w.end").cast("timestamp_ntz").alias("window_end"), "mean_level",
                      "last_level", (F.col("_votes") > 0).alias("is_drive"))


def stream_signals(raw: DataFrame, stypes: list[str] | None = None) -> DataFrame:
    """T5: envelope stream -> readings (E1) -> drop readings newer than their upload (E2); ``stypes`` as in E1 (the detectors need tank levels only)."""
    return drop_future_readings(explode_envelopes(raw, stypes))


def late_readings(signals: DataFrame, delay: str) -> DataFrame:
    """Tank levels uploaded more than ``delay`` after they were read.

    A window is closed once the stream has seen readings that are ``delay`` newer, so these are
    the readings that a closed window may miss; the upload's send time tells.
    """
    late = F.col("send_ts") - F.expr(f"INTERVAL {delay}") > F.col("ts")
    return signals.where((F.col("stype") == S.FUEL_LEVEL) & late)


def run_detectors(signals_stream: DataFrame, out_dir: str, checkpoint_dir: str, watermark: str,
                  trigger: dict | None = None, low_fuel: dict | None = None,
                  refuel_step: str | None = MICRO_BATCH) -> list[StreamingQuery]:
    """Queries over one readings stream, each writing its
    rows per micro-batch (``foreachBatch``) to its own table folder: ``low_fuel``, ``refuel``,
    ``late`` (if the stream has send times) and ``unusable`` levels.

    ``watermark`` is how long the low-fuel windows wait for late readings.  It
    follows the newest reading of the whole fleet, so it has to cover the latest usual
    upload; what comes later than that still is in ``late`` (:func:`late_readings`).

    ``trigger`` defaults to the reference's 5-second micro-batch; tests pass
    ``{'availableNow': True}``.  Offsets and state live under
    ``checkpoint_dir`` (a shared folder), so a restarted query resumes.
    """
    trigger = trigger or {"processingTime": MICRO_BATCH}
    low_fuel = {**(low_fuel or {}), "watermark": watermark}

    def sink(name: str):
        # one folder per epoch, overwritten: a micro-batch replayed after a
        # failure replaces its own output instead of appending it twice
        def write(batch: DataFrame, epoch_id: int) -> None:
            batch.persist()
            if not batch.isEmpty():  # no folder for an epoch without rows
                write_alerts(batch, f"{out_dir}/{name}/epoch={epoch_id}", mode="overwrite")
            batch.unpersist()
        return write

    def start(df: DataFrame, name: str) -> StreamingQuery:
        return (df.writeStream.outputMode("append").foreachBatch(sink(name))
                .option("checkpointLocation", f"{checkpoint_dir}/{name}").trigger(**trigger).start())

    readings = signals_stream.drop("send_ts")
    queries = [
        start(low_fuel_alerts(low_fuel_windows(readings, **low_fuel)), "low_fuel"),
        start(refuel_payload(refuel_events_stream(readings, refuel_step)), "refuel"),
        start(unusable_levels(readings), "unusable"),
    ]
    if "send_ts" in signals_stream.columns:
        queries.append(start(late_readings(signals_stream, watermark), "late"))
    return queries
