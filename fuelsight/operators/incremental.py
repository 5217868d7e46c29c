"""Resume helpers (I1-I3): continue where the previous run stopped."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S


def last_bucket(checkpoint: DataFrame, stype: str) -> DataFrame:
    """Per vehicle the next 100-km bucket to compute for ``stype``.

    ``per100`` is a bucket index: buckets ``0 .. per100-1`` are done (M11).
    ``km`` is the same node in kilometres.
    """
    return (checkpoint.where(F.col("stype") == stype)
            .groupBy("vin").agg(F.max("per100").alias("per100"))
            .select("vin", F.lit(stype).alias("stype"), "per100",
                    (F.col("per100") * 100).cast("int").alias("km")))


def restart_times(signals: DataFrame, checkpoint: DataFrame, stype: str) -> DataFrame:
    """Per vehicle, the first instant its odometer reached an unfinished bucket.

    A19 (first reach of each bucket) + J4 (left join to the checkpoint, a
    vehicle without a mark starts at bucket 0, D10) + A19 again (earliest).
    """
    odo = signals.where(F.col("stype") == S.ODOMETER)
    reach = odo.groupBy("vin", F.floor(F.col("value") / 100).alias("bucket")) \
        .agg(F.min("ts").alias("reach_ts"))
    done = last_bucket(checkpoint, stype).select("vin", "per100")
    return (reach.join(done, "vin", "left")
            .where(F.col("bucket") >= F.coalesce(F.col("per100"), F.lit(0)))
            .groupBy("vin").agg(F.min("reach_ts").alias("restart_ts")))


def after_checkpoint(signals: DataFrame, checkpoint: DataFrame, stype: str, starts: DataFrame | None = None) -> DataFrame:
    """Readings at or after each vehicle's restart time.

    The restart table has one row per vehicle; no static broadcast hint is
    given — AQE turns the join into a broadcast only when the measured size of
    that side is under the adaptive threshold, and splits a hot vehicle's
    partition (skew join) otherwise.  ``starts``: the restart times, where they have been
    written already; their size is known then, and small ones need no shuffle of the readings.
    """
    starts = restart_times(signals, checkpoint, stype) if starts is None else starts
    return (signals.join(starts, "vin", "inner")
            .where(F.col("ts") >= F.col("restart_ts"))
            .drop("restart_ts"))
