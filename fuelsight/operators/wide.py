"""Long → wide reshaping of signals.

The reference regrouped whole JSON rows per (vehicle, second) without a
map-side combine.  Here one ``groupBy`` with conditional sums does it; the
partial aggregate runs before the shuffle, and because the key includes the
second, a hot vehicle spreads over all reducers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.predicates import of_type
from ..schemas import AIRCON, INJECTION, ODOMETER, RPM, SPEED

EPOCH_NTZ = "1970-01-01 00:00:00"


def epoch() -> Column:
    return F.lit(EPOCH_NTZ).cast("timestamp_ntz")


def micros_sql(ts: str = "ts") -> str:
    """SQL text of :func:`epoch_micros` for a column name."""
    return (f"(unix_date(to_date({ts})) * 86400000000L + hour({ts}) * 3600000000L"
            f" + minute({ts}) * 60000000L + CAST(date_part('SECOND', {ts}) * 1000000 AS BIGINT))")


def epoch_micros(ts: Column | str) -> Column:
    """Microseconds from 1970-01-01 00:00 to a wall-clock ``timestamp_ntz``.

    Built from the date and clock fields, so it never passes through the
    session time zone (a cast to ``timestamp`` would, and shift readings
    taken under daylight-saving time).  Given a column *name* the expression
    is sent as one SQL string (one round trip instead of a dozen).
    """
    if isinstance(ts, str):
        return F.expr(micros_sql(ts))
    return (F.unix_date(F.to_date(ts)).cast("bigint") * 86_400_000_000
            + F.hour(ts).cast("bigint") * 3_600_000_000
            + F.minute(ts).cast("bigint") * 60_000_000
            + (F.date_part(F.lit("SECOND"), ts) * 1_000_000).cast("bigint"))


def second_of(ts: str = "ts") -> Column:
    """Whole-second bucket as epoch seconds."""
    return F.expr(f"floor({micros_sql(ts)} / 1000000)")


def tenth_of(ts: str = "ts") -> Column:
    """100-ms bucket as a count of tenths of a second since the epoch."""
    return F.expr(f"floor({micros_sql(ts)} / 100000)")


def km_bucket(value: Column, step: int = 100) -> Column:
    """Start of the ``step``-km bucket of an odometer value."""
    return (F.floor(value / step) * step).cast("int")


def _sum_of(stype: str) -> Column:
    return F.expr(f"coalesce(sum(CASE WHEN stype = '{stype}' THEN value END), 0D)")


def _second_rows(signals: DataFrame, with_km: bool, keep_odo: bool) -> DataFrame:
    types = [SPEED, RPM, INJECTION, AIRCON] + ([ODOMETER] if with_km or keep_odo else [])
    sig = of_type(signals, *types)
    aggs = [
        _sum_of(SPEED).alias("speed"),
        _sum_of(RPM).alias("rpm"),
        _sum_of(INJECTION).alias("fuel"),
        F.expr(f"count(CASE WHEN stype = '{AIRCON}' AND value != 0 THEN 1 END)").alias("aircon_on_votes"),
    ]
    if with_km:
        aggs.append(F.expr(f"coalesce(CAST(floor(max(CASE WHEN stype = '{ODOMETER}' THEN value END) / 100)"
                           " * 100 AS INT), 0)").alias("km"))
    if keep_odo:
        aggs.append(F.expr(f"CAST(floor(max(CASE WHEN stype = '{ODOMETER}' THEN value END) / 100)"
                           " * 100 AS INT)").alias("_odo_km"))
        aggs.append(F.min("ts").alias("_sec_ts"))
    return sig.groupBy("vin", second_of("ts").alias("sec"), F.to_date("ts").alias("day")).agg(*aggs)


def to_second_rows(signals: DataFrame, with_km: bool = False, bucket: str = "same_second") -> DataFrame:
    """P5: one row per (vehicle, second) with the readings of that second.

    Columns: ``vin, sec, day, speed, rpm, fuel, aircon_on_votes`` and, with
    ``with_km``, ``km`` = the 100-km bucket of that second's odometer (0 when
    the second has no odometer reading).  ``bucket='asof'`` instead gives
    each second the bucket of the highest odometer seen up to and including
    it (skew-safe running max over the second rows; 0 before the first
    reading).  Missing readings count as 0.
    """
    if bucket == "same_second" or not with_km:
        return _second_rows(signals, with_km, keep_odo=False)
    if bucket != "asof":
        raise ValueError(f"unknown bucket {bucket!r}")
    from .asof import asof_running_max
    rows = _second_rows(signals, with_km=False, keep_odo=True)
    out = asof_running_max(rows, ["vin"], "_sec_ts", "_odo_km", "km")
    return out.withColumn("km", F.coalesce(F.col("km"), F.lit(0))).drop("_odo_km", "_sec_ts")
