"""Fuel-economy KPIs per day and per 100 km (A1-A10).

All of them are two-level grouped aggregates: the first level collapses
readings to one row per (vehicle, second) or (vehicle, 100 ms), the second to
(vehicle, day) / (vehicle, bucket).  Both levels get a partial aggregate
before their shuffle; nothing is gathered per vehicle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.predicates import in_range, is_driving, is_idle, of_type
from .asof import DEFAULT_CHUNK_SECONDS, asof_running_max
from .incremental import after_checkpoint, last_bucket
from .wide import _sum_of, km_bucket, micros_sql, second_of, tenth_of, to_second_rows

STATES = {"idle": is_idle, "driving": is_driving}
DAY_CODES = {"idle": S.D_IDLE_FUEL, "driving": S.D_DRIVING_FUEL}
KM_CODES = {"idle": S.KM_IDLE_FUEL, "driving": S.KM_DRIVING_FUEL}


def day_fact(df: DataFrame, code: str, value: Column | str = "data_value") -> DataFrame:
    value = F.col(value) if isinstance(value, str) else value
    return df.select("vin", F.col("day").alias("now_date"), F.lit(code).alias("data_key"),
                     value.cast("double").alias("data_value"))


def km_fact(df: DataFrame, code: str, value: Column | str = "data_value") -> DataFrame:
    value = F.col(value) if isinstance(value, str) else value
    return df.select("vin", F.col("km").cast("int").alias("mileage"), F.lit(code).alias("data_key"),
                     value.cast("double").alias("data_value"))


def fuel_by_day(wide: DataFrame, state: str) -> DataFrame:
    """A1 (``idle``, D002) / A3 (``driving``, D003): injection summed per day."""
    agg = wide.where(STATES[state]()).groupBy("vin", "day").agg(F.sum("fuel").alias("data_value"))
    return day_fact(agg, DAY_CODES[state])


def fuel_by_km(wide: DataFrame, state: str) -> DataFrame:
    """A2 (KM002) / A4 (KM003): injection summed per 100-km bucket of the same second."""
    agg = wide.where(STATES[state]()).groupBy("vin", "km").agg(F.sum("fuel").alias("data_value"))
    return km_fact(agg, KM_CODES[state])


def _aircon_filter(wide: DataFrame, state: str) -> DataFrame:
    if state == "on":
        return wide.where(F.col("aircon_on_votes") > 0)
    if state == "off":
        return wide.where(F.col("aircon_on_votes") == 0)
    if state == "all":
        return wide
    raise ValueError(f"unknown air-con state {state!r}")


def aircon_rate(signals: DataFrame) -> DataFrame:
    """Fleet air-conditioning consumption rate, one row.

    Per (vehicle, instant) the air-con samples vote +1 (on) / -1 (off); a tie
    or no sample counts as on (D30).  Each injection sample stands for 100 ms.
    Then ``rate = (fuel_on/h_on - fuel_off/h_off) * h_on / (fuel_on + fuel_off)``
    with hours from the durations (D5); null when a state is absent (D6).
    """
    sig = of_type(signals, S.INJECTION, S.AIRCON)
    inj = f"stype = '{S.INJECTION}'"
    per_instant = sig.groupBy("vin", "ts").agg(
        F.expr(f"sum(CASE WHEN stype = '{S.AIRCON}' THEN (CASE WHEN value = 0 THEN -1 ELSE 1 END) ELSE 0 END)")
        .alias("votes"),
        F.expr(f"coalesce(sum(CASE WHEN {inj} THEN value END), 0D)").alias("fuel"),
        F.expr(f"count(CASE WHEN {inj} THEN 1 END) * 100").alias("dur_ms"),
    )
    totals = per_instant.agg(
        F.expr("sum(CASE WHEN votes >= 0 THEN dur_ms END)").alias("on_ms"),
        F.expr("sum(CASE WHEN votes < 0 THEN dur_ms END)").alias("off_ms"),
        F.expr("sum(CASE WHEN votes >= 0 THEN fuel END)").alias("on_fuel"),
        F.expr("sum(CASE WHEN votes < 0 THEN fuel END)").alias("off_fuel"),
    )
    rate = F.expr("try_divide((try_divide(on_fuel, on_ms / 3600000D) - try_divide(off_fuel, off_ms / 3600000D))"
                  " * (on_ms / 3600000D), on_fuel + off_fuel)")
    return totals.select("on_ms", "off_ms", "on_fuel", "off_fuel", rate.alias("rate"))


def aircon_by_day(wide: DataFrame, rate: DataFrame | Column | float | None = None,
                  state: str = "on") -> DataFrame:
    """A5 (D004): injection of air-con seconds per day, times the A7 rate.

    ``rate`` may be the one-row frame of :func:`aircon_rate` (used as a scalar
    subquery, evaluated once), a column, a number, or ``None`` for no factor.
    A second is "on" when any air-con sample in it is non-zero (D7).
    """
    agg = _aircon_filter(wide, state).groupBy("vin", "day").agg(F.sum("fuel").alias("fuel"))
    if rate is None:
        factor = F.lit(1.0)
    elif isinstance(rate, DataFrame):
        factor = rate.select("rate").scalar()
    elif isinstance(rate, Column):
        factor = rate
    else:
        factor = F.lit(float(rate))
    return day_fact(agg, S.D_AIRCON_FUEL, F.col("fuel") * factor)


def aircon_by_km(wide: DataFrame, state: str = "on") -> DataFrame:
    """A6 (KM004): injection of air-con seconds per 100-km bucket (no rate)."""
    agg = _aircon_filter(wide, state).groupBy("vin", "km").agg(F.sum("fuel").alias("data_value"))
    return km_fact(agg, S.KM_AIRCON_FUEL)


def total_fuel_by_day(signals: DataFrame, start=None, end=None) -> DataFrame:
    """A8 (D001): one injection value per 100-ms bucket (the largest, D8), summed per day."""
    inj = in_range(of_type(signals, S.INJECTION), start, end)
    per_tenth = inj.groupBy("vin", tenth_of("ts").alias("tenth"), F.to_date("ts").alias("day")) \
        .agg(F.max("value").alias("v"))
    agg = per_tenth.groupBy("vin", "day").agg(F.sum("v").alias("data_value"))
    return day_fact(agg, S.D_TOTAL_FUEL)


def mileage_by_day(signals: DataFrame, start=None, end=None) -> DataFrame:
    """A10 (D006): odometer max - min per vehicle and calendar day."""
    odo = in_range(of_type(signals, S.ODOMETER), start, end)
    agg = odo.groupBy("vin", F.to_date("ts").alias("day")).agg(
        (F.max("value") - F.min("value")).alias("data_value"))
    return day_fact(agg, S.D_MILEAGE)


def asof_km(signals: DataFrame, chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
            newest: str | None = None) -> DataFrame:
    """Give every reading the 100-km bucket of the highest odometer seen so far.

    Readings before a vehicle's first odometer sample get a null bucket.
    ``newest`` names a column holding the vehicle's highest bucket overall.
    """
    odo_bucket = F.when(F.col("stype") == S.ODOMETER, km_bucket(F.col("value")))
    d = signals.withColumn("_odo_km", odo_bucket)
    return asof_running_max(d, ["vin"], "ts", "_odo_km", "km", chunk_seconds, newest).drop("_odo_km")


def total_fuel_by_km(signals: DataFrame, checkpoint: DataFrame | None = None,
                     complete_only: bool = True,
                     chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """A9 (KM001): ``sum(injection * 100)`` per vehicle and as-of 100-km bucket.

    With a ``checkpoint`` (M11) only readings from the restart point on are
    used (I1).  ``complete_only`` drops each vehicle's newest, still open
    bucket, so re-running after advancing the checkpoint adds nothing twice
    (D32); ``False`` gives the literal behaviour.
    """
    sig = of_type(signals, S.INJECTION, S.ODOMETER)
    if checkpoint is not None:
        sig = after_checkpoint(sig, checkpoint, S.INJECTION)
    tagged = asof_km(sig, chunk_seconds, newest="newest_km")
    fuel = tagged.where((F.col("stype") == S.INJECTION) & F.col("km").isNotNull())
    if complete_only:
        fuel = fuel.where(F.col("km") < F.col("newest_km"))
    agg = fuel.groupBy("vin", "km").agg(F.sum(F.col("value") * 100).alias("data_value"))
    return km_fact(agg, S.KM_TOTAL_FUEL)


def _rate_factor(signals: DataFrame, rate) -> Column:
    if rate is None:
        return aircon_rate(signals).select("rate").scalar()
    if isinstance(rate, DataFrame):
        return rate.select("rate").scalar()
    if isinstance(rate, Column):
        return rate
    return F.lit(float(rate))


def daily_kpis(signals: DataFrame, rate: DataFrame | Column | float | None = None,
               start=None, end=None) -> DataFrame:
    """D001-D004 and D006 of every vehicle-day from ONE pass over the readings.

    Level 1 groups by (vehicle, second) and carries everything the daily
    KPIs need: the state sums of the second (idle/driving/air-con), the
    odometer extremes, and the 100-ms de-duplicated injection of D001 — the
    largest value of each tenth of the second, kept as ten conditional
    maxima (one per tenth digit) and added up.  Level 2 groups by
    (vehicle, day); presence counts decide which KPI rows a day gets, exactly
    as the separate operators would emit them.  Both levels have a partial
    aggregate, so the signal table is scanned and shuffled once (the air-con
    rate, a fleet-wide scalar over the same range, is one more pass unless
    given).
    """
    types = [S.SPEED, S.RPM, S.INJECTION, S.AIRCON, S.ODOMETER]
    sig = in_range(of_type(signals, *types), start, end)
    inj, odo = f"stype = '{S.INJECTION}'", f"stype = '{S.ODOMETER}'"
    digit = f"(floor({micros_sql('ts')} / 100000) % 10)"
    tenth_max = " + ".join(
        f"coalesce(max(CASE WHEN {inj} AND {digit} = {d} THEN value END), 0D)" for d in range(10))
    per_sec = sig.groupBy("vin", second_of("ts").alias("sec"), F.to_date("ts").alias("day")).agg(
        _sum_of(S.SPEED).alias("speed"),
        _sum_of(S.RPM).alias("rpm"),
        _sum_of(S.INJECTION).alias("fuel"),
        F.expr(f"count(CASE WHEN stype = '{S.AIRCON}' AND value != 0 THEN 1 END)").alias("ac_votes"),
        F.expr(f"count(CASE WHEN {inj} THEN 1 END)").alias("n_inj"),
        F.expr(f"count(CASE WHEN {inj} THEN value END)").alias("n_value"),
        F.expr(f"count(CASE WHEN {odo} THEN 1 END)").alias("n_odo"),
        F.expr(tenth_max).alias("dedup_fuel"),
        F.expr(f"max(CASE WHEN {odo} THEN value END)").alias("odo_max"),
        F.expr(f"min(CASE WHEN {odo} THEN value END)").alias("odo_min"),
    )
    idle, driving, ac_on = "speed = 0 AND rpm > 0", "speed > 0 AND rpm > 0", "ac_votes > 0"
    per_day = per_sec.groupBy("vin", "day").agg(
        F.sum("n_inj").alias("n_inj"),
        F.sum("n_odo").alias("n_odo"),
        F.expr("CASE WHEN sum(n_value) > 0 THEN sum(dedup_fuel) END").alias("total"),  # null like the separate form
        F.expr(f"count(CASE WHEN {idle} THEN 1 END)").alias("n_idle"),
        F.expr(f"sum(CASE WHEN {idle} THEN fuel END)").alias("idle"),
        F.expr(f"count(CASE WHEN {driving} THEN 1 END)").alias("n_driving"),
        F.expr(f"sum(CASE WHEN {driving} THEN fuel END)").alias("driving"),
        F.expr(f"count(CASE WHEN {ac_on} THEN 1 END)").alias("n_ac"),
        F.expr(f"sum(CASE WHEN {ac_on} THEN fuel END)").alias("aircon"),
        F.expr("max(odo_max) - min(odo_min)").alias("mileage"),
    )
    factor = _rate_factor(in_range(signals, start, end), rate)

    def fact(code: str, value: Column, present: Column) -> Column:
        return F.struct(F.lit(code).alias("k"), value.cast("double").alias("v"), present.alias("p"))

    facts = F.array(
        fact(S.D_TOTAL_FUEL, F.col("total"), F.col("n_inj") > 0),
        fact(S.D_IDLE_FUEL, F.col("idle"), F.col("n_idle") > 0),
        fact(S.D_DRIVING_FUEL, F.col("driving"), F.col("n_driving") > 0),
        fact(S.D_AIRCON_FUEL, F.col("aircon") * factor, F.col("n_ac") > 0),
        fact(S.D_MILEAGE, F.col("mileage"), F.col("n_odo") > 0),
    )
    return (per_day.select("vin", F.col("day").alias("now_date"), F.inline(facts))
            .where(F.col("p"))
            .select("vin", "now_date", F.col("k").alias("data_key"), F.col("v").cast("double").alias("data_value")))


def daily_kpis_separate(signals: DataFrame, rate: DataFrame | None = None) -> DataFrame:
    """The same fact table as :func:`daily_kpis`, one operator per KPI (for tests)."""
    wide = to_second_rows(signals)
    parts = [
        total_fuel_by_day(signals),
        fuel_by_day(wide, "idle"),
        fuel_by_day(wide, "driving"),
        aircon_by_day(wide, rate if rate is not None else aircon_rate(signals)),
        mileage_by_day(signals),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def resumed_km_kpis(signals: DataFrame, checkpoint: DataFrame, chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
                    starts: DataFrame | None = None) -> DataFrame:
    """KM001-KM004 of the buckets that are new and complete.

    All four codes use readings from the restart time on and the as-of bucket, and leave
    out each vehicle's newest, still open bucket, so a run after the checkpoint
    has advanced adds none of them twice.  The readings from the restart times (``starts``, see
    :func:`after_checkpoint`) on are joined once for each of their five uses.
    """
    types = [S.SPEED, S.RPM, S.INJECTION, S.AIRCON, S.ODOMETER]
    sig = after_checkpoint(of_type(signals, *types), checkpoint, S.INJECTION, starts)
    newest = (of_type(sig, S.ODOMETER).groupBy("vin")
              .agg((F.floor(F.max("value") / 100) * 100).cast("int").alias("_newest")))
    done = last_bucket(checkpoint, S.INJECTION).select("vin", F.col("km").alias("_done"))
    rows = km_kpis(sig, None, bucket="asof").join(newest, "vin").join(done, "vin", "left")
    return (rows.where((F.col("mileage") < F.col("_newest")) & (F.col("mileage") >= F.coalesce("_done", F.lit(0))))
            .drop("_newest", "_done"))


def km_kpis(signals: DataFrame, checkpoint: DataFrame | None = None, bucket: str = "same_second") -> DataFrame:
    """KM001-KM004 in one long fact table.

    KM001 is the as-of total (:func:`total_fuel_by_km`); KM002-KM004 come
    from ONE aggregate over the second rows per (vehicle, bucket), with
    presence counts deciding which rows exist — the same rows the three
    separate operators emit.
    """
    wide = to_second_rows(signals, with_km=True, bucket=bucket)
    idle, driving, ac_on = is_idle(), is_driving(), F.col("aircon_on_votes") > 0
    per_km = wide.groupBy("vin", "km").agg(
        F.count(F.when(idle, 1)).alias("n_idle"), F.sum(F.when(idle, F.col("fuel"))).alias("idle"),
        F.count(F.when(driving, 1)).alias("n_driving"), F.sum(F.when(driving, F.col("fuel"))).alias("driving"),
        F.count(F.when(ac_on, 1)).alias("n_ac"), F.sum(F.when(ac_on, F.col("fuel"))).alias("aircon"),
    )

    def fact(code: str, value: str, count: str) -> Column:
        return F.struct(F.lit(code).alias("k"), F.col(value).cast("double").alias("v"),
                        (F.col(count) > 0).alias("p"))

    facts = F.array(fact(S.KM_IDLE_FUEL, "idle", "n_idle"), fact(S.KM_DRIVING_FUEL, "driving", "n_driving"),
                    fact(S.KM_AIRCON_FUEL, "aircon", "n_ac"))
    parts = (per_km.select("vin", F.col("km").cast("int").alias("mileage"), F.inline(facts))
             .where(F.col("p"))
             .select("vin", "mileage", F.col("k").alias("data_key"), F.col("v").alias("data_value")))
    return total_fuel_by_km(signals, checkpoint).unionByName(parts)
