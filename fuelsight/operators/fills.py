"""Refuelling intervals and the KPIs computed per interval."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.predicates import of_type
from .asof import DEFAULT_CHUNK_SECONDS, asof_running_max, next_time
from .ranking import rank_within

INTERVAL_KEYS = ["vin", "gas_id", "fill_grade", "start_ts", "price"]


def new_fills(fills: DataFrame, marks: DataFrame) -> DataFrame:
    """J1 + F6: fills newer than the vehicle's last processed mark (or all, without one).

    The marks are reduced to one row per vehicle first (A18); AQE decides at
    run time whether that side is small enough to broadcast.
    """
    last = marks.groupBy("vin").agg(F.max("fill_ts").alias("_mark"))
    floor = F.lit(S.NO_MARK_FLOOR).cast("timestamp_ntz")
    return (fills.join(last, "vin", "left")
            .where(F.col("fill_start_time") > F.coalesce(F.col("_mark"), floor))
            .drop("_mark"))


def fill_intervals(fills: DataFrame, chunk_seconds: int = 86_400) -> DataFrame:
    """Each fill paired with the next one of the same vehicle.

    Order is (start, station id) so two fills at one instant are paired
    deterministically (D13); the last fill has no end and is dropped (F9).
    The pairing is a chunked ``lead`` (:func:`next_time`), so even a vehicle
    holding a large share of all fills is spread over day-sized tasks.
    """
    base = fills.select("vin", "gas_id", "fill_grade", "price", F.col("fill_start_time").alias("start_ts"))
    return (next_time(base, ["vin"], "start_ts", "gas_id", "end_ts", chunk_seconds)
            .where(F.col("end_ts").isNotNull()))


def fuel_prices(fills: DataFrame) -> DataFrame:
    """Price of every fill (D18: one snake_case schema)."""
    return fills.select("vin", "gas_id", "fill_start_time", "fill_grade", "price")


def _assign_range(signals: DataFrame, intervals: DataFrame) -> DataFrame:
    """Interval join bucketed by day: equi-join on (vin, day) plus the range test.

    Each interval is repeated once per calendar day it touches, so one
    (vehicle, day) key meets only the few intervals of that day, never all of
    the vehicle's; a hot (vehicle, day) is split by AQE's skew join.
    """
    days = intervals.withColumn(
        "_day", F.explode(F.sequence(F.to_date("start_ts"), F.to_date("end_ts"))))
    sig = signals.withColumn("_day", F.to_date("ts"))
    return (sig.join(days, ["vin", "_day"], "inner")
            .where((F.col("ts") >= F.col("start_ts")) & (F.col("ts") < F.col("end_ts")))
            .drop("_day", "end_ts"))


def _assign_asof(signals: DataFrame, intervals: DataFrame, chunk_seconds: int) -> DataFrame:
    """As-of plan: union readings with interval starts, carry the latest start forward.

    The running max of ``struct(start, gas_id, ...)`` picks the latest fill at
    or before each reading (ties: larger station id, D13).  A reading at or
    past that interval's end (the final fill, which opens no interval) and a
    reading before the first fill (no marker yet) are dropped.
    """
    marker = F.struct("start_ts", "gas_id", "fill_grade", "price", "end_ts")
    iv = intervals.select("vin", F.col("start_ts").alias("ts"), F.lit(None).cast("string").alias("stype"),
                          F.lit(None).cast("double").alias("value"), marker.alias("_iv"), F.lit(True).alias("_is_iv"))
    sig = signals.select("vin", "ts", "stype", "value", F.lit(None).cast(iv.schema["_iv"].dataType).alias("_iv"),
                         F.lit(False).alias("_is_iv"))
    tagged = asof_running_max(sig.unionByName(iv), ["vin"], "ts", "_iv", "_cur", chunk_seconds)
    return (tagged.where(~F.col("_is_iv") & F.col("_cur.end_ts").isNotNull()
                         & (F.col("ts") < F.col("_cur.end_ts")))
            .select("vin", "ts", "stype", "value",
                    F.col("_cur.gas_id").alias("gas_id"), F.col("_cur.fill_grade").alias("fill_grade"),
                    F.col("_cur.start_ts").alias("start_ts"), F.col("_cur.price").alias("price")))


def assign_fill_interval(signals: DataFrame, intervals: DataFrame, strategy: str = "range",
                         chunk_seconds: int = DEFAULT_CHUNK_SECONDS) -> DataFrame:
    """Tag each reading with the fill interval ``[start, end)`` containing it.

    Output: ``vin, ts, stype, value, gas_id, fill_grade, start_ts, price``.
    ``strategy='range'`` is the day-bucketed interval join; ``'asof'`` the
    union + running-max plan.  Both give the same rows.
    """
    cols = ["vin", "ts", "stype", "value"]
    if strategy == "range":
        out = _assign_range(signals.select(*cols), intervals)
        return out.select(*cols, "gas_id", "fill_grade", "start_ts", "price")
    if strategy == "asof":
        return _assign_asof(signals.select(*cols), intervals, chunk_seconds)
    raise ValueError(f"unknown strategy {strategy!r}")


def interval_readings(signals: DataFrame, fills: DataFrame, marks: DataFrame | None,
                      stypes: list[str], strategy: str = "range") -> DataFrame:
    """I3 + J3: readings of ``stypes`` inside intervals between unprocessed fills."""
    fresh = new_fills(fills, marks) if marks is not None else fills
    intervals = fill_intervals(fresh)
    return assign_fill_interval(of_type(within_days(signals, fresh), *stypes), intervals, strategy)


def within_days(signals: DataFrame, fresh: DataFrame) -> DataFrame:
    """Date-partitioned signals from the first to the last of some fills only.

    A few open intervals then read a few folders, not all history: the bounds are scalar
    subqueries on the partition columns.  Signals without date folders are returned as they are.
    """
    if not {"year", "month", "day"} <= set(signals.columns):
        return signals
    day = F.make_date("year", "month", "day")
    first = fresh.agg(F.to_date(F.min("fill_start_time")).alias("d")).scalar()
    last = fresh.agg(F.to_date(F.max("fill_start_time")).alias("d")).scalar()
    return signals.where((day >= first) & (day <= last))


def fill_fact(df: DataFrame, code: str, value) -> DataFrame:
    return df.select("vin", "gas_id", "fill_grade", F.col("start_ts").alias("fill_date"),
                     F.lit(code).alias("data_key"), value.cast("double").alias("data_value"))


def cost_per_km(signals: DataFrame, fills: DataFrame, marks: DataFrame | None = None,
                strategy: str = "range") -> DataFrame:
    """A15 (FF003): ``sum(injection*100) / (max - min odometer) * price`` per interval.

    One grouped aggregate with conditional parts replaces the three-way join
    (J6); an interval needs both injection and odometer readings.  Zero
    distance gives a null cost.
    """
    rows = interval_readings(signals, fills, marks, [S.INJECTION, S.ODOMETER], strategy)
    inj = F.col("stype") == S.INJECTION
    odo = F.col("stype") == S.ODOMETER
    agg = rows.groupBy(*INTERVAL_KEYS).agg(
        F.sum(F.when(inj, F.col("value") * 100)).alias("fuel"),
        (F.max(F.when(odo, F.col("value"))) - F.min(F.when(odo, F.col("value")))).alias("km"),
    ).where(F.col("fuel").isNotNull() & F.col("km").isNotNull())
    return fill_fact(agg, S.FF_ECONOMY, F.try_divide(F.col("fuel"), F.col("km")) * F.col("price"))


def average_speed(signals: DataFrame, fills: DataFrame, marks: DataFrame | None = None,
                  sample_ms: int = 10, strategy: str = "range") -> DataFrame:
    """A16 (FF001): distance / engine-on hours per interval.

    Engine-on time = running rotation samples x ``sample_ms``.  One grouped
    aggregate replaces the two-way join (J7).
    """
    rows = interval_readings(signals, fills, marks, [S.ODOMETER, S.RPM], strategy)
    odo = F.col("stype") == S.ODOMETER
    running = (F.col("stype") == S.RPM) & (F.col("value") > 0)
    agg = rows.groupBy(*INTERVAL_KEYS).agg(
        (F.max(F.when(odo, F.col("value"))) - F.min(F.when(odo, F.col("value")))).alias("km"),
        F.count(F.when(running, 1)).alias("n_on"),
    ).where(F.col("km").isNotNull() & (F.col("n_on") > 0))
    hours = F.col("n_on") * sample_ms / F.lit(3_600_000.0)
    return fill_fact(agg, S.FF_AVG_SPEED, F.try_divide(F.col("km"), hours))


def fuel_heating(signals: DataFrame, fills: DataFrame, marks: DataFrame | None = None,
                 strategy: str = "range") -> DataFrame:
    """A17 (FF002): mean of ``1/value`` of the fuel-supply factor per interval (D31: 1/0 skipped)."""
    rows = interval_readings(signals, fills, marks, [S.FUEL_SUPPLY], strategy)
    agg = rows.groupBy(*INTERVAL_KEYS).agg(F.avg(F.try_divide(F.lit(1.0), F.col("value"))).alias("v"))
    return fill_fact(agg, S.FF_HEATING_VALUE, F.col("v"))


def fill_kpis(signals: DataFrame, fills: DataFrame, marks: DataFrame | None = None,
              sample_ms: int = 10, strategy: str = "range") -> DataFrame:
    """FF001-FF003 from ONE interval join and ONE grouped aggregate.

    The same rows as :func:`average_speed`, :func:`fuel_heating` and
    :func:`cost_per_km` together, but the readings are joined to their
    intervals once instead of three times; presence flags decide which
    KPI rows an interval gets.
    """
    rows = interval_readings(signals, fills, marks, [S.INJECTION, S.ODOMETER, S.RPM, S.FUEL_SUPPLY], strategy)
    inj, odo, sup = f"stype = '{S.INJECTION}'", f"stype = '{S.ODOMETER}'", f"stype = '{S.FUEL_SUPPLY}'"
    agg = rows.groupBy(*INTERVAL_KEYS).agg(
        F.expr(f"sum(CASE WHEN {inj} THEN value * 100 END)").alias("fuel"),
        F.expr(f"max(CASE WHEN {odo} THEN value END) - min(CASE WHEN {odo} THEN value END)").alias("km"),
        F.expr(f"count(CASE WHEN stype = '{S.RPM}' AND value > 0 THEN 1 END)").alias("n_on"),
        F.expr(f"count(CASE WHEN {sup} THEN 1 END)").alias("n_sup"),
        F.expr(f"avg(CASE WHEN {sup} THEN try_divide(1D, value) END)").alias("heat"),
    )
    speed = F.try_divide(F.col("km"), F.col("n_on") * sample_ms / F.lit(3_600_000.0))
    cost = F.try_divide(F.col("fuel"), F.col("km")) * F.col("price")

    def fact(code: str, value, present) -> object:
        return F.struct(F.lit(code).alias("k"), value.cast("double").alias("v"), present.alias("p"))

    facts = F.array(
        fact(S.FF_AVG_SPEED, speed, F.col("km").isNotNull() & (F.col("n_on") > 0)),
        fact(S.FF_HEATING_VALUE, F.col("heat"), F.col("n_sup") > 0),
        fact(S.FF_ECONOMY, cost, F.col("fuel").isNotNull() & F.col("km").isNotNull()),
    )
    return (agg.select("vin", "gas_id", "fill_grade", F.col("start_ts").alias("fill_date"), F.inline(facts))
            .where(F.col("p"))
            .select("vin", "gas_id", "fill_grade", "fill_date", F.col("k").alias("data_key"),
                    F.col("v").alias("data_value")))


def economy_ranking(cost: DataFrame) -> DataFrame:
    """Rank intervals by cost per km within each fuel grade (1 = cheapest).

    Intervals without a cost are left out (D16).  The rank is computed by a
    range-partitioned distributed rank, not a window over the whole grade.
    """
    valid = cost.where(F.col("data_value").isNotNull()).select(
        "vin", "gas_id", "fill_grade", "fill_date", F.col("data_value").alias("cost_per_km"))
    return rank_within(valid, "fill_grade", "cost_per_km", "rank")
