"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads the scale factor's ``events`` table through the fixture
views (whole tables, no sampling; derived tables written once per session
to the shared folder, as an ETL would) and runs one operator or job of the
library on it.  The DuckDB twins live in :mod:`.oracle`.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import fixtures as FX
from .. import schemas as S
from ..functions.predicates import in_range
from ..functions.timefmt import date_of_parts, date_string, epoch_millis, parse_ts, register_functions
from ..operators import algebra, fills, incremental, kpi, zones
from ..operators.etl import drop_future_readings, explode_envelopes
from ..operators.wide import epoch, epoch_micros, to_second_rows
from ..session import scratch_path, stateful_conf
from ..sources.commits import Store
from ..sources.discovery import discover, field_types, read_lines
from ..sources.log import append_log, drain, ends, read_log
from ..sources.ranges import read_runs, write_run
from ..sources.readers import parse_signals, read_range, read_signals, read_sql
from ..sources.sinks import JSON_TS_OPTIONS, etl_job, to_json_lines, write_by_date, write_kpi
from ..streaming.detectors import fuel_summary, low_fuel_alerts, low_fuel_windows, run_detectors, stream_signals
from ..streaming.refuel import refuel_events_stream
from ..streaming.replay import refuel_events
from ..streaming.timed import low_fuel_panes, low_fuel_panes_stream, refuel_events_timed, run_detectors_once
from . import commit_jobs
from .jobs import fill_job, km_job

Query = Callable[[SparkSession, str], DataFrame]


class Dense(str):
    """A scale factor's folder whose queries run on the dense signal table instead."""


class _OnDense(Mapping):
    """Fixtures with the dense signal table as the signals."""

    def __init__(self, fx: Mapping[str, DataFrame]):
        self._fx = fx

    def __getitem__(self, name: str) -> DataFrame:
        return self._fx[f"dense_{name}" if name.startswith("signals") else name]

    def __iter__(self):
        return iter(self._fx)

    def __len__(self) -> int:
        return len(self._fx)


def _fx(spark: SparkSession, sf_dir: str) -> Mapping[str, DataFrame]:
    fx = FX.load(spark, str(sf_dir))
    return _OnDense(fx) if isinstance(sf_dir, Dense) else fx


def _signals(spark, sf_dir):
    return _fx(spark, sf_dir)["signals"]


def q_signals(spark, sf_dir):
    return _signals(spark, sf_dir)


def q_fill_records(spark, sf_dir):
    return _fx(spark, sf_dir)["fills"]


def q_processed_fills(spark, sf_dir):
    return _fx(spark, sf_dir)["processed_fills"]


def q_km_checkpoint(spark, sf_dir):
    return _fx(spark, sf_dir)["km_checkpoint"]


def _day(state):
    return lambda spark, sf_dir: kpi.fuel_by_day(to_second_rows(_signals(spark, sf_dir)), state)


def _km(state):
    return lambda spark, sf_dir: kpi.fuel_by_km(to_second_rows(_signals(spark, sf_dir), with_km=True), state)


def q_driving_km_asof(spark, sf_dir):
    return kpi.fuel_by_km(to_second_rows(_signals(spark, sf_dir), with_km=True, bucket="asof"), "driving")


def q_aircon_rate(spark, sf_dir):
    return kpi.aircon_rate(_signals(spark, sf_dir))


def q_aircon_day(spark, sf_dir):
    sig = _signals(spark, sf_dir)
    return kpi.aircon_by_day(to_second_rows(sig), kpi.aircon_rate(sig))


def q_aircon_km(spark, sf_dir):
    return kpi.aircon_by_km(to_second_rows(_signals(spark, sf_dir), with_km=True))


def q_total_day(spark, sf_dir):
    return kpi.total_fuel_by_day(_signals(spark, sf_dir))


def q_mileage_day(spark, sf_dir):
    return kpi.mileage_by_day(_signals(spark, sf_dir))


def q_total_km(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return kpi.total_fuel_by_km(fx["signals"], fx["km_checkpoint"])


def q_total_km_full(spark, sf_dir):
    return kpi.total_fuel_by_km(_signals(spark, sf_dir))


def q_daily_kpis(spark, sf_dir):
    return kpi.daily_kpis(_signals(spark, sf_dir))


def q_km_kpis(spark, sf_dir):
    return kpi.km_kpis(_signals(spark, sf_dir))


def q_other_day(spark, sf_dir):
    return algebra.other_fuel(kpi.daily_kpis(_signals(spark, sf_dir)), "day")


def q_other_km(spark, sf_dir):
    return algebra.other_fuel(kpi.km_kpis(_signals(spark, sf_dir)), "km")


def q_lifetime(spark, sf_dir):
    return algebra.lifetime_totals(kpi.daily_kpis(_signals(spark, sf_dir)))


def q_avg_100km(spark, sf_dir):
    return algebra.avg_fuel_per_100km(kpi.total_fuel_by_km(_signals(spark, sf_dir)))


def q_after_checkpoint(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return incremental.after_checkpoint(fx["signals"], fx["km_checkpoint"], S.INJECTION)


def q_last_bucket(spark, sf_dir):
    return incremental.last_bucket(_fx(spark, sf_dir)["km_checkpoint"], S.INJECTION)


def q_new_fills(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return fills.new_fills(fx["fills"], fx["processed_fills"])


def q_fill_intervals(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return fills.fill_intervals(fills.new_fills(fx["fills"], fx["processed_fills"]))


def q_fuel_prices(spark, sf_dir):
    return fills.fuel_prices(_fx(spark, sf_dir)["fills"])


def _assign(strategy):
    def q(spark, sf_dir):
        fx = _fx(spark, sf_dir)
        return fills.interval_readings(fx["signals_by_day"], fx["fills"], fx["processed_fills"],
                                       [S.INJECTION], strategy)
    return q


def _per_fill(fn):
    def q(spark, sf_dir):
        fx = _fx(spark, sf_dir)
        return fn(fx["signals_by_day"], fx["fills"], fx["processed_fills"])
    return q


def q_ranking(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    return fills.economy_ranking(fills.cost_per_km(fx["signals"], fx["fills"], fx["processed_fills"]))


def q_low_fuel(spark, sf_dir):
    return low_fuel_windows(_signals(spark, sf_dir), "6 hours", "2 hours", 20.0)


def q_fuel_summary(spark, sf_dir):
    return fuel_summary(_signals(spark, sf_dir), "1 day")


def q_refuel(spark, sf_dir):
    return refuel_events(_signals(spark, sf_dir), step=None)


def q_refuel_steps(spark, sf_dir):
    return refuel_events(_signals(spark, sf_dir), step="5 seconds")


def _envelope_readings(spark, sf_dir):
    return explode_envelopes(_fx(spark, sf_dir)["envelopes"])


def q_explode(spark, sf_dir):
    return _envelope_readings(spark, sf_dir)


def q_drop_future(spark, sf_dir):
    return drop_future_readings(_envelope_readings(spark, sf_dir))


def q_date_functions(spark, sf_dir):
    ev = FX.read_table(spark, sf_dir, "events")
    ts = F.col("ts")
    return ev.select(
        "event_id", F.year(ts).alias("year"), F.month(ts).alias("month"), F.dayofmonth(ts).alias("day"),
        date_string(ts).alias("date_string"), epoch_millis(ts).alias("epoch_ms"),
        date_of_parts(F.year(ts), F.month(ts), F.dayofmonth(ts)).alias("date_of_parts"),
        parse_ts(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS")).alias("parsed_iso"),
        parse_ts(F.date_format(ts, "yyyyMMddHHmmssSSS")).alias("parsed_compact"),
    )


def q_sql_functions(spark, sf_dir):
    register_functions(spark)
    FX.read_table(spark, sf_dir, "events").createOrReplaceTempView("fs_events")
    return spark.sql("""
        SELECT event_id, fs_year(ts) AS y, fs_month(ts) AS m, fs_day(ts) AS d,
               fs_date_string(ts) AS date_string,
               fs_date_of_parts(fs_year(ts), fs_month(ts), fs_day(ts)) AS rebuilt,
               fs_parse_ts(date_format(ts, 'yyyy-MM-dd HH:mm:ss')) AS parsed
        FROM fs_events""")


def q_read_range(spark, sf_dir):
    ev = FX.read_table(spark, sf_dir, "events")
    hours = F.floor(epoch_micros("ts") / 3_600_000_000)
    table = ev.select(FX.vin_of(F.col("user_id")).alias("vin"),
                      F.timestamp_add("HOUR", hours, epoch()).alias("bucket_ts"),
                      F.col("event_id").alias("version"), "value")
    return read_range(table, "2024-01-05", "2024-01-25", keys=("vin", "bucket_ts"),
                      date_col="bucket_ts", version_col="version")


def q_write_by_date(spark, sf_dir):
    path = scratch_path(spark, "signals-by-date")
    write_by_date(_signals(spark, sf_dir), path, "ts", fmt="json")
    back = spark.read.schema("vin string, ts timestamp_ntz, stype string, value double, "
                             "year int, month int, day int").options(**JSON_TS_OPTIONS).json(path)
    return back.select("vin", "ts", "stype", "value")


def q_etl_clean(spark, sf_dir):
    envelopes = _fx(spark, sf_dir)["envelopes"]
    raw, clean = scratch_path(spark, "raw-zone"), scratch_path(spark, "clean-zone")
    etl_job(envelopes, raw, clean, scratch_path(spark, "corrupt"))
    return spark.read.parquet(clean).select("vin", "ts", "stype", "value")


def q_etl_corrupt(spark, sf_dir):
    """Rows in = rows out: the clean and the corrupt zone of an ETL run, run twice under one load name."""
    envelopes = _fx(spark, sf_dir)["dirty_envelopes"]
    raw, clean, corrupt = (scratch_path(spark, n) for n in ("raw-zone", "clean-zone", "corrupt"))
    for _ in range(2):
        etl_job(envelopes, raw, clean, corrupt, load="first")
    good = spark.read.parquet(clean).select("vin", F.lit("clean").alias("reason"))
    return (good.unionByName(spark.read.parquet(corrupt).select("vin", "reason"))
            .groupBy("vin", "reason").agg(F.count("*").alias("n")))


def _sink(kind, make):
    def q(spark, sf_dir):
        path = scratch_path(spark, f"kpi-{kind}")
        write_kpi(make(spark, sf_dir), kind, target=path)
        return spark.read.parquet(path)
    return q


def q_read_json(spark, sf_dir):
    """The signal table as JSON lines in both spellings, values quoted, read back."""
    path = scratch_path(spark, "signals-json")
    ts = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    old = F.struct(F.col("vin").alias("VIN"), ts.alias("timestamp"), "stype", F.col("value").cast("string").alias("value"))
    new = F.struct("vin", ts.alias("ts"), "stype", "value")
    line = F.when(F.col("stype") == S.SPEED, F.to_json(old)).otherwise(F.to_json(new))
    _signals(spark, sf_dir).select(line.alias("value")).write.text(path)
    return read_signals(spark, path, "json")


RANGE = ("2024-01-05", "2024-01-15")


def q_daily_range(spark, sf_dir):
    """Daily KPIs of a range, from date folders that are pruned."""
    rows = in_range(_fx(spark, sf_dir)["signals_by_day"], *RANGE, partitioned=True)
    return kpi.daily_kpis(rows, start=RANGE[0], end=RANGE[1])


def q_signals_range(spark, sf_dir):
    return in_range(_fx(spark, sf_dir)["signals_by_day"], *RANGE, partitioned=True).select("vin", "ts", "stype", "value")


def _aircon(state):
    def q(spark, sf_dir):
        return kpi.aircon_by_day(to_second_rows(_signals(spark, sf_dir)), None, state)
    return q


def q_total_km_open(spark, sf_dir):
    return kpi.total_fuel_by_km(_signals(spark, sf_dir), complete_only=False)


def q_km_job(spark, sf_dir):
    """The 100-km job run twice: the second run, after the advanced checkpoint, adds nothing."""
    fx = _fx(spark, sf_dir)
    out, marks = scratch_path(spark, "kpi-km"), scratch_path(spark, "checkpoint")
    fx["km_checkpoint"].write.parquet(f"{marks}/run=start")
    for _ in range(2):
        km_job(fx["signals"], spark.read.parquet(marks), out, marks)
    return spark.read.parquet(out).select("vin", "mileage", "data_key", "data_value")


def q_fill_job(spark, sf_dir):
    """The fill job run twice."""
    fx = _fx(spark, sf_dir)
    out, marks = scratch_path(spark, "kpi-fill"), scratch_path(spark, "marks")
    fx["processed_fills"].write.parquet(f"{marks}/run=start")
    for _ in range(2):
        fill_job(fx["signals"], fx["fills"], spark.read.parquet(marks), out, marks)
    return spark.read.parquet(out).select("vin", "gas_id", "fill_grade", "fill_date", "data_key", "data_value")


def _broken_off(store, marks, job):
    """A run whose last write fails, then two that do not: the first changes nothing, the second finds nothing new."""
    def fail(name, text):
        raise InterruptedError(name)

    commit_jobs.start_marks(store, *marks)
    store.put_new, put_new = fail, store.put_new
    try:
        job()
    except InterruptedError:
        pass
    store.put_new = put_new
    for _ in range(2):
        job()


def q_km_commit(spark, sf_dir):
    fx, store = _fx(spark, sf_dir), Store(spark, scratch_path(spark, "km-store"))
    _broken_off(store, (commit_jobs.KM_MARKS, fx["km_checkpoint"]), lambda: commit_jobs.km_commit_job(fx["signals"], store))
    return store.read(commit_jobs.KM_FACTS).select("vin", "mileage", "data_key", "data_value")


def q_fill_commit(spark, sf_dir):
    fx, store = _fx(spark, sf_dir), Store(spark, scratch_path(spark, "fill-store"))
    _broken_off(store, (commit_jobs.FILL_MARKS, fx["processed_fills"]), lambda: commit_jobs.fill_commit_job(fx["signals"], fx["fills"], store))
    return store.read(commit_jobs.FILL_FACTS).select("vin", "gas_id", "fill_grade", "fill_date", "data_key", "data_value")


def q_lifetime_incremental(spark, sf_dir):
    """Totals after all days with doubled values, then each half of the days replaced by the right ones."""
    facts, store = kpi.daily_kpis(_signals(spark, sf_dir)), Store(spark, scratch_path(spark, "attr-store"))
    commit_jobs.lifetime_commit_job(facts.withColumn("data_value", F.col("data_value") * 2), store)
    for half in range(2):
        commit_jobs.lifetime_commit_job(facts.where(F.dayofmonth("now_date") % 2 == half), store)
    return commit_jobs.lifetime_of(store)


def q_after_checkpoint_zoned(spark, sf_dir):
    """The readings arrive in two loads; the resume reads the parts that the zone map names."""
    fx, store = _fx(spark, sf_dir), Store(spark, scratch_path(spark, "signal-store"))
    for half in range(2):
        zones.add_signals(store, fx["signals"].where(F.dayofmonth("ts") % 2 == half), buckets=8)
    return zones.after_checkpoint_zoned(store, fx["km_checkpoint"], S.INJECTION, buckets=8)


def _dirty_lines(spark, sf_dir):
    """Tank levels as JSON lines: by their minute broken, with the level quoted, no number, null, or lacking."""
    levels = _signals(spark, sf_dir).where(F.col("stype") == S.FUEL_LEVEL)
    minute, text = F.minute("ts"), F.col("value").cast("string")
    level = (F.when(minute % 10 == 1, F.concat(F.lit(', "level": "'), text, F.lit('"'))).when(minute % 10 == 2, F.lit(', "level": "n/a"'))
             .when(minute % 10 == 3, F.lit(', "level": null')).when(minute % 10 == 4, F.lit("")).otherwise(F.concat(F.lit(', "level": '), text)))
    line = F.concat(F.lit('{"vin": "'), "vin", F.lit('", "minute": '), minute, F.lit(', "even": '), (minute % 2 == 0).cast("string"), level,
                    F.when(minute % 10 == 0, F.lit("")).otherwise(F.lit("}")))
    return levels.select(line.alias("value"))


def q_schema_fields(spark, sf_dir):
    return field_types(_dirty_lines(spark, sf_dir))


def q_schema_typed(spark, sf_dir):
    lines = _dirty_lines(spark, sf_dir)
    rows, _ = read_lines(lines, discover(lines))
    return rows.select("vin", "minute", "even", "level", F.size("drift").alias("drifted"))


def q_sql_parameters(spark, sf_dir):
    """The newest reading and the number of readings of a type from a time on, asked in SQL."""
    return read_sql(spark, """SELECT vin, count(*) AS n, max(ts) AS newest, max(IDENTIFIER(:measure)) AS highest FROM IDENTIFIER(:source)
        WHERE stype = :stype AND ts >= CAST(:start AS TIMESTAMP_NTZ) AND value >= :least GROUP BY vin""",
                    {"measure": "value", "source": "fleet_signals", "stype": S.SPEED, "start": "2024-01-10 00:00:00", "least": 20.0},
                    {"fleet_signals": _signals(spark, sf_dir)})


def q_attr_upsert(spark, sf_dir):
    """The newest value of each vehicle's attributes after three merges, which come in the wrong order."""
    ev, store = FX.read_table(spark, sf_dir, "events"), Store(spark, scratch_path(spark, "upsert-store"))
    rows = ev.select(FX.vin_of(F.col("user_id")).alias("vin"), F.col("event_type").alias("attribute_type"), F.col("value").alias("attribute_value"),
                     F.col("event_id").alias("version"))
    for i in (2, 0, 1):
        tx = store.begin()
        tx.upsert("attr", rows.where(F.col("version") % 3 == i), ("vin", "attribute_type"), "version")
        tx.commit()
    return store.read("attr")


def q_ranking_null_grade(spark, sf_dir):
    fx = _fx(spark, sf_dir)
    cost = fills.cost_per_km(fx["signals"], fx["fills"], fx["processed_fills"])
    return fills.economy_ranking(cost.withColumn("fill_grade", F.when(F.col("gas_id") % 4 != 0, F.col("fill_grade"))))


def q_read_range_default(spark, sf_dir):
    ev = FX.read_table(spark, sf_dir, "events")
    table = ev.select(FX.vin_of(F.col("user_id")).alias("vin"), F.to_date("ts").cast("timestamp_ntz").alias("ts"),
                      F.col("event_id").alias("version"), "value")
    return read_range(table, "2024-01-05", "2024-01-25")


def q_refuel_nulls(spark, sf_dir):
    """Tank levels with null and NaN values and null times in between: the same events."""
    sig = _signals(spark, sf_dir)
    levels = sig.where(F.col("stype") == S.FUEL_LEVEL)
    bad = [levels.withColumn("value", F.lit(None).cast("double")), levels.withColumn("value", F.lit(float("nan"))),
           levels.withColumn("ts", F.lit(None).cast("timestamp_ntz"))]
    for b in bad:
        sig = sig.unionByName(b)
    return refuel_events(sig, step=None)


def _stream(spark, df, name):
    """``df`` as files read by a stream."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.readStream.schema(df.schema).parquet(path)


def _streamed(spark, df, name):
    """The rows that a streaming query appends to a file sink until its source is exhausted."""
    out = scratch_path(spark, f"{name}-out")
    q = (df.writeStream.format("parquet").outputMode("append").option("path", out)
         .option("checkpointLocation", scratch_path(spark, f"{name}-offsets")).trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(df.schema).parquet(out)


def _closing(spark, sf_dir):
    """All signals and, per vehicle, one much later reading, after which all windows are closed."""
    sig = _signals(spark, sf_dir)
    last = FX.read_table(spark, sf_dir, "events").agg(F.timestamp_add("DAY", F.lit(60), F.max("ts")).alias("ts"))
    later = last.select(F.lit("closing").alias("vin"), "ts", F.explode(F.array(F.lit(S.FUEL_LEVEL), F.lit(S.SPEED))).alias("stype"), F.lit(50.0).alias("value"))
    return sig.unionByName(later)


def q_low_fuel_stream(spark, sf_dir):
    src = _stream(spark, _closing(spark, sf_dir), "low-fuel-in")
    return _streamed(spark, low_fuel_windows(src, "6 hours", "2 hours", 20.0, watermark="1 hour"), "low-fuel")


def q_fuel_summary_stream(spark, sf_dir):
    src = _stream(spark, _closing(spark, sf_dir), "summary-in")
    return _streamed(spark, fuel_summary(src, "1 day", watermark="1 hour"), "summary")


def q_refuel_stream(spark, sf_dir):
    src = _stream(spark, _signals(spark, sf_dir), "refuel-in")
    return _streamed(spark, refuel_events_stream(src, step=None), "refuel")


def _arriving(spark, df, name, parts=4):
    """``df`` as a stream whose readings come up to 12 hours late, each by its own delay, in some micro-batches of 8 files."""
    path = scratch_path(spark, name)
    late = F.pmod(F.xxhash64("vin", "ts"), F.lit(12 * 3600))
    arrival = epoch_micros("ts") + late * 1_000_000
    lo, hi = df.where("vin <> 'closing'").agg(F.min(arrival), F.max(arrival)).first()
    step = (hi - lo) // parts + 1 if lo is not None else 1
    part = F.least((arrival - F.lit(lo)) / step, F.lit(parts - 1)).cast("int")
    for i in range(parts):
        df.where(part == i).repartition(8).write.mode("append").parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 8).parquet(path)


def _with_timers(spark, run):
    """``run()`` with the state store that timers need, which keeps state off the heap."""
    before = {k: spark.conf.get(k, None) for k in stateful_conf()}
    for k, v in stateful_conf().items():
        spark.conf.set(k, v)
    try:
        return run()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def q_refuel_timed(step):
    def run(spark, sf_dir):
        src = _arriving(spark, _closing(spark, sf_dir), "late-levels")
        return _with_timers(spark, lambda: _streamed(spark, refuel_events_timed(src, step, delay="13 hours"), "refuel-timed"))
    return run


def q_low_fuel_panes(spark, sf_dir):
    """360 windows overlap."""
    return low_fuel_panes(_signals(spark, sf_dir), "6 hours", "1 minute", 20.0)


def q_low_fuel_panes_stream(spark, sf_dir):
    src = _arriving(spark, _closing(spark, sf_dir), "late-levels")
    rows = low_fuel_panes_stream(src, "6 hours", "2 hours", 20.0, delay="13 hours")
    return _with_timers(spark, lambda: _streamed(spark, rows, "low-fuel-panes"))


def _in_runs(spark, sf_dir):
    """The hourly versions of :func:`q_read_range` as a key-ordered table of three runs."""
    ev = FX.read_table(spark, sf_dir, "events")
    hours = F.floor(epoch_micros("ts") / 3_600_000_000)
    table = ev.select(FX.vin_of(F.col("user_id")).alias("vin"), F.timestamp_add("HOUR", hours, epoch()).alias("bucket_ts"),
                      F.col("event_id").alias("version"), "value")
    path = scratch_path(spark, "runs")
    for i in range(3):  # three loads, each with a third of the versions
        write_run(table.where(F.col("version") % 3 == i), path, ts_col="bucket_ts")
    return path


def q_read_runs(spark, sf_dir):
    return read_runs(spark, _in_runs(spark, sf_dir), "2024-01-05", "2024-01-25")


def q_read_runs_keys(spark, sf_dir):
    """A scan from vehicle to vehicle, as the table store's key range."""
    return read_runs(spark, _in_runs(spark, sf_dir), "2024-01-05", "2024-01-25", key_from="VIN00020", key_to="VIN00060")


def q_log_stream(spark, sf_dir):
    """Tank levels through the log source: appended to four partitions, read back in at least four capped batches."""
    levels = _signals(spark, sf_dir).where(F.col("stype") == S.FUEL_LEVEL)
    log, out = scratch_path(spark, "log"), scratch_path(spark, "log-out")
    value = F.to_json(F.struct("vin", "ts", "stype", "value"), JSON_TS_OPTIONS)
    append_log(levels, log, F.substring("vin", -5, 5).cast("int") % 4, F.col("vin"), value, ("ts", "vin"), segment_rows=5000)
    cap = max(ends(log).values(), default=0) // 4 + 1
    rows = parse_signals(read_log(spark, log, group="levels", max_per_partition=cap), "value", ["partition", "offset"])
    q = (rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "log-offsets"))
         .trigger(processingTime="0 seconds").start())
    drain(q, log)
    q.stop()
    return spark.read.schema(rows.schema).parquet(out)


def q_run_detectors(spark, sf_dir):
    """The runner over an envelope stream; its refuel alerts."""
    raw = _stream(spark, _fx(spark, sf_dir)["envelopes"], "envelopes-in")
    out = scratch_path(spark, "alerts")

    def run():
        levels = stream_signals(raw, [S.FUEL_LEVEL])
        for q in run_detectors(levels, out, scratch_path(spark, "offsets"), "1 day", trigger={"availableNow": True}, refuel_step=None):
            q.awaitTermination()

    _with_timers(spark, run)  # three open windows per level until the watermark passes: kept off the heap
    return spark.read.parquet(f"{out}/refuel").select("vin", "fuel_mass", "fill_amount", "fill_start_time", "fill_end_time")


def q_detectors_once(spark, sf_dir):
    """Both detectors over one scan of the envelope stream; a far later upload closes what is open."""
    closing = """[{"ts": "2100-01-01 00:00:00", "stype": "fuelLevel", "value": 50.0}]"""
    env = _fx(spark, sf_dir)["envelopes"]
    last = spark.createDataFrame([("closing", "21000101000001000", closing)], env.schema)
    raw, out = _stream(spark, env.unionByName(last), "envelopes-in"), scratch_path(spark, "alerts")

    def run():
        run_detectors_once(stream_signals(raw, [S.FUEL_LEVEL]), out, scratch_path(spark, "offsets"), "1 day", {"availableNow": True}, "6 hours", "2 hours", 20.0, None).awaitTermination()

    _with_timers(spark, run)
    refuel = spark.read.parquet(f"{out}/refuel").select("vin", F.lit("refuel").alias("kind"), F.col("fill_start_time").alias("start_ts"),
                                                        F.col("fill_end_time").alias("end_ts"), F.col("fuel_mass").alias("value"))
    low = spark.read.parquet(f"{out}/low_fuel").select("vin", F.lit("low_fuel").alias("kind"), F.col("window_start").alias("start_ts"),
                                                       F.col("window_end").alias("end_ts"), F.col("msg_para")[0]["value"].alias("value"))
    return refuel.unionByName(low)


def q_low_fuel_short(spark, sf_dir):
    """The reference's window and slide."""
    return low_fuel_windows(_signals(spark, sf_dir), threshold=20.0)


def q_fuel_summary_short(spark, sf_dir):
    return fuel_summary(_signals(spark, sf_dir))


def q_alert_payload(spark, sf_dir):
    out = low_fuel_alerts(low_fuel_windows(_signals(spark, sf_dir), "6 hours", "2 hours", 20.0))
    body = F.from_json("payload", "msgType string, vin string, msgPara array<struct<type: string, value: double>>")
    return out.select("window_start", body.alias("b")).select(
        "window_start", F.col("b.msgType").alias("msg_type"), F.col("b.vin").alias("vin"),
        F.col("b.msgPara")[0]["type"].alias("para_type"), F.col("b.msgPara")[0]["value"].alias("para_value"))


def q_json_lines(spark, sf_dir):
    return to_json_lines(kpi.total_fuel_by_day(_signals(spark, sf_dir)))


QUERIES: dict[str, Query] = {
    "signals_from_events": q_signals,
    "fill_records": q_fill_records,
    "processed_fills": q_processed_fills,
    "km_checkpoint": q_km_checkpoint,
    "idle_fuel_day": _day("idle"),
    "idle_fuel_km": _km("idle"),
    "driving_fuel_day": _day("driving"),
    "driving_fuel_km": _km("driving"),
    "driving_fuel_km_asof": q_driving_km_asof,
    "aircon_rate": q_aircon_rate,
    "aircon_fuel_day": q_aircon_day,
    "aircon_fuel_km": q_aircon_km,
    "total_fuel_day": q_total_day,
    "mileage_day": q_mileage_day,
    "total_fuel_km": q_total_km,
    "total_fuel_km_full": q_total_km_full,
    "daily_kpis": q_daily_kpis,
    "km_kpis": q_km_kpis,
    "other_fuel_day": q_other_day,
    "other_fuel_km": q_other_km,
    "lifetime_totals": q_lifetime,
    "avg_fuel_per_100km": q_avg_100km,
    "after_checkpoint": q_after_checkpoint,
    "last_bucket": q_last_bucket,
    "new_fills": q_new_fills,
    "fill_intervals": q_fill_intervals,
    "fuel_prices": q_fuel_prices,
    "assign_fill_interval": _assign("range"),
    "assign_fill_interval_asof": _assign("asof"),
    "cost_per_km": _per_fill(fills.cost_per_km),
    "economy_ranking": q_ranking,
    "average_speed": _per_fill(fills.average_speed),
    "fuel_heating": _per_fill(fills.fuel_heating),
    "fill_kpis": _per_fill(fills.fill_kpis),
    "low_fuel_windows": q_low_fuel,
    "fuel_summary": q_fuel_summary,
    "refuel_events": q_refuel,
    "refuel_events_steps": q_refuel_steps,
    "explode_envelopes": q_explode,
    "drop_future_readings": q_drop_future,
    "date_functions": q_date_functions,
    "sql_functions": q_sql_functions,
    "read_range": q_read_range,
    "write_by_date_roundtrip": q_write_by_date,
    "etl_clean_zone": q_etl_clean,
    "kpi_sink_roundtrip": _sink("day", q_daily_kpis),
    "km_sink_roundtrip": _sink("km", q_km_kpis),
    "fill_sink_roundtrip": _sink("fill", _per_fill(fills.fill_kpis)),
    "attr_sink_roundtrip": _sink("attr", q_lifetime),
    "json_lines": q_json_lines,
    "read_json_signals": q_read_json,
    "etl_corrupt_rows": q_etl_corrupt,
    "read_range_default_keys": q_read_range_default,
    "signals_range": q_signals_range,
    "daily_kpis_range": q_daily_range,
    "aircon_fuel_day_off": _aircon("off"),
    "aircon_fuel_day_all": _aircon("all"),
    "total_fuel_km_open": q_total_km_open,
    "km_job_rerun": q_km_job,
    "fill_job_rerun": q_fill_job,
    "economy_ranking_null_grade": q_ranking_null_grade,
    "refuel_events_nulls": q_refuel_nulls,
    "refuel_events_stream": q_refuel_stream,
    "low_fuel_windows_stream": q_low_fuel_stream,
    "km_commit_job": q_km_commit,
    "fill_commit_job": q_fill_commit,
    "lifetime_incremental": q_lifetime_incremental,
    "attr_upsert": q_attr_upsert,
    "schema_fields": q_schema_fields,
    "schema_typed": q_schema_typed,
    "sql_parameters": q_sql_parameters,
    "after_checkpoint_zoned": q_after_checkpoint_zoned,
    "log_stream": q_log_stream,
    "read_runs": q_read_runs,
    "read_runs_keys": q_read_runs_keys,
    "refuel_events_timed": q_refuel_timed(None),
    "refuel_events_timed_steps": q_refuel_timed("5 seconds"),
    "low_fuel_panes": q_low_fuel_panes,
    "low_fuel_panes_stream": q_low_fuel_panes_stream,
    "detectors_one_scan": q_detectors_once,
    "fuel_summary_stream": q_fuel_summary_stream,
    "detector_refuel_alerts": q_run_detectors,
    "low_fuel_windows_short": q_low_fuel_short,
    "fuel_summary_short": q_fuel_summary_short,
    "low_fuel_alert_payload": q_alert_payload,
}


#: These also run on the dense, dirty signal table.
DENSE = ["idle_fuel_day", "idle_fuel_km", "driving_fuel_day", "driving_fuel_km", "driving_fuel_km_asof", "aircon_rate", "aircon_fuel_day",
         "aircon_fuel_km", "total_fuel_day", "mileage_day", "total_fuel_km", "total_fuel_km_full", "daily_kpis", "daily_kpis_range", "km_kpis",
         "other_fuel_day", "other_fuel_km", "lifetime_totals", "avg_fuel_per_100km", "after_checkpoint", "assign_fill_interval",
         "assign_fill_interval_asof", "cost_per_km", "economy_ranking", "average_speed", "fuel_heating", "fill_kpis", "km_job_rerun",
         "low_fuel_windows", "low_fuel_windows_short", "low_fuel_panes", "fuel_summary", "fuel_summary_short", "refuel_events", "refuel_events_steps"]


def _on_dense(query: Query) -> Query:
    return lambda spark, sf_dir: query(spark, Dense(sf_dir))


QUERIES |= {f"{name}_dense": _on_dense(QUERIES[name]) for name in DENSE}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily KPI job: D001-D004 and D006 for every vehicle-day."""
    return q_daily_kpis(spark, sf_dir)


def sf_path(sf: str) -> str:
    return os.path.join("/root/testdata", f"sf{sf}")
