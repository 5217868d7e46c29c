"""Batch jobs: the operators wired into the runs a fleet operator schedules.

Each job reads tables, computes one family of KPIs and writes a fact table
(files, or JDBC via ``write_kpi``).  Incremental state — the 100-km
checkpoint and the processed-fill marks — is written next to the results, so
the next run resumes where this one stopped.  Outputs go to folders the
caller names (on a cluster: the shared store); nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.predicates import default_range, in_range
from ..operators import algebra, fills, kpi
from ..operators.incremental import restart_times
from ..session import remove_path, scratch_path
from ..sources.sinks import write_kpi


def _stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write this run's rows to a fresh table in the shared folder and read it
    back: derived KPIs then read the table (cut lineage) instead of
    recomputing the pass, and only this run's rows are used.  The caller deletes the
    table (its path comes second) when the job is done."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def aircon_rate_job(signals: DataFrame, out: str) -> None:
    """A7 as its own run: the fleet rate, written for the daily job to read."""
    kpi.aircon_rate(signals).write.mode("overwrite").parquet(out)


def daily_job(signals: DataFrame, out: str, start=None, end=None, rate: DataFrame | float | None = None,
              partitioned: bool = False, **sink) -> None:
    """D001-D004, D006 for ``[start, end)`` (default: yesterday) plus D005.

    One pass over the readings (fused daily operator); the rows are staged
    in the shared folder, D005 is derived from the staged table, and both go
    to the sink together.  File sinks are partitioned by ``now_date`` and
    written with dynamic overwrite, so running a day again replaces it; a
    JDBC sink appends, as the table's own keys decide.
    """
    if (start is None) != (end is None):
        raise ValueError("give both start and end, or neither (yesterday)")
    if start is None:
        start, end = default_range()
    rows = in_range(signals, start, end, partitioned=partitioned)
    run, path = _stage(kpi.daily_kpis(rows, rate=rate), "kpi-day-run")
    other = algebra.other_fuel(run, "day")
    if sink.get("fmt", "parquet") != "jdbc":
        sink = {"mode": "replace", "partition_by": ("now_date",), **sink}
    write_kpi(run.unionByName(other), "day", target=out, **sink)
    remove_path(signals.sparkSession, path)


def _resumed(signals: DataFrame, marks: DataFrame) -> tuple[DataFrame, list[str]]:
    """KM001-KM004 of a run (staged) and the paths to remove.  The restart times, one row per vehicle, are staged first."""
    starts, starts_path = _stage(restart_times(signals, marks, S.INJECTION), "km-starts")
    run, path = _stage(kpi.resumed_km_kpis(signals, marks, starts=starts), "kpi-km-run")
    return run, [path, starts_path]


def km_job(signals: DataFrame, checkpoint: DataFrame, out: str, checkpoint_out: str, **sink) -> None:
    """KM001-KM005 of the buckets completed since the checkpoint.

    Afterwards each vehicle's next bucket index goes to ``checkpoint_out``, so a run on
    the same readings adds no bucket twice.  Facts and marks of a run go to a
    folder ``run=<id>`` each, named after the checkpoint that the run started from:
    when a run broke off between the two, its repetition starts from the same checkpoint and replaces both.
    """
    run_id = _state_id(checkpoint, "per100")
    run, paths = _resumed(signals, checkpoint)
    write_kpi(run.unionByName(algebra.other_fuel(run, "km")), "km", target=_run_target(out, run_id, sink), **_replacing(sink))
    advanced = (run.where(F.col("data_key") == S.KM_TOTAL_FUEL)
                .groupBy("vin").agg((F.max("mileage") / 100 + 1).cast("int").alias("per100"))
                .select("vin", F.lit(S.INJECTION).alias("stype"), "per100"))
    advanced.write.mode("overwrite").parquet(f"{checkpoint_out}/run={run_id}")
    for path in paths:
        remove_path(signals.sparkSession, path)


def _state_id(marks: DataFrame, value: str) -> str:
    """A name for a state of marks: a hash over its rows that does not depend on their order."""
    row = marks.agg(F.count("*"), F.coalesce(F.sum(F.xxhash64("vin", value).cast("decimal(38,0)")), F.lit(0))).first()
    return f"{row[0]}-{int(row[1]) % (1 << 64):016x}"


def _run_target(out: str, run_id: str, sink: dict) -> str:
    return out if sink.get("fmt") == "jdbc" else f"{out}/run={run_id}"


def _replacing(sink: dict) -> dict:
    """File sinks replace the run's own folder; a JDBC sink appends, as its table's keys decide."""
    return sink if sink.get("fmt") == "jdbc" else {"mode": "overwrite", **sink}


def fill_job(signals: DataFrame, fill_records: DataFrame, marks: DataFrame, out: str, marks_out: str,
             sample_ms: int = 10, strategy: str = "range", **sink) -> None:
    """FF001-FF003 (one interval join, fused) for intervals between fills not
    processed yet; then the start of each vehicle's last closed interval is
    added to the marks.  Folders per run as in :func:`km_job`."""
    run_id = _state_id(marks, "fill_ts")
    facts = fills.fill_kpis(signals, fill_records, marks, sample_ms, strategy)
    write_kpi(facts, "fill", target=_run_target(out, run_id, sink), **_replacing(sink))
    iv = fills.fill_intervals(fills.new_fills(fill_records, marks))
    iv.groupBy("vin").agg(F.max("start_ts").alias("fill_ts")).write.mode("overwrite").parquet(f"{marks_out}/run={run_id}")


def ranking_job(cost: DataFrame, out: str) -> None:
    """Rank of every interval's cost within its fuel grade."""
    fills.economy_ranking(cost.where(F.col("data_key") == S.FF_ECONOMY)).write.mode("overwrite").parquet(out)


def attribute_job(kpi_day: DataFrame, kpi_km: DataFrame, out: str, **sink) -> None:
    """C001-C006: lifetime totals and average fuel per 100 km, replacing the current table."""
    attrs = algebra.lifetime_totals(kpi_day).unionByName(algebra.avg_fuel_per_100km(kpi_km))
    write_kpi(attrs, "attr", target=out, mode=sink.pop("mode", "overwrite"), **sink)
