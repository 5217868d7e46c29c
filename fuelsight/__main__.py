"""Command line entry points for the scheduled jobs.

    spark-submit --py-files fuelsight.zip run_job.py daily --signals s3://.../clean --out s3://.../kpi_day
    python -m fuelsight km --signals ... --checkpoint ... --out ... --checkpoint-out ...

The session comes from ``SparkSession.builder.getOrCreate()`` (so the
submitter's configuration applies); tables are read by path.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from . import schemas as S
from .functions.predicates import default_range
from .plans import jobs
from .sources.readers import date_partitioned, read_signals, read_stream
from .sources.sinks import etl_job


def _read(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    return spark.read.format(fmt).load(path)


def _signals(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    return read_signals(spark, path, fmt)


def build_parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="fuelsight", description=__doc__.splitlines()[0])
    p.add_argument("--format", default="parquet", help="format of the input tables")
    sub = p.add_subparsers(dest="job", required=True)

    e = sub.add_parser("etl", help="envelopes -> raw zone + cleaned, date-partitioned signal zone")
    e.add_argument("--envelopes", required=True)
    e.add_argument("--raw", required=True)
    e.add_argument("--clean", required=True)
    e.add_argument("--corrupt", required=True, help="where unreadable uploads and readings go")
    e.add_argument("--load", help="name of this input; running it again replaces its rows")

    r = sub.add_parser("aircon-rate", help="fleet air-conditioning consumption rate")
    r.add_argument("--signals", required=True)
    r.add_argument("--out", required=True)

    d = sub.add_parser("daily", help="D001-D006 for [start, end) (default: yesterday)")
    d.add_argument("--signals", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--start")
    d.add_argument("--end")
    d.add_argument("--rate", help="air-con rate table written by aircon-rate, or a number")
    d.add_argument("--partitioned", action="store_true", help="signals are year/month/day partitioned")

    k = sub.add_parser("km", help="KM001-KM005, resuming after the 100-km checkpoint")
    k.add_argument("--signals", required=True)
    k.add_argument("--checkpoint", required=True)
    k.add_argument("--out", required=True)
    k.add_argument("--checkpoint-out", required=True)

    f = sub.add_parser("fill", help="FF001-FF003 for intervals between unprocessed fills")
    f.add_argument("--signals", required=True)
    f.add_argument("--fills", required=True)
    f.add_argument("--marks", required=True)
    f.add_argument("--out", required=True)
    f.add_argument("--marks-out", required=True)
    f.add_argument("--sample-ms", type=int, default=10)

    g = sub.add_parser("ranking", help="economy ranking of per-fill costs")
    g.add_argument("--fill-kpis", required=True)
    g.add_argument("--out", required=True)

    a = sub.add_parser("attributes", help="C001-C006 current attributes")
    a.add_argument("--kpi-day", required=True)
    a.add_argument("--kpi-km", required=True)
    a.add_argument("--out", required=True)

    s = sub.add_parser("stream", help="low-fuel and refuel detectors over an envelope stream")
    s.add_argument("--source-format", default="kafka")
    s.add_argument("--source", help="path for file sources")
    s.add_argument("--option", action="append", default=[], help="source option key=value (repeatable)")
    s.add_argument("--out", required=True)
    s.add_argument("--checkpoint-dir", required=True)
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--watermark", required=True, help="how long windows wait for late readings, e.g. '10 minutes'")
    s.add_argument("--partitions", type=int, help="source partitions: cap intake at the usual rate for each")
    return p


def main(argv: list[str] | None = None) -> int:
    args = build_parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"fuelsight-{args.job}").getOrCreate()
    fmt = args.format
    if args.job == "etl":
        envelopes = spark.read.schema(S.ENVELOPE).format(fmt).load(args.envelopes)
        etl_job(envelopes, args.raw, args.clean, args.corrupt, load=args.load)
    elif args.job == "aircon-rate":
        jobs.aircon_rate_job(_signals(spark, args.signals, fmt), args.out)
    elif args.job == "daily":
        if bool(args.start) != bool(args.end):
            build_parser().error("--start and --end go together")
        start, end = (args.start, args.end) if args.start else default_range()
        rate = None
        if args.rate:
            try:
                rate = float(args.rate)
            except ValueError:
                rate = spark.read.parquet(args.rate)
        partitioned = args.partitioned or date_partitioned(spark, args.signals)
        jobs.daily_job(_signals(spark, args.signals, fmt), args.out, start, end, rate, partitioned)
    elif args.job == "km":
        jobs.km_job(_signals(spark, args.signals, fmt), spark.read.parquet(args.checkpoint), args.out,
                    args.checkpoint_out)
    elif args.job == "fill":
        jobs.fill_job(_signals(spark, args.signals, fmt), _read(spark, args.fills, fmt),
                      spark.read.parquet(args.marks), args.out, args.marks_out, args.sample_ms)
    elif args.job == "ranking":
        jobs.ranking_job(spark.read.parquet(args.fill_kpis), args.out)
    elif args.job == "attributes":
        jobs.attribute_job(spark.read.parquet(args.kpi_day), spark.read.parquet(args.kpi_km), args.out)
    elif args.job == "stream":
        from .sources.readers import kafka_values
        from .streaming.detectors import rate_cap, run_detectors, stream_signals
        options = dict(o.split("=", 1) for o in args.option)
        raw = read_stream(spark, args.source_format, args.source,
                          schema=None if args.source_format == "kafka" else S.ENVELOPE,
                          max_per_trigger=rate_cap(args.partitions) if args.partitions else None, **options)
        if args.source_format == "kafka":
            raw = kafka_values(raw)
        trigger = {"availableNow": True} if args.available_now else None
        queries = run_detectors(stream_signals(raw, [S.FUEL_LEVEL]), args.out, args.checkpoint_dir, args.watermark, trigger=trigger)
        for q in queries:
            q.awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
