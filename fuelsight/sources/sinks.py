"""Writers (S3, S8-S16)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.timefmt import add_date_parts
from ..operators.etl import drop_future_readings, split_envelopes

# Timestamps written to JSON keep all six fraction digits (the default
# writer would cut them to milliseconds).
JSON_TS_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def to_json_lines(df: DataFrame) -> DataFrame:
    """S3: one JSON document per row in a ``value`` column."""
    return df.select(F.to_json(F.struct(*df.columns), JSON_TS_OPTIONS).alias("value"))


def write_by_date(df: DataFrame, path: str, ts_col: str = "ts", fmt: str = "parquet",
                  mode: str = "append", sort_by: tuple[str, ...] = ()) -> None:
    """Append ``df`` partitioned into ``year=/month=/day=`` folders.

    Rows are clustered by the partition columns first (one shuffle) so each
    task writes few files; the ``REBALANCE`` hint lets AQE split a big day
    into several tasks instead of one.  ``sort_by`` orders rows inside each
    file (tighter Parquet min/max statistics for later filters).
    """
    out = add_date_parts(df, ts_col).hint("rebalance", "year", "month", "day")
    if sort_by:
        out = out.sortWithinPartitions("year", "month", "day", *sort_by)
    writer = out.write.mode(mode).partitionBy("year", "month", "day")
    if fmt == "json":
        writer = writer.options(**JSON_TS_OPTIONS)
    writer.format(fmt).save(path)


def etl_job(envelopes: DataFrame, raw_path: str, clean_path: str, corrupt_path: str, fmt: str = "parquet",
            load: str | None = None) -> None:
    """Raw zone (envelopes by send date) + cleaned zone (readings by reading date).

    What cannot be read goes to ``corrupt_path`` with its reason (:func:`split_envelopes`), so
    the readings in equal those in the cleaned zone, the future ones (E2) and the
    corrupt ones.  ``load`` names this run's input (an upload batch, a day): its rows go
    under ``load=<name>`` in all three zones, and running it again replaces just
    them.  Without a name each run appends.
    """
    from ..functions.timefmt import parse_ts
    good, bad = split_envelopes(envelopes)
    raw = envelopes.withColumn("send_ts", parse_ts(F.col("TS")))
    clean = drop_future_readings(good).drop("send_ts")
    if load is None:
        write_by_date(raw, raw_path, "send_ts", fmt)
        write_by_date(clean, clean_path, "ts", fmt)
        bad.write.mode("append").format(fmt).save(corrupt_path)
        return
    write_by_date(raw, f"{raw_path}/load={load}", "send_ts", fmt, mode="overwrite")
    write_by_date(clean, f"{clean_path}/load={load}", "ts", fmt, mode="overwrite")
    bad.write.mode("overwrite").format(fmt).save(f"{corrupt_path}/load={load}")


# --- fixed values: names of the KPI tables the reporting side reads ---
KPI_TABLES = {
    "day": "t_car_used_day",
    "km": "t_car_used_km",
    "fill": "t_fuel_fill_attr",
    "attr": "t_car_attr_current",
}
# --- fixed value: the reference writer's pool size ---
JDBC_CONNECTIONS = 3


def write_kpi(df: DataFrame, kind: str, target: str | None = None, fmt: str = "parquet",
              mode: str = "append", url: str | None = None, batch_size: int = 1000,
              isolation_level: str = "READ_COMMITTED", num_connections: int = JDBC_CONNECTIONS,
              partition_by: tuple[str, ...] = (), **options) -> None:
    """Write a KPI fact table.

    ``fmt='jdbc'`` uses Spark's JDBC writer: each partition opens one
    connection and inserts in batches of ``batch_size`` inside one
    transaction (S14); ``num_connections`` caps parallel JDBC writers by
    coalescing (facts are few: one row per vehicle and day or bucket); ``mode='truncate'`` empties the table and keeps its schema
    (S15).  Other formats write files to ``target``; with ``partition_by``
    and ``mode='replace'`` only the partitions present in ``df`` are
    rewritten (dynamic overwrite), which makes a rerun of the same day
    idempotent.
    """
    target = target or KPI_TABLES[kind]
    truncate = mode == "truncate"
    mode = "overwrite" if truncate else mode
    if fmt == "jdbc":
        df = df.coalesce(num_connections)
        (df.write.format("jdbc").mode(mode)
         .option("url", url).option("dbtable", target)
         .option("batchsize", str(batch_size)).option("isolationLevel", isolation_level)
         .option("truncate", "true" if truncate else "false")
         .options(**options).save())
        return
    writer = df.write.format(fmt).options(**options)
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target)


def write_alerts(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "append") -> None:
    """Persist alerts with their JSON payload (no HTTP call is made)."""
    df.write.mode(mode).format(fmt).save(path)
