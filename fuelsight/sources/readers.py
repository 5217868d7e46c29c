"""Readers (S1, S2, S4-S7, S17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.predicates import range_predicate
from ..functions.timefmt import parse_ts


def read_signals(spark: SparkSession, path: str, fmt: str = "parquet", **options) -> DataFrame:
    """Scan a signal table with an explicit schema (no inference pass).

    Text formats may spell time and keys either way (``VIN``/``vin``,
    ``timestamp``/``ts``) and quote numbers; each field is parsed once.  Rows that do not
    parse keep nulls: :func:`split_corrupt` parts them from the others.
    ``year``, ``month`` and ``day`` folders, where the path has them, stay columns, so
    ``in_range(partitioned=True)`` prunes.
    """
    parts = "" if not date_partitioned(spark, path) else ", year int, month int, day int"
    if fmt == "parquet":
        return spark.read.options(**options).schema("vin string, ts timestamp_ntz, stype string, value double" + parts).parquet(path)
    keys = [c.strip().split()[0] for c in parts.split(",") if c.strip()]
    if fmt == "json":
        # a JSON line is read as text first: key spellings differ in case only, which a column name cannot
        raw = spark.read.options(**options).schema("value string" + parts).text(path)
        return parse_signals(raw, "value", keys)
    raw = spark.read.options(**options).schema("vin string, ts string, stype string, value string" + parts).format(fmt).load(path)
    return raw.select("vin", parse_ts(F.col("ts")).alias("ts"), "stype", F.col("value").try_cast("double").alias("value"), *keys)


def date_partitioned(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` has ``year=`` folders (a listing of one level)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p) or not fs.getFileStatus(p).isDirectory():
        return False
    return any(s.getPath().getName().startswith("year=") for s in fs.listStatus(p))


def split_corrupt(signals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Typed readings that can be used, and the rest as a side output.

    A reading is unusable when its vehicle, time (e.g. an unparseable
    timestamp), type or value is missing.  Both outputs are lazy filters of
    the same scan; nothing is dropped silently.
    """
    ok = (F.col("vin").isNotNull() & F.col("ts").isNotNull() & F.col("stype").isNotNull()
          & F.col("value").isNotNull())
    return signals.where(ok), signals.where(~ok | ok.isNull())


def parse_signals(df: DataFrame, col: str = "value", keep: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """JSON signal strings -> typed columns (``from_json``, one pass).

    Accepts both ``VIN``/``vin`` and ``timestamp``/``ts`` key spellings.
    """
    m = F.from_json(F.col(col), "map<string,string>")  # keys stay case-sensitive
    return df.select(
        F.coalesce(m["vin"], m["VIN"]).alias("vin"),
        parse_ts(F.coalesce(m["ts"], m["timestamp"])).alias("ts"),
        m["stype"].alias("stype"),
        m["value"].try_cast("double").alias("value"),
        *keep,
    )


def read_table(spark: SparkSession, name: str, url: str | None = None, fmt: str = "jdbc",
               partition_column: str | None = None, lower_bound=None, upper_bound=None,
               num_partitions: int | None = None, query: str | None = None, **options) -> DataFrame:
    """Read a relational table (or an ad-hoc query) in parallel.

    With ``partition_column`` and bounds, Spark opens ``num_partitions``
    connections each reading one slice; filters and projections on the
    result are pushed into the database query.  ``fmt`` other than ``jdbc``
    reads the same table from files (``name`` is then a path).
    """
    if fmt != "jdbc":
        return spark.read.format(fmt).options(**options).load(name)
    reader = spark.read.format("jdbc").option("url", url).options(**options)
    if query is not None:
        reader = reader.option("query", query)
    else:
        reader = reader.option("dbtable", name)
    if partition_column is None and query is None:
        raise ValueError("name a partition_column with bounds: without one the whole table comes through one task")
    if partition_column is not None:
        reader = (reader.option("partitionColumn", partition_column)
                  .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
                  .option("numPartitions", str(num_partitions or 8)))
    return reader.load()


def read_range(df: DataFrame, start=None, end=None, keys: tuple[str, ...] | None = None,
               date_col: str = "ts", version_col: str = "version", latest: bool = True) -> DataFrame:
    """Rows of a versioned key-range table with ``start <= date < end``.

    The date bound is a real filter on the range column (D28), so on a
    partitioned source it prunes files.  With ``latest`` only the newest
    version of each key (``vin`` and the date, unless named) survives: ``max_by`` over a struct of the other
    columns, so a row stays whole; a grouped aggregate with a partial step.
    The struct makes it a sort-based aggregate.
    """
    keys = keys or ("vin", date_col)
    rows = df.where(range_predicate(start, end, date_col))
    if not latest:
        return rows
    rest = [c for c in df.columns if c not in keys and c != version_col]
    packed = F.max_by(F.struct(*rest), F.col(version_col)).alias("_row")
    out = rows.groupBy(*keys).agg(F.max(version_col).alias(version_col), packed)
    return out.select(*keys, version_col, *[F.col(f"_row.{c}").alias(c) for c in rest])


def read_stream(spark: SparkSession, fmt: str = "parquet", path: str | None = None,
                schema=None, max_per_trigger: int | None = None, **options) -> DataFrame:
    """A streaming source.

    ``fmt='kafka'`` uses Spark's Kafka source (``subscribe``,
    ``startingOffsets``, ``failOnDataLoss`` ... passed through, the rate cap
    as ``maxOffsetsPerTrigger``); any file format reads new files from
    ``path`` with ``maxFilesPerTrigger``.  Offsets live in the query's
    checkpoint, not in an external store.
    """
    if fmt == "kafka":
        # resume from the checkpoint; on the first run start at the earliest
        # offset still available, and skip (not fail on) aged-out offsets
        options = {"startingOffsets": "earliest", "failOnDataLoss": "false", **options}
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        if max_per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", str(max_per_trigger))
        return reader.load()
    if schema is not None:
        reader = reader.schema(schema)
    if max_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_per_trigger))
    return reader.load(path)


def kafka_values(df: DataFrame) -> DataFrame:
    """Kafka ``(key, value)`` binary pair -> string value column."""
    return df.select(F.col("value").cast("string").alias("value"))


def register_views(spark: SparkSession, tables: dict[str, DataFrame]) -> list[str]:
    """Expose DataFrames as temp views for users who prefer SQL."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return list(tables)


def read_sql(spark: SparkSession, query: str, args: dict | None = None, tables: dict[str, DataFrame] | None = None) -> DataFrame:
    """An ad-hoc query with named parameters over registered views.

    ``:name`` in the query stands for a value of ``args``, typed and never spliced into the text, so a quote in it stays a
    character; ``IDENTIFIER(:name)`` stands for a table or column name.  ``tables`` are registered as views first.
    """
    register_views(spark, tables or {})
    return spark.sql(query, args=args or {})
