"""Skew-safe "as-of" running maximum and "next row" per key.

``value_at(t) = max(value of rows with the same key and ts <= t)``.  A window
``partitionBy(key).orderBy(ts)`` would give this directly but puts all rows of
one key in one task; a vehicle holding a third of the data would stall the
stage.  Instead the time axis is cut into chunks:

1. inside each (key, chunk) a window gives the running max of that chunk;
2. a grouped aggregate gives each (key, chunk)'s own max (partial aggregate,
   no skew), and a window over those chunk summaries — one row per key and
   chunk, bounded by time span / chunk, not by data volume — gives the max of
   all *earlier* chunks (the carry);
3. the answer is ``greatest(carry, in-chunk running max)``.

The in-chunk window and the join with the summaries share one hash
partitioning on (key, chunk), so the big side is shuffled once; the summary
branch re-reads the (pruned) columns but shuffles only partial maxima.

:func:`next_time` is the same idea for ``lead``: the next row inside the
chunk, else the first row of the key's next non-empty chunk.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .wide import micros_sql

DEFAULT_CHUNK_SECONDS = 3600


def chunk_of(ts: str, chunk_seconds: int) -> Column:
    return F.expr(f"floor({micros_sql(ts)} / {chunk_seconds * 1_000_000}L)")


def asof_running_max(df: DataFrame, keys: list[str], ts: str, value: str, out: str,
                     chunk_seconds: int = DEFAULT_CHUNK_SECONDS,
                     key_max: str | None = None) -> DataFrame:
    """Add ``out`` = running max of ``value`` per ``keys`` up to and including ``ts``.

    Rows with equal ``ts`` see each other (RANGE frame), so the result does not
    depend on row order.  ``value`` may be any orderable type (structs compare
    field by field); nulls are ignored.  ``key_max`` also adds the maximum
    over the whole key, taken from the same chunk summaries (no extra pass).
    """
    d = df.withColumn("_chunk", chunk_of(ts, chunk_seconds))
    part = [*keys, "_chunk"]
    # rows with a null key or time can never be matched
    not_null = F.col("_chunk").isNotNull()
    for k in keys:
        not_null = not_null & F.col(k).isNotNull()
    d = d.where(not_null)
    # each chunk's own max: a partial aggregate straight off the scan, so this
    # branch shuffles one small row per (key, chunk, map task), not readings
    summary = d.groupBy(*part).agg(F.max(value).alias("_chunk_max"))
    # dealt by (key, chunk) even where the input is dealt by the key already (e.g. after a join on it): that
    # would satisfy the window as well, with all of a hot key in one task
    d = d.repartition(*[F.col(c) for c in part])
    w_in = (Window.partitionBy(*part).orderBy(F.col(ts))
            .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    d = d.withColumn("_in_chunk", F.max(value).over(w_in))
    w_prev = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    extra = [F.max("_chunk_max").over(Window.partitionBy(*keys)).alias(key_max)] if key_max else []
    carry = summary.select(*part, F.max("_chunk_max").over(w_prev).alias("_carry"), *extra)
    return (
        d.join(carry, part, "inner")
        .withColumn(out, F.greatest(F.col("_carry"), F.col("_in_chunk")))
        .drop("_chunk", "_in_chunk", "_carry")
    )


def next_time(df: DataFrame, keys: list[str], ts: str, tiebreak: str, out: str,
              chunk_seconds: int = 86_400) -> DataFrame:
    """Add ``out`` = ``ts`` of the next row per ``keys`` in (ts, tiebreak) order.

    ``lead`` over a window partitioned by the key alone would put a hot key
    in one task.  Here ``lead`` runs inside (key, chunk); the last row of a
    chunk takes the earliest ``ts`` of the key's next non-empty chunk, from a
    window over per-chunk minima (one row per key and chunk).  The last row
    of a key gets null.
    """
    d = df.withColumn("_chunk", chunk_of(ts, chunk_seconds))
    part = [*keys, "_chunk"]
    w_in = Window.partitionBy(*part).orderBy(F.col(ts), F.col(tiebreak))
    d = d.withColumn("_lead", F.lead(F.col(ts)).over(w_in))
    firsts = df.withColumn("_chunk", chunk_of(ts, chunk_seconds)) \
        .groupBy(*part).agg(F.min(ts).alias("_first"))
    w_next = Window.partitionBy(*keys).orderBy("_chunk")
    nxt = firsts.select(*part, F.lead("_first").over(w_next).alias("_next_chunk_first"))
    return (d.join(nxt, part, "left")
            .withColumn(out, F.coalesce(F.col("_lead"), F.col("_next_chunk_first")))
            .drop("_chunk", "_lead", "_next_chunk_first"))
