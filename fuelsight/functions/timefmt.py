"""Timestamp and date helpers (E3-E8), all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values: the two timestamp spellings found in vehicle data ---
ISO_FORMAT = "yyyy-MM-dd HH:mm:ss[.SSSSSS]"
COMPACT_FORMAT = "yyyyMMddHHmmss[.SSSSSS]"

# a fraction's first six digits (after a dot, or after the 14 digits of the compact form) and what follows them
EXTRA_DIGITS = "^([0-9]{20}|[0-9-]+[T ][0-9:]+[.][0-9]{6})[0-9]+$"


def parse_ts(c: Column | str) -> Column:
    """Parse ``yyyy-MM-dd HH:mm:ss[.ffffff]`` (also with ``T``) or ``yyyyMMddHHmmss[SSS]``.

    Fraction digits beyond the sixth are cut, and a trailing ``Z`` is dropped.

    The spelling is picked from the fifth character (``-`` = ISO), so each
    value is parsed once.  The compact form has no separator before the
    fraction, which the pattern parser cannot read, so a dot is inserted
    after 14 digits.  Unparseable strings give null (D23: 24-hour clock).
    """
    name = c if isinstance(c, str) else None
    if name is None:
        return parse_ts_column(c)
    return F.expr(parse_ts_sql(f"`{name}`"))


def parse_ts_sql(x: str) -> str:
    """SQL text of :func:`parse_ts` for an expression ``x``."""
    s = f"regexp_replace(regexp_replace(trim(CAST({x} AS STRING)), 'Z$', ''), '{EXTRA_DIGITS}', '$1')"
    return (f"CAST(CASE WHEN substr({s}, 5, 1) = '-' "
            f"THEN try_to_timestamp(translate({s}, 'T', ' '), '{ISO_FORMAT}') "
            f"ELSE try_to_timestamp(CASE WHEN length({s}) > 14 "
            f"THEN concat(substr({s}, 1, 14), '.', substr({s}, 15)) ELSE {s} END, '{COMPACT_FORMAT}') "
            f"END AS TIMESTAMP_NTZ)")


def clean_ts(c: Column) -> Column:
    """A time's text without what :func:`parse_ts` leaves out."""
    return F.regexp_replace(F.regexp_replace(F.trim(c.cast("string")), "Z$", ""), EXTRA_DIGITS, "$1")


def parse_clean_ts(s: Column) -> Column:
    """The time of a text that :func:`clean_ts` made; ``s`` stands here several times, so it should be a column that has been worked out."""
    compact = F.when(F.length(s) > 14, F.concat(F.substring(s, 1, 14), F.lit("."), F.substring(s, 15, 1 << 20))) \
        .otherwise(s)
    return F.when(F.substring(s, 5, 1) == "-",
                  F.try_to_timestamp(F.translate(s, "T", " "), F.lit(ISO_FORMAT))) \
        .otherwise(F.try_to_timestamp(compact, F.lit(COMPACT_FORMAT))).cast("timestamp_ntz")


def parse_ts_column(c: Column) -> Column:
    """:func:`parse_ts` for an arbitrary column expression."""
    return parse_clean_ts(clean_ts(c))


def add_date_parts(df: DataFrame, ts_col: str = "ts") -> DataFrame:
    """``year``, ``month``, ``day`` partition columns of a timestamp."""
    t = F.col(ts_col)
    return df.withColumns({
        "year": F.year(t),
        "month": F.month(t),
        "day": F.dayofmonth(t),
    })


def date_string(c: Column) -> Column:
    """E5: ``yyyy-MM-dd`` of a timestamp."""
    return F.date_format(c, "yyyy-MM-dd")


def epoch_millis(c: Column) -> Column:
    """Epoch milliseconds of a wall-clock timestamp (read as UTC, truncated)."""
    from ..operators.wide import epoch_micros
    return F.floor(epoch_micros(c.cast("timestamp_ntz")) / 1000)


def date_of_parts(year: Column, month: Column, day: Column) -> Column:
    """``yyyy-MM-dd`` from numeric parts, always two-digit month/day."""
    return F.date_format(F.make_date(year, month, day), "yyyy-MM-dd")


SQL_FUNCTIONS = {
    "fs_year": ("x TIMESTAMP_NTZ", "INT", "year(x)"),
    "fs_month": ("x TIMESTAMP_NTZ", "INT", "month(x)"),
    "fs_day": ("x TIMESTAMP_NTZ", "INT", "dayofmonth(x)"),
    "fs_date_string": ("x TIMESTAMP_NTZ", "STRING", "date_format(x, 'yyyy-MM-dd')"),
    "fs_date_of_parts": ("y INT, m INT, d INT", "STRING", "date_format(make_date(y, m, d), 'yyyy-MM-dd')"),
    "fs_parse_ts": ("s STRING", "TIMESTAMP_NTZ", None),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Register the date helpers as SQL functions.

    They are SQL-bodied temporary functions, so Catalyst inlines them into
    the plan like any built-in expression (no Python on the executors).
    """
    for name, (params, ret, body) in SQL_FUNCTIONS.items():
        body = body or parse_ts_sql("s")
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {ret} RETURN {body}")
    return list(SQL_FUNCTIONS)
