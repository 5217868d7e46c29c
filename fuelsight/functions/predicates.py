"""Row filters (F1-F9): plain column predicates, pushed to the scan by Catalyst."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def of_type(df: DataFrame, *stypes: str) -> DataFrame:
    """keep readings of the given signal types (``IN`` list, pushed down)."""
    return df.where(F.col("stype").isin(*stypes))


def _ts_lit(value) -> Column:
    if isinstance(value, Column):
        return value
    if isinstance(value, _dt.datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    elif isinstance(value, _dt.date):
        value = value.strftime("%Y-%m-%d")
    return F.lit(str(value)).cast("timestamp_ntz")


def range_predicate(start=None, end=None, ts_col: str = "ts") -> Column:
    """F2 as a column: half-open ``[start, end)``; ``None`` leaves a side open."""
    cond = F.lit(True)
    if start is not None:
        cond = cond & (F.col(ts_col) >= _ts_lit(start))
    if end is not None:
        cond = cond & (F.col(ts_col) < _ts_lit(end))
    return cond


def in_range(df: DataFrame, start=None, end=None, ts_col: str = "ts",
             partitioned: bool = False) -> DataFrame:
    """keep rows with ``start <= ts < end`` (both typed, D2).

    ``partitioned=True`` adds the equivalent predicate on ``year/month/day``
    partition columns written by :func:`write_by_date`, so whole directories
    are pruned before any file is opened.
    """
    out = df.where(range_predicate(start, end, ts_col))
    if partitioned:
        day = F.make_date(F.col("year"), F.col("month"), F.col("day"))
        if start is not None:
            out = out.where(day >= F.to_date(_ts_lit(start)))
        if end is not None:
            # the day of the last instant before the exclusive end: midnight admits no further folder
            out = out.where(day <= F.to_date(_ts_lit(end) - F.expr("INTERVAL '0.000001' SECOND")))
    return out


def default_range(args=None, today: _dt.date | None = None) -> tuple[_dt.date, _dt.date]:
    """``(yesterday, today)`` unless two arguments are given."""
    if args and len(args) >= 2:
        return (_dt.date.fromisoformat(str(args[0])[:10]), _dt.date.fromisoformat(str(args[1])[:10]))
    today = today or _dt.datetime.now(_dt.timezone.utc).date()  # sessions run in UTC
    return today - _dt.timedelta(days=1), today


def is_idle(speed: str = "speed", rpm: str = "rpm") -> Column:
    """engine on, vehicle standing."""
    return (F.col(speed) == 0) & (F.col(rpm) > 0)


def is_driving(speed: str = "speed", rpm: str = "rpm") -> Column:
    """engine on, vehicle moving."""
    return (F.col(speed) > 0) & (F.col(rpm) > 0)
