"""Incremental jobs whose facts and marks become visible by one commit.

Each reads its marks from the store, computes what is new and commits facts and marks together
(:mod:`fuelsight.sources.commits`), so a run that breaks off at any point changes nothing, and running
it again gives the tables of a run that did not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import algebra, fills
from ..session import remove_path
from ..sources.commits import Store
from .jobs import _resumed, _stage

KM_FACTS, KM_MARKS = "kpi_km", "km_marks"
FILL_FACTS, FILL_MARKS = "kpi_fill", "fill_marks"
DAY_FACTS, TOTALS = "kpi_day", "attr_totals"


def start_marks(store: Store, table: str, marks: DataFrame) -> None:
    """The marks that the first run starts from."""
    tx = store.begin()
    tx.append(table, marks)
    tx.commit()


def km_commit_job(signals: DataFrame, store: Store) -> int:
    """KM001-KM005 of the buckets completed since the marks, and the new marks; the version that shows them."""
    tx = store.begin()
    run, paths = _resumed(signals, tx.read(KM_MARKS))
    tx.append(KM_FACTS, run.unionByName(algebra.other_fuel(run, "km")))
    tx.append(KM_MARKS, run.where(F.col("data_key") == S.KM_TOTAL_FUEL).groupBy("vin")
              .agg((F.max("mileage") / 100 + 1).cast("int").alias("per100")).select("vin", F.lit(S.INJECTION).alias("stype"), "per100"))
    version = tx.commit()
    for path in paths:
        remove_path(signals.sparkSession, path)
    return version


def fill_commit_job(signals: DataFrame, fill_records: DataFrame, store: Store) -> int:
    """FF001-FF003 of the intervals closed since the marks, and the new marks."""
    tx = store.begin()
    marks = tx.read(FILL_MARKS)
    facts = fills.fill_kpis(signals, fill_records, marks)
    closed = fills.fill_intervals(fills.new_fills(fill_records, marks))
    # without an interval there is nothing to join: the readings would be shuffled to find that out
    tx.append(FILL_FACTS, facts.limit(0) if closed.isEmpty() else facts)
    tx.append(FILL_MARKS, closed.groupBy("vin").agg(F.max("start_ts").alias("fill_ts")))
    return tx.commit()


def lifetime_commit_job(day_facts: DataFrame, store: Store, days: list[str] | None = None) -> int:
    """A13 kept up to date: the facts of some whole days are stored, and the lifetime totals changed by what that adds and takes away.

    ``days`` (as text; those in ``day_facts`` unless named) are replaced.  Only their old facts are read, and only the
    buckets of vehicles that changed are rewritten.  The totals hold how many facts each sum has; one without any goes.
    """
    spark = day_facts.sparkSession
    facts, path = _stage(day_facts, "kpi-day-run")
    days = days or [r[0] for r in facts.select(F.col("now_date").cast("string")).distinct().collect()]  # one per day of the run
    tx = store.begin()
    old = tx.read(DAY_FACTS, days)
    signed = facts.withColumn("_n", F.lit(1).cast("long"))
    if old is not None:
        signed = signed.unionByName(old.withColumn("_n", F.lit(-1).cast("long")))
    codes = F.create_map(*[F.lit(x) for c, d in S.LIFETIME_FROM_DAY.items() for x in (d, c)])
    exact = F.col("data_value").cast(algebra.EXACT_SUM)  # a product with a count would lose digits of it
    delta = (signed.where(F.col("data_key").isin(*S.LIFETIME_FROM_DAY.values()))
             .groupBy("vin", codes[F.col("data_key")].alias("attribute_type"))
             .agg(F.sum(F.when(F.col("_n") < 0, -exact).otherwise(exact)).cast(algebra.EXACT_SUM).alias("total"),
                  F.sum(F.when(exact.isNotNull(), F.col("_n")).otherwise(0)).alias("valued"), F.sum("_n").alias("n"))
             .where("n <> 0 OR valued <> 0 OR total <> 0"))

    def added(rows: DataFrame) -> DataFrame:
        return (rows.groupBy("vin", "attribute_type").agg(F.sum("total").cast(algebra.EXACT_SUM).alias("total"), F.sum("valued").alias("valued"),
                                                          F.sum("n").alias("n")).where("n > 0"))

    changes, changes_path = _stage(delta, "attr-changes")
    tx.replace(DAY_FACTS, facts, "now_date", days)
    tx.merge(TOTALS, changes, ("vin",), added)
    version = tx.commit()
    for p in (path, changes_path):
        remove_path(spark, p)
    return version


def lifetime_of(store: Store) -> DataFrame:
    """C001-C005 as :func:`fuelsight.operators.algebra.lifetime_totals` gives them."""
    return store.read(TOTALS).select("vin", "attribute_type", F.when(F.col("valued") > 0, F.col("total").cast("double")).alias("attribute_value"))
