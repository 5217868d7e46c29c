"""KPI algebra on the fact tables."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

OTHER_INPUTS = {
    "day": ("now_date", [S.D_TOTAL_FUEL, S.D_IDLE_FUEL, S.D_DRIVING_FUEL, S.D_AIRCON_FUEL], S.D_OTHER_FUEL),
    "km": ("mileage", [S.KM_TOTAL_FUEL, S.KM_IDLE_FUEL, S.KM_DRIVING_FUEL, S.KM_AIRCON_FUEL], S.KM_OTHER_FUEL),
}


OTHER_SCALE = {"day": 1.0, "km": 100.0}


def other_fuel(kpi: DataFrame, grain: str = "day") -> DataFrame:
    """A11 (D005) / A12 (KM005): total - idle - driving - air-con.

    A pivot written as one conditional sum per code — a single grouped
    aggregate, one shuffle (``GroupedData.pivot`` would plan two) — replaces
    the 4-way self-join; keys missing any of the four inputs give no row.
    The result may be negative (air-con seconds overlap idle/driving ones)
    and is kept.  KM001 counts each injection 100-fold (A9) and the other codes do not,
    so the 100-km total is divided by that factor first (D33).
    """
    key, codes, out_code = OTHER_INPUTS[grain]
    total, idle, driving, aircon = codes
    wide = (kpi.where(F.col("data_key").isin(*codes))
            .groupBy("vin", key)
            .agg(*[F.sum(F.when(F.col("data_key") == c, F.col("data_value"))).alias(c) for c in codes]))
    value = F.col(total) / OTHER_SCALE[grain] - F.col(idle) - F.col(driving) - F.col(aircon)
    return (wide.where(F.col(total).isNotNull() & F.col(idle).isNotNull()
                       & F.col(driving).isNotNull() & F.col(aircon).isNotNull())
            .select("vin", key, F.lit(out_code).alias("data_key"), value.alias("data_value")))


# Lifetime sums run over years of daily values; summed as doubles their last
# digits would depend on how rows are partitioned.  A DECIMAL(38,12) sum is
# exact, so the totals are the same on every run and cluster size.
EXACT_SUM = "decimal(38,12)"


def lifetime_totals(kpi_day: DataFrame) -> DataFrame:
    """A13 (C001-C005): per vehicle, the sum of each daily KPI.

    The code mapping is a literal map expression, so no join is needed; the
    sum is exact (see ``EXACT_SUM``).
    """
    mapping = F.create_map(*chain.from_iterable(
        (F.lit(d), F.lit(c)) for c, d in S.LIFETIME_FROM_DAY.items()))
    return (kpi_day.where(F.col("data_key").isin(*S.LIFETIME_FROM_DAY.values()))
            .groupBy("vin", mapping[F.col("data_key")].alias("attribute_type"))
            .agg(F.sum(F.col("data_value").cast(EXACT_SUM)).cast("double").alias("attribute_value")))


def avg_fuel_per_100km(kpi_km: DataFrame) -> DataFrame:
    """A14 (C006): mean of KM001 per vehicle."""
    return (kpi_km.where(F.col("data_key") == S.KM_TOTAL_FUEL)
            .groupBy("vin")
            .agg((F.sum(F.col("data_value").cast(EXACT_SUM)).cast("double") / F.count("data_value"))
                 .alias("attribute_value"))
            .select("vin", F.lit(S.C_FUEL_PER_100KM).alias("attribute_type"), "attribute_value"))
