"""Duck curve: demand joined to pivoted fuels, with net and residual load."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CURVE_KEYS = ["period_utc", "respondent"]

# Fuel codes pivoted into the curve (fixed values): solar, wind, nuclear.
PIVOT_FUELS = {"solar_mwh": "SUN", "wind_mwh": "WND", "nuclear_mwh": "NUC"}


def demand_series(region: DataFrame) -> DataFrame:
    """Demand rows (metric ``D``) of the region table."""
    return (region.where(F.col("metric_type") == F.lit("D"))
            .select("period_utc", "respondent", F.col("value_mwh").alias("demand_mwh")))


def fuel_pivot(fuel: DataFrame) -> DataFrame:
    """SUN/WND/NUC generation per (hour, respondent). ``ELSE 0``: a fuel missing while
    others are present gives 0, not NULL. Partial (map-side) aggregation before the shuffle."""
    aggs = [F.sum(F.when(F.col("fuel_type") == F.lit(code), F.col("generation_mwh"))
                  .otherwise(F.lit(0.0))).alias(name)
            for name, code in PIVOT_FUELS.items()]
    return fuel.groupBy(*CURVE_KEYS).agg(*aggs)


def net_load(demand: Column, solar: Column, wind: Column) -> Column:
    return demand - solar - wind


def load_columns(df: DataFrame) -> DataFrame:
    """net = demand - solar - wind; residual = net - nuclear (same operation order as SQL)."""
    d, s, w, n = (F.col(c) for c in ("demand_mwh", "solar_mwh", "wind_mwh", "nuclear_mwh"))
    return (df.withColumn("net_load_mwh", net_load(d, s, w))
              .withColumn("residual_load_after_nuclear_mwh", d - s - w - n))


def duck_curve(region: DataFrame, fuel: DataFrame) -> DataFrame:
    """Inner equi-join of demand with the fuel pivot on (period_utc, respondent).

    Both inputs end up hash-partitioned on the join keys (the pivot by its own
    aggregation), so the join adds at most one exchange on the demand side;
    Catalyst/AQE pick broadcast when a side is measured small.
    """
    joined = demand_series(region).join(fuel_pivot(fuel), CURVE_KEYS, "inner")
    return load_columns(joined).select(
        "period_utc", "respondent", "demand_mwh", "solar_mwh", "wind_mwh", "nuclear_mwh",
        "net_load_mwh", "residual_load_after_nuclear_mwh")
