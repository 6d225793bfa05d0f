"""Catalogue: duck curve (demand, fuel pivot, join, loads) and the local-hour profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.functions.rounding import py_round
from gridlens.functions.rounding import sql_py_mean as M
from gridlens.functions.rounding import sql_py_round as R
from gridlens.operators import curve as C
from gridlens.operators import dashboard as D
from gridlens.plans import oracle as O
from gridlens.sources import fixtures as X
from gridlens.plans.catalog.base import (
    register,
    WHOLE_CTE,
    curve,
    curve_text,
)


# -- curve

@register("demand_series", O.with_views(f"""
SELECT {O.ts_text('period_utc')} AS period_utc, respondent, demand_mwh FROM demand""", "demand"))
def q_demand_series(spark, sf_dir):
    return curve_text(C.demand_series(X.region_hourly(spark, sf_dir)))


@register("fuel_pivot", O.with_views(f"""
SELECT {O.ts_text('period_utc')} AS period_utc, respondent,
       {R('solar_mwh', 2)} AS solar_mwh, {R('wind_mwh', 2)} AS wind_mwh,
       {R('nuclear_mwh', 2)} AS nuclear_mwh
FROM fuel_pivot""", "fuel_pivot"))
def q_fuel_pivot(spark, sf_dir):
    p = C.fuel_pivot(X.fuel_hourly(spark, sf_dir))
    return curve_text(p.select("period_utc", "respondent",
                                *[py_round(c, 2).alias(c) for c in C.PIVOT_FUELS]))


_CURVE_SELECT = f"""
SELECT {O.ts_text('period_utc')} AS period_utc, respondent, demand_mwh, solar_mwh, wind_mwh,
       nuclear_mwh, net_load_mwh, residual_load_after_nuclear_mwh
FROM ba_duck_curve_hourly"""


@register("duck_curve", O.with_views(_CURVE_SELECT, "ba_duck_curve_hourly"))
def q_duck_curve(spark, sf_dir):
    return curve_text(curve(spark, sf_dir))


@register("load_columns", O.with_views(f"""
SELECT {O.ts_text('period_utc')} AS period_utc, respondent, net_load_mwh,
       residual_load_after_nuclear_mwh
FROM ba_duck_curve_hourly""", "ba_duck_curve_hourly"))
def q_load_columns(spark, sf_dir):
    return curve_text(curve(spark, sf_dir).select(
        "period_utc", "respondent", "net_load_mwh", "residual_load_after_nuclear_mwh"))


# -- profile

_PROFILE_COLS = list(D.PROFILE_FIELDS)


@register("duck_profile", O.with_views(f"""
SELECT spine.respondent, spine.hour, {', '.join(f"m.{n}" for n in _PROFILE_COLS)}
FROM spine LEFT JOIN m USING (respondent, hour)""", "ba_duck_curve_hourly", extra=[
    WHOLE_CTE,
    ("m", f"""SELECT respondent, {O.local_hour('period_utc', O.tz('respondent'))} AS hour,
        {', '.join(f'{M(src, 2)} AS {n}' for n, src in D.PROFILE_FIELDS.items())}
        FROM sl GROUP BY 1, 2"""),
    ("spine", "SELECT respondent, CAST(h AS BIGINT) AS hour FROM (SELECT DISTINCT respondent FROM sl) r, range(24) t(h)"),
]))
def q_duck_profile(spark, sf_dir):
    cs = curve(spark, sf_dir)
    return D.duck_profile(cs).withColumn("hour", F.col("hour").cast("bigint"))
