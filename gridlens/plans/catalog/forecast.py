"""Catalogue: forecast features, split, persistence baseline and the GBT forecast."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from gridlens.functions.rounding import py_round
from gridlens.functions.rounding import sql_py_round as R
from gridlens.operators import forecast as FC
from gridlens.plans import oracle as O
from gridlens.plans.catalog.base import register, curve, curve_text


_TWO_PI = f"{2.0 * math.pi!r}"
_LONG = ("ls", """SELECT respondent, 'solar' AS series, period_utc, solar_mwh AS y FROM ba_duck_curve_hourly
    UNION ALL SELECT respondent, 'wind', period_utc, wind_mwh FROM ba_duck_curve_hourly""")
_W = "PARTITION BY respondent, series ORDER BY period_utc"
_U = "CAST(round_even(y * 100.0, 0) AS BIGINT)"
_FEATS = ("ft", f"""SELECT respondent, series, period_utc, y,
        {R(f'sin({_TWO_PI} * CAST(hour(period_utc) AS DOUBLE) / 24.0)', 9)} AS hour_sin,
        {R(f'cos({_TWO_PI} * CAST(hour(period_utc) AS DOUBLE) / 24.0)', 9)} AS hour_cos,
        CAST(isodow(period_utc) - 1 AS DOUBLE) AS dow,
        {R(f'sin({_TWO_PI} * CAST(dayofyear(period_utc) AS DOUBLE) / 365.25)', 9)} AS doy_sin,
        {R(f'cos({_TWO_PI} * CAST(dayofyear(period_utc) AS DOUBLE) / 365.25)', 9)} AS doy_cos,
        row_number() OVER ({_W}) - 1 AS row_index,
        lag(y, 1) OVER ({_W}) AS lag_1,
        lag(y, 24) OVER ({_W}) AS lag_24,
        CASE WHEN count({_U}) OVER ({_W} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) > 0 THEN
            CAST(sum({_U}) OVER ({_W} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS DOUBLE)
            / (CAST(count({_U}) OVER ({_W} ROWS BETWEEN 24 PRECEDING AND 1 PRECEDING) AS DOUBLE) * 100.0)
        END AS roll_24
    FROM ls""")
_SAMPLES = ("smp", """SELECT *, lag_24 AS persistence, row_index - 24 AS sample_index,
        count(*) OVER (PARTITION BY respondent, series) AS n_samples,
        CAST(floor(count(*) OVER (PARTITION BY respondent, series) * 0.75) AS BIGINT) AS split
    FROM ft WHERE row_index >= 24""")
_FC = [_LONG, _FEATS, _SAMPLES]


def _design(spark, sf_dir):
    return FC.design_matrix(FC.long_series(curve(spark, sf_dir)))


def _trig9(df):
    for c in ("hour_sin", "hour_cos", "doy_sin", "doy_cos"):
        df = df.withColumn(c, py_round(c, 9))
    return df


@register("calendar_features", O.with_views(f"""
SELECT DISTINCT respondent, {O.ts_text('period_utc')} AS period_utc, hour_sin, hour_cos, dow,
       doy_sin, doy_cos FROM ft""", "ba_duck_curve_hourly", extra=_FC[:2]))
def q_calendar_features(spark, sf_dir):
    c = FC.calendar_features(curve(spark, sf_dir).select("respondent", "period_utc"))
    return curve_text(_trig9(c))


@register("lag_features", O.with_views(f"""
SELECT respondent, series, {O.ts_text('period_utc')} AS period_utc, y, lag_1, lag_24 FROM ft""",
    "ba_duck_curve_hourly", extra=_FC[:2]))
def q_lag_features(spark, sf_dir):
    levels = FC.level_features(FC.long_series(curve(spark, sf_dir)))
    return curve_text(levels.select("respondent", "series", "period_utc", "y", "lag_1", "lag_24"))


@register("rolling_mean_24", O.with_views(f"""
SELECT respondent, series, {O.ts_text('period_utc')} AS period_utc, roll_24 FROM ft""",
    "ba_duck_curve_hourly", extra=_FC[:2]))
def q_rolling_mean_24(spark, sf_dir):
    levels = FC.level_features(FC.long_series(curve(spark, sf_dir)))
    return curve_text(levels.select("respondent", "series", "period_utc", "roll_24"))


@register("persistence", O.with_views(f"""
SELECT respondent, series, {O.ts_text('period_utc')} AS period_utc, y, persistence FROM smp""",
    "ba_duck_curve_hourly", extra=_FC))
def q_persistence(spark, sf_dir):
    d = _design(spark, sf_dir)
    return curve_text(d.select("respondent", "series", "period_utc", "y", "persistence"))


@register("chrono_split", O.with_views(f"""
SELECT respondent, series, {O.ts_text('period_utc')} AS period_utc, sample_index, n_samples,
       split, sample_index < split AS is_train FROM smp""", "ba_duck_curve_hourly", extra=_FC))
def q_chrono_split(spark, sf_dir):
    d = _design(spark, sf_dir)
    return curve_text(d.select("respondent", "series", "period_utc", F.col("sample_index").cast("bigint"),
                                "n_samples", "split", "is_train"))


@register("design_matrix", O.with_views(f"""
SELECT respondent, series, {O.ts_text('period_utc')} AS period_utc, row_index,
       {', '.join(FC.FEATURES)}, y, persistence FROM smp""", "ba_duck_curve_hourly", extra=_FC))
def q_design_matrix(spark, sf_dir):
    d = _trig9(_design(spark, sf_dir))
    return curve_text(d.select("respondent", "series", "period_utc",
                                F.col("row_index").cast("bigint"), *FC.FEATURES, "y", "persistence"))


_PM_D = "(CAST(round_even(y * 100.0, 0) AS BIGINT) - CAST(round_even(persistence * 100.0, 0) AS BIGINT))"


@register("persistence_metrics", O.with_views(f"""
SELECT respondent, series, max(split) AS n_train, max(n_samples) - max(split) AS n_test,
       sqrt(CAST(sum({_PM_D} * {_PM_D}) AS DOUBLE) / (CAST(count(*) AS DOUBLE) * 10000.0))
           AS rmse_persistence,
       CAST(sum(abs({_PM_D})) AS DOUBLE) / (CAST(count(*) AS DOUBLE) * 100.0) AS mae_persistence
FROM smp WHERE sample_index >= split GROUP BY respondent, series""",
    "ba_duck_curve_hourly", extra=_FC))
def q_persistence_metrics(spark, sf_dir):
    """The deterministic half of the skill score: the 24-row persistence baseline on
    the test tail, from exact integer hundredths."""
    return FC.persistence_metrics(_design(spark, sf_dir))


# The scoring operators with a prediction that both sides can compute: the latest value
# carried on along the last day's change, which falls below zero often enough to test the floor.
_PRED = ("prd", """SELECT respondent, series, period_utc, sample_index, n_samples, split, y AS truth, persistence,
    greatest(2.0 * lag_1 - lag_24, 0.0) AS prediction FROM smp WHERE sample_index >= split""")


def _predicted(spark, sf_dir):
    d = _design(spark, sf_dir)
    test = d.where(~F.col("is_train")).withColumn("prediction", F.lit(2.0) * F.col("lag_1") - F.col("lag_24"))
    return FC.clipped(test), d


@register("predict_clip", O.with_views(f"""
SELECT respondent, series, {O.ts_text('period_utc')} AS period_utc, CAST(sample_index AS BIGINT) AS sample_index,
       truth, prediction, persistence FROM prd""", "ba_duck_curve_hourly", extra=[*_FC, _PRED]))
def q_predict_clip(spark, sf_dir):
    return curve_text(_predicted(spark, sf_dir)[0].withColumn("sample_index", F.col("sample_index").cast("bigint")))


_METRICS_SQL = """SELECT respondent, series, max(split) AS n_train, max(n_samples) - max(split) AS n_test,
    sqrt(avg((truth - prediction) ** 2)) AS rmse_model, sqrt(avg((truth - persistence) ** 2)) AS rmse_persistence,
    avg(abs(truth - prediction)) AS mae_model FROM prd GROUP BY respondent, series"""


@register("forecast_metrics", O.with_views(f"""
SELECT respondent, series, n_train, n_test, round(rmse_model, 6) AS rmse_model,
       round(rmse_persistence, 6) AS rmse_persistence, round(mae_model, 6) AS mae_model
FROM ({_METRICS_SQL})""", "ba_duck_curve_hourly", extra=[*_FC, _PRED]))
def q_forecast_metrics(spark, sf_dir):
    m = FC.forecast_metrics(*_predicted(spark, sf_dir))
    return m.select("respondent", "series", "n_train", "n_test",
                    *(F.round(c, 6).alias(c) for c in ("rmse_model", "rmse_persistence", "mae_model")))


@register("skill_score", O.with_views(f"""
SELECT respondent, series, round(CASE WHEN rmse_persistence > 0 THEN 1 - rmse_model / rmse_persistence
       ELSE 'nan'::DOUBLE END, 9) AS skill_score FROM ({_METRICS_SQL})""", "ba_duck_curve_hourly", extra=[*_FC, _PRED]))
def q_skill_score(spark, sf_dir):
    m = FC.forecast_metrics(*_predicted(spark, sf_dir))
    return m.select("respondent", "series", F.round("skill_score", 9).alias("skill_score"))


_TERMS = {"one": "1.0", **{f"{f}_{k}": f"{f}({2.0 * math.pi / 24.0!r} * CAST(hour(period_utc) AS DOUBLE) * {k})"
                           for k in range(1, FC.HARMONICS + 1) for f in ("sin", "cos")},
          **{f"{f}_rel": f"{f} / level" for f in ("lag_1", "lag_24", "roll_24")}}
_PAIRS = [(a, b) for i, a in enumerate(_TERMS) for b in list(_TERMS)[i:]] + [(a, "y_rel") for a in _TERMS]
_SCALED = ("scl", f"""SELECT respondent, series, y / level AS y_rel, {', '.join(f'{e} AS "{n}"' for n, e in _TERMS.items())}
    FROM (SELECT *, avg(abs(y)) OVER (PARTITION BY respondent, series) AS level FROM smp
          WHERE sample_index < split AND n_samples >= {FC.MIN_SAMPLES})""")


@register("normal_equations", O.with_views(f"""
SELECT respondent, series, x.term, x.other, round(x.value, 6) + 0.0 AS value FROM (SELECT respondent, series, unnest([{', '.join(
    f"{{'term': '{a}', 'other': '{b}', 'value': sum({a} * {b})}}" for a, b in _PAIRS)}]) AS x FROM scl GROUP BY respondent, series)""",
    "ba_duck_curve_hourly", extra=[*_FC, _SCALED]))
def q_normal_equations(spark, sf_dir):
    """The sums behind every series' linear part, one row per pair of terms."""
    sums = FC.normal_equations(FC.scaled_rows(_design(spark, sf_dir))).select("respondent", "series", F.concat("xx", "xy").alias("v"))
    names = F.array(*[F.struct(F.lit(a).alias("term"), F.lit(b).alias("other")) for a, b in _PAIRS])
    return sums.select("respondent", "series", F.explode(F.arrays_zip(names.alias("p"), "v")).alias("x")).select(
        "respondent", "series", "x.p.term", "x.p.other", (F.round("x.v", 6) + F.lit(0.0)).alias("value"))  # + 0.0: no negative zeros


@register("forecast_renewables", None)
def q_forecast_renewables(spark, sf_dir):
    m = FC.forecast_renewables(curve(spark, sf_dir))
    return m.select("respondent", "series", "n_train", "n_test", "rmse_model",
                    "rmse_persistence", "mae_model", "skill_score")
