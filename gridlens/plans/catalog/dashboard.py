"""Catalogue: dashboard slices, lookups, profiles, mix, outages, cards, store-side reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.functions.rounding import py_round
from gridlens.functions.rounding import sql_exact_mean as XM
from gridlens.functions.rounding import sql_exact_sum as XS
from gridlens.functions.rounding import sql_py_mean as M
from gridlens.functions.rounding import sql_py_round as R
from gridlens.functions.timefmt import respondent_timezone, utc_iso
from gridlens.operators import dashboard as D
from gridlens.operators.windows import hourly_ramp
from gridlens.plans import oracle as O
from gridlens.sources import fixtures as X
from gridlens.sources import store as S
from gridlens.plans.catalog.base import (
    register,
    DASH_START,
    DASH_END,
    SQL_LO,
    SQL_HI,
    curve,
    curve_text,
    dash_slice,
    SLICE_CTE,
    FUEL_SLICE_CTE,
    OUTAGE_SLICE_CTE,
    outage_slice_rows,
    FACET,
    WHOLE_CTE,
    FUEL_WHOLE_CTE,
    OUTAGE_WHOLE_CTE,
    date_text,
)


# -- selection, lookups

@register("date_range_slice", O.with_views(f"""
SELECT {O.ts_text('period_utc')} AS period_utc, respondent, demand_mwh, solar_mwh, wind_mwh,
       nuclear_mwh, net_load_mwh, residual_load_after_nuclear_mwh FROM sl""",
    "ba_duck_curve_hourly", extra=[SLICE_CTE]))
def q_date_range_slice(spark, sf_dir):
    return curve_text(dash_slice(spark, sf_dir))


@register("fuel_slice", O.with_views(f"""
SELECT {O.ts_text('period_utc')} AS period_utc, respondent, fuel_type, fuel_name, generation_mwh
FROM fsl""", "grid_fuel_hourly", extra=[FUEL_SLICE_CTE]))
def q_fuel_slice(spark, sf_dir):
    return curve_text(D.fuel_slice(X.fuel_hourly(spark, sf_dir, DASH_START, DASH_END), DASH_START, DASH_END, [FACET]))


@register("outage_slice", O.with_views(f"""
SELECT strftime(period_date, '%Y-%m-%d') AS period_date, facility, facility_name, capacity_mw,
       outage_mw, percent_outage, {O.iso('ingested_at_utc')} AS ingested_at_utc
FROM osl""", "nuclear_facility_daily", extra=[OUTAGE_SLICE_CTE]))
def q_outage_slice(spark, sf_dir):
    o = outage_slice_rows(spark, sf_dir)
    return o.select(date_text("period_date"), "facility", "facility_name", "capacity_mw",
                    "outage_mw", "percent_outage",
                    utc_iso("ingested_at_utc").alias("ingested_at_utc"))


@register("respondent_timezone", O.with_views(f"""
SELECT DISTINCT respondent, {O.tz('respondent')} AS timezone FROM ba_duck_curve_hourly""",
    "ba_duck_curve_hourly"))
def q_respondent_timezone(spark, sf_dir):
    return (curve(spark, sf_dir).select("respondent").distinct()
            .withColumn("timezone", respondent_timezone("respondent")))


@register("authorities", O.with_views(f"""
SELECT respondent, {O.ts_text('min(period_utc)')} AS start, {O.ts_text('max(period_utc)')} AS "end",
       {O.tz('respondent')} AS timezone
FROM ba_duck_curve_hourly GROUP BY respondent""", "ba_duck_curve_hourly"))
def q_authorities(spark, sf_dir):
    a = D.authorities(curve(spark, sf_dir))
    return a.select("respondent", utc_iso("start").alias("start"), utc_iso("end").alias("end"),
                    "timezone")


# -- chart profile

_CHART_M = ("cm", f"""SELECT respondent,
        {O.local_hour('period_utc', "'America/Los_Angeles'")} AS hour,
        {', '.join(f'{R(XM(src), 6)} AS {n}' for n, src in D.CHART_FIELDS.items())},
        count(*) AS rows
    FROM ba_duck_curve_hourly GROUP BY 1, 2""")


def _chart(spark, sf_dir):
    """To six decimals: net and residual load are differences, whose last bits are noise."""
    profile = D.full_profile(D.chart_profile(curve(spark, sf_dir)))
    return profile.withColumns({n: py_round(n, 6) for n in D.CHART_FIELDS})


@register("chart_profile", O.with_views(
    "SELECT respondent, hour, demand, net_load, residual_after_nuclear, rows FROM cm",
    "ba_duck_curve_hourly", extra=[_CHART_M]))
def q_chart_profile(spark, sf_dir):
    return _chart(spark, sf_dir)


@register("profile_bounds", O.with_views("""
SELECT respondent, least(0.0, min(least(demand, net_load, residual_after_nuclear))) AS y_min,
       max(greatest(demand, net_load, residual_after_nuclear)) * 1.08 AS y_max
FROM cm GROUP BY respondent""", "ba_duck_curve_hourly", extra=[_CHART_M]))
def q_profile_bounds(spark, sf_dir):
    return D.profile_bounds(_chart(spark, sf_dir))


# -- generation mix

_MIX = [
    FUEL_WHOLE_CTE,
    ("mm", f"""SELECT respondent, fuel_type, fuel_name,
        {O.local_hour('period_utc', O.tz('respondent'))} AS hour,
        {M('generation_mwh', 2)} AS mean_mwh
        FROM fsl GROUP BY 1, 2, 3, 4"""),
    ("mspine", """SELECT k.*, CAST(h AS BIGINT) AS hour
        FROM (SELECT DISTINCT respondent, fuel_type, fuel_name FROM fsl) k, range(24) t(h)"""),
    ("mix", """SELECT s.respondent, s.fuel_type, s.fuel_name, s.hour,
        coalesce(mm.mean_mwh, 0.0) AS generation_mwh
        FROM mspine s LEFT JOIN mm USING (respondent, fuel_type, fuel_name, hour)"""),
]


def _mix(spark, sf_dir):
    fs = X.fuel_hourly(spark, sf_dir)
    return D.mix_profile(fs).withColumn("hour", F.col("hour").cast("bigint"))


@register("mix_profile", O.with_views("SELECT * FROM mix", "grid_fuel_hourly", extra=_MIX))
def q_mix_profile(spark, sf_dir):
    return _mix(spark, sf_dir)


@register("stacked_mix", O.with_views(f"""
SELECT respondent, fuel_type, fuel_name, hour, generation_mwh, clamped_mwh,
       {R('upper_raw', 2)} AS upper_mwh, {R('upper_raw - clamped_mwh', 2)} AS lower_mwh,
       {R('total_raw', 2)} AS hour_total_mwh,
       CAST(ceil(max({R('total_raw', 2)}) OVER (PARTITION BY respondent) / 5000.0) * 5000 AS BIGINT)
           AS axis_max_mwh
FROM (SELECT *,
        sum(clamped_mwh) OVER (PARTITION BY respondent, hour ORDER BY fuel_type, fuel_name
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upper_raw,
        sum(clamped_mwh) OVER (PARTITION BY respondent, hour) AS total_raw
      FROM (SELECT *, greatest(generation_mwh, 0.0) AS clamped_mwh FROM mix))""",
    "grid_fuel_hourly", extra=_MIX))
def q_stacked_mix(spark, sf_dir):
    st = D.stacked_mix(_mix(spark, sf_dir))
    return st.select("respondent", "fuel_type", "fuel_name", "hour", "generation_mwh",
                     "clamped_mwh", py_round("upper_mwh", 2).alias("upper_mwh"),
                     py_round("lower_mwh", 2).alias("lower_mwh"),
                     py_round("hour_total_mwh", 2).alias("hour_total_mwh"),
                     F.col("axis_max_mwh").cast("bigint").alias("axis_max_mwh"))


# -- outages, cards

_ODAILY = ("od", f"""SELECT period_date, {XS('capacity_mw')} AS cap, {XS('outage_mw')} AS outage_sum_mw
    FROM osl GROUP BY period_date""")


@register("outage_daily", O.with_views(f"""
SELECT strftime(period_date, '%Y-%m-%d') AS period_date, {R('cap', 2)} AS capacity_mw,
       {R('outage_sum_mw', 2)} AS outage_mw, {R('(cap - outage_sum_mw)', 2)} AS available_mw
FROM od""", "nuclear_facility_daily", extra=[OUTAGE_WHOLE_CTE, _ODAILY]))
def q_outage_daily(spark, sf_dir):
    d = D.outage_daily(X.outage_facility_daily(spark, sf_dir, named=False))
    return d.select(date_text("period_date"), "capacity_mw", "outage_mw", "available_mw")


@register("outage_max", O.with_views(f"""
SELECT {R('coalesce(max(outage_sum_mw), 0.0)', 2)} AS maximum_outage_mw FROM od""",
    "nuclear_facility_daily", extra=[OUTAGE_WHOLE_CTE, _ODAILY]))
def q_outage_max(spark, sf_dir):
    return D.outage_max(D.outage_daily(X.outage_facility_daily(spark, sf_dir, named=False)))


@register("freshness", O.with_views(f"""
SELECT respondent, {O.iso('max(ingested_at_utc)')} AS freshness
FROM grid_region_hourly GROUP BY respondent""", "grid_region_hourly"))
def q_freshness(spark, sf_dir):
    f = D.freshness(X.region_hourly(spark, sf_dir))
    return f.select("respondent", utc_iso("freshness").alias("freshness"))


@register("coverage", O.with_views(f"""
SELECT respondent, count(*) AS hourly_rows, {O.ts_text('min(period_utc)')} AS start,
       {O.ts_text('max(period_utc)')} AS "end"
FROM sl GROUP BY respondent""", "ba_duck_curve_hourly", extra=[WHOLE_CTE]))
def q_coverage(spark, sf_dir):
    c = D.coverage(curve(spark, sf_dir))
    return c.select("respondent", "hourly_rows", utc_iso("start").alias("start"),
                    utc_iso("end").alias("end"))


_RAMP = ("rp", """SELECT *, abs(net_load_mwh - lag(net_load_mwh, 1) OVER
        (PARTITION BY respondent ORDER BY period_utc)) AS ramp_mwh FROM sl""")


@register("hourly_ramp", O.with_views(f"""
SELECT {O.ts_text('period_utc')} AS period_utc, respondent, ramp_mwh FROM rp""",
    "ba_duck_curve_hourly", extra=[WHOLE_CTE, _RAMP]))
def q_hourly_ramp(spark, sf_dir):
    r = hourly_ramp(curve(spark, sf_dir), chunk="month")
    return curve_text(r.select("period_utc", "respondent", "ramp_mwh"))


@register("summary_cards", O.with_views(f"""
SELECT respondent, {R('max(demand_mwh)', 2)} AS peak_demand_mwh,
       {R('min(net_load_mwh)', 2)} AS minimum_net_load_mwh,
       {R('coalesce(max(ramp_mwh), 0.0)', 2)} AS steepest_hourly_ramp_mwh,
       {M('nuclear_mwh', 2)} AS average_nuclear_mwh
FROM rp GROUP BY respondent""", "ba_duck_curve_hourly", extra=[WHOLE_CTE, _RAMP]))
def q_summary_cards(spark, sf_dir):
    return D.summary_cards(curve(spark, sf_dir))


# The document in long form: one row per (respondent, item), read back from the JSON text.
_PAYLOAD = """timezone string, freshness string,
    coverage struct<hourlyRows: double, start: string, `end`: string>,
    summary struct<peakDemandMwh: double, minimumNetLoadMwh: double, steepestHourlyRampMwh: double, averageNuclearMwh: double>,
    duckCurveProfile array<struct<hour: int, demand: double, solar: double, wind: double, nuclear: double, netLoad: double,
        residualAfterNuclear: double>>,
    generationMixProfile array<struct<fuelType: string, fuelName: string, values: array<double>>>,
    outageContext struct<scope: string, maximumOutageMw: double,
        days: array<struct<date: string, capacityMw: double, outageMw: double, availableMw: double>>>"""
_PROFILE_NAMES = {"demand": "demand", "solar": "solar", "wind": "wind", "nuclear": "nuclear", "netLoad": "net_load",
                  "residualAfterNuclear": "residual_after_nuclear"}
_SUMMARY_NAMES = {"peakDemandMwh": "max(demand_mwh)", "minimumNetLoadMwh": "min(net_load_mwh)",
                  "steepestHourlyRampMwh": "coalesce(max(ramp_mwh), 0.0)"}
_DAY_NAMES = {"capacityMw": "cap", "outageMw": "outage_sum_mw", "availableMw": "cap - outage_sum_mw"}


def _payload_sql() -> str:
    number = "SELECT respondent, {item} AS item, CAST({value} AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM {src}"
    text = "SELECT respondent, '{item}' AS item, CAST(NULL AS DOUBLE) AS value, {value} AS text FROM {src}"
    whole = "sl GROUP BY respondent"
    rows = [text.format(item="timezone", value=O.tz("respondent"), src="spine WHERE hour = 0"),
            text.format(item="freshness", value=O.iso("max(ingested_at_utc)"),
                        src="grid_region_hourly WHERE respondent IN (SELECT respondent FROM spine) GROUP BY respondent"),
            number.format(item="'coverage.hourlyRows'", value="count(*)", src=whole),
            text.format(item="coverage.start", value=O.ts_text("min(period_utc)"), src=whole),
            text.format(item="coverage.end", value=O.ts_text("max(period_utc)"), src=whole)]
    rows += [number.format(item=f"'summary.{k}'", value=R(v, 2), src="rp GROUP BY respondent") for k, v in _SUMMARY_NAMES.items()]
    rows += [number.format(item="'summary.averageNuclearMwh'", value=M("nuclear_mwh", 2), src="rp GROUP BY respondent")]
    rows += [number.format(item=f"'profile.' || hour || '.{k}'", value=v, src="spine LEFT JOIN m USING (respondent, hour)")
             for k, v in _PROFILE_NAMES.items()]
    rows += [number.format(item="'mix.' || fuel_type || '.' || fuel_name || '.' || hour", value="generation_mwh",
                           src="mix WHERE respondent IN (SELECT respondent FROM spine)")]
    each = "od, (SELECT DISTINCT respondent FROM spine)"
    rows += [text.format(item="outage.scope", value=f"'{D.OUTAGE_SCOPE}'", src="spine WHERE hour = 0"),
             number.format(item="'outage.maximumOutageMw'", value=R("coalesce(max(outage_sum_mw), 0.0)", 2),
                           src=f"{each} GROUP BY respondent")]
    rows += [number.format(item=f"'outage.' || strftime(period_date, '%Y-%m-%d') || '.{k}'", value=R(f"({v})", 2), src=each)
             for k, v in _DAY_NAMES.items()]
    return "\nUNION ALL ".join(rows)


_PAYLOAD_CTES = [
    SLICE_CTE,
    ("fsl", f"""SELECT period_utc, respondent, fuel_type, fuel_name, generation_mwh
        FROM grid_fuel_hourly WHERE period_utc >= {SQL_LO} AND period_utc < {SQL_HI}"""),
    ("osl", f"SELECT * FROM nuclear_facility_daily WHERE period_date BETWEEN DATE '{DASH_START}' AND DATE '{DASH_END}'"),
    ("m", f"""SELECT respondent, {O.local_hour('period_utc', O.tz('respondent'))} AS hour,
        {', '.join(f'{M(src, 2)} AS {n}' for n, src in D.PROFILE_FIELDS.items())}
        FROM sl GROUP BY 1, 2"""),
    ("spine", "SELECT respondent, CAST(h AS BIGINT) AS hour FROM (SELECT DISTINCT respondent FROM sl) r, range(24) t(h)"),
    *_MIX[1:], _ODAILY, _RAMP]


@register("dashboard_payload", O.with_views(_payload_sql(), "ba_duck_curve_hourly", "nuclear_facility_daily", extra=_PAYLOAD_CTES))
def q_dashboard_payload(spark, sf_dir):
    days = (DASH_START, DASH_END)
    hours = D.grid_hours(X.region_hourly(spark, sf_dir), X.fuel_hourly(spark, sf_dir, *days))
    docs = D.dashboard_documents(hours, X.outage_facility_daily(spark, sf_dir, *days, named=False), *days)
    p = F.col("p")

    def row(item, value=None, text=None):
        return F.struct((F.lit(item) if isinstance(item, str) else item).alias("item"),
                        (F.lit(None) if value is None else value).cast("double").alias("value"),
                        (F.lit(None) if text is None else text).cast("string").alias("text"))

    single = [row("timezone", text=p["timezone"]), row("freshness", text=p["freshness"]),
              row("coverage.hourlyRows", p["coverage"]["hourlyRows"]), row("coverage.start", text=p["coverage"]["start"]),
              row("coverage.end", text=p["coverage"]["end"]), row("outage.scope", text=p["outageContext"]["scope"]),
              row("outage.maximumOutageMw", p["outageContext"]["maximumOutageMw"])]
    single += [row(f"summary.{k}", p["summary"][k]) for k in (*_SUMMARY_NAMES, "averageNuclearMwh")]
    profile = F.flatten(F.transform(p["duckCurveProfile"], lambda h: F.array(*(
        row(F.concat(F.lit("profile."), h["hour"], F.lit(f".{k}")), h[k]) for k in _PROFILE_NAMES))))
    mix = F.flatten(F.transform(p["generationMixProfile"], lambda f: F.transform(f["values"], lambda v, i: row(
        F.concat(F.lit("mix."), f["fuelType"], F.lit("."), f["fuelName"], F.lit("."), i), v))))
    outage = F.flatten(F.transform(p["outageContext"]["days"], lambda d: F.array(*(
        row(F.concat(F.lit("outage."), d["date"], F.lit(f".{k}")), d[k]) for k in _DAY_NAMES))))
    parsed = docs.select("respondent", F.from_json("payload", _PAYLOAD).alias("p"))
    return parsed.select("respondent", F.explode(F.concat(F.array(*single), profile, mix, outage)).alias("r")).select(
        "respondent", "r.*")


# -- store-side reads

@register("read_duck_curve", O.with_views("""
SELECT strftime(period_utc, '%Y-%m-%dT%H:%M:%S+00:00') AS period_utc, respondent, demand_mwh,
       solar_mwh, wind_mwh, nuclear_mwh, net_load_mwh, residual_load_after_nuclear_mwh
FROM ba_duck_curve_hourly WHERE respondent = 'CISO' ORDER BY 1""", "ba_duck_curve_hourly"))
def q_read_duck_curve(spark, sf_dir):
    return S.read_duck_curve(curve(spark, sf_dir), FACET)


@register("table_counts", O.with_views("""
SELECT 'grid_region_hourly' AS view_name, count(*) AS row_count FROM grid_region_hourly
UNION ALL SELECT 'grid_fuel_hourly', count(*) FROM grid_fuel_hourly
UNION ALL SELECT 'nuclear_facility_daily', count(*) FROM nuclear_facility_daily
UNION ALL SELECT 'ba_duck_curve_hourly', count(*) FROM ba_duck_curve_hourly""",
    "ba_duck_curve_hourly", "nuclear_facility_daily"))
def q_table_counts(spark, sf_dir):
    return S.counts(X.hourly_keys(spark, sf_dir), X.outage_facility_daily(spark, sf_dir, named=False)).select("view_name", "row_count")
