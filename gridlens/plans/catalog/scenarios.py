"""Catalogue: what-if scenarios (apply, summary, baseline comparison)."""

from __future__ import annotations

from gridlens.functions.rounding import sql_exact_sum as XS
from gridlens.functions.rounding import sql_py_round as R
from gridlens.operators import scenarios as SC
from gridlens.plans import oracle as O
from gridlens.plans.catalog.base import register, curve, curve_text


_SC_VALUES = ", ".join(f"('{l}', {i + 1}, {rm!r}, {na!r})"
                       for i, (l, rm, na) in enumerate(SC.DEFAULT_SCENARIOS))
_SC_ROWS = ("scr", f"""SELECT c.*, s.scenario, s.scenario_order, s.rm, s.na
    FROM ba_duck_curve_hourly c,
         (VALUES {_SC_VALUES}) s(scenario, scenario_order, rm, na)""")
_SC_APPLIED = ("sca", f"""SELECT scenario, scenario_order, period_utc, respondent, demand_mwh,
        {R('(solar_mwh * rm)', 2)} AS solar_mwh, {R('(wind_mwh * rm)', 2)} AS wind_mwh,
        {R('(nuclear_mwh * na)', 2)} AS nuclear_mwh,
        {R('(demand_mwh - solar_mwh * rm - wind_mwh * rm)', 2)} AS net_load_mwh,
        {R('(demand_mwh - solar_mwh * rm - wind_mwh * rm - nuclear_mwh * na)', 2)}
            AS residual_load_after_nuclear_mwh
    FROM scr""")


@register("apply_scenario", O.with_views(f"""
SELECT scenario, CAST(scenario_order AS INTEGER) AS scenario_order,
       {O.ts_text('period_utc')} AS period_utc, respondent, demand_mwh, solar_mwh, wind_mwh,
       nuclear_mwh, net_load_mwh, residual_load_after_nuclear_mwh FROM sca""",
    "ba_duck_curve_hourly", extra=[_SC_ROWS, _SC_APPLIED]))
def q_apply_scenario(spark, sf_dir):
    return curve_text(SC.scenario_curves(curve(spark, sf_dir), with_baseline=False))


_SC_ALL = ("scall", """SELECT 'baseline' AS scenario, 0 AS scenario_order, period_utc, respondent,
        demand_mwh, solar_mwh, wind_mwh, nuclear_mwh, net_load_mwh, residual_load_after_nuclear_mwh
    FROM ba_duck_curve_hourly
    UNION ALL SELECT * FROM sca""")


def _summary_sql(src: str) -> str:
    share = (f"CASE WHEN {XS('demand_mwh')} <> 0 THEN "
             + R(f"(({XS('solar_mwh')} + {XS('wind_mwh')}) / {XS('demand_mwh')})", 4) + " ELSE 0.0 END")
    return f"""
SELECT scenario, CAST(scenario_order AS INTEGER) AS scenario_order, respondent, count(*) AS hours,
       {R('max(demand_mwh)', 1)} AS peak_demand_mwh,
       {R('min(net_load_mwh)', 1)} AS min_net_load_mwh,
       {R('coalesce(max(ramp), 0.0)', 1)} AS max_hourly_ramp_mwh,
       {R('max(residual_load_after_nuclear_mwh)', 1)} AS peak_residual_mwh,
       count(CASE WHEN net_load_mwh < 0 THEN 1 END) AS curtailment_hours,
       {share} AS renewable_share
FROM (SELECT *, abs(net_load_mwh - lag(net_load_mwh) OVER
        (PARTITION BY scenario, respondent ORDER BY period_utc)) AS ramp FROM {src})
GROUP BY scenario, scenario_order, respondent"""


@register("scenario_summary", O.with_views(_summary_sql("sca"), "ba_duck_curve_hourly",
                                           extra=[_SC_ROWS, _SC_APPLIED]))
def q_scenario_summary(spark, sf_dir):
    return SC.scenario_summary(SC.scenario_curves(curve(spark, sf_dir), with_baseline=False))


@register("scenario_compare", O.with_views(_summary_sql("scall"), "ba_duck_curve_hourly",
                                           extra=[_SC_ROWS, _SC_APPLIED, _SC_ALL]))
def q_scenario_compare(spark, sf_dir):
    return SC.scenario_compare(curve(spark, sf_dir))
