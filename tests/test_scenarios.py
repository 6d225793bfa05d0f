import pytest
from pyspark.sql import functions as F

from gridlens.operators import scenarios as SC
from gridlens.operators.curve import load_columns


def structured_curve(spark, days, respondent="DEMO", scale=1.0):
    """An hourly series whose parts follow simple shapes: a parabola of sun between 5 and 19
    o'clock that varies from day to day, wind that drifts over days, demand with a weekday
    step and an evening hump, and steady nuclear.  Two decimals, as stored."""
    n = F.col("id")
    hour, day = (n % 24).cast("double"), F.floor(n / 24)

    def jitter(key, salt):
        return F.pmod(F.hash(key, F.lit(salt)), F.lit(997)).cast("double") / 997.0

    sun = F.greatest(F.lit(0.0), 1 - F.pow((hour - 12) / 7, 2)) * (0.4 + 0.6 * jitter(day, 1))
    drift = 1000 + 600 * F.sin(n / 31.0) + 250 * jitter(day, 2)
    evening = F.greatest(F.lit(0.0), 1 - F.abs(hour - 20) / 4)
    columns = {
        "demand_mwh": 18000 + 900 * (day % 7 < 5).cast("double") + 4100 * evening + 220 * jitter(n, 3),
        "solar_mwh": 9000 * sun + 40 * jitter(n, 4) * (sun > 0).cast("double"),
        "wind_mwh": drift + 90 * jitter(n, 5) + 300 * F.cos(hour / 24 * 6.28),
        "nuclear_mwh": 1900 + 10 * jitter(n, 6)}
    start = F.lit("2025-04-01 00:00:00").cast("timestamp")
    return load_columns(spark.range(days * 24).select(
        (start + F.make_dt_interval(hours=n.cast("int"))).alias("period_utc"), F.lit(respondent).alias("respondent"),
        *(F.round(c * scale, 2).alias(name) for name, c in columns.items())))


def _summary(spark, curve, scenarios):
    rows = SC.scenario_compare(curve, scenarios).collect()
    return {r.scenario: r for r in rows}


def test_more_renewables_lower_net_load_and_raise_the_share(spark):
    s = _summary(spark, structured_curve(spark, 21), [("a little", 1.2, 1.0), ("a lot", 2.5, 1.0)])
    floor = [s[x].min_net_load_mwh for x in ("baseline", "a little", "a lot")]
    share = [s[x].renewable_share for x in ("baseline", "a little", "a lot")]
    spill = [s[x].curtailment_hours for x in ("baseline", "a little", "a lot")]
    assert floor == sorted(floor, reverse=True) and share == sorted(share) and spill == sorted(spill)
    assert floor[0] > floor[2] and share[0] < share[2] and spill[2] > 0
    assert {r.hours for r in s.values()} == {21 * 24}


def test_nuclear_only_moves_the_residual(spark):
    s = _summary(spark, structured_curve(spark, 14), {"half": {"nuclear_availability": 0.5}, "none": {"nuclear_availability": 0.0}})
    assert s["baseline"].peak_residual_mwh < s["half"].peak_residual_mwh < s["none"].peak_residual_mwh
    assert len({(r.min_net_load_mwh, r.max_hourly_ramp_mwh, r.renewable_share) for r in s.values()}) == 1


def test_comparison_equals_the_summary_of_each_scenarios_curve(spark):
    curve = structured_curve(spark, 5).union(structured_curve(spark, 3, "SMALL", 0.013))
    one = sorted(map(str, SC.scenario_compare(curve).collect()))
    two = sorted(map(str, SC.scenario_summary(SC.scenario_curves(curve)).collect()))
    assert one == two


def test_a_long_catalogue_is_not_refused(spark):
    many = [(f"s{i}", 1 + i / 1000, 1.0) for i in range(300)]
    assert SC.scenario_compare(structured_curve(spark, 1), many).count() == 301


def test_default_catalogue_and_share_scaling(spark):
    s = _summary(spark, structured_curve(spark, 10), None)
    assert list(s) and set(s) == {"baseline", *[l for l, _, _ in SC.DEFAULT_SCENARIOS]}
    assert s["2x renewables"].renewable_share == pytest.approx(2 * s["baseline"].renewable_share, abs=2e-4)
    assert s["nuclear at 50%"].min_net_load_mwh == s["baseline"].min_net_load_mwh


def test_apply_scenario_rounds_from_unrounded_values(spark):
    df = spark.createDataFrame([(100.0, 0.005, 0.005, 1.115)],
                               "demand_mwh double, solar_mwh double, wind_mwh double, nuclear_mwh double")
    r = SC.apply_scenario(df, renewable_multiplier=3.0, nuclear_availability=1.0).first()
    solar = 0.005 * 3.0
    assert r.solar_mwh == round(solar, 2)
    assert r.net_load_mwh == round(100.0 - solar - 0.005 * 3.0, 2)
    assert r.residual_load_after_nuclear_mwh == round(100.0 - solar - 0.005 * 3.0 - 1.115, 2)
