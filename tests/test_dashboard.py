import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from gridlens.operators import dashboard as D
from gridlens.operators.curve import duck_curve
from gridlens.schemas import CURVE_SCHEMA, FUEL_SCHEMA, OUTAGE_SCHEMA, REGION_SCHEMA

STAMP = dt.datetime(2025, 4, 1, 12)


@pytest.fixture
def tables(spark):
    curve = spark.createDataFrame([
        (STAMP, "CISO", 100.0, 30.0, 10.0, 20.0, 60.0, 40.0),
        (STAMP + dt.timedelta(hours=1), "CISO", 120.0, 25.0, 15.0, 20.0, 80.0, 60.0)], CURVE_SCHEMA)
    fuel = spark.createDataFrame([
        (STAMP, "CISO", "n", "SUN", "Solar", 30.0, STAMP),
        (STAMP + dt.timedelta(hours=1), "CISO", "n", "SUN", "Solar", 25.0, STAMP)], FUEL_SCHEMA)
    outage = spark.createDataFrame([(dt.date(2025, 4, 1), "1", "x", 1000.0, 125.0, 12.5, STAMP)],
                                   OUTAGE_SCHEMA)
    region = spark.createDataFrame([(STAMP, "CISO", "n", "D", "Demand", 100.0, STAMP)], REGION_SCHEMA)
    return curve, fuel, outage, region


def test_dashboard_summary_profiles_and_outages(spark, tables):
    curve, fuel, outage, region = tables
    cs = D.date_range_slice(curve, "2025-04-01", "2025-04-01", ["CISO"])
    s = D.summary_cards(cs).first()
    assert (s.peak_demand_mwh, s.minimum_net_load_mwh, s.steepest_hourly_ramp_mwh) == (120.0, 60.0, 20.0)
    prof = D.duck_profile(cs).orderBy("hour").collect()
    assert len(prof) == 24
    filled = {r.hour: r.demand for r in prof if r.demand is not None}
    assert filled == {5: 100.0, 6: 120.0}  # 12:00Z and 13:00Z in Pacific daylight time
    days = D.outage_daily(D.outage_slice(outage, "2025-04-01", "2025-04-01")).first()
    assert (days.capacity_mw, days.outage_mw, days.available_mw) == (1000.0, 125.0, 875.0)
    assert D.outage_max(D.outage_daily(outage)).first()[0] == 125.0
    payload = json.loads(D.dashboard_payload(curve, fuel, outage, region, "2025-04-01",
                                             "2025-04-01", ["CISO"]).first().payload)
    assert payload["summary"]["peakDemandMwh"] == 120.0
    assert payload["summary"]["steepestHourlyRampMwh"] == 20.0
    assert len(payload["duckCurveProfile"]) == 24
    assert payload["duckCurveProfile"][0] == {"hour": 0}  # empty hour keeps only its hour
    assert payload["outageContext"]["maximumOutageMw"] == 125.0
    assert payload["outageContext"]["days"][0]["availableMw"] == 875.0
    mix = payload["generationMixProfile"][0]
    assert mix["fuelType"] == "SUN" and mix["values"][5] == 30.0 and mix["values"][0] == 0.0
    assert payload["coverage"] == {"hourlyRows": 2, "start": "2025-04-01T12:00:00Z",
                                   "end": "2025-04-01T13:00:00Z"}
    assert payload["freshness"] == "2025-04-01T12:00:00Z"


def test_outage_max_defaults_to_zero(spark, tables):
    _, _, outage, _ = tables
    assert D.outage_max(D.outage_daily(D.outage_slice(outage, "2020-01-01", "2020-01-02"))).first()[0] == 0.0


def test_single_row_ramp_is_zero(spark, tables):
    curve = tables[0].where(F.col("demand_mwh") == 100.0)
    assert D.summary_cards(curve).first().steepest_hourly_ramp_mwh == 0.0


def test_rejects_reversed_range_and_empty_selection(spark, tables):
    with pytest.raises(D.SelectionError) as err:
        D.date_range_slice(tables[0], "2025-04-02", "2025-04-01")
    assert err.value.status == 400 and err.value.detail == "end must be on or after start"
    with pytest.raises(D.SelectionError) as err:
        D.require_rows(D.date_range_slice(tables[0], "2024-01-01", "2024-01-02"))
    assert err.value.status == 404
    with pytest.raises(D.SelectionError):
        D.check_selection("X", "2025-04-01", "2025-04-02")


def test_chart_profile_requires_every_hour(spark, tables):
    prof = D.chart_profile(tables[0])
    with pytest.raises(Exception, match="of 24"):
        D.full_profile(prof).collect()
    b = D.profile_bounds(prof).first()
    assert b.y_min == 0.0 and b.y_max == pytest.approx(120.0 * 1.08)


def test_stacked_mix_bands(spark):
    mix = spark.createDataFrame([("CISO", "SUN", "Solar", 5, 3000.0), ("CISO", "WND", "Wind", 5, 2500.0),
                                 ("CISO", "COL", "Coal", 5, -10.0)],
                                "respondent string, fuel_type string, fuel_name string, hour int, generation_mwh double")
    rows = {r.fuel_type: r for r in D.stacked_mix(mix).collect()}
    assert rows["COL"].clamped_mwh == 0.0
    assert rows["SUN"].lower_mwh == 0.0 and rows["SUN"].upper_mwh == 3000.0
    assert rows["WND"].lower_mwh == 3000.0 and rows["WND"].upper_mwh == 5500.0
    assert rows["WND"].axis_max_mwh == 10000


def test_local_hours_follow_daylight_saving(spark):
    # 2025-03-09 is the spring-forward day in Pacific time: 02:00 local does not exist
    rows = [(dt.datetime(2025, 3, 9, h), "CISO", 100.0 + h, 0.0, 0.0, 0.0, 100.0 + h, 100.0 + h)
            for h in (9, 10, 11)]
    curve = spark.createDataFrame(rows, CURVE_SCHEMA)
    prof = {r.hour: r.demand for r in D.duck_profile(curve).collect() if r.demand is not None}
    assert prof == {1: 109.0, 3: 110.0, 4: 111.0}
    # a respondent without a mapped zone stays on UTC
    erco = curve.withColumn("respondent", F.lit("ERCO"))
    assert {r.hour for r in D.duck_profile(erco).collect() if r.demand is not None} == {9, 10, 11}


def test_digits_beyond_hundredths_are_summed_before_rounding(spark):
    rows = [(dt.date(2025, 4, 1), str(i), 100.004, 10.004) for i in range(100)]
    df = spark.createDataFrame(rows, "period_date date, facility string, capacity_mw double, outage_mw double")
    r = D.outage_daily(df).first()
    assert (r.capacity_mw, r.outage_mw, r.available_mw) == (10000.4, 1000.4, 9000.0)


def test_documents_of_a_store_equal_those_of_its_curve(spark):
    """The pass over region and fuel rows gives the documents that the curve gives, hours without one side included."""
    hour = lambda h: STAMP + dt.timedelta(hours=h)
    region = [(hour(h), r, "n", m, "x", 100.0 + 7.13 * h, hour(h % 5)) for h in range(60) for r in ("CISO", "ERCO") for m in ("D", "NG") if h % 7]
    fuel = [(hour(h), r, "n", f, f.title(), 3.21 * h + len(f), STAMP) for h in range(60) for r in ("CISO", "ERCO", "MISO")
            for f in ("SUN", "WND", "NUC", "COL") if (h + len(r)) % 5]
    region, fuel = spark.createDataFrame(region, REGION_SCHEMA), spark.createDataFrame(fuel, FUEL_SCHEMA)
    outage = spark.createDataFrame([(dt.date(2025, 4, 2), "1", "x", 1000.0, 125.0, 12.5, STAMP)], OUTAGE_SCHEMA)
    days = ("2025-04-01", "2025-04-02")
    fuels = fuel.where(F.to_date("period_utc") <= "2025-04-02")
    one = {r.respondent: json.loads(r.payload) for r in D.dashboard_documents(D.grid_hours(region, fuels), outage, *days).collect()}
    two = {r.respondent: json.loads(r.payload) for r in D.dashboard_payload(duck_curve(region, fuel), fuels, outage, region, *days).collect()}
    assert one == two and set(one) == {"CISO", "ERCO"}
    slice_ = D.date_range_slice(duck_curve(region, fuel), *days)
    for c in D.summary_cards(slice_, with_coverage=True).collect():
        got = one[c.respondent]["summary"]
        assert (got["peakDemandMwh"], got["minimumNetLoadMwh"], got["steepestHourlyRampMwh"], got["averageNuclearMwh"]) == (
            c.peak_demand_mwh, c.minimum_net_load_mwh, c.steepest_hourly_ramp_mwh, c.average_nuclear_mwh)
        assert one[c.respondent]["coverage"]["hourlyRows"] == c.hourly_rows
