import datetime as dt
import os
import re

import pytest
from landing import land_pages
from pyspark.sql import functions as F

from gridlens.plans.ingest import check_month, ingest_month
from gridlens.schemas import FUEL_SCHEMA, OUTAGE_SCHEMA, REGION_SCHEMA
from gridlens.sources import sinks
from gridlens.sources import store as S

STAMP = dt.datetime(2025, 5, 1)


def _fuel(spark, rows):
    return spark.createDataFrame(rows, FUEL_SCHEMA)


def test_upsert_replaces_rows_by_key(spark, workdir):
    first = [(STAMP, "CISO", "CISO", "SUN", "Solar", 1.0, STAMP)]
    second = [(STAMP, "CISO", "CISO", "SUN", "Solar", 2.0, STAMP)]
    assert S.upsert(spark, workdir, "grid_fuel_hourly", _fuel(spark, first)) == 1
    assert S.upsert(spark, workdir, "grid_fuel_hourly", _fuel(spark, second)) == 1
    rows = S.scan_table(spark, workdir, "grid_fuel_hourly").collect()
    assert len(rows) == 1 and rows[0].generation_mwh == 2.0


def test_last_arrival_inside_a_batch(spark):
    rows = spark.createDataFrame(
        [("k", 1, 0, 10.0), ("k", 1, 3, 30.0), ("k", 0, 9, 90.0), ("j", 0, 0, 5.0)],
        "key string, batch int, pos int, v double")
    got = {r.key: r.v for r in S.last_arrival(rows, ["key"], ["batch", "pos"]).collect()}
    assert got == {"k": 30.0, "j": 5.0}


def test_partition_layout(spark, workdir):
    S.upsert(spark, workdir, "grid_fuel_hourly",
             _fuel(spark, [(dt.datetime(2025, 4, 3, 5), "CISO", "n", "SUN", "Solar", 1.0, STAMP)]))
    base = os.path.join(workdir, "normalized", "grid_fuel_hourly")
    assert os.path.isdir(os.path.join(base, "respondent=CISO", "year=2025", "month=04"))
    S.upsert(spark, workdir, "nuclear_facility_daily", spark.createDataFrame(
        [(dt.date(2025, 4, 1), "1", "x", 10.0, 0.0, 0.0, STAMP)], OUTAGE_SCHEMA))
    assert os.path.isdir(os.path.join(workdir, "normalized", "nuclear_facility_daily",
                                      "year=2025", "month=04"))
    t = S.scan_table(spark, workdir, "grid_fuel_hourly")
    assert "year" not in t.columns and "month" not in t.columns


def test_duck_curve_view(spark, workdir):
    hour = dt.datetime(2025, 5, 1)
    S.upsert(spark, workdir, "grid_region_hourly", spark.createDataFrame(
        [(hour, "CISO", "n", "D", "Demand", 100.0, STAMP)], REGION_SCHEMA))
    S.upsert(spark, workdir, "grid_fuel_hourly", _fuel(spark, [
        (hour, "CISO", "n", "SUN", "Solar", 30.0, STAMP),
        (hour, "CISO", "n", "WND", "Wind", 10.0, STAMP),
        (hour, "CISO", "n", "NUC", "Nuclear", 20.0, STAMP)]))
    views = S.register_views(spark, workdir)
    row = spark.sql("SELECT net_load_mwh, residual_load_after_nuclear_mwh "
                    "FROM ba_duck_curve_hourly").first()
    assert tuple(row) == (60.0, 40.0)
    counts = {r.view_name: r.row_count for r in S.table_counts(views).collect()}
    assert counts == {"grid_region_hourly": 1, "grid_fuel_hourly": 3,
                      "nuclear_facility_daily": 0, "ba_duck_curve_hourly": 1}
    out = os.path.join(workdir, "export.csv")
    assert sinks.export_duck_curve_csv(views["ba_duck_curve_hourly"], out, respondent="CISO") == 1
    with open(out) as file:
        head, row = file.read().splitlines()
    assert head.startswith("period_utc,respondent,demand_mwh")
    assert row == "2025-05-01 00:00:00+00:00,CISO,100.0,30.0,10.0,20.0,60.0,40.0"


def _land_month(root):
    region = [{"period": f"2025-04-01T{h:02d}", "respondent": "CISO", "respondent-name": "Cal",
               "type": "D", "type-name": "Demand", "value": str(100 + h)} for h in range(3)]
    region.append({"period": "2025-04-01T00", "respondent": "ERCO", "respondent-name": "Tex",
                   "type": "D", "type-name": "Demand", "value": "7"})
    fuel = []
    for h in range(3):
        for code, name, v in (("SUN", "Solar", 30), ("WND", "Wind", 10), ("NUC", "Nuclear", 20)):
            fuel.append({"period": f"2025-04-01T{h:02d}", "respondent": "CISO",
                         "respondent-name": "Cal", "fueltype": code, "type-name": name,
                         "value": str(v + h)})
    outage = [{"period": "2025-04-01", "facility": "46", "facilityName": "Browns Ferry",
               "capacity": "3661.7", "outage": "1207.7", "percentOutage": "32.98"}]
    land_pages(os.path.join(root, "region"), region, page_size=2)
    land_pages(os.path.join(root, "fuel"), fuel, page_size=4)
    land_pages(os.path.join(root, "outage"), outage, page_size=2)


def test_ingest_month_end_to_end_and_idempotent(spark, workdir):
    landed = os.path.join(workdir, "landed")
    _land_month(landed)
    data = os.path.join(workdir, "data")
    args = dict(respondent="CISO", start=dt.date(2025, 4, 1), end=dt.date(2025, 4, 30))
    r1 = ingest_month(spark, data, landed, ingested_at_utc=dt.datetime(2025, 5, 1, tzinfo=dt.UTC), **args)
    assert (r1.region_rows, r1.fuel_rows, r1.outage_rows) == (3, 9, 1)  # ERCO is not requested
    first = sorted(map(tuple, r1.views["ba_duck_curve_hourly"].collect()))
    r2 = ingest_month(spark, data, landed, ingested_at_utc=dt.datetime(2025, 5, 2, tzinfo=dt.UTC), **args)
    assert (r2.region_rows, r2.fuel_rows, r2.outage_rows) == (3, 9, 1)
    assert sorted(map(tuple, r2.views["ba_duck_curve_hourly"].collect())) == first
    fresh = r2.views["grid_region_hourly"].agg(F.max("ingested_at_utc")).first()[0]
    assert fresh == dt.datetime(2025, 5, 2)  # the later run replaced whole rows


def _april(spark, workdir, landed):
    return ingest_month(spark, os.path.join(workdir, "data"), landed, respondent="CISO", start=dt.date(2025, 4, 1),
                        end=dt.date(2025, 4, 30), ingested_at_utc=dt.datetime(2025, 5, 1, tzinfo=dt.UTC))


def _region(hour, value="1", **other):
    return {"period": hour, "respondent": "CISO", "respondent-name": "Cal", "type": "D", "type-name": "Demand",
            "value": value} | other


@pytest.mark.parametrize("record", [_region(None), _region("soon"), _region("2025-04-01T00", None), _region("2025-04-01T00", "12d")])
def test_a_bad_record_fails_the_ingest(spark, workdir, record):
    landed = os.path.join(workdir, "landed")
    _land_month(landed)
    land_pages(os.path.join(landed, "region"), [_region("2025-04-01T00"), record], page_size=1)
    with pytest.raises(Exception):
        _april(spark, workdir, landed)


def test_an_unpadded_period_is_ingested(spark, workdir):
    landed = os.path.join(workdir, "landed")
    _land_month(landed)
    land_pages(os.path.join(landed, "region"), [_region("2025-04-01T00"), _region("2025-4-1T5"), _region("2025-5-1T0")], page_size=3)
    got = _april(spark, workdir, landed).views["grid_region_hourly"].collect()
    # three records of three: the page at offset 2, left from the longer landing, is behind the stop
    assert sorted(r.period_utc.hour for r in got if r.period_utc.day == 1) == [0, 5]


def test_incomplete_or_unreadable_landings_fail_before_anything_is_written(spark, workdir):
    data = os.path.join(workdir, "data")
    short = os.path.join(workdir, "short")
    _land_month(short)
    land_pages(os.path.join(short, "outage"), [{"period": "2025-04-01", "facility": "46", "facilityName": "B",
               "capacity": "1", "outage": "1", "percentOutage": "1"}], total=9)
    with pytest.raises(ValueError, match="1 of 9"):
        _april(spark, workdir, short)
    broken = os.path.join(workdir, "broken")
    _land_month(broken)
    page = sorted(os.listdir(os.path.join(broken, "region")))[0]
    with open(os.path.join(broken, "region", page)) as file:
        text = file.read()
    with open(os.path.join(broken, "region", page), "w") as file:
        file.write(text[:len(text) // 2])
    with pytest.raises(Exception):
        _april(spark, workdir, broken)
    empty = os.path.join(workdir, "empty")
    _land_month(empty)
    with open(os.path.join(empty, "fuel", page), "w") as file:
        file.write("{}")
    with pytest.raises(Exception):
        _april(spark, workdir, empty)
    assert not os.path.exists(data)


def test_holes_and_overlaps_between_pages_are_refused(spark, workdir):
    for name, offsets, text in (("hole", (0, 4), "2 missing and 0 repeated"), ("overlap", (0, 1, 3), "0 missing and 1 repeated")):
        landed = os.path.join(workdir, name)
        _land_month(landed)
        region = os.path.join(landed, "region")
        land_pages(region, [_region("2025-04-01T00"), _region("2025-04-01T01")], page_size=2, total=6)
        page = os.path.join(region, "offset=000000000000.json")
        with open(page) as file:
            envelope = file.read()
        os.replace(os.path.join(region, "offset=000000000002.json"), page + ".bak")
        for offset in offsets:
            with open(os.path.join(region, f"offset={offset:012d}.json"), "w") as file:
                file.write(envelope)
        os.replace(page + ".bak", os.path.join(workdir, f"{name}.bak"))
        with pytest.raises(ValueError, match=text):
            _april(spark, workdir, landed)
    assert not os.path.exists(os.path.join(workdir, "data"))


def test_ingest_month_checks():
    with pytest.raises(ValueError, match="one month per call"):
        check_month(dt.date(2025, 4, 1), dt.date(2025, 5, 1))
    with pytest.raises(ValueError, match="end must be on or after start"):
        check_month(dt.date(2025, 4, 5), dt.date(2025, 4, 1))


def test_dashboard_request_over_the_store(spark, workdir):
    from gridlens.operators.dashboard import SelectionError
    from gridlens.plans.dashboard import authorities_request, dashboard_request
    data = os.path.join(workdir, "data")
    with pytest.raises(SelectionError) as err:
        dashboard_request(spark, data)
    assert err.value.status == 503
    landed = os.path.join(workdir, "landed")
    _land_month(landed)
    ingest_month(spark, data, landed, respondent="CISO", start=dt.date(2025, 4, 1),
                 end=dt.date(2025, 4, 30), ingested_at_utc=dt.datetime(2025, 5, 1, tzinfo=dt.UTC))
    doc = dashboard_request(spark, data, "CISO", "2025-04-01", "2025-04-01")
    assert doc["coverage"]["hourlyRows"] == 3
    assert doc["summary"]["peakDemandMwh"] == 102.0
    assert doc["outageContext"]["maximumOutageMw"] == 1207.7
    assert doc["freshness"] == "2025-05-01T00:00:00Z"
    with pytest.raises(SelectionError) as err:
        dashboard_request(spark, data, "CISO", "2025-04-02", "2025-04-01")
    assert err.value.status == 400
    with pytest.raises(SelectionError) as err:
        dashboard_request(spark, data, "CISO", "2025-04-10", "2025-04-11")
    assert err.value.status == 404
    assert authorities_request(spark, data) == [
        {"respondent": "CISO", "start": "2025-04-01T00:00:00Z", "end": "2025-04-01T02:00:00Z",
         "timezone": "America/Los_Angeles"}]


def test_views_prune_month_partitions(spark, workdir):
    rows = [(dt.datetime(2025, m, 3, 5), "CISO", "n", "SUN", "Solar", float(m), STAMP) for m in (3, 4, 5)]
    S.upsert(spark, workdir, "grid_fuel_hourly", _fuel(spark, rows))
    views = S.register_views(spark, workdir, "2025-04-01", "2025-04-30")
    got = views["grid_fuel_hourly"]
    assert [r.generation_mwh for r in got.collect()] == [4.0]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "202504" in plan
    assert S.register_views(spark, workdir)["grid_fuel_hourly"].count() == 3


def test_last_arrival_with_a_hot_key(spark):
    # one key holds a third of all rows, spread over many partitions
    hot = [("hot", i % 3, i, float(i)) for i in range(3000)]
    cold = [(f"k{i}", 0, i, float(i)) for i in range(6000)]
    df = spark.createDataFrame(hot + cold, "key string, batch int, seq int, v double").repartition(16)
    got = {r.key: r.v for r in S.last_arrival(df, ["key"], ["batch", "seq"]).collect()}
    assert len(got) == 6001
    assert got["hot"] == float(max(i for i in range(3000) if i % 3 == 2))
    assert got["k5999"] == 5999.0


def test_upsert_touches_only_its_partitions(spark, workdir):
    april = [(dt.datetime(2025, 4, 1, h), "CISO", "n", "SUN", "Solar", 1.0, STAMP) for h in range(3)]
    may = [(dt.datetime(2025, 5, 1, h), "CISO", "n", "SUN", "Solar", 2.0, STAMP) for h in range(2)]
    assert S.upsert(spark, workdir, "grid_fuel_hourly", _fuel(spark, april)) == 3
    assert S.upsert(spark, workdir, "grid_fuel_hourly", _fuel(spark, may)) == 2  # touched rows only
    rows = S.scan_table(spark, workdir, "grid_fuel_hourly").collect()
    assert sorted((r.period_utc.month, r.generation_mwh) for r in rows) == [
        (4, 1.0), (4, 1.0), (4, 1.0), (5, 2.0), (5, 2.0)]


def test_upsert_reads_only_the_partitions_it_touches(spark, workdir):
    history = [(dt.datetime(2025, m, 3, 5), "CISO", "n", "SUN", "Solar", float(m), STAMP) for m in range(1, 13)]
    assert S.upsert(spark, workdir, "grid_fuel_hourly", _fuel(spark, history)) == 12
    stored = S.stored_rows(spark, workdir, "grid_fuel_hourly", [("CISO", "2025", "02"), ("CISO", "2025", "11"), ("ERCO", "2025", "02")])
    assert {re.search(r"month=(\d\d)/v=", f)[1] for f in stored.inputFiles()} == {"02", "11"}
    april = [(dt.datetime(2025, 4, 3, 5), "CISO", "n", "SUN", "Solar", 44.0, STAMP)]
    assert S.upsert(spark, workdir, "grid_fuel_hourly", _fuel(spark, april)) == 1
    got = {r.period_utc.month: r.generation_mwh for r in S.scan_table(spark, workdir, "grid_fuel_hourly").collect()}
    assert got == {**{m: float(m) for m in range(1, 13)}, 4: 44.0}
    assert S.upsert(spark, workdir, "grid_fuel_hourly", _fuel(spark, [])) == 0


def _april_values(spark, workdir):
    return {r.period_utc.hour: r.generation_mwh for r in S.scan_table(spark, workdir, "grid_fuel_hourly").collect()}


def test_a_failed_commit_leaves_the_month_whole(spark, workdir, monkeypatch):
    """Whether the data write or the publication fails, readers keep the old snapshot and a retry succeeds."""
    rows = lambda value, hours: _fuel(spark, [(dt.datetime(2025, 4, 1, h), "CISO", "n", "SUN", "Solar", value, STAMP) for h in hours])
    S.upsert(spark, workdir, "grid_fuel_hourly", rows(1.0, range(4)))
    old = {h: 1.0 for h in range(4)}
    merge = S.merged_rows

    def breaks_midway(*args):  # some rows are written, then a task fails for good
        return merge(*args).repartition(4).withColumn("generation_mwh", F.when(F.hour("period_utc") == 3, F.raise_error(F.lit("disk gone")).cast(
            "double")).otherwise(F.col("generation_mwh")))

    monkeypatch.setattr(S, "merged_rows", breaks_midway)
    with pytest.raises(Exception, match="disk gone"):
        S.upsert(spark, workdir, "grid_fuel_hourly", rows(2.0, range(2, 6)))
    assert _april_values(spark, workdir) == old
    monkeypatch.setattr(S, "merged_rows", merge)
    publish = S._publish
    monkeypatch.setattr(S, "_publish", lambda *args: (_ for _ in ()).throw(OSError("lost the driver")))
    with pytest.raises(OSError):
        S.upsert(spark, workdir, "grid_fuel_hourly", rows(3.0, range(2, 6)))
    assert _april_values(spark, workdir) == old
    monkeypatch.setattr(S, "_publish", publish)
    assert S.upsert(spark, workdir, "grid_fuel_hourly", rows(4.0, range(2, 6))) == 6
    assert _april_values(spark, workdir) == {0: 1.0, 1: 1.0, **{h: 4.0 for h in range(2, 6)}}
    assert not os.path.exists(os.path.join(workdir, "_staging")) or not os.listdir(os.path.join(workdir, "_staging"))


def test_an_overtaken_commit_is_refused(spark, workdir, monkeypatch):
    one = _fuel(spark, [(STAMP, "CISO", "n", "SUN", "Solar", 1.0, STAMP)])
    other = _fuel(spark, [(STAMP, "CISO", "n", "WND", "Wind", 2.0, STAMP)])
    merge = S.merged_rows

    def overtaken(*args):
        monkeypatch.setattr(S, "merged_rows", merge)
        S.upsert(spark, workdir, "grid_fuel_hourly", other)
        return merge(*args)

    monkeypatch.setattr(S, "merged_rows", overtaken)
    with pytest.raises(S.ConcurrentCommit):
        S.upsert(spark, workdir, "grid_fuel_hourly", one)
    assert [r.fuel_type for r in S.scan_table(spark, workdir, "grid_fuel_hourly").collect()] == ["WND"]
    assert S.upsert(spark, workdir, "grid_fuel_hourly", one) == 2


def test_readers_keep_their_snapshot_and_old_versions_go(spark, workdir):
    rows = lambda value: _fuel(spark, [(STAMP, "CI/SO", "n", "SUN", "Solar", value, STAMP)])
    S.upsert(spark, workdir, "grid_fuel_hourly", rows(1.0))
    reader = S.scan_table(spark, workdir, "grid_fuel_hourly")
    S.upsert(spark, workdir, "grid_fuel_hourly", rows(2.0))
    assert [r.generation_mwh for r in reader.collect()] == [1.0]  # a plan made before the commit
    S.upsert(spark, workdir, "grid_fuel_hourly", rows(3.0))
    folders = [f for f in os.walk(workdir) if os.path.basename(f[0]).startswith("v=")]
    assert len(folders) == S.KEPT_SNAPSHOTS == len(S.snapshot_numbers(spark, workdir, "grid_fuel_hourly"))
    assert [(r.respondent, r.generation_mwh) for r in S.scan_table(spark, workdir, "grid_fuel_hourly").collect()] == [("CI/SO", 3.0)]
