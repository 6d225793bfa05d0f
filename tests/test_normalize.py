import datetime as dt

import pytest
from pyspark.errors import PySparkException

from gridlens.schemas import RAW_FUEL_FIELDS, RAW_OUTAGE_FIELDS, RAW_REGION_FIELDS, raw_record_schema
from gridlens.sources.normalize import normalize_fuel, normalize_outage, normalize_region

INGESTED_AT = dt.datetime(2025, 5, 1, tzinfo=dt.UTC)


def _records(spark, fields, rows):
    return spark.createDataFrame(rows, raw_record_schema(fields))


def test_normalize_region_rows(spark):
    df = _records(spark, RAW_REGION_FIELDS, [("2025-04-01T01", "CISO",
                  "California Independent System Operator", "D", "Demand", "24545")])
    row = normalize_region(df, ingested_at_utc=INGESTED_AT).first()
    assert row.metric_type == "D"
    assert row.value_mwh == 24545.0
    assert row.period_utc == dt.datetime(2025, 4, 1, 1, 0)  # UTC wall clock (session zone UTC)
    assert row.ingested_at_utc == dt.datetime(2025, 5, 1, 0, 0)


def test_normalize_fuel_rows_allows_negative_generation(spark):
    df = _records(spark, RAW_FUEL_FIELDS, [("2025-04-01T03", "CISO",
                  "California Independent System Operator", "COL", "Coal", "-3")])
    row = normalize_fuel(df, ingested_at_utc=INGESTED_AT).first()
    assert row.generation_mwh == -3.0
    assert row.fuel_type == "COL" and row.fuel_name == "Coal"


def test_normalize_outage_rows(spark):
    df = _records(spark, RAW_OUTAGE_FIELDS, [("2025-04-02", "46", "Browns Ferry", "3661.7",
                                              "1207.7", "32.98")])
    row = normalize_outage(df, ingested_at_utc=INGESTED_AT).first()
    assert row.facility_name == "Browns Ferry"
    assert row.outage_mw == 1207.7
    assert row.period_date == dt.date(2025, 4, 2)
    assert row.facility == "46"


@pytest.mark.parametrize("value", ["not-a-number", None])
def test_normalize_is_strict(spark, value):
    df = _records(spark, RAW_REGION_FIELDS, [("2025-04-01T01", "CISO", "x", "D", "Demand", value)])
    with pytest.raises((PySparkException, Exception)):
        normalize_region(df, ingested_at_utc=INGESTED_AT).collect()


def test_unpadded_period_is_accepted(spark):
    df = _records(spark, RAW_REGION_FIELDS, [("2025-4-1T1", "CISO", "x", "D", "Demand", "1")])
    assert normalize_region(df, ingested_at_utc=INGESTED_AT).first().period_utc == dt.datetime(2025, 4, 1, 1)


@pytest.mark.parametrize("period", ["2025-04-01T24", "2025-13-01T00", "2025-04-01T001", "2025-04-01 01"])
def test_bad_period_raises(spark, period):
    df = _records(spark, RAW_REGION_FIELDS, [(period, "CISO", "x", "D", "Demand", "1")])
    with pytest.raises(Exception):
        normalize_region(df, ingested_at_utc=INGESTED_AT).collect()


@pytest.mark.parametrize("text,value", [("1_000", 1000.0), (" 12 ", 12.0), ("1e3", 1000.0), ("-3", -3.0)])
def test_number_text_like_python_float(spark, text, value):
    assert float(text) == value
    df = _records(spark, RAW_REGION_FIELDS, [("2025-04-01T01", "CISO", "x", "D", "Demand", text)])
    assert normalize_region(df, ingested_at_utc=INGESTED_AT).first().value_mwh == value


@pytest.mark.parametrize("text", ["12d", "3.5F"])
def test_java_suffixes_are_rejected(spark, text):
    with pytest.raises(ValueError):
        float(text)
    df = _records(spark, RAW_REGION_FIELDS, [("2025-04-01T01", "CISO", "x", "D", "Demand", text)])
    with pytest.raises(Exception):
        normalize_region(df, ingested_at_utc=INGESTED_AT).collect()
