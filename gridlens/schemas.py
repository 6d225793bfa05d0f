"""Declared schemas and keys of the grid tables. Never inferred."""

from __future__ import annotations

from pyspark.sql import types as T

REGION_KEYS = ("period_utc", "respondent", "metric_type")
FUEL_KEYS = ("period_utc", "respondent", "fuel_type")
OUTAGE_KEYS = ("period_date", "facility")

REGION_SCHEMA = T.StructType([
    T.StructField("period_utc", T.TimestampType()),
    T.StructField("respondent", T.StringType()),
    T.StructField("respondent_name", T.StringType()),
    T.StructField("metric_type", T.StringType()),
    T.StructField("metric_name", T.StringType()),
    T.StructField("value_mwh", T.DoubleType()),
    T.StructField("ingested_at_utc", T.TimestampType()),
])

FUEL_SCHEMA = T.StructType([
    T.StructField("period_utc", T.TimestampType()),
    T.StructField("respondent", T.StringType()),
    T.StructField("respondent_name", T.StringType()),
    T.StructField("fuel_type", T.StringType()),
    T.StructField("fuel_name", T.StringType()),
    T.StructField("generation_mwh", T.DoubleType()),
    T.StructField("ingested_at_utc", T.TimestampType()),
])

OUTAGE_SCHEMA = T.StructType([
    T.StructField("period_date", T.DateType()),
    T.StructField("facility", T.StringType()),
    T.StructField("facility_name", T.StringType()),
    T.StructField("capacity_mw", T.DoubleType()),
    T.StructField("outage_mw", T.DoubleType()),
    T.StructField("percent_outage", T.DoubleType()),
    T.StructField("ingested_at_utc", T.TimestampType()),
])

CURVE_COLUMNS = ["period_utc", "respondent", "demand_mwh", "solar_mwh", "wind_mwh",
                 "nuclear_mwh", "net_load_mwh", "residual_load_after_nuclear_mwh"]

CURVE_SCHEMA = T.StructType(
    [T.StructField("period_utc", T.TimestampType()), T.StructField("respondent", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in CURVE_COLUMNS[2:]]
)

# Raw API records: every field arrives as text.
RAW_REGION_FIELDS = ["period", "respondent", "respondent-name", "type", "type-name", "value"]
RAW_FUEL_FIELDS = ["period", "respondent", "respondent-name", "fueltype", "type-name", "value"]
RAW_OUTAGE_FIELDS = ["period", "facility", "facilityName", "capacity", "outage", "percentOutage"]


def raw_record_schema(fields: list[str]) -> T.StructType:
    return T.StructType([T.StructField(f, T.StringType()) for f in fields])


def page_schema(fields: list[str]) -> T.StructType:
    """Paged envelope ``{"response": {"total": "N", "data": [...]}}``; total is text."""
    return T.StructType([
        T.StructField("response", T.StructType([
            T.StructField("total", T.StringType()),
            T.StructField("data", T.ArrayType(raw_record_schema(fields))),
        ])),
    ])


# Fixed values that must equal the reference's for the same results.
# Respondent time zones (anything else falls back to UTC):
RESPONDENT_TIMEZONES = {"CISO": "America/Los_Angeles"}
DEFAULT_TIMEZONE = "UTC"
# Zone used by the chart profile for every respondent:
CHART_TIMEZONE = "America/Los_Angeles"
