"""Type raw API records (all text) into the grid tables.

Strict like the reference: a missing or unparsable field aborts the job
(ANSI casts raise on junk; NULLs are turned into errors with ``raise_error``).
The ingest stamp is one literal for the whole batch; ``keep`` passes extra
columns (e.g. arrival order) through unchanged.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _required(c: str, parsed: Column) -> Column:
    return F.when(F.col(f"`{c}`").isNull() | parsed.isNull(),
                  F.raise_error(F.concat(F.lit(f"missing or invalid '{c}': "),
                                         F.coalesce(F.col(f"`{c}`"), F.lit("NULL"))))
                  ).otherwise(parsed)


# Fixed value: the shape the API's hourly periods take (``%Y-%m-%dT%H``; like
# Python's strptime, month, day and hour may come without zero padding).
HOUR_PERIOD_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}T[0-9]{1,2}$"


def parse_hour_utc(c: str) -> Column:
    """``yyyy-MM-ddTHH`` as a UTC hour (session clock is UTC); un-padded fields are
    accepted and out-of-range values rejected, as ``strptime`` does."""
    col = F.col(f"`{c}`")
    parsed = F.when(col.rlike(HOUR_PERIOD_SHAPE), F.to_timestamp(col, "yyyy-M-d'T'H"))
    return _required(c, parsed)


def parse_date(c: str) -> Column:
    return _required(c, F.to_date(F.col(f"`{c}`"), "yyyy-MM-dd"))


# Number text the way Python's ``float()`` reads it -- digit-group
# underscores are allowed ("1_000"), Java's type suffixes are not ("12d", "3f").
_DIGIT_UNDERSCORE = r"(?<=[0-9])_(?=[0-9])"
_TYPE_SUFFIX = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[dDfF]\s*$"


def parse_double(c: str) -> Column:
    col = F.col(f"`{c}`")
    cleaned = F.regexp_replace(col, _DIGIT_UNDERSCORE, "")
    return _required(c, F.when(~col.rlike(_TYPE_SUFFIX), cleaned.cast("double")))


def text(c: str) -> Column:
    return _required(c, F.col(f"`{c}`"))


def _stamp(ingested_at_utc: dt.datetime) -> Column:
    if ingested_at_utc.tzinfo is not None:
        ingested_at_utc = ingested_at_utc.astimezone(dt.UTC).replace(tzinfo=None)
    return F.lit(ingested_at_utc).cast("timestamp").alias("ingested_at_utc")


def normalize_region(records: DataFrame, *, ingested_at_utc: dt.datetime,
                     keep: Sequence[str] = ()) -> DataFrame:
    return records.select(
        parse_hour_utc("period").alias("period_utc"),
        text("respondent").alias("respondent"),
        text("respondent-name").alias("respondent_name"),
        text("type").alias("metric_type"),
        text("type-name").alias("metric_name"),
        parse_double("value").alias("value_mwh"),
        _stamp(ingested_at_utc), *keep)


def normalize_fuel(records: DataFrame, *, ingested_at_utc: dt.datetime,
                   keep: Sequence[str] = ()) -> DataFrame:
    """Negative generation is kept."""
    return records.select(
        parse_hour_utc("period").alias("period_utc"),
        text("respondent").alias("respondent"),
        text("respondent-name").alias("respondent_name"),
        text("fueltype").alias("fuel_type"),
        text("type-name").alias("fuel_name"),
        parse_double("value").alias("generation_mwh"),
        _stamp(ingested_at_utc), *keep)


def normalize_outage(records: DataFrame, *, ingested_at_utc: dt.datetime,
                     keep: Sequence[str] = ()) -> DataFrame:
    return records.select(
        parse_date("period").alias("period_date"),
        text("facility").alias("facility"),
        text("facilityName").alias("facility_name"),
        parse_double("capacity").alias("capacity_mw"),
        parse_double("outage").alias("outage_mw"),
        parse_double("percentOutage").alias("percent_outage"),
        _stamp(ingested_at_utc), *keep)
