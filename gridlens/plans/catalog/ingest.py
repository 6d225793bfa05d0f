"""Catalogue: ingest transforms (request slice, normalizers, keyed merges)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import functions as F

from gridlens.functions.rounding import sql_py_round as R
from gridlens.functions.timefmt import utc_iso
from gridlens.plans import oracle as O
from gridlens.session import checkpoint_dir
from gridlens.sources import fixtures as X
from gridlens.sources import normalize as N
from gridlens.sources import pages as P
from gridlens.sources import store as S
from gridlens.plans.catalog.base import register, DASH_START, DASH_END, FACET, curve_text, date_text


# -- ingest transforms

INGESTED_AT = dt.datetime(2025, 5, 1, tzinfo=dt.UTC)
SQL_INGESTED = "'2025-05-01T00:00:00Z'"

_RAW_REGION = ("raw_region", """SELECT strftime(period_utc, '%Y-%m-%dT%H') AS period, respondent,
        respondent_name AS "respondent-name", metric_type AS "type", metric_name AS "type-name",
        CAST(value_mwh AS VARCHAR) AS "value" FROM grid_region_hourly""")


@register("request_slice", O.with_views(f"""
SELECT period, respondent, "respondent-name", "type", "type-name", "value" FROM raw_region
WHERE respondent IN ('CISO') AND period BETWEEN '{DASH_START}T00' AND '{DASH_END}T23'""",
    "grid_region_hourly", extra=[_RAW_REGION]))
def q_request_slice(spark, sf_dir):
    lo, hi = P.hourly_bounds(DASH_START, DASH_END)
    return P.request_slice(X.raw_region_records(spark, sf_dir), start=lo, end=hi,
                           facets={"respondent": [FACET]})


@register("normalize_region", O.with_views(f"""
SELECT {O.ts_text("strptime(period, '%Y-%m-%dT%H')")} AS period_utc, respondent,
       "respondent-name" AS respondent_name, "type" AS metric_type, "type-name" AS metric_name,
       CAST("value" AS DOUBLE) AS value_mwh, {SQL_INGESTED} AS ingested_at_utc
FROM raw_region""", "grid_region_hourly", extra=[_RAW_REGION]))
def q_normalize_region(spark, sf_dir):
    n = N.normalize_region(X.raw_region_records(spark, sf_dir), ingested_at_utc=INGESTED_AT)
    return curve_text(n).withColumn("ingested_at_utc", utc_iso("ingested_at_utc"))


@register("normalize_fuel", O.with_views(f"""
SELECT {O.ts_text("strptime(period, '%Y-%m-%dT%H')")} AS period_utc, respondent,
       respondent_name, fuel_type, fuel_name,
       CAST(CAST(generation_mwh AS VARCHAR) AS DOUBLE) AS generation_mwh,
       {SQL_INGESTED} AS ingested_at_utc
FROM (SELECT strftime(period_utc, '%Y-%m-%dT%H') AS period, * FROM grid_fuel_hourly)""",
    "grid_fuel_hourly"))
def q_normalize_fuel(spark, sf_dir):
    n = N.normalize_fuel(X.raw_fuel_records(spark, sf_dir), ingested_at_utc=INGESTED_AT)
    return curve_text(n).withColumn("ingested_at_utc", utc_iso("ingested_at_utc"))


@register("normalize_outage", O.with_views(f"""
SELECT strftime(CAST(strftime(period_date, '%Y-%m-%d') AS DATE), '%Y-%m-%d') AS period_date,
       facility, facility_name, CAST(CAST(capacity_mw AS VARCHAR) AS DOUBLE) AS capacity_mw,
       CAST(CAST(outage_mw AS VARCHAR) AS DOUBLE) AS outage_mw,
       CAST(CAST(percent_outage AS VARCHAR) AS DOUBLE) AS percent_outage,
       {SQL_INGESTED} AS ingested_at_utc
FROM nuclear_facility_daily""", "nuclear_facility_daily"))
def q_normalize_outage(spark, sf_dir):
    n = N.normalize_outage(X.raw_outage_records(spark, sf_dir), ingested_at_utc=INGESTED_AT)
    return n.select(date_text("period_date"), "facility", "facility_name", "capacity_mw",
                    "outage_mw", "percent_outage",
                    utc_iso("ingested_at_utc").alias("ingested_at_utc"))


@register("read_pages", O.with_views("""
SELECT p.request, p.page, r.pos, r.event_id, r.event_type, r.value
FROM landed_pages p JOIN landed_rows r ON p.request = r.request AND p.holds = r.page
LEFT JOIN page_stops s ON p.request = s.request WHERE s.stop IS NULL OR p.page <= s.stop""", "landed_pages", "page_stops"))
def q_read_pages(spark, sf_dir):
    """The records up to the stop of the fetch loop; pages left over from a longer run hold none."""
    return P.loop_records(X.landed_pages(spark, sf_dir)).select(
        "request", "page", F.col("pos").cast("long").alias("pos"), "event_id", "event_type", "value")


@register("page_completeness", O.with_views("""
SELECT p.request, CAST(count(*) FILTER (seen) AS BIGINT) AS pages, CAST(count(*) FILTER (NOT seen) AS BIGINT) AS stale_pages,
       CAST(sum(size) FILTER (seen) AS BIGINT) AS landed, CAST(max(total) AS BIGINT) AS total,
       CAST(coalesce(sum(page - reach) FILTER (seen AND page > reach), 0) AS BIGINT) AS missing,
       CAST(coalesce(sum(least(reach, page + size) - page) FILTER (seen AND page < reach), 0) AS BIGINT) AS repeated,
       bool_or(stop IS NOT NULL) AS loop_stopped,
       bool_or(stop IS NOT NULL) AND bool_and(page = reach OR NOT seen) AND sum(size) FILTER (seen) >= max(total) AS complete
FROM (SELECT p.*, stop, stop IS NULL OR page <= stop AS seen FROM page_states p LEFT JOIN page_stops s ON p.request = s.request) p
GROUP BY p.request""", "page_states", "page_stops"))
def q_page_completeness(spark, sf_dir):
    return P.page_completeness(X.landed_pages(spark, sf_dir))


_ARRIVALS = ("arr", f"""SELECT period_utc, respondent, 'D' AS metric_type,
        {R('(value * 4.0)', 2)} AS value_mwh, ts AS ingested_at_utc,
        event_id % 2 AS batch, event_id AS seq
    FROM ev WHERE event_type = 'purchase'""")


@register("upsert_merge", O.with_views(f"""
SELECT {O.ts_text('period_utc')} AS period_utc, respondent, metric_type, value_mwh,
       {O.iso('ingested_at_utc')} AS ingested_at_utc, seq
FROM (SELECT *, row_number() OVER (PARTITION BY period_utc, respondent, metric_type
                                   ORDER BY batch DESC, seq DESC) AS rn FROM arr)
WHERE rn = 1""", "ev", extra=[_ARRIVALS]))
def q_upsert_merge(spark, sf_dir):
    arr = X.region_arrivals(spark, sf_dir).select(
        "period_utc", "respondent", "metric_type", "value_mwh", "ingested_at_utc", "batch", "seq")
    m = S.last_arrival(arr.withColumn("winner", F.col("seq")), ["period_utc", "respondent",
                                                                 "metric_type"], ["batch", "seq"])
    return m.select(utc_iso("period_utc").alias("period_utc"), "respondent", "metric_type",
                    "value_mwh", utc_iso("ingested_at_utc").alias("ingested_at_utc"),
                    F.col("winner").alias("seq"))


@register("upsert_stored", O.with_views(f"""
SELECT {O.ts_text('period_utc')} AS period_utc, respondent, metric_type, value_mwh, {O.iso('ingested_at_utc')} AS ingested_at_utc
FROM (SELECT *, row_number() OVER (PARTITION BY period_utc, respondent, metric_type
                                   ORDER BY batch DESC, seq DESC) AS rn FROM arr)
WHERE rn = 1""", "ev", extra=[_ARRIVALS]))
def q_upsert_stored(spark, sf_dir):
    """Two landings go through the store one after the other: what the first left is merged with the second."""
    data = f"{checkpoint_dir(spark)}/store-{uuid.uuid4().hex}"
    rows = X.region_arrivals(spark, sf_dir).withColumnRenamed("seq", "pos")
    for batch in (0, 1):
        S.upsert(spark, data, "grid_region_hourly", rows.where(F.col("batch") == batch))
    m = S.scan_table(spark, data, "grid_region_hourly")
    return m.select(utc_iso("period_utc").alias("period_utc"), "respondent", "metric_type",
                    "value_mwh", utc_iso("ingested_at_utc").alias("ingested_at_utc"))


_FUEL_ARRIVALS = ("farr", """SELECT period_utc, respondent,
        CASE event_type WHEN 'click' THEN 'SUN' WHEN 'error' THEN 'NUC' WHEN 'signup' THEN 'COL'
                        WHEN 'view' THEN 'WND' END AS fuel_type,
        value AS generation_mwh, ts AS ingested_at_utc, event_id % 2 AS batch, event_id AS seq
    FROM ev WHERE event_type IN ('click', 'error', 'signup', 'view')""")


@register("last_arrival", O.with_views(f"""
SELECT {O.ts_text('period_utc')} AS period_utc, respondent, fuel_type, generation_mwh,
       {O.iso('ingested_at_utc')} AS ingested_at_utc, seq
FROM (SELECT *, row_number() OVER (PARTITION BY period_utc, respondent, fuel_type
                                   ORDER BY batch DESC, seq DESC) AS rn FROM farr)
WHERE rn = 1""", "ev", extra=[_FUEL_ARRIVALS]))
def q_last_arrival(spark, sf_dir):
    """Latest fuel record per (hour, respondent, fuel) over two interleaved landings."""
    arr = X.fuel_arrivals(spark, sf_dir).select(
        "period_utc", "respondent", "fuel_type", "generation_mwh", "ingested_at_utc", "batch",
        "seq", F.col("seq").alias("winner"))
    m = S.last_arrival(arr, ["period_utc", "respondent", "fuel_type"], ["batch", "seq"])
    return m.select(utc_iso("period_utc").alias("period_utc"), "respondent", "fuel_type",
                    "generation_mwh", utc_iso("ingested_at_utc").alias("ingested_at_utc"),
                    F.col("winner").alias("seq"))
