"""Dashboard requests against the stored tables (what the reference served over HTTP).

``dashboard_request`` validates the selection, reads only what the selection
needs -- the respondent's partitions and the year/month partitions of the
range, with the UTC period bounds pushed to the Parquet scan -- and returns
the finished JSON document.  Only that single bounded document reaches the
driver.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from gridlens.operators import dashboard as D
from gridlens.sources import store as S


def _require_store(spark: SparkSession, data_dir: str) -> None:
    if not S.snapshot_numbers(spark, data_dir, "grid_region_hourly"):
        raise D.SelectionError(503, "data has not been ingested yet")


def dashboard_request(spark: SparkSession, data_dir: str, respondent: str = "CISO",
                      start="2025-04-01", end="2025-04-30") -> dict:
    _require_store(spark, data_dir)
    start, end = D.check_selection(respondent, start, end)
    months = S.month_range(start, end)
    region = S.scan_table(spark, data_dir, "grid_region_hourly")  # freshness: not date-filtered
    fuel = S.scan_table(spark, data_dir, "grid_fuel_hourly", months=months)
    outage = S.scan_table(spark, data_dir, "nuclear_facility_daily", months=months)
    hours = D.grid_hours(region.where(region.respondent == respondent), fuel.where(fuel.respondent == respondent))
    doc = D.dashboard_documents(hours, outage, start, end, [respondent]).first()
    if doc is None:
        raise D.SelectionError(404, "No duck-curve rows for selection")
    return json.loads(doc.payload)


def authorities_request(spark: SparkSession, data_dir: str) -> list[dict]:
    """Every respondent with its first/last hour and zone (one small row each)."""
    from gridlens.functions.timefmt import utc_iso
    _require_store(spark, data_dir)
    views = S.register_views(spark, data_dir)
    rows = (D.authorities(views["ba_duck_curve_hourly"])
            .select("respondent", utc_iso("start").alias("start"), utc_iso("end").alias("end"),
                    "timezone").orderBy("respondent").collect())
    return [r.asDict() for r in rows]
