"""Time helpers: UTC text forms, local hours and the respondent zone lookup."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridlens.schemas import DEFAULT_TIMEZONE, RESPONDENT_TIMEZONES


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def utc_iso(ts: Column | str) -> Column:
    """``2025-04-01T12:00:00Z``, with ``.ffffff`` only when the microseconds are non-zero
    (Python ``isoformat`` behaviour)."""
    ts = _c(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    micro = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    has_fraction = F.date_format(ts, "SSSSSS") != F.lit("000000")
    return F.when(ts.isNull(), F.lit(None)).when(has_fraction, micro).otherwise(whole)


def iso_offset(ts: Column | str) -> Column:
    """``2025-04-01T12:00:00+00:00`` (session zone is UTC)."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ssxxx")


def csv_text(ts: Column | str) -> Column:
    """``2025-04-01 12:00:00+00:00``: how a zone-aware stamp prints in a CSV cell."""
    return F.date_format(_c(ts), "yyyy-MM-dd HH:mm:ssxxx")


def hour_text(ts: Column | str) -> Column:
    """API period text ``yyyy-MM-ddTHH``."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH")


def respondent_timezone(respondent: Column | str) -> Column:
    """Zone of a balancing authority; a literal map, so no join is needed."""
    zones = F.create_map(*[F.lit(v) for kv in sorted(RESPONDENT_TIMEZONES.items()) for v in kv])
    return F.coalesce(F.try_element_at(zones, _c(respondent)), F.lit(DEFAULT_TIMEZONE))


def local_hour(ts: Column | str, tz: Column | str) -> Column:
    """Hour of day on the local wall clock (DST aware: 23/25-hour days handled by the zone).

    ``tz`` is a zone name (``str``) or a Column of zone names."""
    tz = F.lit(tz) if isinstance(tz, str) else tz
    return F.hour(F.from_utc_timestamp(_c(ts), tz))


def sql_respondent_timezone(expr: str) -> str:
    cases = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(RESPONDENT_TIMEZONES.items()))
    return f"(CASE {expr} {cases} ELSE '{DEFAULT_TIMEZONE}' END)"


def sql_local_hour(ts_expr: str, tz_expr: str) -> str:
    return f"CAST(hour(timezone({tz_expr}, timezone('UTC', {ts_expr}))) AS BIGINT)"


def sql_utc_iso(expr: str) -> str:
    return (f"(CASE WHEN {expr} IS NULL THEN NULL "
            f"WHEN strftime({expr}, '%f') <> '000000' THEN strftime({expr}, '%Y-%m-%dT%H:%M:%S.%fZ') "
            f"ELSE strftime({expr}, '%Y-%m-%dT%H:%M:%SZ') END)")
