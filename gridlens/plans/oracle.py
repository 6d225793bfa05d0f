"""SQL twins of the fixture adapters and the grid views, for the DuckDB oracle.

``with_views(body, *names)`` prefixes a query with the CTEs it needs (and their
dependencies).  The driver pre-registers the raw tables (events, lineitem,
supplier, ...) as views.
"""

from __future__ import annotations

from gridlens.functions.rounding import sql_py_round as R
from gridlens.functions.timefmt import sql_local_hour, sql_respondent_timezone, sql_utc_iso
from gridlens.sources.fixtures import (DEMAND_EVENT, DEMAND_SCALE, EVEN_RESPONDENT, FUEL_EVENTS,
                                       ODD_RESPONDENT, PAGE_RECORDS, RESPONDENT_NAMES)


def _case(expr: str, mapping: dict[str, str]) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in sorted(mapping.items()))
    return f"(CASE {expr} {whens} END)"


_FUEL_IN = ", ".join(f"'{k}'" for k in sorted(FUEL_EVENTS))

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "ev": ((), f"""
        SELECT event_id, ts, date_trunc('hour', ts) AS period_utc,
               CASE WHEN user_id % 2 = 0 THEN '{EVEN_RESPONDENT}' ELSE '{ODD_RESPONDENT}' END
                   AS respondent,
               event_type, value
        FROM events"""),
    "grid_region_hourly": (("ev",), f"""
        SELECT period_utc, respondent, {_case('respondent', RESPONDENT_NAMES)} AS respondent_name,
               'D' AS metric_type, 'Demand' AS metric_name,
               {R(f'(sum(value) * {DEMAND_SCALE!r})', 2)} AS value_mwh,
               max(ts) AS ingested_at_utc
        FROM ev WHERE event_type = '{DEMAND_EVENT}'
        GROUP BY period_utc, respondent"""),
    "grid_fuel_hourly": (("ev",), f"""
        SELECT period_utc, respondent, {_case('respondent', RESPONDENT_NAMES)} AS respondent_name,
               {_case('event_type', {k: v[0] for k, v in FUEL_EVENTS.items()})} AS fuel_type,
               {_case('event_type', {k: v[1] for k, v in FUEL_EVENTS.items()})} AS fuel_name,
               {R('sum(value)', 2)} AS generation_mwh,
               max(ts) AS ingested_at_utc
        FROM ev WHERE event_type IN ({_FUEL_IN})
        GROUP BY period_utc, respondent, event_type"""),
    "outage_agg": ((), f"""
        SELECT CAST(CAST(l_shipdate AS DATE) + INTERVAL 28 YEAR AS DATE) AS period_date,
               l_suppkey,
               {R('(sum(l_quantity) * CAST(1.000371 AS DOUBLE))', 6)} AS capacity_mw,
               {R('(sum(l_quantity * l_discount) * CAST(1.000371 AS DOUBLE))', 6)} AS outage_mw,
               max(l_shipdate + INTERVAL 28 YEAR) AS ingested_at_utc
        FROM lineitem GROUP BY 1, 2"""),
    "nuclear_facility_daily": (("outage_agg",), f"""
        SELECT period_date, CAST(l_suppkey AS VARCHAR) AS facility, s.s_name AS facility_name,
               capacity_mw, outage_mw,
               CASE WHEN capacity_mw <> 0 THEN {R('(100.0 * outage_mw / capacity_mw)', 2)} END
                   AS percent_outage,
               ingested_at_utc
        FROM outage_agg o LEFT JOIN supplier s ON o.l_suppkey = s.s_suppkey"""),
    "landed_rows": (("ev",), f"""
        SELECT *, respondent || '/' || strftime(ts, '%Y-%m-%d') AS request, day(ts) AS d,
               (row_number() OVER w - 1) // {PAGE_RECORDS} * {PAGE_RECORDS} AS page,
               (row_number() OVER w - 1) % {PAGE_RECORDS} AS pos, count(*) OVER (PARTITION BY respondent, CAST(ts AS DATE)) AS n
        FROM ev WINDOW w AS (PARTITION BY respondent, CAST(ts AS DATE) ORDER BY event_id)"""),
    # every page with the page whose records it holds (-1: none)
    "landed_pages": (("landed_rows",), f"""
        SELECT request, d, n, page, page AS holds, count(*) AS size FROM landed_rows
        WHERE NOT (d % 7 = 2 AND page = 10) GROUP BY ALL
        UNION ALL SELECT request, d, n, n + {PAGE_RECORDS}, 0, count(*) FROM landed_rows WHERE page = 0 AND d % 3 = 0 GROUP BY ALL
        UNION ALL SELECT DISTINCT request, d, n, n, -1, 0 FROM landed_rows WHERE d % 4 = 0 OR d % 5 = 0
        UNION ALL SELECT request, d, n, 3, 0, count(*) FROM landed_rows WHERE page = 0 AND d % 11 = 6 GROUP BY ALL"""),
    "page_states": (("landed_pages",), """
        SELECT *, n + CASE WHEN d % 5 = 0 THEN 7 ELSE 0 END AS total,
               coalesce(max(page + size) OVER (PARTITION BY request ORDER BY page ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reach
        FROM landed_pages"""),
    "page_stops": (("page_states",), """
        SELECT request, min(page) AS stop FROM page_states WHERE size = 0 OR page + size >= total OR reach >= total GROUP BY request"""),
    "demand": (("grid_region_hourly",), """
        SELECT period_utc, respondent, value_mwh AS demand_mwh
        FROM grid_region_hourly WHERE metric_type = 'D'"""),
    "fuel_pivot": (("grid_fuel_hourly",), """
        SELECT period_utc, respondent,
               SUM(CASE WHEN fuel_type = 'SUN' THEN generation_mwh ELSE 0.0 END) AS solar_mwh,
               SUM(CASE WHEN fuel_type = 'WND' THEN generation_mwh ELSE 0.0 END) AS wind_mwh,
               SUM(CASE WHEN fuel_type = 'NUC' THEN generation_mwh ELSE 0.0 END) AS nuclear_mwh
        FROM grid_fuel_hourly GROUP BY period_utc, respondent"""),
    "ba_duck_curve_hourly": (("demand", "fuel_pivot"), """
        SELECT demand.period_utc, demand.respondent, demand.demand_mwh,
               fuel_pivot.solar_mwh, fuel_pivot.wind_mwh, fuel_pivot.nuclear_mwh,
               demand.demand_mwh - fuel_pivot.solar_mwh - fuel_pivot.wind_mwh AS net_load_mwh,
               demand.demand_mwh - fuel_pivot.solar_mwh - fuel_pivot.wind_mwh
                   - fuel_pivot.nuclear_mwh AS residual_load_after_nuclear_mwh
        FROM demand INNER JOIN fuel_pivot USING (period_utc, respondent)"""),
}


def _order(names: tuple[str, ...]) -> list[str]:
    seen: list[str] = []

    def visit(n: str) -> None:
        if n in seen:
            return
        for dep in CTES[n][0]:
            visit(dep)
        seen.append(n)

    for n in names:
        visit(n)
    return seen


def with_views(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH <needed adapter CTEs>, <extra CTEs> <body>``."""
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in _order(names)]
    parts += [f"{n} AS ({sql}\n)" for n, sql in (extra or [])]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body


tz = sql_respondent_timezone
local_hour = sql_local_hour
iso = sql_utc_iso


def ts_text(expr: str) -> str:
    """Hour stamps as ``YYYY-MM-DDTHH:MM:SSZ`` (the Spark side uses ``utc_iso``)."""
    return sql_utc_iso(expr)
