"""Catalogue base: the registry, the shared selection and the curve helper.

Each entry builds a DataFrame from the driver tables at ``sf_dir`` (through the
fixture adapters) and names its columns exactly as the SQL twin does.  Output
conventions shared with the twins: timestamps as UTC ISO text, dates as
``yyyy-MM-dd`` text, integers as BIGINT, doubles rounded with ``py_round``
wherever they come out of an aggregation whose summation order differs across
engines.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.functions.timefmt import utc_iso
from gridlens.operators import curve as C
from gridlens.operators import dashboard as D
from gridlens.sources import fixtures as X

QueryFn = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    fn: QueryFn
    sql: str | None  # None: not SQL-expressible, checked by tests instead


REGISTRY: dict[str, Query] = {}


def register(name: str, sql: str | None):
    def deco(fn: QueryFn) -> QueryFn:
        REGISTRY[name] = Query(fn, sql)
        return fn
    return deco


# The selection of the slicing queries (UTC days, inclusive): part of the events month.
DASH_START = "2024-01-04"
DASH_END = "2024-01-17"
SQL_LO = "TIMESTAMP '2024-01-04 00:00:00'"
SQL_HI = "TIMESTAMP '2024-01-18 00:00:00'"
FACET = "CISO"
# And of the outage slice, out of a calendar of seven years.
OUT_START = "2024-03-01"
OUT_END = "2026-08-31"


def curve(spark: SparkSession, sf_dir: str, *days) -> DataFrame:
    """The whole curve, or that of the given first and last UTC day."""
    return C.duck_curve(X.region_hourly(spark, sf_dir, *days), X.fuel_hourly(spark, sf_dir, *days))


def curve_text(df: DataFrame) -> DataFrame:
    return df.withColumn("period_utc", utc_iso("period_utc"))


def dash_slice(spark, sf_dir):
    return D.date_range_slice(curve(spark, sf_dir, DASH_START, DASH_END), DASH_START, DASH_END)


def outage_slice_rows(spark, sf_dir):
    return D.outage_slice(X.outage_facility_daily(spark, sf_dir, OUT_START, OUT_END), OUT_START, OUT_END)


_FUEL_COLUMNS = "period_utc, respondent, fuel_type, fuel_name, generation_mwh"
SLICE_CTE = ("sl", f"SELECT * FROM ba_duck_curve_hourly WHERE period_utc >= {SQL_LO} AND period_utc < {SQL_HI}")
FUEL_SLICE_CTE = ("fsl", f"""SELECT {_FUEL_COLUMNS} FROM grid_fuel_hourly
    WHERE period_utc >= {SQL_LO} AND period_utc < {SQL_HI} AND respondent = '{FACET}'""")
OUTAGE_SLICE_CTE = ("osl", f"""SELECT * FROM nuclear_facility_daily
    WHERE period_date >= DATE '{OUT_START}' AND period_date <= DATE '{OUT_END}'""")
# The same names over everything, for the queries that select nothing.
WHOLE_CTE = ("sl", "SELECT * FROM ba_duck_curve_hourly")
FUEL_WHOLE_CTE = ("fsl", f"SELECT {_FUEL_COLUMNS} FROM grid_fuel_hourly")
OUTAGE_WHOLE_CTE = ("osl", "SELECT * FROM nuclear_facility_daily")


def date_text(c: str):
    return F.date_format(c, "yyyy-MM-dd").alias(c)
