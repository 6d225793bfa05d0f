"""Adapters that shape the driver's Parquet tables like the grid tables.

Each adapter has a SQL twin in :mod:`gridlens.plans.oracle` so that Spark and the
DuckDB oracle see the same input.

* ``events`` -> hourly region (demand) and fuel tables, both in aggregated form
  and as raw text records / per-event arrivals for the ingest path.
* ``lineitem`` + ``supplier`` -> daily nuclear facility table.  Ship dates are
  moved forward 28 years (a whole leap/weekday cycle) so the outage calendar
  overlaps the events month the dashboard reads.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridlens.functions.rounding import py_round_expr
from gridlens.functions.timefmt import hour_text

# Fixed adapter values.
# user_id parity -> balancing authority
EVEN_RESPONDENT = "CISO"
ODD_RESPONDENT = "ERCO"
RESPONDENT_NAMES = {
    "CISO": "California Independent System Operator",
    "ERCO": "Electric Reliability Council of Texas",
}
# event_type -> demand or fuel
DEMAND_EVENT = "purchase"
DEMAND_SCALE = 4.0
FUEL_EVENTS = {
    "click": ("SUN", "Solar"),
    "view": ("WND", "Wind"),
    "error": ("NUC", "Nuclear"),
    "signup": ("COL", "Coal"),
}
OUTAGE_SHIFT_MONTHS = 336  # 28 years
OUTAGE_SCALE = 1.000371  # leaves six decimals, so that sums and means must carry more than hundredths


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map(d: dict) -> F.Column:
    return F.create_map(*[F.lit(x) for kv in sorted(d.items()) for x in kv])


def _days(df: DataFrame, column: str, start, end, years: int = 0) -> DataFrame:
    """Rows whose raw stamp lies in the UTC days ``start`` to ``end``, moved back by ``years``.

    The bounds are literals of the column's own type, so they reach the Parquet scan."""
    if start is None:
        return df
    kind = df.schema[column].dataType.simpleString()
    first, last = (dt.date.fromisoformat(str(d)) for d in (start, end))
    low, high = (d.replace(year=d.year - years).isoformat() for d in (first, last + dt.timedelta(days=1)))
    return df.where((F.col(column) >= F.lit(low).cast(kind)) & (F.col(column) < F.lit(high).cast(kind)))


def _events(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    ev = _days(table(spark, sf_dir, "events"), "ts", start, end)
    ts = F.col("ts").cast("timestamp")  # zone-less in the file; the session clock is UTC
    return ev.select(
        F.col("event_id"),
        ts.alias("ts"),
        F.date_trunc("hour", ts).alias("period_utc"),
        F.when(F.col("user_id") % 2 == 0, F.lit(EVEN_RESPONDENT))
         .otherwise(F.lit(ODD_RESPONDENT)).alias("respondent"),
        F.col("event_type"),
        F.col("value"),
    )


def _with_name(df: DataFrame) -> DataFrame:
    return df.withColumn("respondent_name", F.try_element_at(_map(RESPONDENT_NAMES), F.col("respondent")))


def region_hourly(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    """grid_region_hourly: demand = 4 x sum(purchase value) per (hour, respondent)."""
    agg = (_events(spark, sf_dir, start, end)
           .where(F.col("event_type") == F.lit(DEMAND_EVENT))
           .groupBy("period_utc", "respondent")
           .agg(py_round_expr(f"sum(value) * {DEMAND_SCALE!r}D", 2).alias("value_mwh"),
                F.max("ts").alias("ingested_at_utc")))
    return _with_name(agg).select(
        "period_utc", "respondent", "respondent_name",
        F.lit("D").alias("metric_type"), F.lit("Demand").alias("metric_name"),
        "value_mwh", "ingested_at_utc")


def _fuel_events(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    codes = _map({k: v[0] for k, v in FUEL_EVENTS.items()})
    names = _map({k: v[1] for k, v in FUEL_EVENTS.items()})
    return (_events(spark, sf_dir, start, end)
            .where(F.col("event_type").isin(list(FUEL_EVENTS)))
            .withColumn("fuel_type", F.try_element_at(codes, F.col("event_type")))
            .withColumn("fuel_name", F.try_element_at(names, F.col("event_type"))))


def fuel_hourly(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    """grid_fuel_hourly: generation = sum(value) per (hour, respondent, fuel)."""
    agg = (_fuel_events(spark, sf_dir, start, end)
           .groupBy("period_utc", "respondent", "fuel_type", "fuel_name")
           .agg(py_round_expr("sum(value)", 2).alias("generation_mwh"),
                F.max("ts").alias("ingested_at_utc")))
    return _with_name(agg).select(
        "period_utc", "respondent", "respondent_name", "fuel_type", "fuel_name",
        "generation_mwh", "ingested_at_utc")


def hourly_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (hour, respondent): the rows that :func:`region_hourly` and :func:`fuel_hourly` have, from one scan."""
    kinds = [DEMAND_EVENT, *FUEL_EVENTS]
    has = {k: F.max((F.col("event_type") == k).cast("long")) for k in kinds}
    fuels = has[kinds[1]]
    for k in kinds[2:]:
        fuels = fuels + has[k]
    return _events(spark, sf_dir).where(F.col("event_type").isin(kinds)).groupBy("period_utc", "respondent").agg(
        has[DEMAND_EVENT].alias("region_rows"), has[DEMAND_EVENT].alias("demand_rows"), fuels.alias("fuel_rows"))


def _value_text(c: str) -> F.Column:
    return F.col(c).cast("string")


def raw_region_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region rows as the API sends them: all text, period ``yyyy-MM-ddTHH``."""
    r = region_hourly(spark, sf_dir)
    return r.select(hour_text("period_utc").alias("period"), "respondent",
                    F.col("respondent_name").alias("respondent-name"),
                    F.col("metric_type").alias("type"), F.col("metric_name").alias("type-name"),
                    _value_text("value_mwh").alias("value"))


def raw_fuel_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fuel_hourly(spark, sf_dir)
    return f.select(hour_text("period_utc").alias("period"), "respondent",
                    F.col("respondent_name").alias("respondent-name"),
                    F.col("fuel_type").alias("fueltype"), F.col("fuel_name").alias("type-name"),
                    _value_text("generation_mwh").alias("value"))


def raw_outage_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = outage_facility_daily(spark, sf_dir)
    return o.select(F.date_format("period_date", "yyyy-MM-dd").alias("period"), "facility",
                    F.col("facility_name").alias("facilityName"),
                    _value_text("capacity_mw").alias("capacity"),
                    _value_text("outage_mw").alias("outage"),
                    _value_text("percent_outage").alias("percentOutage"))


def region_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One demand record per purchase event, tagged with its arrival.

    Two interleaved landings of the whole table: batch = event_id parity, and
    within a batch the larger event_id arrived later.
    """
    ev = _events(spark, sf_dir).where(F.col("event_type") == F.lit(DEMAND_EVENT))
    return _with_name(ev).select(
        "period_utc", "respondent", "respondent_name",
        F.lit("D").alias("metric_type"), F.lit("Demand").alias("metric_name"),
        py_round_expr(f"value * {DEMAND_SCALE!r}D", 2).alias("value_mwh"),
        F.col("ts").alias("ingested_at_utc"),
        (F.col("event_id") % 2).alias("batch"),
        F.col("event_id").alias("seq"))


def fuel_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _with_name(_fuel_events(spark, sf_dir))
    return ev.select(
        "period_utc", "respondent", "respondent_name", "fuel_type", "fuel_name",
        F.col("value").alias("generation_mwh"), F.col("ts").alias("ingested_at_utc"),
        (F.col("event_id") % 2).alias("batch"), F.col("event_id").alias("seq"))


PAGE_RECORDS = 5


def landed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page envelopes made of the events: a request per respondent and day, PAGE_RECORDS records a page.

    By the day of the month, some requests have also a page left over from a longer run (behind the
    end), an empty page at the end, a total that is announced too high, a page that is missing, or
    one that overlaps the first two."""
    ev = _events(spark, sf_dir)
    request = W.partitionBy("request")
    rows = (ev.withColumn("request", F.concat_ws("/", "respondent", F.date_format("ts", "yyyy-MM-dd")))
            .withColumn("d", F.dayofmonth("ts")).withColumn("n", F.count(F.lit(1)).over(request))
            .withColumn("page", F.floor((F.row_number().over(request.orderBy("event_id")) - 1) / PAGE_RECORDS) * PAGE_RECORDS))
    base = rows.groupBy("request", "d", "n", "page").agg(F.array_sort(F.collect_list(F.struct("event_id", "event_type", "value"))).alias("data"))
    # further pages of a request hang on its first one
    extra = F.array_compact(F.array(
        F.when(F.col("d") % 3 == 0, F.struct((F.col("n") + PAGE_RECORDS).alias("page"), F.col("data").alias("data"))),
        F.when((F.col("d") % 4 == 0) | (F.col("d") % 5 == 0), F.struct(F.col("n").alias("page"), F.slice("data", 1, 0).alias("data"))),
        F.when(F.col("d") % 11 == 6, F.struct(F.lit(3).cast("long").alias("page"), F.col("data").alias("data")))))
    first = base.where("page = 0").select("request", "d", "n", F.explode(extra).alias("x")).select("request", "d", "n", "x.page", "x.data")
    pages = base.where("not (d % 7 = 2 and page = 10)").unionByName(first)
    total = F.col("n") + F.when(F.col("d") % 5 == 0, 7).otherwise(0)
    return pages.select("request", F.format_string("%s/offset=%012d.json", "request", "page").alias("file"), F.col("page").cast("long").alias("page"),
                        total.cast("string").alias("total"), "data")


def outage_facility_daily(spark: SparkSession, sf_dir: str, start=None, end=None, *, named: bool = True) -> DataFrame:
    """nuclear_facility_daily from lineitem: one row per (ship day, supplier).

    Aggregates lineitem first (partial aggregation, one row per facility-day),
    then attaches the supplier name with a left join on the much smaller result;
    ``named=False`` leaves the names (and the supplier table) out.
    """
    li = _days(table(spark, sf_dir, "lineitem"), "l_shipdate", start, end, years=OUTAGE_SHIFT_MONTHS // 12)
    # Group on the raw ship day, then move the (far fewer) facility-days forward:
    # the calendar shift is one-to-one per day, so it commutes with the grouping.
    daily = (li.select(F.to_date("l_shipdate").alias("ship_day"), "l_suppkey", "l_quantity",
                       (F.col("l_quantity") * F.col("l_discount")).alias("out"),
                       F.col("l_shipdate").cast("timestamp").alias("shipped"))
             .groupBy("ship_day", "l_suppkey")
             .agg(py_round_expr(f"sum(l_quantity) * {OUTAGE_SCALE!r}D", 6).alias("capacity_mw"),
                  py_round_expr(f"sum(out) * {OUTAGE_SCALE!r}D", 6).alias("outage_mw"),
                  F.max("shipped").alias("last_shipped"))
             .select(F.add_months("ship_day", OUTAGE_SHIFT_MONTHS).alias("period_date"),
                     "l_suppkey", "capacity_mw", "outage_mw",
                     (F.col("last_shipped") + F.expr("INTERVAL 28 YEARS")).alias("ingested_at_utc")))
    pct = F.when(F.col("capacity_mw") != 0,
                 py_round_expr("100.0D * outage_mw / capacity_mw", 2))
    measures = ["capacity_mw", "outage_mw", pct.alias("percent_outage"), "ingested_at_utc"]
    facility = F.col("l_suppkey").cast("string").alias("facility")
    if not named:
        return daily.select("period_date", facility, *measures)
    sup = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("l_suppkey"), F.col("s_name").alias("facility_name"))
    return daily.join(sup, "l_suppkey", "left").select("period_date", facility, "facility_name", *measures)


def fold_residual(curve: DataFrame, capacity: float) -> DataFrame:
    """The curve with |residual load| folded into a small fleet's range: the events stand for far more
    load than seven units serve, and the dispatch queries want targets the fleet can meet."""
    return curve.withColumn("residual_load_after_nuclear_mwh",
                            F.abs(F.col("residual_load_after_nuclear_mwh")) % F.lit(float(capacity)))
