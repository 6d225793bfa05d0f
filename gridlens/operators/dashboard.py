"""Dashboard aggregates, computed for every respondent at once.

The reference answers one respondent per request and buckets rows in Python
after a full fetch; here every aggregate stays in the plan (one shuffle on the
group key with map-side partial aggregation) and only finished rows leave it.

Missing-hour rules differ on purpose (kept from the reference):
* ``duck_profile``: an hour without rows keeps only ``hour`` (other fields NULL);
* ``mix_profile``: an hour without rows is 0.0;
* ``chart_profile``: an hour without rows is an error (``full_profile``).
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridlens.functions.rounding import exact_mean, exact_sum, finish_means, mean_parts, merge_parts, py_round
from gridlens.functions.timefmt import local_hour, respondent_timezone, utc_iso
from gridlens.operators.curve import PIVOT_FUELS, load_columns
from gridlens.operators.windows import hourly_ramp
from gridlens.schemas import CHART_TIMEZONE


class SelectionError(ValueError):
    """A rejected dashboard selection; ``status`` mirrors the HTTP code the reference used."""

    def __init__(self, status: int, detail: str):
        super().__init__(detail)
        self.status = status
        self.detail = detail


# ---------------------------------------------------------------- selection

def _as_date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def check_selection(respondent: str | None, start, end) -> tuple[dt.date, dt.date]:
    """Argument checks of the dashboard request (driver side, no data touched)."""
    if respondent is not None and not 2 <= len(respondent) <= 12:
        raise SelectionError(422, "respondent must be 2 to 12 characters")
    start, end = _as_date(start), _as_date(end)
    if end < start:
        raise SelectionError(400, "end must be on or after start")
    return start, end


def require_rows(df: DataFrame, detail: str = "No duck-curve rows for selection") -> DataFrame:
    """Raise the reference's 404 when a selection is empty (one cheap ``isEmpty`` job)."""
    if df.isEmpty():
        raise SelectionError(404, detail)
    return df


def utc_bounds(start, end) -> tuple[Column, Column]:
    """Half-open UTC bounds ``[start 00:00Z, end+1d 00:00Z)`` of a date selection."""
    start, end = check_selection(None, start, end)
    lo = F.lit(dt.datetime.combine(start, dt.time.min)).cast("timestamp")
    hi = F.lit(dt.datetime.combine(end + dt.timedelta(days=1), dt.time.min)).cast("timestamp")
    return lo, hi


def _respondent_filter(df: DataFrame, respondents: Sequence[str] | None) -> DataFrame:
    if respondents is None:
        return df
    return df.where(F.col("respondent").isin(list(respondents)))


def date_range_slice(curve: DataFrame, start, end,
                     respondents: Sequence[str] | None = None) -> DataFrame:
    """Curve rows with ``start 00:00Z <= period_utc < end+1 00:00Z`` (UTC days).

    The bounds are literals, so they reach the Parquet scan as pushed filters."""
    lo, hi = utc_bounds(start, end)
    return _respondent_filter(curve, respondents).where(
        (F.col("period_utc") >= lo) & (F.col("period_utc") < hi))


def fuel_slice(fuel: DataFrame, start, end, respondents: Sequence[str] | None = None) -> DataFrame:
    lo, hi = utc_bounds(start, end)
    return (_respondent_filter(fuel, respondents)
            .where((F.col("period_utc") >= lo) & (F.col("period_utc") < hi))
            .select("period_utc", "respondent", "fuel_type", "fuel_name", "generation_mwh"))


def outage_slice(outage: DataFrame, start, end) -> DataFrame:
    """Inclusive date range over the whole fleet (never filtered by respondent)."""
    start, end = check_selection(None, start, end)
    return outage.where(F.col("period_date").between(F.lit(start), F.lit(end)))


# ---------------------------------------------------------------- authorities

def authorities(curve: DataFrame) -> DataFrame:
    """respondent, first and last hour, zone; one row per respondent."""
    return (curve.groupBy("respondent")
            .agg(F.min("period_utc").alias("start"), F.max("period_utc").alias("end"))
            .withColumn("timezone", respondent_timezone("respondent")))


# ---------------------------------------------------------------- profiles

PROFILE_FIELDS = {
    "demand": "demand_mwh",
    "solar": "solar_mwh",
    "wind": "wind_mwh",
    "nuclear": "nuclear_mwh",
    "net_load": "net_load_mwh",
    "residual_after_nuclear": "residual_load_after_nuclear_mwh",
}


def fill_hours(hourly: DataFrame, keys: Sequence[str], fields: Sequence[str],
               default: Column | None = None) -> DataFrame:
    """All 24 hours per key from per-(key, hour) rows, without a join or a second
    pass over the input: the (at most 24) hours of a key are gathered into a map,
    then the key is exploded over 0..23 and each hour looked up (missing ->
    ``default``, NULL when not given)."""
    by_key = hourly.groupBy(*keys).agg(F.map_from_entries(F.collect_list(
        F.struct(F.col("hour"), F.struct(*[F.col(f) for f in fields])))).alias("_h"))
    spread = by_key.withColumn("hour", F.explode(F.sequence(F.lit(0), F.lit(23))))
    got = F.try_element_at(F.col("_h"), F.col("hour"))
    out = [(got[f] if default is None else F.coalesce(got[f], default)).alias(f) for f in fields]
    return spread.select(*keys, "hour", *out)


def duck_profile(curve_slice: DataFrame) -> DataFrame:
    """Mean per local hour (respondent's zone) of the six curve series, rounded to 2.

    All 24 hours per respondent; an hour without rows has NULL fields."""
    local = curve_slice.withColumn(
        "hour", local_hour("period_utc", respondent_timezone("respondent")))
    means = finish_means(local.groupBy("respondent", "hour").agg(
        *[mean_parts(src).alias(name) for name, src in PROFILE_FIELDS.items()]), list(PROFILE_FIELDS))
    return fill_hours(means, ["respondent"], list(PROFILE_FIELDS))


CHART_FIELDS = {"demand": "demand_mwh", "net_load": "net_load_mwh",
                "residual_after_nuclear": "residual_load_after_nuclear_mwh"}


def chart_profile(curve: DataFrame, timezone: str = CHART_TIMEZONE) -> DataFrame:
    """Unrounded mean per local hour of demand, net and residual; one zone for all
    respondents (Pacific by default); no date filter. Hours without rows are absent:
    :func:`full_profile` makes them a failure, as in the reference."""
    local = curve.withColumn("hour", local_hour("period_utc", timezone).cast("bigint"))
    return local.groupBy("respondent", "hour").agg(
        *[exact_mean(src).alias(name) for name, src in CHART_FIELDS.items()],
        F.count(F.lit(1)).alias("rows"))


def full_profile(profile: DataFrame) -> DataFrame:
    """The profile, which fails when it is computed if a respondent lacks one of the 24 hours."""
    hours = F.count(F.lit(1)).over(Window.partitionBy("respondent"))
    message = F.concat(F.lit("some local hour of "), "respondent", F.lit(" has no rows: "), hours.cast("string"), F.lit(" of 24"))
    return profile.withColumn("hour", F.when(hours == 24, F.col("hour")).otherwise(F.raise_error(message)))


def profile_bounds(profile: DataFrame) -> DataFrame:
    """Chart axis: y_min = min(0, all values), y_max = max(all values) x 1.08."""
    vals = [F.col(c) for c in CHART_FIELDS]
    return (profile.groupBy("respondent")
            .agg(F.min(F.least(*vals)).alias("lo"), F.max(F.greatest(*vals)).alias("hi"))
            .select("respondent",
                    F.least(F.lit(0.0), F.col("lo")).alias("y_min"),
                    (F.col("hi") * F.lit(1.08)).alias("y_max")))


def mix_profile(fuel_rows: DataFrame) -> DataFrame:
    """Mean generation per (respondent, fuel) and local hour, rounded to 2; hours
    without rows are 0.0. Long form: one row per (respondent, fuel, hour)."""
    local = fuel_rows.withColumn(
        "hour", local_hour("period_utc", respondent_timezone("respondent")))
    keys = ["respondent", "fuel_type", "fuel_name"]
    means = finish_means(local.groupBy(*keys, "hour").agg(
        mean_parts("generation_mwh").alias("generation_mwh")), ["generation_mwh"])
    return fill_hours(means, keys, ["generation_mwh"], default=F.lit(0.0))


def mix_profile_arrays(mix: DataFrame) -> DataFrame:
    """The payload shape: one row per fuel with a 24-value array ordered by hour."""
    return (mix.groupBy("respondent", "fuel_type", "fuel_name")
            .agg(F.array_sort(F.collect_list(F.struct("hour", "generation_mwh"))).alias("h"))
            .select("respondent", "fuel_type", "fuel_name",
                    F.transform("h", lambda x: x["generation_mwh"]).alias("values")))


def stacked_mix(mix: DataFrame) -> DataFrame:
    """Stacked area bands: values clamped at 0, stacked per hour in fuel order.

    The stacking window is partitioned by (respondent, hour): a partition holds one
    row per fuel type, so it stays tiny at any data size."""
    clamped = mix.withColumn("clamped_mwh", F.greatest(F.col("generation_mwh"), F.lit(0.0)))
    w = (Window.partitionBy("respondent", "hour").orderBy("fuel_type", "fuel_name")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    wh = Window.partitionBy("respondent", "hour")
    wr = Window.partitionBy("respondent")
    return (clamped
            .withColumn("upper_mwh", F.sum("clamped_mwh").over(w))
            .withColumn("lower_mwh", F.col("upper_mwh") - F.col("clamped_mwh"))
            .withColumn("hour_total_mwh", F.sum("clamped_mwh").over(wh))
            .withColumn("axis_max_mwh",
                        F.ceil(F.max("hour_total_mwh").over(wr) / F.lit(5000.0)) * F.lit(5000)))


# ---------------------------------------------------------------- outages

def outage_daily(outage_rows: DataFrame) -> DataFrame:
    """Fleet capacity and outage per day, available = capacity - outage, each rounded to 2.
    ``outage_sum_mw`` keeps the unrounded daily outage for :func:`outage_max`."""
    daily = outage_rows.groupBy("period_date").agg(
        exact_sum("capacity_mw").alias("cap"), exact_sum("outage_mw").alias("outage_sum_mw"))
    return daily.select(
        "period_date",
        py_round("cap", 2).alias("capacity_mw"),
        py_round("outage_sum_mw", 2).alias("outage_mw"),
        py_round(F.col("cap") - F.col("outage_sum_mw"), 2).alias("available_mw"),
        "outage_sum_mw")


def outage_max(daily: DataFrame) -> DataFrame:
    """Largest daily fleet outage in the range, 0.0 when there are no days, rounded to 2."""
    return daily.agg(py_round(F.coalesce(F.max("outage_sum_mw"), F.lit(0.0)), 2)
                     .alias("maximum_outage_mw"))


# ---------------------------------------------------------------- cards

def freshness(region: DataFrame) -> DataFrame:
    """Latest ingest stamp per respondent over its region rows (no date filter)."""
    return region.groupBy("respondent").agg(F.max("ingested_at_utc").alias("freshness"))


def coverage(curve_slice: DataFrame) -> DataFrame:
    return curve_slice.groupBy("respondent").agg(
        F.count(F.lit(1)).alias("hourly_rows"),
        F.min("period_utc").alias("start"), F.max("period_utc").alias("end"))


def summary_cards(curve_slice: DataFrame, with_coverage: bool = False) -> DataFrame:
    """Peak demand, minimum net load, steepest row-to-row ramp (0.0 with fewer than
    two rows), mean nuclear; rounded to 2. One window pass, one aggregation
    (optionally carrying the coverage columns in the same aggregation)."""
    ramps = hourly_ramp(curve_slice.select("respondent", "period_utc", "demand_mwh",
                                           "net_load_mwh", "nuclear_mwh"))
    extra = [F.count(F.lit(1)).alias("hourly_rows"), F.min("period_utc").alias("start"),
             F.max("period_utc").alias("end")] if with_coverage else []
    cards = ramps.groupBy("respondent").agg(*extra,
        py_round(F.max("demand_mwh"), 2).alias("peak_demand_mwh"),
        py_round(F.min("net_load_mwh"), 2).alias("minimum_net_load_mwh"),
        py_round(F.coalesce(F.max("ramp_mwh"), F.lit(0.0)), 2).alias("steepest_hourly_ramp_mwh"),
        mean_parts("nuclear_mwh").alias("average_nuclear_mwh"))
    return finish_means(cards, ["average_nuclear_mwh"])


# ---------------------------------------------------------------- payload

OUTAGE_SCOPE = "U.S. nuclear fleet context"  # fixed value: part of the document

_FUELS = "array<struct<fuel_type:string,fuel_name:string,generation_mwh:double>>"


def _fuel_entry() -> Column:
    return F.struct("fuel_type", "fuel_name", F.col("generation_mwh").cast("double").alias("generation_mwh"))


def grid_hours(region: DataFrame, fuel: DataFrame) -> DataFrame:
    """One row per hour and respondent, from one read of each table: the curve's columns (null where
    the hour has no curve row), the fuels, and the latest ingest stamp of the region rows."""
    amount = F.when(F.col("metric_type") == "D", F.col("value_mwh"))
    rows = region.select("period_utc", "respondent", amount.alias("demand_mwh"), F.col("ingested_at_utc").alias("fresh"),
                         F.lit(None).cast(_FUELS)[0].alias("fuel")).unionByName(
        fuel.select("period_utc", "respondent", F.lit(None).cast("double").alias("demand_mwh"),
                    F.lit(None).cast("timestamp").alias("fresh"), _fuel_entry().alias("fuel")))
    pivot = [F.sum(F.when(F.col("fuel.fuel_type") == code, F.col("fuel.generation_mwh")).otherwise(F.lit(0.0))).alias(name)
             for name, code in PIVOT_FUELS.items()]
    hours = rows.groupBy("period_utc", "respondent").agg(
        F.max("demand_mwh").alias("demand_mwh"), *pivot, F.max("fresh").alias("fresh"), F.collect_list("fuel").alias("fuels"))
    known = F.col("demand_mwh").isNotNull() & (F.size("fuels") > 0)
    loads = load_columns(hours.withColumn("demand_mwh", F.when(known, F.col("demand_mwh"))))
    return loads.select("period_utc", "respondent", *(F.when(known, F.col(c)).alias(c) for c in PROFILE_FIELDS.values()), "fresh", "fuels")


def curve_hours(curve: DataFrame, fuel: DataFrame, region: DataFrame) -> DataFrame:
    """The rows of :func:`grid_hours` for a curve that is at hand."""
    empty = {**{c: "double" for c in PROFILE_FIELDS.values()}, "fresh": "timestamp", "fuel": _FUELS}

    def part(df, **given):
        none = lambda kind: F.lit(None).cast(kind)
        return df.select("period_utc", "respondent", *(
            given.get(c, none(kind)[0] if c == "fuel" else none(kind)).alias(c) for c, kind in empty.items()))

    rows = part(curve, **{c: F.col(c) for c in PROFILE_FIELDS.values()}).unionByName(
        part(fuel, fuel=_fuel_entry())).unionByName(part(region, fresh=F.col("ingested_at_utc")))
    return rows.groupBy("period_utc", "respondent").agg(
        *(F.max(c).alias(c) for c in PROFILE_FIELDS.values()), F.max("fresh").alias("fresh"), F.collect_list("fuel").alias("fuels"))


def dashboard_payload(curve: DataFrame, fuel: DataFrame, outage: DataFrame, region: DataFrame,
                      start, end, respondents: Sequence[str] | None = None) -> DataFrame:
    """:func:`dashboard_documents` of a curve that is at hand."""
    return dashboard_documents(curve_hours(curve, fuel, region), outage, start, end, respondents)


def dashboard_documents(hours: DataFrame, outage: DataFrame, start, end, respondents: Sequence[str] | None = None) -> DataFrame:
    """(respondent, payload): one JSON document per respondent with curve rows in the range, with every dashboard block.

    One pass over the hours: they are dealt by respondent, and every block comes out of one chain of
    aggregates on that deal: per (respondent, local hour, fuel), where the curve counts as a fuel without a
    name, then per fuel, then per respondent.  Means travel as whole-number sums, so steps add nothing to
    them.  The fleet's outage context, the same for all, is written as text once.
    No job runs while the plan is built."""
    low, high = utc_bounds(start, end)
    use = (F.col("period_utc") >= low) & (F.col("period_utc") < high)
    rows = _respondent_filter(hours, respondents).withColumn("use", use)
    net = F.when(F.col("use"), F.col("net_load_mwh"))
    before = Window.partitionBy("respondent").orderBy("period_utc").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("ramp", F.abs(net - F.last(net, ignorenulls=True).over(before)))

    # a record per fuel of an hour, and one (without a fuel) for its curve row
    own = F.lit(None).cast(_FUELS)[0]
    records = rows.withColumn("x", F.explode(F.concat(F.array(own), F.when(F.col("use"), F.col("fuels")).otherwise(F.array().cast(_FUELS)))))
    is_curve = F.col("x").isNull()
    mine = is_curve & F.col("use") & F.col("demand_mwh").isNotNull()
    records = records.select(
        "respondent", F.col("x.fuel_type").alias("fuel_type"), F.col("x.fuel_name").alias("fuel_name"), is_curve.alias("is_curve"),
        local_hour("period_utc", respondent_timezone("respondent")).alias("hour"),
        F.when(is_curve, F.col("fresh")).alias("fresh"), F.when(mine, F.col("period_utc")).alias("at"), F.when(mine, F.col("ramp")).alias("ramp"),
        F.col("x.generation_mwh").alias("generation"), *(F.when(mine, F.col(c)).alias(n) for n, c in PROFILE_FIELDS.items()))

    names = [*PROFILE_FIELDS, "generation"]
    hourly = records.groupBy("respondent", "is_curve", "fuel_type", "fuel_name", "hour").agg(
        *(mean_parts(n).alias(n) for n in names), mean_parts("nuclear").alias("all_nuclear"),
        F.count("at").alias("rows"), F.min("at").alias("first"), F.max("at").alias("last"), F.max("fresh").alias("fresh"),
        F.max("demand").alias("peak"), F.min("net_load").alias("low"), F.max("ramp").alias("ramp"))
    hourly = finish_means(hourly, names)
    cards = {"rows": F.sum, "first": F.min, "last": F.max, "fresh": F.max, "peak": F.max, "low": F.min, "ramp": F.max}
    by_fuel = hourly.groupBy("respondent", "is_curve", "fuel_type", "fuel_name").agg(
        F.map_from_entries(F.collect_list(F.struct("hour", F.struct(*names)))).alias("h"),
        merge_parts("all_nuclear").alias("all_nuclear"), *(f(c).alias(c) for c, f in cards.items()))
    day = F.sequence(F.lit(0), F.lit(23))
    shown = {"netLoad": "net_load", "residualAfterNuclear": "residual_after_nuclear"}
    shown = {n: n for n in PROFILE_FIELDS if n not in shown.values()} | shown
    profile = F.transform(day, lambda h: F.struct(h.alias("hour"), *(F.try_element_at("h", h)[src].alias(n) for n, src in shown.items())))
    values = F.transform(day, lambda h: F.coalesce(F.try_element_at("h", h)["generation"], F.lit(0.0)))
    docs = by_fuel.groupBy("respondent").agg(
        F.max(F.when(F.col("is_curve"), profile)).alias("profile"),
        F.array_sort(F.collect_list(F.when(~F.col("is_curve"), F.struct(
            F.col("fuel_type").alias("fuelType"), F.col("fuel_name").alias("fuelName"), values.alias("values"))))).alias("mix"),
        merge_parts("all_nuclear").alias("average"), *(f(c).alias(c) for c, f in cards.items())).where("rows > 0")
    docs = finish_means(docs, ["average"])

    days = outage_daily(outage_slice(outage, start, end))
    context = days.agg(F.to_json(F.struct(
        F.lit(OUTAGE_SCOPE).alias("scope"),
        py_round(F.coalesce(F.max("outage_sum_mw"), F.lit(0.0)), 2).alias("maximumOutageMw"),
        F.array_sort(F.collect_list(F.struct(
            F.date_format("period_date", "yyyy-MM-dd").alias("date"),
            F.col("capacity_mw").alias("capacityMw"), F.col("outage_mw").alias("outageMw"),
            F.col("available_mw").alias("availableMw")))).alias("days")))).scalar()
    payload = F.to_json(F.struct(
        F.col("respondent"),
        respondent_timezone("respondent").alias("timezone"),
        utc_iso("fresh").alias("freshness"),
        F.struct(F.col("rows").alias("hourlyRows"), utc_iso("first").alias("start"), utc_iso("last").alias("end")).alias("coverage"),
        F.struct(py_round("peak", 2).alias("peakDemandMwh"), py_round("low", 2).alias("minimumNetLoadMwh"),
                 py_round(F.coalesce("ramp", F.lit(0.0)), 2).alias("steepestHourlyRampMwh"),
                 F.col("average").alias("averageNuclearMwh")).alias("summary"),
        F.col("profile").alias("duckCurveProfile"),
        F.col("mix").alias("generationMixProfile")))
    # the document's last brace makes room for the fleet's context
    return docs.select("respondent", F.concat(
        F.regexp_replace(payload, r"\}$", ""), F.lit(',"outageContext":'), context, F.lit("}")).alias("payload"))
