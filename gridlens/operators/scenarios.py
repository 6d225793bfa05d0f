"""What-if scenarios for renewables and nuclear availability.

A scenario scales solar and wind by ``renewable_multiplier`` and nuclear by
``nuclear_availability``, recomputes net and residual load from the unrounded
values, then rounds each to 2 decimals.  The baseline is summarized as stored.

All scenarios run in one pass: the scenario catalogue (the caller's list) is
attached to every hourly row by exploding a literal array, which is a map-side
generator, so no join is needed; the comparison takes the hour before on the base
curve and shuffles nothing after the explode but partial sums.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.functions.rounding import REST_SCALE, py_round, rest_units
from gridlens.operators.windows import hourly_ramp

# The default scenario catalogue (label, renewable multiplier,
# nuclear availability), in report order.
DEFAULT_SCENARIOS = [
    ("+50% renewables", 1.5, 1.0),
    ("2x renewables", 2.0, 1.0),
    ("nuclear at 50%", 1.0, 0.5),
    ("2x renewables, nuclear 50%", 2.0, 0.5),
]
BASELINE = "baseline"

SUMMARY_FIELDS = ["hours", "peak_demand_mwh", "min_net_load_mwh", "max_hourly_ramp_mwh",
                  "peak_residual_mwh", "curtailment_hours", "renewable_share"]


def catalogue(scenarios: Sequence[tuple[str, float, float]] | Mapping | None = None):
    """Normalize a catalogue to ``[(label, renewable_multiplier, nuclear_availability)]``.

    Accepts the reference's mapping form ``{label: {"renewable_multiplier": .., ...}}``."""
    if scenarios is None:
        scenarios = DEFAULT_SCENARIOS
    if isinstance(scenarios, Mapping):
        scenarios = [(label, float(kw.get("renewable_multiplier", 1.0)),
                      float(kw.get("nuclear_availability", 1.0)))
                     for label, kw in scenarios.items()]
    out = [(str(a), float(b), float(c)) for a, b, c in scenarios]
    return out


def _scenario_array(scenarios, with_baseline: bool = False) -> F.Column:
    entries = [(BASELINE, 0, 1.0, 1.0, True)] if with_baseline else []
    entries += [(label, i + 1, rm, na, False) for i, (label, rm, na) in enumerate(scenarios)]
    return F.array(*[F.struct(F.lit(label).alias("scenario"), F.lit(order).alias("scenario_order"),
                              F.lit(rm).alias("renewable_multiplier"),
                              F.lit(na).alias("nuclear_availability"),
                              F.lit(base).alias("is_baseline"))
                     for label, order, rm, na, base in entries])


def scenario_rows(curve: DataFrame, scenarios=None, *, with_baseline: bool = False) -> DataFrame:
    """Every hourly row once per scenario (and once as the baseline), with its
    multipliers -- a generator over a literal array, not a join."""
    arr = _scenario_array(catalogue(scenarios), with_baseline)
    return curve.withColumn("_sc", F.explode(arr)).select("*", "_sc.*").drop("_sc")


def apply_scenario(rows: DataFrame, renewable_multiplier=None, nuclear_availability=None) -> DataFrame:
    """Scale and recompute. Multipliers are numbers or column names (per-row values).
    Rows flagged ``is_baseline`` keep their stored values (the baseline is not re-rounded)."""
    rm = F.col("renewable_multiplier") if renewable_multiplier is None else (
        F.col(renewable_multiplier) if isinstance(renewable_multiplier, str) else F.lit(float(renewable_multiplier)))
    na = F.col("nuclear_availability") if nuclear_availability is None else (
        F.col(nuclear_availability) if isinstance(nuclear_availability, str) else F.lit(float(nuclear_availability)))
    solar = F.col("solar_mwh") * rm
    wind = F.col("wind_mwh") * rm
    nuclear = F.col("nuclear_mwh") * na
    net = F.col("demand_mwh") - solar - wind
    new = {"net_load_mwh": py_round(net, 2),
           "residual_load_after_nuclear_mwh": py_round(net - nuclear, 2),
           "solar_mwh": py_round(solar, 2), "wind_mwh": py_round(wind, 2),
           "nuclear_mwh": py_round(nuclear, 2)}
    keep = F.col("is_baseline") if "is_baseline" in rows.columns else F.lit(False)
    out = [(F.when(keep, F.col(c)).otherwise(new[c]).alias(c) if c in new else F.col(c))
           for c in rows.columns]
    out += [e.alias(c) for c, e in new.items() if c not in rows.columns]
    return rows.select(*out)


def scenario_curves(curve: DataFrame, scenarios=None, *, with_baseline: bool = True) -> DataFrame:
    """Baseline rows (as stored, order 0) plus every scenario's recomputed rows, from
    one pass over ``curve``."""
    cols = curve.columns
    rows = apply_scenario(scenario_rows(curve, scenarios, with_baseline=with_baseline))
    return rows.select("scenario", "scenario_order", *cols)


def _parts(c: F.Column) -> tuple[F.Column, F.Column]:
    """Whole hundredths, and what lies beyond them as a whole number: sums have the same bits in every order."""
    return F.rint(c * F.lit(100.0)).cast("long"), rest_units(c)


def scenario_summary(curves: DataFrame, keys: Sequence[str] = ("scenario", "scenario_order",
                                                                 "respondent")) -> DataFrame:
    """Grid-stress metrics per (scenario, respondent): one window pass for the
    row-adjacent ramp, then one aggregation.  Peaks/minimum/ramp round to 1,
    share to 4 (0.0 when total demand is 0)."""
    part = [k for k in keys if k != "scenario_order"]
    return _summarise(hourly_ramp(curves, partition=part), keys)


def _summarise(ramps: DataFrame, keys: Sequence[str]) -> DataFrame:
    # sun and wind apart: their sum would carry rounding noise into the rest
    parts = {c: _parts(F.col(c)) for c in ("solar_mwh", "wind_mwh", "demand_mwh")}
    sums = [s for c, (units, rest) in parts.items()
            for s in (F.sum(units).alias(f"_{c}_u"), F.sum(rest).alias(f"_{c}_r"))]
    agg = ramps.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("hours"),
        py_round(F.max("demand_mwh"), 1).alias("peak_demand_mwh"),
        py_round(F.min("net_load_mwh"), 1).alias("min_net_load_mwh"),
        py_round(F.coalesce(F.max("ramp_mwh"), F.lit(0.0)), 1).alias("max_hourly_ramp_mwh"),
        py_round(F.max("residual_load_after_nuclear_mwh"), 1).alias("peak_residual_mwh"),
        F.count(F.when(F.col("net_load_mwh") < 0, 1)).alias("curtailment_hours"), *sums)
    def total(*names: str) -> F.Column:
        units, rest = (reduce(add, (F.col(f"_{c}_{k}") for c in names)).cast("double") for k in "ur")
        return units / F.lit(100.0) + rest / F.lit(REST_SCALE)

    renew, demand = total("solar_mwh", "wind_mwh"), total("demand_mwh")
    share = F.when(demand != 0, py_round(renew / demand, 4)).otherwise(F.lit(0.0))
    return agg.withColumn("renewable_share", share).drop(*(f"_{c}_{k}" for c in parts for k in "ur"))


def scenario_compare(curve: DataFrame, scenarios=None) -> DataFrame:
    """Baseline + each scenario -> one summary row per (scenario, respondent).

    The hour before is attached once, on the base curve by respondent; every scenario's ramp
    is then the difference of two values computed in its own row, so only partial
    aggregates are shuffled after the scenarios are exploded."""
    before = Window.partitionBy("respondent").orderBy("period_utc")
    inputs = ("demand_mwh", "solar_mwh", "wind_mwh", "net_load_mwh")
    based = curve.select("*", *(F.lag(c).over(before).alias(f"_last_{c}") for c in inputs))
    rows = scenario_rows(based, scenarios, with_baseline=True)
    last = F.when(F.col("is_baseline"), F.col("_last_net_load_mwh")).otherwise(py_round(
        F.col("_last_demand_mwh") - F.col("_last_solar_mwh") * F.col("renewable_multiplier")
        - F.col("_last_wind_mwh") * F.col("renewable_multiplier"), 2))
    ramps = apply_scenario(rows.withColumn("_last", last)).withColumn(
        "ramp_mwh", F.abs(F.col("net_load_mwh") - F.col("_last")))
    return _summarise(ramps, ("scenario", "scenario_order", "respondent"))
