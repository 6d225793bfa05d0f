"""Least-cost unit commitment as a batch Spark job.

Objective of a commitment x (bit i = unit i committed, most significant bit =
unit 0) for a target load T with penalty P:

    cost(x) = sum_i cost_i x_i + P * (T - sum_i capacity_i x_i)^2
            = x^T Q x + P T^2   with   Q_ii = cost_i + P (cap_i^2 - 2 T cap_i),
                                       Q_ij = P cap_i cap_j.

The reference enumerates all 2^N commitments for one T.  Here every distinct target of an hourly
table is solved over two half fleets (``halves``): targets are deduplicated, dealt over the
cluster, solved in Arrow batches by tasks that derive the halves from the fleet they are given, and joined
back.  No row, task or broadcast holds the 2^N commitments or a list of them by capacity, and no target x
commitment pairs are materialized.  ``topk_commitments`` with a score of the user's own has to
look at every commitment; it does so in chunks, of which only the k best go on.

Objectives are rounded to 6 decimals before comparing, so mathematically equal
objectives tie and the smallest index wins, as the reference's ``argmin``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlens.functions.rounding import py_round
from gridlens.operators.halves import OBJECTIVE_DECIMALS, half_fleets

# The default 7-unit fleet (name, capacity in 100-MW blocks, cost $/MWh).
DEFAULT_UNITS = [
    ("Hydro", 4.0, 12.0),
    ("CCGT-1", 7.0, 31.0),
    ("CCGT-2", 4.5, 34.0),
    ("CT-1", 5.0, 42.0),
    ("CT-2", 3.0, 38.0),
    ("Battery", 2.5, 20.0),
    ("Peaker", 2.0, 55.0),
]
DEFAULT_PENALTY = 10.0
MAX_UNITS = 40  # a task holds the commitments of half a fleet: 2^20
#: Commitments that one row looks at for a score of the user's own.
CHUNK = 1024


def fleet(units: Sequence[tuple[str, float, float]] | None = None):
    units = [(str(n), float(c), float(k)) for n, c, k in (units or DEFAULT_UNITS)]
    if not 1 <= len(units) <= MAX_UNITS:
        raise ValueError(f"fleet must have 1..{MAX_UNITS} units")
    return units


def fleet_frame(spark: SparkSession, units=None) -> DataFrame:
    return spark.createDataFrame([(i, n, c, k) for i, (n, c, k) in enumerate(fleet(units))],
                                 "idx int, name string, capacity double, cost double")


def default_target(units=None) -> float:
    """round(0.55 x total capacity, 2) -- the reference's default target."""
    return round(0.55 * sum(c for _, c, _ in fleet(units)), 2)


def bit(idx: Column, i: int, n: int) -> Column:
    """Commitment bit of unit ``i`` (unit 0 is the most significant bit)."""
    return F.shiftright(idx, n - 1 - i).bitwiseAND(F.lit(1))


def _fold(idx: Column, units, pick) -> Column:
    n = len(units)
    acc = F.lit(0.0)
    for i, u in enumerate(units):
        acc = acc + F.when(bit(idx, i, n) == 1, F.lit(pick(u))).otherwise(F.lit(0.0))
    return acc


def commitments(spark: SparkSession, units=None) -> DataFrame:
    """All 2^N commitments: id, bit string, committed capacity and cost."""
    units = fleet(units)
    n = len(units)
    idx = F.col("id")
    return spark.range(2 ** n).select(
        idx.alias("commitment"),
        F.lpad(F.bin(idx), n, "0").alias("bits"),
        _fold(idx, units, lambda u: u[1]).alias("capacity"),
        _fold(idx, units, lambda u: u[2]).alias("cost"))


def objective(cost: Column, capacity: Column, target: Column, penalty: float) -> Column:
    gap = target - capacity
    return cost + F.lit(float(penalty)) * (gap * gap)


def _solve(units, penalty: float, k: int | None):
    """Arrow batches of targets -> their best commitment (of the ``k`` nearest in capacity, where given)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        halves = half_fleets(tuple(units), penalty)
        for batch in batches:
            targets = batch.column(0).to_pylist()
            rows = [halves.best(t) if k is None else halves.cheapest_of(t, halves.nearest(t, k)) for t in targets]
            columns = zip(*rows, strict=True) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(x, t) for x, t in zip(
                columns, (pa.int64(), pa.float64(), pa.float64(), pa.float64()), strict=True))],
                names=["target_load", "commitment", "capacity", "cost", "objective"])
    return run


def _solved(targets: DataFrame, units, penalty: float, k: int | None = None) -> DataFrame:
    """Distinct targets (nulls left out), dealt over as many tasks as a shuffle has, and solved."""
    width = int(targets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = targets.select(F.col("target_load").cast("double").alias("target_load")).where("target_load is not null").distinct()
    return distinct.repartition(width, "target_load").mapInArrow(
        _solve(units, float(penalty), k), "target_load double, commitment long, capacity double, cost double, objective double")


def _bits(commitment: str, n: int) -> Column:
    return F.lpad(F.bin(F.col(commitment)), n, "0")


def best_commitment(spark: SparkSession, targets: DataFrame, target_col: str = "target_load",
                    units=None, penalty: float = DEFAULT_PENALTY) -> DataFrame:
    """Optimal commitment per distinct target value in ``targets``."""
    units = fleet(units)
    solved = _solved(targets.select(F.col(target_col).alias("target_load")), units, penalty)
    return solved.select("target_load", "commitment", _bits("commitment", len(units)).alias("bits"), "capacity", "cost", "objective")


def committed_names(idx: Column, units) -> Column:
    """Comma-joined names of the committed units, in unit order."""
    n = len(units)
    return F.array_join(F.array(*[F.when(bit(idx, i, n) == 1, F.lit(u[0]))
                                  for i, u in enumerate(units)]), ",")


def commitment_report(best: DataFrame, units=None) -> DataFrame:
    """Committed names, served capacity and commitment cost (rounded to 2) per target."""
    units = fleet(units)
    return best.select(
        "target_load", "bits", committed_names(F.col("commitment"), units).alias("committed"),
        py_round("capacity", 2).alias("served_capacity"),
        py_round("cost", 2).alias("commit_cost"), "objective")


def hourly_targets(curve: DataFrame, unit_mwh: float = 1.0) -> DataFrame:
    """One target per curve hour: |residual load| in units of ``unit_mwh``, 1 decimal."""
    return curve.select("period_utc", "respondent", py_round(
        F.abs(F.col("residual_load_after_nuclear_mwh")) / F.lit(float(unit_mwh)), 1).alias("target_load"))


def dispatch_hourly(spark: SparkSession, targets: DataFrame, units=None,
                    penalty: float = DEFAULT_PENALTY) -> DataFrame:
    """Best commitment for every hourly target row.

    Solved once per distinct target, then joined back on the target value; AQE
    broadcasts the solved table when its measured size is small and splits a
    skewed target value otherwise."""
    best = commitment_report(best_commitment(spark, targets, units=units, penalty=penalty), units)
    return targets.join(best, "target_load", "inner")


def commitment_gap(spark: SparkSession, candidates: DataFrame, optimum: DataFrame,
                   penalty: float = DEFAULT_PENALTY, units=None) -> DataFrame:
    """Compare candidate commitments (target_load, commitment) with the optimum:
    recovered if the bits agree or the objectives differ by less than 1e-6."""
    units = fleet(units)
    cap = _fold(F.col("cand_commitment"), units, lambda u: u[1])
    cost = _fold(F.col("cand_commitment"), units, lambda u: u[2])
    cand = candidates.select("target_load", F.col("commitment").alias("cand_commitment"))
    cand = cand.withColumn("candidate_objective", py_round(
        objective(cost, cap, F.col("target_load"), penalty), OBJECTIVE_DECIMALS))
    j = cand.join(optimum.select("target_load", "commitment", "objective"), "target_load")
    return j.select(
        "target_load",
        F.lpad(F.bin("commitment"), len(units), "0").alias("optimum_bits"),
        F.lpad(F.bin("cand_commitment"), len(units), "0").alias("candidate_bits"),
        F.col("objective").alias("optimum_objective"), "candidate_objective",
        ((F.col("commitment") == F.col("cand_commitment"))
         | (F.abs(F.col("candidate_objective") - F.col("objective")) < F.lit(1e-6)))
        .alias("optimum_recovered"))


def closeness(target: Column, subset: Column) -> Column:
    """-|T - capacity|: the default score of a commitment for a target."""
    return -F.abs(target - subset["capacity"])


def topk_commitments(spark: SparkSession, targets: DataFrame, score=closeness, k: int = 16,
                     units=None, penalty: float = DEFAULT_PENALTY) -> DataFrame:
    """Keep the ``k`` best-scored commitments per target, then the cheapest of them.

    ``score(target, subset)`` gives a column from the target and a commitment's struct (capacity,
    cost, commitment); higher is better, ties go to the smaller index.  Closeness of capacity needs
    no look at all commitments (see ``halves``).  For any other score every commitment is a
    candidate: a row looks at CHUNK of them and passes its ``k`` best on, which are merged per target, partly
    before the shuffle."""
    units = fleet(units)
    n = len(units)
    if score is closeness:
        best = _solved(targets, units, penalty, k)
    else:
        best = _scored(targets.select("target_load").where("target_load is not null").distinct(), score, k, units, penalty)
    return best.select("target_load", "commitment", _bits("commitment", n).alias("bits"), "objective")


def _scored(targets: DataFrame, score, k: int, units, penalty: float) -> DataFrame:
    n, t = len(units), F.col("target_load")
    size = min(CHUNK, 2 ** n)
    first = F.col("chunk") * size

    def judged(i: Column) -> Column:
        subset = F.struct(_fold(i, units, lambda u: u[1]).alias("capacity"), _fold(i, units, lambda u: u[2]).alias("cost"), i.alias("commitment"))
        return F.struct((-score(t, subset)).alias("rank"), i.alias("commitment"), subset["capacity"].alias("capacity"), subset["cost"].alias("cost"))

    def k_best(entries: Column) -> Column:
        return F.slice(F.array_sort(entries), 1, k)

    rows = targets.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(2 ** n // size - 1).cast("long"))))
    best = rows.withColumn("best", k_best(F.transform(F.sequence(first, first + (size - 1)), judged)))
    width = max(1, round((2 ** n // size) ** 0.5))  # two steps, so that no row gathers the best of all chunks
    for keys in ([t, (F.col("chunk") % width).alias("chunk")], [t]):
        best = best.groupBy(*keys).agg(k_best(F.flatten(F.collect_list("best"))).alias("best"))
    value = F.transform("best", lambda s: F.struct(
        py_round(objective(s["cost"], s["capacity"], t, penalty), OBJECTIVE_DECIMALS).alias("objective"), s["commitment"].alias("commitment")))
    least = best.withColumn("least", F.array_min(value))
    return least.select("target_load", F.col("least.commitment").alias("commitment"), F.col("least.objective").alias("objective"))


def qubo_objective(commitment: Column, target: Column, units=None, penalty: float = DEFAULT_PENALTY) -> Column:
    """x^T Q x + const of a commitment, summed in its own row over the unit pairs."""
    units = fleet(units)
    n, p = len(units), F.lit(float(penalty))
    pairs = F.array(*[F.struct(F.lit(n - 1 - i).alias("i"), F.lit(n - 1 - j).alias("j"), F.lit(ui[1]).alias("cap_i"),
                               F.lit(uj[1]).alias("cap_j"), F.lit(ui[2]).alias("cost_i"))
                      for i, ui in enumerate(units) for j, uj in enumerate(units)])

    def add(total, u):
        both = (F.call_function("shiftright", commitment, u["i"]).bitwiseAND(F.lit(1)) == 1) & (
            F.call_function("shiftright", commitment, u["j"]).bitwiseAND(F.lit(1)) == 1)
        q = F.when(u["i"] == u["j"], u["cost_i"] + p * (u["cap_i"] * u["cap_i"] - F.lit(2.0) * target * u["cap_i"])) \
             .otherwise(p * u["cap_i"] * u["cap_j"])
        return total + F.when(both, q).otherwise(F.lit(0.0))

    return F.aggregate(pairs, F.lit(0.0), add) + p * target * target


def qubo_terms(targets: DataFrame, units=None, penalty: float = DEFAULT_PENALTY) -> DataFrame:
    """Long-form QUBO per distinct target: (target_load, i, j, q) plus const = P T^2.

    The N x N unit pairs are a literal array exploded per target (N is at most MAX_UNITS)."""
    units = fleet(units)
    pairs = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j"),
                               F.lit(ui[1]).alias("cap_i"), F.lit(uj[1]).alias("cap_j"),
                               F.lit(ui[2]).alias("cost_i"))
                      for i, ui in enumerate(units) for j, uj in enumerate(units)])
    p = F.lit(float(penalty))
    t = F.col("target_load")
    e = targets.select("target_load").distinct().withColumn("u", F.explode(pairs))
    ci, cj = F.col("u.cap_i"), F.col("u.cap_j")
    q = F.when(F.col("u.i") == F.col("u.j"),
               F.col("u.cost_i") + p * (ci * ci - F.lit(2.0) * t * ci)).otherwise(p * ci * cj)
    return e.select("target_load", F.col("u.i").alias("i"), F.col("u.j").alias("j"),
                    q.alias("q"), (p * t * t).alias("const"))
