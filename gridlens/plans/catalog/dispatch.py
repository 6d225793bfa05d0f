"""Catalogue: unit commitment for every hourly target."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridlens.functions.rounding import py_round
from gridlens.functions.rounding import sql_py_round as R
from gridlens.operators import dispatch as DP
from gridlens.plans import oracle as O
from gridlens.plans.catalog.base import register, curve, curve_text
from gridlens.sources import fixtures as X


_UNITS = DP.fleet()
_NU = len(_UNITS)
_TOTAL_CAP = sum(c for _, c, _ in _UNITS)


def _dbl(v: float) -> str:
    return f"CAST({v!r} AS DOUBLE)"


def _sql_fold(pick: int) -> str:
    terms = " + ".join(
        f"(CASE WHEN (id >> {_NU - 1 - i}) & 1 = 1 THEN {_dbl(u[pick])} ELSE {_dbl(0.0)} END)"
        for i, u in enumerate(_UNITS))
    return f"({_dbl(0.0)} + {terms})"


def _sql_obj(cost: str, cap: str, t: str = "target_load") -> str:
    return f"({cost} + {DP.DEFAULT_PENALTY!r} * (({t} - {cap}) * ({t} - {cap})))"


_TARGETS_HOURLY = ("th", f"""SELECT period_utc, respondent,
        {R(f'(abs(residual_load_after_nuclear_mwh) % {_TOTAL_CAP!r})', 1)} AS target_load
    FROM ba_duck_curve_hourly""")
_TARGETS = ("tg", "SELECT DISTINCT target_load FROM th")
_SUBSETS = ("subsets", f"""SELECT id AS commitment, lpad(bin(id), {_NU}, '0') AS bits,
        {_sql_fold(1)} AS capacity, {_sql_fold(2)} AS cost
    FROM range({2 ** _NU}) t(id)""")
_SCORED = ("scored", f"""SELECT t.target_load, s.*,
        {R(_sql_obj('s.cost', 's.capacity', 't.target_load'), 6)} AS objective
    FROM tg t, subsets s""")
_BEST = ("best", """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER
        (PARTITION BY target_load ORDER BY objective, commitment) AS rn FROM scored) WHERE rn = 1""")
_DISPATCH = [_TARGETS_HOURLY, _TARGETS, _SUBSETS, _SCORED, _BEST]
_NAMES = "concat_ws(',', " + ", ".join(
    f"CASE WHEN (commitment >> {_NU - 1 - i}) & 1 = 1 THEN '{u[0]}' END"
    for i, u in enumerate(_UNITS)) + ")"
_REPORT_COLS = (f"bits, {_NAMES} AS committed, {R('capacity', 2)} AS served_capacity, "
                f"{R('cost', 2)} AS commit_cost, objective")


def _targets(spark, sf_dir):
    return DP.hourly_targets(X.fold_residual(curve(spark, sf_dir), _TOTAL_CAP))


@register("best_commitment", O.with_views(
    "SELECT target_load, commitment, bits, capacity, cost, objective FROM best",
    "ba_duck_curve_hourly", extra=_DISPATCH))
def q_best_commitment(spark, sf_dir):
    return DP.best_commitment(spark, _targets(spark, sf_dir))


@register("commitment_report", O.with_views(f"SELECT target_load, {_REPORT_COLS} FROM best",
                                            "ba_duck_curve_hourly", extra=_DISPATCH))
def q_commitment_report(spark, sf_dir):
    return DP.commitment_report(DP.best_commitment(spark, _targets(spark, sf_dir)))


@register("dispatch_hourly", O.with_views(f"""
SELECT {O.ts_text('th.period_utc')} AS period_utc, th.respondent, th.target_load, {_REPORT_COLS}
FROM th JOIN best USING (target_load)""", "ba_duck_curve_hourly", extra=_DISPATCH))
def q_dispatch_hourly(spark, sf_dir):
    return curve_text(DP.dispatch_hourly(spark, _targets(spark, sf_dir)))


_QUBO = ("qubo", f"""SELECT t.target_load, a.i, a.j,
        CASE WHEN a.i = a.j THEN a.cost_i + {DP.DEFAULT_PENALTY!r} * (a.cap_i * a.cap_i - 2.0 * t.target_load * a.cap_i)
             ELSE {DP.DEFAULT_PENALTY!r} * a.cap_i * a.cap_j END AS q,
        {DP.DEFAULT_PENALTY!r} * t.target_load * t.target_load AS const
    FROM tg t, (SELECT u.idx AS i, v.idx AS j, u.capacity AS cap_i, v.capacity AS cap_j,
                       u.cost AS cost_i
                FROM (VALUES {', '.join(f"({i}, {_dbl(c)}, {_dbl(k)})" for i, (_, c, k) in enumerate(_UNITS))})
                         u(idx, capacity, cost),
                     (VALUES {', '.join(f"({i}, {_dbl(c)}, {_dbl(k)})" for i, (_, c, k) in enumerate(_UNITS))})
                         v(idx, capacity, cost)) a""")


@register("qubo_terms", O.with_views("SELECT target_load, i, j, q, const FROM qubo",
                                     "ba_duck_curve_hourly", extra=[_TARGETS_HOURLY, _TARGETS, _QUBO]))
def q_qubo_terms(spark, sf_dir):
    return DP.qubo_terms(_targets(spark, sf_dir))


@register("commitment_cost", O.with_views(f"""
SELECT b.target_load, b.bits,
       {R('coalesce(sum(CASE WHEN (b.commitment >> (' + str(_NU - 1) + ' - q.i)) & 1 = 1 AND (b.commitment >> (' + str(_NU - 1) + ' - q.j)) & 1 = 1 THEN q.q ELSE 0.0 END), 0.0) + max(q.const)', 6)} AS qubo_objective,
       b.objective
FROM best b JOIN qubo q ON q.target_load = b.target_load
GROUP BY b.target_load, b.bits, b.objective""", "ba_duck_curve_hourly", extra=_DISPATCH + [_QUBO]))
def q_commitment_cost(spark, sf_dir):
    """x^T Q x + const of each optimum; equals the closed form."""
    best = DP.best_commitment(spark, _targets(spark, sf_dir))
    value = DP.qubo_objective(F.col("commitment"), F.col("target_load"))
    return best.select("target_load", "bits", py_round(value, 6).alias("qubo_objective"), "objective")


@register("commitment_gap", O.with_views(f"""
SELECT e.target_load, e.bits AS optimum_bits, c.bits AS candidate_bits,
       e.objective AS optimum_objective,
       {R(_sql_obj('c.cost', 'c.capacity', 'e.target_load'), 6)} AS candidate_objective,
       (e.commitment = c.commitment OR abs({R(_sql_obj('c.cost', 'c.capacity', 'e.target_load'), 6)}
            - e.objective) < 1e-6) AS optimum_recovered
FROM best e JOIN (SELECT target_load, commitment, bits, capacity, cost FROM (
        SELECT t.target_load, s.*, row_number() OVER (PARTITION BY t.target_load ORDER BY
            {R(_sql_obj('s.cost', 's.capacity', 'round_even(t.target_load, 0)'), 6)}, s.commitment) AS rn
        FROM tg t, subsets s) WHERE rn = 1) c USING (target_load)""",
    "ba_duck_curve_hourly", extra=_DISPATCH))
def q_commitment_gap(spark, sf_dir):
    """Candidate = the commitment solved on the whole-number target grid; is it
    still optimal at the exact target?"""
    t = _targets(spark, sf_dir).select("target_load").distinct()
    coarse = t.withColumn("coarse_load", F.rint("target_load"))
    solved = DP.best_commitment(spark, coarse, target_col="coarse_load").select(
        F.col("target_load").alias("coarse_load"), "commitment")
    cand = coarse.join(solved, "coarse_load").select("target_load", "commitment")
    return DP.commitment_gap(spark, cand, DP.best_commitment(spark, t))


@register("topk_commitments", O.with_views(f"""
SELECT target_load, commitment, bits, objective FROM (
    SELECT *, row_number() OVER (PARTITION BY target_load ORDER BY objective, commitment) AS rk
    FROM (SELECT *, row_number() OVER (PARTITION BY target_load
                     ORDER BY abs(target_load - capacity), commitment) AS sr FROM scored)
    WHERE sr <= 16) WHERE rk = 1""", "ba_duck_curve_hourly", extra=_DISPATCH))
def q_topk_commitments(spark, sf_dir):
    return DP.topk_commitments(spark, _targets(spark, sf_dir), k=16)
