import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridlens.operators import dispatch as DP

SMALL_UNITS = [("A", 4.0, 12.0), ("B", 3.0, 31.0), ("C", 2.0, 20.0), ("D", 5.0, 42.0)]


def brute(units, t, p=10.0):
    best = None
    for idx, bits in enumerate(itertools.product([0, 1], repeat=len(units))):
        cap = sum(u[1] for u, b in zip(units, bits) if b)
        cost = sum(u[2] for u, b in zip(units, bits) if b)
        obj = round(cost + p * (t - cap) ** 2, 6)
        if best is None or obj < best[0]:
            best = (obj, idx, "".join(map(str, bits)))
    return best


def test_default_instance_golden(spark):
    t = spark.createDataFrame([(15.4,)], "target_load double")
    r = DP.commitment_report(DP.best_commitment(spark, t)).first()
    assert r.bits == "1110000" and r.committed == "Hydro,CCGT-1,CCGT-2"
    assert (r.served_capacity, r.commit_cost, r.objective) == (15.5, 77.0, 77.1)
    assert DP.default_target() == 15.4


def test_small_fleet_covers_target(spark):
    t = spark.createDataFrame([(6.0,)], "target_load double")
    r = DP.commitment_report(DP.best_commitment(spark, t, units=SMALL_UNITS), units=SMALL_UNITS).first()
    assert r.bits == "1010" and r.objective == 32.0
    assert r.served_capacity >= 6.0


def test_default_fleet_matches_brute_force(spark):
    targets = [x / 10 for x in range(0, 300, 7)] + [1.0, 15.4, 28.0, 31.5]
    df = spark.createDataFrame([(t,) for t in targets], "target_load double")
    got = {r.target_load: (r.objective, r.commitment, r.bits)
           for r in DP.best_commitment(spark, df).collect()}
    for t in targets:
        assert got[t] == brute(DP.DEFAULT_UNITS, t), t


def test_under_serving_is_allowed(spark):
    t = spark.createDataFrame([(1.0,)], "target_load double")
    r = DP.best_commitment(spark, t).first()
    assert r.bits == "0000000" and r.objective == 10.0


def test_qubo_equals_closed_form(spark):
    t = spark.createDataFrame([(6.0,)], "target_load double")
    terms = {(r.i, r.j): (r.q, r.const) for r in DP.qubo_terms(t, units=SMALL_UNITS).collect()}
    assert len(terms) == 16
    for bits in itertools.product([0, 1], repeat=4):
        xqx = sum(terms[(i, j)][0] * bits[i] * bits[j] for i in range(4) for j in range(4))
        cap = sum(u[1] for u, b in zip(SMALL_UNITS, bits) if b)
        cost = sum(u[2] for u, b in zip(SMALL_UNITS, bits) if b)
        assert xqx + terms[(0, 0)][1] == pytest.approx(cost + 10.0 * (6.0 - cap) ** 2)


def test_gap_and_topk(spark):
    t = spark.createDataFrame([(15.4,)], "target_load double")
    opt = DP.best_commitment(spark, t)
    cand = spark.createDataFrame([(15.4, 112), (15.4, 0)], "target_load double, commitment long")
    rows = {r.candidate_bits: r.optimum_recovered for r in DP.commitment_gap(spark, cand, opt).collect()}
    assert rows == {"1110000": True, "0000000": False}
    top = DP.topk_commitments(spark, t, k=16).first()
    assert top.bits == "1110000"
    assert DP.topk_commitments(spark, t, k=1).first().objective >= top.objective


def test_a_users_score_picks_the_candidates(spark):
    t = spark.createDataFrame([(15.4,)], "target_load double")
    cheap = DP.topk_commitments(spark, t, score=lambda target, x: -x["cost"], k=1).first()
    assert cheap.bits == "0000000"  # nothing costs less than nothing


def every(units):
    """Capacity and cost of all commitments, each added up in unit order."""
    index = np.arange(2 ** len(units))
    cap, cost = np.zeros(len(index)), np.zeros(len(index))
    for i, (_, c, k) in enumerate(units):
        on = (index >> (len(units) - 1 - i)) & 1 == 1
        cap, cost = cap + np.where(on, c, 0.0), cost + np.where(on, k, 0.0)
    return cap, cost


def odd_fleet(n, seed=4):
    rng = random.Random(seed)
    return [(f"u{i}", rng.choice([rng.uniform(0.3, 9.0), 2.5, 4.0]), rng.choice([rng.uniform(1.0, 60.0), 20.0])) for i in range(n)]


@pytest.mark.parametrize("n,penalty", [(1, 10.0), (2, 10.0), (9, 0.0), (16, 10.0), (16, 0.02)])
def test_half_fleets_match_brute_force(spark, n, penalty):
    units = odd_fleet(n)
    cap, cost = every(units)
    targets = [float(i * (cap.max() + 3) / 150 - 1) for i in range(150)]
    df = spark.createDataFrame([(t,) for t in targets], "target_load double")
    got = {r.target_load: r for r in DP.best_commitment(spark, df, units=units, penalty=penalty).collect()}
    near = {r.target_load: r for r in DP.topk_commitments(spark, df, k=5, units=units, penalty=penalty).collect()}
    for t in targets:
        values = cost + penalty * ((t - cap) * (t - cap))
        close = np.flatnonzero(values <= values.min() + 1e-5)
        want = min((round(float(values[i]), 6), int(i)) for i in close)
        assert (got[t].objective, got[t].commitment) == want
        first = np.lexsort((np.arange(len(cap)), np.abs(t - cap)))[:5]
        assert (near[t].objective, near[t].commitment) == min((round(float(values[i]), 6), int(i)) for i in first)


def test_a_score_of_ones_own_sees_every_commitment(spark):
    units = odd_fleet(13)
    cap, cost = every(units)
    df = spark.createDataFrame([(t,) for t in (0.0, 11.3, 40.0)], "target_load double")
    got = {r.target_load: r for r in DP.topk_commitments(
        spark, df, score=lambda t, x: -F.abs(t - x["capacity"]) - x["cost"] / 50, k=7, units=units).collect()}
    for t in got:
        first = np.lexsort((np.arange(len(cap)), np.abs(t - cap) + cost / 50))[:7]
        values = cost + 10.0 * ((t - cap) * (t - cap))
        assert (got[t].objective, got[t].commitment) == min((round(float(values[i]), 6), int(i)) for i in first)


def test_forty_units_and_thousands_of_targets(spark):
    units = [(f"u{i}", 1.0 + i % 4, 10.0 + 3 * i) for i in range(40)]
    targets = spark.range(3000).selectExpr("id / 32.0 as target_load")
    got = {r.target_load: r for r in DP.best_commitment(spark, targets, units=units).collect()}
    assert len(got) == 3000
    # independent optimum: cheapest cost per whole capacity, by dynamic programming
    least = {0: 0.0}
    for _, cap, cost in units:
        for c, k in sorted(least.items(), reverse=True):
            least[c + int(cap)] = min(least.get(c + int(cap), 1e18), k + cost)
    for t, r in got.items():
        assert abs(r.objective - min(k + 10.0 * (t - c) ** 2 for c, k in least.items())) < 1e-6
    some = spark.createDataFrame([(17.3,), (61.75,)], "target_load double")
    mixed = odd_fleet(40)
    cap, cost = (np.array([u[i] for u in mixed]) for i in (1, 2))
    for r in DP.best_commitment(spark, some, units=mixed).collect():  # no single change or swap of units is better
        on = np.array([b == "1" for b in r.bits])
        for i, j in itertools.product(range(40), repeat=2):
            other = on.copy()
            other[[i, j]] = ~other[[i, j]]
            assert cost[other].sum() + 10.0 * (r.target_load - cap[other].sum()) ** 2 >= r.objective - 1e-5


def test_larger_fleets_are_refused():
    with pytest.raises(ValueError):
        DP.fleet([("u", 1.0, 1.0)] * (DP.MAX_UNITS + 1))


def test_dispatch_hourly_keeps_every_row(spark):
    rows = [(f"2025-04-01 {h:02d}:00:00", "CISO", t) for h, t in enumerate([15.4, 1.0, 15.4, 6.0, 27.9])]
    targets = spark.createDataFrame(rows, "period_utc string, respondent string, target_load double")
    a = sorted(map(tuple, DP.dispatch_hourly(spark, targets).collect()))
    assert len(a) == 5
    assert {r[0]: r[3] for r in a}[15.4] == "1110000"


def test_qubo_objective_equals_the_closed_form(spark):
    best = DP.best_commitment(spark, spark.range(40).selectExpr("id / 2.0 as target_load"))
    value = DP.qubo_objective(F.col("commitment"), F.col("target_load"))
    for r in best.withColumn("value", value).collect():
        assert abs(r.value - r.objective) < 1e-6
