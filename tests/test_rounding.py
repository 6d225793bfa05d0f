import random
import statistics
from fractions import Fraction

import duckdb

from pyspark.sql import functions as F

from gridlens.functions.rounding import (exact_mean, exact_sum, finish_means, mean_parts, merge_parts, py_mean, py_round,
                                         sql_py_mean, sql_py_round)
from gridlens.operators.scenarios import _summarise


def test_py_round_matches_python_and_sql_twin(spark):
    random.seed(11)
    vals = [1.005, 0.125, 2.675, 12.35, -12.35, 0.285, 2.5, -2.5, 1e-9, 0.0]
    vals += [round(random.uniform(-9000, 9000), random.choice([1, 2, 3])) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(vals)), "i long, x double")
    con = duckdb.connect()
    con.execute("create table t(i bigint, x double)")
    con.executemany("insert into t values (?, ?)", list(enumerate(vals)))
    for n in (0, 1, 2, 4):
        got = {r.i: r.r for r in df.select("i", py_round("x", n).alias("r")).collect()}
        twin = dict(con.execute(f"select i, {sql_py_round('x', n)} from t").fetchall())
        assert all(got[i] == round(v, n) for i, v in enumerate(vals))
        assert got == twin


def test_py_mean_exact_and_order_free(spark):
    rows = [(1, 100.0), (1, 120.0), (2, 0.125), (2, 0.125), (3, 1.01), (3, 1.02), (4, -5.0)]
    df = spark.createDataFrame(rows, "g long, x double")
    got = {r.g: r.m for r in df.groupBy("g").agg(py_mean("x", 2).alias("m")).collect()}
    assert got[1] == 110.0
    assert got[4] == -5.0
    # 1.015 is an exact decimal tie: it resolves by the double nearest 1.015, which
    # lies below (Python's mean of the two noisy inputs happens to land above).
    assert got[3] == round(1.015, 2) == 1.01
    assert got[2] == round(statistics.mean([0.125, 0.125]), 2)
    con = duckdb.connect()
    con.execute("create table t(g bigint, x double)")
    con.executemany("insert into t values (?, ?)", rows)
    twin = dict(con.execute(f"select g, {sql_py_mean('x', 2)} from t group by g").fetchall())
    assert got == twin
    # repartitioning never changes an exact sum
    a = df.agg(exact_sum("x").alias("s")).first().s
    b = df.repartition(5).agg(exact_sum("x").alias("s")).first().s
    assert a == b


def test_sums_have_the_same_bits_on_any_partitioning(spark):
    """Values of six decimals, summed over twenty random partitionings, and in two steps."""
    rng = random.Random(8)
    rows = [(rng.randrange(3), *(round(rng.uniform(-2e4, 9e4), 6) for _ in range(5))) for _ in range(1500)]
    df = spark.createDataFrame(rows, "g long, demand_mwh double, solar_mwh double, wind_mwh double, net_load_mwh double, "
                                     "residual_load_after_nuclear_mwh double").withColumn("ramp_mwh", F.lit(1.0)).persist()
    seen = set()
    for i in range(20):
        dealt = df.repartition(1 + rng.randrange(4), F.rand(i))
        plain = dealt.groupBy("g").agg(exact_sum("solar_mwh").alias("s"), exact_mean("solar_mwh").alias("m"), py_mean("solar_mwh").alias("p"))
        parts = dealt.withColumn("half", F.rint(F.rand(i + 50) * 2)).groupBy("g", "half").agg(mean_parts("solar_mwh").alias("p")).groupBy(
            "g").agg(merge_parts("p").alias("p"))
        shares = _summarise(dealt, ("g",)).select("g", "renewable_share")
        seen.add(tuple(sorted(map(tuple, df.collect())) for df in (plain, finish_means(parts, ["p"]), shares)).__repr__())
    df.unpersist()
    assert len(seen) == 1
    sums, merged, _ = eval(seen.pop())  # noqa: S307
    for g, s, m, p in sums:
        values = [r[2] for r in rows if r[0] == g]
        assert abs(s - sum(map(Fraction, values))) < 1e-6 and abs(m - float(sum(map(Fraction, values)) / len(values))) < 1e-9
        assert p == round(m, 2) and (g, p) in merged
