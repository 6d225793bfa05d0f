import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_scenarios import structured_curve

from gridlens.operators import forecast as FC


def test_design_matrix_shapes(spark):
    curve = structured_curve(spark, 10)
    d = FC.design_matrix(FC.long_series(curve))
    rows = d.where(F.col("series") == "solar").orderBy("period_utc").collect()
    assert len(rows) == 10 * 24 - 24
    assert rows[0].row_index == 24 and rows[0].sample_index == 0
    n = len(rows)
    assert sum(r.is_train for r in rows) == int(n * 0.75)
    ys = [r.y for r in curve.orderBy("period_utc").select(F.col("solar_mwh").alias("y")).collect()]
    assert rows[0].lag_1 == ys[23] and rows[0].lag_24 == ys[0] and rows[0].persistence == ys[0]
    assert math.isclose(rows[0].roll_24, sum(ys[0:24]) / 24, rel_tol=1e-12)
    assert rows[0].dow == float(rows[0].period_utc.weekday())  # Monday = 0


def test_a_short_series_is_reported_and_only_short_ones_fail(spark):
    short = structured_curve(spark, 2, "SHORT")
    with pytest.raises(ValueError, match="48 samples"):
        FC.check_sample_counts(FC.design_matrix(FC.long_series(short)))
    both = FC.forecast_renewables(short.union(structured_curve(spark, 12)), max_iter=3).collect()
    got = {(r.respondent, r.series): r for r in both}
    assert len(got) == 4
    assert got["SHORT", "solar"].skill_score is None and got["SHORT", "solar"].n_train == 18
    assert got["DEMO", "solar"].rmse_model > 0


def test_forecast_beats_persistence(spark):
    curve = structured_curve(spark, 40)
    m = {r.series: r for r in FC.forecast_renewables(curve, max_iter=40).collect()}
    for series in ("solar", "wind"):
        assert m[series].n_test > 0 and m[series].rmse_model >= 0
    assert m["solar"].skill_score > 0.3
    assert m["wind"].skill_score > 0.0


def test_a_small_respondent_is_forecast_as_well_as_alone(spark):
    large, small = structured_curve(spark, 20), structured_curve(spark, 20, "SMALL", 0.02)
    pooled = {(r.respondent, r.series): r.skill_score for r in FC.forecast_renewables(large.union(small), max_iter=30).collect()}
    for curve in (large, small):
        for r in FC.forecast_renewables(curve, max_iter=30).collect():
            assert pooled[r.respondent, r.series] > r.skill_score - 0.05, (r, pooled)


def test_predictions_have_a_floor(spark):
    d = spark.createDataFrame([("R", "solar", 1, 5, 2.0, -3.0, 1.0)], "respondent string, series string, period_utc int, "
                              "sample_index int, y double, prediction double, persistence double")
    assert FC.clipped(d).first().prediction == 0.0


def many_shapes(spark, respondents, days):
    """Respondents whose days differ: solar by hour, width and size, wind by phase and swing, each with its own noise."""
    r, h = F.col("r"), F.col("h").cast("double")
    part = lambda salt, n: (F.xxhash64(r, F.lit(salt)) % n + n) % n
    noise = lambda salt: (F.xxhash64(r, F.col("h"), F.lit(salt)) % 1000) / 1000.0
    size = F.pow(F.lit(10.0), part(1, 30) / 10.0)
    sun = F.pow(F.greatest(F.sin(2 * math.pi * (h - part(2, 24)) / 24), F.lit(0.0)), 1 + part(3, 3))
    wind = 1.5 + 0.3 * (1 + part(4, 3)) * F.sin(2 * math.pi * (h / 24 + part(5, 24) / 24)) + 0.2 * noise(6)
    return spark.range(respondents * days * 24).select((F.col("id") % respondents).alias("r"), F.floor(F.col("id") / respondents).alias("h")).select(
        F.concat(F.lit("R"), r).alias("respondent"), (F.timestamp_seconds(F.lit(1704067200) + F.col("h") * 3600)).alias("period_utc"),
        (size * sun * (1 + 0.15 * noise(7))).alias("solar_mwh"), (size * wind).alias("wind_mwh"))


def test_each_of_400_respondents_keeps_its_own_shape(spark):
    curve = many_shapes(spark, 400, 12)
    pooled = {(r.respondent, r.series): r.skill_score for r in FC.forecast_renewables(curve, max_iter=5).collect()}
    assert len(pooled) == 800 and sum(s > 0 for s in pooled.values()) > 760
    for own in ("R7", "R250"):
        for r in FC.forecast_renewables(curve.where(F.col("respondent") == own), max_iter=5).collect():
            assert pooled[own, r.series] > r.skill_score - 0.05, (r, pooled[own, r.series])


def test_linear_part_is_the_least_squares_solution(spark):
    rows = FC.scaled_rows(FC.design_matrix(FC.long_series(many_shapes(spark, 3, 10))))
    got = {(r.respondent, r.series): r.coefficients for r in FC.linear_coefficients(FC.normal_equations(rows)).collect()}
    terms = rows.where("is_train").select("respondent", "series", "y_rel", *(c.alias(f"_{n}") for n, c in FC.linear_terms().items())).toPandas()
    assert len(got) == 6
    for key, part in terms.groupby(["respondent", "series"]):
        x, y = part[[c for c in part if c.startswith("_")]].to_numpy(), part["y_rel"].to_numpy()
        want = np.linalg.solve(x.T @ x + FC.RIDGE * len(x) * np.eye(x.shape[1]), x.T @ y)
        assert np.allclose(x @ got[key], x @ want, atol=1e-6)


def test_a_round_has_as_many_tasks_as_its_samples_need(spark, monkeypatch):
    rows = FC.model_rows(FC.design_matrix(FC.long_series(many_shapes(spark, 3, 10)))).persist()
    seen = spark.sparkContext.statusTracker()

    def tasks_of(fit):
        before = set(seen.getJobIdsForGroup(None))
        fit()
        jobs = [seen.getJobInfo(j) for j in set(seen.getJobIdsForGroup(None)) - before]
        return sum(stage.numCompletedTasks for job in jobs for s in job.stageIds if (stage := seen.getStageInfo(s)))

    try:
        assert FC.fit_tasks(rows) == {"solar": 1, "wind": 1}
        # two series, four rounds of four jobs, two stages each; as many again are left for what comes before
        assert 0 < tasks_of(lambda: FC.fit_forecast(rows, max_iter=4)) < 2 * 4 * 4 * 2 * 2
        monkeypatch.setattr(FC, "ROWS_A_TASK", 200)
        assert FC.fit_tasks(rows) == {"solar": 3, "wind": 3}  # 486 samples each
        monkeypatch.setattr(FC, "ROWS_A_TASK", 1)
        assert set(FC.fit_tasks(rows).values()) == {8}
    finally:
        rows.unpersist()
