import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridlens.operators import forecast as FC
from gridlens.operators.windows import hourly_ramp


def _series(seed):
    """Respondents with gaps of hours, days and months, single rows in a chunk, nulls, and six decimals."""
    rng, rows = random.Random(seed), []
    for respondent, n, gap in (("dense", 400, 0.02), ("gaps", 300, 0.4), ("sparse", 60, 1.0), ("one", 1, 0.0)):
        t = datetime(2024, 11, 28)
        for _ in range(n):
            t += timedelta(hours=1 if rng.random() >= gap else rng.choice([2, 5, 30, 200, 900]))
            rows.append((respondent, "solar", t, None if rng.random() < 0.05 else round(rng.uniform(-50, 900), rng.choice([2, 6]))))
    rng.shuffle(rows)
    return rows


def _plain(rows):
    """(respondent, period) -> index, series length, lags, mean of the 24 rows before; in plain Python."""
    out = {}
    for respondent in {r[0] for r in rows}:
        own = sorted((r[2], r[3]) for r in rows if r[0] == respondent)
        for i, (t, _) in enumerate(own):
            back = [y for _, y in own[max(0, i - 24):i] if y is not None]
            out[respondent, t] = (i, len(own), own[i - 1][1] if i else None, own[i - 24][1] if i >= 24 else None,
                                  sum(back) / len(back) if back else None)
    return out


@pytest.mark.parametrize("chunk", ["day", "week", "month", "year"])
def test_chunks_equal_the_whole_series(spark, chunk):
    rows = _series(7)
    df = spark.createDataFrame(rows, "respondent string, series string, period_utc timestamp, y double").repartition(5)
    got = FC.level_features(df, chunk).collect()
    want = _plain(rows)
    assert len(got) == len(rows)
    for r in got:
        index, n, lag_1, lag_24, mean = want[r.respondent, r.period_utc]
        assert (r.row_index, r.n_rows, r.lag_1, r.lag_24) == (index, n, lag_1, lag_24), r
        assert r.roll_24 == pytest.approx(mean, rel=1e-12) if mean is not None else r.roll_24 is None


def test_rolling_means_have_the_same_bits_in_every_chunking(spark):
    df = spark.createDataFrame(_series(8), "respondent string, series string, period_utc timestamp, y double")
    bits = {chunk: {(r.respondent, r.period_utc): r.roll_24 for r in FC.level_features(df, chunk).collect()}
            for chunk in ("day", "month", "year")}
    assert bits["day"] == bits["month"] == bits["year"]


def test_chunked_ramps_equal_plain_ones_and_their_tasks_grow_with_time(spark):
    df = spark.createDataFrame(_series(9), "respondent string, series string, period_utc timestamp, y double")
    ramps = {chunk: {(r.respondent, r.period_utc): r.ramp for r in hourly_ramp(df, "y", out="ramp", chunk=chunk).collect()}
             for chunk in (None, "day", "month")}
    assert ramps[None] == ramps["day"] == ramps["month"] and len(ramps[None]) == df.count()
    assert hourly_ramp(df, "y", chunk="month").columns == [*df.columns, "ramp_mwh"]
    empty = df.where("false")
    assert hourly_ramp(empty, "y", chunk="month").count() == FC.level_features(empty).count() == 0
    # the windows over rows are dealt by chunk as well as by series; only rows per chunk are ordered by series
    plan = FC.level_features(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(respondent" in plan and "_chunk" in plan.split("hashpartitioning(respondent", 1)[1].split(")")[0]
    months = df.select("respondent", F.date_trunc("month", "period_utc")).distinct().count()
    assert months > 3 * df.select("respondent").distinct().count()
