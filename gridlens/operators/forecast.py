"""Hour-ahead wind and solar forecast with a skill score against persistence.

Each renewable series (solar, wind) of each respondent is one ordered series.
Features, all on the UTC clock and row-adjacent (gaps are not bridged):
hour sin/cos, weekday (Monday = 0), day-of-year sin/cos, the value 1 and 24
rows earlier and the mean of the 24 rows before.  Samples start at row 24; the
first ``int(n * (1 - test_frac))`` samples of a series train, the rest test.

A forecast has two parts.  Every series gets its own linear one: its normal equations are sums of
products, so one grouped aggregate over the training samples makes those of all series at once, and each is
solved from its own row.  What that leaves is learned by gradient-boosted trees, one model per
target series (solar, wind), on the residuals of *all* respondents with Spark ML.  Targets and levels
are scaled per series.  So each respondent keeps its own shape however many there are, and a fit
is one distributed job.  Predictions are floored at 0 and scored per (respondent, series).

skill = 1 - RMSE_model / RMSE_persistence (NaN when the baseline RMSE is 0).
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridlens.functions.rounding import REST_SCALE, rest_units
from gridlens.operators.windows import CARRIED, CHUNK, carried_part, chunk_window, lag_col, row_count, row_index, with_tails
from gridlens.session import checkpoint_dir

LAG_SHORT, LAG_DAY = 1, 24
MIN_SAMPLES = 48
SERIES = {"solar": "solar_mwh", "wind": "wind_mwh"}
FEATURES = ["hour_sin", "hour_cos", "dow", "doy_sin", "doy_cos", "lag_1", "lag_24", "roll_24"]
SERIES_KEYS = ["respondent", "series"]
UNITS = 100.0  # hundredths


def long_series(curve: DataFrame, series: dict[str, str] | None = None) -> DataFrame:
    """Unpivot the target columns into (respondent, series, period_utc, y) in one pass."""
    series = series or SERIES
    arr = F.array(*[F.struct(F.lit(name).alias("series"), F.col(col).cast("double").alias("y"))
                    for name, col in series.items()])
    return (curve.select("respondent", "period_utc", F.explode(arr).alias("s"))
            .select("respondent", F.col("s.series").alias("series"), "period_utc",
                    F.col("s.y").alias("y")))


def calendar_features(df: DataFrame, ts: str = "period_utc") -> DataFrame:
    two_pi = 2.0 * math.pi
    hour = F.hour(ts).cast("double")
    doy = F.dayofyear(ts).cast("double")
    return (df.withColumn("hour_sin", F.sin(F.lit(two_pi) * hour / F.lit(24.0)))
              .withColumn("hour_cos", F.cos(F.lit(two_pi) * hour / F.lit(24.0)))
              .withColumn("dow", F.weekday(ts).cast("double"))
              .withColumn("doy_sin", F.sin(F.lit(two_pi) * doy / F.lit(365.25)))
              .withColumn("doy_cos", F.cos(F.lit(two_pi) * doy / F.lit(365.25))))


def _units(c: F.Column) -> F.Column:
    return F.rint(c * F.lit(UNITS)).cast("long")


def _rest(c: F.Column) -> F.Column:
    """What a value has beyond whole units: exactly 0.0 for values of two decimals."""
    return c - F.rint(c * F.lit(UNITS)) / F.lit(UNITS)


def rolling_mean_24(w) -> F.Column:
    """Mean of the 24 rows before, over rows with tails (null where there is no value).  Whole hundredths and
    what lies beyond them (as whole 1e-12) are summed apart, so the result has the same bits however the rows
    are cut into chunks and in whatever order the engine adds."""
    frame = w.rowsBetween(-LAG_DAY, -1)
    carried = F.coalesce(F.filter(carried_part(LAG_DAY), lambda x: x.isNotNull()), F.array().cast("array<double>"))

    def total(part) -> F.Column:
        tail = F.aggregate(carried, F.lit(0).cast("long"), lambda whole, x: whole + part(x))
        return (F.coalesce(F.sum(part(F.col("y"))).over(frame), F.lit(0)) + tail).cast("double")

    n = (F.count("y").over(frame) + F.size(carried)).cast("double")
    return F.when(n > 0, total(_units) / (n * F.lit(UNITS)) + total(rest_units) / F.lit(REST_SCALE) / n)


def level_features(series_rows: DataFrame, chunk: str = CHUNK) -> DataFrame:
    """``row_index``, ``n_rows`` (of the series), ``lag_1``, ``lag_24`` and ``roll_24`` of every row.

    The windows are over chunks of a series (``chunk`` is a unit of date_trunc), whose first rows look back into
    the carried last 24 rows before."""
    w = chunk_window(SERIES_KEYS)
    rows = with_tails(series_rows, "y", LAG_DAY, SERIES_KEYS, chunk=chunk)
    return (rows.withColumn("row_index", row_index()).withColumn("n_rows", row_count())
            .withColumn("lag_1", lag_col("y", LAG_SHORT, w))
            .withColumn("lag_24", lag_col("y", LAG_DAY, w))
            .withColumn("roll_24", rolling_mean_24(w)).drop(*CARRIED))


def design_matrix(series_rows: DataFrame, test_frac: float = 0.25, chunk: str = CHUNK) -> DataFrame:
    """Features, target ``y``, ``persistence`` and ``row_index`` from row 24 on, plus
    the chronological split (``sample_index``, ``n_samples``, ``split``, ``is_train``)."""
    feats = calendar_features(level_features(series_rows, chunk)).withColumn("persistence", F.col("lag_24"))
    return chrono_split(feats.where(F.col("row_index") >= LAG_DAY), test_frac).drop("n_rows")


def chrono_split(samples: DataFrame, test_frac: float = 0.25) -> DataFrame:
    """First ``int(n * (1 - test_frac))`` samples of each series train, the rest test; ``samples`` are the rows of
    :func:`level_features` from row 24 on."""
    return (samples.withColumn("sample_index", F.col("row_index") - F.lit(LAG_DAY))
            .withColumn("n_samples", F.col("n_rows") - F.lit(LAG_DAY))
            .withColumn("split", F.floor(F.col("n_samples") * F.lit(1.0 - test_frac)).cast("long"))
            .withColumn("is_train", F.col("sample_index") < F.col("split")))


def check_sample_counts(design: DataFrame, minimum: int = MIN_SAMPLES) -> None:
    """Raise unless some series has the ``minimum`` of samples (one small aggregate job)."""
    longest = design.agg(F.max("n_samples")).first()[0] or 0
    if longest < minimum:
        raise ValueError(f"no series has {minimum} samples to fit on (the longest has {longest})")


# The booster settings of the reference (depth 4, learning rate
# 0.08, 300 rounds) plus its histogram booster's defaults that Spark does not
# share (255 bins per feature, at least 20 samples per leaf).
MAX_BINS = 255
MIN_SAMPLES_LEAF = 20

_LEVEL_FEATURES = ["lag_1", "lag_24", "roll_24"]
_REL = [f"{f}_rel" for f in _LEVEL_FEATURES]
_MODEL_FEATURES = [f for f in FEATURES if f not in _LEVEL_FEATURES] + _REL + ["linear_rel"]
HARMONICS = 3
#: Added to the diagonal of the normal equations, per sample: terms that never vary stay solvable.
RIDGE = 1e-6
#: Samples a task takes in a round.  A round is four short jobs one after the other, so with few samples a
#: task costs more than its work.
ROWS_A_TASK = 50_000


def linear_terms() -> dict[str, F.Column]:
    """The terms of the linear part: 1, the day's first harmonics, and the scaled levels."""
    angle = F.lit(2.0 * math.pi / 24.0) * F.hour("period_utc").cast("double")
    waves = {f"{name}_{k}": f(angle * k) for k in range(1, HARMONICS + 1) for name, f in (("sin", F.sin), ("cos", F.cos))}
    return {"one": F.lit(1.0), **waves, **{c: F.col(c) for c in _REL}}


def scaled_rows(design: DataFrame, minimum: int = MIN_SAMPLES) -> DataFrame:
    """Samples of the series long enough to fit, on a common scale.

    Target and level features are divided by the series' mean absolute training value, and every series weighs
    as much as the average one, so neither a small nor a short series is drowned by the others."""
    train = design.where(F.col("is_train") & (F.col("n_samples") >= minimum))
    levels = train.groupBy(*SERIES_KEYS).agg(F.avg(F.abs("y")).alias("level"), F.count("*").alias("n_fit"))
    mean = F.avg("n_fit").over(Window.partitionBy("series"))
    levels = levels.select(*SERIES_KEYS, F.when(F.col("level") > 0, F.col("level")).otherwise(F.lit(1.0)).alias("level"),
                           (mean / F.col("n_fit")).alias("weight"))
    rows = design.join(levels, SERIES_KEYS)
    return rows.select("*", (F.col("y") / F.col("level")).alias("y_rel"),
                       *((F.col(f) / F.col("level")).alias(f"{f}_rel") for f in _LEVEL_FEATURES))


def normal_equations(rows: DataFrame) -> DataFrame:
    """Per series of :func:`scaled_rows`: the sums ``xx`` (upper triangle, row by row) and ``xy`` over its training samples.

    One aggregate with partial sums before the shuffle, whatever the number and length of the series."""
    terms = linear_terms()
    train = rows.where("is_train").select(*SERIES_KEYS, "y_rel", *(c.alias(f"_{n}") for n, c in terms.items()))
    names = [f"_{n}" for n in terms]
    products = [F.sum(F.col(a) * F.col(b)) for i, a in enumerate(names) for b in names[i:]]
    return train.groupBy(*SERIES_KEYS).agg(
        F.count(F.lit(1)).alias("n"), F.array(*products).alias("xx"), F.array(*(F.sum(F.col(a) * F.col("y_rel")) for a in names)).alias("xy"))


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The coefficients of a batch of series."""
    for batch in batches:
        if not batch.num_rows:
            continue
        xy = batch.column("xy").flatten().to_numpy().reshape(batch.num_rows, -1)
        size = xy.shape[1]
        xx = np.zeros((batch.num_rows, size, size))
        upper = np.triu_indices(size)
        xx[:, upper[0], upper[1]] = batch.column("xx").flatten().to_numpy().reshape(batch.num_rows, -1)
        xx = xx + np.triu(xx, 1).transpose(0, 2, 1)
        xx += RIDGE * batch.column("n").to_numpy()[:, None, None] * np.eye(size)
        found = np.linalg.solve(xx, xy[:, :, None])[:, :, 0]
        yield pa.RecordBatch.from_arrays([batch.column(c) for c in SERIES_KEYS] + [pa.array(list(found), pa.list_(pa.float64()))],
                                         names=[*SERIES_KEYS, "coefficients"])


def linear_coefficients(equations: DataFrame) -> DataFrame:
    """(respondent, series, coefficients): each series' own least-squares solution, a row at a time."""
    return equations.mapInArrow(_solve, "respondent string, series string, coefficients array<double>")


def model_rows(design: DataFrame, minimum: int = MIN_SAMPLES) -> DataFrame:
    """:func:`scaled_rows` with the series' own linear prediction ``linear_rel`` and what it leaves, ``residual_rel``."""
    rows = scaled_rows(design, minimum)
    fitted = rows.join(linear_coefficients(normal_equations(rows)), SERIES_KEYS)
    linear = F.lit(0.0)
    for i, term in enumerate(linear_terms().values()):
        linear = linear + F.col("coefficients")[i] * term
    return fitted.withColumn("linear_rel", linear).drop("coefficients").withColumn("residual_rel", F.col("y_rel") - F.col("linear_rel"))


def fit_tasks(rows: DataFrame) -> dict[str, int]:
    """By series name, into how many tasks the training samples go: more samples more tasks, up to a shuffle's usual
    number.  The one pass also computes ``rows``, where they are persisted, on all their partitions."""
    usual = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows.sparkSession.sparkContext.defaultParallelism)
    return {r["series"]: min(-(-r["n"] // ROWS_A_TASK), usual)
            for r in rows.where("is_train").groupBy("series").agg(F.count(F.lit(1)).alias("n")).collect()}


def fit_forecast(rows: DataFrame, *, max_iter: int = 300, max_depth: int = 4,
                 step_size: float = 0.08, seed: int = 0,
                 series: Sequence[str] | None = None) -> dict:
    """Fit one boosted-tree regressor per series name on the residuals of the training samples of :func:`model_rows`."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    checkpoint_dir(rows.sparkSession)  # boosting cuts its lineage there every ten rounds
    names = list(series or SERIES)
    assembler = VectorAssembler(inputCols=_MODEL_FEATURES, outputCol="features")
    tasks = fit_tasks(rows)

    def fit(name):
        train = assembler.transform(rows.where((F.col("series") == name) & F.col("is_train"))).select(
            "features", "residual_rel", "weight").repartition(tasks.get(name, 1))
        gbt = GBTRegressor(featuresCol="features", labelCol="residual_rel", weightCol="weight", maxDepth=max_depth,
                           stepSize=step_size, maxIter=max_iter, seed=seed, maxBins=MAX_BINS,
                           minInstancesPerNode=MIN_SAMPLES_LEAF)
        return gbt.fit(train)

    # One fit per target series (a fixed, small set), each distributed over all
    # respondents' samples; the fits are independent, so their jobs run side by side.
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        return dict(zip(names, pool.map(fit, names)))


def predict_clip(rows: DataFrame, models: dict) -> DataFrame:
    """Test samples of :func:`model_rows` with (truth, prediction floored at 0, persistence baseline)."""
    from pyspark.ml.feature import VectorAssembler

    assembler = VectorAssembler(inputCols=_MODEL_FEATURES, outputCol="features")
    out = None
    for name, model in models.items():
        test = assembler.transform(rows.where((F.col("series") == name) & ~F.col("is_train")))
        pred = clipped(model.transform(test).withColumn("prediction", (F.col("linear_rel") + F.col("prediction")) * F.col("level")))
        out = pred if out is None else out.unionByName(pred)
    return out


def clipped(predicted: DataFrame) -> DataFrame:
    """(keys, truth, prediction floored at 0, persistence) of predicted samples."""
    return predicted.select(
        "respondent", "series", "period_utc", "sample_index", F.col("y").alias("truth"),
        F.greatest(F.col("prediction"), F.lit(0.0)).alias("prediction"), "persistence")


def forecast_metrics(pred: DataFrame, design: DataFrame) -> DataFrame:
    """rmse_model, rmse_persistence, mae_model, skill_score, n_train, n_test per series.

    Every series of ``design`` has a row; one without predictions (too short to fit) has null scores."""
    sizes = design.groupBy(*SERIES_KEYS).agg(
        F.max("split").alias("n_train"), (F.max("n_samples") - F.max("split")).alias("n_test"))
    m = pred.groupBy(*SERIES_KEYS).agg(
        F.sqrt(F.avg(F.pow(F.col("truth") - F.col("prediction"), 2))).alias("rmse_model"),
        F.sqrt(F.avg(F.pow(F.col("truth") - F.col("persistence"), 2))).alias("rmse_persistence"),
        F.avg(F.abs(F.col("truth") - F.col("prediction"))).alias("mae_model"))
    return sizes.join(m, SERIES_KEYS, "left").withColumn("skill_score", F.when(
        F.col("rmse_model").isNotNull(), skill_score("rmse_model", "rmse_persistence")))


def skill_score(model_rmse: str, base_rmse: str) -> F.Column:
    return F.when(F.col(base_rmse) > 0, F.lit(1.0) - F.col(model_rmse) / F.col(base_rmse)) \
            .otherwise(F.lit(float("nan")))


def forecast_renewables(curve: DataFrame, *, test_frac: float = 0.25, **fit_kwargs) -> DataFrame:
    """Solar and wind for every respondent: one row of metrics per series.

    The samples are kept for the fit's rounds and released once the few metric rows are
    written down; a series with fewer than 48 samples is reported without scores."""
    design = design_matrix(long_series(curve), test_frac)
    check_sample_counts(design)
    rows = model_rows(design).persist()
    try:
        metrics = forecast_metrics(predict_clip(rows, fit_forecast(rows, **fit_kwargs)), design)
        path = f"{checkpoint_dir(curve.sparkSession)}/forecast-{uuid.uuid4().hex}"
        metrics.write.parquet(path)
    finally:
        rows.unpersist()
    return curve.sparkSession.read.schema(metrics.schema).parquet(path)


def persistence_metrics(design: DataFrame) -> DataFrame:
    """RMSE and MAE of the persistence baseline on each series' test tail.

    Differences are taken in whole hundredths, summed as decimals, with what lies beyond
    them added apart as decimals of twelve places, so the result has the same bits on any partitioning."""
    y, before = F.col("y"), F.col("persistence")
    whole, rest = _units(y) - _units(before), _rest(y) - _rest(before)
    gap = whole / F.lit(UNITS)
    test = design.where(~F.col("is_train"))
    n = F.count(F.lit(1)).cast("double")

    def small(x):
        return F.sum(x.cast("decimal(28,12)")).cast("double")

    return test.groupBy(*SERIES_KEYS).agg(
        F.max("split").alias("n_train"),
        (F.max("n_samples") - F.max("split")).alias("n_test"),
        F.sqrt(F.sum((whole * whole).cast("decimal(38,0)")).cast("double") / (n * F.lit(UNITS * UNITS))
               + small(gap * rest * 2 + rest * rest) / n).alias("rmse_persistence"),
        (F.sum(F.abs(whole)).cast("double") / (n * F.lit(UNITS))
         + small(F.abs(gap + rest) - F.abs(gap)) / n).alias("mae_persistence"))
