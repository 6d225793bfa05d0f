"""File sinks: curve CSV export, scenario CSV, forecast and dispatch JSON.

Results that grow with the data (a curve's hours, dispatch records) are written by as many
tasks as hold them, in order from file to file; no sink pulls its input into one task.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gridlens.functions.timefmt import csv_text
from gridlens.schemas import CURVE_COLUMNS

SCENARIO_FIELDS = ["peak_demand_mwh", "min_net_load_mwh", "max_hourly_ramp_mwh",
                   "peak_residual_mwh", "curtailment_hours", "renewable_share"]
FORECAST_FIELDS = ["skill_score", "rmse_model", "rmse_persistence", "mae_model",
                   "n_train", "n_test"]


def duck_curve_export_rows(curve: DataFrame, respondent: str) -> DataFrame:
    """The 8 curve columns for one respondent ordered by hour; stamps as CSV text."""
    return (curve.where(F.col("respondent") == F.lit(respondent))
            .orderBy("period_utc")
            .select(csv_text("period_utc").alias("period_utc"), *CURVE_COLUMNS[1:]))


def export_duck_curve_csv(curve: DataFrame, path: str, *, respondent: str) -> int:
    """Write the export as one file with one header; returns its rows, counted while they are written.

    Every task of the range sort writes its own part next to ``path``; the parts are then put one behind
    the other through the file system, in order, and the file appears under its name only when it is whole."""
    spark, seen = curve.sparkSession, Observation("export")
    rows = duck_curve_export_rows(curve, respondent)
    aside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    try:
        rows.observe(seen, F.count(F.lit(1)).alias("rows")).write.option("header", False).csv(f"{aside}/parts")
        _concatenate(spark, f"{aside}/parts", ",".join(rows.columns) + "\n", f"{aside}/whole", path)
    finally:
        fs, folder = _file_system(spark, aside)
        fs.delete(folder, True)
    return int(seen.get["rows"])


def _file_system(spark, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _concatenate(spark, parts: str, head: str, whole: str, path: str) -> None:
    """Copy the part files of a folder, by name, behind ``head`` into ``whole``, and rename that to ``path``."""
    fs, folder = _file_system(spark, parts)
    names = sorted(s.getPath().getName() for s in fs.listStatus(folder) if s.getPath().getName().startswith("part-"))
    target, made = (_file_system(spark, p)[1] for p in (path, whole))
    copy = spark.sparkContext._jvm.org.apache.hadoop.io.IOUtils.copyBytes
    out = fs.create(made, True)
    try:
        out.write(bytearray(head.encode()))
        for name in names:
            part = fs.open(_file_system(spark, f"{parts}/{name}")[1])
            try:
                copy(part, out, 1 << 16, False)
            finally:
                part.close()
    finally:
        out.close()
    if fs.exists(target):
        fs.delete(target, True)
    if not fs.rename(made, target):
        raise OSError(f"cannot rename {whole} to {path}")


def write_scenario_csv(summary: DataFrame, path: str) -> None:
    """One folder per respondent (``<path>/respondent=X/``) with one CSV: the header
    ``scenario`` + six fields and one row per scenario in catalogue order (baseline first)."""
    (summary.select("respondent", "scenario_order", "scenario", *SCENARIO_FIELDS)
     .repartition("respondent").sortWithinPartitions("respondent", "scenario_order")
     .drop("scenario_order")
     .write.mode("overwrite").option("header", True).partitionBy("respondent").csv(path))


def write_forecast_json(metrics: DataFrame, path: str) -> None:
    """Per-series summary; prediction vectors are not written.  Rebalanced, so that no part is empty."""
    metrics.select("respondent", "series", *FORECAST_FIELDS).hint("rebalance").write.mode("overwrite").json(path)


def write_dispatch_json(result: DataFrame, path: str) -> None:
    result.write.mode("overwrite").json(path)
