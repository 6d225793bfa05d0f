import csv
import glob
import json
import os

from test_scenarios import structured_curve

from gridlens.operators import dispatch as DP
from gridlens.operators import scenarios as SC
from gridlens.sources import sinks


def test_scenario_csv_and_dispatch_json(spark, workdir):
    summary = SC.scenario_compare(structured_curve(spark, 3))
    out = os.path.join(workdir, "scen")
    sinks.write_scenario_csv(summary, out)
    rows = list(csv.reader(open(glob.glob(os.path.join(out, "respondent=DEMO", "*.csv"))[0])))
    assert rows[0] == ["scenario", *sinks.SCENARIO_FIELDS]
    assert [r[0] for r in rows[1:]] == ["baseline", *[l for l, _, _ in SC.DEFAULT_SCENARIOS]]
    t = spark.createDataFrame([(15.4,)], "target_load double")
    res = DP.commitment_report(DP.best_commitment(spark, t))
    out2 = os.path.join(workdir, "disp")
    sinks.write_dispatch_json(res, out2)
    rec = json.loads(open(glob.glob(os.path.join(out2, "*.json"))[0]).readline())
    assert rec["bits"] == "1110000" and rec["objective"] == 77.1


def test_forecast_json_drops_vectors(spark, workdir):
    m = spark.createDataFrame(
        [("R", "solar", 0.5, 1.0, 2.0, 0.8, 10, 4, [1.0])],
        "respondent string, series string, skill_score double, rmse_model double, "
        "rmse_persistence double, mae_model double, n_train long, n_test long, predictions array<double>")
    out = os.path.join(workdir, "fc")
    sinks.write_forecast_json(m, out)
    parts = glob.glob(os.path.join(out, "*.json"))
    assert all(os.path.getsize(p) for p in parts)
    (rec,) = [json.loads(line) for p in parts for line in open(p)]
    assert "predictions" not in rec and rec["n_test"] == 4 and rec["skill_score"] == 0.5


def test_curve_export_is_one_ordered_file(spark, workdir):
    """Several tasks write, one file with one header results, and an older export is replaced."""
    curve = structured_curve(spark, 30).repartition(7)
    out = os.path.join(workdir, "curve.csv")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        plan = sinks.duck_curve_export_rows(curve, "DEMO")._jdf.queryExecution().executedPlan().toString()
        assert "rangepartitioning" in plan and "SinglePartition" not in plan
        for _ in range(2):
            assert sinks.export_duck_curve_csv(curve, out, respondent="DEMO") == 720
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    with open(out) as file:
        rows = list(csv.reader(file))
    assert rows[0][:2] == ["period_utc", "respondent"] and len(rows) == 721
    assert [r[0] for r in rows[1:]] == sorted(r[0] for r in rows[1:]) and len({r[0] for r in rows[1:]}) == 720
    assert os.listdir(workdir) == ["curve.csv"] or set(os.listdir(workdir)) == {"curve.csv", ".curve.csv.crc"}
    assert sinks.export_duck_curve_csv(curve, out, respondent="NONE") == 0
    with open(out) as file:
        assert file.read().count("\n") == 1
