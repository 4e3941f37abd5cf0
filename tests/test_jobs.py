"""End-to-end jobs on a raw file in the public UCI Air Quality layout."""


import math
import os
import tempfile

import pytest

from sensorgrid.plans import jobs

COLS = ["CO(GT)", "PT08.S1(CO)", "NMHC(GT)", "C6H6(GT)", "PT08.S2(NMHC)", "NOx(GT)", "PT08.S3(NOx)", "NO2(GT)",
        "PT08.S4(NO2)", "PT08.S5(O3)", "T", "RH", "AH"]
# the 12 priority features the reference's preparation selects for this column set
EXPECTED_FEATURES = ["AH", "AH__was_missing", "C6H6(GT)", "C6H6(GT)__was_missing", "CO(GT)", "CO(GT)__was_missing",
                     "NMHC(GT)", "NMHC(GT)__was_missing", "NO2(GT)", "NO2(GT)__was_missing", "NOx(GT)",
                     "NOx(GT)__was_missing"]


def eu(x):
    return ("%.1f" % x).replace(".", ",") if isinstance(x, float) else str(x)


@pytest.fixture(scope="module")
def raw_csv():
    import datetime as dt
    d = tempfile.mkdtemp(prefix="sg-uci-")
    path = os.path.join(d, "AirQualityUCI.csv")
    t0 = dt.datetime(2004, 12, 1)
    lines = [";".join(["Date", "Time"] + COLS) + ";;"]
    n = 0
    for i in range(24 * 62):
        if 300 <= i < 305:          # five missing hours
            continue
        t = t0 + dt.timedelta(hours=i)
        vals = []
        for j, c in enumerate(COLS):
            v = 2.0 + 1.5 * math.sin(i / (5.0 + j)) + 0.1 * j
            if (i + j) % 37 == 0:
                v = -200            # sentinel
            vals.append(v)
        tm = t.strftime("%H.%M.%S") if i % 2 else t.strftime("%H:%M:%S")
        lines.append(";".join([t.strftime("%d/%m/%Y"), tm] + [eu(v) for v in vals]) + ";;")
        n += 1
        if i == 100:                # a duplicate timestamp
            lines.append(lines[-1])
    lines.append(";;;;;;;;;;;;;;;;")
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path, n


def test_prepare_regress_classify(spark, raw_csv):
    from sensorgrid.session import scratch_path
    path, n_present = raw_csv
    out = scratch_path(spark, "uci")
    info = jobs.prepare_job(spark, path, out)
    assert info["co_column"] == "CO(GT)"
    assert info["features"] == EXPECTED_FEATURES
    assert info["rows_total"] == 24 * 62 and info["rows_after_warmup"] == 24 * 62 - 24
    assert info["X_shape"] == [24 * 62 - 24, 185]
    assert info["packs"]["trees"]["test"][0] == 24 * 31 and sum(c[1] for p in info["packs"].values() for c in p.values()) == 0
    cleaned = spark.read.parquet(f"{out}/cleaned")
    assert cleaned.where("__gap = 1").count() == 5
    splits = {r.split: r["count"] for r in spark.read.parquet(f"{out}/features/trees").groupBy("split").count().collect()}
    # the split is cut on the full grid, then the 24 warm-up rows are trimmed (as in the reference)
    assert splits["test"] == 24 * 31 and splits["train"] == int(0.8 * 24 * 31) - 24

    res = scratch_path(spark, "uci-res")
    counts = jobs.regression_job(spark, out, res, pollutants=["CO(GT)", "NO2(GT)"], horizons=(1, 6),
                                 linear=("LinearRegression", "Ridge"), trees=("DecisionTree",))
    # persistence, two linear models, one tree, the SVR equivalent on every (pollutant, horizon)
    assert counts["winners"] == 4 and counts["leaderboard"] == 5 * 4 and counts["family_best"] == 2 * 4
    board = spark.read.option("header", True).csv(f"{res}/leaderboard.csv")
    assert {r.model for r in board.select("model").collect()} == {"Naive_persistence", "LinearRegression", "Ridge", "DecisionTree", "LinearSVR"}
    winners = {(r.pollutant, r.horizon_h): r.model for r in spark.read.option("header", True).csv(f"{res}/winners.csv").collect()}
    top = spark.read.option("header", True).csv(f"{res}/top_by_cell.csv").where("rank = 1").collect()
    assert winners == {(r.pollutant, r.horizon_h): r.model for r in top}
    from sensorgrid.operators import models as M
    assert M.load_model("Ridge", f"{res}/models/CO(GT)/h6/Ridge").numFeatures == 185
    again = jobs.leaderboard_job(spark, f"{res}/results", scratch_path(spark, "uci-again"))
    assert again == {k: v for k, v in counts.items()}
    # a second run of the job fits nothing: its ledger has every task
    before = {r.task for r in spark.read.option("recursiveFileLookup", True).parquet(f"{res}/ledger").collect()}
    assert len(before) == 4 * 4
    rerun = jobs.regression_job(spark, out, res, pollutants=["CO(GT)", "NO2(GT)"], horizons=(1, 6),
                                linear=("LinearRegression", "Ridge"), trees=("DecisionTree",))
    assert rerun == counts and {r.task for r in spark.read.option("recursiveFileLookup", True).parquet(f"{res}/ledger").collect()} == before
    cls = scratch_path(spark, "uci-cls")
    acc = jobs.classification_job(spark, out, cls, horizons=(1, 6))
    assert M.load_model("LogisticRegression", f"{cls}/models/status/h6/LogisticRegression").numClasses >= 2
    assert set(acc) == {"Naive@1h", "Naive@6h", "LogisticRegression@1h", "LogisticRegression@6h"}
    assert all(0.0 <= v <= 1.0 for v in acc.values())

