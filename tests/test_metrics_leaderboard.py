"""Metrics against hand computations; leaderboard operators on hand-built score tables."""

import math

from pyspark.sql import functions as F

from sensorgrid.operators import leaderboard as lb
from sensorgrid.operators import metrics



def test_regression_metrics_nulls_zero(spark):
    df = spark.createDataFrame([(0.0, 1.0), (2.0, 2.5), (None, 3.0), (4.0, None), (6.0, 5.0)], "y_true double, y_pred double")
    r = metrics.regression_metrics(df).first()
    ys, ps = [0.0, 2.0, 6.0], [1.0, 2.5, 5.0]
    err = [a - b for a, b in zip(ys, ps)]
    assert r.n == 3
    assert abs(r.RMSE - math.sqrt(sum(e * e for e in err) / 3)) < 1e-12
    assert abs(r.MAE - sum(abs(e) for e in err) / 3) < 1e-12
    assert abs(r["MAPE(%)"] - (abs(-0.5 / 2.0) + abs(1.0 / 6.0)) / 2 * 100) < 1e-12
    m = sum(ys) / 3
    assert abs(r.R2 - (1 - sum(e * e for e in err) / sum((y - m) ** 2 for y in ys))) < 1e-12


def test_r2_constant_truth(spark):
    df = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y_true double, y_pred double")
    assert metrics.regression_metrics(df).first().R2 == 1.0
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 1.0)], "y_true double, y_pred double")
    assert metrics.regression_metrics(df).first().R2 == 0.0
    assert metrics.regression_metrics(df, constant_y="null").first().R2 is None


def test_classification_zero_division(spark):
    # class 2 is never predicted: its precision is 0 (zero_division=0); class 1 never true
    y = [0, 0, 2, 2, 0]
    p = [0, 1, 0, 0, 0]
    df = spark.createDataFrame(list(zip(y, p)), "y_true int, y_pred int")
    r = metrics.classification_metrics(df).first()
    # per class (0, 1, 2): tp (2, 0, 0), predicted (4, 1, 0), support (3, 0, 2)
    prec = [2 / 4, 0.0, 0.0]
    rec = [2 / 3, 0.0, 0.0]
    f1 = [2 * 2 / (4 + 3), 0.0, 0.0]
    assert abs(r.accuracy - 2 / 5) < 1e-12
    assert abs(r.precision_macro - sum(prec) / 3) < 1e-12
    assert abs(r.recall_macro - sum(rec) / 3) < 1e-12
    assert abs(r.f1_macro - sum(f1) / 3) < 1e-12
    sup = [3, 0, 2]
    assert abs(r.precision_weighted - sum(a * b for a, b in zip(prec, sup)) / 5) < 1e-12
    assert abs(r.f1_weighted - sum(a * b for a, b in zip(f1, sup)) / 5) < 1e-12


def test_confusion_and_distribution(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (2, 0), (2, 2)], "y_true int, y_pred int")
    cm = {r.y_true: (r.pred_0, r.pred_1, r.pred_2) for r in metrics.confusion_matrix(df).collect()}
    assert cm == {0: (1, 1, 0), 1: (0, 0, 0), 2: (1, 0, 1)}
    d = spark.createDataFrame([("train", 0), ("train", 0), ("test", 2)], "split string, target_cls int")
    got = sorted(tuple(r) for r in metrics.class_distribution(d).collect())
    assert got == [("test", 0, 0), ("test", 1, 0), ("test", 2, 1), ("train", 0, 2), ("train", 1, 0), ("train", 2, 0)]


def test_histogram_max_in_last_bin(spark):
    df = spark.createDataFrame([(float(i), 0.0) for i in range(31)], "y_true double, y_pred double")
    h = {r.bin: r.n for r in metrics.residual_histogram(df, bins=30).collect()}
    assert sum(h.values()) == 31 and h[30] == 2 and max(h) == 30


def test_model_family_rules(spark):
    names = ["LSTM_nn48", "GRU", "RandomForest", "ExtraTrees", "DecisionTree", "lightgbm", "LinearSVR", "Ridge",
             "Naive", "MLP", "GBDT", "XGBoost"]
    df = spark.createDataFrame([(n,) for n in names], "model string")
    from sensorgrid.functions.exprs import family_of, model_family
    got = {r.model: r.f for r in df.select("model", model_family(F.col("model")).alias("f")).collect()}
    assert got["LSTM_nn48"] == "RNN" and got["GRU"] == "RNN"
    assert got["DecisionTree"] == "Tree" and got["lightgbm"] == "Tree"
    assert got["LinearSVR"] == "Linear/Kernel" and got["Naive"] == "Other" and got["MLP"] == "Other"
    old = {r.model: r.f for r in df.select("model", family_of(F.col("model")).alias("f")).collect()}
    assert old["DecisionTree"] == "Other" and old["lightgbm"] == "Other" and old["XGBoost"] == "Tree"


def test_normalize_scores(spark):
    df = spark.createDataFrame([("Ridge", "CO(GT)", "6h", "0.5", "1.0", "2.0", "3.0")],
                               "model string, pollutant string, horizon string, R2 string, RMSE string, MAE string, MAPE string")
    r = lb.normalize_scores(df).first()
    assert r.horizon_h == 6 and r["MAPE(%)"] == 3.0 and r.R2 == 0.5


def _scores(spark, rows):
    return spark.createDataFrame(rows, "model string, pollutant string, horizon_h int, R2 double, RMSE double, "
                                       "MAE double, `MAPE(%)` double, run_id long")


def test_winners_family_best_and_averages(spark):
    rows = [
        # CO 1h: Naive has the top R2; among Linear/Kernel, Ridge's better duplicate run (0.75) beats Lasso
        ("RandomForest", "CO(GT)", 1, 0.80, 1.0, 0.5, 10.0, 1), ("Ridge", "CO(GT)", 1, 0.70, 1.1, 0.6, 11.0, 2),
        ("Lasso", "CO(GT)", 1, 0.70, 1.2, 0.7, 12.0, 3), ("LSTM", "CO(GT)", 1, 0.60, 1.3, 0.8, 13.0, 4),
        ("Naive", "CO(GT)", 1, 0.90, 0.9, 0.4, 9.0, 5),
        # a duplicate run of Ridge with a better R2: dedup keeps it
        ("Ridge", "CO(GT)", 1, 0.75, 1.05, 0.55, 10.5, 6),
        # NO2 6h: GRU_nn48 wins overall, DecisionTree is the Tree family best
        ("GRU_nn48", "NO2(GT)", 6, 0.50, 2.0, 1.0, 20.0, 7), ("DecisionTree", "NO2(GT)", 6, 0.40, 2.1, 1.1, 21.0, 8),
        ("MLP", "NO2(GT)", 6, 0.45, 2.2, 1.2, 22.0, 9),
    ]
    df = _scores(spark, rows)
    best = lb.dedup_keep_best(df)
    win = {(r.pollutant, r.horizon_h): (r.model, r.family) for r in lb.overall_winners(best).collect()}
    assert win == {("CO(GT)", 1): ("Naive", "Other"), ("NO2(GT)", 6): ("GRU_nn48", "RNN")}
    fam = {(r.pollutant, r.horizon_h, r.family): r.model for r in lb.family_best_by_cell(best).collect()}
    assert fam == {("CO(GT)", 1, "Tree"): "RandomForest", ("CO(GT)", 1, "Linear/Kernel"): "Ridge",
                   ("CO(GT)", 1, "RNN"): "LSTM", ("NO2(GT)", 6, "Tree"): "DecisionTree",
                   ("NO2(GT)", 6, "RNN"): "GRU_nn48"}
    # averages drop naive and RNN models and keep the best run per (model, cell)
    avg = {r.pollutant: (r.R2_mean, r.R2_std) for r in lb.avg_by_pollutant(df).collect()}
    m, s = avg["CO(GT)"]
    assert abs(m - (0.80 + 0.75 + 0.70) / 3) < 1e-12 and abs(s - 0.05) < 1e-12
    m, s = avg["NO2(GT)"]
    assert abs(m - 0.425) < 1e-12
    by_model = {r.model: r.R2 for r in lb.avg_by_model(df).collect()}
    assert "Naive" in by_model and "LSTM" not in by_model and abs(by_model["Ridge"] - 0.75) < 1e-12


def test_top3_and_pivot(spark):
    rows = [("Ridge", "CO(GT)", 1, 0.5, 1.0, 1.0, 1.0, 1), ("GBDT", "CO(GT)", 6, 0.7, 1.0, 1.0, 1.0, 2),
            ("Ridge", "CO(GT)", 6, 0.7, 1.0, 1.0, 1.0, 3), ("LSTM", "CO(GT)", 24, 0.9, 1.0, 1.0, 1.0, 4),
            ("Lasso", "CO(GT)", 12, 0.1, 1.0, 1.0, 1.0, 5)]
    df = spark.createDataFrame(rows, "model string, pollutant string, horizon_h int, R2 double, RMSE double, "
                                     "MAE double, `MAPE(%)` double, run_id long")
    t3 = [(r.rank, r.model, r.label) for r in lb.top3_by_pollutant(df).orderBy("rank").collect()]
    assert t3 == [(1, "LSTM", "LSTM (RNN, 24h)"), (2, "GBDT", "GBDT (Tree, 6h)"), (3, "Ridge", "Ridge (Linear/Kernel, 6h)")]
    pv = lb.pivot_scores(lb.overall_winners(df)).first()
    assert (pv.h1, pv.h6, pv.h12, pv.h24) == (0.5, 0.7, 0.1, 0.9)


def test_family_r2_pivot(spark):
    rows = [("RandomForest", "CO(GT)", 1, 0.8, 1.0, 1.0, 1.0, 1), ("GBDT", "CO(GT)", 1, 0.85, 1.0, 1.0, 1.0, 2),
            ("Ridge", "CO(GT)", 1, 0.7, 1.0, 1.0, 1.0, 3), ("Naive", "CO(GT)", 1, 0.95, 1.0, 1.0, 1.0, 4)]
    r = lb.family_r2_pivot(_scores(spark, rows)).first()
    assert (r.r2_tree, r.r2_linear_kernel, r.r2_rnn) == (0.85, 0.7, None)


def test_value_spans_skip_pairs_with_a_missing_value(mkdf):
    from sensorgrid.operators.metrics import value_spans
    nan = float("nan")
    df = mkdf([(1, 2.0, 5.0), (1, 3.0, -1.0), (1, 99.0, None), (1, nan, 99.0), (2, 4.0, 4.0), (3, None, 1.0)], "h int, y_true double, y_pred double")
    got = {r.h: (r.y_true_min, r.y_true_max, r.y_pred_min, r.y_pred_max, r.n, r.lo, r.hi) for r in value_spans(df, by="h").collect()}
    assert got == {1: (2.0, 3.0, -1.0, 5.0, 2, -1.0, 5.0), 2: (4.0, 4.0, 4.0, 4.0, 1, 4.0, 4.0)}
