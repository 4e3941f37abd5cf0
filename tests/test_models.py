"""MLlib estimators reproduce the scikit-learn objectives (closed form / coordinate descent)."""

import threading

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from sensorgrid.operators import models as M


def enet_cd(X, y, alpha, r, iters=20000):
    n, d = X.shape
    Xc, yc = X - X.mean(0), y - y.mean()
    w = np.zeros(d)
    col = (Xc ** 2).sum(0) / n
    for _ in range(iters):
        old = w.copy()
        for j in range(d):
            rj = yc - Xc @ w + Xc[:, j] * w[j]
            z = Xc[:, j] @ rj / n
            w[j] = np.sign(z) * max(abs(z) - alpha * r, 0) / (col[j] + alpha * (1 - r))
        if np.max(np.abs(w - old)) < 1e-13:
            break
    return w


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    n, d = 300, 5
    X = rng.normal(size=(n, d)) * np.array([1, 10, 0.1, 5, 2])
    y = X @ np.array([1.0, -2, 3, 0.5, 0]) + 7 + rng.normal(size=n) * 3
    df = spark.createDataFrame([(Vectors.dense(X[i].tolist()), float(y[i])) for i in range(n)], ["features", "label"])
    return X, y, df.cache(), float(np.std(y, ddof=1))


def test_ols_and_ridge_closed_form(data):
    X, y, df, s = data
    n, d = X.shape
    m = M.linear_estimator("LinearRegression", n, s).fit(df)
    w = np.linalg.lstsq(np.c_[X, np.ones(n)], y, rcond=None)[0]
    assert np.max(np.abs(np.array(m.coefficients) - w[:d])) < 1e-9
    Xc, yc = X - X.mean(0), y - y.mean()
    for alpha in (0.1, 10.0, 100.0):
        w = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(d), Xc.T @ yc)
        m = M.linear_estimator("Ridge", n, s, alpha=alpha).fit(df)
        assert np.max(np.abs(np.array(m.coefficients) - w)) < 1e-9


@pytest.mark.parametrize("alpha,r", [(0.1, 1.0), (1.0, 1.0), (0.1, 0.5), (1.0, 0.3)])
def test_lasso_elasticnet_match_coordinate_descent(data, alpha, r):
    X, y, df, s = data
    n = X.shape[0]
    w = enet_cd(X, y, alpha, r)
    name = "Lasso" if r == 1.0 else "ElasticNet"
    m = M.linear_estimator(name, n, s, alpha=alpha, l1_ratio=r, max_iter=2000).fit(df)
    assert np.max(np.abs(np.array(m.coefficients) - w)) < 1e-5


def test_save_load_and_importance(spark, data):
    from sensorgrid.session import scratch_path
    X, y, df, s = data
    m = M.tree_estimator("DecisionTree", max_depth=3).fit(df)
    p = M.save_model(m, scratch_path(spark, "model-test"))
    back = M.load_model("DecisionTree", p)
    assert back.depth == m.depth
    imp = M.feature_importance(back, list("abcde"), "DecisionTree", "y", 1)
    assert len(imp) == 5 and abs(sum(r[4] for r in imp) - 1.0) < 1e-9


def test_second_moments_solve_the_same_models(spark):
    """Labels missing in several ways, unlike scales, a constant feature: one pass gives every label's
    rows, the closed form, coordinate descent and the validation error."""
    rng = np.random.default_rng(5)
    n, d = 500, 4
    X = np.c_[rng.normal(size=(n, d)) * np.array([1, 10, 0.1, 5]) + np.array([0, 1000, 0, -3]), np.full(n, 2.5)]
    Y = np.c_[X[:, :d] @ rng.normal(size=(d, 2)) + rng.normal(size=(n, 2)) * 3 + 50]
    split = np.where(np.arange(n) < 300, "train", np.where(np.arange(n) < 420, "val", "test"))
    miss = rng.random((n, 2)) < [0.1, 0.3]
    rows = [("a", str(split[i]), Vectors.dense(X[i].tolist()), *(None if miss[i, j] else float(Y[i, j]) for j in range(2))) for i in range(n)]
    df = spark.createDataFrame(rows, ["entity_id", "split", "features", M.label_col("u", 1), M.label_col("v", 6)])
    tf = M.TaskFrame(df.withColumn("__pos", M.F.lit(0)).cache(), list("abcde"), [("u", 1), ("v", 6)])
    moments = M.second_moments(tf)
    for j, (t, h) in enumerate(tf.tasks):
        lab = M.label_col(t, h)
        tr, va = ((split == s) & ~miss[:, j] for s in ("train", "val"))
        assert moments.label_stats(lab, ("train", "val")) == (int((tr | va).sum()), pytest.approx(np.std(Y[tr | va, j], ddof=1)))
        Xc, yc = X[tr] - X[tr].mean(0), Y[tr, j] - Y[tr, j].mean()
        for name, alpha, r in (("Ridge", 10.0, None), ("Lasso", 0.1, None), ("ElasticNet", 0.5, 0.3)):
            w, b = M.solve_linear(moments.of(lab, ("train",)), name, alpha, r)
            want = np.linalg.solve(Xc.T @ Xc + alpha * np.eye(d + 1), Xc.T @ yc) if r is None and name == "Ridge" else np.append(enet_cd(X[tr][:, :d], Y[tr, j], alpha, r or 1.0), 0)
            assert np.max(np.abs(w - want)) < 1e-6
            shift = X[split != "test"].mean(0)  # features were centred
            error = np.mean((Y[va, j] - (X[va] - shift) @ w - b) ** 2)
            assert moments.squared_error(lab, ("val",), w, b) == pytest.approx(error)
        for name in ("Ridge", "Lasso", "ElasticNet"):
            (row, model), (old, before) = M.fit_linear_task(tf, t, h, name, moments=moments), M.fit_linear_task(tf, t, h, name)
            assert row[-1] == old[-1] and row[8] == old[8] and row[3] == pytest.approx(old[3], abs=1e-6)
            assert np.max(np.abs(np.array(model.coefficients) - np.array(before.coefficients))) < 1e-6
    M_most, M.MOST_PATTERNS = M.MOST_PATTERNS, 1
    assert M.second_moments(tf) is None  # too many patterns: the tasks fit their grids themselves
    M.MOST_PATTERNS = M_most


def test_frame_partitions_follow_the_rows():
    assert [M.frame_partitions(n) for n in (0, 1, 1024, 1025, 2085, 10 ** 5, 6_400_000, 10 ** 8)] == [1, 1, 1, 2, 3, 64, 64, 1000]


def small_frame(spark, n=240, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = np.sin(x[:, 0]) * 3 + x[:, 1] ** 2 + rng.normal(size=n) * 0.3
    rows = [("s", i, "train" if i < 140 else "val" if i < 180 else "test", i, Vectors.dense(x[i].tolist()), float(y[i]), float(-y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, ["entity_id", "ts", "split", "__pos", "features", "y__a__h1", "y__b__h1"])
    return M.TaskFrame(df.coalesce(2).cache(), ["f0", "f1", "f2"], [("a", 1), ("b", 1)])


def test_prefixes_of_a_boosting_are_the_smaller_models(spark):
    tf = small_frame(spark)
    fit, test = M._fit_rows(tf, "y__a__h1", ("train",)), M._fit_rows(tf, "y__a__h1", ("val",))
    points = [{"n_estimators": n, "learning_rate": 0.3, "max_depth": 2, "subsample": 0.8} for n in (2, 5, 9)]
    each = [M.score(M.tree_estimator("GBDT", **p).fit(fit), test)["R2"] for p in points]
    assert np.allclose(M.fold_scores("GBDT", points, fit, test), each, rtol=0, atol=1e-6)
    assert len(set(np.round(each, 6))) == 3
    nothing = test.where("label is null")
    assert M.fold_scores("GBDT", points, fit, nothing) == [None] * 3
    flat = test.selectExpr("entity_id", "__pos", "features", "1.0 label")
    assert M.fold_scores("GBDT", points, fit, flat) == [0.0] * 3


def test_prefixes_of_a_forest_are_the_smaller_models(spark, monkeypatch):
    tf, fits, real = small_frame(spark), [], M.tree_estimator

    def counting(name, **p):
        fits.append(p["n_estimators"])
        return real(name, **p)
    monkeypatch.setattr(M, "tree_estimator", counting)
    fit, test = M._fit_rows(tf, "y__a__h1", ("train",)), M._fit_rows(tf, "y__a__h1", ("val",))
    points = [{"n_estimators": n, "max_depth": None, "min_samples_leaf": 2, "max_features": 0.6} for n in (2, 9, 5)]
    got = M.fold_scores("RandomForest", points, fit, test)
    assert fits == [9]
    model = real("RandomForest", **points[1]).fit(fit)
    rows = test.collect()
    y = np.array([r.label for r in rows])
    each = np.array([[t.predict(r.features) for t in model.trees] for r in rows])
    want = [1 - ((y - each[:, :n].mean(axis=1)) ** 2).mean() / y.var() for n in (2, 9, 5)]
    assert np.allclose(got, want, rtol=0, atol=1e-9) and len(set(np.round(want, 6))) == 3
    assert M.forest_prefix(model, 5).getNumTrees == 5 == len(M.forest_prefix(model, 5).trees) and M.forest_prefix(model, 9) is model
    assert got[1] == pytest.approx(M.fold_scores("RandomForest", points[1:2], fit, test)[0], abs=1e-9)
    assert M.fold_scores("RandomForest", points, fit, test.where("label is null")) == [None] * 3


def test_fits_of_a_grid_run_at_once_and_are_all_scored(spark, monkeypatch):
    """No fit waits for the other folds of its point; each point keeps its own mean."""
    tf, seen = small_frame(spark), []
    together = threading.Barrier(4, timeout=60)
    worth = {(d, leaf, n): d + leaf / 10 + n / 1000 for d in (1, 2) for leaf in (1, 5) for n in (3, 6)}

    def scores(name, points, train, test):
        at = [(p["max_depth"], p["min_samples_leaf"], p["n_estimators"]) for p in points]
        seen.extend((train.count(), a) for a in at)
        together.wait()
        return [-worth[a] for a in at]
    monkeypatch.setattr(M, "fold_scores", scores)
    grid = {"n_estimators": [6, 3], "max_depth": [2, 1], "min_samples_leaf": [5, 1]}
    row, model = M.fit_tuned_tree_task(tf, "a", 1, "GBDT", grid, n_splits=3)
    assert sorted(seen) == sorted((n, a) for n in (45, 90, 135) for a in worth)
    assert row[-1] == {"n_estimators": "3", "max_depth": "1", "min_samples_leaf": "1"} and model.getNumTrees == 3
    assert [M.fits_at_once("GBDT", p, 8, 3) for p in (1, 2, 64)] == [8, 4, 3] and M.fits_at_once("GBDT", 1, 1000, 3) == M.FITS_AT_ONCE


def test_tuning_groups_points_by_their_trees(spark, monkeypatch):
    grid = {"n_estimators": [6, 2], "max_depth": [1, 2], "learning_rate": [0.3]}
    assert [[p["n_estimators"] for p in g] for g in M._nested(M._grid(grid))] == [[2, 6], [2, 6]]
    assert M._nested([{}]) == [[{}]]
    tf, fits = small_frame(spark), []
    real = M.tree_estimator

    def counting(name, **p):
        fits.append(p)
        return real(name, **p)
    monkeypatch.setattr(M, "tree_estimator", counting)
    row, model = M.fit_tuned_tree_task(tf, "a", 1, "GBDT", grid, n_splits=2)
    assert len(fits) == 2 * 2 + 1 and row[0] == "GBDT_TUNED" and model.getNumTrees == int(row[-1]["n_estimators"])
    monkeypatch.setattr(M, "_nested", lambda points: [[p] for p in points])
    again, _ = M.fit_tuned_tree_task(tf, "a", 1, "GBDT", grid, n_splits=2)
    assert again[-1] == row[-1] and len(fits) == 5 + 4 * 2 + 1


def test_a_stopped_suite_goes_on_where_it_was(spark, monkeypatch):
    from sensorgrid.plans.ledger import Ledger
    from sensorgrid.plans.regression import linear_suite, tree_suite
    from sensorgrid.session import scratch_path
    tf, base = small_frame(spark), scratch_path(spark, "ledger")
    table = lambda df: sorted((tuple(r)[:7], tuple(r)[8:10], tuple(r.params.items())) for r in df.collect())
    names, specs = ("LinearRegression", "Ridge"), {"DecisionTree": {"max_depth": 3}}
    suites = lambda book=None, frame=tf: (
        table(linear_suite(spark, frame, names, workers=1, save_to=f"{base}/models", ledger=book)),
        table(tree_suite(spark, frame, ("DecisionTree",), specs, workers=1, save_to=f"{base}/models", ledger=book)))
    want = suites()
    saved, real = [], M.save_model

    def stops(model, path):
        if len(saved) == 3:
            raise RuntimeError("stopped")
        saved.append(path)
        return real(model, path)
    monkeypatch.setattr(M, "save_model", stops)
    with pytest.raises(RuntimeError, match="stopped"):
        suites(Ledger(spark, f"{base}/ledger").of(tf))
    assert len(Ledger(spark, f"{base}/ledger").done) == 3

    def goes_on(model, path):
        saved.append(path)
        return real(model, path)
    monkeypatch.setattr(M, "save_model", goes_on)
    assert suites(Ledger(spark, f"{base}/ledger").of(tf)) == want
    assert len(saved) == 6 and len(set(saved)) == 6  # nothing was fitted twice
    book = Ledger(spark, f"{base}/ledger")
    monkeypatch.setattr(M, "second_moments", lambda _: pytest.fail("nothing is left to fit"))
    assert suites(book.of(tf)) == want and len(saved) == 6
    monkeypatch.undo()
    paths = {r.model_path for r in book.entries().collect()}
    assert paths == set(saved) and M.load_model("Ridge", f"{base}/models/a/h1/Ridge").numFeatures == 3
    # other rows or settings are other tasks
    other = small_frame(spark, seed=3)
    assert book.of(other).data != book.of(tf).data and book.of(small_frame(spark)).data == book.of(tf).data
    assert not book.of(tf).has({"model": "Ridge", "target": "a", "horizon": 1, "grid": {"alpha": [5.0]}})


def test_tuned_rows_are_dealt_by_their_number(spark, monkeypatch):
    """Not by the session's shuffle partitions: each partition sends statistics of every tree node."""
    tf, seen = small_frame(spark), []

    def scores(name, points, train, test):
        seen.append((train.rdd.getNumPartitions(), train.count(), test.count()))
        return [0.5] * len(points)
    monkeypatch.setattr(M, "fold_scores", scores)
    row, _ = M.fit_tuned_tree_task(tf, "a", 1, "RandomForest", {"n_estimators": [2], "max_depth": [2]}, n_splits=3)
    assert sorted(seen) == [(1, 45, 45), (1, 90, 45), (1, 135, 45)] and row[8] == 180


def test_forests_have_few_partitions(spark, monkeypatch):
    """Every partition sends statistics of every node."""
    assert [M.forest_partitions(n) for n in (0, 2085, 16_384, 16_385, 10 ** 6, 10 ** 8)] == [1, 1, 1, 2, 62, 1000]
    tf, seen, real = small_frame(spark), [], M.tree_estimator

    class Seen:
        def __init__(self, est):
            self.est = est

        def fit(self, df):
            seen.append(df.rdd.getNumPartitions())
            return self.est.fit(df)
    monkeypatch.setattr(M, "tree_estimator", lambda name, **p: Seen(real(name, **p)))
    row, model = M.fit_tree_task(tf, "a", 1, "RandomForest", {"n_estimators": 3, "max_depth": 3})
    assert seen == [1] and row[8] == 140 and model.getNumTrees == 3
    again, _ = M.fit_tree_task(M.TaskFrame(tf.df.repartition(5), tf.feature_names, tf.tasks), "a", 1, "RandomForest", {"n_estimators": 3, "max_depth": 3})
    assert again[3] == pytest.approx(row[3], rel=1e-12)  # the same forest however the frame lies
