"""Every registered query runs on sf0.001; the oracle ones agree with DuckDB."""

import os
import sys

import duckdb
import pytest

from sensorgrid.operators import metrics

SF = "/root/testdata/sf0.001"
SLOW = {"fit_forest", "fit_gbt", "grid_search_trees"}

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in ("events", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def _names():
    from sensorgrid.plans.registry import ORACLE
    return sorted(ORACLE)


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
@pytest.mark.parametrize("name", _names())
def test_query_matches_oracle(spark, duck, name):
    import __spark_entry__ as E
    from check_oracle import rows_of
    df = E.queries()[name](spark, SF)
    a, ac = rows_of(df.columns, [tuple(r) for r in df.collect()])
    res = duck.execute(E.oracle_sql()[name])
    b, bc = rows_of([d[0] for d in res.description], res.fetchall())
    assert ac == bc
    assert a == b


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_entry_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0 and "R2" in df.columns


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_model_queries_score_every_task(spark, monkeypatch):
    """Fitted models have no SQL: every (target, horizon) task has its score, and what is
    computed twice in different ways agrees."""
    from sensorgrid.plans import registry
    assert len(registry.ML_TASKS) == 16
    monkeypatch.setattr(registry, "ML_TASKS", [("v_mean", 1), ("n_events", 24)])  # the same code on two tasks
    tasks = set(registry.ML_TASKS)
    for name in ("fit_linear", "fit_ridge", "fit_lasso", "fit_elasticnet", "fit_linear_svr_equiv", "fit_tree", "model_save_load"):
        rows = registry.QUERIES[name](spark, SF).collect()
        assert {(r.pollutant, r.horizon_h) for r in rows} == tasks and len(rows) == len(tasks), name
        assert all(r.RMSE is not None and r.RMSE >= 0 and r.n_test > 0 and r.n_train > 0 for r in rows), name
    linear = {(r.pollutant, r.horizon_h): r.RMSE for r in registry.QUERIES["fit_linear"](spark, SF).collect()}
    loaded = {(r.pollutant, r.horizon_h): r.RMSE for r in registry.QUERIES["model_save_load"](spark, SF).collect()}
    assert all(abs(linear[t] - loaded[t]) < 1e-9 for t in tasks)
    predicted = registry.QUERIES["score_models"](spark, SF)
    by = {(r.pollutant, r.horizon_h): r.RMSE for r in metrics.regression_metrics(predicted, by=["pollutant", "horizon_h"]).collect()}
    assert all(abs(linear[t] - by[t]) < 1e-9 for t in tasks)
    importance = registry.QUERIES["feature_importance"](spark, SF).groupBy("pollutant", "horizon_h").sum("importance").collect()
    assert len(importance) == len(tasks) and all(abs(r[2] - 1) < 1e-6 or r[2] == 0 for r in importance)
    best = registry.QUERIES["grid_search_linear"](spark, SF)
    assert best.groupBy("model").count().count() == 4 and best.count() == 4 * len(tasks)
    scores = registry.QUERIES["fit_status_classifier"](spark, SF).collect()
    assert [r.horizon_h for r in scores] == [1, 6, 12, 24] and all(0 <= r.accuracy <= 1 and r.n > 0 for r in scores)


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_residual_histogram_has_every_horizon(spark):
    from sensorgrid.plans import registry
    got = registry.QUERIES["residual_histogram_by_horizon"](spark, SF).groupBy("horizon_h").sum("n").collect()
    want = registry.QUERIES["persistence_forecast"](spark, SF).groupBy("horizon_h").count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) == 4


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_status_classifier_scores_all_classes_of_the_supplier_series(spark):
    from sensorgrid.plans import registry
    dist = {(r.split, r.cls): r.n for r in registry.QUERIES["class_distribution_supplier"](spark, SF).collect()}
    assert len(dist) == 9 and all(dist.values())
    scores = registry.QUERIES["fit_status_classifier"](spark, SF).collect()
    # a window of 24 days inside the test split, and a label h days after it, lead null at the end of a series
    rows = registry.supplier_pack(spark, SF).where("split = 'test'").groupBy("entity_id").agg({"*": "count"}).collect()
    assert {r.horizon_h: r.n for r in scores} == {h: sum(r[1] - 23 - h - 1 for r in rows) for h in (1, 6, 12, 24)}


@pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")
def test_tuned_trees_search_the_whole_grids_on_every_task(spark, monkeypatch):
    from sensorgrid.operators import models as M
    from sensorgrid.plans import registry, regression
    seen = []
    monkeypatch.setattr(regression, "tuned_tree_suite", lambda spark, tf, grids, **_: seen.append((tf, grids)))
    registry.QUERIES["grid_search_trees"](spark, SF)
    (tf, grids), = seen
    assert sorted(tf.tasks) == sorted(registry.ML_TASKS) and len(tf.tasks) == 16
    assert {n: len(M._grid(g)) for n, g in grids.items()} == {"RandomForest": 36, "GBDT": 72}
    assert all(set(g["n_estimators"]) == {300, 600} for g in grids.values())
    assert set(grids["RandomForest"]["max_depth"]) == {None, 12, 20} and set(grids["GBDT"]["max_depth"]) == {2, 3, 4}


def test_the_hours_long_search_holds_up_no_other_query():
    import __spark_entry__ as E
    names = list(E.queries())
    assert names[-1] == "grid_search_trees" and set(names[-3:]) == SLOW
    assert set(names) >= set(E.registry.QUERIES) and len(names) == len(set(names))
