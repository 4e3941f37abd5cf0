"""Multi-horizon regression suite: task frame -> per-task MLlib fits -> score table.

One task = one (target, horizon). All tasks share one checkpointed task
frame; fits run as independent Spark jobs from a small driver thread pool.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgrid.operators import clean, metrics
from sensorgrid.operators import models as M
from sensorgrid.operators.common import q, series_window
from sensorgrid.plans.prepare import PrepareConfig, feature_pack, pack_columns

HORIZONS = (1, 6, 12, 24)


def task_frame(cleaned: DataFrame, cfg: PrepareConfig, tasks, scaled: bool = False,
               scale_scope: str = "train") -> M.TaskFrame:
    """Feature pack with one label column per task, assembled and checkpointed once.

    ``scaled=True`` gives the 'nn' pack: the pack is checkpointed first, then its feature
    columns (not the labels) are standardised on ``scale_scope`` rows in place, so the
    window plan runs once and no join is needed."""
    pk = feature_pack(cleaned, cfg, label_tasks=tasks)
    labels = {M.label_col(t, h) for t, h in tasks}
    feats = [c for c in pack_columns(pk, cfg.key, cfg.ts) if c not in labels]
    if scaled:
        pk = pk.checkpoint(eager=True)
        scope = (F.col("split") == "train") if scale_scope == "train" else None
        pk = clean.standardize(pk, feats, by=None, scope=scope)
    return M.build_task_frame(pk, feats, tasks, key=cfg.key, ts=cfg.ts)


def _once(what: dict, fit, save_to: str | None = None, ledger=None) -> tuple:
    """The score row of ``fit()`` (row, model), its model saved under ``save_to`` if given. With a
    ``ledger`` (:class:`sensorgrid.plans.ledger.TaskLedger`) a task entered there isn't fitted again."""
    def work():
        row, model = fit()
        path = M.save_model(model, f"{save_to}/{row[1]}/h{row[2]}/{row[0]}") if save_to else None
        return row, path
    return ledger.once(what, work) if ledger else work()[0]


def linear_suite(spark: SparkSession, tf: M.TaskFrame, names=tuple(M.LINEAR_GRIDS), grids: dict | None = None,
                 workers: int = 4, save_to: str | None = None, ledger=None) -> DataFrame:
    """Every linear model on every task. One pass over the fit rows serves all grids: its time is
    shared out evenly over the fits' ``fit_time_s``."""
    grid_of = lambda n: M.LINEAR_GRIDS.get(n, {}) if grids is None else grids.get(n, {})
    what = lambda t, h, n: {"model": n, "target": t, "horizon": h, "grid": grid_of(n)}
    jobs = [(t, h, n) for (t, h) in tf.tasks for n in names]
    left = [j for j in jobs if not (ledger and ledger.has(what(*j)))]
    t0 = time.time()
    moments = M.second_moments(tf) if any(grid_of(n) for _, _, n in left) else None
    share = (time.time() - t0) / max(1, len(left))

    def one(job):
        t, h, n = job

        def fit():
            row, model = M.fit_linear_task(tf, t, h, n, grid_of(n), moments)
            at = M.SCORE_SCHEMA.names.index("fit_time_s")
            return (*row[:at], row[at] + share, *row[at + 1:]), model
        return _once(what(*job), fit, save_to, ledger)
    return M.run_tasks(spark, one, jobs, workers)


def tree_suite(spark: SparkSession, tf: M.TaskFrame, names=tuple(M.TREE_SPECS), params: dict | None = None,
               workers: int = 4, save_to: str | None = None, ledger=None) -> DataFrame:
    jobs = [(t, h, n) for (t, h) in tf.tasks for n in names]

    def one(job):
        t, h, n = job
        p = dict(M.TREE_SPECS.get(n, {}) if params is None or params.get(n) is None else params[n])
        return _once({"model": n, "target": t, "horizon": h, "params": p}, lambda: M.fit_tree_task(tf, t, h, n, p), save_to, ledger)
    return M.run_tasks(spark, one, jobs, workers)


def linear_svr_equiv(spark: SparkSession, tf_scaled: M.TaskFrame, C: float = M.LINEAR_SVR["C"],
                     workers: int = 4, save_to: str | None = None, ledger=None) -> DataFrame:
    """LinearSVR(eps=0, squared loss, C) = ridge with alpha = 1 / (2C) on standardised features."""
    alpha = 1.0 / (2.0 * C)

    def one(job):
        t, h = job

        def fit():
            lab = M.label_col(t, h)
            train = M._fit_rows(tf_scaled, lab, ("train",))
            test = M._fit_rows(tf_scaled, lab, ("test",))
            n, s = M._label_stats(train)
            t0 = time.time()
            model = M.linear_estimator("LinearSVR", n, s, alpha=alpha).fit(train)
            return M._row("LinearSVR", t, h, M.score(model, test), time.time() - t0, n, {"C": C, "epsilon": 0.0}), model
        return _once({"model": "LinearSVR", "target": t, "horizon": h, "C": C}, fit, save_to, ledger)
    return M.run_tasks(spark, one, list(tf_scaled.tasks), workers)


def tuned_tree_suite(spark: SparkSession, tf: M.TaskFrame, grids: dict, n_splits: int = 3,
                     workers: int = 2, save_to: str | None = None, ledger=None) -> DataFrame:
    jobs = [(t, h, n) for (t, h) in tf.tasks for n in grids]

    def one(job):
        t, h, n = job
        return _once({"model": n, "target": t, "horizon": h, "grid": grids[n], "folds": n_splits},
                     lambda: M.fit_tuned_tree_task(tf, t, h, n, grids[n], n_splits), save_to, ledger)
    return M.run_tasks(spark, one, jobs, workers)


def persistence_suite(cleaned: DataFrame, pack: DataFrame, tasks, key="entity_id", ts="ts") -> DataFrame:
    """Score rows of the forecast y(t + h) = y(t) on the test rows of ``pack``, one per task;
    one pass over the cleaned series for all targets and horizons."""
    names = sorted({t for t, _ in tasks})
    w = series_window(key, ts)
    cells = [F.struct(F.lit(t).alias("pollutant"), F.lit(int(h)).alias("horizon_h"), q(t).cast("double").alias("y_pred"),
                      F.col(f"__y{i}").alias("y_true")) for i, (t, h) in enumerate(tasks)]
    wide = cleaned.select(q(key), q(ts), *[q(t) for t in names], *[F.lead(q(t), int(h)).over(w).cast("double").alias(f"__y{i}") for i, (t, h) in enumerate(tasks)])
    test = pack.where(F.col("split") == "test").select(q(key), q(ts))
    long = wide.join(test, [key, ts], "left_semi").select(F.explode(F.array(*cells)).alias("c")).select("c.*")
    got = metrics.regression_metrics(long, by=["pollutant", "horizon_h"])
    return got.select(F.lit("Naive_persistence").alias("model"), "pollutant", "horizon_h", "RMSE", "MAE", q("MAPE(%)"), "R2",
                      F.lit(0.0).alias("fit_time_s"), F.lit(0).cast("bigint").alias("n_train"), F.col("n").alias("n_test"))


def importance_table(spark: SparkSession, tf: M.TaskFrame, name: str = "RandomForest", params: dict | None = None,
                     workers: int = 4) -> DataFrame:
    def one(job):
        t, h = job
        _, model = M.fit_tree_task(tf, t, h, name, params)
        return M.feature_importance(model, tf.feature_names, name, t, h)
    with ThreadPoolExecutor(max_workers=workers) as ex:
        parts = list(ex.map(one, tf.tasks))
    return spark.createDataFrame([r for p in parts for r in p], M.IMPORTANCE_SCHEMA)
