"""Spark ML forecasters fitted per (target, horizon) task, scored with the null-safe metrics.

Data flow: one *task frame* holds the assembled feature vector, the split,
the per-series position (for time folds) and one label column per
(target, horizon). It is built in a single windowed pass and checkpointed to
the shared checkpoint folder, so every iteration of every fit reads
materialised vectors instead of recomputing the window plan, and a lost
executor re-reads the checkpoint instead of the raw tables.

Hyper-parameter mapping to the reference's scikit-learn estimators
(n = fit rows, s = sample std of the label on the fit rows):

* OLS                     -> LinearRegression(regParam = 0)
* Ridge(alpha)            -> LinearRegression(regParam = alpha / n * s, elasticNetParam = 0)
* Lasso(alpha)            -> LinearRegression(regParam = alpha, elasticNetParam = 1)
* ElasticNet(alpha, r)    -> regParam = alpha * (r + s * (1 - r)), elasticNetParam = r / (r + s * (1 - r))
* LinearSVR(C, eps = 0, squared loss) is ridge with alpha = 1 / (2 C) on standardised features

all with ``standardization=False`` (scikit-learn does not scale X) and
``solver="normal"``, which scales the label by its *population* std, so s
here is the population std (the L-BFGS path would use the sample std).
"""

from __future__ import annotations

import itertools
import time
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import SparkContext
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseMatrix, DenseVector
from pyspark.ml.regression import (DecisionTreeRegressor, GBTRegressor, LinearRegression,
                                   RandomForestRegressor)
from pyspark.ml.wrapper import JavaWrapper
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, MapType, StringType, StructField,
                               StructType)

from sensorgrid.operators import metrics, softmax, windows
from sensorgrid.operators.blocked import blockwise
from sensorgrid.operators.common import as_list, group_window, q, series_window
from sensorgrid.session import scratch_path

SEED = 42  # fixed value: the reference's random seed

# The reference's model settings and grids.
LINEAR_GRIDS = {
    "LinearRegression": {},
    "Ridge": {"alpha": [0.1, 1.0, 10.0, 100.0]},
    "Lasso": {"alpha": [0.001, 0.01, 0.1, 1.0], "max_iter": [2000]},
    "ElasticNet": {"alpha": [0.01, 0.1, 1.0], "l1_ratio": [0.3, 0.5, 0.7], "max_iter": [2000]},
}
TREE_SPECS = {
    "DecisionTree": {"max_depth": 12},
    "RandomForest": {"n_estimators": 300, "max_depth": None},
    "GBDT": {"n_estimators": 400, "learning_rate": 0.05, "max_depth": 3},
}
RF_GRID = {"n_estimators": [300, 600], "max_depth": [None, 12, 20], "min_samples_leaf": [1, 2, 5],
           "max_features": ["sqrt", 0.6]}
GBDT_GRID = {"n_estimators": [300, 600], "learning_rate": [0.05, 0.1], "max_depth": [2, 3, 4],
             "subsample": [1.0, 0.8], "min_samples_leaf": [1, 2, 5]}
LINEAR_SVR = {"C": 1.0, "epsilon": 0.0}
MAX_TREE_DEPTH = 30  # MLlib's depth limit stands in for "unlimited"

SCORE_SCHEMA = StructType([
    StructField("model", StringType()), StructField("pollutant", StringType()),
    StructField("horizon_h", IntegerType()), StructField("RMSE", DoubleType()),
    StructField("MAE", DoubleType()), StructField("MAPE(%)", DoubleType()), StructField("R2", DoubleType()),
    StructField("fit_time_s", DoubleType()), StructField("n_train", LongType()), StructField("n_test", LongType()),
    StructField("params", MapType(StringType(), StringType())),
])


def label_col(target: str, horizon: int) -> str:
    return f"y__{target}__h{horizon}"


@dataclass
class TaskFrame:
    """Checkpointed frame with ``features`` vector, split, position columns and label columns."""
    df: DataFrame
    feature_names: list
    tasks: list  # [(target, horizon)]
    key: str = "entity_id"
    extra: dict = field(default_factory=dict)


def build_task_frame(pack: DataFrame, feature_names, tasks, labels: DataFrame | None = None,
                     key="entity_id", ts="ts", partitions: int | None = None) -> TaskFrame:
    """Assemble features once; attach per-series position / count (for folds) and labels.

    ``pack`` must already carry the label columns (``label_col(t, h)``) unless
    ``labels`` (key, ts, label columns) is given, which is then joined on
    (key, ts) — both sides come hash partitioned by key from their windows.

    A row with a missing feature raises (:func:`require_complete`). Rows are dealt by (key, ts)
    to ``partitions`` (default: :func:`frame_partitions` of their number) and sorted, so bootstraps
    and with them fitted forests depend on the rows alone, not on cores or settings.
    """
    df = pack if labels is None else pack.join(labels, on=[key, ts], how="inner")
    df = df.select("*", (F.row_number().over(series_window(key, ts)) - 1).alias("__pos"))
    asm = VectorAssembler(inputCols=list(feature_names), outputCol="features", handleInvalid="keep")
    ycols = [label_col(t, h) for t, h in tasks]
    out = asm.transform(df).select(q(key), q(ts), "split", "__pos", "features", *[q(c) for c in ycols])
    # MLlib parallelises every pass (gradient, X'X, tree histograms) over input partitions: spread the
    # frame instead of leaving the few partitions AQE coalesced the windows into.
    n_part = partitions or frame_partitions(df.select(q(key)).count())
    out = out.repartition(max(1, int(n_part)), q(key), q(ts)).sortWithinPartitions(q(key), q(ts)).checkpoint(eager=True)
    require_complete(out, feature_names, key)
    return TaskFrame(out, list(feature_names), list(tasks), key)


def frame_partitions(rows: int) -> int:
    """Partitions of a task frame: 1,024 rows each while there are few, since every tree level sends one
    set of node statistics a partition (30 trees on 2,085 rows here: 15.8 s on 14 partitions, 9.1 s
    on 4; 60 boosting rounds 11.2 s and 9.4 s); from 6.4 million rows on 100,000 rows each."""
    return max(1, min(64, -(-rows // 1024)), -(-rows // 100_000))


def forest_partitions(rows: int) -> int:
    """Partitions of a forest's rows: deep trees have almost as many nodes as rows, and every partition sends
    its statistics of every node, so partitions that grow with the rows make the shuffle grow with their
    square. 30 trees on 2,085 rows here: 265 MB on 4 partitions, 151 MB on one, in the same time."""
    return min(frame_partitions(rows), max(1, -(-rows // 16_384)))


def require_complete(df: DataFrame, feature_names, key="entity_id", show: int = 5) -> None:
    """Raise if a ``features`` vector holds a missing value, naming series, column and count."""
    x = vector_to_array(F.col("features"))
    bad = df.where(F.exists(x, lambda v: v.isNull() | F.isnan(v)))
    cells = F.filter(F.transform(x, lambda v, i: F.when(v.isNull() | F.isnan(v), i)), lambda i: i.isNotNull())
    found = (bad.select(*[q(k) for k in as_list(key)], F.explode(cells).alias("i")).groupBy(*[q(k) for k in as_list(key)], "i")
             .count().orderBy(*[q(k) for k in as_list(key)], "i").limit(show).collect())
    if found:
        names = list(feature_names)
        raise ValueError("missing features: " + "; ".join(
            f"{', '.join(str(r[k]) for k in as_list(key))}: {names[r['i']]} in {r['count']} rows" for r in found))


def _fit_rows(tf: TaskFrame, label: str, splits_: tuple) -> DataFrame:
    return (tf.df.where(F.col("split").isin(list(splits_)) & F.col(label).isNotNull())
                 .select(q(tf.key), "__pos", "features", F.col(label).alias("label")))


def _label_stats(df: DataFrame) -> tuple[int, float]:
    r = df.agg(F.count("label").alias("n"), F.stddev_samp("label").alias("s")).first()
    return int(r["n"] or 0), float(r["s"] or 0.0)


def linear_estimator(name: str, n: int, s: float, alpha: float | None = None, l1_ratio: float | None = None,
                     max_iter: int = 100) -> LinearRegression:
    """MLlib LinearRegression equivalent to a scikit-learn linear model (see module doc)."""
    base = dict(featuresCol="features", labelCol="label", predictionCol="prediction", standardization=False,
                fitIntercept=True, solver="normal")
    # Every linear model uses the normal-equation solver: one distributed pass aggregates
    # X'X (d x d, d <= 4096), then the (elastic-net) problem is solved on that small matrix.
    # That solver scales the label by its population std, hence s_pop in the mapping.
    s_pop = s * ((n - 1) / n) ** 0.5 if n > 1 else s
    if name == "LinearRegression":
        return LinearRegression(regParam=0.0, elasticNetParam=0.0, **base)
    if name in ("Ridge", "LinearSVR"):
        return LinearRegression(regParam=alpha / max(n, 1) * s_pop, elasticNetParam=0.0, **base)
    if name == "Lasso":
        return LinearRegression(regParam=alpha, elasticNetParam=1.0, maxIter=max_iter, tol=1e-10, **base)
    if name == "ElasticNet":
        d = l1_ratio + s_pop * (1 - l1_ratio)
        return LinearRegression(regParam=alpha * d, elasticNetParam=(l1_ratio / d) if d else 0.0,
                                maxIter=max_iter, tol=1e-10, **base)
    raise ValueError(name)


def tree_memory_mb() -> int:
    """Node-statistics buffer per tree-training task, sized per task slot: half of one
    slot's share of the executor heap (local mode: JVM heap / cores; cluster:
    spark.executor.memory / spark.executor.cores), clamped to 16..1024 MB. Every running
    task holds one such buffer, so the sum stays under the heap."""
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    if sc is None:
        return 128
    try:
        if sc.master.startswith("local"):
            heap = sc._jvm.java.lang.Runtime.getRuntime().maxMemory() / (1024 * 1024)
            slots = sc.defaultParallelism
        else:
            txt = (sc.getConf().get("spark.executor.memory") or "1g").strip().lower()
            mult = {"k": 1 / 1024, "m": 1, "g": 1024, "t": 1024 * 1024}.get(txt[-1], 1 / (1024 * 1024))
            heap = float(txt[:-1] if txt[-1].isalpha() else txt) * mult
            slots = int(sc.getConf().get("spark.executor.cores") or 1)
    except Exception:  # noqa: BLE001 - sizing is a hint only
        return 128
    return int(max(16, min(1024, heap / max(1, slots) / 2)))


def tree_estimator(name: str, n_estimators: int | None = None, max_depth=None, learning_rate: float | None = None,
                   min_samples_leaf: int = 1, max_features="all", subsample: float = 1.0, seed: int = SEED):
    depth = MAX_TREE_DEPTH if max_depth is None else int(max_depth)
    common = dict(featuresCol="features", labelCol="label", predictionCol="prediction", seed=seed,
                  minInstancesPerNode=int(min_samples_leaf), maxDepth=depth)
    # deep trees: bigger node groups per pass and cached node ids cut the number of passes
    # over the data (measured: 300 unlimited-depth trees 218 s -> 104 s on 8 cores)
    deep = dict(maxMemoryInMB=tree_memory_mb(), cacheNodeIds=True, checkpointInterval=10)
    if name == "DecisionTree":
        return DecisionTreeRegressor(**common, **deep)
    if name == "RandomForest":
        strat = max_features if isinstance(max_features, str) else str(max_features)
        return RandomForestRegressor(numTrees=int(n_estimators or 100), featureSubsetStrategy=strat,
                                     subsamplingRate=1.0, bootstrap=True, **common, **deep)
    if name == "GBDT":
        return GBTRegressor(maxIter=int(n_estimators or 100), stepSize=float(learning_rate or 0.1),
                            subsamplingRate=float(subsample), featureSubsetStrategy="all", **common)
    raise ValueError(name)


def score(model, df: DataFrame) -> dict:
    """Null-safe RMSE / MAE / MAPE / R2 of ``model`` on ``df`` (one aggregate job)."""
    pred = model.transform(df).select(F.col("label").alias("y_true"), F.col("prediction").alias("y_pred"))
    r = metrics.regression_metrics(pred, "y_true", "y_pred").first().asDict()
    return r


def _row(model_name, target, h, sc, fit_time, n_train, params) -> tuple:
    return (model_name, target, int(h), sc.get("RMSE"), sc.get("MAE"), sc.get("MAPE(%)"), sc.get("R2"),
            float(fit_time), int(n_train), int(sc.get("n") or 0), {k: str(v) for k, v in params.items()})


def _grid(grid: dict) -> list[dict]:
    if not grid:
        return [{}]
    keys = list(grid)
    return [dict(zip(keys, vals)) for vals in itertools.product(*[grid[k] for k in keys])]


def score_many(models, df: DataFrame) -> list[float | None]:
    """Validation RMSE of several fitted models in ONE aggregate job: the models' transforms
    are chained into distinct prediction columns, then all RMSEs are one ``agg``."""
    out = df
    for i, m in enumerate(models):
        out = m.copy().setPredictionCol(f"__p{i}").transform(out)
    ok = F.col("label").isNotNull()
    aggs = [F.sqrt(F.avg(F.when(ok & F.col(f"__p{i}").isNotNull(),
                                (F.col("label") - F.col(f"__p{i}")) ** 2))).alias(f"r{i}") for i in range(len(models))]
    row = out.agg(*aggs).first()
    return [row[f"r{i}"] for i in range(len(models))]


#: Patterns of missing labels that get a second-moment matrix of their own.
MOST_PATTERNS = 32


@dataclass
class Moments:
    """Second moments of [features, labels, 1] by split and by which labels the rows have. Sums of
    them are the moments of any label's rows in any splits: nothing else is needed to solve a
    linear model or to know its squared error."""
    n_features: int
    labels: list
    parts: list  # [(split, labels present, matrix)]

    def of(self, label: str, splits_: tuple) -> np.ndarray:
        """The (features, label, 1) matrix over the rows of ``splits_`` that have the label."""
        d, j = self.n_features, self.labels.index(label)
        at = [*range(d), d + j, d + len(self.labels)]
        total = np.zeros((d + 2, d + 2))
        for split, present, m in self.parts:
            if split in splits_ and label in present:
                total += m[np.ix_(at, at)]
        return total

    def label_stats(self, label: str, splits_: tuple) -> tuple[int, float]:
        a = self.of(label, splits_)
        n = a[-1, -1]
        var = (a[-2, -2] - a[-2, -1] ** 2 / n) / (n - 1) if n > 1 else 0.0
        return int(round(n)), float(max(var, 0.0) ** 0.5)

    def squared_error(self, label: str, splits_: tuple, w: np.ndarray, b: float) -> float | None:
        a, v = self.of(label, splits_), np.concatenate([-w, [1.0, -b]])
        return float(max(v @ a @ v, 0.0)) / a[-1, -1] if a[-1, -1] else None


def second_moments(tf: TaskFrame) -> Moments | None:
    """One distributed pass over the train and val rows for all tasks: Z'Z of the centred features,
    the labels and 1 (MLlib's Gramian, partial sums on the executors); only these small matrices
    reach the driver. None if the labels are missing in more than :data:`MOST_PATTERNS` ways."""
    labels = [label_col(t, h) for t, h in tf.tasks]
    present = F.concat(*[F.when(q(c).isNull() | F.isnan(q(c)), "0").otherwise("1") for c in labels])
    rows = tf.df.where(F.col("split").isin("train", "val")).withColumn("__present", present)
    kinds = rows.groupBy("split", "__present").count().limit(2 * MOST_PATTERNS + 1).collect()
    if len(kinds) > 2 * MOST_PATTERNS:
        return None
    # centring keeps digits; the shift is the same for all splits and takes no part in a fit
    shift = StandardScaler(withMean=True, withStd=False, inputCol="features", outputCol="__x").fit(rows)
    parts = []
    for split, kind, _ in kinds:
        own = rows.where((F.col("split") == split) & (F.col("__present") == kind))
        own = shift.transform(own).select("__x", *[(q(c) if k == "1" else F.lit(0.0)).alias(f"__l{i}") for i, (c, k) in enumerate(zip(labels, kind))], F.lit(1.0).alias("__one"))
        z = VectorAssembler(inputCols=["__x", *[f"__l{i}" for i in range(len(labels))], "__one"], outputCol="z").transform(own).select("z")
        gram = RowMatrix(MLUtils.convertVectorColumnsFromML(z, "z")).computeGramianMatrix().toArray()
        parts.append((split, {c for c, k in zip(labels, kind) if k == "1"}, gram))
    return Moments(len(tf.feature_names), labels, parts)


def solve_linear(a: np.ndarray, name: str, alpha: float, l1_ratio: float | None = None, iterations: int = 5000) -> tuple[np.ndarray, float]:
    """Weights and intercept from the moments of (features, label, 1), with the objectives of
    :func:`linear_estimator`: ridge in closed form, lasso and elastic net by accelerated
    proximal steps on standardised features."""
    n, mean = a[-1, -1], a[:-1, -1] / a[-1, -1]
    s = a[:-1, :-1] - n * np.outer(mean, mean)
    sxx, sxy = s[:-1, :-1], s[:-1, -1]
    if name in ("Ridge", "LinearSVR"):
        w = np.linalg.solve(sxx + alpha * np.eye(len(sxy)), sxy)
    else:
        r = 1.0 if name == "Lasso" else l1_ratio
        scale = np.sqrt(np.maximum(np.diag(sxx) / n, 1e-300))
        scale = np.where(scale > 1e-12, scale, 1.0)
        g = sxx / n / np.outer(scale, scale) + np.diag(alpha * (1 - r) / scale ** 2)
        c, cut = sxy / n / scale, alpha * r / scale
        step = 1.0 / max(np.linalg.eigvalsh(g)[-1], 1e-300)
        v = u = np.zeros(len(c))
        t = 1.0
        for _ in range(iterations):
            x = u - step * (g @ u - c)
            new = np.sign(x) * np.maximum(np.abs(x) - step * cut, 0.0)
            if (u - new) @ (new - v) > 0:  # momentum points uphill: start it again
                t = 1.0
            t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
            u = new + (t - 1) / t_new * (new - v)
            done = np.max(np.abs(new - v), initial=0.0) <= 1e-9 * max(1.0, np.max(np.abs(new), initial=0.0))
            v, t = new, t_new
            if done:
                break
        w = v / scale
    return w, float(mean[-1] - w @ mean[:-1])


def _best_point(moments: Moments, label: str, name: str, points: list[dict]) -> dict:
    """The grid point with the least squared error on val, fitted on train, from moments alone."""
    fit = moments.of(label, ("train",))
    errors = [moments.squared_error(label, ("val",), *solve_linear(fit, name, p["alpha"], p.get("l1_ratio"))) if fit[-1, -1] else None for p in points]
    scored = [(e, i) for i, e in enumerate(errors) if e is not None]
    return points[min(scored)[1]] if scored else points[0]


def fit_linear_task(tf: TaskFrame, target: str, h: int, name: str, grid: dict | None = None, moments: Moments | None = None) -> tuple:
    """Plain fit on train (no grid) or single predefined fold: pick by val RMSE, refit on train+val.

    With the ``moments`` of a suite the grid costs no pass over the rows. Without, the task's train
    and val rows are cached during the search (every grid point re-reads them)."""
    lab = label_col(target, h)
    train, val, test = _fit_rows(tf, lab, ("train",)), _fit_rows(tf, lab, ("val",)), _fit_rows(tf, lab, ("test",))
    grid = LINEAR_GRIDS.get(name, {}) if grid is None else grid
    t0 = time.time()
    if moments:
        points = _grid(grid)
        best = _best_point(moments, lab, name, points) if grid else {}
        fit = ("train", "val") if grid else ("train",)
        n_fit, s = moments.label_stats(lab, fit)
        model = linear_estimator(name, n_fit, s, best.get("alpha"), best.get("l1_ratio"), best.get("max_iter", 100)).fit(_fit_rows(tf, lab, fit))
    elif not grid:
        n, s = (train.count(), 0.0) if name == "LinearRegression" else _label_stats(train)
        model = linear_estimator(name, n, s).fit(train)
        best, n_fit = {}, n
    else:
        train, val = train.persist(), val.persist()
        n, s = _label_stats(train)
        points = _grid(grid)
        fitted = [linear_estimator(name, n, s, p.get("alpha"), p.get("l1_ratio"), p.get("max_iter", 100)).fit(train)
                  for p in points]
        rmses = score_many(fitted, val)
        scored = [(r, i) for i, r in enumerate(rmses) if r is not None]
        best = points[min(scored)[1]] if scored else points[0]
        refit = train.unionByName(val)
        n_fit, s2 = _label_stats(refit)
        model = linear_estimator(name, n_fit, s2, best.get("alpha"), best.get("l1_ratio"),
                                 best.get("max_iter", 100)).fit(refit)
        train.unpersist()
        val.unpersist()
    fit_time = time.time() - t0
    return _row(name, target, h, score(model, test), fit_time, n_fit, best), model


def fit_tree_task(tf: TaskFrame, target: str, h: int, name: str, params: dict | None = None) -> tuple:
    """Fit on train with fixed settings, score on test."""
    lab = label_col(target, h)
    train, test = _fit_rows(tf, lab, ("train",)), _fit_rows(tf, lab, ("test",))
    p = dict(TREE_SPECS.get(name, {}) if params is None else params)
    n = train.count()
    if name == "RandomForest":
        train = train.repartition(forest_partitions(n), q(tf.key), "__pos").sortWithinPartitions(q(tf.key), "__pos")
    t0 = time.time()
    model = tree_estimator(name, **p).fit(train)
    fit_time = time.time() - t0
    return _row(name, target, h, score(model, test), fit_time, n, p), model


def _fold_masks(df: DataFrame, key: str, n_splits: int) -> DataFrame:
    """Per-series position / count among the fit rows, for expanding time folds."""
    return df.select("*", (F.row_number().over(series_window(key, "__pos")) - 1).alias("__fpos"),
                     F.count(F.lit(1)).over(group_window(key)).alias("__fn"))


def _nested(points: list[dict]) -> list[list[dict]]:
    """Grid points that differ in their number of trees only, together, fewest trees first."""
    groups: dict[str, list[dict]] = {}
    for p in points:
        groups.setdefault(repr(sorted((k, v) for k, v in p.items() if k != "n_estimators")), []).append(p)
    return [sorted(g, key=lambda p: p["n_estimators"] or 0) if all(p.get("n_estimators") for p in g) else g for g in groups.values()]


def _r2(squared_error: float, n: int, variance: float) -> float | None:
    """As the regression metrics have it: of a constant label 1 if perfect, else 0."""
    if not n:
        return None
    if variance * n == 0:
        return 1.0 if squared_error == 0 else 0.0
    return 1 - squared_error / variance


def forest_prefix(model, trees: int):
    """The forest of the first ``trees`` trees of ``model``."""
    if trees >= model.getNumTrees:
        return model
    jvm, java = SparkContext._active_spark_context._jvm, model._java_obj
    first = jvm.org.apache.spark.ml.regression.RandomForestRegressionModel(f"{java.uid()}_first_{trees}", java.trees()[:trees], java.numFeatures())
    return type(model)(first.set(first.getParam("numTrees"), trees))  # predictions are sums divided by this parameter


def fold_scores(name: str, points: list[dict], train: DataFrame, test: DataFrame) -> list[float | None]:
    """R2 on ``test`` of each of ``points``, which differ in their number of trees only.

    Boosting adds tree after tree, so the largest model's first k trees are the model of k rounds. The trees
    of a forest are independent draws and, with the reference's fixed seed, its smaller forest is the first
    trees of the larger one. So one fit and one pass over the test rows score all of them."""
    if len(points) == 1:
        return [score(tree_estimator(name, **p).fit(train), test)["R2"] for p in points]
    n, variance = test.agg(F.count("label"), F.var_pop("label")).first()
    if not n:
        return [None] * len(points)
    sizes = [int(p.get("n_estimators") or 100) for p in points]
    model = tree_estimator(name, **points[sizes.index(max(sizes))]).fit(train)
    if name == "GBDT":
        errors = model.evaluateEachIteration(test, "squared")
        return [_r2(errors[min(k, len(errors)) - 1], n, variance) for k in sizes]
    return [_r2(e ** 2, n, variance) for e in score_many([forest_prefix(model, k) for k in sizes], test)]


#: Fits of one grid search at once at most: one scheduler plans all their jobs (60 boosting rounds on 2,640
#: rows, 8 cores: 14.9 s alone, 23.9 s for 8 at once, 48.9 s for 16).
FITS_AT_ONCE = 16


def fits_at_once(name: str, partitions: int, slots: int, n_splits: int) -> int:
    """Fits of a grid search at once: as many as fill the task slots. Deep forests hold their node statistics,
    so in local mode the heap bounds them; a boosting's trees have few nodes."""
    wanted = max(n_splits, min(FITS_AT_ONCE, -(-slots // partitions)))
    return task_workers(wanted) if name == "RandomForest" else wanted


def fit_tuned_tree_task(tf: TaskFrame, target: str, h: int, name: str, grid: dict, n_splits: int = 3) -> tuple:
    """Grid search over expanding time folds (mean R2; ties: the earlier grid point), refit best on
    train+val, score on test."""
    lab = label_col(target, h)
    # the folds' window leaves as many partitions as the session shuffles to, 200 by default, and each sends
    # its statistics of every node: the rows are dealt again by their number, like a forest's. The fits of a
    # grid are many, so while there are few rows they fill the cores by running at once.
    rows = _fit_rows(tf, lab, ("train", "val"))
    parts = forest_partitions(rows.count())
    rows = _fold_masks(rows, tf.key, n_splits).repartition(parts, q(tf.key), "__pos")
    fit_rows = rows.sortWithinPartitions(q(tf.key), "__pos").persist()
    test = _fit_rows(tf, lab, ("test",))
    size = F.floor(F.col("__fn") / F.lit(n_splits + 1))
    t0 = time.time()
    points = _grid(grid)
    scores = {}

    def fold(i, group):
        start = F.col("__fn") - (F.lit(n_splits - i)) * size
        tr = fit_rows.where(F.col("__fpos") < start)
        te = fit_rows.where((F.col("__fpos") >= start) & (F.col("__fpos") < start + size))
        return fold_scores(name, group, tr, te)
    groups = _nested(points)
    fits = [(g, i) for g in range(len(groups)) for i in range(n_splits)]
    slots = SparkContext._active_spark_context.defaultParallelism
    with ThreadPoolExecutor(max_workers=fits_at_once(name, parts, slots, n_splits)) as ex:
        got = dict(zip(fits, ex.map(lambda f: fold(f[1], groups[f[0]]), fits)))
    for g, group in enumerate(groups):
        for j, p in enumerate(group):
            vals = [got[g, i][j] for i in range(n_splits) if got[g, i][j] is not None]
            if vals:
                scores[repr(p)] = sum(vals) / len(vals)
    best = max((p for p in points if repr(p) in scores), key=lambda p: scores[repr(p)], default=points[0])
    model = tree_estimator(name, **best).fit(fit_rows)
    fit_time = time.time() - t0
    n = fit_rows.count()
    fit_rows.unpersist()
    return _row(f"{name}_TUNED", target, h, score(model, test), fit_time, n, best), model


def _heap_mb() -> float | None:
    from pyspark import SparkContext
    sc = SparkContext._active_spark_context
    if sc is None or not sc.master.startswith("local"):
        return None
    return sc._jvm.java.lang.Runtime.getRuntime().maxMemory() / (1024 * 1024)


def task_workers(requested: int = 4) -> int:
    """Concurrent fits: as requested on a cluster; in local mode about one per 3 GB of heap
    (deep forests hold their node statistics on the single local executor)."""
    heap = _heap_mb()
    if heap is None:
        return max(1, requested)
    return max(1, min(requested, int(heap // 3072)))


def run_tasks(spark: SparkSession, fn, tasks, workers: int = 4) -> DataFrame:
    """Run independent task fits from a small driver thread pool (concurrent Spark jobs)."""
    with ThreadPoolExecutor(max_workers=task_workers(workers)) as ex:
        results = list(ex.map(fn, tasks))
    rows = [r[0] if isinstance(r, tuple) and len(r) == 2 and isinstance(r[0], tuple) else r for r in results]
    return spark.createDataFrame(rows, SCORE_SCHEMA)


def feature_importance(model, feature_names, model_name: str, target: str, h: int) -> list[tuple]:
    """(model, pollutant, horizon_h, feature, importance) rows from a tree model."""
    imp = model.featureImportances.toArray()
    return [(model_name, target, int(h), f, float(v)) for f, v in zip(feature_names, imp)]


IMPORTANCE_SCHEMA = StructType([
    StructField("model", StringType()), StructField("pollutant", StringType()),
    StructField("horizon_h", IntegerType()), StructField("feature", StringType()),
    StructField("importance", DoubleType()),
])


# ----------------------------------------------------------------------------- status classifier

CLS_SCHEMA = StructType([
    StructField("model", StringType()), StructField("horizon_h", IntegerType()),
    StructField("accuracy", DoubleType()), StructField("precision_macro", DoubleType()),
    StructField("recall_macro", DoubleType()), StructField("f1_macro", DoubleType()),
    StructField("precision_weighted", DoubleType()), StructField("recall_weighted", DoubleType()),
    StructField("f1_weighted", DoubleType()), StructField("n", LongType()), StructField("fit_time_s", DoubleType()),
])


def window_summary_frame(df: DataFrame, features, label: str, seq_len: int, horizons, key="entity_id",
                         ts="ts", block_hours: int | None = None) -> tuple[DataFrame, list[str]]:
    """Summary of each full ``seq_len`` window: last value, mean, sample std per feature, plus
    the label ``h`` rows after the window end for each horizon (``cls__h<h>``). With ``split``
    among the keys windows and labels stay inside their split. ``block_hours``: the same rows
    from blocks of that many hours of a series on the hourly grid, so that no task holds a series."""
    if block_hours:
        names: list[str] = []

        def summary(block: DataFrame, keys) -> DataFrame:
            out, found = window_summary_frame(block, features, label, seq_len, horizons, keys, ts)
            names[:] = found
            return out
        return blockwise(df, summary, block_hours, seq_len - 1, max(horizons), key, ts), names
    keys, times = as_list(key), as_list(ts)
    names, labs = _summary_names(features, horizons)
    src = _placed_rows(df, features, label, key, ts)
    carried = [*keys, *times, *([] if "split" in keys else ["split"])]
    schema = StructType([src.schema[c] for c in carried] + [StructField(c, DoubleType()) for c in names]
                        + [StructField(c, src.schema["__label"].dataType) for c in labs])
    steps, fields = tuple(horizons), schema.names
    n_features = len(as_list(features))
    return src.mapInArrow(lambda rows: windows.summaries(rows, carried, n_features, seq_len, steps, fields), schema), names


def _summary_names(features, horizons) -> tuple[list[str], list[str]]:
    return [f"{c}__{s}" for c in as_list(features) for s in ("last", "wmean", "wstd")], [f"cls__h{h}" for h in horizons]


def _placed_rows(df: DataFrame, features, label: str, key, ts) -> DataFrame:
    """Keys, times, split, ``__label`` and ``__x<i>`` of every row and its place ``__pos`` in its series. The window
    of ``__pos`` leaves each series whole and in order in one partition; tasks check it by ``__pos``."""
    keys = as_list(key)
    return df.select(*[q(k) for k in keys], *[q(t) for t in as_list(ts)], *([] if "split" in keys else ["split"]),
                     F.row_number().over(series_window(key, ts)).alias("__pos"), q(label).alias("__label"),
                     *[q(c).cast("double").alias(f"__x{i}") for i, c in enumerate(as_list(features))])


def window_blocks(df: DataFrame, features, label: str, seq_len: int, horizons, key="entity_id", ts="ts",
                  block_hours: int | None = None) -> DataFrame:
    """The rows of :func:`window_summary_frame` as the blocks that the classifier is fitted on: made and packed by the
    same task, so that no summary becomes a Spark row on the way."""
    names, labs = _summary_names(features, horizons)
    if block_hours:
        return softmax.to_blocks(window_summary_frame(df, features, label, seq_len, horizons, key, ts, block_hours)[0], names, labs)
    src = _placed_rows(df, features, label, key, ts)
    src = src.select("split", "__pos", F.col("__label").cast("int").alias("__label"), *[c for c in src.columns if c.startswith("__x")])
    n_features, steps, fields = len(as_list(features)), tuple(horizons), ["split", *names, *labs]
    return src.mapInArrow(lambda rows: softmax.pack(windows.summaries(rows, ["split"], n_features, seq_len, steps, fields), names, labs),
                          softmax.BLOCK_SCHEMA)


def fit_status_classifier(spark: SparkSession, summary: DataFrame, feature_names, horizons, max_iter: int = 100,
                          reg: float = 0.0, key="entity_id", save_to: str | None = None,
                          blocks: DataFrame | None = None) -> DataFrame:
    """Multinomial logistic regression per horizon on window summaries; metrics on test. Rows
    with a missing feature raise. The summaries (or the same as :func:`window_blocks`) are made once, as blocks
    in the shared folder, and every pass over them serves all horizons (:mod:`sensorgrid.operators.softmax`); with ``save_to`` the
    models are kept as ``<save_to>/status/h<h>/LogisticRegression``."""
    names, labs = list(feature_names), [f"cls__h{h}" for h in horizons]
    path = scratch_path(spark, "window_blocks")
    made = softmax.to_blocks(summary, names, labs) if blocks is None else blocks
    made.write.partitionBy("split").parquet(path)
    blocks = spark.read.schema(softmax.BLOCK_SCHEMA).parquet(path)
    if blocks.agg(F.sum("incomplete")).first()[0]:
        asm = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
        require_complete(asm.transform(summary), names, key)
    t0 = time.time()
    models = softmax.fit(blocks.where(F.col("split") == "train"), len(labs), max_iter, reg)
    ft = time.time() - t0
    if save_to:
        for h, (coef, intercept) in zip(horizons, models):
            save_model(logistic_model(coef, intercept), f"{save_to}/status/h{int(h)}/LogisticRegression")
    counts = softmax.confusion_counts(blocks.where(F.col("split") == "test"), models)
    found = {r["label"]: r for r in metrics.classification_metrics(counts, by="label", weight="n").collect()}
    rows = [("LogisticRegression", int(h), r["accuracy"], r["precision_macro"], r["recall_macro"],
             r["f1_macro"], r["precision_weighted"], r["recall_weighted"], r["f1_weighted"], int(r["n"]), ft)
            for i, h in enumerate(horizons) if (r := found.get(i)) is not None]
    return spark.createDataFrame(rows, CLS_SCHEMA)


def logistic_model(coef: np.ndarray, intercept: np.ndarray) -> LogisticRegressionModel:
    """MLlib's model with these coefficients (classes x features)."""
    return LogisticRegressionModel(JavaWrapper._new_java_obj(
        "org.apache.spark.ml.classification.LogisticRegressionModel", "status_" + uuid.uuid4().hex[:12],
        DenseMatrix(*coef.shape, coef.ravel(order="F").tolist()), DenseVector(intercept), len(intercept), True))


# ----------------------------------------------------------------------------- persistence of models

def save_model(model, path: str) -> str:
    model.write().overwrite().save(path)
    return path


def load_model(kind: str, path: str):
    from pyspark.ml.regression import (DecisionTreeRegressionModel, GBTRegressionModel, LinearRegressionModel,
                                       RandomForestRegressionModel)
    cls = {"LinearRegression": LinearRegressionModel, "Ridge": LinearRegressionModel, "Lasso": LinearRegressionModel,
           "ElasticNet": LinearRegressionModel, "LinearSVR": LinearRegressionModel,
           "DecisionTree": DecisionTreeRegressionModel, "RandomForest": RandomForestRegressionModel,
           "GBDT": GBTRegressionModel, "LogisticRegression": LogisticRegressionModel}[kind.removesuffix("_TUNED")]
    return cls.load(path)
