"""The status classifier's fit: blocks of windows, sums of all horizons in one pass, Newton's method."""

import datetime as dt

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from sensorgrid.operators import models as M
from sensorgrid.operators import softmax
from sensorgrid.operators.common import series_window


@pytest.fixture(scope="module")
def series(spark):
    rng = np.random.default_rng(5)
    t0, rows = dt.datetime(2004, 3, 1), []
    for e in ("a", "b", "c"):
        x, y = np.cumsum(rng.normal(size=400)), rng.normal(size=400) * 50
        c = np.digitize(x + rng.normal(size=400) * 4, [-3, 3])
        rows += [(e, t0 + dt.timedelta(hours=i), "train" if i < 250 else "val" if i < 280 else "test", float(x[i]), float(y[i]), int(c[i])) for i in range(400)]
    return spark.createDataFrame(rows, "entity_id string, ts timestamp_ntz, split string, x double, y double, cls int").repartition(3)


WINDOWS = (["x", "y"], "cls", 24, (1, 6), ["entity_id", "split"])


def test_summaries_are_those_of_spark_frames(spark, series):
    got, names = M.window_summary_frame(series, *WINDOWS)
    w = series_window(["entity_id", "split"], "ts")
    fr = w.rowsBetween(-23, 0)
    cols = [c for f in ("x", "y") for c in (F.col(f).alias(f"{f}__last"), F.avg(f).over(fr).alias(f"{f}__wmean"), F.stddev_samp(f).over(fr).alias(f"{f}__wstd"))]
    want = series.select("entity_id", "split", "ts", *cols, *[F.lead("cls", h).over(w).alias(f"cls__h{h}") for h in (1, 6)],
                         F.count(F.lit(1)).over(fr).alias("n")).where("n = 24").drop("n")
    rows = sorted(map(tuple, want.collect()), key=str)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == rows and len(rows) == 3 * (227 + 7 + 97)
    small = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)  # batches shorter than a window
    try:
        assert sorted(map(tuple, M.window_summary_frame(series, *WINDOWS)[0].select(*want.columns).collect()), key=str) == rows
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", small)


@pytest.mark.parametrize("reg", [0.0, 0.05])
def test_newton_finds_the_models_of_mllib(spark, series, reg):
    summary, names = M.window_summary_frame(series, *WINDOWS)
    blocks = M.window_blocks(series, *WINDOWS).cache()
    models = softmax.fit(blocks.where("split = 'train'"), 2, reg=reg)
    rows = VectorAssembler(inputCols=names, outputCol="features").transform(summary).cache()
    for (coef, intercept), h in zip(models, (1, 6)):
        train = rows.where(f"split = 'train' and cls__h{h} is not null").withColumn("label", F.col(f"cls__h{h}").cast("double"))
        want = LogisticRegression(family="multinomial", maxIter=1000, tol=1e-14, regParam=reg).fit(train)
        assert np.allclose(coef, want.coefficientMatrix.toArray(), rtol=1e-4, atol=1e-5)
        assert np.allclose(intercept, want.interceptVector.toArray(), rtol=1e-4, atol=1e-4)
        made = M.logistic_model(coef, intercept)
        test = rows.where(f"split = 'test' and cls__h{h} is not null")
        pred = {(r[0], int(r[1])): r["count"] for r in made.transform(test).groupBy(f"cls__h{h}", "prediction").count().collect()}
        counts = softmax.confusion_counts(blocks.where("split = 'test'"), models).where(F.col("label") == (1, 6).index(h))
        assert {(r.y_true, r.y_pred): r.n for r in counts.collect()} == pred


def test_all_horizons_are_fitted_by_the_same_few_passes(spark, series, monkeypatch):
    passes, sums = [], softmax.newton_sums
    monkeypatch.setattr(softmax, "newton_sums", lambda b, n, c, s, tasks: passes.append(len(tasks)) or sums(b, n, c, s, tasks))
    summary, names = M.window_summary_frame(series, *WINDOWS)
    rows = M.fit_status_classifier(spark, summary, names, (1, 6)).collect()
    assert [r.horizon_h for r in rows] == [1, 6] and passes[0] == 2 and len(passes) <= 10


def test_a_missing_feature_is_named(spark, series):
    bad = series.withColumn("y", F.when((F.col("entity_id") != "b") | (F.hour("ts") != 5), F.col("y")))
    summary, names = M.window_summary_frame(bad, *WINDOWS)
    with pytest.raises(ValueError, match="b: y__last"):
        M.fit_status_classifier(spark, summary, names, (1, 6), blocks=M.window_blocks(bad, *WINDOWS))


def test_a_class_without_rows_is_never_predicted(spark, series):
    only = series.withColumn("cls", F.when(F.col("cls") == 1, 2).otherwise(F.col("cls")))
    (coef, intercept), _ = softmax.fit(M.window_blocks(only, *WINDOWS).where("split = 'train'"), 2)
    assert len(intercept) == 3 and intercept[1] == -np.inf and not coef[1].any()
