"""Status classification: naive class persistence and a multinomial classifier on window summaries.

The reference's recurrent networks read 24-hour windows; here each window is
summarised (last value, mean, std of every feature — the same rolling
windows the feature pack uses) and a multinomial logistic regression is
fitted per horizon. The naive baseline is ``lead(cls, h)`` vs ``cls``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgrid.operators import metrics
from sensorgrid.operators import models as M
from sensorgrid.operators.targets import persistence_forecast
from sensorgrid.plans.prepare import PrepareConfig, feature_pack, feature_pack_blocked

HORIZONS = (1, 6, 12, 24)


def naive_class_scores(pack: DataFrame, horizons=HORIZONS, split: str | None = "test", key="entity_id",
                       ts="ts") -> DataFrame:
    """y_true = class h rows later, y_pred = class now; metrics per horizon on ``split`` rows."""
    d = pack.select(key, ts, "split", "target_cls")
    p = persistence_forecast(d, "target_cls", horizons, key, ts, carry=["split"])
    if split is not None:
        p = p.where(F.col("split") == split)
    p = p.select("horizon_h", F.col("y_true").cast("int").alias("y_true"), F.col("y_pred").cast("int").alias("y_pred"))
    return metrics.classification_metrics(p, by="horizon_h").select(F.lit("Naive").alias("model"), "*")


def status_classifier(spark: SparkSession, cleaned: DataFrame, cfg: PrepareConfig, features, seq_len: int = 24,
                      horizons=HORIZONS, max_iter: int = 100) -> DataFrame:
    """Fit + score the multinomial classifier for every horizon (one row per horizon); pack and
    summaries in blocks of ``cfg.block_hours`` if set."""
    pk = feature_pack_blocked(cleaned, cfg) if cfg.block_hours else feature_pack(cleaned, cfg)
    windows = (pk, features, "target_cls", seq_len, horizons, [cfg.key, "split"], cfg.ts, cfg.block_hours)
    summary, names = M.window_summary_frame(*windows)
    return M.fit_status_classifier(spark, summary, names, horizons, max_iter=max_iter, blocks=M.window_blocks(*windows))


def comparison_table(scores: DataFrame) -> DataFrame:
    """Model x horizon table with 4-decimal strings (Model, Horizon, Accuracy, F1 Score, Precision, Recall)."""
    def fmt(c):
        return F.format_string("%.4f", F.round(F.col(c) + F.signum(c) * F.lit(1e-9), 4))
    return scores.select(F.col("model").alias("Model"), F.format_string("%dh", "horizon_h").alias("Horizon"),
                         fmt("accuracy").alias("Accuracy"), fmt("f1_macro").alias("F1 Score"),
                         fmt("precision_macro").alias("Precision"), fmt("recall_macro").alias("Recall"))


METRIC_NAMES = ("accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted",
                "recall_weighted", "f1_weighted")


def results_json_frame(scores: DataFrame) -> DataFrame:
    """Nested results: one row per model with MAP<horizon, STRUCT<metrics>> (the JSON dump layout)."""
    cell = F.struct(*[F.col(m).alias(m) for m in METRIC_NAMES])
    return scores.groupBy("model").agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("horizon_h").cast("string"), cell))).alias("by_horizon"))


def write_results_json(scores: DataFrame, path: str) -> str:
    results_json_frame(scores).coalesce(1).write.mode("overwrite").json(path)
    return path
