"""The reference's three workflows as Spark jobs with a command line.

  python -m sensorgrid.plans.jobs prepare  --csv RAW.csv --out PACK_DIR [--entity station_1] [--block-hours N]
  python -m sensorgrid.plans.jobs regress  --pack PACK_DIR --out RESULTS_DIR [--models persistence linear trees svr tuned] [--horizons 1 6 12 24]
  python -m sensorgrid.plans.jobs classify --pack PACK_DIR --out RESULTS_DIR [--seq-len 24] [--block-hours N]

``prepare`` writes ``cleaned`` (parquet), ``features/trees`` and ``features/nn``
(parquet partitioned by split) and ``artifacts`` (JSON metadata). ``regress``
scores the persistence forecast, fits every (pollutant x horizon) task, saves the
fitted models and enters each finished task in a ledger (a rerun fits only what is
missing there), writes one results CSV per model family, then the merged
leaderboard, winners, family winners and averages; ``--models tuned`` adds the grid
searches of both tree families over the full grids. ``classify``
writes the naive and classifier scores as a comparison CSV and nested JSON and saves the
classifiers.
Paths may be any Hadoop filesystem URI; intermediate state goes to
``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgrid.functions.columns import numeric_columns, pick_target_column, pollutant_candidates, priority_features
from sensorgrid.operators import clean, leaderboard as lb
from sensorgrid.operators.clean import MISSING_SUFFIX
from sensorgrid.operators.grid import GAP_COL
from sensorgrid.plans.prepare import (PrepareConfig, clean_readings, clean_readings_blocked, feature_pack,
                                      feature_pack_blocked, pack_columns, scaled_pack)
from sensorgrid.sources.csv_eu import read_eu_csv
from sensorgrid.sources.metadata import pack_metadata, write_metadata
from sensorgrid.sources.packs import load_pack, write_checked_pack, write_table
from sensorgrid.sources.results import read_result_tables, write_result_table

HORIZONS = (1, 6, 12, 24)


def raw_frame(spark: SparkSession, csv: str, entity: str = "station_1", entity_col: str | None = None) -> DataFrame:
    """Typed raw readings with an ``entity_id`` (a constant, or an existing column)."""
    df = read_eu_csv(spark, csv, keep_strings=[entity_col] if entity_col else (), min_valid=100)
    ent = F.col(f"`{entity_col}`") if entity_col else F.lit(entity)
    return df.select(ent.cast("string").alias("entity_id"), *[F.col(f"`{c}`") for c in df.columns if c != entity_col])


def prepare_config(raw: DataFrame, fit_years=(2004,), test_years=(2005,), block_hours: int | None = None,
                   stats_scope: str = "all") -> PrepareConfig:
    """Sensors = numeric columns; target = the CO rule; features = priority-name rule over
    sensors + their missing flags (the reference's 12 of 26 candidates)."""
    sensors = numeric_columns(raw, exclude=["entity_id", "ts"])
    candidates = sensors + [f"{c}{MISSING_SUFFIX}" for c in sensors]
    feats = priority_features(candidates, exclude=["target_reg", "target_cls"])
    return PrepareConfig(sensors=sensors, target=pick_target_column(sensors), features=feats,
                         fit_years=tuple(fit_years), test_years=tuple(test_years), block_hours=block_hours,
                         stats_scope=stats_scope, dedup_order=list(sensors))


def prepare_job(spark: SparkSession, csv: str, out: str, cfg: PrepareConfig | None = None,
                entity: str = "station_1", entity_col: str | None = None, scale_scope: str = "train") -> dict:
    """``scale_scope``: rows on which the scaled pack's means are fitted, "train" or "all"."""
    raw = raw_frame(spark, csv, entity, entity_col)
    # duplicate timestamps: keep the smallest readings tuple, missing readings last (a total
    # order; the reference's sort is unstable, so any fixed rule is as faithful)
    cfg = cfg or prepare_config(raw)
    base = out.rstrip("/")
    if cfg.block_hours:
        cleaned = clean_readings_blocked(raw, cfg)
        write_table(cleaned.drop("__blk"), f"{base}/cleaned")
        cleaned_r = spark.read.parquet(f"{base}/cleaned")
        pk = feature_pack_blocked(cleaned_r, cfg)
    else:
        write_table(clean_readings(raw, cfg), f"{base}/cleaned")
        cleaned_r = spark.read.parquet(f"{base}/cleaned")
        pk = feature_pack(cleaned_r, cfg)
    # rows, missing features and bad labels are counted by the writes themselves
    feats = pack_columns(pk)
    written = write_checked_pack(pk, base, feats, "trees")
    trees = spark.read.parquet(f"{base}/features/trees")
    scaled = write_checked_pack(scaled_pack(trees, scope=scale_scope), base, feats, "nn")
    if scaled.rows != written.rows:
        raise RuntimeError(f"{base}: {written.rows} rows in the raw pack, {scaled.rows} in the scaled one")
    meta = pack_metadata(cleaned_r, written.rows, cfg.target, cfg.features, cfg.lags, cfg.rolls, cfg.thresholds,
                         n_features=len(feats), rule=split_rule(cfg))
    write_metadata(meta, f"{base}/artifacts")
    r = meta.first().asDict()
    return {"co_column": r["co_column"], "features": r["priority_features"], "rows_total": r["rows_total"],
            "rows_after_warmup": r["rows_after_warmup"], "X_shape": r["X_trees_shape"], "packs": {"trees": written.by_split, "nn": scaled.by_split}}


def split_rule(cfg: PrepareConfig) -> str:
    """The split in words, for the metadata."""
    val = f"last {cfg.val_fraction:.0%} val"
    if cfg.test_start is not None:
        return f"before {cfg.test_start} train/val ({val}), test from then on"
    years = lambda ys: ", ".join(map(str, ys))
    return f"{years(cfg.fit_years)} train/val ({val}), {years(cfg.test_years)} test"


#: Model families of the regression job; "tuned" runs the full grids and is not in the default.
MODELS = ("persistence", "linear", "trees", "svr")


def regression_job(spark: SparkSession, pack_dir: str, out: str, pollutants=None, horizons=HORIZONS,
                   linear=("LinearRegression", "Ridge", "Lasso", "ElasticNet"),
                   trees=("DecisionTree", "RandomForest", "GBDT"), workers: int = 4, models=MODELS,
                   tuned_grids: dict | None = None) -> dict:
    from sensorgrid.operators import models as M
    from sensorgrid.plans.ledger import Ledger
    from sensorgrid.plans.regression import linear_suite, linear_svr_equiv, persistence_suite, tree_suite, tuned_tree_suite
    base = pack_dir.rstrip("/")
    cleaned = spark.read.parquet(f"{base}/cleaned")
    sensors = [c for c in numeric_columns(cleaned, exclude=["entity_id", "ts"])
               if not c.endswith(MISSING_SUFFIX) and c != GAP_COL]
    if pollutants is None:
        cand = pollutant_candidates(sensors) or sensors
        varying = {r.column for r in clean.non_constant_columns(cleaned, cand).collect() if r.varying}
        pollutants = [c for c in cand if c in varying]
    tasks = [(p, h) for p in pollutants for h in horizons]
    trees_pack = load_pack(spark, base, "trees", split=None)
    feats = pack_columns(trees_pack)
    labels = _labels(cleaned, tasks)
    tf = M.build_task_frame(trees_pack.select("entity_id", "ts", "split", *feats), feats, tasks, labels=labels)
    nn_pack = load_pack(spark, base, "nn", split=None)
    tf_nn = M.build_task_frame(nn_pack.select("entity_id", "ts", "split", *feats), feats, tasks, labels=labels)
    res = out.rstrip("/")
    saved = f"{res}/models"
    # a rerun of a job that was stopped fits only what its ledger lacks
    book = Ledger(spark, f"{res}/ledger")
    ledger, ledger_nn = book.of(tf), book.of(tf_nn)
    written = {}
    if "persistence" in models:
        written["persistence"] = persistence_suite(cleaned, trees_pack, tasks)
    if "linear" in models and linear:
        written["linear"] = linear_suite(spark, tf, names=linear, workers=workers, save_to=saved, ledger=ledger)
    if "trees" in models and trees:
        written["trees"] = tree_suite(spark, tf, names=trees, workers=workers, save_to=saved, ledger=ledger)
    if "svr" in models:
        written["svr"] = linear_svr_equiv(spark, tf_nn, workers=workers, save_to=saved, ledger=ledger_nn)
    if "tuned" in models:
        grids = tuned_grids or {"RandomForest": M.RF_GRID, "GBDT": M.GBDT_GRID}
        # kept beside the results under the name the merge skips, as the reference does
        tuned = tuned_tree_suite(spark, tf, grids, workers=workers, save_to=saved, ledger=ledger)
        write_result_table(tuned.withColumn("params", F.to_json("params")), f"{res}/results/tuned_tree_results.csv")
    for fam, df in written.items():
        write_result_table(df.drop("params"), f"{res}/results/{fam}_results.csv")
    return leaderboard_job(spark, f"{res}/results", res)


def _labels(cleaned: DataFrame, tasks) -> DataFrame:
    from sensorgrid.operators.common import series_window
    w = series_window("entity_id", "ts")
    return cleaned.select("entity_id", "ts", *[F.lead(F.col(f"`{t}`"), h).over(w).cast("double").alias(f"y__{t}__h{h}")
                                              for t, h in tasks])


def leaderboard_job(spark: SparkSession, results_dir: str, out: str) -> dict:
    """Merge result tables; write leaderboard, winners, family winners and averages as CSV."""
    allres = lb.drop_exact_duplicates(read_result_tables(spark, results_dir, keep_extra=()))
    # ties go by content, so that reruns and other file orders agree
    allres = allres.select("*", F.xxhash64(*[F.col(f"`{c}`") for c in allres.columns]).alias("run_id"))
    best = lb.dedup_keep_best(allres).persist()
    outs = {
        "leaderboard": lb.leaderboard_sort(lb.with_family(best)).drop("run_id", "cell_rank"),
        "winners": lb.overall_winners(best),
        "family_best": lb.family_best_by_cell(best).drop("family_order"),
        "top_by_cell": lb.top_k_per_cell(allres).drop("run_id"),
        "avg_by_pollutant": lb.avg_by_pollutant(allres),
        "avg_by_horizon": lb.avg_by_horizon(allres),
        "avg_by_model": lb.avg_by_model(allres),
    }
    counts = {}
    for name, df in outs.items():
        write_result_table(df, f"{out.rstrip('/')}/{name}.csv")
        counts[name] = spark.read.option("header", True).csv(f"{out.rstrip('/')}/{name}.csv").count()
    best.unpersist()
    return counts


def classification_job(spark: SparkSession, pack_dir: str, out: str, seq_len: int = 24, horizons=HORIZONS,
                       block_hours: int | None = None) -> dict:
    from sensorgrid.operators import models as M
    from sensorgrid.plans.classification import comparison_table, naive_class_scores, write_results_json
    base = pack_dir.rstrip("/")
    nn = load_pack(spark, base, "nn", split=None)
    # base features + calendar (lags / rolling columns are window summaries already)
    feats = [c for c in pack_columns(nn) if "__lag" not in c and "__roll" not in c]
    naive = naive_class_scores(nn, horizons)
    windows = (nn, feats, "target_cls", seq_len, horizons, ["entity_id", "split"], "ts", block_hours)
    summary, names = M.window_summary_frame(*windows)
    clf = M.fit_status_classifier(spark, summary, names, horizons, save_to=f"{out.rstrip('/')}/models", blocks=M.window_blocks(*windows))
    cols = ["model", "horizon_h", "accuracy", "precision_macro", "recall_macro", "f1_macro", "precision_weighted",
            "recall_weighted", "f1_weighted"]
    scores = naive.select(*cols).unionByName(clf.select(*cols)).persist()
    write_result_table(comparison_table(scores), f"{out.rstrip('/')}/model_comparison.csv", bom=True)
    write_results_json(scores, f"{out.rstrip('/')}/all_results")
    return {r["model"] + f"@{r['horizon_h']}h": r["accuracy"] for r in scores.collect()}


def main(argv=None) -> None:
    from sensorgrid.session import get_session
    ap = argparse.ArgumentParser(prog="sensorgrid.plans.jobs")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("prepare")
    p.add_argument("--csv", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--entity", default="station_1")
    p.add_argument("--entity-col", default=None)
    p.add_argument("--block-hours", type=int, default=None)
    r = sub.add_parser("regress")
    r.add_argument("--pack", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--models", nargs="+", choices=[*MODELS, "tuned"], default=list(MODELS))
    r.add_argument("--horizons", type=int, nargs="+", default=list(HORIZONS))
    c = sub.add_parser("classify")
    c.add_argument("--pack", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--seq-len", type=int, default=24)
    c.add_argument("--block-hours", type=int, default=None)
    for s in (p, r, c):
        s.add_argument("--master", default=None)
    a = ap.parse_args(argv)
    spark = get_session(a.master)
    if a.cmd == "prepare":
        raw = raw_frame(spark, a.csv, a.entity, a.entity_col)
        print(prepare_job(spark, a.csv, a.out, prepare_config(raw, block_hours=a.block_hours), a.entity, a.entity_col))
    elif a.cmd == "regress":
        print(regression_job(spark, a.pack, a.out, horizons=tuple(a.horizons), models=tuple(a.models)))
    else:
        print(classification_job(spark, a.pack, a.out, a.seq_len, block_hours=a.block_hours))


if __name__ == "__main__":
    main()
