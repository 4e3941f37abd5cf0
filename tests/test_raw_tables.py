"""Rules that ordinary raw tables break: grids off the hour, duplicates, NaN and text scores, dead sensors."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from sensorgrid.functions.columns import pick_target_column
from sensorgrid.operators import blocked as bk
from sensorgrid.operators import clean, grid, metrics, splits, targets
from sensorgrid.operators import features as fx
from sensorgrid.operators import leaderboard as lb
from sensorgrid.operators import models as M
from sensorgrid.plans.prepare import PrepareConfig, feature_pack, prepare
from sensorgrid.sources.results import read_result_tables, write_result_table

DAY = dt.datetime(2004, 3, 10)


def at(hhmm: str, day: int = 0) -> dt.datetime:
    h, m = hhmm.split(":")
    return DAY + dt.timedelta(days=day, hours=int(h), minutes=int(m))


@pytest.mark.parametrize("times, want", [
    (["00:00", "01:00", "03:30"], ["00:00", "01:00", "02:00", "03:00"]),
    (["18:30", "20:00"], ["18:30", "19:30"]),
    (["05:00"], ["05:00"]), (["05:00", "05:10"], ["05:00"]), (["05:10", "06:09"], ["05:10"]), (["05:10", "07:10"], ["05:10", "06:10", "07:10"]),
])
def test_grid_ends_at_the_last_whole_step(spark, times, want):
    df = spark.createDataFrame([("a", at(t), 1.0) for t in times], "entity_id string, ts timestamp_ntz, v double")
    plain = sorted(r.ts for r in grid.hourly_grid(df).collect())
    assert plain == [at(t) for t in want]
    for hours in (1, 3, 24):
        assert sorted(r.ts for r in bk.hourly_grid_blocked(df, hours).collect()) == plain


def test_prepare_drops_duplicates_and_prefers_readings(spark):
    rows = [("s", at("00:00") + dt.timedelta(hours=i), float(i), 5.0) for i in range(30)]
    rows += [("s", at("00:00"), None, 5.0), ("s", at("03:00"), None, None), ("s", at("04:00"), 1.0, 5.0)]
    df = spark.createDataFrame(rows, "entity_id string, ts timestamp_ntz, a double, b double")
    for hours in (None, 24):
        c, _ = prepare(df, PrepareConfig(sensors=["a", "b"], target="a", features=["a"], block_hours=hours))
        got = {r.ts: r for r in c.collect()}
        assert c.count() == len(got) == 30
        assert got[at("03:00")]["a__was_missing"] == 0 and got[at("00:00")]["a__was_missing"] == 0 and got[at("04:00")].a == 1.0


def test_dedup_orders_null_last(spark):
    df = spark.createDataFrame([("s", at("00:00"), None, 5.0), ("s", at("00:00"), 2.0, 5.0)], "entity_id string, ts timestamp_ntz, a double, b double")
    assert clean.dedup_first(df, order_by=["a", "b"]).first().a == 2.0


TEXT = [("bad", "CO(GT)", "6.0", "NaN", "1", "1", "1"), ("good", "CO(GT)", "6h", "0.5", "2", "2", "2"), ("good", "CO(GT)", "6", "0.5", "2", "2", "2"),
        ("worse", "CO(GT)", "6", "0.1", "NaN", "x", ""), ("odd", "CO(GT)", "six", "0.9", "1", "1", "1")]


def text_scores(spark):
    return spark.createDataFrame(TEXT, "model string, pollutant string, horizon string, R2 string, RMSE string, MAE string, MAPE string")


def test_text_scores(spark):
    n = lb.normalize_scores(text_scores(spark)).cache()
    assert [r.horizon_h for r in n.collect()] == [6, 6, 6, 6, None]
    assert n.where("isnan(R2) or isnan(RMSE)").count() == 0
    one = lb.drop_exact_duplicates(n)
    assert one.count() == 4
    one = one.where("horizon_h = 6").withColumn("run_id", F.lit(1))
    assert lb.overall_winners(one).first().model == "good"
    assert [r.model for r in lb.top_k_per_cell(one, 2).orderBy("rank").collect()] == ["good", "worse"]


def test_nan_is_never_first(spark):
    rows = [("nan", "p", 1, float("nan"), 1.0, 1.0, 1.0, 1), ("null", "p", 1, None, 1.0, 1.0, 1.0, 2), ("low", "p", 1, -3.0, 1.0, 1.0, 1.0, 3)]
    df = spark.createDataFrame(rows, "model string, pollutant string, horizon_h int, R2 double, RMSE double, MAE double, `MAPE(%)` double, run_id long")
    assert lb.top_k_models(df, 1).first().model == "low"
    assert lb.leaderboard_sort(df).first().model == "low"
    assert lb.overall_winners(df).first().model == "low"
    assert lb.top3_by_pollutant(df).where("rank = 1").first().model == "low"
    assert lb.avg_by_pollutant(df).first().R2_mean == -3.0
    assert [r.k for r in clean.coerce_numeric(spark.createDataFrame([("NaN",), ("2",), ("x",)], "k string"), ["k"]).collect()] == [None, 2.0, None]


def test_result_tables_without_a_column(spark, tmp_path):
    folder = str(tmp_path / "results")
    write_result_table(text_scores(spark), f"{folder}/a.csv")
    write_result_table(text_scores(spark).drop("RMSE").withColumn("model", F.lit("no_rmse")), f"{folder}/b.csv")
    both = read_result_tables(spark, folder)
    assert {r.model for r in both.collect()} >= {"no_rmse", "good"} and both.where("model = 'no_rmse' and RMSE is not null").count() == 0
    assert both.where("horizon_h = 6").count() == both.count() > 0
    assert "no_rmse" not in {r.model for r in read_result_tables(spark, folder, missing="skip").collect()}


def test_target_rule():
    assert pick_target_column(["T", "co_x", "CO(GT)", "CO(GT)2"]) == "CO(GT)"
    assert pick_target_column(["T", "xCOx"]) == "xCOx" and pick_target_column(["T", "RH"]) == "T"
    assert pick_target_column(["s", "T"], numeric=["T"]) == "T" and pick_target_column([]) is None


def feed(spark, dead=False, n=200):
    rows = [(e, at("00:00") + dt.timedelta(hours=i), float((i * 7 + k) % 23) + (i % 24) / 5, None if dead and e == "b" else float(i % 11))
            for k, e in enumerate(("a", "b")) for i in range(n)]
    return spark.createDataFrame(rows, "entity_id string, ts timestamp_ntz, x double, y double")


CFG = PrepareConfig(sensors=["x", "y"], target="x", features=["x", "y"], fit_years=(), test_years=(), test_start="2004-03-16 00:00:00")


def test_dead_sensor_raises(spark):
    from sensorgrid.plans.regression import task_frame
    c, _ = prepare(feed(spark, dead=True), CFG)
    with pytest.raises(ValueError, match="b: y in"):
        task_frame(c, CFG, [("x", 1)])


def test_forest_does_not_depend_on_the_cores(spark):
    """The frame's rows and partitions follow the session's settings, not how its input is spread."""
    p = feature_pack(prepare(feed(spark), CFG)[0], CFG, label_tasks=[("x", 1)]).cache()
    rmse = []
    for spread in (1, 4, 8):
        tf = M.build_task_frame(p.repartition(spread), ["x", "y", "x__lag1", "x__lag24"], [("x", 1)], partitions=4)
        row, _ = M.fit_tree_task(tf, "x", 1, "RandomForest", {"n_estimators": 5, "max_depth": 5})
        rmse.append(row[3])
    assert rmse[0] == rmse[1] == rmse[2]


def test_windows_and_labels_stay_in_their_split(spark):
    c = splits.chrono_split(feed(spark).where("entity_id = 'a'"), test_start="2004-03-16 00:00:00")
    inside = fx.sequence_windows(targets.next_value_target(c, "x", key=["entity_id", "split"]), ["x"], "target_reg", 24, key=["entity_id", "split"])
    sizes = {r.split: r["count"] for r in c.groupBy("split").count().collect()}
    got = {r.split: r["count"] for r in inside.groupBy("split").count().collect()}
    assert got == {s: n - 23 - 1 for s, n in sizes.items()}
    summary, names = M.window_summary_frame(c.withColumn("cls", (F.col("x") > 10).cast("int")), ["x"], "cls", 24, (1, 6), key=["entity_id", "split"])
    assert summary.where("cls__h6 is not null").count() == sum(n - 23 - 6 for n in sizes.values())


def test_purge_boundary(spark):
    c = splits.chrono_split(feed(spark).where("entity_id = 'a'"), test_start="2004-03-16 00:00:00")
    p = splits.purge_boundary(c, 6)
    before = {r.split: r["count"] for r in c.groupBy("split").count().collect()}
    after = {r.split: r["count"] for r in p.groupBy("split").count().collect()}
    assert after == {"train": before["train"] - 6, "val": before["val"] - 6, "test": before["test"]}


def test_aligned_xy_equals_one_pass(spark):
    c = prepare(feed(spark), CFG)[0].cache()
    p = feature_pack(c, CFG, label_tasks=[("x", 6)])
    one = p.where("split = 'train' and y__x__h6 is not null").select("entity_id", "ts", F.col("y__x__h6").alias("y"))
    keyed = targets.aligned_xy(p.select("entity_id", "ts", "split", "x"), targets.multi_horizon_targets(c, ["x"]), "x", 6, split="train").select("entity_id", "ts", "y")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, keyed.collect()))


def test_confusion_and_distribution_by_group(spark):
    df = spark.createDataFrame([("g", 0, 1), ("g", 2, 2), ("g", None, 1), ("h", 1, 1)], "k string, y_true int, y_pred int")
    got = {(r.k, r.y_true): (r.pred_0, r.pred_1, r.pred_2) for r in metrics.confusion_matrix(df, by="k").collect()}
    assert got == {("g", 0): (0, 1, 0), ("g", 1): (0, 0, 0), ("g", 2): (0, 0, 1), ("h", 0): (0, 0, 0), ("h", 1): (0, 1, 0), ("h", 2): (0, 0, 0)}
    dist = {(r.k, r.cls): r.n for r in metrics.class_distribution(df, "y_true", "k").collect()}
    assert dist == {("g", 0): 1, ("g", 1): 0, ("g", 2): 1, ("h", 0): 0, ("h", 1): 1, ("h", 2): 0}
