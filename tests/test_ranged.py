"""Quantiles, positions and block-wise windows that never hold a whole series in one task."""

import random

import pytest
from pyspark.sql import functions as F

from sensorgrid.functions.exprs import argmax_class
from sensorgrid.operators import blocked as bk
from sensorgrid.operators import clean, features as fx, leaderboard, metrics, positions, quantiles, splits, targets
from sensorgrid.plans import registry

SF = "/root/testdata/sf0.001"


def same(a, b):
    cols = a.columns
    order = lambda df: sorted(([None if x != x else x for x in r] for r in df.select(*cols).collect()), key=repr)
    assert order(a) == order(b)


@pytest.fixture(scope="module")
def irregular(spark):
    """Series of any spacing; one holds nearly all rows, values tie."""
    r = random.Random(2)
    rows = [("hot", t, float(r.choice([1, 1, 1, 2, 5, 9])), None if r.random() < .2 else r.random()) for t in r.sample(range(10 ** 6), 3000)]
    rows += [(k, t, r.random(), None) for k in ("a", "b") for t in r.sample(range(50), 7)] + [("one", 3, 4.0, float("nan"))]
    df = spark.createDataFrame(rows, "entity_id string, s long, x double, y double")
    return df.select("entity_id", F.timestamp_seconds(F.col("s") * 977).cast("timestamp_ntz").alias("ts"), "x", "y").repartition(5)


def test_exact_quantiles_equal_percentile(irregular):
    probs = (0.0, 0.25, 0.5, 0.9, 1.0)
    arr = F.array(*[F.lit(p) for p in probs])
    known = F.nanvl("y", F.lit(None))
    want = irregular.groupBy("entity_id").agg(F.percentile("x", arr).alias("__q0"), F.percentile(known, arr).alias("__q1"))
    got = {r[0]: r for r in quantiles.exact_quantiles(irregular, ["x", "y"], probs, "entity_id").collect()}
    for r in want.collect():
        assert got[r[0]][1] == pytest.approx(r[1])
        assert got[r[0]][2] == pytest.approx(r[2]) if r[2] else set(got[r[0]][2]) == {None}
    everything = quantiles.exact_quantiles(irregular, "x", probs, scope=F.col("entity_id") == "hot").first()
    assert everything[0] == pytest.approx(got["hot"][1])


def test_quantiles_with_null_groups_and_empty_tables(spark, irregular):
    df = spark.createDataFrame([(None, 1.0), (None, 2.0), ("a", None)], "k string, v double")
    got = {r.k: r["__q0"] for r in quantiles.with_quantiles(df, "v", (0.5,), "k").collect()}
    assert got == {None: [1.5], "a": None}
    assert quantiles.exact_quantiles(irregular.limit(0), "x", (0.5,), "entity_id").count() == 0
    assert quantiles.exact_quantiles(irregular.limit(0), "x", (0.5,)).first()[0] == [None]
    assert metrics.column_profile(irregular.limit(0), ["x"]).first()["p50"] is None


def test_ranked_statistics_equal_windowed_ones(irregular):
    y = F.nanvl("y", F.lit(None)).alias("y")
    df = irregular.select("entity_id", "ts", "x", y)
    for fn in (clean.median_impute, clean.winsorize_iqr):
        same(fn(df, ["x", "y"], exact="ranks"), fn(df, ["x", "y"]))
        same(fn(df, ["x"], by=None, exact="ranks"), fn(df, ["x"], by=None))


def test_no_percentile_and_no_series_window_in_the_plans(irregular):
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for df in (clean.winsorize_iqr(irregular, ["x"], exact="ranks"), metrics.column_profile(irregular, ["x"]), metrics.residual_quantiles(irregular, "x", "y")):
        assert "percentile" not in plan(df)
    for df in (splits.ratio_split(irregular, ranged=True), splits.timeseries_folds(irregular, ranged=True), fx.warmup_trim(irregular, 2, ranged=True)):
        # the only window runs over the table of parts
        assert "row_number" not in plan(df) and all("__rows" in x or "__part" in x for x in plan(df).splitlines() if "Window [" in x)


@pytest.mark.parametrize("n", [1, 7])
def test_positions_and_successors(spark, tmp_path, n):
    rows = [(i * 37 % 101, str(i)) for i in range(101)]
    df = spark.createDataFrame(rows, "a long, b string").repartition(n)
    o = positions.ordered_positions(df, [F.col("a").desc()], str(tmp_path / "o"))
    assert {r.a: r.position for r in positions.global_positions(o).collect()} == {a: 100 - a for a, _ in rows}
    names = dict(rows)
    for circular in (False, True):
        got = {r.a: (r.next_a, r.next_b) for r in positions.successors(o, ["a", "b"], circular=circular).collect()}
        assert got == {a: (a - 1, names[a - 1]) if a else (100, names[100]) if circular else (None, None) for a in names}


def test_ranged_splits_equal_windowed_ones(irregular):
    df = irregular.select("entity_id", "ts")
    for op in (lambda **k: splits.ratio_split(df, **k), lambda **k: splits.timeseries_folds(df, 3, **k), lambda **k: fx.warmup_trim(df, 5, **k),
               lambda **k: splits.chrono_split(df, (1971, 1975), (1976,), **k), lambda **k: splits.chrono_split(df, test_start="1980-01-01 00:00:00", **k)):
        same(op(ranged=True), op())


@pytest.mark.parametrize("hours", [1, 6, 72])
def test_blockwise_equals_whole_series(spark, hours):
    """Halos of 24 hours reach over several blocks."""
    c = splits.chrono_split(registry.cleaned(spark, SF), test_start=registry.TEST_START).checkpoint()
    both = ["entity_id", "split"]
    for op, before, after, key in (
            (lambda x, k: targets.multi_horizon_targets(x, ["v_mean", "v_max"], key=k), 0, 24, "entity_id"),
            (lambda x, k: targets.next_class_target(x, "n_events", key=k), 0, 1, "entity_id"),
            (lambda x, k: fx.rolling_error(targets.persistence_forecast(x, "v_mean", key=k), "y_true", "y_pred", 24, key=[*k, "horizon_h"]), 23, 24, "entity_id"),
            (lambda x, k: fx.sequence_windows_horizon(x, ["v_mean"], "v_max", 24, 6, key=k), 23, 6, both)):
        plain = op(c, [key] if isinstance(key, str) else key)
        got = bk.blockwise(c, op, hours, before, after, key=key)
        assert sorted(got.columns) == sorted(plain.columns)
        rounded = lambda df: registry.finish(df) if "seq" not in df.columns else df
        same(rounded(got.select(*plain.columns)), rounded(plain))


def test_argmax_class(spark):
    df = spark.createDataFrame([(1, [0.1, 0.7, 0.2]), (2, [0.5, 0.5, 0.0]), (3, [None, -2.0, -1.0]), (4, [float("nan"), 0.0]), (5, [None, None]), (6, None), (7, [])], "i int, s array<double>")
    assert {r.i: r.c for r in df.select("i", argmax_class("s").alias("c")).collect()} == {1: 1, 2: 0, 3: 2, 4: 1, 5: None, 6: None, 7: None}


def test_first_values_skip_nulls_per_column(spark):
    df = spark.createDataFrame([("a", 1, .9, None, float("nan")), ("a", 2, .8, 5.0, None), ("a", 3, .7, 6.0, 7.0), ("b", 1, None, None, 1.0)], "k string, i int, r double, m double, n double")
    got = leaderboard.first_values_per_group(df, "k", [("r", "desc"), ("i", "asc")])
    assert {r.k: (r.i, r.r, r.m, r.n) for r in got.collect()} == {"a": (1, .9, 5.0, 7.0), "b": (1, None, None, 1.0)}
