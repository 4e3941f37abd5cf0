"""Cleaning, grid, gap flag and forward fill on hand-built frames."""

import datetime as dt

from pyspark.sql import functions as F

from sensorgrid.operators import clean, grid
from tests.conftest import ts

SCHEMA = "entity_id string, ts timestamp_ntz, a double, b double"


def rows(df, *cols):
    return [tuple(r) for r in df.orderBy("entity_id", "ts").select(*cols).collect()]


def test_sentinel_to_null(mkdf):
    df = mkdf([("e", ts("2004-03-10 18:00"), -200.0, 1.0), ("e", ts("2004-03-10 19:00"), 2.0, float("nan"))], SCHEMA)
    out = rows(clean.sentinel_to_null(df, ["a", "b"]), "a", "b")
    assert out == [(None, 1.0), (2.0, None)]


def test_dedup_first_tie_break(mkdf):
    df = mkdf([("e", ts("2004-03-10 18:00"), 5.0, 2.0), ("e", ts("2004-03-10 18:00"), 3.0, 1.0),
               ("e", ts("2004-03-10 19:00"), 7.0, 9.0)], SCHEMA)
    out = rows(clean.dedup_first(df, ["entity_id", "ts"], ["b"]), "a", "b")
    assert out == [(3.0, 1.0), (7.0, 9.0)]


def test_missing_flags_and_median(mkdf):
    df = mkdf([("e", ts("2004-03-10 18:00"), 1.0, None), ("e", ts("2004-03-10 19:00"), None, None),
               ("e", ts("2004-03-10 20:00"), 4.0, None), ("e", ts("2004-03-10 21:00"), 10.0, None)], SCHEMA)
    f = clean.missing_flags(df, ["a", "b"])
    assert rows(f, "a__was_missing", "b__was_missing") == [(0, 1), (1, 1), (0, 1), (0, 1)]
    imp = clean.median_impute(f, ["a", "b"])
    # median of 1, 4, 10 = 4; all-NULL column stays NULL
    assert rows(imp, "a", "b") == [(1.0, None), (4.0, None), (4.0, None), (10.0, None)]


def test_median_is_linear_interpolated(mkdf):
    df = mkdf([("e", ts(f"2004-03-10 1{i}:00"), v, 0.0) for i, v in enumerate([1.0, 2.0, 4.0, 9.0, None])], SCHEMA)
    out = rows(clean.median_impute(df, ["a"]), "a")
    assert out[-1] == (3.0,)


def test_winsorize_iqr(mkdf):
    vals = [1.0, 2.0, 3.0, 4.0, 100.0, -100.0]
    df = mkdf([("e", ts(f"2004-03-10 1{i}:00"), v, 0.0) for i, v in enumerate(vals)], SCHEMA)
    # pandas quantile(.25/.75) of the six values: q1 = 1.25, q3 = 3.75, IQR = 2.5 -> [-6.25, 11.25]
    out = [r[0] for r in rows(clean.winsorize_iqr(df, ["a"]), "a")]
    assert out == [1.0, 2.0, 3.0, 4.0, 11.25, -6.25]


def test_standardize_zero_std(mkdf):
    df = mkdf([("e", ts("2004-03-10 18:00"), 1.0, 5.0), ("e", ts("2004-03-10 19:00"), 3.0, 5.0)], SCHEMA)
    out = rows(clean.standardize(df, ["a", "b"], by=None), "a", "b")
    # population std of (1, 3) = 1; constant column -> (x - mean) / 1 = 0
    assert out == [(-1.0, 0.0), (1.0, 0.0)]


def test_standardize_scope_train_only(mkdf):
    df = mkdf([("e", ts("2004-03-10 18:00"), 1.0, 0.0), ("e", ts("2004-03-10 19:00"), 3.0, 0.0),
               ("e", ts("2004-03-10 20:00"), 100.0, 1.0)], SCHEMA)
    out = rows(clean.standardize(df, ["a"], by=None, scope=F.col("b") == 0.0), "a")
    assert out == [(-1.0,), (1.0,), (98.0,)]


def test_grid_gap_and_ffill(mkdf):
    # 18:00, (19:00 missing), 20:00, an off-grid 20:30 row, 21:00
    df = mkdf([("e", ts("2004-03-10 18:00"), 1.0, 1.0), ("e", ts("2004-03-10 20:00"), None, 2.0),
               ("e", dt.datetime(2004, 3, 10, 20, 30), 9.0, 9.0), ("e", ts("2004-03-10 21:00"), 4.0, 3.0)], SCHEMA)
    f = clean.missing_flags(df, ["a"])
    g = grid.hourly_grid(f)
    assert [r[1].hour for r in rows(g, "entity_id", "ts")] == [18, 19, 20, 21]
    assert rows(g, "__gap") == [(0,), (1,), (0,), (0,)]
    assert rows(g, "a__was_missing") == [(0,), (0,), (1,), (0,)]
    filled = grid.forward_fill(g, ["a", "b"])
    assert rows(filled, "a", "b") == [(1.0, 1.0), (1.0, 1.0), (1.0, 2.0), (4.0, 3.0)]


def test_grid_off_grid_start(mkdf):
    # the grid starts at the first timestamp (18:30), so on-the-hour rows are off-grid
    df = mkdf([("e", dt.datetime(2004, 3, 10, 18, 30), 1.0, 1.0), ("e", ts("2004-03-10 19:00"), 5.0, 5.0),
               ("e", dt.datetime(2004, 3, 10, 20, 30), 2.0, 2.0)], SCHEMA)
    g = grid.hourly_grid(df)
    assert [(r[0].minute, r[1]) for r in rows(g, "ts", "a")] == [(30, 1.0), (30, None), (30, 2.0)]


def test_two_entities_interleaved(mkdf):
    from sensorgrid.operators import features as fx
    df = mkdf([("x", ts("2004-03-10 18:00"), 1.0, 0.0), ("y", ts("2004-03-10 18:00"), 100.0, 0.0),
               ("x", ts("2004-03-10 19:00"), 2.0, 0.0), ("y", ts("2004-03-10 19:00"), 200.0, 0.0)], SCHEMA)
    out = rows(fx.lag_features(df, ["a"], (1,)), "entity_id", "a__lag1")
    assert out == [("x", None), ("x", 1.0), ("y", None), ("y", 100.0)]


def test_approx_quantiles_option(mkdf):
    vals = [float(v) for v in range(1, 102)]  # median 51
    df = mkdf([("e", ts("2004-03-10 00:00"), v, 0.0) for v in vals] + [("e", ts("2004-03-11 00:00"), None, 0.0)],
              SCHEMA)
    exact = [r.a for r in clean.median_impute(df, ["a"]).where(F.col("b") == 0.0).collect()]
    approx = [r.a for r in clean.median_impute(df, ["a"], exact=False).collect()]
    assert 51.0 in exact and abs(sorted(approx)[-1] - 101.0) < 1e-9
    filled = [v for v in approx if v not in vals]
    assert filled == [] or all(abs(v - 51.0) <= 1.0 for v in filled)


def test_checked_broadcast_respects_bound(spark):
    from sensorgrid.operators.common import checked_broadcast
    small = spark.createDataFrame([(i,) for i in range(3)], "k int")
    hinted = checked_broadcast(small, max_rows=10)
    plain = checked_broadcast(small, max_rows=1)
    assert "broadcast" in hinted._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in plain._jdf.queryExecution().logical().toString().lower()


def test_partitions_follow_the_rows_of_the_grid(spark, monkeypatch):
    """Few readings far apart make many grid rows: the supplier series are dealt by those, once."""
    from pyspark.sql import functions as F
    from sensorgrid.operators import grid
    from sensorgrid.plans import registry
    from sensorgrid.sources import testdata as td
    lines = spark.range(400).select((F.col("id") % 40).alias("l_suppkey"), (F.col("id") % 7).cast("double").alias("l_quantity"), F.lit(1.0).alias("l_extendedprice"),
                                    F.expr("timestamp'1995-01-01' + make_interval(0, 0, 0, cast(floor(id / 40) * 100 as int))").alias("l_shipdate"))
    assert grid.grid_partitions(td.supplier_days(lines), step_hours=24) == 1
    assert grid.grid_partitions(td.supplier_days(lines).where("false"), step_hours=24) == 1
    monkeypatch.setattr(grid, "GRID_ROWS_PER_PARTITION", 1000)
    assert grid.grid_partitions(td.supplier_days(lines), step_hours=24) == 37  # 40 series of 901 days
    monkeypatch.setattr(td, "read_table", lambda *_: lines)
    got = registry.supplier_series(spark, "")
    assert got.count() == 40 * 901
    rows = got.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in rows) <= 5 * 901  # a few series each, where one partition held them all
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
