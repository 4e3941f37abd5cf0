"""Window features, targets, splits and folds."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sensorgrid.functions.exprs import threshold_class
from sensorgrid.operators import features as fx
from sensorgrid.operators import splits, targets
from tests.conftest import ts

SCHEMA = "entity_id string, ts timestamp_ntz, a double"


def series(mkdf, vals, entity="e", start="2004-03-10 00:00"):
    t0 = ts(start)
    return mkdf([(entity, t0 + pd.Timedelta(hours=i), v) for i, v in enumerate(vals)], SCHEMA)


def col(df, c):
    return [r[0] for r in df.orderBy("entity_id", "ts").select(c).collect()]


def test_rolling_matches_pandas(mkdf):
    vals = [1.0, None, 3.0, 4.0, None, None, 7.0, 8.0, 2.0, 5.0, None, 1.0, 3.0]
    df = series(mkdf, vals)
    out = fx.rolling_std(fx.rolling_mean(df, ["a"], (3, 6)), ["a"], (3, 6))
    s = pd.Series(vals, dtype="float64")
    for W in (3, 6):
        exp_m = s.rolling(W, min_periods=max(2, W // 2)).mean()
        exp_s = s.rolling(W, min_periods=max(2, W // 2)).std()
        got_m, got_s = col(out, f"a__roll_mean{W}"), col(out, f"a__roll_std{W}")
        for g, e in zip(got_m, exp_m):
            assert (g is None and pd.isna(e)) or abs(g - e) < 1e-12
        for g, e in zip(got_s, exp_s):
            assert (g is None and pd.isna(e)) or abs(g - e) < 1e-9


def test_lags_and_warmup(mkdf):
    df = series(mkdf, [float(i) for i in range(30)])
    out = fx.warmup_trim(fx.lag_features(df, ["a"], (1, 24)))
    assert col(out, "a") == [float(i) for i in range(24, 30)]
    assert col(out, "a__lag24") == [float(i) for i in range(0, 6)]


def test_calendar(mkdf):
    df = series(mkdf, [1.0, 2.0], start="2004-03-13 23:00")  # Saturday 23:00, Sunday 00:00
    out = fx.calendar_features(df, gap_col=None).orderBy("ts").select("hour", "dow", "month", "is_weekend").collect()
    assert [tuple(r) for r in out] == [(23, 5, 3, 1), (0, 6, 3, 1)]


def test_thresholds_boundaries(spark):
    df = spark.createDataFrame([(1.5,), (1.5000001,), (2.5,), (2.6,), (None,), (0.0,)], "x double")
    got = [r[0] for r in df.select(threshold_class("x")).collect()]
    assert got == [0, 1, 1, 2, None, 0]


def test_next_class_target(mkdf):
    df = series(mkdf, [1.0, 2.0, 3.0, None])
    out = targets.next_class_target(df, "a")
    assert col(out, "target_reg") == [2.0, 3.0, None, None]
    assert col(out, "target_cls") == [1, 2, None, None]


def test_multi_horizon_and_persistence(mkdf):
    df = series(mkdf, [1.0, 2.0, 3.0, 4.0])
    mh = targets.multi_horizon_targets(df, ["a"], (1, 2))
    got = sorted((r.horizon_h, r.ts.hour, r.y) for r in mh.collect())
    assert got == [(1, 0, 2.0), (1, 1, 3.0), (1, 2, 4.0), (2, 0, 3.0), (2, 1, 4.0)]
    p = targets.persistence_forecast(df, "a", (2,))
    assert sorted((r.y_true, r.y_pred) for r in p.collect()) == [(3.0, 1.0), (4.0, 2.0)]


def test_sequence_windows(mkdf):
    df = series(mkdf, [1.0, 2.0, None, 4.0, 5.0, 6.0])
    df = df.withColumn("y", F.col("a") * 10)
    out = fx.sequence_windows(df, ["a"], "y", 2).orderBy("ts").collect()
    # windows ending at rows 1 (1,2), 4 (4,5), 5 (5,6); windows touching the NULL are dropped
    assert [(r.seq, r.y) for r in out] == [([[1.0], [2.0]], 20.0), ([[4.0], [5.0]], 50.0), ([[5.0], [6.0]], 60.0)]


def test_sequence_windows_horizon(mkdf):
    df = series(mkdf, [1.0, 2.0, 3.0, 4.0, 5.0])
    out = fx.sequence_windows_horizon(df, ["a"], "a", 2, horizon=2).orderBy("ts").collect()
    # X[i:i+2] labelled with y[i+2+2-1]: windows (1,2)->4, (2,3)->5
    assert [(r.seq, r.y) for r in out] == [([[1.0], [2.0]], 4.0), ([[2.0], [3.0]], 5.0)]


def test_chrono_split_years(mkdf):
    rows = [("e", ts("2004-01-01 00:00") + pd.Timedelta(days=i), 1.0) for i in range(10)]
    rows += [("e", ts("2005-01-01 00:00") + pd.Timedelta(days=i), 1.0) for i in range(3)]
    df = mkdf(rows, SCHEMA)
    out = col(splits.chrono_split(df, (2004,), (2005,)), "split")
    assert out == ["train"] * 8 + ["val"] * 2 + ["test"] * 3


def test_timeseries_folds_seven_rows(mkdf):
    df = series(mkdf, [float(i) for i in range(7)])
    f = splits.timeseries_folds(df, 3).collect()
    got = {}
    for r in f:
        got.setdefault((r.fold, r.role), []).append(int(r.a))
    for k in got:
        got[k].sort()
    assert got == {(0, "train"): [0, 1, 2, 3], (0, "test"): [4], (1, "train"): [0, 1, 2, 3, 4], (1, "test"): [5],
                   (2, "train"): [0, 1, 2, 3, 4, 5], (2, "test"): [6]}



def test_ratio_split(mkdf):
    df = series(mkdf, [float(i) for i in range(20)])
    out = col(splits.ratio_split(df), "split")
    assert out == ["train"] * 14 + ["val"] * 3 + ["test"] * 3


@pytest.mark.parametrize("fmt_ok", [True])
def test_parse_two_formats(spark, fmt_ok):
    from sensorgrid.functions.exprs import parse_two_formats
    df = spark.createDataFrame([("10/03/2004", "18.00.00"), ("10/03/2004", "19:00:00"), ("31/02/2004", "18.00.00"),
                                (None, "18.00.00"), ("1/4/2005", "7.05.00")], "d string, t string")
    got = [r[0] for r in df.select(parse_two_formats("d", "t")).collect()]
    assert got[0] == ts("2004-03-10 18:00") and got[1] == ts("2004-03-10 19:00")
    assert got[2] is None and got[3] is None
    assert got[4] == ts("2005-04-01 07:05")
