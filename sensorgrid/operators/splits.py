"""Chronological splits and time-ordered folds, as columns (never index lists).

Positions inside a series come from ``row_number``/``count`` over windows partitioned by the
series key, so a split never needs a global sort. With ``ranged=True`` they come from range
partitions of each series, with counts added up between them: for series too long for one
task, at any spacing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.operators.common import as_list, bounded_broadcast, group_window, q, series_window
from sensorgrid.operators.positions import series_positions
from sensorgrid.session import scratch_path

POS, N = "__pos", "__n"


def with_positions(df: DataFrame, key="entity_id", ts="ts", ranged: bool = False, first=()) -> DataFrame:
    """``df`` with the 0-based place ``__pos`` of each row in its series and the series' size
    ``__n``. ``first``: columns (0 or 1) that order before ``ts``."""
    keys, order = as_list(key), [*first, q(ts)]
    if ranged:
        return series_positions(df, keys, order, scratch_path(df.sparkSession, "positions"))
    w = Window.partitionBy(*[q(k) for k in keys])
    return df.select("*", (F.row_number().over(w.orderBy(*order)) - 1).cast("bigint").alias(POS), F.count(F.lit(1)).over(w).alias(N))


VAL_FRACTION = 0.20  # fixed value: last 20 % of the fit year is validation


def chrono_split(df: DataFrame, fit_years=None, test_years=None, val_fraction: float = VAL_FRACTION,
                 key="entity_id", ts="ts", out: str = "split", test_start=None, ranged: bool = False) -> DataFrame:
    """``split`` = train / val inside the fit period, test in the test period, NULL elsewhere.

    Fit period = ``fit_years`` (or ts < ``test_start``); the first
    int((1 - v) * n_fit) fit rows of each series are train, the rest val.
    Test period = ``test_years`` (or ts >= ``test_start``). The position among
    fit rows is a running count on the same ordered window the features use,
    so the split adds no sort of its own.
    """
    t = q(ts)
    if test_start is not None:
        bound = F.lit(test_start).cast("timestamp_ntz")
        fit, test = t < bound, t >= bound
    else:
        yr = F.year(t)
        fit, test = yr.isin(list(fit_years)), yr.isin(list(test_years))
    if ranged:  # the fit rows of a series first: their places are their running count
        n_fit = df.groupBy(*[q(k) for k in as_list(key)]).agg(F.count_if(fit).alias("__n_fit"))
        rows = with_positions(df, key, ts, True, [F.coalesce(fit, F.lit(False)).cast("int").desc()])
        rows = rows.join(bounded_broadcast(n_fit), as_list(key))
        cut = F.floor(F.lit(1.0 - val_fraction) * F.col("__n_fit"))
        split = F.when(fit & (F.col(POS) < cut), F.lit("train")).when(fit, F.lit("val")).when(test, F.lit("test"))
        return rows.select(*[q(c) for c in df.columns], split.alias(out))
    fit_i = fit.cast("int")
    pos = F.sum(fit_i).over(series_window(key, ts).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    n = F.sum(fit_i).over(group_window(key))
    cut = F.floor(F.lit(1.0 - val_fraction) * n)
    split = (F.when(fit & (pos <= cut), F.lit("train"))
              .when(fit, F.lit("val"))
              .when(test, F.lit("test")))
    return df.select("*", split.alias(out))


def purge_boundary(df: DataFrame, horizon: int, key="entity_id", ts="ts", split_col: str = "split") -> DataFrame:
    """Without the rows whose target, ``horizon`` rows later, lies in another split: a label
    of the training rows is then never a value of the validation or test period."""
    ahead = F.lead(q(split_col), horizon).over(series_window(key, ts))
    return df.select("*", ahead.alias("__ahead")).where(F.col("__ahead").isNull() | F.col("__ahead").eqNullSafe(q(split_col))).drop("__ahead")


def ratio_split(df: DataFrame, train: float = 0.70, val: float = 0.15, key="entity_id", ts="ts",
                out: str = "split", ranged: bool = False) -> DataFrame:
    """First floor(train*n) rows train, next floor(val*n) val, rest test (per series)."""
    rows = with_positions(df, key, ts, ranged)
    rn, n = F.col(POS) + 1, F.col(N)
    n_tr = F.floor(F.lit(train) * n)
    n_va = F.floor(F.lit(val) * n)
    split = (F.when(rn <= n_tr, F.lit("train")).when(rn <= n_tr + n_va, F.lit("val"))
              .otherwise(F.lit("test")))
    return rows.select(*[q(c) for c in df.columns], split.alias(out))


def predefined_fold(df: DataFrame, split_col: str = "split") -> DataFrame:
    """Single predefined fold: fit on train, score on val, refit on train + val.

    Adds ``role`` (fit / validate / holdout) and ``in_refit`` (train or val).
    """
    s = q(split_col)
    role = (F.when(s == "train", F.lit("fit")).when(s == "val", F.lit("validate"))
             .when(s == "test", F.lit("holdout")))
    return df.select("*", role.alias("role"), s.isin("train", "val").alias("in_refit"))


def timeseries_folds(df: DataFrame, n_splits: int = 3, key="entity_id", ts="ts", ranged: bool = False) -> DataFrame:
    """Expanding-window folds (``TimeSeriesSplit``): one row per (row, fold) it takes part in.

    test size = n // (n_splits + 1); fold i tests rows
    [n - (n_splits - i) * size, ... + size) and trains on every earlier row.
    Output adds ``fold`` (0-based) and ``role`` (train / test).
    """
    base = with_positions(df, key, ts, ranged)
    size = F.floor(F.col("__n") / F.lit(n_splits + 1))
    start = F.col("__n") - (F.lit(n_splits) - F.col("fold")) * size
    folds = base.select("*", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))).alias("fold"))
    role = (F.when(F.col("__pos") < start, F.lit("train"))
             .when(F.col("__pos") < start + size, F.lit("test")))
    keep = folds.where(role.isNotNull() & (size > 0))
    return keep.select(*[q(c) for c in df.columns], F.col("fold"), role.alias("role"))


def split_semi_join(df: DataFrame, ids: DataFrame, on) -> DataFrame:
    """Rows of ``df`` whose key appears in ``ids`` (no duplication, no columns added)."""
    return df.join(ids, on=as_list(on), how="left_semi")

