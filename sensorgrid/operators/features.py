"""Window features over one hourly series.

All expressions of one call are placed in one ``select``; Spark groups window
expressions that share ``partitionBy(key).orderBy(ts)`` into one WindowExec
(one sort), regardless of the frame widths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.functions.exprs import weekday_mon0
from sensorgrid.operators import splits
from sensorgrid.operators.common import as_list, q, series_window
from sensorgrid.operators.grid import GAP_COL

# The reference's lag set and rolling widths (hours).
LAGS = (1, 2, 3, 6, 12, 24)
ROLLS = (3, 6, 12, 24)


def min_periods(width: int) -> int:
    """Rolling frames need max(2, width // 2) non-NULL values."""
    return max(2, width // 2)


def lag_exprs(columns, lags=LAGS, key="entity_id", ts="ts") -> list[Column]:
    w = series_window(key, ts)
    return [F.lag(q(c), L).over(w).alias(f"{c}__lag{L}") for c in as_list(columns) for L in lags]


def _rolling(c: str, width: int, fn, key, ts) -> Column:
    w = series_window(key, ts).rowsBetween(-(width - 1), Window.currentRow)
    return F.when(F.count(q(c)).over(w) >= min_periods(width), fn(q(c)).over(w))


def rolling_mean_exprs(columns, widths=ROLLS, key="entity_id", ts="ts") -> list[Column]:
    return [_rolling(c, W, F.avg, key, ts).alias(f"{c}__roll_mean{W}")
            for c in as_list(columns) for W in widths]


def rolling_std_exprs(columns, widths=ROLLS, key="entity_id", ts="ts") -> list[Column]:
    return [_rolling(c, W, F.stddev_samp, key, ts).alias(f"{c}__roll_std{W}")
            for c in as_list(columns) for W in widths]


def lag_features(df: DataFrame, columns, lags=LAGS, key="entity_id", ts="ts") -> DataFrame:
    """``<c>__lag<L>`` = value L rows earlier in the series (NULL before the start)."""
    return df.select("*", *lag_exprs(columns, lags, key, ts))


def rolling_mean(df: DataFrame, columns, widths=ROLLS, key="entity_id", ts="ts") -> DataFrame:
    """Trailing mean over ``W`` rows incl. current, NULL below min_periods non-NULLs."""
    return df.select("*", *rolling_mean_exprs(columns, widths, key, ts))


def rolling_std(df: DataFrame, columns, widths=ROLLS, key="entity_id", ts="ts") -> DataFrame:
    """Trailing sample std (ddof 1) over the same frames as ``rolling_mean``."""
    return df.select("*", *rolling_std_exprs(columns, widths, key, ts))


def calendar_exprs(ts="ts", gap_col: str | None = GAP_COL) -> list[Column]:
    t = q(ts)
    out = [F.hour(t).alias("hour"), weekday_mon0(t).alias("dow"), F.month(t).alias("month"),
           (weekday_mon0(t) >= 5).cast("tinyint").alias("is_weekend")]
    if gap_col:
        out.append(F.coalesce(q(gap_col), F.lit(0)).cast("tinyint").alias("gap_flag"))
    return out


def calendar_features(df: DataFrame, ts="ts", gap_col: str | None = GAP_COL) -> DataFrame:
    """hour, dow (Mon=0), month, is_weekend, gap_flag."""
    return df.select("*", *calendar_exprs(ts, gap_col))


def warmup_trim(df: DataFrame, warmup: int = max(LAGS), key="entity_id", ts="ts", ranged: bool = False) -> DataFrame:
    """Drop the first ``warmup`` rows of every series; ``ranged`` as in ``operators/splits.py``."""
    if ranged:
        return splits.with_positions(df, key, ts, True).where(F.col(splits.POS) >= warmup).select(*[q(c) for c in df.columns])
    rn = F.row_number().over(series_window(key, ts))
    return df.select("*", rn.alias("__rn")).where(F.col("__rn") > warmup).drop("__rn")


def rolling_error(df: DataFrame, y: str, pred: str, width: int = 24, key="entity_id", ts="ts") -> DataFrame:
    """Trailing RMSE / MAE of (y - pred) over ``width`` rows (pairs with NULLs skipped)."""
    w = series_window(key, ts).rowsBetween(-(width - 1), Window.currentRow)
    err = F.when(q(y).isNotNull() & q(pred).isNotNull(), q(y) - q(pred))
    return df.select("*", F.sqrt(F.avg(err * err).over(w)).alias(f"rolling_rmse{width}"),
                     F.avg(F.abs(err)).over(w).alias(f"rolling_mae{width}"))


def _frame_windows(df: DataFrame, features, label: Column, seq_len: int, key, ts, label_name: str,
                   places: int | None) -> DataFrame:
    feats = as_list(features)
    w = series_window(key, ts).rowsBetween(-(seq_len - 1), Window.currentRow)
    vec = F.array(*[q(c).cast("double") for c in feats])
    if places is not None:
        vec = F.transform(vec, lambda x: F.round(x + F.signum(x) * F.lit(1e-9), places))
    bad = sum([F.when(q(c).isNull() | F.isnan(q(c).cast("double")), 1).otherwise(0) for c in feats], F.lit(0))
    out = df.select(*[q(k) for k in as_list(key)], q(ts),
                    F.collect_list(vec).over(w).alias("seq"),
                    F.count(F.lit(1)).over(w).alias("__n"),
                    F.sum(bad).over(w).alias("__bad"),
                    label.alias(label_name))
    return (out.where((F.col("__n") == seq_len) & (F.col("__bad") == 0) & F.col(label_name).isNotNull()
                      & ~F.isnan(F.col(label_name).cast("double")))
               .drop("__n", "__bad"))


def sequence_windows(df: DataFrame, features, target: str, seq_len: int = 24, key="entity_id", ts="ts",
                     places: int | None = None) -> DataFrame:
    """One row per full window of ``seq_len`` rows; label = target at the window's last row.

    ``seq`` is ARRAY<ARRAY<DOUBLE>> (time-major). Windows with any NULL/NaN
    feature or a NULL target are dropped. With the split column among the keys
    (``key=["entity_id", "split"]``) no window and no label leaves its split.
    Output grows seq_len x |features| per input row: keep this last and the
    feature list short.
    """
    return _frame_windows(df, features, q(target), seq_len, key, ts, "y", places)


def sequence_windows_horizon(df: DataFrame, features, label: str, seq_len: int = 24, horizon: int = 1,
                             key="entity_id", ts="ts", places: int | None = None) -> DataFrame:
    """Windows of rows i..i+s-1 labelled with ``label`` at row i+s+h-1 (h rows after the end)."""
    lab = F.lead(q(label), horizon).over(series_window(key, ts))
    return _frame_windows(df, features, lab, seq_len, key, ts, "y", places)
