"""Targets: next-hour value/class, multi-horizon long targets, persistence forecast.

On the regular grid (``hourly_grid``) a lead of ``h`` rows is a lead of
``h`` hours, so every target is ``lead(y, h)`` over the series window and
all horizons come out of the same sort.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgrid.functions.exprs import threshold_class
from sensorgrid.operators.common import as_list, q, series_window

HORIZONS = (1, 6, 12, 24)  # fixed value: forecast horizons in hours


def next_value_target(df: DataFrame, column: str, out: str = "target_reg", key="entity_id", ts="ts") -> DataFrame:
    """Value of ``column`` one row later in the series (NULL at the end)."""
    return df.select("*", F.lead(q(column), 1).over(series_window(key, ts)).alias(out))


def next_class_target(df: DataFrame, column: str, out_reg: str = "target_reg", out_cls: str = "target_cls",
                      key="entity_id", ts="ts", low: float = 1.5, mid: float = 2.5) -> DataFrame:
    """Next-hour value and its status class (<= low: 0, <= mid: 1, else 2; NULL stays NULL)."""
    nxt = F.lead(q(column), 1).over(series_window(key, ts))
    return df.select("*", nxt.alias(out_reg), threshold_class(nxt, low, mid).alias(out_cls))


def multi_horizon_targets(df: DataFrame, targets, horizons=HORIZONS, key="entity_id", ts="ts") -> DataFrame:
    """Long table (key, ts, target_name, horizon_h, y) with y = target at t + h; NULL y dropped."""
    keys = as_list(key)
    w = series_window(key, ts)
    pairs = [(t, h) for t in as_list(targets) for h in horizons]
    # leads first, explode in a second projection (a generator cannot share a select with windows)
    wide = df.select(*[q(k) for k in keys], q(ts),
                     *[F.lead(q(t), h).over(w).cast("double").alias(f"__y{i}") for i, (t, h) in enumerate(pairs)])
    cells = [F.struct(F.lit(t).alias("target_name"), F.lit(h).cast("int").alias("horizon_h"),
                      F.col(f"__y{i}").alias("y")) for i, (t, h) in enumerate(pairs)]
    long = wide.select(*[q(k) for k in keys], q(ts), F.explode(F.array(*cells)).alias("__c"))
    return (long.select(*[q(k) for k in keys], q(ts), "__c.target_name", "__c.horizon_h", "__c.y")
                .where(F.col("y").isNotNull()))


def aligned_xy(features: DataFrame, targets_long: DataFrame, target_name: str, horizon: int,
               split: str | None = None, key="entity_id", ts="ts", split_col: str = "split") -> DataFrame:
    """Features at t joined to the target at t + h, by key (never by position)."""
    keys = as_list(key)
    t = (targets_long.where((F.col("target_name") == target_name) & (F.col("horizon_h") == horizon))
                     .select(*[q(k) for k in keys], q(ts), F.col("y")))
    f = features if split is None else features.where(q(split_col) == split)
    return f.join(t, on=keys + [ts], how="inner")


def persistence_forecast(df: DataFrame, column: str, horizons=HORIZONS, key="entity_id", ts="ts",
                         carry=()) -> DataFrame:
    """Naive forecast y_hat(t + h) = y(t): rows (key, ts, horizon_h, y_true, y_pred), and the
    columns ``carry`` of the row at t."""
    carry = as_list(carry)
    keys = as_list(key)
    w = series_window(key, ts)
    wide = df.select(*[q(k) for k in keys], q(ts), *[q(c) for c in carry], q(column).cast("double").alias("y_pred"),
                     *[F.lead(q(column), h).over(w).cast("double").alias(f"__y{h}") for h in horizons])
    cells = [F.struct(F.lit(h).cast("int").alias("horizon_h"), F.col(f"__y{h}").alias("y_true")) for h in horizons]
    long = wide.select(*[q(k) for k in keys], q(ts), *[q(c) for c in carry], "y_pred", F.explode(F.array(*cells)).alias("__c"))
    return (long.select(*[q(k) for k in keys], q(ts), *[q(c) for c in carry], "__c.horizon_h", "__c.y_true", "y_pred")
                .where(F.col("y_true").isNotNull()))
