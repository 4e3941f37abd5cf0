"""Baseline forecasters written as window expressions (no model fitting)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.operators.common import as_list, q


def seasonal_mean_baseline(df: DataFrame, column: str, key="entity_id", ts="ts", split_col: str = "split",
                           fit: str = "train", score: str = "test") -> DataFrame:
    """Hour-of-day mean of ``column`` over the fit rows, as the forecast for the scored rows.

    The mean is a window aggregate over (key, hour), so there is no
    statistics table to join back and nothing is broadcast; only the five
    needed columns are shuffled.
    """
    keys = as_list(key)
    hour = F.hour(q(ts))
    narrow = df.select(*[q(k) for k in keys], q(ts), q(split_col).alias("__split"), hour.alias("__hour"),
                       q(column).cast("double").alias("y_true"))
    w = Window.partitionBy(*[q(k) for k in keys], "__hour")
    pred = F.avg(F.when(F.col("__split") == fit, F.col("y_true"))).over(w)
    out = narrow.select("*", pred.alias("y_pred")).where(F.col("__split") == score)
    return out.select(*[q(k) for k in keys], q(ts), "y_true", "y_pred")
