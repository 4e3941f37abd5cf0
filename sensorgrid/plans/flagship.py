"""Flagship query: the minimum end-to-end slice of the forecasting engine.

events -> hourly sensor feed -> sentinel / impute / winsorize -> hourly grid
-> gap flag -> forward fill -> lag-1 and 3-hour rolling mean -> two naive
forecasters (persistence and rolling mean) at every horizon -> null-safe
RMSE / MAE / MAPE / R2 per series, horizon and forecaster.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgrid.operators import features as fx
from sensorgrid.operators import metrics
from sensorgrid.operators.common import series_window
from sensorgrid.operators.targets import HORIZONS


def forecasts(cleaned: DataFrame, column: str = "v_mean", horizons=HORIZONS) -> DataFrame:
    """(entity_id, ts, forecaster, horizon_h, y_true, y_pred) for both naive forecasters."""
    w = series_window()
    feats = cleaned.select("entity_id", "ts", F.col(column).alias("y"),
                           *fx.lag_exprs([column], (1,)), *fx.rolling_mean_exprs([column], (3,)),
                           *[F.lead(column, h).over(w).alias(f"__f{h}") for h in horizons])
    cells = []
    for h in horizons:
        fut = F.col(f"__f{h}")
        cells.append(F.struct(F.lit("persistence").alias("forecaster"), F.lit(h).alias("horizon_h"),
                              fut.alias("y_true"), F.col("y").alias("y_pred")))
        cells.append(F.struct(F.lit("rolling_mean3").alias("forecaster"), F.lit(h).alias("horizon_h"),
                              fut.alias("y_true"), F.col(f"{column}__roll_mean3").alias("y_pred")))
    long = feats.select("entity_id", "ts", F.explode(F.array(*cells)).alias("c"))
    return long.select("entity_id", "ts", "c.forecaster", "c.horizon_h", "c.y_true", "c.y_pred") \
               .where(F.col("y_true").isNotNull())


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sensorgrid.plans.registry import cleaned, finish
    f = forecasts(cleaned(spark, sf_dir))
    return finish(metrics.regression_metrics(f, by=["entity_id", "forecaster", "horizon_h"]))
