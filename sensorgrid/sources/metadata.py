"""Run metadata as a one-row DataFrame (arrays / maps / structs), written as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, LongType, MapType, StringType,
                               StructField, StructType)

META_SCHEMA = StructType([
    StructField("co_column", StringType()),
    StructField("priority_features", ArrayType(StringType())),
    StructField("lags", ArrayType(IntegerType())),
    StructField("rolls", ArrayType(IntegerType())),
    StructField("rows_total", LongType()),
    StructField("rows_after_warmup", LongType()),
    StructField("X_trees_shape", ArrayType(LongType())),
    StructField("X_nn_shape", ArrayType(LongType())),
    StructField("label_map", MapType(StringType(), IntegerType())),
    StructField("cls_thresholds", MapType(StringType(), DoubleType())),
    StructField("splits_rule", StringType()),
])


def pack_metadata(cleaned: DataFrame, pack: DataFrame | int, target: str, features, lags, rolls,
                  thresholds=(1.5, 2.5), n_features: int | None = None, rule: str = "") -> DataFrame:
    """One-row metadata frame. Pass the written tables: their two counts then read file footers only.
    In place of the pack its number of rows will do, with ``n_features``."""
    n_feat = n_features if n_features is not None else len(pack.columns)
    rows_total, rows_after = cleaned.count(), pack if isinstance(pack, int) else pack.count()
    return _meta_frame(cleaned.sparkSession, target, features, lags, rolls, thresholds, n_feat, rule,
                       rows_total, rows_after)


def _meta_frame(spark: SparkSession, target, features, lags, rolls, thresholds, n_feat, rule,
                rows_total, rows_after) -> DataFrame:
    row = (target, list(features), [int(x) for x in lags], [int(x) for x in rolls], int(rows_total),
           int(rows_after), [int(rows_after), int(n_feat)], [int(rows_after), int(n_feat)],
           {"low": 0, "mid": 1, "high": 2}, {"low": float(thresholds[0]), "mid": float(thresholds[1])}, rule)
    return spark.createDataFrame([row], META_SCHEMA)


def write_metadata(meta: DataFrame, path: str) -> str:
    meta.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(META_SCHEMA).json(path)
