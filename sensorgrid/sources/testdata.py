"""Adapters from the benchmark tables to the sensor / score data model.

* ``sensor_readings(events)``: the raw hourly feed. Entity = event type,
  one row per (entity, hour) with four sensors; like the reference's raw
  CSV, a reading that could not be taken (std of a single event) is coded
  with the -200 sentinel.
* ``daily_series(orders)``: a daily series per order priority spanning
  1995-2001, used where a multi-year span matters (year split).
* ``supplier_readings(lineitem)``: one daily series per supplier, so the number of series
  grows with the table while a series keeps its length; ``qty10`` (mean quantity / 10) spreads
  over all three status classes at any size.
* ``score_table(events)``: a long score table (model, pollutant, horizon_h,
  R2, RMSE, MAE, MAPE(%), run_id) for the leaderboard operators.

Each adapter is an aggregate or projection of a whole table, so its cost
grows with the table. ``ADAPTER_SQL`` holds the same definitions as DuckDB
SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgrid.functions.exprs import to_hour
from sensorgrid.operators.clean import SENTINEL

SENSORS = ("v_mean", "v_max", "v_std", "n_events")
# Model names seen in the reference's score files, in sorted order.
MODEL_NAMES = ("DecisionTree", "ElasticNet", "ExtraTrees", "GBDT", "GRU", "GRU_nn48", "LSTM", "LSTM_nn48",
               "Lasso", "LinearRegression", "LinearSVR", "MLP", "Naive", "RandomForest", "Ridge")
POLLUTANTS = ("CO(GT)", "C6H6(GT)", "NOx(GT)", "NO2(GT)")
HORIZONS = (1, 6, 12, 24)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sensor_readings(events: DataFrame) -> DataFrame:
    """entity_id, ts (hour), v_mean, v_max, v_std (-200 when undefined), n_events."""
    return (events.groupBy(F.col("event_type").alias("entity_id"), to_hour("ts").alias("ts"))
                  .agg(F.avg("value").alias("v_mean"), F.max("value").alias("v_max"),
                       F.coalesce(F.stddev_samp("value"), F.lit(SENTINEL)).alias("v_std"),
                       F.count(F.lit(1)).cast("double").alias("n_events")))


def daily_series(orders: DataFrame) -> DataFrame:
    """entity_id = priority, ts = order day, value = mean order price, n_orders."""
    return (orders.groupBy(F.col("o_orderpriority").alias("entity_id"),
                           F.date_trunc("day", "o_orderdate").cast("timestamp_ntz").alias("ts"))
                  .agg(F.avg("o_totalprice").alias("value"), F.count(F.lit(1)).cast("double").alias("n_orders")))


def supplier_days(lineitem: DataFrame, *more: str) -> DataFrame:
    """entity_id = supplier, ts = ship day of every line, and the columns ``more``."""
    return lineitem.select(F.col("l_suppkey").cast("string").alias("entity_id"),
                           F.date_trunc("day", "l_shipdate").cast("timestamp_ntz").alias("ts"), *more)


def supplier_readings(lineitem: DataFrame, num_partitions: int | None = None) -> DataFrame:
    """entity_id = supplier, ts = ship day, qty10 = mean quantity / 10, price = mean extended price.

    With ``num_partitions`` the lines are dealt by supplier to as many partitions, which the grouping and
    all windows over the series keep: one exchange, and no task holds more days for a larger table.
    A supplier has hardly two lines a day, so grouping before the exchange would save nothing."""
    days = supplier_days(lineitem, "l_quantity", "l_extendedprice")
    if num_partitions:
        days = days.repartition(num_partitions, "entity_id")
    return days.groupBy("entity_id", "ts").agg((F.avg("l_quantity") / 10).alias("qty10"), F.avg("l_extendedprice").alias("price"))


def _pick(values, idx) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (idx % len(values) + 1).cast("int"))


def score_table(events: DataFrame) -> DataFrame:
    """One score row per event: model from event_id, pollutant from the hour, horizon from user_id."""
    v = F.col("value")
    return events.select(
        _pick(MODEL_NAMES, F.col("event_id")).alias("model"),
        _pick(POLLUTANTS, F.hour("ts")).alias("pollutant"),
        _pick(HORIZONS, F.col("user_id")).cast("int").alias("horizon_h"),
        (F.lit(1.0) - v / 100).alias("R2"),
        (v / 10).alias("RMSE"),
        (v / 20).alias("MAE"),
        v.alias("MAPE(%)"),
        F.col("event_id").alias("run_id"),
    )


def _sql_list(values) -> str:
    return "[" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values) + "]"


# DuckDB equivalents (list index is 1-based, like element_at).
ADAPTER_SQL = {
    "readings": (
        "SELECT event_type AS entity_id, date_trunc('hour', ts) AS ts, avg(value) AS v_mean, "
        "max(value) AS v_max, coalesce(stddev_samp(value), -200.0) AS v_std, "
        "CAST(count(*) AS DOUBLE) AS n_events FROM events GROUP BY 1, 2"
    ),
    "daily": (
        "SELECT o_orderpriority AS entity_id, date_trunc('day', o_orderdate) AS ts, "
        "avg(o_totalprice) AS value, CAST(count(*) AS DOUBLE) AS n_orders FROM orders GROUP BY 1, 2"
    ),
    "supplier": (
        "SELECT CAST(l_suppkey AS VARCHAR) AS entity_id, date_trunc('day', l_shipdate) AS ts, "
        "avg(l_quantity) / 10 AS qty10, avg(l_extendedprice) AS price FROM lineitem GROUP BY 1, 2"
    ),
    "scores": (
        f"SELECT {_sql_list(MODEL_NAMES)}[(event_id % {len(MODEL_NAMES)}) + 1] AS model, "
        f"{_sql_list(POLLUTANTS)}[(hour(ts) % {len(POLLUTANTS)}) + 1] AS pollutant, "
        f"CAST({_sql_list(HORIZONS)}[(user_id % {len(HORIZONS)}) + 1] AS INTEGER) AS horizon_h, "
        "1.0 - value / 100 AS R2, value / 10 AS RMSE, value / 20 AS MAE, value AS \"MAPE(%)\", "
        "event_id AS run_id FROM events"
    ),
}
