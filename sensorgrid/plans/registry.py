"""Registered queries: one per operator of the inventory, each over whole tables.

``QUERIES[name](spark, sf_dir)`` returns a DataFrame; ``ORACLE[name]`` is the
DuckDB SQL that must give the same rows (doubles rounded to 6 places on both
sides). Queries without an oracle (fitted models, file round trips whose
result is itself a model or a file) are checked on row counts only.

Inputs are the benchmark tables through the adapters of
``sensorgrid.sources.testdata``: the hourly sensor feed is ``events`` per
type and hour, the multi-year daily series is ``orders`` per priority, and
the score table is one row per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from sensorgrid.functions.exprs import argmax_class, family_of, model_family, parse_two_formats, threshold_class, to_hour
from sensorgrid.operators import blocked as bk, clean, features as fx, grid, leaderboard as lb, metrics, splits, targets
from sensorgrid.operators.common import q
from sensorgrid.plans import oracle as O
from sensorgrid.plans.prepare import PrepareConfig, clean_readings, feature_pack
from sensorgrid.sources import testdata as td

QUERIES: dict = {}
ORACLE: dict = {}

TEST_START = "2024-01-24 00:00:00"  # events span January 2024: last week is the test period
CFG = PrepareConfig(sensors=list(td.SENSORS), target="n_events", features=list(td.SENSORS),
                    fit_years=(), test_years=(), test_start=TEST_START)
FIT_YEAR, TEST_YEAR = 1996, 1997  # daily order series: one fit year, the next one test


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


NUDGE = 1e-9  # moves exact decimal ties off the rounding boundary, the same way in both engines


def cmp_round(c, places: int = 6):
    """Comparison rounding: HALF_UP at ``places`` after a sign-aware 1e-9 nudge, so two engines
    whose sums differ by one ulp around an exact tie (x.xxxxxx5) still agree."""
    return F.round(c + F.signum(c) * F.lit(NUDGE), places)


def finish(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every DOUBLE (and array-of-double) column for comparison."""
    out = []
    for f in df.schema.fields:
        c = q(f.name)
        if isinstance(f.dataType, DoubleType):
            out.append(cmp_round(c, places).alias(f.name))
        elif isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, DoubleType):
            out.append(F.transform(c, lambda x: cmp_round(x, places)).alias(f.name))
        else:
            out.append(c)
    return df.select(*out)


# ----------------------------------------------------------------------------- inputs

def events(spark, sf):
    return td.read_table(spark, sf, "events")


def readings(spark, sf):
    return td.sensor_readings(events(spark, sf))


def cleaned(spark, sf):
    return clean_readings(readings(spark, sf), CFG)


def pack(spark, sf):
    return feature_pack(cleaned(spark, sf), CFG)


def scores(spark, sf):
    return td.score_table(events(spark, sf))


def daily(spark, sf):
    return td.daily_series(td.read_table(spark, sf, "orders"))


def supplier_series(spark, sf):
    """One series per supplier on a daily grid, forward filled: the series count grows with the table,
    and with it the number of partitions, each of as many grid rows at any size."""
    lines = td.read_table(spark, sf, "lineitem")
    n = grid.grid_partitions(td.supplier_days(lines), step_hours=24)
    return grid.forward_fill(grid.hourly_grid(td.supplier_readings(lines, n), step_hours=24), ["qty10", "price"])


SUPPLIER_TEST_START = "2000-01-01 00:00:00"  # ship days span 1995 to 2001
CFG_SUPPLIER = PrepareConfig(sensors=["qty10", "price"], target="qty10", features=["qty10", "price"],
                             fit_years=(), test_years=(), test_start=SUPPLIER_TEST_START)


def supplier_pack(spark, sf):
    """Split and next-day status class of the supplier series, after the warm-up."""
    return feature_pack(supplier_series(spark, sf), CFG_SUPPLIER).select("entity_id", "ts", "split", "target_cls")


S = list(td.SENSORS)
DBL = [(c, True) for c in S]
FLAGS = [(f"{c}__was_missing", False) for c in S]
CLEAN = O.clean_chain()
SUPPLIER = O.supplier_chain()
KEYS = [("entity_id", False), ("ts", False)]


# ----------------------------------------------------------------------------- sources, column rules

@register("scan_parquet", "SELECT event_id, ts, event_type, " + O.r6("value") + " AS value FROM events")
def q_scan_parquet(spark, sf):
    return finish(events(spark, sf).select("event_id", "ts", "event_type", "value"))


# Raw Date / Time strings derived from events: 'click' rows use the colon time format; 'error'
# rows with value > 300 carry a broken time.
def _broken():
    return (F.col("event_type") == "error") & (F.col("value") > 300)


@register("parse_ts_two_formats",
          "SELECT event_id, CASE WHEN event_type = 'error' AND value > 300 THEN NULL "
          "ELSE date_trunc('second', ts) END AS ts FROM events")
def q_parse_ts(spark, sf):
    e = events(spark, sf)
    date = F.date_format("ts", "dd/MM/yyyy")
    time = (F.when(_broken(), F.lit("xx.yy.zz"))
             .when(F.col("event_type") == "click", F.date_format("ts", "HH:mm:ss"))
             .otherwise(F.date_format("ts", "HH.mm.ss")))
    return e.select("event_id", parse_two_formats(date, time).alias("ts"))


@register("drop_null_keys",
          "SELECT event_id, date_trunc('second', ts) AS ts FROM events "
          "WHERE NOT (event_type = 'error' AND value > 300)")
def q_drop_null_keys(spark, sf):
    return clean.drop_null_keys(q_parse_ts(spark, sf), ["ts"])


@register("select_by_regex", "SELECT event_id, ts, event_type, " + O.r6("value") + " AS value FROM events")
def q_select_by_regex(spark, sf):
    from sensorgrid.functions.columns import drop_by_regex
    return finish(drop_by_regex(events(spark, sf), r"^(props|user_id)$"))


@register("coerce_numeric",
          "SELECT event_id, " + O.r6("TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE)") + " AS k, "
          + O.r6("TRY_CAST(props AS DOUBLE)") + " AS props FROM events")
def q_coerce_numeric(spark, sf):
    e = events(spark, sf).select("event_id", F.get_json_object("props", "$.k").alias("k"), "props")
    return finish(clean.coerce_numeric(e, ["k", "props"]))


@register("sentinel_to_null", O.with_([O.cte_readings(), O.cte_sentinel()], O.final(KEYS + DBL, "sentinel")))
def q_sentinel(spark, sf):
    return finish(clean.sentinel_to_null(readings(spark, sf), S))


@register("non_constant_columns", O.with_([O.cte_readings(), O.cte_sentinel()], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {O.r6(f'min({c})')} AS min, {O.r6(f'max({c})')} AS max, "
    f"coalesce(min({c}) <> max({c}), false) AS varying FROM sentinel" for c in S)))
def q_non_constant(spark, sf):
    return finish(clean.non_constant_columns(clean.sentinel_to_null(readings(spark, sf), S), S))


@register("missing_flags", O.with_([O.cte_readings(), O.cte_sentinel(), O.cte_flags()],
                                   O.final(KEYS + DBL + FLAGS, "flagged")))
def q_missing_flags(spark, sf):
    return finish(clean.missing_flags(clean.sentinel_to_null(readings(spark, sf), S), S))


@register("median_impute", O.with_([O.cte_readings(), O.cte_sentinel(), O.cte_flags(), O.cte_impute()],
                                   O.final(KEYS + DBL + FLAGS, "imputed")))
def q_median_impute(spark, sf):
    x = clean.missing_flags(clean.sentinel_to_null(readings(spark, sf), S), S)
    return finish(clean.median_impute(x, S, exact="ranks"))


@register("winsorize_iqr", O.with_(CLEAN[:5], O.final(KEYS + DBL + FLAGS, "winsorized")))
def q_winsorize(spark, sf):
    x = clean.missing_flags(clean.sentinel_to_null(readings(spark, sf), S), S)
    return finish(clean.winsorize_iqr(clean.median_impute(x, S, exact="ranks"), S, exact="ranks"))


@register("dedup_first",
          "WITH r AS (SELECT event_type AS entity_id, date_trunc('hour', ts) AS ts, " + O.r6("value") + " AS value, "
          "event_id, row_number() OVER (PARTITION BY event_type, date_trunc('hour', ts) ORDER BY ts, event_id) AS k "
          "FROM events) SELECT entity_id, ts, value, event_id FROM r WHERE k = 1")
def q_dedup_first(spark, sf):
    e = events(spark, sf).select(F.col("event_type").alias("entity_id"), to_hour("ts").alias("hour_ts"),
                                 F.col("ts").alias("raw_ts"), "value", "event_id")
    d = clean.dedup_first(e, ["entity_id", "hour_ts"], ["raw_ts", "event_id"])
    return finish(d.select("entity_id", F.col("hour_ts").alias("ts"), "value", "event_id"))


# ----------------------------------------------------------------------------- grid, gap, fill

@register("hourly_grid", O.with_([O.cte_readings(), O.cte_sentinel(), O.cte_grid("sentinel", with_flags=False)],
                                 O.final(KEYS + DBL + [("__gap", False)], "gridded")))
def q_hourly_grid(spark, sf):
    return finish(grid.hourly_grid(clean.sentinel_to_null(readings(spark, sf), S)))


@register("gap_flag", O.with_(CLEAN[:6], O.final(KEYS + FLAGS + [("__gap", False)], "gridded")))
def q_gap_flag(spark, sf):
    x = clean.missing_flags(clean.sentinel_to_null(readings(spark, sf), S), S)
    x = clean.winsorize_iqr(clean.median_impute(x, S), S)
    return grid.hourly_grid(x).select("entity_id", "ts", *[f"{c}__was_missing" for c in S], "__gap")


@register("forward_fill", O.with_(CLEAN, O.final(KEYS + DBL + FLAGS + [("__gap", False)], "cleaned")))
def q_forward_fill(spark, sf):
    return finish(cleaned(spark, sf))


@register("standardize", O.with_(CLEAN, "SELECT entity_id, ts, " + ", ".join(
    f"{O.r6(f'({c} - avg({c}) OVER (PARTITION BY entity_id)) / CASE WHEN stddev_pop({c}) OVER (PARTITION BY entity_id) = 0 THEN 1.0 ELSE stddev_pop({c}) OVER (PARTITION BY entity_id) END')} AS {c}"
    for c in S) + " FROM cleaned"))
def q_standardize(spark, sf):
    c = cleaned(spark, sf).select("entity_id", "ts", *S)
    return finish(clean.standardize(c, S, by="entity_id"))


# ----------------------------------------------------------------------------- window features

def _feat_sql(cols_sql: list[tuple[str, str]]) -> str:
    sel = ", ".join(f"{s}" for s, _ in cols_sql)
    inner = f"SELECT entity_id, ts, {sel} FROM cleaned"
    outer = ", ".join(f"{O.r6(O.qi(n))} AS {O.qi(n)}" for _, n in cols_sql)
    return O.with_(CLEAN + [f"f AS ({inner})"], f"SELECT entity_id, ts, {outer} FROM f")


@register("lag_features", _feat_sql([(O.lag_sql(c, L), f"{c}__lag{L}") for c in S for L in fx.LAGS]))
def q_lag(spark, sf):
    c = cleaned(spark, sf)
    return finish(c.select("entity_id", "ts", *fx.lag_exprs(S)))


@register("rolling_mean", _feat_sql([(O.roll_sql(c, w, "avg", f"{c}__roll_mean{w}"), f"{c}__roll_mean{w}")
                                     for c in S for w in fx.ROLLS]))
def q_rolling_mean(spark, sf):
    c = cleaned(spark, sf)
    return finish(c.select("entity_id", "ts", *fx.rolling_mean_exprs(S)))


@register("rolling_std", _feat_sql([(O.roll_sql(c, w, "stddev_samp", f"{c}__roll_std{w}"), f"{c}__roll_std{w}")
                                    for c in S for w in fx.ROLLS]))
def q_rolling_std(spark, sf):
    c = cleaned(spark, sf)
    return finish(c.select("entity_id", "ts", *fx.rolling_std_exprs(S)))


@register("calendar_features", O.with_(CLEAN, "SELECT entity_id, ts, " + ", ".join(s for s, _, _ in O.CALENDAR)
                                       + " FROM cleaned"))
def q_calendar(spark, sf):
    return cleaned(spark, sf).select("entity_id", "ts", *fx.calendar_exprs())


@register("next_value_target", O.with_(CLEAN, "SELECT entity_id, ts, " + O.r6(f"lead(n_events, 1) OVER ({O.W})")
                                       + " AS target_reg FROM cleaned"))
def q_next_value(spark, sf):
    c = cleaned(spark, sf).select("entity_id", "ts", "n_events")
    return finish(targets.next_value_target(c, "n_events").drop("n_events"))


@register("next_class_target", O.with_(CLEAN, "SELECT entity_id, ts, " + O.r6(f"lead(n_events, 1) OVER ({O.W})")
                                       + " AS target_reg, " + O.class_sql(f"lead(n_events, 1) OVER ({O.W})")
                                       + " AS target_cls FROM cleaned"))
def q_next_class(spark, sf):
    c = cleaned(spark, sf).select("entity_id", "ts", "n_events")
    return finish(targets.next_class_target(c, "n_events").drop("n_events"))


@register("threshold_class", O.with_([O.cte_readings()], "SELECT entity_id, ts, " + O.class_sql("n_events")
                                     + " AS cls_n, " + O.class_sql("NULLIF(v_std, -200.0) / 20") + " AS cls_v FROM readings"))
def q_threshold_class(spark, sf):
    r = readings(spark, sf)
    v = F.when(F.col("v_std") != -200.0, F.col("v_std")) / 20
    return r.select("entity_id", "ts", threshold_class("n_events").alias("cls_n"), threshold_class(v).alias("cls_v"))


@register("warmup_trim", O.with_(CLEAN, f"SELECT entity_id, ts FROM (SELECT entity_id, ts, row_number() OVER ({O.W}) "
                                        "AS rn FROM cleaned) WHERE rn > 24"))
def q_warmup(spark, sf):
    return fx.warmup_trim(cleaned(spark, sf).select("entity_id", "ts"))


_PERSIST_SQL = ("persist AS (SELECT entity_id, ts, h.horizon_h, lead(v_mean, h.horizon_h) OVER ({W}) AS y_true, "
                "v_mean AS y_pred FROM cleaned, (SELECT unnest([1, 6, 12, 24]) AS horizon_h) h), "
                "persist_ok AS (SELECT * FROM persist WHERE y_true IS NOT NULL)").replace("{W}", "PARTITION BY entity_id, h.horizon_h ORDER BY ts")


@register("persistence_forecast", O.with_(CLEAN + [_PERSIST_SQL],
                                          "SELECT entity_id, ts, CAST(horizon_h AS INTEGER) AS horizon_h, "
                                          + O.r6("y_true") + " AS y_true, " + O.r6("y_pred") + " AS y_pred FROM persist_ok"))
def q_persistence(spark, sf):
    return finish(targets.persistence_forecast(cleaned(spark, sf), "v_mean"))


def _persist(spark, sf):
    return targets.persistence_forecast(cleaned(spark, sf), "v_mean")


_MH_PAIRS = [(c, h) for c in S for h in targets.HORIZONS]
_MH_SQL = ("mh AS (SELECT entity_id, ts, t.target_name, CAST(t.horizon_h AS INTEGER) AS horizon_h, CASE t.target_name "
           + " ".join(f"WHEN '{c}' THEN lead({c}, t.horizon_h) OVER (PARTITION BY entity_id, t.target_name, t.horizon_h ORDER BY ts)" for c in S)
           + f" END AS y FROM cleaned, (SELECT unnest({[c for c, _ in _MH_PAIRS]}) AS target_name, unnest({[h for _, h in _MH_PAIRS]}) AS horizon_h) t)")


@register("multi_horizon_targets", O.with_(CLEAN + [_MH_SQL], "SELECT entity_id, ts, target_name, horizon_h, "
                                           + O.r6("y") + " AS y FROM mh WHERE y IS NOT NULL"))
def q_multi_horizon(spark, sf):
    return finish(targets.multi_horizon_targets(cleaned(spark, sf), S))


# sequence windows: all sensors, 24-row windows
_SEQ_FEATS = S


WS = "PARTITION BY entity_id, split ORDER BY ts"


def _seq_sql(label_sql: str, src: str = "sp", pre=()) -> str:
    fr = f"({WS} ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"
    vec = "[" + ", ".join(O.r6(c) for c in _SEQ_FEATS) + "]"
    bad = " + ".join(f"CASE WHEN {c} IS NULL OR isnan({c}) THEN 1 ELSE 0 END" for c in _SEQ_FEATS)
    split_pre, split_expr = O.split_sql(TEST_START)
    pre = [f"sp AS (SELECT *, {split_expr} AS split FROM (SELECT *, {split_pre} FROM cleaned))", *pre]
    body = (f"sw AS (SELECT entity_id, split, ts, list({vec}) OVER {fr} AS seq, count(*) OVER {fr} AS n, "
            f"sum({bad}) OVER {fr} AS bad, {label_sql} AS y FROM {src})")
    return O.with_(CLEAN + pre + [body], "SELECT entity_id, split, ts, seq, " + O.r6("y") + " AS y FROM sw "
                   "WHERE n = 24 AND bad = 0 AND y IS NOT NULL AND NOT isnan(y)")


@register("sequence_windows", _seq_sql(f"lead(n_events, 1) OVER ({WS})"))
def q_seq(spark, sf):
    c = splits.chrono_split(cleaned(spark, sf), test_start=TEST_START)
    c = targets.next_value_target(c, "n_events", key=["entity_id", "split"])
    return finish(fx.sequence_windows(c, _SEQ_FEATS, "target_reg", 24, key=["entity_id", "split"], places=6))


@register("sequence_windows_horizon", _seq_sql(f"CAST(lead(cls, 6) OVER ({WS}) AS DOUBLE)", "cl", [
    "cl AS (SELECT *, " + O.class_sql(f"lead(n_events, 1) OVER ({WS})") + " AS cls FROM sp)"]))
def q_seq_h(spark, sf):
    c = splits.chrono_split(cleaned(spark, sf), test_start=TEST_START)
    c = targets.next_class_target(c, "n_events", key=["entity_id", "split"])
    out = fx.sequence_windows_horizon(c, _SEQ_FEATS, "target_cls", 24, horizon=6, key=["entity_id", "split"], places=6)
    return finish(out.withColumn("y", F.col("y").cast("double")))


@register("rolling_error", O.with_(CLEAN + [_PERSIST_SQL],
                                   "SELECT entity_id, ts, CAST(horizon_h AS INTEGER) AS horizon_h, "
                                   + O.r6("sqrt(avg((y_true - y_pred) * (y_true - y_pred)) OVER (PARTITION BY entity_id, horizon_h ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW))")
                                   + " AS rolling_rmse24, "
                                   + O.r6("avg(abs(y_true - y_pred)) OVER (PARTITION BY entity_id, horizon_h ORDER BY ts ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)")
                                   + " AS rolling_mae24 FROM persist_ok"))
def q_rolling_error(spark, sf):
    p = _persist(spark, sf)
    out = fx.rolling_error(p, "y_true", "y_pred", 24, key=["entity_id", "horizon_h"])
    return finish(out.select("entity_id", "ts", "horizon_h", "rolling_rmse24", "rolling_mae24"))


# the same operators per (series, block): blocks of 6 and 72 hours, halos of up to 24

def _register_blocked(name: str, hours: int, before: int, after: int, op):
    def run(spark, sf):
        return finish(bk.blockwise(cleaned(spark, sf), op, hours, before, after))
    run.__name__ = f"q_{name}_blocked"
    register(f"{name}_blocked", ORACLE[name])(run)


_register_blocked("next_value_target", 6, 0, 1, lambda x, key: targets.next_value_target(x.select(*key, "ts", "n_events"), "n_events", key=key).drop("n_events"))
_register_blocked("next_class_target", 6, 0, 1, lambda x, key: targets.next_class_target(x.select(*key, "ts", "n_events"), "n_events", key=key).drop("n_events"))
_register_blocked("multi_horizon_targets", 6, 0, 24, lambda x, key: targets.multi_horizon_targets(x, S, key=key))
_register_blocked("persistence_forecast", 6, 0, 24, lambda x, key: targets.persistence_forecast(x, "v_mean", key=key))
_register_blocked("rolling_error", 6, 23, 24, lambda x, key: fx.rolling_error(
    targets.persistence_forecast(x, "v_mean", key=key), "y_true", "y_pred", 24, key=[*key, "horizon_h"]).drop("y_true", "y_pred"))


def _register_blocked_windows(name: str, hours: int, after: int, op):
    def run(spark, sf):
        c = splits.chrono_split(cleaned(spark, sf), test_start=TEST_START)
        return finish(bk.blockwise(c, op, hours, 23, after, key=["entity_id", "split"]).withColumn("y", F.col("y").cast("double")))
    run.__name__ = f"q_{name}_blocked"
    register(f"{name}_blocked", ORACLE[name])(run)


_register_blocked_windows("sequence_windows", 72, 1, lambda x, key: fx.sequence_windows(
    targets.next_value_target(x, "n_events", key=key), _SEQ_FEATS, "target_reg", 24, key=key, places=6))
_register_blocked_windows("sequence_windows_horizon", 6, 7, lambda x, key: fx.sequence_windows_horizon(
    targets.next_class_target(x, "n_events", key=key), _SEQ_FEATS, "target_cls", 24, horizon=6, key=key, places=6))


# ----------------------------------------------------------------------------- pack, targets, splits

_PACK_CTES, _PACK_COLS = O.pack_ctes(list(td.SENSORS), "n_events", TEST_START)


@register("feature_pack", O.with_(_PACK_CTES, O.final(_PACK_COLS, "pack")))
def q_feature_pack(spark, sf):
    return finish(pack(spark, sf))


_TGT_CTE = _MH_SQL


@register("aligned_xy", O.with_(_PACK_CTES + [_TGT_CTE],
                                "SELECT p.entity_id, p.ts, p.split, " + O.r6("p.v_mean") + " AS v_mean, "
                                + O.r6('p."v_mean__lag1"') + " AS v_mean__lag1, " + O.r6('p."v_mean__roll_mean3"')
                                + " AS v_mean__roll_mean3, " + O.r6("t.y") + " AS y FROM pack p JOIN mh t "
                                "ON p.entity_id = t.entity_id AND p.ts = t.ts "
                                "WHERE t.target_name = 'v_mean' AND t.horizon_h = 6 AND t.y IS NOT NULL AND p.split = 'train'"))
def q_aligned_xy(spark, sf):
    # targets and features come from one window pass, so nothing is joined
    p = feature_pack(cleaned(spark, sf), CFG, label_tasks=[("v_mean", 6)])
    p = p.where((F.col("split") == "train") & F.col("y__v_mean__h6").isNotNull())
    return finish(p.select("entity_id", "ts", "split", "v_mean", "v_mean__lag1", "v_mean__roll_mean3", F.col("y__v_mean__h6").alias("y")))


@register("aligned_xy_joined", ORACLE["aligned_xy"])
def q_aligned_xy_joined(spark, sf):
    """The same rows for tables that were written apart: features and long targets joined by key."""
    c = cleaned(spark, sf)
    xy = targets.aligned_xy(feature_pack(c, CFG), targets.multi_horizon_targets(c, S), "v_mean", 6, split="train")
    return finish(xy.select("entity_id", "ts", "split", "v_mean", "v_mean__lag1", "v_mean__roll_mean3", "y"))


@register("load_pack", O.with_(_PACK_CTES, O.final(_PACK_COLS, "pack", "split = 'val'")))
def q_load_pack(spark, sf):
    from sensorgrid.session import scratch_path
    from sensorgrid.sources.packs import load_pack, write_pack
    base = scratch_path(spark, "pack")
    write_pack(pack(spark, sf), base, "trees")
    out = load_pack(spark, base, "trees", split="val")
    return finish(out.select(*[c for c in pack(spark, sf).columns]))


@register("validate_pack", O.with_(_PACK_CTES, "SELECT split, count(*) AS n_rows, count(*) FILTER (WHERE "
                                   + " OR ".join(f'{O.qi(c)} IS NULL OR isnan({O.qi(c)})' for c, d in _PACK_COLS if d and c != "target_reg")
                                   + ") AS n_bad_feature_rows, count(*) FILTER (WHERE target_cls IS NULL OR target_cls < 0 OR target_cls >= 3) "
                                   "AS n_bad_labels FROM pack GROUP BY split"))
def q_validate_pack(spark, sf):
    from sensorgrid.sources.packs import validate_pack
    p = pack(spark, sf)
    feats = [c for c, d in _PACK_COLS if d and c != "target_reg"]
    return validate_pack(p, feats)


@register("validate_pack_on_write", ORACLE["validate_pack"])
def q_validate_on_write(spark, sf):
    """The same counts as metrics of the job that writes the pack: nothing is read again."""
    from sensorgrid.session import scratch_path
    from sensorgrid.sources.packs import write_checked_pack
    feats = [c for c, d in _PACK_COLS if d and c != "target_reg"]
    return write_checked_pack(pack(spark, sf), scratch_path(spark, "checked-pack"), feats).as_frame(spark)


@register("load_pack_week", O.with_(_PACK_CTES, O.final(_PACK_COLS, "pack", "split = 'train' AND entity_id = 'click' AND "
                                    "ts >= TIMESTAMP '2024-01-08 00:00:00' AND ts < TIMESTAMP '2024-01-15 00:00:00'")))
def q_load_pack_week(spark, sf):
    """One series and week of a pack clustered by (series, time): the comparisons reach the scan."""
    import datetime as dt
    from sensorgrid.session import scratch_path
    from sensorgrid.sources.packs import load_pack, write_pack
    plain, base = scratch_path(spark, "pack"), scratch_path(spark, "clustered-pack")
    write_pack(pack(spark, sf), plain, "trees")
    written = load_pack(spark, plain, "trees", split=None)
    write_pack(written, base, "trees", cluster_by=("entity_id", "ts"))
    out = load_pack(spark, base, "trees", "train", entities=["click"], start=dt.datetime(2024, 1, 8), end=dt.datetime(2024, 1, 15))
    return finish(out.select(*[c for c, _ in _PACK_COLS]))


_SPLIT_PRE, _SPLIT_EXPR = O.split_sql(TEST_START)


@register("split_semi_join", O.with_(_PACK_CTES, "SELECT entity_id, ts, " + O.r6("v_mean") + " AS v_mean FROM pack "
                                     "WHERE (entity_id, ts) IN (SELECT (entity_id, ts) FROM (SELECT entity_id, ts, "
                                     + _SPLIT_EXPR + " AS split FROM (SELECT *, " + _SPLIT_PRE + " FROM cleaned)) WHERE split = 'val')"))
def q_semi(spark, sf):
    from sensorgrid.session import scratch_path
    from sensorgrid.sources.packs import write_table
    # both sides read the written cleaned table: the preparation runs once
    path = scratch_path(spark, "cleaned")
    write_table(cleaned(spark, sf), path)
    c = spark.read.parquet(path)
    p = feature_pack(c, CFG).select("entity_id", "ts", "v_mean")
    ids = splits.chrono_split(c, test_start=TEST_START).where(F.col("split") == "val").select("entity_id", "ts")
    return finish(splits.split_semi_join(p, ids, ["entity_id", "ts"]))


def _daily_split_sql(extra_cols: str = "") -> str:
    fit = f"(year(ts) = {FIT_YEAR})"
    pre = (f"sum(CAST({fit} AS INTEGER)) OVER ({O.W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS __pos, "
           f"sum(CAST({fit} AS INTEGER)) OVER (PARTITION BY entity_id) AS __nfit")
    split = (f"CASE WHEN {fit} AND __pos <= floor(CAST(0.8 AS DOUBLE) * __nfit) THEN 'train' WHEN {fit} THEN 'val' "
             f"WHEN year(ts) = {TEST_YEAR} THEN 'test' END")
    return (f"WITH {O.daily_cte()}, ds AS (SELECT *, {pre} FROM daily), "
            f"sp AS (SELECT entity_id, ts, {split} AS split FROM ds)")


@register("chrono_split", _daily_split_sql() + " SELECT entity_id, ts, split FROM sp")
def q_chrono(spark, sf):
    return splits.chrono_split(daily(spark, sf).select("entity_id", "ts"), (FIT_YEAR,), (TEST_YEAR,))


@register("predefined_fold", _daily_split_sql() + " SELECT entity_id, ts, split, CASE split WHEN 'train' THEN 'fit' "
          "WHEN 'val' THEN 'validate' WHEN 'test' THEN 'holdout' END AS role, split IN ('train', 'val') AS in_refit FROM sp")
def q_predefined(spark, sf):
    return splits.predefined_fold(q_chrono(spark, sf))


@register("ratio_split", f"WITH {O.daily_cte()}, d AS (SELECT entity_id, ts, row_number() OVER ({O.W}) AS rn, "
          "count(*) OVER (PARTITION BY entity_id) AS n FROM daily) SELECT entity_id, ts, CASE WHEN rn <= floor(CAST(0.7 AS DOUBLE) * n) "
          "THEN 'train' WHEN rn <= floor(CAST(0.7 AS DOUBLE) * n) + floor(CAST(0.15 AS DOUBLE) * n) THEN 'val' ELSE 'test' END AS split FROM d")
def q_ratio(spark, sf):
    return splits.ratio_split(daily(spark, sf).select("entity_id", "ts"))


@register("timeseries_folds", f"WITH {O.daily_cte()}, d AS (SELECT entity_id, ts, row_number() OVER ({O.W}) - 1 AS pos, "
          "count(*) OVER (PARTITION BY entity_id) AS n FROM daily), f AS (SELECT d.*, fold, n // 4 AS size, "
          "n - (3 - fold) * (n // 4) AS start FROM d, (SELECT unnest([0, 1, 2]) AS fold)) "
          "SELECT entity_id, ts, CAST(fold AS INTEGER) AS fold, CASE WHEN pos < start THEN 'train' ELSE 'test' END AS role "
          "FROM f WHERE size > 0 AND pos < start + size")
def q_folds(spark, sf):
    return splits.timeseries_folds(daily(spark, sf).select("entity_id", "ts"), 3)


# the same rows from range partitions: no window over a whole series, any spacing

@register("warmup_trim_ranged", ORACLE["warmup_trim"])
def q_warmup_ranged(spark, sf):
    return fx.warmup_trim(cleaned(spark, sf).select("entity_id", "ts"), ranged=True)


@register("chrono_split_ranged", ORACLE["chrono_split"])
def q_chrono_ranged(spark, sf):
    return splits.chrono_split(daily(spark, sf).select("entity_id", "ts"), (FIT_YEAR,), (TEST_YEAR,), ranged=True)


@register("ratio_split_ranged", ORACLE["ratio_split"])
def q_ratio_ranged(spark, sf):
    return splits.ratio_split(daily(spark, sf).select("entity_id", "ts"), ranged=True)


@register("timeseries_folds_ranged", ORACLE["timeseries_folds"])
def q_folds_ranged(spark, sf):
    return splits.timeseries_folds(daily(spark, sf).select("entity_id", "ts"), 3, ranged=True)


@register("rows_per_year", f"WITH {O.daily_cte()} SELECT entity_id, CAST(year(ts) AS INTEGER) AS year, count(*) AS n_rows "
          "FROM daily GROUP BY 1, 2")
def q_rows_per_year(spark, sf):
    return metrics.rows_per_year(daily(spark, sf), by="entity_id")


# ----------------------------------------------------------------------------- metrics

def _reg_metrics_sql(src: str, by: str) -> str:
    ok = "(y_true IS NOT NULL AND y_pred IS NOT NULL)"
    e = f"CASE WHEN {ok} THEN y_true - y_pred END"
    yy = f"CASE WHEN {ok} THEN y_true END"
    n = f"count({e})"
    ssr = f"sum(({e}) * ({e}))"
    sst = f"(var_pop({yy}) * {n})"
    r2 = (f"CASE WHEN {n} = 0 THEN NULL WHEN {sst} = 0 THEN CASE WHEN {ssr} = 0 THEN 1.0 ELSE 0.0 END "
          f"ELSE 1.0 - {ssr} / {sst} END")
    mape = f"avg(CASE WHEN {yy} <> 0 THEN abs(({e}) / {yy}) END) * 100"
    return (f"SELECT {by}, {n} AS n, {O.r6(f'sqrt(avg(({e}) * ({e})))')} AS RMSE, {O.r6(f'avg(abs({e}))')} AS MAE, "
            f"{O.r6(mape)} AS \"MAPE(%)\", {O.r6(r2)} AS R2 FROM {src} GROUP BY {by}")


@register("regression_metrics", O.with_(CLEAN + [_PERSIST_SQL], _reg_metrics_sql("persist_ok", "entity_id, horizon_h")
                                        .replace("SELECT entity_id, horizon_h,", "SELECT entity_id, CAST(horizon_h AS INTEGER) AS horizon_h,")))
def q_reg_metrics(spark, sf):
    return finish(metrics.regression_metrics(_persist(spark, sf), by=["entity_id", "horizon_h"]))


# naive status persistence on the class target
_NAIVE_SQL = ("cl AS (SELECT entity_id, ts, " + O.class_sql(f"lead(qty10, 1) OVER ({O.W})") + " AS cls FROM cleaned), "
              "nv AS (SELECT entity_id, ts, CAST(h.horizon_h AS INTEGER) AS horizon_h, "
              "lead(cls, h.horizon_h) OVER (PARTITION BY entity_id, h.horizon_h ORDER BY ts) AS y_true, cls AS y_pred "
              "FROM cl, (SELECT unnest([1, 6, 12, 24]) AS horizon_h) h), "
              "nv_ok AS (SELECT * FROM nv WHERE y_true IS NOT NULL AND y_pred IS NOT NULL)")


def _naive(spark, sf):
    c = targets.next_class_target(supplier_series(spark, sf), "qty10").select("entity_id", "ts", "target_cls")
    p = targets.persistence_forecast(c, "target_cls")
    return p.select("entity_id", "ts", "horizon_h", F.col("y_true").cast("int").alias("y_true"),
                    F.col("y_pred").cast("int").alias("y_pred"))


def _cls_metrics_sql(by: str, src: str = "nv_ok") -> str:
    keys = [k.strip() for k in by.split(",")]
    kk = ", ".join(keys)
    return (f"cc AS (SELECT {kk}, y_true, y_pred, count(*) AS cnt FROM {src} GROUP BY ALL), "
            f"pc AS (SELECT {kk}, cls, sum(support) AS support, sum(predicted) AS predicted, sum(tp) AS tp FROM ("
            f"SELECT {kk}, y_true AS cls, cnt AS support, 0 AS predicted, CASE WHEN y_true = y_pred THEN cnt ELSE 0 END AS tp FROM cc "
            f"UNION ALL SELECT {kk}, y_pred AS cls, 0, cnt, 0 FROM cc) GROUP BY ALL), "
            f"pm AS (SELECT *, coalesce(CAST(tp AS DOUBLE) / NULLIF(predicted, 0), 0.0) AS p, "
            f"coalesce(CAST(tp AS DOUBLE) / NULLIF(support, 0), 0.0) AS r, "
            f"coalesce(CAST(2 * tp AS DOUBLE) / NULLIF(predicted + support, 0), 0.0) AS f FROM pc), "
            f"cm AS (SELECT {kk}, {O.r6('sum(tp) / sum(support)')} AS accuracy, {O.r6('avg(p)')} AS precision_macro, "
            f"{O.r6('avg(r)')} AS recall_macro, {O.r6('avg(f)')} AS f1_macro, "
            f"{O.r6('sum(p * support) / sum(support)')} AS precision_weighted, "
            f"{O.r6('sum(r * support) / sum(support)')} AS recall_weighted, "
            f"{O.r6('sum(f * support) / sum(support)')} AS f1_weighted, CAST(sum(support) AS BIGINT) AS n FROM pm GROUP BY ALL)")


@register("classification_metrics", O.with_(SUPPLIER + [_NAIVE_SQL, _cls_metrics_sql("entity_id, horizon_h")], "SELECT * FROM cm"))
def q_cls_metrics(spark, sf):
    return finish(metrics.classification_metrics(_naive(spark, sf), by=["entity_id", "horizon_h"]))


@register("naive_classifier", O.with_(SUPPLIER + [_NAIVE_SQL, _cls_metrics_sql("horizon_h")], "SELECT * FROM cm"))
def q_naive_cls(spark, sf):
    return finish(metrics.classification_metrics(_naive(spark, sf), by=["horizon_h"]))


@register("model_comparison", O.with_(SUPPLIER + [_NAIVE_SQL, _cls_metrics_sql("horizon_h")],
                                      "SELECT 'Naive' AS Model, printf('%dh', horizon_h) AS Horizon, "
                                      + ", ".join(f"printf('%.4f', {O.r6(c, 4)}) AS \"{n}\"" for c, n in
                                                  [("accuracy", "Accuracy"), ("f1_macro", "F1 Score"),
                                                   ("precision_macro", "Precision"), ("recall_macro", "Recall")])
                                      + " FROM cm"))
def q_model_comparison(spark, sf):
    m = metrics.classification_metrics(_naive(spark, sf), by=["horizon_h"])
    return m.select(F.lit("Naive").alias("Model"), F.format_string("%dh", "horizon_h").alias("Horizon"),
                    *[F.format_string("%.4f", cmp_round(F.col(c), 4)).alias(n) for c, n in
                      [("accuracy", "Accuracy"), ("f1_macro", "F1 Score"), ("precision_macro", "Precision"),
                       ("recall_macro", "Recall")]])


@register("confusion_matrix", O.with_(SUPPLIER + [_NAIVE_SQL],
                                      "SELECT h.horizon_h, l.y_true, " + ", ".join(
                                          f"CAST(count(n.y_pred) FILTER (WHERE n.y_pred = {k}) AS BIGINT) AS pred_{k}" for k in (0, 1, 2))
                                      + " FROM (SELECT DISTINCT horizon_h FROM nv_ok) h CROSS JOIN (SELECT unnest([0, 1, 2]) AS y_true) l "
                                      "LEFT JOIN nv_ok n ON l.y_true = n.y_true AND h.horizon_h = n.horizon_h GROUP BY ALL"))
def q_confusion(spark, sf):
    return metrics.confusion_matrix(_naive(spark, sf), by=["horizon_h"])


@register("class_distribution", O.with_(_PACK_CTES, "SELECT s.split, l.cls, coalesce(c.n, 0) AS n FROM "
                                        "(SELECT DISTINCT split FROM pack) s CROSS JOIN (SELECT unnest([0, 1, 2]) AS cls) l "
                                        "LEFT JOIN (SELECT split, target_cls AS cls, count(*) AS n FROM pack WHERE target_cls IS NOT NULL "
                                        "GROUP BY ALL) c ON s.split IS NOT DISTINCT FROM c.split AND l.cls = c.cls"))
def q_class_dist(spark, sf):
    return metrics.class_distribution(pack(spark, sf), "target_cls", "split")


@register("column_profile", O.with_(CLEAN, " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, {O.r6(f'avg({c})')} AS mean, {O.r6(f'stddev_samp({c})')} AS std, "
    f"{O.r6(f'min({c})')} AS min, {O.r6(f'quantile_cont({c}, 0.25)')} AS p25, {O.r6(f'quantile_cont({c}, 0.5)')} AS p50, "
    f"{O.r6(f'quantile_cont({c}, 0.75)')} AS p75, {O.r6(f'max({c})')} AS max FROM cleaned" for c in S)))
def q_profile(spark, sf):
    return finish(metrics.column_profile(cleaned(spark, sf), S))


@register("residual_histogram", O.with_(CLEAN + [_PERSIST_SQL,
                                                 "r AS (SELECT abs(y_true - y_pred) AS r FROM persist_ok WHERE horizon_h = 1), "
                                                 "b AS (SELECT min(r) AS lo, max(r) AS hi FROM r), "
                                                 "w AS (SELECT lo, CASE WHEN hi > lo THEN (hi - lo) / 30 ELSE 1.0 END AS width FROM b)"],
                                        "SELECT CAST(least(floor((r.r - w.lo) / w.width) + 1, 30) AS INTEGER) AS bin, "
                                        + O.r6("any_value(w.lo) + (CAST(least(floor((r.r - w.lo) / w.width) + 1, 30) AS INTEGER) - 1) * any_value(w.width)")
                                        + " AS lo, " + O.r6("any_value(w.lo) + CAST(least(floor((r.r - w.lo) / w.width) + 1, 30) AS INTEGER) * any_value(w.width)")
                                        + " AS hi, count(*) AS n FROM r, w GROUP BY 1"))
def q_hist(spark, sf):
    p = _persist(spark, sf).where(F.col("horizon_h") == 1)
    return finish(metrics.residual_histogram(p))


_HIST_BIN = "CAST(least(floor((r.r - w.lo) / w.width) + 1, 30) AS INTEGER)"


@register("residual_histogram_by_horizon", O.with_(
    CLEAN + [_PERSIST_SQL,
             "r AS (SELECT CAST(horizon_h AS INTEGER) AS horizon_h, abs(y_true - y_pred) AS r FROM persist_ok), "
             "b AS (SELECT horizon_h, min(r) AS lo, max(r) AS hi FROM r GROUP BY 1), "
             "w AS (SELECT horizon_h, lo, CASE WHEN hi > lo THEN (hi - lo) / 30 ELSE 1.0 END AS width FROM b)"],
    f"SELECT r.horizon_h, {_HIST_BIN} AS bin, " + O.r6(f"any_value(w.lo) + ({_HIST_BIN} - 1) * any_value(w.width)") + " AS lo, "
    + O.r6(f"any_value(w.lo) + {_HIST_BIN} * any_value(w.width)") + " AS hi, count(*) AS n FROM r JOIN w ON r.horizon_h = w.horizon_h GROUP BY 1, 2"))
def q_hist_by_horizon(spark, sf):
    """The residual histogram of every horizon, each over its own range."""
    return finish(metrics.residual_histogram(_persist(spark, sf), by="horizon_h"))


@register("value_spans", O.with_(CLEAN + [_PERSIST_SQL], "SELECT CAST(horizon_h AS INTEGER) AS horizon_h, " + ", ".join(
    O.r6(f"{f}({c})") + f" AS {c}_{f}" for c in ("y_true", "y_pred") for f in ("min", "max")) + ", count(*) AS n, "
    + O.r6("least(min(y_true), min(y_pred))") + " AS lo, " + O.r6("greatest(max(y_true), max(y_pred))") + " AS hi FROM persist_ok GROUP BY 1"))
def q_value_spans(spark, sf):
    """Least and greatest truth and forecast of every horizon, beside the residual histograms."""
    return finish(metrics.value_spans(_persist(spark, sf), by="horizon_h"))


@register("residual_quantiles", O.with_(CLEAN + [_PERSIST_SQL,
                                                 "qq AS (SELECT CAST(horizon_h AS INTEGER) AS horizon_h, quantile_cont(y_true - y_pred, "
                                                 + O.sql_list(list(O.QQ_PROBS)) + ") AS q FROM persist_ok GROUP BY 1)"],
                                        "SELECT horizon_h, " + O.r6("unnest(" + O.sql_list(list(O.QQ_PROBS)) + ")") + " AS prob, "
                                        + O.r6("unnest(q)") + " AS residual_q, " + O.r6("unnest(" + O.sql_list(O.QQ_NORMAL) + ")")
                                        + " AS normal_q FROM qq"))
def q_quantiles(spark, sf):
    return finish(metrics.residual_quantiles(_persist(spark, sf), by="horizon_h"))


@register("seasonal_mean_baseline", O.with_(_PACK_CTES + [
    "tr AS (SELECT entity_id, hour, avg(v_mean) AS m FROM pack WHERE split = 'train' GROUP BY ALL), "
    "te AS (SELECT p.entity_id, p.ts, p.v_mean AS y_true, tr.m AS y_pred FROM pack p LEFT JOIN tr "
    "ON p.entity_id = tr.entity_id AND p.hour = tr.hour WHERE p.split = 'test')"], _reg_metrics_sql("te", "entity_id")))
def q_seasonal(spark, sf):
    from sensorgrid.plans.baselines import seasonal_mean_baseline
    pr = seasonal_mean_baseline(pack(spark, sf), "v_mean")
    return finish(metrics.regression_metrics(pr, by="entity_id"))


# ----------------------------------------------------------------------------- score tables

SC = O.scores_cte()
_SCORE_COLS = "model, pollutant, horizon_h, " + ", ".join(f"{O.r6(c)} AS {c}" for c in ("R2", "RMSE", "MAE")) + \
              ", " + O.r6('"MAPE(%)"') + ' AS "MAPE(%)"'


@register("model_family", f"WITH {SC} SELECT DISTINCT model, {O.family_sql()} AS family, "
          f"{O.family_old_sql()} AS family_old FROM scores")
def q_model_family(spark, sf):
    m = lb.distinct_models(scores(spark, sf))
    return m.select("model", model_family("model").alias("family"), family_of("model").alias("family_old"))


@register("distinct_models", f"WITH {SC} SELECT DISTINCT model FROM scores")
def q_distinct_models(spark, sf):
    return lb.distinct_models(scores(spark, sf))


@register("filter_models", f"WITH {SC} SELECT {_SCORE_COLS}, run_id FROM scores WHERE {O.NAIVE_RNN_FILTER}")
def q_filter_models(spark, sf):
    return finish(lb.filter_models(scores(spark, sf), exclude_patterns=lb.NAIVE_PATTERNS + lb.RNN_PATTERNS))


_DEDUP = O.best_rows("scores", ["model", "pollutant", "horizon_h"], "R2 DESC NULLS LAST, run_id", "best")


@register("dedup_keep_best", f"WITH {SC}, {_DEDUP} SELECT {_SCORE_COLS}, run_id FROM best")
def q_dedup_best(spark, sf):
    return finish(lb.dedup_keep_best(scores(spark, sf)))


@register("distinct_scores", f"WITH {SC} SELECT DISTINCT model, pollutant, horizon_h FROM scores")
def q_distinct_scores(spark, sf):
    return scores(spark, sf).dropDuplicates(["model", "pollutant", "horizon_h"]).select("model", "pollutant", "horizon_h")


_GAPPED = ("gapped AS (SELECT model, pollutant, horizon_h, run_id, R2, CASE WHEN run_id % 2 = 0 THEN NULL ELSE RMSE END AS RMSE, "
           "CASE WHEN run_id % 3 = 0 THEN NULL ELSE MAE END AS MAE FROM scores)")


@register("first_scores_by_cell", f"WITH {SC}, {_GAPPED} SELECT pollutant, horizon_h, " + ", ".join(
    f"{O.r6(c) if c != 'model' else c} AS {c}" for c in ("model", "R2", "RMSE", "MAE")) + " FROM (SELECT pollutant, horizon_h, " + ", ".join(
    f"first({c} ORDER BY R2 DESC NULLS LAST, model, run_id) FILTER (WHERE {c} IS NOT NULL) AS {c}" for c in ("model", "R2", "RMSE", "MAE"))
    + " FROM gapped GROUP BY pollutant, horizon_h)")
def q_first_scores(spark, sf):
    """Best scores of each cell where a run's errors may be missing: the next run's then."""
    x = scores(spark, sf).select("model", "pollutant", "horizon_h", "run_id", "R2", F.when(F.col("run_id") % 2 != 0, F.col("RMSE")).alias("RMSE"),
                                 F.when(F.col("run_id") % 3 != 0, F.col("MAE")).alias("MAE"))
    return finish(lb.first_values_per_group(x, ["pollutant", "horizon_h"], [("R2", "desc"), ("model", "asc"), ("run_id", "asc")],
                                            keep=["model", "R2", "RMSE", "MAE"]))


_CENTRES = (1.0, 2.0, 3.0)  # of the three status classes on the qty10 scale


@register("argmax_class", O.with_(SUPPLIER + ["sc AS (SELECT entity_id, ts, qty10, [" + ", ".join(
    f"CASE WHEN price > {20000 * (i + 1)} THEN NULL ELSE -abs(qty10 - {c}) END" for i, c in enumerate(_CENTRES))
    + "] AS s FROM cleaned)"], "SELECT entity_id, ts, CASE WHEN list_max(s) IS NOT NULL THEN CAST(list_position(s, list_max(s)) - 1 AS INTEGER) END AS cls FROM sc"))
def q_argmax_class(spark, sf):
    """Predicted status class from three class scores, some of them missing."""
    s = F.array(*[F.when(F.coalesce(F.col("price") <= 20000 * (i + 1), F.lit(True)), -F.abs(F.col("qty10") - c)) for i, c in enumerate(_CENTRES)])
    return supplier_series(spark, sf).select("entity_id", "ts", argmax_class(s).alias("cls"))


_WIN = O.best_rows("best", ["pollutant", "horizon_h"], "R2 DESC NULLS LAST, model, run_id", "win")


@register("overall_winners", f"WITH {SC}, {_DEDUP}, {_WIN} SELECT pollutant, horizon_h, model, {O.family_sql()} AS family, "
          + ", ".join(f"{O.r6(c)} AS {c}" for c in ("R2", "RMSE", "MAE")) + ", " + O.r6('"MAPE(%)"') + ' AS "MAPE(%)" FROM win')
def q_winners(spark, sf):
    return finish(lb.overall_winners(lb.dedup_keep_best(scores(spark, sf))))


_FAM = O.best_rows(f"(SELECT *, {O.family_sql()} AS family FROM best WHERE {O.family_sql()} IN ('Tree', 'Linear/Kernel', 'RNN'))",
                   ["pollutant", "horizon_h", "family"], "R2 DESC NULLS LAST, model, run_id", "fam")


@register("family_best_by_cell", f"WITH {SC}, {_DEDUP}, {_FAM} SELECT pollutant, horizon_h, family, model, "
          + ", ".join(f"{O.r6(c)} AS {c}" for c in ("R2", "RMSE", "MAE")) + ", " + O.r6('"MAPE(%)"')
          + " AS \"MAPE(%)\", CAST(list_position(['Tree', 'Linear/Kernel', 'RNN'], family) AS INTEGER) AS family_order FROM fam")
def q_family_best(spark, sf):
    return finish(lb.family_best_by_cell(lb.dedup_keep_best(scores(spark, sf))))


@register("leaderboard_sort", f"WITH {SC}, {_DEDUP} SELECT {_SCORE_COLS}, run_id, CAST(row_number() OVER (PARTITION BY "
          "horizon_h, pollutant ORDER BY R2 DESC NULLS LAST, model, run_id) AS INTEGER) AS cell_rank FROM best")
def q_leaderboard(spark, sf):
    return finish(lb.leaderboard_sort(lb.dedup_keep_best(scores(spark, sf))))


@register("top_k_models", f"WITH {SC} SELECT {_SCORE_COLS}, run_id FROM scores ORDER BY R2 DESC NULLS LAST, model, run_id LIMIT 10")
def q_topk(spark, sf):
    return finish(lb.top_k_models(scores(spark, sf), 10))


@register("top3_by_pollutant", f"WITH {SC}, c AS (SELECT pollutant, model, {O.family_sql()} AS family, horizon_h, max(R2) AS R2 "
          "FROM scores GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY pollutant ORDER BY R2 DESC NULLS LAST, "
          "horizon_h, model) AS rank FROM c) SELECT pollutant, CAST(rank AS INTEGER) AS rank, model, family, horizon_h, "
          + O.r6("R2") + " AS R2, printf('%s (%s, %dh)', model, family, horizon_h) AS label FROM r WHERE rank <= 3")
def q_top3(spark, sf):
    return finish(lb.top3_by_pollutant(scores(spark, sf)))


def _avg_sql(by: str) -> str:
    best = O.best_rows(f"(SELECT * FROM scores WHERE pollutant IS NOT NULL AND horizon_h IS NOT NULL AND R2 IS NOT NULL "
                       f"AND {O.NAIVE_RNN_FILTER})", ["model", "pollutant", "horizon_h"], "R2 DESC NULLS LAST, run_id", "fb")
    aggs = ", ".join(f"{O.r6(f'avg({c})')} AS {c}_mean, {O.r6(f'stddev_samp({c})')} AS {c}_std" for c in ("R2", "RMSE", "MAE"))
    return f"WITH {SC}, {best} SELECT {by}, {aggs} FROM fb GROUP BY {by}"


@register("avg_by_pollutant", _avg_sql("pollutant"))
def q_avg_pollutant(spark, sf):
    return finish(lb.avg_by_pollutant(scores(spark, sf)))


@register("avg_by_horizon", _avg_sql("horizon_h"))
def q_avg_horizon(spark, sf):
    return finish(lb.avg_by_horizon(scores(spark, sf)))


@register("avg_by_model", f"WITH {SC}, " + O.best_rows(f"(SELECT * FROM scores WHERE pollutant IS NOT NULL AND horizon_h IS NOT NULL "
                                                      f"AND R2 IS NOT NULL AND {O.RNN_FILTER})", ["model", "pollutant", "horizon_h"],
                                                      "R2 DESC NULLS LAST, run_id", "fb")
          + " SELECT model, " + ", ".join(f"{O.r6(f'avg({c})')} AS {c}" for c in ("RMSE", "MAE", "R2")) + " FROM fb GROUP BY model")
def q_avg_model(spark, sf):
    return finish(lb.avg_by_model(scores(spark, sf)))


@register("win_counts", f"WITH {SC}, {_DEDUP}, {_WIN} SELECT model, count(*) AS wins FROM win GROUP BY model")
def q_win_counts(spark, sf):
    return lb.win_counts(lb.overall_winners(lb.dedup_keep_best(scores(spark, sf))))


@register("pivot_scores", f"WITH {SC}, {_DEDUP}, {_WIN} SELECT pollutant, " + ", ".join(
    f"{O.r6(f'max(CASE WHEN horizon_h = {h} THEN R2 END)')} AS h{h}" for h in (1, 6, 12, 24)) + " FROM win GROUP BY pollutant")
def q_pivot(spark, sf):
    w = lb.overall_winners(lb.dedup_keep_best(scores(spark, sf)))
    return finish(lb.pivot_scores(w))


@register("score_labels", f"WITH {SC}, {_DEDUP}, {_WIN} SELECT pollutant, horizon_h, model, {O.family_sql()} AS family, "
          f"printf('%s (%s, %dh)', model, {O.family_sql()}, horizon_h) AS label, "
          f"printf('%s' || chr(10) || 'R2=%.3f', model, {O.r6('R2', 3)}) AS cell_text FROM win")
def q_labels(spark, sf):
    w = lb.overall_winners(lb.dedup_keep_best(scores(spark, sf)))
    return lb.score_labels(w).select("pollutant", "horizon_h", "model", "family", "label", "cell_text")


@register("categorical_order", f"WITH {SC}, {_DEDUP} SELECT model, pollutant, horizon_h, "
          "CAST(NULLIF(list_position(" + O.sql_list(list(lb.POLLUTANTS)) + ", pollutant), 0) AS INTEGER) AS pollutant_order, "
          "CAST(NULLIF(list_position([1, 6, 12, 24], horizon_h), 0) AS INTEGER) AS horizon_h_order FROM best")
def q_categorical(spark, sf):
    b = lb.dedup_keep_best(scores(spark, sf)).select("model", "pollutant", "horizon_h")
    return lb.categorical_order(lb.categorical_order(b, "pollutant", lb.POLLUTANTS), "horizon_h", lb.HORIZONS)


def _suite_b(df: DataFrame) -> DataFrame:
    """The second suite's layout: horizon as text '12h', 'MAPE' without the percent sign."""
    return df.select("model", "pollutant", F.concat(F.col("horizon_h").cast("string"), F.lit("h")).alias("horizon"),
                     "R2", "RMSE", "MAE", F.col("`MAPE(%)`").alias("MAPE"), "run_id")


@register("normalize_scores", f"WITH {SC} SELECT {_SCORE_COLS}, run_id FROM scores")
def q_normalize(spark, sf):
    n = lb.normalize_scores(_suite_b(scores(spark, sf)))
    return finish(n.select("model", "pollutant", "horizon_h", "R2", "RMSE", "MAE", "`MAPE(%)`", "run_id"))


@register("union_scores", f"WITH {SC} SELECT {_SCORE_COLS}, run_id, CASE WHEN horizon_h IN (1, 6) THEN 'suite_a' "
          "ELSE 'suite_b' END AS source FROM scores")
def q_union(spark, sf):
    s = scores(spark, sf)
    a = s.where(F.col("horizon_h").isin(1, 6))
    b = lb.normalize_scores(_suite_b(s.where(F.col("horizon_h").isin(12, 24))))
    u = lb.union_scores({"suite_a": a, "suite_b": b})
    return finish(u.select("model", "pollutant", "horizon_h", "R2", "RMSE", "MAE", "`MAPE(%)`", "run_id", "source"))


@register("scan_result_tables", f"WITH {SC} SELECT {_SCORE_COLS}, run_id FROM scores WHERE pollutant <> 'NO2(GT)' "
          "AND NOT contains(lower(model), 'tuned')")
def q_scan_results(spark, sf):
    """Three CSV tables written from the score table (two layouts plus one 'tuned' file that the
    merge must skip: every NO2 row), read back through the multi-table scan."""
    from sensorgrid.session import scratch_path
    from sensorgrid.sources.results import read_result_tables, write_result_table
    base = scratch_path(spark, "results")
    s = scores(spark, sf)
    no2 = F.col("pollutant") == "NO2(GT)"
    write_result_table(s.where(~no2 & F.col("horizon_h").isin(1, 6)), f"{base}/linear_results.csv")
    write_result_table(_suite_b(s.where(~no2 & F.col("horizon_h").isin(12, 24))), f"{base}/other_results.csv")
    write_result_table(s.where(no2), f"{base}/tuned_tree_results.csv")
    out = read_result_tables(spark, base)
    return finish(out.select("model", "pollutant", "horizon_h", "R2", "RMSE", "MAE", "`MAPE(%)`", "run_id"))


@register("scan_csv_eu", O.with_([O.cte_readings()], "SELECT entity_id, ts, " + ", ".join(f"{O.r6(c)} AS {c}" for c in S)
                                 + " FROM readings"))
def q_scan_csv_eu(spark, sf):
    """Readings rendered as the raw European CSV (decimal commas, Date/Time strings, trailing empty
    columns, colon times for one entity), written to the shared scratch folder and parsed back."""
    from sensorgrid.session import scratch_path
    from sensorgrid.sources.csv_eu import read_eu_csv, to_eu_strings, write_eu_csv
    path = scratch_path(spark, "raw_csv")
    raw = to_eu_strings(readings(spark, sf), time_format_col=F.col("entity_id") == "click", keep_strings=["entity_id"])
    write_eu_csv(raw, path)
    back = read_eu_csv(spark, path, keep_strings=["entity_id"], min_valid=100)
    return finish(back.select("entity_id", "ts", *S))



@register("forecast_scores", O.with_(CLEAN + [
    "fc0 AS (SELECT entity_id, ts, v_mean AS y, " + O.roll_sql("v_mean", 3, "avg", "rm3") + " FROM cleaned), "
    "fc AS (SELECT entity_id, ts, f.forecaster, CAST(f.horizon_h AS INTEGER) AS horizon_h, "
    "lead(y, f.horizon_h) OVER (PARTITION BY entity_id, f.forecaster, f.horizon_h ORDER BY ts) AS y_true, "
    "CASE f.forecaster WHEN 'persistence' THEN y ELSE rm3 END AS y_pred FROM fc0, "
    "(SELECT unnest(['persistence', 'persistence', 'persistence', 'persistence', 'rolling_mean3', 'rolling_mean3', "
    "'rolling_mean3', 'rolling_mean3']) AS forecaster, unnest([1, 6, 12, 24, 1, 6, 12, 24]) AS horizon_h) f), "
    "fc_ok AS (SELECT * FROM fc WHERE y_true IS NOT NULL)"], _reg_metrics_sql("fc_ok", "entity_id, forecaster, horizon_h")))
def q_forecast_scores(spark, sf):
    """The flagship query (``entry``) on any scale factor."""
    from sensorgrid.plans.flagship import flagship
    return flagship(spark, sf)


# ----------------------------------------------------------------------------- pack sinks / sources

@register("write_pack", O.with_(_PACK_CTES, O.final(_PACK_COLS, "pack", "split IS NOT NULL")))
def q_write_pack(spark, sf):
    """Both packs written partitioned by split: 'trees' (raw) from the plan, 'nn' (standardised on
    train rows) from the written 'trees' files, so the window plan runs once. The trees pack is
    read back split by split (partition pruning); rows without a split are in no split folder."""
    from sensorgrid.plans.prepare import scaled_pack
    from sensorgrid.session import scratch_path
    from sensorgrid.sources.packs import check_pack, load_pack, write_pack
    base = scratch_path(spark, "packs")
    p = pack(spark, sf)
    write_pack(p, base, "trees")
    trees = load_pack(spark, base, "trees", split=None)
    write_pack(scaled_pack(trees.select(*p.columns)), base, "nn")
    parts = [load_pack(spark, base, "trees", split=s) for s in ("train", "val", "test")]
    for s, d in zip(("train", "val", "test"), parts):
        check_pack(d, f"trees/{s}", required=["entity_id", "ts", "target_reg"])
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return finish(out.select(*p.columns))


@register("pack_metadata", O.with_(_PACK_CTES, "SELECT 'n_events' AS co_column, ['v_mean', 'v_max', 'v_std', 'n_events'] AS priority_features, "
                                   "[1, 2, 3, 6, 12, 24] AS lags, [3, 6, 12, 24] AS rolls, (SELECT count(*) FROM cleaned) AS rows_total, "
                                   "(SELECT count(*) FROM pack) AS rows_after_warmup, 65::BIGINT AS n_features, 0 AS low, 1 AS mid, 2 AS high, "
                                   "1.5::DOUBLE AS low_upto, 2.5::DOUBLE AS mid_upto, "
                                   "'before 2024-01-24 00:00:00 train/val (last 20% val), test from then on' AS splits_rule"))
def q_pack_metadata(spark, sf):
    """Run metadata (target, features, lags, rolls, row counts, shapes, label map, thresholds)
    written as JSON to the shared folder and read back; counts come from the written tables."""
    from sensorgrid.plans.jobs import split_rule
    from sensorgrid.plans.prepare import pack_columns
    from sensorgrid.session import scratch_path
    from sensorgrid.sources.metadata import pack_metadata, read_metadata, write_metadata
    from sensorgrid.sources.packs import write_table
    base = scratch_path(spark, "meta-pack")
    write_table(cleaned(spark, sf), f"{base}/cleaned")
    c = spark.read.parquet(f"{base}/cleaned")
    write_table(feature_pack(c, CFG), f"{base}/pack")
    p = spark.read.parquet(f"{base}/pack")
    meta = pack_metadata(c, p, CFG.target, CFG.features, CFG.lags, CFG.rolls, CFG.thresholds,
                         n_features=len(pack_columns(p)), rule=split_rule(CFG))
    path = scratch_path(spark, "meta")
    write_metadata(meta, path)
    m = read_metadata(spark, path)
    return m.select("co_column", "priority_features", "lags", "rolls", "rows_total", "rows_after_warmup", F.col("X_trees_shape")[1].alias("n_features"),
                    *[F.col("label_map")[k].alias(k) for k in ("low", "mid", "high")], *[F.col("cls_thresholds")[k].alias(f"{k}_upto") for k in ("low", "mid")],
                    "splits_rule")


# ----------------------------------------------------------------------------- Spark ML (rows-only checks)

ML_TASKS = [(t, h) for t in td.SENSORS for h in (1, 6, 12, 24)]
# deep forests and long boostings take minutes a task here: their queries keep the headline target
TREE_TASKS = [(t, h) for t, h in ML_TASKS if t == "n_events"]


def task_frame(spark, sf, scaled: bool = False, tasks=None):
    """Task frame of the given table, checkpointed for the fits of one query."""
    from sensorgrid.plans.regression import task_frame as build
    return build(cleaned(spark, sf), CFG, tasks or ML_TASKS, scaled=scaled)


def _linear(names, grids=None):
    def run(spark, sf):
        from sensorgrid.plans.regression import linear_suite
        return linear_suite(spark, task_frame(spark, sf), names=names, grids=grids)
    return run


register("fit_linear")(_linear(("LinearRegression",)))
register("fit_ridge")(_linear(("Ridge",)))
register("fit_lasso")(_linear(("Lasso",)))
register("fit_elasticnet")(_linear(("ElasticNet",)))
register("grid_search_linear")(_linear(("LinearRegression", "Ridge", "Lasso", "ElasticNet")))


def _trees(names, tasks=None):
    def run(spark, sf):
        from sensorgrid.plans.regression import tree_suite
        return tree_suite(spark, task_frame(spark, sf, tasks=tasks), names=names)
    return run


register("fit_tree")(_trees(("DecisionTree",)))
register("fit_forest")(_trees(("RandomForest",), TREE_TASKS))
register("fit_gbt")(_trees(("GBDT",), TREE_TASKS))


@register("fit_linear_svr_equiv")
def q_svr(spark, sf):
    from sensorgrid.plans.regression import linear_svr_equiv
    return linear_svr_equiv(spark, task_frame(spark, sf, scaled=True))


@register("grid_search_trees")
def q_grid_trees(spark, sf):
    """The reference's whole grids (36 forest and 72 boosting points, three time folds) on every task."""
    from sensorgrid.operators import models as M
    from sensorgrid.plans.regression import tuned_tree_suite
    return tuned_tree_suite(spark, task_frame(spark, sf), {"RandomForest": M.RF_GRID, "GBDT": M.GBDT_GRID})


@register("score_models")
def q_score_models(spark, sf):
    """Test-period predictions of the OLS model per task: (entity_id, ts, pollutant, horizon_h, y_true, y_pred)."""
    from sensorgrid.operators import models as M
    tf = task_frame(spark, sf)
    outs = []
    for t, h in tf.tasks:
        lab = M.label_col(t, h)
        train = M._fit_rows(tf, lab, ("train",))
        n, s = M._label_stats(train)
        model = M.linear_estimator("LinearRegression", n, s).fit(train)
        test = tf.df.where((F.col("split") == "test") & F.col(lab).isNotNull()).select(
            "entity_id", "ts", "features", F.col(lab).alias("label"))
        outs.append(model.transform(test).select("entity_id", "ts", F.lit(t).alias("pollutant"),
                                                 F.lit(h).alias("horizon_h"), F.col("label").alias("y_true"),
                                                 F.col("prediction").alias("y_pred")))
    out = outs[0]
    for o in outs[1:]:
        out = out.unionByName(o)
    return out


@register("feature_importance")
def q_importance(spark, sf):
    from sensorgrid.plans.regression import importance_table
    return importance_table(spark, task_frame(spark, sf), "DecisionTree")


@register("model_save_load")
def q_save_load(spark, sf):
    """OLS per task saved to the shared folder, loaded back, test predictions scored."""
    from sensorgrid.operators import models as M
    from sensorgrid.session import scratch_path
    tf = task_frame(spark, sf)
    base = scratch_path(spark, "models")
    rows = []
    for t, h in tf.tasks:
        lab = M.label_col(t, h)
        train = M._fit_rows(tf, lab, ("train",))
        n, s = M._label_stats(train)
        path = M.save_model(M.linear_estimator("LinearRegression", n, s).fit(train), f"{base}/{t}_h{h}_LinearRegression")
        sc = M.score(M.load_model("LinearRegression", path), M._fit_rows(tf, lab, ("test",)))
        rows.append(M._row("LinearRegression", t, h, sc, 0.0, n, {"path": path}))
    return spark.createDataFrame(rows, M.SCORE_SCHEMA)


@register("fit_status_classifier")
def q_status_classifier(spark, sf):
    """On the supplier series, whose classes stay spread at any size."""
    from sensorgrid.plans.classification import status_classifier
    return status_classifier(spark, supplier_series(spark, sf), CFG_SUPPLIER, CFG_SUPPLIER.features)


_IN_SPLIT = "OVER (PARTITION BY entity_id, split ORDER BY ts"
_LAST_DAY = _IN_SPLIT + " ROWS BETWEEN 23 PRECEDING AND CURRENT ROW)"


def _window_summaries(spark, sf, block_hours=None):
    from sensorgrid.operators import models as M
    out, names = M.window_summary_frame(pack(spark, sf), S, "target_cls", 24, (1, 24), ["entity_id", "split"], block_hours=block_hours)
    return finish(out.select("entity_id", "split", "ts", *names, "cls__h1", "cls__h24"))


@register("window_summaries", O.with_(_PACK_CTES, "SELECT entity_id, split, ts, " + ", ".join(
    f"{O.r6(c)} AS {c}__last, " + O.r6(f"avg({c}) {_LAST_DAY}") + f" AS {c}__wmean, "
    + O.r6(f"coalesce(stddev_samp({c}) {_LAST_DAY}, 0)") + f" AS {c}__wstd" for c in S)
    + "".join(f", lead(target_cls, {h}) {_IN_SPLIT}) AS cls__h{h}" for h in (1, 24))
    + f" FROM pack QUALIFY count(*) {_LAST_DAY} = 24"))
def q_window_summaries(spark, sf):
    """What the status classifier is fitted on: last value, mean and standard deviation of each full
    day's window of every sensor, and the class 1 and 24 hours on, all inside one split."""
    return _window_summaries(spark, sf)


# ----------------------------------------------------------------------------- time-blocked execution

BLOCK_HOURS = 72  # ten blocks per month-long series: every block boundary is exercised
CFG_BLOCKED = PrepareConfig(sensors=list(td.SENSORS), target="n_events", features=list(td.SENSORS),
                            fit_years=(), test_years=(), test_start=TEST_START, block_hours=BLOCK_HOURS)


@register("window_summaries_blocked", ORACLE["window_summaries"])
def q_window_summaries_blocked(spark, sf):
    """The same rows by (series, block): no task holds a series."""
    return _window_summaries(spark, sf, BLOCK_HOURS)


@register("forward_fill_blocked", ORACLE["forward_fill"])
def q_ffill_blocked(spark, sf):
    """``forward_fill`` with per-(series, block) windows: same rows as the whole-series plan."""
    from sensorgrid.plans.prepare import clean_readings_blocked
    from sensorgrid.operators.blocked import BLK
    return finish(clean_readings_blocked(readings(spark, sf), CFG_BLOCKED).drop(BLK))


@register("feature_pack_blocked", ORACLE["feature_pack"])
def q_pack_blocked(spark, sf):
    """``feature_pack`` with halo-blocked windows and hour-arithmetic positions."""
    from sensorgrid.plans.prepare import clean_readings_blocked, feature_pack_blocked
    c = clean_readings_blocked(readings(spark, sf), CFG_BLOCKED)
    return finish(feature_pack_blocked(c, CFG_BLOCKED).select(*pack(spark, sf).columns))


_PACK_NAIVE = ("nv AS (SELECT split, CAST(h.horizon_h AS INTEGER) AS horizon_h, lead(target_cls, h.horizon_h) OVER (PARTITION BY entity_id, h.horizon_h ORDER BY ts) AS y_true, "
               "target_cls AS y_pred FROM pack, (SELECT unnest([1, 6, 12, 24]) AS horizon_h) h), "
               "nv_ok AS (SELECT * FROM nv WHERE y_true IS NOT NULL AND y_pred IS NOT NULL AND split = 'test')")


@register("classification_results_json", O.with_(_PACK_CTES + [_PACK_NAIVE, _cls_metrics_sql("horizon_h")],
                                                 "SELECT 'Naive' AS model, CAST(horizon_h AS VARCHAR) AS horizon, accuracy, precision_macro, recall_macro, f1_macro, "
                                                 "precision_weighted, recall_weighted, f1_weighted FROM cm"))
def q_cls_json(spark, sf):
    return _json_round_trip(spark, pack(spark, sf))


def _json_round_trip(spark, pk):
    """Naive status scores per horizon dumped as nested JSON (model -> horizon -> metrics), read back and laid out flat."""
    from sensorgrid.plans.classification import naive_class_scores, results_json_frame, write_results_json
    from sensorgrid.session import scratch_path
    scores = naive_class_scores(pk)
    path = write_results_json(scores, scratch_path(spark, "cls-json"))
    back = spark.read.schema(results_json_frame(scores).schema).json(path)
    return finish(back.select("model", F.explode("by_horizon").alias("horizon", "m")).select("model", "horizon", "m.*"))


# the same two on the supplier series, whose classes stay spread at any size
_SUP_SPLIT_PRE, _SUP_SPLIT = O.split_sql(SUPPLIER_TEST_START)
_SUP_PACK = (f"sp AS (SELECT *, {_SUP_SPLIT} AS split FROM (SELECT *, {_SUP_SPLIT_PRE} FROM cleaned)), "
             "pack AS (SELECT * FROM (SELECT entity_id, ts, split, " + O.class_sql(f"lead(qty10, 1) OVER ({O.W})") + " AS target_cls, "
             f"row_number() OVER ({O.W}) AS rn FROM sp) WHERE rn > 24)")


@register("class_distribution_supplier", O.with_(SUPPLIER + [_SUP_PACK],
                                                 "SELECT s.split, l.cls, coalesce(c.n, 0) AS n FROM (SELECT DISTINCT split FROM pack) s CROSS JOIN (SELECT unnest([0, 1, 2]) AS cls) l "
                                                 "LEFT JOIN (SELECT split, target_cls AS cls, count(*) AS n FROM pack WHERE target_cls IS NOT NULL "
                                                 "GROUP BY ALL) c ON s.split IS NOT DISTINCT FROM c.split AND l.cls = c.cls"))
def q_class_dist_supplier(spark, sf):
    return metrics.class_distribution(supplier_pack(spark, sf), "target_cls", "split")


@register("classification_results_json_supplier", O.with_(SUPPLIER + [_SUP_PACK, _PACK_NAIVE, _cls_metrics_sql("horizon_h")],
                                                          "SELECT 'Naive' AS model, CAST(horizon_h AS VARCHAR) AS horizon, accuracy, precision_macro, recall_macro, f1_macro, "
                                                          "precision_weighted, recall_weighted, f1_weighted FROM cm"))
def q_cls_json_supplier(spark, sf):
    return _json_round_trip(spark, supplier_pack(spark, sf))


# ----------------------------------------------------------------------------- series off the grid, many series, text scores

# 'click' starts half past the hour; the last 'error' reading lies 20 minutes off its grid
_OFF_SQL = ("off AS (SELECT entity_id, CASE WHEN entity_id = 'click' THEN ts + INTERVAL 30 MINUTE "
            "WHEN entity_id = 'error' AND ts = max(ts) OVER (PARTITION BY entity_id) THEN ts + INTERVAL 20 MINUTE ELSE ts END AS ts, "
            "v_mean, v_max, v_std, n_events FROM sentinel)")


def _off_grid(spark, sf):
    r = clean.sentinel_to_null(readings(spark, sf), S)
    b = r.groupBy(F.col("entity_id").alias("e")).agg(F.max("ts").alias("last"))
    minutes = lambda n: F.make_dt_interval(F.lit(0), F.lit(0), F.lit(n), F.lit(0))
    ts = (F.when(F.col("entity_id") == "click", F.col("ts") + minutes(30))
           .when((F.col("entity_id") == "error") & (F.col("ts") == F.col("last")), F.col("ts") + minutes(20)).otherwise(F.col("ts")))
    return r.join(b, F.col("entity_id") == F.col("e")).select("entity_id", ts.alias("ts"), *S)


_OFF_GRID = O.with_([O.cte_readings(), O.cte_sentinel(), _OFF_SQL, O.cte_grid("off", with_flags=False)], O.final(KEYS + DBL + [("__gap", False)], "gridded"))


@register("hourly_grid_off_hours", _OFF_GRID)
def q_grid_off_hours(spark, sf):
    """The grid of series that start or end off the full hour."""
    return finish(grid.hourly_grid(_off_grid(spark, sf), flag_suffix="__none"))


@register("hourly_grid_off_hours_blocked", _OFF_GRID)
def q_grid_off_hours_blocked(spark, sf):
    """The same grid, built block by block."""
    from sensorgrid.operators import blocked as bk
    return finish(bk.hourly_grid_blocked(_off_grid(spark, sf), BLOCK_HOURS, flag_suffix="__none").drop(bk.BLK))


@register("supplier_grid", O.with_(SUPPLIER, "SELECT entity_id, count(*) AS n_days, CAST(sum(__gap) AS BIGINT) AS n_gaps, min(ts) AS first_day, max(ts) AS last_day, "
                                   + O.r6("avg(qty10)") + " AS qty10, " + O.r6("avg(price)") + " AS price FROM cleaned GROUP BY entity_id"))
def q_supplier_grid(spark, sf):
    """Daily grid and forward fill of one series per supplier, summed up per series."""
    c = supplier_series(spark, sf)
    return finish(c.groupBy("entity_id").agg(F.count("*").alias("n_days"), F.sum("__gap").alias("n_gaps"), F.min("ts").alias("first_day"),
                                             F.max("ts").alias("last_day"), F.avg("qty10").alias("qty10"), F.avg("price").alias("price")))


@register("supplier_forecast_scores", O.with_(SUPPLIER + [_PERSIST_SQL.replace("v_mean", "price")], _reg_metrics_sql("persist_ok", "horizon_h")
                                              .replace("SELECT horizon_h,", "SELECT CAST(horizon_h AS INTEGER) AS horizon_h,")))
def q_supplier_scores(spark, sf):
    """Persistence over all suppliers' series: one pass, scored per horizon."""
    return finish(metrics.regression_metrics(targets.persistence_forecast(supplier_series(spark, sf), "price"), by=["horizon_h"]))


@register("purged_split", _daily_split_sql() + " SELECT entity_id, ts, split FROM (SELECT *, lead(split, 7) OVER (PARTITION BY entity_id ORDER BY ts) AS s7, "
          "lead(1, 7) OVER (PARTITION BY entity_id ORDER BY ts) AS there FROM sp) WHERE s7 IS NULL OR s7 IS NOT DISTINCT FROM split")
def q_purged(spark, sf):
    """The year split without the rows whose target, 7 rows later, belongs to another split."""
    d = splits.chrono_split(daily(spark, sf), (FIT_YEAR,), (TEST_YEAR,)).select("entity_id", "ts", "split")
    return splits.purge_boundary(d, 7)


_TEXT_SQL = ("raw AS (SELECT ['Ridge', 'GRU', 'GBDT', 'Lasso'][(event_id % 4 + 1)::INTEGER] AS model, ['CO(GT)', 'NO2(GT)'][(user_id % 2 + 1)::INTEGER] AS pollutant, "
             "CASE event_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 6 ELSE 12 END AS horizon_h, CASE WHEN event_id % 5 = 0 THEN NULL ELSE (event_id % 997) / 1000.0::DOUBLE END AS R2, "
             "(event_id % 7)::DOUBLE AS RMSE FROM events), one AS (SELECT DISTINCT * FROM raw), "
             "best AS (SELECT *, row_number() OVER (PARTITION BY model, pollutant, horizon_h ORDER BY R2 DESC NULLS LAST, RMSE) AS b FROM one), "
             "ranked AS (SELECT *, row_number() OVER (PARTITION BY pollutant, horizon_h ORDER BY R2 DESC NULLS LAST, model, RMSE) AS k FROM best WHERE b = 1)")


@register("text_score_top", f"WITH {_TEXT_SQL} SELECT pollutant, CAST(horizon_h AS INTEGER) AS horizon_h, model, {O.r6('R2')} AS R2, RMSE, CAST(k AS INTEGER) AS rank FROM ranked WHERE k <= 3")
def q_text_scores(spark, sf):
    """A score table as text, with NaN scores, horizons '1', '6.0', '12h' and every row twice:
    normalised, exact duplicates removed, the three best models of each cell."""
    e = events(spark, sf)
    horizon = F.when(F.col("event_id") % 3 == 0, "1").when(F.col("event_id") % 3 == 1, "6.0").otherwise("12h")
    r2 = F.when(F.col("event_id") % 5 == 0, "NaN").otherwise(F.format_string("0.%03d", F.col("event_id") % 997))
    raw = e.select(F.element_at(F.array(*[F.lit(m) for m in ("Ridge", "GRU", "GBDT", "Lasso")]), (F.col("event_id") % 4 + 1).cast("int")).alias("model"),
                   F.element_at(F.array(F.lit("CO(GT)"), F.lit("NO2(GT)")), (F.col("user_id") % 2 + 1).cast("int")).alias("pollutant"),
                   horizon.alias("horizon"), r2.alias("R2"), (F.col("event_id") % 7).cast("string").alias("RMSE"))
    one = lb.drop_exact_duplicates(lb.normalize_scores(raw.unionAll(raw), ("model", "pollutant", "horizon_h", "R2", "RMSE")))
    return finish(lb.top_k_per_cell(one, 3, tiebreak=("model", "RMSE")).select("pollutant", "horizon_h", "model", "R2", "RMSE", "rank"))


@register("standardize_train_scope", O.with_(_PACK_CTES, "SELECT entity_id, ts, " + ", ".join(
    O.r6(f"({c} - avg({c}) FILTER (WHERE split = 'train') OVER ()) / CASE stddev_pop({c}) FILTER (WHERE split = 'train') OVER () WHEN 0 THEN 1 "
         f"ELSE stddev_pop({c}) FILTER (WHERE split = 'train') OVER () END") + f" AS {c}" for c in S) + " FROM pack"))
def q_standardize_train(spark, sf):
    """Scaling fitted on the train rows of all series together, as the scaled pack has it."""
    p = pack(spark, sf).select("entity_id", "ts", "split", *S).checkpoint()
    return finish(clean.standardize(p, S, by=None, scope=F.col("split") == "train").drop("split"))


@register("ols_one_feature", O.with_(_PACK_CTES + [
    "ya AS (SELECT entity_id, ts, split, v_mean AS x, lead(v_max, 6) OVER (PARTITION BY entity_id ORDER BY ts) AS y FROM pack), tr AS (SELECT * FROM ya WHERE split = 'train' AND y IS NOT NULL), "
    "co AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept FROM tr), "
    "te AS (SELECT y, slope * x + intercept AS p FROM ya, co WHERE split = 'test' AND y IS NOT NULL)"],
    f"SELECT {O.r6('(SELECT slope FROM co)')} AS slope, {O.r6('(SELECT intercept FROM co)')} AS intercept, {O.r6('sqrt(avg((y - p) * (y - p)))')} AS RMSE, count(*) AS n_test FROM te"))
def q_ols(spark, sf):
    """Least squares through the model path on one feature, saved and loaded: its closed form is SQL."""
    from sensorgrid.operators import models as M
    from sensorgrid.session import scratch_path
    w = targets.series_window("entity_id", "ts")
    p = pack(spark, sf).select("entity_id", "ts", "split", "v_mean", F.lead("v_max", 6).over(w).alias(M.label_col("v_max", 6)))
    tf = M.build_task_frame(p, ["v_mean"], [("v_max", 6)])
    row, model = M.fit_linear_task(tf, "v_max", 6, "LinearRegression", {})
    model = M.load_model("LinearRegression", M.save_model(model, scratch_path(spark, "ols")))
    score = M.score(model, M._fit_rows(tf, M.label_col("v_max", 6), ("test",)))
    return finish(spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept), score["RMSE"], score["n"])],
                                        "slope double, intercept double, RMSE double, n_test long"))


@register("family_r2_pivot", f"WITH {SC} SELECT pollutant, horizon_h, " + ", ".join(
    f"{O.r6(f'max(CASE WHEN {O.family_sql()} = ' + repr(fam) + ' THEN R2 END)')} AS r2_{fam.lower().replace('/', '_')}"
    for fam in ("Tree", "Linear/Kernel", "RNN")) + " FROM scores GROUP BY pollutant, horizon_h")
def q_family_pivot(spark, sf):
    return finish(lb.family_r2_pivot(scores(spark, sf)))
