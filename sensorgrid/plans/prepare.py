"""The preparation job as one lazy plan: raw readings -> cleaned table -> feature pack.

Order matters and follows the reference: sentinel -> dedup -> missing flags
-> median impute -> winsorize -> hourly grid -> gap flag -> forward fill ->
targets -> split -> lag / rolling / calendar features -> warm-up trim.

Physical shape: the readings are hash partitioned by the series key once
(the grid join's exchange); statistics are whole-series window aggregates on
that partitioning, and every ordered window (ffill, lags, rolls, leads,
row numbers) shares ``partitionBy(key).orderBy(ts)``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgrid.functions.columns import numeric_columns, pick_target_column, priority_features
from sensorgrid.functions.exprs import threshold_class
from sensorgrid.operators import clean, grid, splits
from sensorgrid.operators import features as fx
from sensorgrid.operators.clean import MISSING_SUFFIX
from sensorgrid.operators import blocked as bk
from sensorgrid.operators.common import checked_broadcast, q, select_replacing, series_window


@dataclass
class PrepareConfig:
    key: str = "entity_id"
    ts: str = "ts"
    sensors: list | None = None          # default: numeric columns of the input
    target: str | None = None            # default: name rule (CO column)
    features: list | None = None         # default: priority-name rule
    lags: tuple = fx.LAGS
    rolls: tuple = fx.ROLLS
    fit_years: tuple = (2004,)
    test_years: tuple = (2005,)
    test_start: str | None = None        # alternative to years: ts >= test_start is test
    val_fraction: float = splits.VAL_FRACTION
    thresholds: tuple = (1.5, 2.5)
    stats_scope: str = "all"             # "all" (reference) or "train" (no leakage)
    exact_quantiles: bool = True
    dedup_order: list = field(default_factory=list)  # tie-break for duplicate timestamps (default: the sensors, missing last)
    num_partitions: int | None = None
    block_hours: int | None = None       # set: time-blocked windows (hot / very long series)


def clean_readings(raw: DataFrame, cfg: PrepareConfig) -> DataFrame:
    """Cleaned table: key, ts, sensors (imputed, winsorized, filled), flags, __gap."""
    key, ts = cfg.key, cfg.ts
    sensors = cfg.sensors or numeric_columns(raw, exclude=[key, ts])
    base = raw.select(q(key), q(ts), *[q(c).cast("double").alias(c) for c in sensors])
    x = clean.sentinel_to_null(base, sensors, key=key)
    x = clean.drop_null_keys(x, [key, ts])
    x = clean.dedup_first(x, [key, ts], cfg.dedup_order or sensors)
    x = clean.missing_flags(x, sensors, key=key)
    scope = _scope(x, cfg) if cfg.stats_scope == "train" else None
    x = clean.median_impute(x, sensors, by=key, scope=scope, exact=cfg.exact_quantiles)
    x = clean.winsorize_iqr(x, sensors, by=key, scope=scope, exact=cfg.exact_quantiles)
    g = grid.hourly_grid(x, key=key, ts=ts, num_partitions=cfg.num_partitions)
    return grid.forward_fill(g, sensors, key=key, ts=ts)


def _scope(df: DataFrame, cfg: PrepareConfig) -> Column:
    """Rows a statistic may be fitted on when ``stats_scope='train'``: the fit years.

    The train/val cut inside the fit years is positional on the final grid, so
    the scope here is the whole fit period (no test-period rows)."""
    if cfg.test_start is not None:
        return q(cfg.ts) < F.lit(cfg.test_start).cast("timestamp_ntz")
    return F.year(q(cfg.ts)).isin(list(cfg.fit_years))


def feature_pack(cleaned: DataFrame, cfg: PrepareConfig, label_tasks=()) -> DataFrame:
    """key, ts, split, base features, lags, rolling mean/std, calendar, target_reg, target_cls.

    ``label_tasks`` = [(target, h), ...] adds ``y__<target>__h<h>`` = target h rows ahead,
    computed in the same window pass (no second sort, no join)."""
    key, ts = cfg.key, cfg.ts
    sensors = cfg.sensors or [c for c in numeric_columns(cleaned, exclude=[key, ts])
                              if not c.endswith(MISSING_SUFFIX) and c != grid.GAP_COL]
    target = cfg.target or pick_target_column(sensors)
    num_all = [c for c in numeric_columns(cleaned, exclude=[key, ts]) if c != grid.GAP_COL]
    feats = cfg.features or priority_features(num_all, exclude=["target_reg", "target_cls"])
    w = series_window(key, ts)
    nxt = F.lead(q(target), 1).over(w)
    with_split = splits.chrono_split(cleaned, cfg.fit_years, cfg.test_years, cfg.val_fraction, key=key, ts=ts,
                                      test_start=cfg.test_start)
    exprs = [q(key), q(ts), F.col("split")]
    exprs += [q(c) for c in feats]
    for c in feats:
        exprs += fx.lag_exprs([c], cfg.lags, key, ts)
        exprs += fx.rolling_mean_exprs([c], cfg.rolls, key, ts) + fx.rolling_std_exprs([c], cfg.rolls, key, ts)
    exprs += fx.calendar_exprs(ts, grid.GAP_COL)
    exprs += [nxt.alias("target_reg"), threshold_class(nxt, *cfg.thresholds).alias("target_cls"),
              F.row_number().over(w).alias("__rn")]
    exprs += [F.lead(q(t), int(h)).over(w).cast("double").alias(f"y__{t}__h{int(h)}") for t, h in label_tasks]
    wide = with_split.select(*exprs)
    return wide.where(F.col("__rn") > max(cfg.lags)).drop("__rn")


def pack_columns(pack: DataFrame, key="entity_id", ts="ts") -> list[str]:
    """Model input columns of a pack (everything but ids, split and targets)."""
    skip = {key, ts, "split", "target_reg", "target_cls"}
    return [c for c in pack.columns if c not in skip]


def scaled_pack(pack: DataFrame, key="entity_id", scope: str = "train", by=None) -> DataFrame:
    """The 'nn' pack: every feature standardised (population std, std 0 -> 1).

    ``scope='train'`` fits on train rows only; ``'all'`` reproduces the
    reference, which fits on all rows."""
    cols = [c for c in pack_columns(pack, key) if c]
    sc = (F.col("split") == "train") if scope == "train" else None
    return clean.standardize(pack, cols, by=by, scope=sc)


def prepare(raw: DataFrame, cfg: PrepareConfig | None = None) -> tuple[DataFrame, DataFrame]:
    cfg = cfg or PrepareConfig()
    if cfg.block_hours:
        cleaned = clean_readings_blocked(raw, cfg)
        return cleaned.drop(bk.BLK), feature_pack_blocked(cleaned, cfg)
    cleaned = clean_readings(raw, cfg)
    return cleaned, feature_pack(cleaned, cfg)


# ----------------------------------------------------------------------------- time-blocked variant

def _fit_expr(cfg: PrepareConfig) -> Column:
    if cfg.test_start is not None:
        return q(cfg.ts) < F.lit(cfg.test_start).cast("timestamp_ntz")
    years = sorted(cfg.fit_years)
    if years and years != list(range(years[0], years[-1] + 1)):
        raise ValueError("the blocked split needs a contiguous fit period")
    return F.year(q(cfg.ts)).isin(years)


def _test_expr(cfg: PrepareConfig) -> Column:
    if cfg.test_start is not None:
        return q(cfg.ts) >= F.lit(cfg.test_start).cast("timestamp_ntz")
    return F.year(q(cfg.ts)).isin(list(cfg.test_years))


def clean_readings_blocked(raw: DataFrame, cfg: PrepareConfig) -> DataFrame:
    """``clean_readings`` with no whole-series window: statistics are group-by aggregates joined
    back (size-checked broadcast), the grid and the forward fill run per (key, block).
    The result keeps the ``__blk`` column."""
    key, ts, B = cfg.key, cfg.ts, int(cfg.block_hours)
    sensors = cfg.sensors or numeric_columns(raw, exclude=[key, ts])
    base = raw.select(q(key), q(ts), *[q(c).cast("double").alias(c) for c in sensors])
    x = clean.sentinel_to_null(base, sensors, key=key)
    x = clean.drop_null_keys(x, [key, ts])
    x = clean.dedup_first(x, [key, ts], cfg.dedup_order or sensors)
    x = clean.missing_flags(x, sensors, key=key)
    # the hourly readings feed four branches (median, quartiles, grid bounds, alignment):
    # materialise them once in the shared checkpoint folder instead of re-reading the raw input
    x = x.checkpoint(eager=True)
    scope = _scope(x, cfg) if cfg.stats_scope == "train" else None
    med = checked_broadcast(bk.percentile_stats(x, sensors, key, (0.5,), scope, cfg.exact_quantiles, "__m"))
    x = x.join(med, on=[key], how="left")
    x = select_replacing(x, {c: F.coalesce(q(c), F.col(f"__m{i}")[0]) for i, c in enumerate(sensors)})
    x = x.drop(*[f"__m{i}" for i in range(len(sensors))])
    qs = checked_broadcast(bk.percentile_stats(x, sensors, key, (0.25, 0.75), scope, cfg.exact_quantiles, "__q"))
    x = x.join(qs, on=[key], how="left")
    rep = {}
    for i, c in enumerate(sensors):
        q1, q3 = F.col(f"__q{i}")[0], F.col(f"__q{i}")[1]
        rep[c] = F.least(F.greatest(q(c), q1 - F.lit(3.0) * (q3 - q1)), q3 + F.lit(3.0) * (q3 - q1))
    x = select_replacing(x, rep).drop(*[f"__q{i}" for i in range(len(sensors))])
    x = x.checkpoint(eager=True)  # imputed + winsorized readings: grid bounds and alignment both read them
    g = bk.hourly_grid_blocked(x, B, key=key, ts=ts)
    return bk.forward_fill_blocked(g, sensors, B, key=key, ts=ts)


def feature_pack_blocked(cleaned: DataFrame, cfg: PrepareConfig, label_tasks=()) -> DataFrame:
    """``feature_pack`` computed per (key, block) with halo rows; same rows and values.

    Positions (warm-up trim, train/val cut) are hour offsets on the regular grid against
    per-series bounds from one small group-by."""
    key, ts, B = cfg.key, cfg.ts, int(cfg.block_hours)
    base = cleaned.drop(bk.BLK) if bk.BLK in cleaned.columns else cleaned
    sensors = cfg.sensors or [c for c in numeric_columns(base, exclude=[key, ts])
                              if not c.endswith(MISSING_SUFFIX) and c != grid.GAP_COL]
    target = cfg.target or pick_target_column(sensors)
    num_all = [c for c in numeric_columns(base, exclude=[key, ts]) if c != grid.GAP_COL]
    feats = cfg.features or priority_features(num_all, exclude=["target_reg", "target_cls"])
    before = max(max(cfg.lags), max(cfg.rolls) - 1)
    after = max([1] + [int(h) for _, h in label_tasks])
    fit = _fit_expr(cfg)
    base = base.checkpoint(eager=True)  # the cleaned table (the reference writes it too): bounds + halo read it
    bounds = checked_broadcast(bk.series_bounds(base, key, ts, fit))
    halo = bk.with_halo(base.select(q(key), q(ts), grid.GAP_COL, *[q(c) for c in feats if c != grid.GAP_COL],
                                    *([q(target)] if target not in feats else []),
                                    *[q(t) for t, _ in label_tasks if t not in feats and t != target]),
                        B, before, after, ts)
    bkey = [key, bk.BLK]
    w = series_window(bkey, ts)
    nxt = F.lead(q(target), 1).over(w)
    exprs = [q(key), q(ts), F.col(bk.CORE)] + [q(c) for c in feats]
    for c in feats:
        exprs += fx.lag_exprs([c], cfg.lags, bkey, ts)
        exprs += fx.rolling_mean_exprs([c], cfg.rolls, bkey, ts) + fx.rolling_std_exprs([c], cfg.rolls, bkey, ts)
    exprs += fx.calendar_exprs(ts, grid.GAP_COL)
    exprs += [nxt.alias("target_reg"), threshold_class(nxt, *cfg.thresholds).alias("target_cls")]
    exprs += [F.lead(q(t), int(h)).over(w).cast("double").alias(f"y__{t}__h{int(h)}") for t, h in label_tasks]
    wide = halo.select(*exprs).where(F.col(bk.CORE) == 1).drop(bk.CORE)
    j = wide.join(bounds, on=[key], how="inner")
    off = bk.hour_index(q(ts)) - bk.hour_index(F.col("__lo"))
    pos_fit = bk.hour_index(q(ts)) - bk.hour_index(F.col("__fit_lo")) + 1
    n_fit = bk.hour_index(F.col("__fit_hi")) - bk.hour_index(F.col("__fit_lo")) + 1
    cut = F.floor(F.lit(1.0 - cfg.val_fraction) * n_fit)
    split = (F.when(fit & (pos_fit <= cut), F.lit("train")).when(fit, F.lit("val"))
              .when(_test_expr(cfg), F.lit("test")))
    cols = [c for c in wide.columns if c not in (key, ts)]
    return (j.where(off >= max(cfg.lags))
             .select(q(key), q(ts), split.alias("split"), *[q(c) for c in cols]))


