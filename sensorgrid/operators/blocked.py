"""Time-blocked execution of per-series work, for series too long or too hot for one task.

The plain operators partition every window by the series key, so one series
is one task. When a single series holds a large share of all rows (one hot
sensor, years of minute data), that task becomes the job. Here a series is
cut into blocks of ``block_hours`` consecutive grid hours and every window is
partitioned by (key, block):

* look-back / look-ahead windows (lags, rolling frames, leads, targets, forecasts,
  sequence windows: :func:`blockwise`) see halo rows copied from the blocks around —
  at most ``before`` hours back and ``after`` hours ahead, over as many blocks as
  that takes — and the halo rows are dropped after the windows ran;
* forward fill is a two-level scan: fill inside each block, then carry the
  last non-NULL value of earlier blocks in from a one-row-per-block summary;
* positions (warm-up trim, chronological split) are hour arithmetic on the
  regular grid against per-series bounds, not a row_number over the series;
* per-series quantiles are selected by rank over range partitions and other statistics
  are a group-by on the key (partial aggregation), joined back, never a window over the
  whole series.

Series without a regular grid are cut by row positions instead (``operators/positions.py``,
``ranged=True`` of the splits).

All of this requires the regular hourly grid (row offset == hour offset),
which ``hourly_grid_blocked`` builds block by block.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.operators.clean import MISSING_SUFFIX
from sensorgrid.operators.common import as_list, q
from sensorgrid.operators.grid import GAP_COL
from sensorgrid.operators.quantiles import exact_quantiles

BLK = "__blk"
CORE = "__core"
EPOCH = "1970-01-01 00:00:00"


def hour_index(ts) -> Column:
    """Whole hours since 1970-01-01 (bigint); consecutive grid hours differ by 1."""
    return F.timestamp_diff("HOUR", F.lit(EPOCH).cast("timestamp_ntz"), q(ts) if isinstance(ts, str) else ts)


def block_of(ts, block_hours: int) -> Column:
    return F.floor(hour_index(ts) / F.lit(block_hours)).cast("bigint")


def block_window(key="entity_id", ts="ts"):
    return Window.partitionBy(*[q(k) for k in as_list(key)], F.col(BLK)).orderBy(q(ts))


def with_block(df: DataFrame, block_hours: int, ts="ts") -> DataFrame:
    return df.select("*", block_of(ts, block_hours).alias(BLK))


def with_halo(df: DataFrame, block_hours: int, before: int, after: int, ts="ts") -> DataFrame:
    """Each row in its own block (``__core`` = 1) plus halo copies (``__core`` = 0) in every other
    block that has an hour at most ``before`` later or ``after`` earlier. A halo wider than a
    block reaches over several."""
    hi = hour_index(ts)
    at = lambda h: F.floor(h / F.lit(block_hours)).cast("bigint")
    cols = [c for c in df.columns if c not in (BLK, CORE)]
    out = df.select(*[q(c) for c in cols], F.explode(F.sequence(at(hi - F.lit(after)), at(hi + F.lit(before)))).alias(BLK))
    return out.select("*", (F.col(BLK) == at(hi)).cast("int").alias(CORE))


def series_bounds(df: DataFrame, key="entity_id", ts="ts", fit: Column | None = None) -> DataFrame:
    """Per series: first / last grid hour (and first / last fit hour). One small group-by."""
    aggs = [F.min(q(ts)).alias("__lo"), F.max(q(ts)).alias("__hi")]
    if fit is not None:
        aggs += [F.min(F.when(fit, q(ts))).alias("__fit_lo"), F.max(F.when(fit, q(ts))).alias("__fit_hi")]
    return df.groupBy(*[q(k) for k in as_list(key)]).agg(*aggs)


def hourly_grid_blocked(df: DataFrame, block_hours: int, key="entity_id", ts="ts", gap_col: str = GAP_COL,
                        flag_suffix: str = MISSING_SUFFIX) -> DataFrame:
    """Same rows as ``grid.hourly_grid``; grid hours are generated per (series, block) in parallel
    and the alignment join is co-partitioned on (key, block, ts)."""
    keys = as_list(key)
    b = series_bounds(df, key, ts)
    # grid anchored at each series' first timestamp (off-hour starts keep their minute offset)
    # and ending at the last whole hour from there that is not after its last timestamp
    steps = F.timestamp_diff("HOUR", F.col("__lo"), F.col("__hi"))
    lo_blk = block_of("__lo", block_hours)
    hi_blk = F.floor((hour_index("__lo") + steps) / F.lit(block_hours)).cast("bigint")
    blocks = b.select(*[q(k) for k in keys], "__lo", steps.alias("__steps"),
                      F.explode(F.sequence(lo_blk, hi_blk)).alias(BLK))
    one_hour = F.make_dt_interval(F.lit(0), F.lit(1), F.lit(0), F.lit(0))
    # first / last grid hour inside the block: the series start shifted by whole hours
    start_h = F.greatest(F.col(BLK) * block_hours, hour_index("__lo")) - hour_index("__lo")
    end_h = F.least((F.col(BLK) + 1) * block_hours - 1 - hour_index("__lo"), F.col("__steps"))
    first = F.col("__lo") + F.make_dt_interval(F.lit(0), start_h.cast("int"), F.lit(0), F.lit(0))
    last = F.col("__lo") + F.make_dt_interval(F.lit(0), end_h.cast("int"), F.lit(0), F.lit(0))
    grid = (blocks.repartition(*[q(k) for k in keys], BLK)
                  .select(*[q(k) for k in keys], BLK, F.explode(F.sequence(first, last, one_hour)).alias(ts)))
    present = with_block(df.select("*", F.lit(1).cast("tinyint").alias("__present")), block_hours, ts)
    joined = grid.join(present, on=keys + [BLK, ts], how="left")
    out = []
    for c in df.columns:
        if c in keys or c == ts:
            out.append(q(c))
        elif c.endswith(flag_suffix):
            out.append(F.coalesce(q(c), F.lit(0)).cast("tinyint").alias(c))
        else:
            out.append(q(c))
    out.append(F.when(F.col("__present").isNull(), 1).otherwise(0).cast("tinyint").alias(gap_col))
    out.append(F.col(BLK))
    return joined.select(*out)


def forward_fill_blocked(df: DataFrame, columns, block_hours: int, key="entity_id", ts="ts") -> DataFrame:
    """Forward fill as a two-level scan (in-block fill + carry-in from earlier blocks)."""
    keys = as_list(key)
    cols = as_list(columns)
    d = df if BLK in df.columns else with_block(df, block_hours, ts)
    w_in = block_window(key, ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    inner = d.select(*[q(c) for c in d.columns if c not in cols],
                     *[F.last(q(c), ignorenulls=True).over(w_in).alias(c) for c in cols])
    # last non-NULL value of each block, then of all earlier blocks (tiny table: one row per block)
    summ = d.groupBy(*[q(k) for k in keys], BLK).agg(
        *[F.max_by(q(c), F.when(q(c).isNotNull(), q(ts))).alias(f"__last_{i}") for i, c in enumerate(cols)])
    w_b = Window.partitionBy(*[q(k) for k in keys]).orderBy(BLK).rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select(*[q(k) for k in keys], BLK,
                        *[F.last(f"__last_{i}", ignorenulls=True).over(w_b).alias(f"__carry_{i}")
                          for i in range(len(cols))])
    j = inner.join(carry, on=keys + [BLK], how="left")
    out = [q(c) for c in d.columns if c not in cols]
    out += [F.coalesce(q(c), F.col(f"__carry_{i}")).alias(c) for i, c in enumerate(cols)]
    return j.select(*out)


def percentile_stats(df: DataFrame, columns, key="entity_id", probs=(0.5,), scope: Column | None = None,
                     exact: bool = True, prefix: str = "__p") -> DataFrame:
    """Per-series percentiles (key, <prefix><i> ...): selected by rank over range partitions, or by
    the bounded sketch. No task holds a series' distinct values."""
    cols, keys = as_list(columns), as_list(key)
    if exact:
        found = exact_quantiles(df, cols, probs, keys, scope)
        return found.select(*[q(k) for k in keys], *[F.col(f"__q{i}").alias(f"{prefix}{i}") for i in range(len(cols))])
    arr = F.array(*[F.lit(float(p)) for p in probs])
    aggs = []
    for i, c in enumerate(cols):
        x = q(c).cast("double") if scope is None else F.when(scope, q(c).cast("double"))
        aggs.append(F.percentile_approx(x, arr, 10000).cast("array<double>").alias(f"{prefix}{i}"))
    return df.groupBy(*[q(k) for k in keys]).agg(*aggs)


def blockwise(df: DataFrame, op, block_hours: int, before: int = 0, after: int = 0, key="entity_id", ts="ts") -> DataFrame:
    """``op(frame, key)``, a per-series operator on the hourly grid that looks at most ``before`` hours back
    and ``after`` ahead, run per (series, block) with halo rows: the same rows as ``op(df, key)``.
    ``op`` must keep the key and ``ts`` columns of the rows it returns."""
    out = op(with_halo(df, block_hours, before, after, ts).drop(CORE), [*as_list(key), BLK])
    return out.where(block_of(ts, block_hours) == F.col(BLK)).drop(BLK)
