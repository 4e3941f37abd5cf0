"""Regular hourly grid, gap flag, forward fill.

The grid is built per series from its own (min, max) — one small aggregate —
exploded with ``sequence``. Both sides of the alignment join are hash
partitioned by the series key only, so the ordered windows that follow
(ffill, lags, rolling) reuse that partitioning instead of shuffling again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.operators.clean import MISSING_SUFFIX
from sensorgrid.operators.common import as_list, group_window, q, series_window

GAP_COL = "__gap"

#: Grid rows of a partition: a task sorts them a few times, at some 200 bytes a row and pass.
GRID_ROWS_PER_PARTITION = 250_000


def grid_partitions(df: DataFrame, key="entity_id", ts="ts", step_hours: int = 1) -> int:
    """Partitions that hold :data:`GRID_ROWS_PER_PARTITION` rows each of the grid of ``df``: one aggregate of
    first and last times, one number to the driver.

    Partitions merged by the bytes of the readings do not know how many rows the grid adds to them."""
    b = df.groupBy(*[q(k) for k in as_list(key)]).agg(F.min(q(ts)).alias("__lo"), F.max(q(ts)).alias("__hi"))
    rows = F.floor(F.timestamp_diff("MICROSECOND", F.col("__lo"), F.col("__hi")) / F.lit(step_hours * 3_600_000_000)) + 1
    n = b.agg(F.sum(rows)).first()[0] or 0
    return max(1, -(-int(n) // GRID_ROWS_PER_PARTITION))


def hourly_grid(df: DataFrame, key="entity_id", ts="ts", step_hours: int = 1,
                gap_col: str = GAP_COL, flag_suffix: str = MISSING_SUFFIX,
                num_partitions: int | None = None) -> DataFrame:
    """Every step from each series' first to last timestamp; off-grid rows dropped.

    Added rows get NULL readings, ``gap_col`` = 1 and missing-flags = 0;
    present rows get ``gap_col`` = 0. ``ts`` must be unique per key (dedup first).

    One pass, no join: rows whose offset from the series start is not a whole
    number of steps are dropped, then each remaining row emits itself plus the
    missing steps up to the next present row (``posexplode(sequence(ts, next - step))``),
    or, for the last one, up to the last whole step not after the series' maximum —
    the maximum of all readings, whether on the grid or off it.
    The only exchange is the hash partitioning by key that the following
    series windows reuse; the raw input is scanned once.
    """
    keys = as_list(key)
    step = F.make_dt_interval(F.lit(0), F.lit(step_hours), F.lit(0), F.lit(0))
    src = df.repartition(num_partitions, *[q(k) for k in keys]) if num_partitions else df
    first, last = F.min(q(ts)).over(group_window(keys)), F.max(q(ts)).over(group_window(keys))
    step_us = F.lit(step_hours * 3_600_000_000)
    steps = F.floor(F.timestamp_diff("MICROSECOND", first, last) / step_us)
    end = first + F.make_dt_interval(F.lit(0), (steps * F.lit(step_hours)).cast("int"), F.lit(0), F.lit(0))
    marked = src.select("*", (F.timestamp_diff("MICROSECOND", first, q(ts)) % step_us == 0).alias("__on"), end.alias("__end"))
    on_grid = marked.where(F.col("__on")).drop("__on")
    nxt = F.lead(q(ts)).over(series_window(keys, ts))
    with_next = on_grid.select("*", nxt.alias("__next"))
    stop = F.greatest(F.coalesce(F.col("__next") - step, F.col("__end")), q(ts))
    gen = with_next.select(*[q(c) for c in df.columns], F.posexplode(F.sequence(q(ts), stop, step)).alias("__k", "__t"))
    present = F.col("__k") == 0
    out = []
    for c in df.columns:
        if c in keys:
            out.append(q(c))
        elif c == ts:
            out.append(F.col("__t").alias(ts))
        elif c.endswith(flag_suffix):
            out.append(F.when(present, q(c)).otherwise(F.lit(0)).cast("tinyint").alias(c))
        else:
            out.append(F.when(present, q(c)).alias(c))
    out.append(F.when(present, F.lit(0)).otherwise(F.lit(1)).cast("tinyint").alias(gap_col))
    return gen.select(*out)


def forward_fill(df: DataFrame, columns, key="entity_id", ts="ts") -> DataFrame:
    """Carry the last non-NULL value forward within each series."""
    cols = set(as_list(columns))
    w = series_window(key, ts).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(*[F.last(q(c), ignorenulls=True).over(w).alias(c) if c in cols else q(c)
                       for c in df.columns])
