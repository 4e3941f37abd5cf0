"""Shared helpers: series windows, size-checked broadcast, driver-side scalars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

# Largest number of rows we let a side be broadcast with. Above it the join
# falls back to a shuffle join (and AQE may still convert it at runtime).
BROADCAST_MAX_ROWS = 2_000_000


def as_list(x) -> list:
    if x is None:
        return []
    if isinstance(x, (list, tuple)):
        return list(x)
    return [x]


def series_window(key="entity_id", ts="ts") -> WindowSpec:
    """Ordered window over one series. ``ts`` must be unique per key (total order)."""
    return Window.partitionBy(*as_list(key)).orderBy(*as_list(ts))


def group_window(key) -> WindowSpec:
    """Unordered whole-group window (per-key statistics without a join)."""
    keys = as_list(key)
    return Window.partitionBy(*keys) if keys else Window.partitionBy()


def q(name: str) -> Column:
    """Column by name, quoting names with dots or parentheses."""
    return F.col(f"`{name}`")


def bounded_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Broadcast ``small`` only if it provably has at most ``max_rows`` rows.

    The check is a ``limit(max_rows + 1).count()`` job on the (already
    aggregated) small side. Past the bound the side is returned unchanged so
    the join shuffles instead of exploding executor memory.
    """
    n = small.limit(max_rows + 1).count()
    return F.broadcast(small) if n <= max_rows else small


def checked_broadcast(small: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Persist a small aggregate, count it, and broadcast it only under the row bound.

    Unlike ``bounded_broadcast`` the count also materialises the cache, so the
    join does not recompute the aggregate. Over the bound the side is left to
    a shuffle join (AQE may still split skewed partitions of the big side).
    """
    cached = small.persist()
    n = cached.count()
    return F.broadcast(cached) if n <= max_rows else cached


def global_scalars(df: DataFrame, aggs: dict) -> dict:
    """Compute a handful of global aggregates and return them as Python values.

    One job returning one row; use only for a fixed, small number of scalars.
    """
    row = df.agg(*[expr.alias(name) for name, expr in aggs.items()]).first()
    return row.asDict() if row is not None else {k: None for k in aggs}


def select_replacing(df: DataFrame, replacements: dict, extra: list | None = None) -> DataFrame:
    """One ``select`` that swaps some columns for expressions and appends others.

    Used instead of a ``withColumn`` loop so wide feature packs analyse fast.
    """
    cols = []
    for c in df.columns:
        cols.append(replacements[c].alias(c) if c in replacements else q(c))
    return df.select(*cols, *(extra or []))
