"""Cleaning operators: sentinel, dedup, missing flags, imputation, winsorizing, scaling.

Per-series statistics (median, quartiles, mean/std) are computed as unordered
window aggregates partitioned by the series key. That keeps them on the same
hash partitioning the later ordered windows need, so the whole preparation
plan shuffles the readings once by key and never joins a statistics table
back. ``by=None`` means one statistic over all rows (two scalars per column,
computed in one job and inlined as literals).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgrid.functions.columns import numeric_columns
from sensorgrid.functions.exprs import null_if_nan
from sensorgrid.operators.common import as_list, global_scalars, group_window, q, select_replacing
from sensorgrid.operators.quantiles import with_quantiles

SENTINEL = -200.0  # fixed value: raw feed code for "no reading"
MISSING_SUFFIX = "__was_missing"


def _numeric(df: DataFrame, columns, key) -> list[str]:
    if columns is not None:
        return as_list(columns)
    return numeric_columns(df, exclude=as_list(key))


def sentinel_to_null(df: DataFrame, columns=None, sentinel: float = SENTINEL, key="entity_id") -> DataFrame:
    """Sentinel value -> NULL (and NaN -> NULL) in every numeric column."""
    cols = _numeric(df, columns, key)
    rep = {c: F.when(q(c) == F.lit(sentinel), F.lit(None)).otherwise(q(c)) for c in cols}
    for f in df.schema.fields:
        if f.name in rep and f.dataType.typeName() in ("double", "float"):
            rep[f.name] = null_if_nan(rep[f.name])
    return select_replacing(df, rep)


def drop_null_keys(df: DataFrame, subset=("ts",)) -> DataFrame:
    """Drop rows whose required key columns are NULL."""
    cond = F.lit(True)
    for c in as_list(subset):
        cond = cond & q(c).isNotNull()
    return df.where(cond)


def dedup_first(df: DataFrame, keys=("entity_id", "ts"), order_by=None) -> DataFrame:
    """Keep one row per ``keys``: the first by ``order_by`` (a total tie-break); of columns
    named there, a reading comes before a missing one.

    Written as ``min_by(struct(row), struct(order))`` in a hash aggregate, so
    duplicates collapse map-side before the shuffle (a row_number window would
    ship and sort every duplicate).
    """
    keys = as_list(keys)
    order = as_list(order_by)
    if not order:
        raise ValueError("dedup_first needs an explicit tie-break order (pandas' order is unstable)")
    rest = [c for c in df.columns if c not in keys]
    picked = (df.groupBy(*[q(k) for k in keys])
                .agg(F.min_by(F.struct(*[q(c) for c in rest]),
                              F.struct(*[x for c in order for x in ([q(c).isNull(), q(c)] if isinstance(c, str) else [c])])).alias("__row")))
    return picked.select(*[q(k) for k in keys], *[F.col("__row").getField(c).alias(c) for c in rest]) \
                 .select(*[q(c) for c in df.columns])


def missing_flags(df: DataFrame, columns=None, key="entity_id", suffix: str = MISSING_SUFFIX) -> DataFrame:
    """Append ``<c>__was_missing`` TINYINT flags (1 where c is NULL)."""
    cols = _numeric(df, columns, key)
    return df.select("*", *[q(c).isNull().cast("tinyint").alias(f"{c}{suffix}") for c in cols])


def _scoped(c: Column, scope: Column | None) -> Column:
    return c if scope is None else F.when(scope, c)


def _stat(df: DataFrame, fn, cols, by, scope):
    """Per-group statistic as window aggregate, or global statistic as literal."""
    keys = as_list(by)
    if keys:
        w = group_window(keys)
        return {c: fn(_scoped(q(c), scope)).over(w) for c in cols}
    vals = global_scalars(df, {c: fn(_scoped(q(c), scope)) for c in cols})
    return {c: F.lit(vals[c]) for c in cols}


def median_impute(df: DataFrame, columns=None, by="entity_id", scope: Column | None = None,
                  exact: bool | str = True) -> DataFrame:
    """NULL -> median of the column (per ``by`` group; ``scope`` limits the fit rows).

    ``exact`` uses ``percentile`` (linear interpolation, as pandas), which holds a group's
    distinct values in one task; ``"ranks"`` selects the same value over range partitions, for
    groups of any size; False uses the bounded-memory ``percentile_approx`` sketch.
    """
    cols = _numeric(df, columns, by)
    if exact == "ranks":
        x = with_quantiles(df, cols, (0.5,), by, scope)
        return select_replacing(x, {c: F.coalesce(q(c), F.col(f"__q{i}")[0]) for i, c in enumerate(cols)}).select(*[q(c) for c in df.columns])
    fn = (lambda c: F.percentile(c, 0.5)) if exact else (lambda c: F.percentile_approx(c, 0.5, 10000))
    med = _stat(df, fn, cols, by, scope)
    return select_replacing(df, {c: F.coalesce(q(c), med[c].cast("double")) for c in cols})


def winsorize_iqr(df: DataFrame, columns=None, by="entity_id", k: float = 3.0,
                  scope: Column | None = None, exact: bool | str = True) -> DataFrame:
    """Clip to [q1 - k*IQR, q3 + k*IQR] with linear-interpolated quartiles; ``exact`` as in
    :func:`median_impute`."""
    cols = _numeric(df, columns, by)
    if exact == "ranks":
        x = with_quantiles(df, cols, (0.25, 0.75), by, scope)
        return select_replacing(x, {c: _clipped(q(c), F.col(f"__q{i}")[0], F.col(f"__q{i}")[1], k) for i, c in enumerate(cols)}).select(*[q(c) for c in df.columns])
    if exact:
        fn = lambda c: F.percentile(c, F.array(F.lit(0.25), F.lit(0.75)))
    else:
        fn = lambda c: F.percentile_approx(c, F.array(F.lit(0.25), F.lit(0.75)), 10000)
    qs = _stat(df, fn, cols, by, scope)
    rep = {}
    for c in cols:
        q1 = qs[c].getItem(0).cast("double")
        q3 = qs[c].getItem(1).cast("double")
        rep[c] = _clipped(q(c), q1, q3, k)
    return select_replacing(df, rep)


def _clipped(x: Column, q1: Column, q3: Column, k: float) -> Column:
    iqr = q3 - q1
    return F.least(F.greatest(x, q1 - F.lit(k) * iqr), q3 + F.lit(k) * iqr)


def standardize(df: DataFrame, columns=None, by=None, scope: Column | None = None) -> DataFrame:
    """(x - mean) / std_pop, NULLs ignored, std 0 -> 1 (sklearn ``StandardScaler``).

    ``scope`` restricts the fit rows (e.g. ``col('split') == 'train'``); the
    reference fits on every row, which leaks the test period.
    """
    cols = _numeric(df, columns, by)
    keys = as_list(by)
    if keys:
        means, sds = _stat(df, F.avg, cols, keys, scope), _stat(df, F.stddev_pop, cols, keys, scope)
    else:  # both scalars of every column in one job
        got = global_scalars(df, {f"{fn.__name__}:{c}": fn(_scoped(q(c), scope)) for c in cols for fn in (F.avg, F.stddev_pop)})
        means, sds = ({c: F.lit(got[f"{fn.__name__}:{c}"]) for c in cols} for fn in (F.avg, F.stddev_pop))
    rep = {}
    for c in cols:
        s = sds[c].cast("double")
        rep[c] = (q(c) - means[c].cast("double")) / F.when(s == 0, F.lit(1.0)).otherwise(s)
    return select_replacing(df, rep)


def coerce_numeric(df: DataFrame, columns) -> DataFrame:
    """Cast to DOUBLE with unparsable values and the text ``NaN`` -> NULL."""
    return select_replacing(df, {c: null_if_nan(q(c).try_cast("double")) for c in as_list(columns)})


def non_constant_columns(df: DataFrame, columns=None, key="entity_id") -> DataFrame:
    """One row per column: (column, min, max, varying). ``varying`` = more than one distinct
    non-NULL value, computed as min <> max in a single partially-aggregated pass (a distinct
    count per column would need one exchange per column)."""
    cols = _numeric(df, columns, key)
    aggs = []
    for i, c in enumerate(cols):
        x = q(c).cast("double")
        aggs += [F.min(x).alias(f"__lo{i}"), F.max(x).alias(f"__hi{i}")]
    wide = df.agg(*aggs)
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"__lo{i}").alias("min"), F.col(f"__hi{i}").alias("max"))
             for i, c in enumerate(cols)]
    long = wide.select(F.explode(F.array(*cells)).alias("s"))
    return long.select("s.column", "s.min", "s.max",
                       F.coalesce(F.col("s.min") != F.col("s.max"), F.lit(False)).alias("varying"))
