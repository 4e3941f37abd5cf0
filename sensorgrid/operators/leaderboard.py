"""Score-table operators: normalise, union, de-duplicate, winners, averages, pivots.

A score table has one row per (model, pollutant, horizon_h) run with RMSE,
MAE, MAPE(%), R2. "Best row per group" is written as a ``min_by`` aggregate
over an explicit total order key, so it combines map-side instead of
sorting every row of a group in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgrid.functions.exprs import model_family, null_if_nan
from sensorgrid.operators.common import as_list, q

# Canonical row / column orders of the leaderboard reports.
POLLUTANTS = ("CO(GT)", "C6H6(GT)", "NOx(GT)", "NO2(GT)")
HORIZONS = (1, 6, 12, 24)
FAMILIES = ("Tree", "Linear/Kernel", "RNN")
SCORE_COLS = ("model", "pollutant", "horizon_h", "R2", "RMSE", "MAE", "MAPE(%)")
# Model-name patterns (case-insensitive substrings) used by the report filters.
NAIVE_PATTERNS = ("naive", "baseline")
RNN_PATTERNS = ("lstm", "gru")
TUNED_PATTERNS = ("tuned",)


def contains_any(col, patterns) -> Column:
    """Case-insensitive substring test against any pattern (NULL-safe: NULL -> false)."""
    s = F.lower(q(col) if isinstance(col, str) else col)
    cond = F.lit(False)
    for p in patterns:
        cond = cond | F.coalesce(s.contains(p.lower()), F.lit(False))
    return cond


def filter_models(df: DataFrame, include=None, exclude_patterns=(), model_col: str = "model") -> DataFrame:
    """Keep models in ``include`` (exact) and drop any matching an exclude pattern."""
    out = df
    if include is not None:
        out = out.where(q(model_col).isin(list(include)))
    if exclude_patterns:
        out = out.where(~contains_any(model_col, exclude_patterns))
    return out


def horizon_number(c: Column) -> Column:
    """6 from 6, '6', '6.0' or '6h'; NULL from anything else."""
    return null_if_nan(F.regexp_replace(c.cast("string"), "h$", "").try_cast("double")).try_cast("int")


def score_order(col: str = "R2", descending: bool = True) -> Column:
    """Sort key of a score: NaN counts as missing, missing comes last."""
    x = null_if_nan(q(col).cast("double"))
    return x.desc_nulls_last() if descending else x.asc_nulls_last()


def normalize_scores(df: DataFrame, required=SCORE_COLS) -> DataFrame:
    """Common score schema: ``MAPE`` -> ``MAPE(%)``, ``horizon`` '6h' -> ``horizon_h`` 6,
    numeric metrics coerced (bad text and NaN -> NULL), missing required columns added as NULL."""
    cols = set(df.columns)
    sel = []
    for c in df.columns:
        if c == "MAPE" and "MAPE(%)" not in cols:
            sel.append(q(c).alias("MAPE(%)"))
        elif c == "horizon" and "horizon_h" not in cols:
            sel.append(horizon_number(q(c)).alias("horizon_h"))
        else:
            sel.append(q(c))
    out = df.select(*sel)
    have = set(out.columns)
    extra = []
    for c in required:
        if c not in have:
            extra.append(F.lit(None).cast("string" if c in ("model", "pollutant") else "double").alias(c))
    out = out.select("*", *extra)
    num = {"R2", "RMSE", "MAE", "MAPE(%)"}
    return out.select(*[null_if_nan(q(c).try_cast("double")).alias(c) if c in num else
                        (horizon_number(q(c)).alias(c) if c == "horizon_h" else q(c)) for c in out.columns])


def union_scores(frames: dict, tag_col: str = "source") -> DataFrame:
    """Union of score tables with unlike columns, each tagged with its source name."""
    out = None
    for tag, df in frames.items():
        t = df.select("*", F.lit(tag).alias(tag_col))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def with_family(df: DataFrame, model_col: str = "model", out: str = "family") -> DataFrame:
    return df.select("*", model_family(q(model_col)).alias(out))


def _order_key(order) -> Column:
    """Struct sort key for min_by: (col, 'desc'|'asc') pairs, NULL and NaN last either way."""
    parts = []
    for i, (c, d) in enumerate(order):
        x = q(c) if isinstance(c, str) else c
        if d == "desc":
            x = null_if_nan(x.cast("double"))
        parts.append(x.isNull().alias(f"n{i}"))
        parts.append((-x if d == "desc" else x).alias(f"v{i}"))
    return F.struct(*parts)


def best_per_group(df: DataFrame, keys, order, keep=None) -> DataFrame:
    """First row of each ``keys`` group under ``order`` = [(col, 'asc'|'desc'), ...].

    ``order`` must be total within a group (end it with a unique column).
    Descending order is only allowed on numeric columns (it is negated).
    """
    keys = as_list(keys)
    rest = [c for c in (keep or df.columns) if c not in keys]
    agg = df.groupBy(*[q(k) for k in keys]).agg(
        F.min_by(F.struct(*[q(c) for c in rest]), _order_key(order)).alias("__b"))
    return agg.select(*[q(k) for k in keys], *[F.col("__b").getField(c).alias(c) for c in rest])


def first_values_per_group(df: DataFrame, keys, order, keep=None) -> DataFrame:
    """For each ``keys`` group and column the first value under ``order`` that is not null (or NaN),
    which may come from another row than the first: ``groupby().first()`` of a sorted table."""
    keys = as_list(keys)
    kinds = dict(df.dtypes)
    value = lambda c: null_if_nan(q(c)) if kinds[c] in ("double", "float") else q(c)
    rest = [c for c in (keep or df.columns) if c not in keys]
    return df.groupBy(*[q(k) for k in keys]).agg(
        *[F.min_by(value(c), F.when(value(c).isNotNull(), _order_key(order))).alias(c) for c in rest])


def dedup_keep_best(df: DataFrame, keys=("model", "pollutant", "horizon_h"), tiebreak="run_id") -> DataFrame:
    """One row per (model, pollutant, horizon_h): the highest R2 (ties: ``tiebreak`` asc)."""
    order = [("R2", "desc")] + [(t, "asc") for t in as_list(tiebreak)]
    return best_per_group(df, keys, order).select(*[q(c) for c in df.columns])


def overall_winners(df: DataFrame, tiebreak=("model", "run_id")) -> DataFrame:
    """Best model per (pollutant, horizon_h) by R2 (ties: model, then run id)."""
    order = [("R2", "desc")] + [(t, "asc") for t in as_list(tiebreak)]
    b = best_per_group(with_family(df), ["pollutant", "horizon_h"], order)
    return b.select("pollutant", "horizon_h", "model", "family", "R2", "RMSE", "MAE", q("MAPE(%)"))


def family_best_by_cell(df: DataFrame, families=FAMILIES, tiebreak=("model", "run_id")) -> DataFrame:
    """Best model per (pollutant, horizon_h, family) for the listed families."""
    fam = with_family(df).where(F.col("family").isin(list(families)))
    order = [("R2", "desc")] + [(t, "asc") for t in as_list(tiebreak)]
    b = best_per_group(fam, ["pollutant", "horizon_h", "family"], order)
    return b.select("pollutant", "horizon_h", "family", "model", "R2", "RMSE", "MAE", q("MAPE(%)"),
                    F.array_position(F.array(*[F.lit(f) for f in families]), F.col("family")).cast("int")
                    .alias("family_order"))


def family_r2_pivot(df: DataFrame, families=FAMILIES) -> DataFrame:
    """Best R2 per family for every (pollutant, horizon_h), one column per family in the fixed
    order (r2_tree, r2_linear_kernel, r2_rnn); a family without rows gives NULL. One
    partially aggregated group-by with conditional maxima (no pivot-value pass)."""
    f = with_family(df)
    names = {fam: "r2_" + fam.lower().replace("/", "_") for fam in families}
    return f.groupBy("pollutant", "horizon_h").agg(
        *[F.max(F.when(F.col("family") == fam, F.col("R2"))).alias(names[fam]) for fam in families])


def leaderboard_sort(df: DataFrame, tiebreak=("model", "run_id")) -> DataFrame:
    """Rows ordered by horizon_h asc, pollutant asc, R2 desc, with the rank inside each cell.

    The global order is a range-partitioned sort (no single-task window);
    ``cell_rank`` is a row_number per (horizon_h, pollutant).
    """
    from pyspark.sql import Window
    order = [score_order()] + [q(t).asc() for t in as_list(tiebreak)]
    w = Window.partitionBy("horizon_h", "pollutant").orderBy(*order)
    ranked = df.select("*", F.row_number().over(w).alias("cell_rank"))
    return ranked.orderBy(F.col("horizon_h").asc_nulls_last(), F.col("pollutant").asc_nulls_last(), *order)


def top_k_models(df: DataFrame, k: int = 10, tiebreak=("model", "run_id")) -> DataFrame:
    """Global top-k rows by R2 (a per-partition top-k then one merge of k rows each)."""
    return df.orderBy(score_order(), *[q(t).asc() for t in as_list(tiebreak)]).limit(k)


def top_k_per_cell(df: DataFrame, k: int = 5, tiebreak=("model", "run_id")) -> DataFrame:
    """Per (pollutant, horizon_h): the best run of each model, then the first ``k`` by R2, with ``rank``.

    The best run combines map-side; a cell then holds one row per model."""
    from pyspark.sql import Window
    best = dedup_keep_best(df, tiebreak=[t for t in as_list(tiebreak) if t != "model"])
    w = Window.partitionBy("pollutant", "horizon_h").orderBy(score_order(), *[q(t).asc() for t in as_list(tiebreak)])
    return best.select("*", F.row_number().over(w).alias("rank")).where(F.col("rank") <= k)


# Fixed value: the columns on which two rows are the same run.
DISTINCT_COLS = ("model", "pollutant", "horizon_h", "RMSE", "MAE", "R2")


def drop_exact_duplicates(df: DataFrame, subset=DISTINCT_COLS) -> DataFrame:
    """One row per distinct ``subset``; of the other columns the smallest values, so reruns agree."""
    subset = [c for c in subset if c in df.columns]
    rest = [c for c in df.columns if c not in subset]
    if not rest:
        return df.select(*[q(c) for c in subset]).distinct()
    row = F.min(F.struct(*[q(c) for c in rest])).alias("__row")
    one = df.groupBy(*[q(c) for c in subset]).agg(row)
    return one.select(*[F.col("__row").getField(c).alias(c) if c in rest else q(c) for c in df.columns])


def collapse_max_r2(df: DataFrame, keys=("pollutant", "model", "family", "horizon_h")) -> DataFrame:
    return df.groupBy(*[q(k) for k in keys]).agg(F.max(null_if_nan(F.col("R2"))).alias("R2"))


def top3_by_pollutant(df: DataFrame, k: int = 3) -> DataFrame:
    """Per pollutant: collapse to max R2 per (model, family, horizon), keep top k by R2 desc,
    horizon asc (then model asc), with the label 'model (family, 6h)'."""
    from pyspark.sql import Window
    c = collapse_max_r2(with_family(df))
    w = Window.partitionBy("pollutant").orderBy(F.col("R2").desc_nulls_last(), F.col("horizon_h").asc(),
                                                F.col("model").asc())
    r = c.select("*", F.row_number().over(w).alias("rank")).where(F.col("rank") <= k)
    return r.select("pollutant", "rank", "model", "family", "horizon_h", "R2",
                    F.format_string("%s (%s, %dh)", F.col("model"), F.col("family"), F.col("horizon_h"))
                    .alias("label"))


def report_filter(df: DataFrame, drop_naive: bool = True, drop_rnn: bool = True) -> DataFrame:
    """Drop rows without pollutant / horizon / R2, then naive/baseline and/or RNN models."""
    pats = (NAIVE_PATTERNS if drop_naive else ()) + (RNN_PATTERNS if drop_rnn else ())
    out = df.where(F.col("pollutant").isNotNull() & F.col("horizon_h").isNotNull() & null_if_nan(F.col("R2")).isNotNull())
    return filter_models(out, exclude_patterns=pats)


def _mean_std(cols=("R2", "RMSE", "MAE")) -> list[Column]:
    out = []
    for c in cols:
        out += [F.avg(q(c)).alias(f"{c}_mean"), F.stddev_samp(q(c)).alias(f"{c}_std")]
    return out


def avg_by(df: DataFrame, by: str, tiebreak="run_id") -> DataFrame:
    """Mean and sample std of R2 / RMSE / MAE per ``by``, after dropping naive and RNN
    models and keeping the best R2 per (model, pollutant, horizon)."""
    best = dedup_keep_best(report_filter(df), tiebreak=tiebreak)
    return best.groupBy(q(by)).agg(*_mean_std())


def avg_by_pollutant(df: DataFrame, tiebreak="run_id") -> DataFrame:
    return avg_by(df, "pollutant", tiebreak)


def avg_by_horizon(df: DataFrame, tiebreak="run_id") -> DataFrame:
    return avg_by(df, "horizon_h", tiebreak)


def avg_by_model(df: DataFrame, tiebreak="run_id") -> DataFrame:
    """Mean RMSE / MAE / R2 per model (RNN dropped, naive kept), best run per cell first."""
    best = dedup_keep_best(report_filter(df, drop_naive=False), tiebreak=tiebreak)
    return best.groupBy("model").agg(F.avg("RMSE").alias("RMSE"), F.avg("MAE").alias("MAE"), F.avg("R2").alias("R2"))


def win_counts(winners: DataFrame) -> DataFrame:
    """How many (pollutant, horizon) cells each model wins."""
    return winners.groupBy("model").agg(F.count(F.lit(1)).alias("wins")).orderBy(F.col("wins").desc(), "model")


def pivot_scores(df: DataFrame, index: str = "pollutant", column: str = "horizon_h", value: str = "R2",
                 values=HORIZONS, prefix: str = "h") -> DataFrame:
    """Matrix view: one row per ``index``, one column per listed ``column`` value (missing -> NULL).

    Conditional aggregation with a fixed value list (no extra pass to find
    pivot values); expects one row per cell (e.g. winners).
    """
    return df.groupBy(q(index)).agg(*[F.max(F.when(q(column) == v, q(value))).alias(f"{prefix}{v}")
                                      for v in values])


def distinct_models(df: DataFrame, model_col: str = "model") -> DataFrame:
    return df.select(q(model_col)).distinct()


def categorical_order(df: DataFrame, col: str, order, out: str | None = None) -> DataFrame:
    """Sort key = position of ``col`` in a fixed list (1-based; unknown -> NULL, sorted last)."""
    pos = F.array_position(F.array(*[F.lit(v) for v in order]), q(col))
    pos = F.when(pos > 0, pos).cast("int")
    return df.select("*", pos.alias(out or f"{col}_order"))


def score_labels(df: DataFrame) -> DataFrame:
    """Plot labels: 'model (family, 6h)' and cell text 'model\\nR2=0.812'."""
    d = with_family(df) if "family" not in df.columns else df
    return d.select("*", F.format_string("%s (%s, %dh)", F.col("model"), F.col("family"), F.col("horizon_h"))
                    .alias("label"),
                    F.format_string("%s\nR2=%.3f", F.col("model"), F.round(F.col("R2") + F.signum("R2") * F.lit(1e-9), 3)).alias("cell_text"))
