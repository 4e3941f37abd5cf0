"""Null-safe scoring and profiling aggregates.

All metrics are single-pass, partially aggregatable expressions (sums,
counts, variances), so scoring a prediction table of any size is a map-side
combine plus one small shuffle on the group keys.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgrid.operators.common import as_list, global_scalars, q
from sensorgrid.operators.quantiles import exact_quantiles


def _both(y: Column, p: Column) -> Column:
    return y.isNotNull() & p.isNotNull() & ~F.isnan(y) & ~F.isnan(p)


def regression_metric_exprs(y: str = "y_true", p: str = "y_pred", constant_y: str = "sklearn") -> list[Column]:
    """n, RMSE, MAE, MAPE(%), R2 over rows where both sides are present.

    MAPE also skips y = 0. R2 = 1 - SS_res / SS_tot; when y is constant
    (SS_tot = 0) sklearn returns 1.0 for a perfect fit and 0.0 otherwise
    (``constant_y='sklearn'``); ``constant_y='null'`` gives NULL instead.
    """
    yc, pc = q(y).cast("double"), q(p).cast("double")
    ok = _both(yc, pc)
    yy, pp = F.when(ok, yc), F.when(ok, pc)
    err = yy - pp
    n = F.count(err)
    ss_res = F.sum(err * err)
    ss_tot = F.var_pop(yy) * n
    if constant_y == "sklearn":
        r2_const = F.when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    else:
        r2_const = F.lit(None).cast("double")
    r2 = F.when(n == 0, F.lit(None)).when(ss_tot == 0, r2_const).otherwise(F.lit(1.0) - ss_res / ss_tot)
    mape = F.avg(F.when(yy != 0, F.abs(err / yy))) * 100
    return [n.alias("n"), F.sqrt(F.avg(err * err)).alias("RMSE"), F.avg(F.abs(err)).alias("MAE"),
            mape.alias("MAPE(%)"), r2.cast("double").alias("R2")]


def regression_metrics(df: DataFrame, y: str = "y_true", p: str = "y_pred", by=None,
                       constant_y: str = "sklearn") -> DataFrame:
    """One score row per ``by`` group (G1-G4)."""
    keys = as_list(by)
    ex = regression_metric_exprs(y, p, constant_y)
    return df.groupBy(*[q(k) for k in keys]).agg(*ex) if keys else df.agg(*ex)


def _class_counts(df: DataFrame, y: str, p: str, keys: list[str], weight: str | None = None) -> DataFrame:
    """Confusion counts (group, y, p, cnt) over rows with both labels present; ``weight``: a row stands for so many."""
    ok = df.where(q(y).isNotNull() & q(p).isNotNull())
    return ok.groupBy(*[q(k) for k in keys], q(y).cast("int").alias("__y"), q(p).cast("int").alias("__p")) \
             .agg((F.sum(q(weight)) if weight else F.count(F.lit(1))).alias("__cnt"))


def per_class_stats(df: DataFrame, y: str = "y_true", p: str = "y_pred", by=None, weight: str | None = None) -> DataFrame:
    """(group, cls, support, predicted, tp) for every class seen in y or p."""
    keys = as_list(by)
    cc = _class_counts(df, y, p, keys, weight)
    k = [q(c) for c in keys]
    # each count row serves its true and its predicted class; exploded, so that what made the rows runs once
    none, cnt = F.lit(0).cast("bigint"), F.col("__cnt")
    truth = F.struct(F.col("__y").alias("cls"), cnt.alias("support"), none.alias("predicted"),
                     F.when(F.col("__y") == F.col("__p"), cnt).otherwise(none).alias("tp"))
    pred = F.struct(F.col("__p").alias("cls"), none.alias("support"), cnt.alias("predicted"), none.alias("tp"))
    return cc.select(*k, F.explode(F.array(truth, pred)).alias("__c")).select(*k, "__c.*").groupBy(*k, "cls").agg(
        F.sum("support").alias("support"), F.sum("predicted").alias("predicted"), F.sum("tp").alias("tp"))


def classification_metrics(df: DataFrame, y: str = "y_true", p: str = "y_pred", by=None, weight: str | None = None) -> DataFrame:
    """accuracy, macro and weighted precision / recall / F1 with zero_division = 0 (G5-G7).

    Classes = union of labels present in y or p (sklearn's default). ``weight``: rows of counts.
    """
    keys = as_list(by)
    st = per_class_stats(df, y, p, keys, weight)
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("predicted")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * F.col("tp"), F.col("predicted") + F.col("support")), F.lit(0.0))
    st = st.select("*", prec.cast("double").alias("__p"), rec.cast("double").alias("__r"), f1.cast("double").alias("__f"))
    sup = F.sum("support")
    agg = [
        (F.sum("tp") / sup).alias("accuracy"),
        F.avg("__p").alias("precision_macro"), F.avg("__r").alias("recall_macro"), F.avg("__f").alias("f1_macro"),
        (F.sum(F.col("__p") * F.col("support")) / sup).alias("precision_weighted"),
        (F.sum(F.col("__r") * F.col("support")) / sup).alias("recall_weighted"),
        (F.sum(F.col("__f") * F.col("support")) / sup).alias("f1_weighted"),
        sup.alias("n"),
    ]
    return st.groupBy(*[q(c) for c in keys]).agg(*agg) if keys else st.agg(*agg)


def confusion_matrix(df: DataFrame, y: str = "y_true", p: str = "y_pred", labels=(0, 1, 2), by=None) -> DataFrame:
    """Rows = true class (every label), columns pred_<label> = counts (zero-filled)."""
    k = [q(c) for c in as_list(by)]
    ok = df.where(q(y).isNotNull() & q(p).isNotNull())
    counts = [F.count_if((q(y) == t) & (q(p) == lab)).alias(f"__{i}_{j}") for i, t in enumerate(labels) for j, lab in enumerate(labels)]
    wide = ok.groupBy(*k).agg(*counts) if k else ok.agg(*counts)
    rows = [F.struct(F.lit(t).alias("y_true"), *[F.col(f"__{i}_{j}").alias(f"pred_{lab}") for j, lab in enumerate(labels)])
            for i, t in enumerate(labels)]
    return wide.select(*k, F.explode(F.array(*rows)).alias("__r")).select(*k, "__r.*")


def class_distribution(df: DataFrame, cls: str = "target_cls", by="split", labels=(0, 1, 2)) -> DataFrame:
    """Zero-filled count of each label per group (bincount)."""
    k = [q(c) for c in as_list(by)]
    wide = df.groupBy(*k).agg(*[F.count_if(q(cls) == lab).alias(f"__{i}") for i, lab in enumerate(labels)])
    rows = [F.struct(F.lit(lab).alias("cls"), F.col(f"__{i}").alias("n")) for i, lab in enumerate(labels)]
    return wide.select(*k, F.explode(F.array(*rows)).alias("__r")).select(*k, "__r.*")


def column_profile(df: DataFrame, columns, exact: bool = True) -> DataFrame:
    """``describe``: one row per column with count, mean, std, min, 25/50/75 %, max.

    One partially aggregated pass over all columns; the quartiles are selected by rank over
    range partitions (``exact``) or come from the bounded sketch.
    """
    cols, probs = as_list(columns), (0.25, 0.5, 0.75)
    aggs = []
    for i, c in enumerate(cols):
        x = q(c).cast("double")
        aggs.append(F.struct(F.lit(c).alias("column"), F.count(x).alias("count"), F.avg(x).alias("mean"),
                             F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max")).alias(f"__s{i}"))
        if not exact:
            aggs.append(F.percentile_approx(x, F.array(*[F.lit(p) for p in probs]), 10000).cast("array<double>").alias(f"__q{i}"))
    wide = df.agg(*aggs)
    if exact:
        found = exact_quantiles(df, cols, probs).first()  # one row: three numbers a column
        wide = wide.select("*", *[F.array(*[F.lit(v).cast("double") for v in found[f"__q{i}"]]).alias(f"__q{i}") for i in range(len(cols))])
    long = wide.select(F.explode(F.array(*[F.struct(F.col(f"__s{i}").alias("s"), F.col(f"__q{i}").alias("q")) for i in range(len(cols))])).alias("x"))
    return long.select("x.s.column", "x.s.count", "x.s.mean", "x.s.std", "x.s.min",
                       *[F.col("x.q").getItem(j).alias(n) for j, n in enumerate(("p25", "p50", "p75"))], "x.s.max")


def rows_per_year(df: DataFrame, ts: str = "ts", by=None) -> DataFrame:
    keys = as_list(by)
    return df.groupBy(*[q(c) for c in keys], F.year(q(ts)).alias("year")).agg(F.count(F.lit(1)).alias("n_rows"))


def residual_histogram(df: DataFrame, y: str = "y_true", p: str = "y_pred", bins: int = 30, by=None) -> DataFrame:
    """Equal-width histogram of |y - p| (the maximum falls in the last bin), one per ``by`` group.

    The range is two global scalars (one small job), or a group-by joined back; the
    histogram itself is a partially-aggregated group-by on the bin id.
    """
    ok = df.where(_both(q(y).cast("double"), q(p).cast("double")))
    r = F.abs(q(y) - q(p))
    if by:
        keys = as_list(by)
        rows = ok.select(*[q(k) for k in keys], r.alias("__r"))
        span = rows.groupBy(*[q(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.min("__r").alias("__lo"), F.max("__r").alias("__hi"))
        on = [q(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
        width = F.when(F.col("__hi") > F.col("__lo"), (F.col("__hi") - F.col("__lo")) / bins).otherwise(1.0)
        b = F.least(F.floor((F.col("__r") - F.col("__lo")) / width) + 1, F.lit(bins)).cast("int")
        h = rows.join(span, on).groupBy(*[q(k) for k in keys], "__lo", width.alias("__width"), b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
        return h.select(*[q(k) for k in keys], "bin", (F.col("__lo") + (F.col("bin") - 1) * F.col("__width")).alias("lo"),
                        (F.col("__lo") + F.col("bin") * F.col("__width")).alias("hi"), "n")
    s = global_scalars(ok, {"lo": F.min(r), "hi": F.max(r)})
    lo, hi = s["lo"], s["hi"]
    if lo is None:
        return ok.select(F.lit(0).alias("bin"), F.lit(0.0).alias("lo"), F.lit(0.0).alias("hi"),
                         F.lit(0).cast("bigint").alias("n")).limit(0)
    width = (hi - lo) / bins if hi > lo else 1.0
    b = F.least(F.floor((r - F.lit(lo)) / F.lit(width)) + 1, F.lit(bins)).cast("int")
    h = ok.groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    return h.select("bin", (F.lit(lo) + (F.col("bin") - 1) * F.lit(width)).alias("lo"),
                    (F.lit(lo) + F.col("bin") * F.lit(width)).alias("hi"), "n")


def value_spans(df: DataFrame, y: str = "y_true", p: str = "y_pred", by=None) -> DataFrame:
    """Least and greatest truth and prediction of the pairs that have both, and the span of the two
    together (the diagonal of a truth / prediction plot), one row per ``by`` group."""
    a, b = q(y).cast("double"), q(p).cast("double")
    keys = [q(k) for k in as_list(by)]
    spans = df.where(_both(a, b)).groupBy(*keys).agg(
        F.min(a).alias("y_true_min"), F.max(a).alias("y_true_max"), F.min(b).alias("y_pred_min"), F.max(b).alias("y_pred_max"), F.count(F.lit(1)).alias("n"))
    return spans.withColumns({"lo": F.least("y_true_min", "y_pred_min"), "hi": F.greatest("y_true_max", "y_pred_max")})


# Fixed probabilities for the residual Q-Q table.
QQ_PROBS = (0.01, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def residual_quantiles(df: DataFrame, y: str = "y_true", p: str = "y_pred", probs=QQ_PROBS,
                       by=None, exact: bool = True) -> DataFrame:
    """Empirical quantiles of y - p beside standard-normal quantiles (Q-Q points)."""
    keys = as_list(by)
    ok = df.where(_both(q(y).cast("double"), q(p).cast("double")))
    res = (q(y) - q(p)).cast("double")
    arr = F.array(*[F.lit(float(x)) for x in probs])
    if exact:
        agg = exact_quantiles(ok.select(*[q(c) for c in keys], res.alias("__res")), "__res", probs, keys).withColumnRenamed("__q0", "__q")
    else:
        pct = F.percentile_approx(res, arr, 10000).cast("array<double>")
        agg = (ok.groupBy(*[q(c) for c in keys]) if keys else ok.groupBy()).agg(pct.alias("__q"))
    normal = [NormalDist().inv_cdf(x) for x in probs]
    cells = F.arrays_zip(arr.alias("prob"), F.col("__q").alias("residual_q"),
                         F.array(*[F.lit(v) for v in normal]).alias("normal_q"))
    out = agg.select(*[q(c) for c in keys], F.explode(cells).alias("c"))
    return out.select(*[q(c) for c in keys], "c.prob", "c.residual_q", "c.normal_q")
