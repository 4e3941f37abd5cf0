"""Exact quantiles by rank selection over range partitions.

The values of all columns become long rows (group, column, value), sorted by range partition.
Counts per group and partition, summed up in order, tell in which partition and at which place
the value of any rank lies, and only those rows are picked. A quantile is the linear
interpolation of its two neighbours, as with Spark's ``percentile``, but no task holds the
distinct values of a group: one group may hold all rows.

The values are shuffled once; what is broadcast or joined is one row a group, column and rank.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorgrid.operators.common import as_list, bounded_broadcast, q
from sensorgrid.operators.positions import PART, PLACE, group_parts, ordered_positions
from sensorgrid.session import scratch_path


def exact_quantiles(df: DataFrame, columns, probs, by=None, scope: Column | None = None) -> DataFrame:
    """One row for each ``by`` group, with an array ``__q<i>`` of the quantiles ``probs`` of the
    i-th column over its non-null (and non-NaN) values, null if it has none. ``scope`` limits the rows that count."""
    cols, keys = as_list(columns), as_list(by)
    groups = [f"__g{i}" for i in range(len(keys))]
    cells = [F.struct(F.lit(i).alias("c"), F.nanvl((q(c) if scope is None else F.when(scope, q(c))).cast("double"), F.lit(None)).alias("v")) for i, c in enumerate(cols)]
    long = df.select(*[q(k).alias(g) for k, g in zip(keys, groups)], F.explode(F.array(*cells)).alias("x"))
    long = long.select(*groups, F.col("x.c").alias("__c"), F.col("x.v").alias("__v")).where("__v IS NOT NULL")
    group = [*groups, "__c"]
    ordered = ordered_positions(long, [F.col(g) for g in group] + [F.col("__v")], scratch_path(df.sparkSession, "quantiles"))
    parts = group_parts(ordered, group)
    # ranks wanted of each group; each lies in the one partition whose rows reach over it
    wanted = [F.struct(F.lit(i).alias("p"), (F.lit(float(p)) * (F.col("__n") - 1)).alias("at")) for i, p in enumerate(probs)]
    ranks = parts.select("*", F.explode(F.array(*wanted)).alias("w")).select("*", F.explode(F.array_distinct(F.array(F.floor("w.at"), F.ceil("w.at")))).alias("__rank"))
    ranks = ranks.where((F.col("__rank") >= F.col("__before")) & (F.col("__rank") < F.col("__before") + F.col("__rows")))
    ranks = ranks.select(*[F.col(g).alias(f"{g}_") for g in group], "w.p", "w.at", "__rank", PART, (F.col("__start") + F.col("__rank") - F.col("__before")).alias(PLACE))
    picked = ordered.select(PART, PLACE, "__v").join(bounded_broadcast(ranks), [PART, PLACE])
    out = [f"{g}_" for g in groups]
    share = F.when(F.col("__rank") == F.col("at"), 1.0).otherwise(1 - F.abs(F.col("at") - F.col("__rank")))
    each = picked.groupBy(*out, "__c_", "p").agg(F.sum(F.col("__v") * share).alias("v"))
    lists = each.groupBy(*out).agg(*[
        F.array(*[F.max(F.when((F.col("__c_") == i) & (F.col("p") == j), F.col("v"))) for j in range(len(probs))]).alias(f"__q{i}") for i in range(len(cols))])
    return lists.select(*[F.col(o).alias(k) for o, k in zip(out, keys)], *[F.col(f"__q{i}") for i in range(len(cols))])


def with_quantiles(df: DataFrame, columns, probs, by=None, scope: Column | None = None) -> DataFrame:
    """``df`` with the arrays of :func:`exact_quantiles` of each row's group."""
    keys, cols = as_list(by), as_list(columns)
    found = exact_quantiles(df, cols, probs, keys, scope)
    if not keys:
        got = found.first()  # one row of len(columns) x len(probs) numbers
        lists = [(got[f"__q{i}"] if got else None) or [None] * len(probs) for i in range(len(cols))]
        return df.select("*", *[F.array(*[F.lit(v).cast("double") for v in x]).alias(f"__q{i}") for i, x in enumerate(lists)])
    found = found.select(*[q(k).alias(f"__k{i}") for i, k in enumerate(keys)], *[f"__q{i}" for i in range(len(cols))])
    return df.join(bounded_broadcast(found), [q(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)], "left").drop(*[f"__k{i}" for i in range(len(keys))])
