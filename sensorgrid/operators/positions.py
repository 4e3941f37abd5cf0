"""Positions of rows in a total order, without a window over the whole table.

:func:`ordered_positions` sorts by range partitions and writes each row with its partition and
its place in it; :func:`successors` and :func:`global_positions` turn the two into neighbours
and running numbers with one small row per partition. No task ever sees more than its range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PART, PLACE = "__part", "__place"


def ordered_positions(df: DataFrame, order: list[Column], path: str) -> DataFrame:
    """``df`` with its range partition (``__part``) and place in it from 0 (``__place``), in
    ``order``. Range bounds come from a sample, so the rows are written to ``path`` once and
    what reads them again sees the same numbers."""
    at = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.select("*", F.shiftright(at, 33).cast("int").alias(PART), at.bitwiseAND(F.lit((1 << 33) - 1)).alias(PLACE))
    dealt.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(dealt.schema).parquet(path)


def part_sizes(ordered: DataFrame) -> DataFrame:
    """One row for each non-empty range partition: its size, the rows before it, the next part and
    the first one. There are at most as many as shuffle partitions: one window over them is small."""
    sizes = ordered.groupBy(PART).agg(F.count("*").alias("__size"))
    w = Window.orderBy(PART)
    ahead = w.rowsBetween(Window.unboundedPreceding, -1)
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return sizes.select(PART, "__size", F.coalesce(F.sum("__size").over(ahead), F.lit(0)).alias("__before"),
                        F.lead(PART).over(w).alias("__next"), F.first(PART).over(whole).alias("__first"))


def global_positions(ordered: DataFrame, name: str = "position") -> DataFrame:
    """``ordered`` with the 0-based position of each row over all partitions."""
    sizes = part_sizes(ordered).select(PART, "__before")
    return ordered.join(F.broadcast(sizes), PART).withColumn(name, F.col("__before") + F.col(PLACE)).drop("__before")


def successors(ordered: DataFrame, columns: list[str], prefix: str = "next_", circular: bool = False) -> DataFrame:
    """Each row with ``columns`` of the row after it; of the first row after the last one if
    ``circular``, else null."""
    sizes = part_sizes(ordered)
    if circular:
        sizes = sizes.withColumn("__next", F.coalesce("__next", "__first"))
    rows = ordered.join(F.broadcast(sizes.select(PART, "__size", "__next")), PART)
    ends = F.col(PLACE) + 1 == F.col("__size")
    rows = rows.withColumns({"__to_part": F.when(ends, F.col("__next")).otherwise(F.col(PART)),
                             "__to_place": F.when(ends, F.lit(0)).otherwise(F.col(PLACE) + 1)}).drop("__size", "__next")
    after = ordered.select(F.col(PART).alias("__to_part"), F.col(PLACE).alias("__to_place"), *[F.col(c).alias(prefix + c) for c in columns])
    return rows.join(after, ["__to_part", "__to_place"], "left").drop("__to_part", "__to_place")


def group_parts(ordered: DataFrame, keys: list[str]) -> DataFrame:
    """Of an order that starts with ``keys``, one row for each group in each range partition: its
    rows there, the place of the first, and the group's rows before. A group of any size has
    as many rows here as range partitions hold some of it."""
    parts = ordered.groupBy(*[F.col(f"`{k}`") for k in keys], PART).agg(F.count("*").alias("__rows"), F.min(PLACE).alias("__start"))
    by = Window.partitionBy(*[F.col(f"`{k}`") for k in keys])
    before = by.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("*", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__before"), F.sum("__rows").over(by).alias("__n"))


def series_positions(df: DataFrame, keys: list[str], order: list[Column], path: str) -> DataFrame:
    """``df`` with ``__pos``, the 0-based place of each row in its series, and ``__n``, the rows of
    the series: a series of any length and spacing is never in one task. ``keys`` not null."""
    ordered = ordered_positions(df, [F.col(f"`{k}`") for k in keys] + order, path)
    parts = group_parts(ordered, keys).drop("__rows")
    cols = [F.col(f"`{c}`") for c in df.columns]
    return ordered.join(parts, [*keys, PART]).select(*cols, (F.col("__before") + F.col(PLACE) - F.col("__start")).alias("__pos"), "__n")
