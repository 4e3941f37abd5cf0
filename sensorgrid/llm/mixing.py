"""Mixing sources to target weights by systematic sampling (built-in functions only).

Sources get weights in code-point order of their names (null last); their shares of the
wished total are capped at ``cap`` times what they hold, and the excess is shared again by
weight. Inside a source every document expects ``target / source_size`` copies; expected
copies are prefix-summed over the documents, one random offset is added, and a document is
emitted once for each integer its interval crosses. The order goes up in size over one half
of the documents (by digest) and down again over the other: neighbours have nearly the same
size and both ends are small, so the words taken come close to the target at any offset.

Scale: the prefix sum is hierarchical. Documents are counted per (source, place, digest
byte), the place being the size on its way up or down, with map-side combine; prefix sums run over those counts, first over the places of a
source, then over the at most 256 digest bytes of a place. Only the rows of one such cell are
numbered together, so a source holding a third of all rows, or a third of all rows having
one size, is dealt over 256 cells or more.

Defined cases: null or empty text has size 0 and takes 0 words; a null source is a source of
its own, after all others; identical rows are interchangeable; a very long text is a document like others; an empty table gives an empty
result; a source of size 0 has target 0; input columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.llm.common import pack_hash, stash, text_of, word_count

#: Weights, repeated over the sources in order.
WEIGHTS = (5.0, 2.0, 1.0)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0) -> DataFrame:
    """Targets of a table (source, source_size): ``share`` of all sizes dealt by weight, no
    source above ``cap`` times its size, the excess dealt again by weight.

    The capped shares solve ``target = min(cap * size, level * weight)``. In order of
    ``cap * size / weight`` the capped sources come first, so the level follows from running
    sums in one pass (one row per source).
    """
    every = Window.partitionBy()
    ranked = sizes.withColumn("__llm_rank", F.row_number().over(every.orderBy(F.col("source").asc_nulls_last())))
    w = F.array(*[F.lit(float(x)) for x in weights])
    s = ranked.withColumn("__llm_w", F.element_at(w, (F.col("__llm_rank") - 1) % len(weights) + 1))
    s = s.withColumn("__llm_cap", F.lit(float(cap)) * F.col("source_size"))
    s = s.withColumn("__llm_ratio", F.col("__llm_cap") / F.col("__llm_w"))
    order = every.orderBy("__llm_ratio", "__llm_rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    left = F.lit(float(share)) * F.sum("source_size").over(every) - F.coalesce(F.sum("__llm_cap").over(before), F.lit(0.0))
    weight = F.sum("__llm_w").over(order.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("__llm_level", left / weight)
    level = F.max(F.when(F.col("__llm_level") < F.col("__llm_ratio"), F.col("__llm_level"))).over(every)
    return s.select("source", "source_size",
                    F.coalesce(F.least("__llm_cap", level * F.col("__llm_w")), F.col("__llm_cap")).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, cap: float = 2.0, seed: int = 0) -> DataFrame:
    """``docs`` (doc_id, text, source, ...) with size, source_size, target, copies, taken."""
    docs = docs.drop("size", "source_size", "target", "copies", "taken")
    digest = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text_of()))
    rows = docs.withColumns({"size": word_count(text_of()), "__llm_digest": digest, "__llm_tie": pack_hash(docs)})
    up = F.substring("__llm_digest", 3, 1) < "8"
    # keys that can't be null: the join below then tests nothing at the scan (which would count
    # every text's words again), and its partitioning serves the window too
    solid = lambda c, none: F.coalesce(c, F.lit(none))
    rows = rows.withColumns({"__llm_source": solid(F.concat(F.lit("s"), F.col("source")), ""),
                             "__llm_place": solid(F.when(up, F.col("size")).otherwise(F.lit(1 << 40) - F.col("size")), 0),
                             "__llm_cell": solid(F.substring("__llm_digest", 1, 2), "")})
    cell = ["__llm_source", "__llm_place", "__llm_cell"]

    cells = stash(rows.groupBy(*cell).agg(F.count("*").alias("__llm_n"), F.min("size").alias("size"), F.min("source").alias("source")), "mix-cells")
    places = cells.groupBy("__llm_source", "__llm_place").agg(F.sum("__llm_n").alias("__llm_n"), F.min("size").alias("size"), F.min("source").alias("source"))
    sources = places.groupBy("__llm_source").agg(F.sum(F.col("size") * F.col("__llm_n")).cast("long").alias("source_size"), F.min("source").alias("source"))
    targets = source_targets(sources.select("source", "source_size"), weights, share, cap)
    named = solid(F.concat(F.lit("s"), F.col("source")), "")
    offset = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), named)), 1, 4), 16, 10)
    targets = targets.select(named.alias("__llm_source"), "source_size", "target",
                             F.coalesce(F.col("target") / F.expr("nullif(source_size, 0)"), F.lit(0.0)).alias("__llm_rate"),
                             (offset.cast("double") / 65536.0).alias("__llm_offset"))

    before = lambda *by: F.coalesce(F.sum("__llm_n").over(Window.partitionBy(*by[:-1]).orderBy(by[-1]).rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    places = places.select("__llm_source", "__llm_place", before("__llm_source", "__llm_place").alias("__llm_s")).join(targets, "__llm_source")
    cells = cells.select(*cell, before(*cell).alias("__llm_c")).join(places, ["__llm_source", "__llm_place"])

    out = rows.join(cells, cell)
    within = Window.partitionBy(*cell).orderBy("__llm_digest", "__llm_tie")
    out = out.withColumn("__llm_rank", F.col("__llm_s") + F.col("__llm_c") + F.row_number().over(within))
    edge = lambda r: F.floor(F.col("__llm_rate") * r + F.col("__llm_offset"))
    out = out.withColumn("copies", (edge(F.col("__llm_rank")) - edge(F.col("__llm_rank") - 1)).cast("long"))
    out = out.withColumn("taken", F.col("copies") * F.col("size"))
    return out.drop(*[c for c in out.columns if c.startswith("__llm_")])


def emit(mixed: DataFrame) -> DataFrame:
    """Every row once per copy."""
    return (mixed.withColumn("__llm_copy", F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1)).cast("int"))))
            .filter("copies > 0").drop("__llm_copy"))
