"""Document fingerprints: threshold-scaled sketches of word shingles (built-in functions only).

A sketch keeps every distinct shingle hash below a fixed fraction of the hash range
(1 / :data:`SCALE`), so sketches of documents of any two lengths are samples taken by the same
rule: they intersect, unite (:func:`merged`) and are compared directly. A short text would keep few or none, so
a sketch never has fewer than the :data:`LEAST` smallest hashes (all, if the text has fewer).

Up to which hash a sketch is complete is read off itself (:func:`complete_below`): all of them if
it has fewer than ``LEAST``, the fraction if all it holds are below that, else its largest. Two
sketches are compared below the lesser bound of the two, where both are complete:

- :func:`likeness`: shared hashes by hashes of either (Jaccard estimate);
- :func:`containment`: shared hashes by hashes of the smaller one, for very unequal documents.

Shingles are :data:`WORDS` consecutive words (runs of other than ASCII white space, A-Z
lower-cased), fewer words being one shingle; the hash of a shingle is XXH64 over its words'
XXH64 (seed 42). A fingerprint is the sketch as text, 16 lowercase hex digits a hash, ascending.

:func:`fingerprint_pairs` also sketches each document's edited text, whose last third is the
head of the next document in descending doc_id, and compares both neighbours. Neighbours are found
in blocks of :data:`BLOCK` consecutive ids: a block's rows and the first row of the block after
it meet in one window, so a window holds at most that many ids.

Scale: texts are shuffled once, by block; a sketch is about one hash in ``SCALE`` words. The
first rows of all blocks are found from ids and digests only and fetched by a join that is a
broadcast only below a checked number of rows.

Defined cases: null or empty text, or one without words, has the empty sketch; two empty ones
are alike (1), an empty and another not (0). Very long texts are hashed whole. Rows of equal
doc_id, which meet in one block, and those without (last, dealt by text) are ordered by digest;
repeated rows follow each other. One row is its own next. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.llm.common import KEY, WS, ascii_lower, stash, text_of, with_row_key
from sensorgrid.operators.positions import PART, PLACE, ordered_positions, successors
from sensorgrid.session import scratch_path

WORDS = 5
SCALE = 8
LEAST = 64
#: Consecutive ids of a block.
BLOCK = 1024
#: First rows of blocks (their ids and digests, 40 bytes each) that are broadcast at most.
BROADCAST_ROWS = 500_000
_LEAST_HASH, _LARGEST_HASH = -(1 << 63), (1 << 63) - 1
#: Hashes are ordered as signed numbers; the kept ones are below this.
BELOW = _LEAST_HASH + (1 << 64) // SCALE


def shingle_hashes(word_hashes: Column, words: int = WORDS) -> Column:
    """Hash of each shingle from the hashes of a text's words; a column of its own, as it is
    read once for each shingle."""
    n = F.size(word_hashes)
    each = F.transform(F.slice(word_hashes, 1, F.greatest(n - words + 1, F.lit(0))),
                       lambda h, i: F.xxhash64(h, *[F.get(word_hashes, i + k) for k in range(1, words)]))
    # xxhash64 of a list hashes its members one after the other
    return F.when(n >= words, each).when(n > 0, F.array(F.xxhash64(word_hashes))).otherwise(F.array().cast("array<bigint>"))


def with_sketch(df: DataFrame, text: Column, name: str, least: int = LEAST) -> DataFrame:
    """``df`` with the sketch of ``text``: an ascending array of hashes."""
    w, s, few = f"__llm_w_{name}", f"__llm_s_{name}", f"__llm_f_{name}"
    out = df.withColumn(w, F.transform(F.array_remove(F.split(ascii_lower(text), WS + "+"), ""), lambda x: F.xxhash64(x)))
    out = out.withColumn(s, shingle_hashes(F.col(w)))
    out = out.withColumn(few, F.sort_array(F.array_distinct(F.filter(s, lambda h: h < F.lit(BELOW)))))
    floor = F.slice(F.sort_array(F.array_distinct(F.col(s))), 1, least)
    return out.withColumn(name, F.when(F.size(few) >= least, F.col(few)).otherwise(floor)).drop(w, s, few)


def as_text(sketch: Column) -> Column:
    """16 lowercase hex digits a hash."""
    return F.lower(F.array_join(F.transform(sketch, lambda h: F.lpad(F.hex(h), 16, "0")), ""))


def complete_below(sketch: Column, least: int = LEAST) -> Column:
    """The hash up to which the sketch holds all."""
    largest = F.element_at(sketch, -1)
    return F.when(F.size(sketch) < least, F.lit(_LARGEST_HASH)).when(largest < BELOW, F.lit(BELOW - 1)).otherwise(largest)


def compared(a: Column, b: Column, least: int = LEAST) -> tuple[Column, Column, Column]:
    """Hashes of either, of both and of the smaller of two sketches, below the common bound."""
    bound = F.least(complete_below(a, least), complete_below(b, least))
    x, y = F.filter(a, lambda h: h <= bound), F.filter(b, lambda h: h <= bound)
    shared = F.size(F.array_intersect(x, y))
    return F.size(x) + F.size(y) - shared, shared, F.least(F.size(x), F.size(y))


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(1.0)).otherwise(part / whole)


def likeness(a: Column, b: Column, least: int = LEAST) -> Column:
    """Estimated share of the two texts' shingles that both have."""
    either, both, _ = compared(a, b, least)
    return ratio(both, either)


def containment(a: Column, b: Column, least: int = LEAST) -> Column:
    """Estimated share of the smaller text's shingles that the other has. Where the smaller has
    no hash below the common bound, nothing of it is known to be shared: 0."""
    either, both, smaller = compared(a, b, least)
    return F.when(either == 0, F.lit(1.0)).when(smaller == 0, F.lit(0.0)).otherwise(both / smaller)


def merged(a: Column, b: Column, least: int = LEAST) -> Column:
    """Sketch of two texts' shingles together, from their sketches alone."""
    both = F.sort_array(F.array_union(a, b))
    kept = F.filter(both, lambda h: h < F.lit(BELOW))
    return F.when(F.size(kept) >= least, kept).otherwise(F.slice(both, 1, least))


def fingerprints(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``docs`` with n_chars, the sketch (array of hashes) and the fingerprint (its text)."""
    out = with_sketch(docs.drop("n_chars", "sketch", "fingerprint"), text_of(), "sketch", least)
    return out.withColumns({"n_chars": F.length(text_of()).cast("long"), "fingerprint": as_text(F.col("sketch"))})


def blocked(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(__llm_null, __llm_block, doc_id, digests, text): consecutive ids share a block, rows
    without an id one of a digest's range."""
    rows = with_row_key(docs.select(F.col("doc_id").cast("long"), text_of().alias("text")))
    at = F.coalesce(F.col("doc_id") - F.pmod("doc_id", F.lit(block)), F.shiftright(KEY[0], 40).cast("long"))
    return rows.select(F.col("doc_id").isNull().alias("__llm_null"), at.alias("__llm_block"), "doc_id", *KEY, "text")


BLOCK_KEY = ["__llm_null", "__llm_block"]


def with_next(docs: DataFrame, block: int = BLOCK) -> tuple[DataFrame, list[Column]]:
    """Rows (doc_id, text) in blocks and, marked ``__llm_halo``, the first row of the block after
    each; and the order in which a block's window reads them."""
    rows = blocked(docs, block)
    top = rows.groupBy(*BLOCK_KEY).agg(F.max(F.struct("doc_id", *KEY)).alias("top"))
    top = top.select(*BLOCK_KEY, "top.doc_id", *[f"top.{k}" for k in KEY])
    ordered = ordered_positions(top, [F.col("__llm_null"), F.col("__llm_block").desc()], scratch_path(docs.sparkSession, "llm-blocks"))
    after = successors(ordered, ["doc_id", *KEY], circular=True).drop(PART, PLACE)
    # the block before the one that starts with a row: where that row is the next
    wanted = stash(after.select(*BLOCK_KEY, "next_doc_id", *[F.col(f"next_{k}").alias(f"__llm_to_{k}") for k in KEY]), "wanted")
    if wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    firsts = with_row_key(docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))).join(
        wanted, [F.col(k) == F.col(f"__llm_to_{k}") for k in KEY] + [F.col("doc_id").eqNullSafe(F.col("next_doc_id"))])
    # copies of a first row are one
    halo = firsts.groupBy(*BLOCK_KEY, "doc_id", *KEY).agg(F.any_value("text").alias("text"))
    both = rows.withColumn("__llm_halo", F.lit(0)).unionByName(halo.withColumn("__llm_halo", F.lit(1)))
    return both, [F.col("__llm_halo"), F.col("doc_id").desc_nulls_last(), *[F.col(k).desc() for k in KEY]]


def fingerprint_pairs(docs: DataFrame, least: int = LEAST, block: int = BLOCK) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, and
    the containments contained_edited and contained_next, for each row of ``docs`` (doc_id, text)."""
    rows, order = with_next(docs, block)
    # one exchange by block: the sketches are made behind it, before the window
    rows = rows.repartition(*BLOCK_KEY)
    rows = with_sketch(rows, F.col("text"), "sketch", least)
    by = Window.partitionBy(*BLOCK_KEY).orderBy(*order)
    rows = rows.withColumns({"__llm_next": F.lead("text").over(by), "__llm_next_sketch": F.lead("sketch").over(by)})
    n = F.length("text")
    cut = F.expr("length(text) div 3").cast("int")
    edited = F.concat(F.substr(F.col("text"), F.lit(1), n - cut), F.substr(F.col("__llm_next"), F.lit(1), cut))
    rows = rows.filter("__llm_halo = 0").withColumn("__llm_edited", edited)
    rows = with_sketch(rows, F.col("__llm_edited"), "edited_sketch", least)
    a, b, c = F.col("sketch"), F.col("edited_sketch"), F.col("__llm_next_sketch")
    return rows.select("doc_id", n.cast("long").alias("n_chars"), F.sha2("__llm_edited", 256).alias("edited_sha256"),
                       as_text(a).alias("fingerprint"), as_text(b).alias("edited_fingerprint"),
                       likeness(a, b, least).alias("near_edited"), likeness(a, c, least).alias("near_next"),
                       containment(a, b, least).alias("contained_edited"), containment(a, c, least).alias("contained_next"))
