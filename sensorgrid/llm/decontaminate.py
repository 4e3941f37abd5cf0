"""Benchmark decontamination with a distributed positional inverted index (built-in functions only).

1. :func:`build_index` stores the postings (term, row key, position) of the texts in the
   shared folder, by default those of the terms that occur in the benchmark.
2. :func:`phrase_matches` counts every term's postings, picks the ``lists`` rarest terms of
   each benchmark window, subtracts a term's place in its item from its positions and
   intersects these offset-adjusted lists: an alignment (row, item, shift) survives if some
   window has all of its rarest terms there.
3. The few surviving alignments are compared word for word with the whole text, which keeps
   exact phrase matches only. :func:`proximity_matches` instead asks for all terms of an item
   within a span of positions, in any order.

Words are ASCII-lower-cased runs of ``[0-9a-z]`` and characters from U+0080 on. A window is
``width`` consecutive words of an item; an item of fewer words, but not none, is one window.

Scale: postings are never grouped by term, so a word that makes up a third of the corpus is
only counted (map-side combine) and joined if it is among the rarest of a window. Texts are
shuffled once, by row key, to meet their alignments. The benchmark's vocabulary and items are
broadcast only below :data:`BROADCAST_TERMS` rows and :data:`BROADCAST_BYTES`; beyond, Spark joins by shuffle.

Defined cases: null, empty or word-less text has no words and no hit; very long texts are indexed
and compared whole; repeated rows each get their own result; a null item_id reads as the empty string; items without words and an empty
benchmark match nothing; input columns named like an output are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.llm.common import KEY, ascii_lower, stash, text_of, with_row_key

#: What separates words. A-Z are word characters since they are lower-cased first.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WIDTH = 10
#: At most so many benchmark terms or window anchors (of some 100 bytes) are broadcast.
BROADCAST_TERMS = 500_000
#: And whole items, or vocabularies of odd words, only of so many bytes together.
BROADCAST_BYTES = 32 << 20
LISTS = 2


def words_of(c: Column) -> Column:
    """Words in their own case; only the ends of a split can be empty."""
    return F.array_remove(F.split(c, SEPARATORS), "")


def bounded(df: DataFrame, size: Column | None = None) -> DataFrame:
    """``df`` with a broadcast hint if it has at most :data:`BROADCAST_TERMS` rows and, where rows are
    of any ``size``, :data:`BROADCAST_BYTES` bytes."""
    if df.limit(BROADCAST_TERMS + 1).count() > BROADCAST_TERMS:
        return df
    if size is not None and (df.agg(F.sum(size)).head()[0] or 0) > BROADCAST_BYTES:
        return df
    return F.broadcast(df)


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """One row (item, item_id, words) for each distinct item with words; ``item`` is a digest."""
    item_id = F.coalesce(F.col("item_id").cast("string"), F.lit(""))
    words = words_of(ascii_lower(text_of()))
    items = benchmark.select(item_id.alias("item_id"), words.alias("words")).filter(F.size("words") > 0)
    return items.select(F.xxhash64("item_id", "words").alias("item"), "item_id", "words").dropDuplicates(["item"])


def build_index(docs: DataFrame, terms: DataFrame | None = None) -> DataFrame:
    """Postings (__llm_k1, __llm_k2, pos, term) of ``docs``, kept in the shared folder.

    ``terms`` (term string): index only these; None indexes every word. ``term`` is a 64-bit
    digest, ``pos`` counts from 0. Rows stay in document order, so a key takes next to no space.
    """
    rows = with_row_key(docs).select(*KEY, F.posexplode(words_of(F.col("text"))).alias("pos", "__llm_w"))
    if terms is None:
        return stash(rows.select(*KEY, "pos", F.xxhash64(ascii_lower(F.col("__llm_w"))).alias("term")), "postings")
    # the equality is on the whole-Unicode lower case, which is fast; the ASCII rule decides
    vocab = bounded(terms.select(F.col("term").alias("__llm_t"), F.lower("term").alias("__llm_fold"),
                                 F.xxhash64("term").alias("term")).distinct(), F.octet_length("__llm_t"))
    hit = (F.col("__llm_w") == F.col("__llm_t")) | (ascii_lower(F.col("__llm_w")) == F.col("__llm_t"))
    return stash(rows.join(vocab, (F.lower("__llm_w") == F.col("__llm_fold")) & hit).select(*KEY, "pos", "term"), "postings")


def item_terms(items: DataFrame) -> DataFrame:
    return items.select("item", F.posexplode("words").alias("ipos", "word")).select("item", "ipos", F.xxhash64("word").alias("term"))


def windows_of(items: DataFrame, width: int = WIDTH) -> DataFrame:
    """(item, start, len): every window of an item."""
    n = F.size("words")
    return items.select("item", F.least(n, F.lit(width)).alias("len"),
                        F.explode(F.sequence(F.lit(0), F.greatest(n - width, F.lit(0)))).alias("start"))


def rarest(index: DataFrame, items: DataFrame, width: int = WIDTH, lists: int = LISTS) -> DataFrame:
    """(item, start, len, anchors): the item positions of the rarest terms of each window all
    of whose terms occur somewhere, and (term) lists by way of :func:`item_terms`."""
    freq = index.groupBy("term").agg(F.count("*").alias("freq"))
    counted = item_terms(items).join(bounded(stash(freq, "frequencies")), "term")
    places = windows_of(items, width).select("item", "start", "len", F.explode(
        F.sequence(F.col("start"), F.col("start") + F.col("len") - 1)).alias("ipos"))
    by = Window.partitionBy("item", "start")
    ranked = places.join(counted, ["item", "ipos"]).withColumns({
        "__llm_n": F.count("*").over(by), "__llm_r": F.row_number().over(by.orderBy("freq", "ipos"))})
    return (ranked.filter((F.col("__llm_n") == F.col("len")) & (F.col("__llm_r") <= lists))
            .groupBy("item", "start", "len").agg(F.sort_array(F.collect_set("ipos")).alias("anchors")))


def alignments(index: DataFrame, items: DataFrame, width: int = WIDTH, lists: int = LISTS) -> DataFrame:
    """Rows (key, item, shift, start, len): windows whose rarest terms' postings all meet at
    ``shift`` = text position - item position."""
    windows = stash(rarest(index, items, width, lists), "windows")
    anchors = windows.select("item", F.explode("anchors").alias("ipos"), F.size("anchors").alias("__llm_need"))
    anchors = anchors.groupBy("item", "ipos").agg(F.min("__llm_need").alias("__llm_need"))
    anchors = bounded(anchors.join(item_terms(items), ["item", "ipos"]))
    met = (index.join(anchors, "term").withColumn("shift", F.col("pos") - F.col("ipos"))
           .groupBy(*KEY, "item", "shift").agg(F.collect_set("ipos").alias("__llm_at"), F.min("__llm_need").alias("__llm_need"))
           .filter(F.size("__llm_at") >= F.col("__llm_need")))
    return (met.join(bounded(windows), "item")
            .filter((F.size(F.array_except("anchors", "__llm_at")) == 0) & (F.col("shift") + F.col("start") >= 0))
            .select(*KEY, "item", "shift", "start", "len"))


def phrase_matches(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, lists: int = LISTS) -> DataFrame:
    """``docs`` with ``__llm_words`` (words in their case) and ``matches``: an array of
    (dpos, len, item_id) with every exact occurrence of a window, null where there is none."""
    items = stash(benchmark_items(benchmark), "items")
    terms = items.select(F.explode("words").alias("term"))
    index = build_index(docs, terms)
    phrase = F.transform(F.slice("words", F.col("start") + 1, F.col("len")), lambda x: x)
    found = (alignments(index, items, width, lists).join(bounded(items, F.octet_length(F.array_join("words", " "))), "item")
             .groupBy(*KEY).agg(F.collect_set(F.struct((F.col("shift") + F.col("start")).alias("dpos"), F.col("len"),
                                                       F.col("item_id"), phrase.alias("phrase"))).alias("__llm_found")))
    k = [c + "f" for c in KEY]
    found = found.select(*[F.col(a).alias(b) for a, b in zip(KEY, k)], "__llm_found")
    rows = with_row_key(docs)
    joined = rows.join(found, [F.col(a) == F.col(b) for a, b in zip(KEY, k)], "left").drop(*k)
    joined = joined.withColumn("__llm_words", words_of(text_of()))
    same = lambda m: F.transform(F.slice("__llm_words", m["dpos"] + 1, m["len"]), ascii_lower) == m["phrase"]
    # asking for the size too keeps the words a column of their own, split once for a row
    exact = F.when(F.size("__llm_words") > 0, F.filter("__llm_found", same))
    return joined.withColumn("matches", exact).drop("__llm_found", *KEY)


def covered(matches: Column) -> Column:
    """Number of positions inside any match: a fold over the matches in order."""
    spans = F.array_sort(F.transform(matches, lambda m: F.struct(m["dpos"].alias("a"), (m["dpos"] + m["len"]).alias("b"))))
    start = F.struct(F.lit(0).alias("n"), F.lit(0).alias("end"))
    fold = F.aggregate(spans, start, lambda acc, s: F.struct(
        (acc["n"] + F.greatest(F.lit(0), s["b"] - F.greatest(s["a"], acc["end"]))).alias("n"),
        F.greatest(acc["end"], s["b"]).alias("end")), lambda acc: acc["n"])
    return F.coalesce(fold, F.lit(0)).cast("long")


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, lists: int = LISTS) -> DataFrame:
    """``docs`` with n_words, n_hit, items (sorted item ids), n_items, items_sha256, contaminated."""
    out = ["n_words", "n_hit", "items", "n_items", "items_sha256", "contaminated", "matches"]
    m = phrase_matches(docs.drop(*out), benchmark, width, lists)
    m = m.withColumns({"n_words": F.size("__llm_words").cast("long"), "n_hit": covered(F.col("matches")),
                       "items": F.array_sort(F.array_distinct(F.transform(F.coalesce("matches", F.array().cast(
                           "array<struct<dpos:int,len:int,item_id:string,phrase:array<string>>>")), lambda x: x["item_id"])))})
    return m.withColumns({"n_items": F.size("items").cast("long"), "items_sha256": F.sha2(F.array_join("items", ","), 256),
                          "contaminated": F.col("n_hit") > 0}).drop("__llm_words", "matches")


def proximity_matches(docs: DataFrame, benchmark: DataFrame, span: int) -> DataFrame:
    """(key, doc_id, item_id, dpos): starts of ``span`` consecutive words of a text that hold
    every distinct term of an item, in any order. Candidates come from the postings of the
    item's rarest term; the other terms' postings join them by row key and block of positions.
    """
    items = stash(benchmark_items(benchmark), "items")
    index = build_index(docs, items.select(F.explode("words").alias("term")))
    freq = stash(index.groupBy("term").agg(F.count("*").alias("freq")), "frequencies")
    need = item_terms(items).select("item", "term").distinct().join(freq, "term", "left").fillna(0, ["freq"])
    by = Window.partitionBy("item")
    need = need.withColumns({"__llm_r": F.row_number().over(by.orderBy("freq", "term")), "__llm_n": F.count("*").over(by)})
    postings = index.distinct()
    anchor = postings.join(need.filter("__llm_r = 1"), "term").select(
        *KEY, "item", "__llm_n", F.col("pos").alias("__llm_a"),
        F.explode(F.array(*[F.floor(F.col("pos") / span) + d for d in (-1, 0, 1)])).alias("__llm_block"))
    others = postings.join(need.select("item", "term"), "term").select(
        *KEY, "item", "term", "pos", F.floor(F.col("pos") / span).alias("__llm_block"))
    near = (anchor.join(others, [*KEY, "item", "__llm_block"]).filter(F.abs(F.col("pos") - F.col("__llm_a")) < span)
            .groupBy(*KEY, "item", "__llm_a", "__llm_n").agg(F.collect_set(F.struct("pos", "term")).alias("__llm_p")))
    starts = F.sequence(F.greatest(F.col("__llm_a") - span + 1, F.lit(0)), F.col("__llm_a"))
    inside = lambda s: F.size(F.array_distinct(F.transform(F.filter(
        "__llm_p", lambda p: (p["pos"] >= s) & (p["pos"] < s + span)), lambda p: p["term"]))) == F.col("__llm_n")
    hits = near.select(*KEY, "item", F.explode(F.filter(starts, inside)).alias("dpos")).distinct()
    ids = with_row_key(docs).select(*KEY, "doc_id").distinct()
    return hits.join(items.select("item", "item_id"), "item").join(ids, KEY).select(*KEY, "doc_id", "item_id", "dpos")
