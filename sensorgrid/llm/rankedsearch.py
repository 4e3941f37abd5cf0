"""Ranked lexical search in reverse: the items wait, the documents stream past them.

The stated query set (the items) is small beside the corpus, so no index of the documents is
built. Instead the items' own terms become an inverted index (term -> items, with how often
each asks for it) that goes to every task; each task counts the terms of one document after
the other, adds up the scores of the items those terms lead to, and keeps a bounded heap per
item. The tasks' heaps are merged in two steps.

1. :func:`item_blocks` deals the distinct items to blocks of at most ``block_bytes`` of text. Only
   one block's index is collected and broadcast at a time, so the size of what is broadcast
   is checked and does not grow with the corpus, and any number of items works.
2. A first pass over the texts counts documents, terms and, for the block's terms, the
   documents that hold them (one small row a task and term, summed by Spark).
3. A second pass scores. Documents are scored a chunk at a time in numpy: their (term, count)
   pairs are spread over the term's items and added up in 64-bit integers, exactly.
4. The heaps of all tasks meet per item, first within groups of tasks, then over all.

Score of a document for an item: the sum, over the item's terms with repeats, of
``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` with ``w = floor(1000 * ln((2N + 2) / (2df + 1)))``
and ``m = 25 + (75 * n * N) div L``; N documents with a term, L terms in all, n terms of the
document, tf and df as usual. Terms are runs of ``[0-9A-Za-z]`` and characters from U+0080
on, with A-Z lower-cased only.

Scale: the texts are read twice a block and never shuffled; what is shuffled is at most ``k``
rows a task and item. A chunk is bounded by :data:`CELLS` (documents x items) and by postings,
one document at least. A lost task reads its files again.

Defined cases: a null or empty text has no terms, as an item (no rows) and as a document (not
counted in N). Very long texts are counted whole; only distinct terms of the items stay. Equal
scores are ordered by doc_id, null last; repeated documents take a rank each; repeated items
each get their rows; empty tables give an empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.llm.common import UPPER, batches_of, stash, text_of, utf8

K = 10
#: Bytes of item texts whose index is broadcast at once.
BLOCK_BYTES = 8 << 20
#: Scores held at once in a task: documents of a chunk times items of the block.
CELLS = 1 << 21
#: Tasks whose heaps are merged together first.
MERGED = 64
#: UTF-8 bytes with separators as spaces and A-Z lower-cased; others as they are.
_TERM_BYTES = bytes(b + 32 if chr(b) in UPPER else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def item_blocks(items: DataFrame, block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, list[int]]:
    """Distinct items (item, item_id, text, copies, block) and the blocks. A block holds at most
    ``block_bytes`` of text, or one item."""
    rows = items.select("item_id", text_of().alias("text")).filter("text != ''")
    rows = rows.groupBy("item_id", "text").agg(F.count("*").alias("copies"))
    rows = stash(rows.withColumn("item", F.xxhash64("item_id", "text")), "items")
    total = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    n = max(1, -(-total // block_bytes))
    while True:
        dealt = rows.withColumn("block", F.pmod("item", F.lit(n)).cast("int"))
        sizes = dealt.groupBy("block").agg(F.sum(F.octet_length("text")).alias("size"), F.count("*").alias("n"))
        if n == 1 or sizes.filter((F.col("size") > block_bytes) & (F.col("n") > 1)).isEmpty():
            return dealt, sorted(r.block for r in sizes.select("block").collect()) or [0]
        n *= 2


class ItemIndex:
    """Inverted index over items' terms: for the term numbered t, ``items[start[t]:start[t + 1]]``
    hold it, ``asked`` times each."""

    def __init__(self, texts: list[bytes]):
        counts = [Counter(terms_of(t)) for t in texts]
        self.number = {t: i for i, t in enumerate(sorted(set().union(*counts)))}
        postings = sorted((self.number[t], i, n) for i, c in enumerate(counts) for t, n in c.items())
        term, self.items, self.asked = (np.array(x, np.int64) for x in zip(*postings)) if postings else [np.zeros(0, np.int64)] * 3
        self.start = np.searchsorted(term, np.arange(len(self.number) + 1))
        self.n_items = len(texts)


def corpus_statistics(docs: DataFrame, vocabulary) -> dict[int, int]:
    """Documents that hold each numbered term of the broadcast ``vocabulary``; under -1 the
    documents with any term, under -2 the terms of all."""

    def run(batches):
        known = vocabulary.value.number
        terms = frozenset(known)
        held: Counter = Counter()
        n_docs = n_terms = 0
        for b in batches:
            for text in utf8(b.column(0)):
                words = terms_of(text)
                n_docs += bool(words)
                n_terms += len(words)
                held.update(terms & set(words))
        rows = [(known[t], n) for t, n in held.items()] + [(-1, n_docs), (-2, n_terms)]
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*rows)], ["term", "n"])

    with batches_of(docs.sparkSession):
        # a row for each term of one block of items: the block's bound holds for it too
        counted = docs.select("text").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n")).collect()
    return dict(map(tuple, counted))


class Heaps:
    """The ``k`` best documents of each item so far: highest score, then lowest doc_id, null last."""

    def __init__(self, n_items: int, k: int):
        self.k, self.best = k, [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)

    def update(self, doc_ids: list, scores: np.ndarray) -> None:
        """``scores`` has a row for each document and a column for each item."""
        bar = self.least
        if len(doc_ids) > self.k:  # no document below the chunk's own k-th can enter
            bar = np.maximum(bar, np.partition(scores, -self.k, axis=0)[-self.k])
        touched = set()
        for d, i in zip(*(x.tolist() for x in np.nonzero(scores >= bar))):
            doc = doc_ids[d]
            entry = (int(scores[d, i]), doc is not None, -(doc or 0))
            heap = self.best[i]
            if len(heap) < self.k:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            touched.add(i)
        for i in touched:
            if len(self.best[i]) == self.k:
                self.least[i] = self.best[i][0][0]

    def rows(self):
        return [(i, -d if known else None, s) for i, heap in enumerate(self.best) for s, known, d in heap]


def best_of_tasks(docs: DataFrame, index, weights, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(place, doc_id, score): the heaps of every task over ``docs`` (doc_id, text)."""

    def run(batches):
        ix, w = index.value, weights.value
        number, spread = ix.number, np.diff(ix.start)
        terms = frozenset(number)
        heaps = Heaps(ix.n_items, k)
        ids: list = []
        pairs: list[tuple[int, int, int, int]] = []  # document of the chunk, term, tf, m
        postings = 0

        def score():
            d, t, tf, m = np.array(pairs, np.int64).T
            gain = w[t] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
            reach = spread[t]
            before = np.cumsum(reach) - reach
            at = np.arange(reach.sum()) + np.repeat(ix.start[t] - before, reach)
            scores = np.zeros(len(ids) * ix.n_items, np.int64)
            np.add.at(scores, np.repeat(d, reach) * ix.n_items + ix.items[at], np.repeat(gain, reach) * ix.asked[at])
            heaps.update(ids, scores.reshape(len(ids), ix.n_items))

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                words = terms_of(text)
                found = terms.intersection(words)
                if not found:
                    continue
                m = 25 + 75 * len(words) * n_docs // n_terms
                tf = Counter(filter(found.__contains__, words))
                numbered = [(number[x], n) for x, n in tf.items()]
                pairs += [(len(ids), t, n, m) for t, n in numbered]
                postings += sum(int(spread[t]) for t, _ in numbered)
                ids.append(doc)
                if len(ids) * ix.n_items >= CELLS or postings >= CELLS:
                    score()
                    ids, pairs, postings = [], [], 0
        if ids:
            score()
        rows = heaps.rows()
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], pa.int64()) for j in range(3)], ["place", "doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long"), "text")
    return rows.mapInArrow(run, "place long, doc_id long, score long").withColumn("__llm_task", F.spark_partition_id())


def ranked(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each item, with their rank."""
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    some = Window.partitionBy("item", F.pmod("__llm_task", F.lit(MERGED))).orderBy(*best)
    everything = Window.partitionBy("item").orderBy(*best)
    merged = rows.withColumn("__llm_r", F.row_number().over(some)).filter(F.col("__llm_r") <= k).drop("__llm_r")
    return merged.withColumn("rank", F.row_number().over(everything)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: for each item (item_id, text) the ``k`` documents (doc_id, text)
    that score highest, above 0."""
    spark = docs.sparkSession
    dealt, blocks = item_blocks(items, block_bytes)
    found = None
    for block in blocks:
        own = dealt.filter(F.col("block") == block).select("item", "text").orderBy("item").collect()  # at most block_bytes
        index = spark.sparkContext.broadcast(ItemIndex([r.text.encode() for r in own]))
        held = corpus_statistics(docs, index)
        n_docs, n_terms = held.get(-1, 0), held.get(-2, 0)
        weights = spark.sparkContext.broadcast(np.array(
            [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held.get(t, 0) + 1))) for t in range(len(index.value.number))], np.int64))
        rows = best_of_tasks(docs, index, weights, n_docs, n_terms, k)
        with batches_of(spark):
            rows = stash(rows, "heaps")
        place = spark.createDataFrame([(i, r.item) for i, r in enumerate(own)], "place long, item long")
        rows = rows.join(F.broadcast(place), "place").select("item", "doc_id", "score", "__llm_task")
        found = rows if found is None else found.unionByName(rows)
    best = ranked(found, k).join(dealt.select("item", "item_id", "copies"), "item")
    each = best.select("*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("col")
    return each.select("item_id", F.col("rank").cast("int"), "doc_id", "score")
