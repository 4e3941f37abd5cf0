"""Phrase collocations by set-oriented relational mining over stored occurrence relations.

An occurrence relation of length k holds (block, position, phrase) for the occurrences of
phrases of k words, sorted by position. Positions number the words of a block; each end of a piece
leaves a number out, so words of two pieces are never adjacent. For k = 1, 2, ...:

1. group-count: every task adds up its blocks' distinct phrases, the sums meet by phrase, and
   groups of ``min_count`` occurrences stay, with an id (:func:`word_groups`, :func:`pair_groups`);
2. semi-join: a block's phrases meet the frequent groups and the others' occurrences go; up to
   :data:`KNOWN_ROWS` groups are broadcast to the blocks, more are joined to (block, phrase) rows;
3. extension: what is left merge-joins itself at the adjacent position (it is sorted), so that
   an occurrence of length k + 1 is one of its first k words and one of its last k words.

Each relation is written to the shared folder as one row per block of about :data:`BLOCK` words,
as arrays: positions as differences, phrases as numbers into the block's own list. A phrase is
identified by the exact ids of its first and last k - 1 words, never by a hash.

Then, relationally: phrases get their words from the ids; every cut of a candidate into two
parts looks up the parts' counts; scores are exact decimals; and a candidate goes if some
phrase one word longer holds it and occurs as often. One word is enough: a phrase between it
and a longer one with the same count has that count, too.

Words are runs without space and tab; pieces end at ``[.,;:!?]`` and line breaks (U+000A to
U+000D); A-Z are lower-cased; null ``lang`` is ``und``. Everything is counted per lang.

Scale: texts are read once and never shuffled. What is shuffled are counts, combined in each
task, packed as sorted arrays and dealt to buckets of about :data:`BUCKET_PAIRS` pairs, whose number
grows with the pairs; and, if the frequent groups are too many to broadcast, blocks of
occurrences that shrink with each length. A frequent phrase is one entry a task, however often
it occurs. The last ranking keeps ``top`` rows a lang and task before it shuffles.

Defined cases: null or empty text has no words; very long texts are one block, counted whole;
repeated documents count each time; ties in score go by count, then phrase (UTF-8 bytes); an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorgrid.llm.common import UPPER, batches_of, stash, utf8

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
#: Words of a block; a text is not split, so a block holds less than this plus one text.
BLOCK = 1 << 17
#: Pairs of a bucket of counts, about, and pairs that a task adds up before it deals them out.
BUCKET_PAIRS = 1 << 20
TASK_PAIRS = 1 << 21
#: Frequent groups (of some 30 bytes) that go to every task at most; more meet the blocks in joins.
KNOWN_ROWS = 500_000
#: Bytes with A-Z lower-cased, tab as space and the ends of pieces as line feeds.
_PIECE_BYTES = bytes(b + 32 if chr(b) in UPPER else 32 if b == 9 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))

#: ``pos``: int32 differences of sorted positions; ``code``: int32 numbers into the arrays.
WORDS = "block long, langs array<string>, words array<string>, counts array<bigint>, pos binary, code binary"
#: The relation of length k with its groups: phrases by their first and last k - 1 words.
PHRASES = "block long, firsts array<bigint>, lasts array<bigint>, counts array<bigint>, pos binary, code binary"


def packed(a: np.ndarray) -> bytes:
    return a.astype("<i4").tobytes()


def unpacked(b: bytes) -> np.ndarray:
    return np.frombuffer(b, "<i4")


def places(b: bytes) -> np.ndarray:
    return np.cumsum(unpacked(b), dtype=np.int64)


def differences(pos: np.ndarray) -> bytes:
    return packed(np.diff(pos, prepend=0))


def word_relation(docs: DataFrame) -> DataFrame:
    """The relation of length 1, a row a block, with the block's words, langs and counts."""
    schema = pa.schema([("block", pa.int64()), ("langs", pa.list_(pa.string())), ("words", pa.list_(pa.string())),
                        ("counts", pa.list_(pa.int64())), ("pos", pa.binary()), ("code", pa.binary())])

    def run(batches):
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        numbers: dict[str, dict[bytes, int]] = {}
        codes: list[int] = []
        sizes: list[int] = []

        def flush():
            code = np.array(codes, np.int32)
            n = sum(map(len, numbers.values()))
            langs, words = [None] * n, [None] * n
            for lang, own in numbers.items():
                for w, i in own.items():
                    langs[i], words[i] = lang, w.decode()
            pos = np.arange(1, len(code) + 1) + np.repeat(np.arange(len(sizes)), sizes)
            counts = np.bincount(code, minlength=n)
            return pa.RecordBatch.from_arrays([
                pa.array([block], pa.int64()), pa.array([langs], schema.field(1).type), pa.array([words], schema.field(2).type),
                pa.array([counts], schema.field(3).type), pa.array([differences(pos)], pa.binary()), pa.array([packed(code)], pa.binary())], schema=schema)

        n_words = 0  # of all langs' lists
        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), utf8(b.column(1))):
                own = numbers.setdefault(lang, {})
                for piece in text.translate(_PIECE_BYTES).split(b"\n"):
                    # only spaces are left of what bytes.split() splits at, but for none
                    words = piece.split()
                    if not words:
                        continue
                    for w in words:
                        if w not in own:
                            own[w] = n_words
                            n_words += 1
                    codes += map(own.__getitem__, words)
                    sizes.append(len(words))
                if len(codes) >= BLOCK:
                    yield flush()
                    block, numbers, codes, sizes, n_words = block + 1, {}, [], [], 0
        if codes:
            yield flush()

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    with batches_of(docs.sparkSession):
        return stash(rows.mapInArrow(run, WORDS), "occurrences", large_rows=True)


def with_id(counted: DataFrame, min_count: int) -> DataFrame:
    """The groups of ``min_count`` occurrences with an id, which the write fixes."""
    return stash(counted.filter(F.col("f") >= min_count).withColumn("id", F.monotonically_increasing_id()), "groups")


def word_groups(relation: DataFrame, min_count: int) -> DataFrame:
    """(lang, word, f, id) of the frequent words."""
    rows = relation.select(F.explode(F.arrays_zip("langs", "words", "counts")).alias("g"))
    return with_id(rows.groupBy(F.col("g.langs").alias("lang"), F.col("g.words").alias("word")).agg(F.sum("g.counts").alias("f")), min_count)


def summed(first: np.ndarray, last: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts of equal pairs added up, sorted."""
    order = np.lexsort((last, first))
    first, last, n = first[order], last[order], n[order]
    new = np.flatnonzero(np.concatenate([[True], (first[1:] != first[:-1]) | (last[1:] != last[:-1])]))
    return first[new], last[new], np.add.reduceat(n, new)


def pair_groups(relation: DataFrame, min_count: int) -> DataFrame:
    """(first, last, f, id) of the frequent phrases, counted in numpy: packed sums of a task's
    blocks meet in buckets of pairs."""
    total = relation.agg(F.sum(F.size("counts"))).head()[0] or 0
    buckets = -(-total // BUCKET_PAIRS) or 1

    def deal(held):
        first, last, n = summed(*(np.concatenate(x) for x in zip(*held)))
        mixed = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + last.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
        bucket = ((mixed ^ mixed >> np.uint64(29)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
        for b, (i, j) in enumerate(zip(ends, ends[1:])):
            if j > i:
                own = order[i:j]
                yield b, *(pa.compress(x.tobytes(), "zstd", asbytes=True) for x in (np.diff(first[own], prepend=0), last[own], n[own])), j - i

    def sums(batches):
        held, size = [], 0
        rows: list[tuple] = []
        for b in batches:
            for i in range(b.num_rows):
                held.append(tuple(c[i].values.to_numpy() for c in b.columns))
                size += len(held[-1][0])
                if size >= TASK_PAIRS:
                    rows = list(deal(held))
                    held, size = [], 0
                    yield packed_batch(rows)
        if size:
            yield packed_batch(list(deal(held)))

    def packed_batch(rows):
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows), kinds)], ["bucket", "first", "last", "n", "size"])

    def count(table: pa.Table) -> pa.Table:
        parts = []
        for r in table.to_pylist():
            first, last, n = (np.frombuffer(pa.decompress(r[c], r["size"] * 8, "zstd", asbytes=True), np.int64) for c in ("first", "last", "n"))
            parts.append((np.cumsum(first), last, n))
        first, last, f = summed(*(np.concatenate(x) for x in zip(*parts)))
        kept = f >= min_count
        return pa.table({"first": first[kept], "last": last[kept], "f": f[kept]})

    with batches_of(relation.sparkSession):
        rows = relation.select("firsts", "lasts", "counts").mapInArrow(sums, "bucket long, first binary, last binary, n binary, size long")
        return with_id(rows.groupBy("bucket").applyInArrow(count, "first long, last long, f long"), min_count)


class Known:
    """A bounded table of frequent groups (keys, id), looked up from a block's own lists."""

    def __init__(self, table: pa.Table):
        first, last, ids = (c.combine_chunks() for c in table.columns)
        self.ids = ids.to_numpy()
        self.words = pa.types.is_string(first.type) or pa.types.is_large_string(first.type)
        if self.words:
            self.keys = self.word_keys(first, last)
        else:
            self.first, self.last = np.unique(first.to_numpy()), np.unique(last.to_numpy())
            pair = np.searchsorted(self.first, first.to_numpy()) * len(self.last) + np.searchsorted(self.last, last.to_numpy())
            order = np.argsort(pair)
            self.pair, self.ids = pair[order], self.ids[order]

    @staticmethod
    def word_keys(langs: pa.Array, words: pa.Array) -> pa.Array:
        return pc.binary_join_element_wise(langs.cast(pa.string()), words.cast(pa.string()), " ")  # no word has a space

    def find(self, first: pa.Array, last: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Places in the lists that are frequent, and their ids."""
        if not len(self.ids):
            return np.zeros(0, np.int64), self.ids
        if self.words:
            at = pc.fill_null(pc.index_in(self.word_keys(first, last), self.keys), -1).to_numpy()
            own = np.flatnonzero(at >= 0)
            return own, self.ids[at[own]]
        first, last = first.to_numpy(), last.to_numpy()
        a, b = (np.minimum(np.searchsorted(known, x), len(known) - 1) for known, x in ((self.first, first), (self.last, last)))
        pair = a * len(self.last) + b
        at = np.minimum(np.searchsorted(self.pair, pair), len(self.pair) - 1)
        own = np.flatnonzero((self.first[a] == first) & (self.last[b] == last) & (self.pair[at] == pair))
        return own, self.ids[at[own]]


def extend(relation: DataFrame, frequent: DataFrame, keys: list[str], lists: list[str]) -> DataFrame:
    """The relation of length k + 1 from that of length k and its frequent groups."""
    spark = relation.sparkSession
    schema = pa.schema([("block", pa.int64()), *[(c, pa.list_(pa.int64())) for c in ("firsts", "lasts", "counts")], ("pos", pa.binary()), ("code", pa.binary())])
    known = None
    if frequent.limit(KNOWN_ROWS + 1).count() <= KNOWN_ROWS:
        known = spark.sparkContext.broadcast(Known(frequent.select(*keys, "id").toArrow()))
        rows = relation.select("block", "pos", "code", *lists)
    else:
        groups = relation.select("block", F.posexplode(F.arrays_zip(*lists)).alias("i", "g"))
        groups = groups.select("block", "i", *[F.col(f"g.{x}").alias(k) for x, k in zip(lists, keys)])
        kept = (groups.join(frequent.select(*keys, "id"), keys).groupBy("block")
                .agg(F.collect_list("i").alias("own"), F.collect_list("id").alias("ids")))
        rows = relation.select("block", "pos", "code").join(kept, "block")

    def merged(own, ids, pos, code):
        # semi-join: only occurrences of frequent phrases, numbered anew
        number = np.full(max(int(code.max()), int(own.max())) + 1, -1, np.int64)
        number[own] = np.arange(len(own))
        code = number[code]
        pos, code = pos[code >= 0], code[code >= 0]
        # merge-join of the sorted relation with itself at adjacent positions
        met = np.flatnonzero(np.diff(pos) == 1)
        groups, number, counts = np.unique(code[met] * len(ids) + code[met + 1], return_inverse=True, return_counts=True)
        return ids[groups // len(ids)], ids[groups % len(ids)], counts, differences(pos[met]), packed(number)

    def run(batches):
        for b in batches:
            for row in range(b.num_rows):
                cell = {name: b.column(i)[row] for i, name in enumerate(b.schema.names)}
                if known:
                    own, ids = known.value.find(*[cell[c].values for c in lists])
                else:
                    own, ids = (cell[c].values.to_numpy(zero_copy_only=False) for c in ("own", "ids"))
                if len(own):
                    found = merged(own, ids, places(cell["pos"].as_py()), unpacked(cell["code"].as_py()))
                    if len(found[0]):
                        yield pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip([cell["block"].as_py(), *found], schema)], schema=schema)

    with batches_of(spark):
        return stash(rows.mapInArrow(run, PHRASES), "occurrences", large_rows=True)


def phrase_counts(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT) -> tuple[list[DataFrame], DataFrame]:
    """For each length 1 .. ``longest`` the frequent phrases (lang, words, f), and (lang, n)."""
    relation = word_relation(docs)
    own = relation.select(F.explode(F.arrays_zip("langs", "counts")).alias("g"))
    totals = stash(own.groupBy(F.col("g.langs").alias("lang")).agg(F.sum("g.counts").alias("n")), "totals")
    keys, lists = ["lang", "word"], ["langs", "words"]
    frequent = word_groups(relation, min_count)
    levels = [frequent.select("id", "lang", F.array("word").alias("words"), "f")]
    for _ in range(1, longest):
        relation = extend(relation, frequent, keys, lists)
        keys, lists = ["first", "last"], ["firsts", "lasts"]
        frequent = pair_groups(relation, min_count)
        first = levels[-1].select(F.col("id").alias("first"), "lang", F.col("words").alias("begin"))
        last = levels[-1].select(F.col("id").alias("last"), F.slice("words", -1, 1).alias("end"))
        named = frequent.join(first, "first").join(last, "last")
        levels.append(stash(named.select("id", "lang", F.concat("begin", "end").alias("words"), "f"), "phrases"))
    return [x.select("lang", "words", "f") for x in levels], totals


def joined(words: Column) -> Column:
    return F.array_join(words, " ")


def scored(levels: list[DataFrame], totals: DataFrame) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of every phrase of two words or more: its worst cut."""
    parts = None
    for x in levels[:-1]:
        x = x.select("lang", joined(F.col("words")).alias("part"), "f")
        parts = x if parts is None else parts.unionByName(x)
    cuts = None
    for k, x in enumerate(levels[1:], 2):
        rows = x.select("lang", joined(F.col("words")).alias("phrase"), F.col("f").alias("a"),
                        F.explode(F.array(*[F.struct(F.lit(c).alias("cut"), joined(F.slice("words", 1, c)).alias("left"),
                                                     joined(F.slice("words", c + 1, k - c)).alias("right")) for c in range(1, k)])).alias("c"))
        rows = rows.select("lang", "phrase", "a", "c.*")
        cuts = rows if cuts is None else cuts.unionByName(rows)
    left = parts.select("lang", F.col("part").alias("left"), F.col("f").alias("l"))
    right = parts.select("lang", F.col("part").alias("right"), F.col("f").alias("r"))
    rows = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(F.broadcast(totals) if totals.count() <= 10_000 else totals, "lang")
    # 38 digits hold the products for up to 10 ** 17 words; the quotient is at most 10 n
    score = F.expr("(cast(1000 as decimal(4, 0)) * cast(a as decimal(17, 0)) * cast(n as decimal(17, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    worst = rows.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("w"))
    return worst.select("lang", "phrase", "a", "w.l", "w.r", "n", "w.score")


def inside_longer(levels: list[DataFrame]) -> DataFrame:
    """(lang, phrase) of the phrases that some phrase one word longer holds each time they occur."""
    held = None
    for k, x in enumerate(levels[2:], 3):
        rows = x.select("lang", F.col("f").alias("a"), F.explode(F.array(joined(F.slice("words", 1, k - 1)), joined(F.slice("words", 2, k - 1)))).alias("phrase"))
        held = rows if held is None else held.unionByName(rows)
    return held


def mine(docs: DataFrame, longest: int = LONGEST, min_count: int = MIN_COUNT, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` collocations of each lang in ``docs`` (text, lang)."""
    levels, totals = phrase_counts(docs, longest, min_count)
    rows = scored(levels, totals)
    if longest > 2:
        rows = rows.join(inside_longer(levels), ["lang", "phrase", "a"], "left_anti")
    by = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    return (rows.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long"), "phrase", "a", "l", "r", "n", "score"))
