"""Token counts through a digest cache.

The cache is a Parquet table (digest, tokenizer, n_tokens) in a folder of the caller. A text is
normalised (null as empty; nothing else, as the tokenizer keeps every character), digested,
and joined to the stored counts of this tokenizer's version, itself a digest of the model
file. Only distinct misses are encoded, and their counts are appended to the cache.

Scale: misses shuffle their texts once, by digest; a group of copies, however large, is one
row per task before the shuffle and one text after it. The last join carries ids and digests
only; the at most :data:`HOT` texts that hold a large share of the rows are broadcast to it, and
their rows are spread. A task that is lost encodes its texts again; the append commits whole.

Defined cases: null or empty text has 0 bytes and 0 tokens; repeated rows each get their
count; a very long text is encoded whole; an empty table gives an empty result; input columns named like an output are replaced.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgrid.llm.common import pack_hash, scratch_path, small_batches, stash, text_of, utf8
from sensorgrid.session import ensure_checkpoint_dir

LIMIT = 4096
#: A text with this share of all rows or more (one in so many) has its count broadcast.
HOT = 2000
#: Distinct segments whose counts a worker remembers.
MEMO = 400_000
#: Changes when counts do, so that older entries of a cache are no hits.
COUNTED = b"texts with U+2581 whole"
CACHE = "digest binary, tokenizer string, n_tokens long"
_SEGMENT = re.compile(r" *[^ ]+| +\Z")


def tokenizer_version(path: str) -> str:
    """Digest of the model file, the library's version and how counts are made here."""
    import sentencepiece
    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + sentencepiece.__version__.encode() + COUNTED).hexdigest()


class SegmentCounter:
    """Counts of whole texts by remembered segments. The model has no piece with a space after
    another character, so no merge crosses the start of a run of spaces: a text, with the
    space that the library puts before it, is counted run by run. Segments not met before go
    through the library. The model reads a literal U+2581 as a space, so pieces reach over a
    cut beside one: texts that hold it are encoded whole."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.library = SentencePieceProcessor(model_file=path)
        pieces = (self.library.id_to_piece(i) for i in range(self.library.vocab_size()))
        self.by_segment = not any("▁" in p.lstrip("▁") for p in pieces)
        self.lone = self.library.piece_to_id("▁")
        self.memo: dict[str, int] = {" ": 1}

    def count(self, texts: list[str]) -> list[int]:
        if not self.by_segment:
            return [len(x) for x in self.library.encode(texts, num_threads=1)]
        whole = [i for i, t in enumerate(texts) if "▁" in t]
        if whole:
            counts = dict(zip(whole, map(len, self.library.encode([texts[i] for i in whole], num_threads=1))))
            rest = iter(self.count([t for t in texts if "▁" not in t]))
            return [counts[i] if i in counts else next(rest) for i in range(len(texts))]
        out = []
        for i in range(0, len(texts), 64):
            # single spaces only, the usual case, need no pattern
            split = [[" " + w for w in t.split(" ")] if t and "  " not in t and t[0] != " " and t[-1] != " "
                     else _SEGMENT.findall(" " + t) if t else [] for t in texts[i:i + 64]]
            if len(self.memo) > MEMO:
                self.memo = {" ": 1}
            memo = self.memo
            new = list({s for x in split for s in x if s not in memo})
            if new:
                memo.update(zip(new, map(len, self.library.encode([s[1:] for s in new], num_threads=1))))
            out += [sum(map(memo.__getitem__, x)) for x in split]
        return out


_COUNTERS: dict[str, SegmentCounter] = {}


def counter(path: str) -> SegmentCounter:
    if path not in _COUNTERS:
        _COUNTERS[path] = SegmentCounter(path)
    return _COUNTERS[path]


def digest_of(text):
    return F.unhex(F.sha2(text, 256))


def cached_counts(spark, cache: str, version: str) -> DataFrame:
    """(digest, n_tokens) stored for one tokenizer version; two writers may both have added one."""
    spark.createDataFrame([], CACHE).write.mode("append").parquet(cache)
    return (spark.read.schema(CACHE).parquet(cache).filter(F.col("tokenizer") == version)
            .groupBy(F.col("digest").alias("__llm_digest")).agg(F.min("n_tokens").alias("n_tokens")))


def fill_cache(docs: DataFrame, tokenizer: str, cache: str) -> str:
    """Encode the distinct texts of ``docs`` that the cache lacks, append them, return the version."""
    spark, version = docs.sparkSession, tokenizer_version(tokenizer)
    small_batches(spark)
    texts = docs.select(digest_of(text_of()).alias("__llm_digest"), text_of().alias("text"))
    misses = texts.join(cached_counts(spark, cache, version), "__llm_digest", "left_anti").dropDuplicates(["__llm_digest"])

    def run(batches):
        count = counter(tokenizer).count
        for b in batches:
            n = count([x.decode("utf-8", "replace") for x in utf8(b.column(1))])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([version] * len(n), pa.string()), pa.array(n, pa.int64())], ["digest", "tokenizer", "n_tokens"])

    misses.mapInArrow(run, CACHE).write.mode("append").option("compression", "zstd").parquet(cache)
    return version


def hot_counts(rows: DataFrame, counts: DataFrame) -> DataFrame:
    """(digest, count) of the texts that make up a :data:`HOT` th of all rows or more: at most so
    many, whatever the corpus."""
    copies = stash(rows.groupBy("__llm_digest").agg(F.count("*").alias("__llm_copies")), "copies")
    total = copies.agg(F.sum("__llm_copies")).head()[0] or 0
    hot = copies.filter(F.col("__llm_copies") * HOT >= total).filter("__llm_copies > 1").select("__llm_digest")
    return hot.join(counts, "__llm_digest").select(F.col("__llm_digest").alias("__llm_hot"), F.col("n_tokens").alias("__llm_n"))


def count_tokens(docs: DataFrame, tokenizer: str, cache: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``docs`` with n_bytes, n_tokens and over_limit. Without a cache folder a new one is made
    in the shared folder."""
    spark = docs.sparkSession
    if cache is None:
        ensure_checkpoint_dir(spark)
        cache = scratch_path(spark, "llm-token-counts")
    docs = docs.drop("n_bytes", "n_tokens", "over_limit")
    version = fill_cache(docs, tokenizer, cache)
    rows = docs.withColumns({"__llm_digest": digest_of(text_of()), "n_bytes": F.octet_length(text_of()).cast("long")})
    counts = cached_counts(spark, cache, version)
    hot = hot_counts(rows.select("__llm_digest"), counts)
    rows = rows.withColumn("__llm_spread", pack_hash(docs)).join(F.broadcast(hot), F.col("__llm_digest") == F.col("__llm_hot"), "left")
    # rows that know their count are spread by their own hash, which is nobody's digest
    key = F.when(F.col("__llm_hot").isNull(), F.col("__llm_digest")).otherwise(F.col("__llm_spread").cast("string").cast("binary"))
    rows = rows.withColumn("__llm_key", key).drop("__llm_digest", "__llm_hot", "__llm_spread")
    out = rows.join(counts.withColumnRenamed("__llm_digest", "__llm_key"), "__llm_key", "left").withColumn("n_tokens", F.coalesce("__llm_n", "n_tokens"))
    return out.drop("__llm_key", "__llm_n").withColumn("over_limit", F.col("n_tokens") > limit)
