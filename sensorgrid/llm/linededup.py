"""Reversible line dedup: sharded cuckoo filters backed by an exact reference-count table.

- :func:`line_rows`: the distinct line keys of each document as 128-bit digests;
- :func:`reference_counts`: digest -> number of documents that hold the line. The table is
  exact and additive, so :func:`merge_counts` inserts a batch of documents or takes one back;
- :func:`build_filters` / :func:`update_filters`: per shard of digests a cuckoo filter of the
  frequent keys; a key that crosses the threshold is inserted, or deleted when documents go;
- :func:`probe`: lines meet the filter of their shard, and only the few positives are joined
  with the exact table, which removes the filter's false positives;
- :func:`drop_lines`: documents without their frequent lines.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased.

Scale: counting combines map-side, so a line that a third of all documents share is one row
per task. Filters are dealt by (shard, salt): as many salts as keep a group near
:data:`GROUP_ROWS` rows, with the filter's bytes copied to each, so the shard of a hot line is
split too. Texts are shuffled once, by row key, to meet the digests they lose.

Defined cases: null or empty text is one empty line; keys of fewer than ``min_chars`` code
points are never dropped; repeated rows count as documents of their own and each lose their
lines; very long texts are split whole; an empty table gives an empty result; input columns named like an output are replaced.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgrid.llm.common import KEY, small_batches, stash, utf8, with_row_key

MIN_DOCS = 10
MIN_CHARS = 1
#: Frequent keys in one filter shard, and line rows that meet it in one group.
SHARD_KEYS = 50_000
GROUP_ROWS = 200_000
#: Frequent keys that are broadcast to confirm positives; beyond it the join shuffles.
BROADCAST_KEYS = 500_000


def line_key(line: bytes) -> bytes:
    """``bytes.strip`` and ``bytes.lower`` know ASCII only, as the key's rule does."""
    return line.strip().lower()


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


class CuckooFilter:
    """16-bit fingerprints in buckets of four; a key has two buckets, so an entry can be moved
    and, unlike in a Bloom filter, deleted. Keys are 16-byte digests."""

    SLOTS, KICKS = 4, 500

    def __init__(self, table: np.ndarray):
        self.table = table
        self.mask = len(table) - 1

    @classmethod
    def of(cls, keys: list[bytes]) -> CuckooFilter:
        """A filter of all ``keys``; it doubles until every key has found a place."""
        n = 1 << max(2, math.ceil(math.log2(max(1, len(keys)) / cls.SLOTS / 0.85)))
        while True:
            f = cls(np.zeros((n, cls.SLOTS), np.uint16))
            if all(f.insert(k) for k in keys):
                return f
            n *= 2

    @classmethod
    def load(cls, blob: bytes) -> CuckooFilter:
        return cls(np.frombuffer(blob, np.uint16).reshape(-1, cls.SLOTS).copy())

    def dump(self) -> bytes:
        return self.table.tobytes()

    def _places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Fingerprints and both buckets; keys: (n, 2) unsigned 64-bit halves of digests."""
        fp = (keys[:, 1] >> np.uint64(48)).astype(np.uint64)
        fp[fp == 0] = 1
        one = (keys[:, 0] & np.uint64(self.mask)).astype(np.int64)
        return fp.astype(np.uint16), one, self._other(one, fp)

    def _other(self, bucket, fp):
        return bucket ^ ((fp.astype(np.uint64) * np.uint64(0x5BD1E995)) & np.uint64(self.mask)).astype(np.int64)

    def _one(self, key: bytes) -> tuple[int, int, int]:
        fp, a, b = self._places(np.frombuffer(key, np.uint64).reshape(1, 2))
        return int(fp[0]), int(a[0]), int(b[0])

    def insert(self, key: bytes) -> bool:
        """False if no place was found; the caller then rebuilds from the exact table."""
        fp, a, b = self._one(key)
        for i in (a, b):
            free = np.flatnonzero(self.table[i] == 0)
            if len(free):
                self.table[i, free[0]] = fp
                return True
        i = b
        for kick in range(self.KICKS):
            slot = kick % self.SLOTS
            fp, self.table[i, slot] = int(self.table[i, slot]), fp
            i = int(self._other(np.array([i]), np.array([fp], np.uint64))[0])
            free = np.flatnonzero(self.table[i] == 0)
            if len(free):
                self.table[i, free[0]] = fp
                return True
        return False

    def delete(self, key: bytes) -> bool:
        fp, a, b = self._one(key)
        for i in (a, b):
            at = np.flatnonzero(self.table[i] == fp)
            if len(at):
                self.table[i, at[0]] = 0
                return True
        return False

    def contains(self, keys: list[bytes]) -> np.ndarray:
        if not len(keys):
            return np.zeros(0, bool)
        fp, a, b = self._places(np.frombuffer(b"".join(keys), np.uint64).reshape(-1, 2))
        return ((self.table[a] == fp[:, None]) | (self.table[b] == fp[:, None])).any(axis=1)


def line_rows(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, line): each document's distinct line digests, of keys long enough to count."""
    small_batches(docs.sparkSession)

    def rows(batches):
        for b in batches:
            k1, k2 = b.column(0), b.column(1)
            at, out = [], []
            for i, text in enumerate(utf8(b.column(2))):
                keys = {line_key(x) for x in text.split(b"\n")}
                own = [digest(k) for k in keys if len(k) >= min_chars and len(k.decode("utf-8", "replace")) >= min_chars]
                out += own
                at += [i] * len(own)
            at = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([k1.take(at), k2.take(at), pa.array(out, pa.binary())], [*KEY, "line"])

    return with_row_key(docs).select(*KEY, "text").mapInArrow(rows, f"{KEY[0]} long, {KEY[1]} long, line binary")


def reference_counts(lines: DataFrame) -> DataFrame:
    """(line, refs): in how many documents a line stands."""
    return lines.groupBy("line").agg(F.count("*").alias("refs"))


def merge_counts(counts: DataFrame, batch: DataFrame, sign: int = 1) -> DataFrame:
    """Counts after inserting (sign 1) or deleting (sign -1) the documents behind ``batch``."""
    both = counts.unionByName(batch.withColumn("refs", F.col("refs") * sign))
    return both.groupBy("line").agg(F.sum("refs").alias("refs")).filter("refs > 0")


def shard_of(shards: int):
    return F.pmod(F.xxhash64("line"), F.lit(shards)).cast("int").alias("shard")


def build_filters(frequent: DataFrame, shards: int) -> DataFrame:
    """(shard, filter): a cuckoo filter for every shard, of about :data:`SHARD_KEYS` keys."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"shard": [pdf["shard"].iloc[0]], "filter": [CuckooFilter.of(pdf["line"].tolist()).dump()]})

    return frequent.select(shard_of(shards), "line").groupBy("shard").applyInPandas(build, "shard int, filter binary")


def update_filters(filters: DataFrame, before: DataFrame, after: DataFrame, shards: int, min_docs: int = MIN_DOCS) -> DataFrame:
    """Filters after the counts went from ``before`` to ``after``: keys that reached
    ``min_docs`` are inserted, keys that fell below it are deleted. A filter that is too full
    is rebuilt from the shard's frequent keys."""
    old = before.filter(F.col("refs") >= min_docs).select("line", F.lit(1).alias("was"))
    new = after.filter(F.col("refs") >= min_docs).select("line", F.lit(1).alias("is"))
    change = old.join(new, "line", "full").select(shard_of(shards), "line", F.col("was").isNotNull().alias("was"), F.col("is").isNotNull().alias("is"))

    def update(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        here = right[right["is"]]["line"].tolist()
        if len(left):
            f = CuckooFilter.load(left["filter"].iloc[0])
            for k in right[right["was"] & ~right["is"]]["line"]:
                f.delete(k)
            ok = all(f.insert(k) for k in right[right["is"] & ~right["was"]]["line"])
        if not len(left) or not ok:
            f = CuckooFilter.of(here)
        return pd.DataFrame({"shard": [key[0]], "filter": [f.dump()]})

    return filters.groupBy("shard").cogroup(change.groupBy("shard")).applyInPandas(update, "shard int, filter binary")


def probe(lines: DataFrame, filters: DataFrame, shards: int, salts: int) -> DataFrame:
    """The rows of ``lines`` whose digest is in the filter of its shard."""
    dealt = lines.select(*KEY, "line", shard_of(shards), F.pmod(F.col(KEY[0]), F.lit(salts)).cast("int").alias("salt"))
    copies = filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))

    def test(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({KEY[0]: pd.Series([], dtype="int64"), KEY[1]: pd.Series([], dtype="int64"), "line": []})
        hit = CuckooFilter.load(right["filter"].iloc[0]).contains(left["line"].tolist())
        return left.loc[hit, [*KEY, "line"]]

    return (dealt.groupBy("shard", "salt").cogroup(copies.groupBy("shard", "salt"))
            .applyInPandas(test, f"{KEY[0]} long, {KEY[1]} long, line binary"))


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """(key, drop): for each document the digests of its frequent lines."""
    lines = stash(line_rows(docs, min_chars), "lines")
    counts = stash(reference_counts(lines), "line-counts")
    frequent = counts.filter(F.col("refs") >= min_docs)
    n_keys, n_lines = frequent.count(), lines.count()
    shards = max(1, math.ceil(n_keys / SHARD_KEYS))
    salts = max(1, math.ceil(n_lines / shards / GROUP_ROWS))
    filters = stash(build_filters(frequent, shards), "line-filters")
    positive = probe(lines, filters, shards, salts)
    exact = F.broadcast(frequent) if n_keys <= BROADCAST_KEYS else frequent
    sure = positive.join(exact.select("line"), "line")
    return sure.groupBy(*KEY).agg(F.collect_set("line").alias("__llm_drop"))


def drop_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with kept_text (other lines, joined by newline), n_lines and n_dropped."""
    docs = docs.drop("kept_text", "n_lines", "n_dropped")
    lost = frequent_lines(docs, min_docs, min_chars)
    k = [c + "d" for c in KEY]
    lost = lost.select(*[F.col(a).alias(b) for a, b in zip(KEY, k)], "__llm_drop")
    rows = with_row_key(docs).join(lost, [F.col(a) == F.col(b) for a, b in zip(KEY, k)], "left").drop(*k, *KEY)
    names = rows.columns
    text_at, drop_at = names.index("text"), names.index("__llm_drop")

    def apply(batches):
        for b in batches:
            kept, n_lines, n_dropped = [], [], []
            for text, drop in zip(utf8(b.column(text_at)), b.column(drop_at).to_pylist()):
                lines = text.split(b"\n")
                n_lines.append(len(lines))
                if drop:
                    drop = set(drop)
                    lines = [x for x in lines if digest(line_key(x)) not in drop]
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append(b"\n".join(lines))
            cols = [b.column(i) for i in range(len(names)) if i != drop_at]
            cols += [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(cols, [*[c for c in names if c != "__llm_drop"], "kept_text", "n_lines", "n_dropped"])

    schema = rows.drop("__llm_drop").schema.add("kept_text", "string").add("n_lines", "long").add("n_dropped", "long")
    return rows.mapInArrow(apply, schema)
