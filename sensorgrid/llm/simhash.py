"""SimHash near-dedup with deletion-variant signatures.

:func:`fingerprints` gives each text the 64-bit SimHash of its word shingles. To find the
fingerprints that differ in at most 3 bits, :func:`links` cuts them into 2 segments of 32
bits, so that one segment differs in at most one bit, and indexes, for each segment, its 32
one-wildcard variants (the position of the wildcard and the other 31 bits). Fingerprints with
an equal variant are compared in full. :func:`components` joins the links to classes.

Scale: everything past the texts runs on distinct fingerprints, so a group of exact copies is
one row. Within a bucket of equal variants only links to the bucket's local class root are
emitted, never its pairs. A bucket that may hold more than :data:`BUCKET` fingerprints (a
large group of near copies) is split: its members must also agree in one half of the other
segment but for one bit, which gives second-level buckets of at most 2^18 members, solved by
looking up the 987 fingerprints around each member instead of comparing pairs. Classes come
from contraction: every node points to its smallest neighbour, the pointers are followed to
their roots, and the links between roots go round again; each round at least halves the nodes.

Defined cases: null, empty or word-less text has fingerprint 0, linked like any other; fewer
words than a shingle make one shingle of the whole sequence; repeated rows fall into one
class; a null doc_id is never a component_id unless its class has no other; an empty table
gives an empty result; input columns named like an output are replaced.
"""

from __future__ import annotations

from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorgrid.llm.common import KEY, pack_hash, small_batches, stash, utf8, with_row_key

SHINGLE = 3
MAX_BITS = 3
SEED = 42
#: Largest bucket compared directly; larger ones are split by second-level keys.
BUCKET = 4096


def shingle_hashes(text: bytes, n: int = SHINGLE) -> list[int]:
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return []
    flat = b" ".join(words)
    if len(words) <= n:
        return [xxhash.xxh64_intdigest(flat, SEED)]
    ends = list(accumulate([len(w) + 1 for w in words]))
    h = xxhash.xxh64_intdigest
    return [h(flat[a:b - 1], SEED) for a, b in zip([0, *ends], ends[n - 1:])]


def fingerprint(text: bytes, n: int = SHINGLE) -> int:
    """A bit is set if it is set in more than half of the shingles' hashes (repeats included)."""
    hashes = shingle_hashes(text, n)
    if not hashes:
        return 0
    ones = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 16):  # bounds the unpacked bits of a very long text
        part = np.array(hashes[i:i + (1 << 16)], np.uint64).view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, n: int = SHINGLE) -> DataFrame:
    """(key, doc_id, fp long): the fingerprint's bits as a signed long."""
    small_batches(docs.sparkSession)

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, n) for t in utf8(b.column(3))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(fp)], [*KEY, "doc_id", "fp"])

    rows = with_row_key(docs).select(*KEY, "doc_id", "text")
    return rows.mapInArrow(run, rows.drop("text").schema.add("fp", "long"))


def near(fps: np.ndarray, bits: int = MAX_BITS) -> np.ndarray:
    """For sorted distinct fingerprints: the index of the root of each one's class, where
    fingerprints that differ in at most ``bits`` bits are linked. Breadth-first; the links of
    a frontier are found by comparing it with all in blocks, or, for large sets that differ
    in few bit positions, by looking up every fingerprint around it."""
    n = len(fps)
    free = [int(p) for p in range(64) if (np.bitwise_or.reduce(fps ^ fps[0]) >> np.uint64(p)) & np.uint64(1)]
    masks = None
    if n > BUCKET:
        masks = [np.uint64(sum(1 << p for p in c)) for k in range(1, bits + 1) for c in combinations(free, k)]
        masks = None if len(masks) > n else masks
    root = np.full(n, -1, np.int64)
    for i in range(n):
        if root[i] >= 0:
            continue
        root[i], front = i, np.array([i])
        while len(front):
            if masks is not None:
                hit = np.zeros(n, bool)
                for m in masks:
                    x = fps[front] ^ m
                    at = np.searchsorted(fps, x)
                    at[at == n] = n - 1
                    hit[at[fps[at] == x]] = True
                new = np.flatnonzero(hit & (root < 0))
            else:
                rest, hit = np.flatnonzero(root < 0), []
                block = max(1, (1 << 22) // max(1, len(rest)))
                found = np.zeros(len(rest), bool)
                for j in range(0, len(front), block):
                    found |= (np.bitwise_count(fps[rest][None, :] ^ fps[front[j:j + block]][:, None]) <= bits).any(axis=0)
                new = rest[found]
            root[new] = i
            front = new
    return root


def bucket_links(buckets: DataFrame, keys: list[str], bits: int) -> DataFrame:
    """(a, b): links from each fingerprint to the root of its class within its bucket.
    ``buckets`` (keys..., fp); rows of a bucket follow each other after the sort, and a bucket
    that spans Arrow batches is carried over."""
    def solve(fps: np.ndarray, out: list) -> None:
        fps = np.unique(fps)
        if len(fps) > 1:
            root = near(fps, bits)
            own = root != np.arange(len(fps))
            out.append((fps[own], fps[root[own]]))

    def run(batches):
        held: list[np.ndarray] = []
        last = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(i).to_numpy(zero_copy_only=False) for i in range(len(keys))]
            fps = b.column(len(keys)).to_numpy(zero_copy_only=False).view(np.uint64)
            new = np.zeros(len(fps), bool)
            new[0] = True
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            cut = np.append(np.flatnonzero(new), len(fps))
            out: list = []
            if last is not None and last != tuple(c[0] for c in cols):
                solve(np.concatenate(held), out)
                held = []
            size = np.diff(cut)
            inner = np.arange(len(size)) < len(size) - 1
            if held:  # the first run goes on with what is held
                inner[0] = False
            two = cut[:-1][inner & (size == 2)]
            ok = np.bitwise_count(fps[two] ^ fps[two + 1]) <= bits
            ok &= fps[two] != fps[two + 1]
            out.append((fps[two + 1][ok], fps[two][ok]))
            for r in np.flatnonzero(inner & (size > 2)):
                solve(fps[cut[r]:cut[r + 1]], out)
            if held and len(size) > 1:
                solve(np.concatenate([*held, fps[:cut[1]]]), out)
                held = []
            held.append(fps[cut[-2]:])
            last = tuple(c[-1] for c in cols)
            a, z = (np.concatenate(x).view(np.int64) for x in zip(*out))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(z)], ["a", "b"])
        if held:
            out = []
            solve(np.concatenate(held), out)
            for a, z in out:
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(z.view(np.int64))], ["a", "b"])

    dealt = buckets.repartition(*keys).sortWithinPartitions(*keys, "fp").select(*keys, "fp")
    return dealt.mapInArrow(run, "a long, b long")


def links(fps: DataFrame, bits: int = MAX_BITS) -> DataFrame:
    """(a, b) links that join every class of the distinct fingerprints ``fps`` (fp)."""
    if not 0 <= bits <= 3:
        raise ValueError("two segments with one wildcard each find up to 3 differing bits")
    high = 0xFFFFFFFF
    segments = fps.select("fp", F.explode(F.array(*[F.struct(F.lit(s).alias("s"), F.expr(f"shiftrightunsigned(fp, {32 * s}) & {high}L").alias("v"),
                                                             F.expr(f"shiftrightunsigned(fp, {32 - 32 * s}) & {high}L").alias("o")) for s in (0, 1)])).alias("x")).select("fp", "x.*")
    # variant: segment, wildcard position, the other 31 bits
    variant = "cast(s as long) << 40 | cast(p as long) << 32 | (v & ~(1L << p))"
    variants = segments.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(31)))).select("fp", "o", F.expr(variant).alias("key"))
    heavy = segments.groupBy("s", "v").count().filter(F.col("count") > BUCKET // 2)
    hot = stash(heavy.withColumn("p", F.explode(F.sequence(F.lit(0), F.lit(31)))).select(F.expr(variant).alias("key")).distinct(), "hot-variants")
    if hot.isEmpty():
        return bucket_links(variants, ["key"], bits)
    cold = bucket_links(variants.join(hot, "key", "left_anti"), ["key"], bits)
    # the other segment differs in 3 bits at most, so one of its halves in one at most
    sub = "cast(h as long) << 24 | cast(q as long) << 16 | (shiftrightunsigned(o, 16 * h) & 65535L & ~(1L << q))"
    split = (variants.join(hot, "key").withColumn("hq", F.explode(F.sequence(F.lit(0), F.lit(31))))
             .withColumns({"h": F.expr("hq div 16").cast("int"), "q": F.expr("hq % 16").cast("int")})
             .select("key", F.expr(sub).alias("sub"), "fp"))
    return cold.unionByName(bucket_links(split, ["key", "sub"], bits))


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node of the undirected graph ``edges`` (a, b)."""
    steps = []
    edges = stash(edges.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = stash(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("root")), "pointers")
        while True:  # follow the pointers to their roots
            up = to.select(F.col("node").alias("root"), F.col("root").alias("up"))
            nxt = stash(to.join(up, "root").select("node", F.col("up").alias("root"), (F.col("up") != F.col("root")).alias("moved")), "pointers")
            to = nxt.drop("moved")
            if nxt.filter("moved").isEmpty():
                break
        steps.append(to)
        ra, rb = to.select(F.col("node").alias("a"), F.col("root").alias("ra")), to.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        edges = stash(edges.join(ra, "a").join(rb, "b").filter("ra != rb")
                      .select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct(), "edges")
    if not steps:
        return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    out = steps[0]
    for to in steps[1:]:
        up = to.select(F.col("node").alias("root"), F.col("root").alias("up"))
        out = out.join(up, "root", "left").select("node", F.coalesce("up", "root").alias("root"))
    return out


def classes(docs: DataFrame, n: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """(key, doc_id, fp, component_id, first): one row per document; ``first`` is the smallest
    (doc_id, key) of the class, nulls last, as a struct."""
    rows = stash(fingerprints(docs, n), "fingerprints")
    least = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *KEY)).alias("first")
    fps = stash(rows.groupBy("fp").agg(least), "distinct-fingerprints")
    found = components(links(fps.select("fp"), bits))
    root = fps.join(found.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    root = stash(root, "roots")
    best = root.groupBy("root").agg(F.min("first").alias("first"))
    of = root.select("fp", "root").join(best, "root").select("fp", "first")
    return rows.join(of, "fp").withColumn("component_id", F.col("first.doc_id"))


def near_duplicates(docs: DataFrame, n: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, one row per document."""
    out = classes(docs, n, bits)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame, n: int = SHINGLE, bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each class: the one of the smallest doc_id, then row key."""
    firsts = classes(docs, n, bits).select("first").distinct().select(*[F.col(f"first.{k}").alias(k) for k in KEY])
    # of rows of equal id and text the one of the least digest over all columns
    rows = with_row_key(docs).withColumn("__llm_row", pack_hash(docs)).join(firsts, KEY, "left_semi")
    one = rows.groupBy(*KEY).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in docs.columns]), "__llm_row").alias("__llm_one"))
    return one.select(*[F.col(f"__llm_one.`{c}`") for c in docs.columns])
