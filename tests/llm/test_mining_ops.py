"""Collocations, fingerprints and ranked search against plain versions of their contracts."""

import random

import brute
import pytest
from conftest import LONG, rows_of
from pyspark.sql import functions as F

from sensorgrid.llm import collocations, fingerprints, rankedsearch


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


# ---- collocations

def mined(df, **kw):
    return sorted(tuple(r) for r in collocations.mine(df, **kw).collect())


PHRASES = [("en", "new york, New York new york city.\nnew\tyork"), ("en", "New York City is big; new york city"), (None, "a a a a a a"),
           ("und", "A a\x0bb c"), ("en", None), ("fr", ""), ("fr", "a a a"), ("en", "new york"), ("en", "new york"), ("é", "x\x1cy x\x1cy é É é É é")]


@pytest.mark.parametrize("block, least, known", [(1, 2, 0), (5, 1, 500_000), (1 << 18, 3, 3)])
def test_collocations_small_texts(spark, monkeypatch, block, least, known):
    """Blocks of any size; frequent groups joined, broadcast, or some of either."""
    monkeypatch.setattr(collocations, "BLOCK", block)
    monkeypatch.setattr(collocations, "KNOWN_ROWS", known)
    docs = spark.createDataFrame(PHRASES, "lang string, text string").repartition(2)
    assert mined(docs, min_count=least) == sorted(brute.op11(PHRASES, least=least))


def test_collocations_random(spark):
    r = random.Random(4)
    rows = [(r.choice(["en", "de", None]), "".join(r.choice(["a ", "b ", "b c ", "d. ", "a b c ", "É\t"]) for _ in range(r.randrange(60)))) for _ in range(80)]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    for longest, top in ((5, 2000), (2, 3), (3, 7)):
        assert mined(docs, longest=longest, min_count=6, top=top) == sorted(brute.op11(rows, longest, 6, top))


def test_collocations_sample(small):
    docs = small("documents")
    rows = [tuple(r) for r in docs.select("lang", "text").collect()]
    assert mined(docs) == sorted(brute.op11(rows))
    assert mined(docs, min_count=40) == sorted(brute.op11(rows, least=40))


def test_collocations_edge(spark, edge, nothing):
    rows = [tuple(r) for r in edge.select("lang", "text").collect()]
    assert mined(edge, min_count=3, longest=3) == sorted(brute.op11(rows, 3, 3))
    assert mined(nothing) == []
    assert mined(spark.createDataFrame([("en", None), (None, " . ")], "lang string, text string")) == []


def test_collocation_scores_are_exact_beyond_64_bits(spark):
    big = 4_000_000_000_000
    level = lambda rows: spark.createDataFrame(rows, "lang string, words array<string>, f long")
    levels = [level([("en", ["a"], 3 * big), ("en", ["b"], big + 7)]), level([("en", ["a", "b"], big - 1)])]
    got = collocations.scored(levels, spark.createDataFrame([("en", 90 * big + 1)], "lang string, n long")).collect()
    assert [(r.l, r.r, r.score) for r in got] == [(3 * big, big + 7, 1000 * (big - 1) * (90 * big + 1) // (3 * big * (big + 7)))]


# ---- fingerprints

def sketched(df, **kw):
    cols = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    return {r[0]: tuple(r)[1:] for r in fingerprints.fingerprint_pairs(df, **kw).select(*cols).collect()}


def test_fingerprints_sample(small):
    docs = small("documents")
    assert sketched(docs) == brute.op12(pairs(docs))


@pytest.mark.parametrize("block", [1, 4, 1024])
def test_fingerprints_across_blocks(spark, block):
    r = random.Random(block)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(r.choice(words) for _ in range(r.choice([0, 1, 3, 5, 40, 900])))) for i in r.sample(range(-50, 10_000), 40)]
    rows += [(-9_000_000_000, None), (2 ** 62, LONG), (None, "É no id  here")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    assert sketched(docs, block=block) == brute.op12(rows)


def test_fingerprints_edge(spark, edge, nothing):
    rows = fingerprints.fingerprint_pairs(edge).collect()
    assert sorted(map(str, (r.doc_id for r in rows))) == sorted(map(str, (d for d, _ in pairs(edge))))
    text = dict((d, t) for d, t in pairs(edge) if d is not None)
    by_text = {}
    for r in rows:
        assert 0 <= min(r.near_edited, r.near_next, r.contained_edited, r.contained_next) and max(r.near_edited, r.near_next) <= 1
        if r.doc_id is not None:  # equal texts have equal fingerprints
            assert by_text.setdefault(text[r.doc_id] or "", r.fingerprint) == r.fingerprint
            assert r.fingerprint == "".join(f"{h & (1 << 64) - 1:016x}" for h in brute.op12_sketch(text[r.doc_id]))
    copies = sorted(r.near_next for r in rows if r.doc_id == 5)
    assert copies[-1] == 1.0  # one of two equal rows follows the other
    assert fingerprints.fingerprint_pairs(nothing).count() == 0
    one = spark.createDataFrame([(3, "a b c d e f")], "doc_id long, text string")
    got = fingerprints.fingerprint_pairs(one).first()
    assert got.near_next == 1.0 and got.edited_sha256 == brute.sha("a b c d " + "a b")


def test_sketches_merge_and_estimate(spark):
    r = random.Random(9)
    words = [f"w{i}" for i in range(4000)]
    a, b = " ".join(r.choices(words, k=6000)), " ".join(r.choices(words, k=300))
    inside = a[1000:4000]
    near = " ".join(x if r.random() > .02 else "zz" for x in a.split(" "))
    rows = [(a, b), (a, inside), (a, near), (b, b), ("", a), ("", "")]
    df = spark.createDataFrame(rows, "x string, y string")
    df = fingerprints.with_sketch(fingerprints.with_sketch(df, F.col("x"), "s"), F.col("y"), "t")
    like, held = (f(F.col("s"), F.col("t")) for f in (fingerprints.likeness, fingerprints.containment))
    for row in df.select("*", like.alias("like"), held.alias("held"), fingerprints.merged(F.col("s"), F.col("t")).alias("m")).collect():
        p, q = brute.op12_shingles(row.x), brute.op12_shingles(row.y)
        exact = len(p & q) / len(p | q) if p | q else 1.0
        assert abs(row.like - exact) < .06, (row.like, exact)
        if p and q:
            assert abs(row.held - len(p & q) / min(len(p), len(q))) < .12
        both = sorted(p | q)
        kept = [h for h in both if h < fingerprints.BELOW]
        assert row.m == (kept if len(kept) >= 64 else both[:64])


def test_fingerprints_use_no_python(small):
    plan = fingerprints.fingerprint_pairs(small("documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "MapIn" not in plan


# ---- ranked search

def found(docs, items, **kw):
    return rows_of(rankedsearch.search(docs, items, **kw).select("item_id", "rank", "doc_id", "score"))


def test_ranked_search_sample(small):
    docs, bench = small("documents"), small("benchmark")
    assert found(docs, bench) == brute.op13(pairs(docs), [tuple(r) for r in bench.select("item_id", "text").collect()])


@pytest.mark.parametrize("cells, block", [(1, 8 << 20), (50, 60)])
def test_ranked_search_random(spark, monkeypatch, cells, block):
    """Small chunks, several blocks of items, many ties."""
    monkeypatch.setattr(rankedsearch, "CELLS", cells)
    r = random.Random(block)
    text = lambda n: " ".join(r.choice(["a", "B", "c1", "É", "x-y", "z"]) for _ in range(r.randrange(n)))
    docs = [(i if i else None, text(9)) for i in range(60)] + [(7, "a"), (7, "a"), (99, None)]
    items = [(i, text(9)) for i in range(9)] + [(None, "a B"), (50, "a a B"), (50, "a a B"), (51, None), (52, " - "), (53, "unseen")]
    got = found(spark.createDataFrame(docs, "doc_id long, text string").repartition(6), spark.createDataFrame(items, "item_id long, text string"), k=4, block_bytes=block)
    assert got == brute.op13(docs, items, 4)


def test_ranked_search_edge(spark, edge, nothing, items):
    assert found(edge, items) == brute.op13(pairs(edge), [tuple(r) for r in items.collect()])
    assert not found(nothing, items) and not found(edge, items.limit(0)) and not found(nothing, items.limit(0))


def test_batches_end_by_bytes_and_the_setting_comes_back(spark):
    from sensorgrid.llm.common import batches_of
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)

    def sizes(batches):
        import pyarrow as pa
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])
    df = spark.range(0, 64, 1, 1).select(F.repeat(F.lit("x"), 100_000).alias("t"))
    with batches_of(spark, 1 << 20):
        n = [r.n for r in df.mapInArrow(sizes, "n long").collect()]
    assert sum(n) == 64 and max(n) <= 16 and spark.conf.get(key) == before
