"""Line dedup, quality rules, decontamination, SimHash, mixing against brute force and edge cases."""

import random
from collections import Counter

import brute
import numpy as np
import pytest
from conftest import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sensorgrid.llm import decontaminate, linededup, mixing, quality, simhash


def pairs(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


# ---- line dedup


def op1(df):
    out = linededup.drop_lines(df)
    return rows_of(out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)))


def test_lines_edge(edge, edge_rows):
    got = op1(edge)
    assert got == brute.op1(edge_rows)
    assert any(k[2] == 3 for k in got)  # the shared line goes in each of its spellings


def test_lines_small(small):
    assert op1(small("documents")) == brute.op1(pairs(small("documents")))


def test_lines_empty(nothing):
    assert linededup.drop_lines(nothing).count() == 0


def test_lines_keep_columns(edge):
    out = linededup.drop_lines(edge)
    assert set(edge.columns) <= set(out.columns) and out.filter("line != 'clash'").count() == 0


def test_counts_are_reversible(spark):
    """Inserting a batch and deleting it again gives the old counts and filters that agree with them."""
    old = spark.createDataFrame([(i, f"x\nold {i % 3}") for i in range(30)], "doc_id long, text string")
    new = spark.createDataFrame([(100 + i, "x\nnew\nold 0") for i in range(12)], "doc_id long, text string")
    count = lambda d: linededup.reference_counts(linededup.line_rows(d))
    before = count(old).cache()
    grown = linededup.merge_counts(before, count(new)).cache()
    back = linededup.merge_counts(grown, count(new), -1)
    assert rows_of(back) == rows_of(before)
    refs = {r.line: r.refs for r in grown.collect()}
    assert sorted(refs.values()) == [10, 10, 12, 22, 42]
    filters = linededup.build_filters(before.filter("refs >= 11"), 2).cache()
    after = linededup.update_filters(filters, before, grown, 2, 11).cache()
    again = linededup.update_filters(after, grown, before, 2, 11)
    def members(fs):
        fs = {r["shard"]: linededup.CuckooFilter.load(r["filter"]) for r in fs.collect()}
        rows = grown.select("line", linededup.shard_of(2)).collect()
        return {bytes(r["line"]) for r in rows if r["shard"] in fs and fs[r["shard"]].contains([bytes(r["line"])])[0]}
    assert members(after) == {k for k, v in refs.items() if v >= 11}
    assert members(again) == {r.line for r in before.filter("refs >= 11").collect()}


@settings(max_examples=20, deadline=None)
@given(st.integers(0, 3000), st.integers(0, 99))
def test_cuckoo_filter(n, seed):
    r = random.Random(seed)
    keys = [r.randbytes(16) for _ in range(n)]
    f = linededup.CuckooFilter.load(linededup.CuckooFilter.of(keys).dump())
    assert f.contains(keys).all()
    assert all(f.delete(k) for k in keys) and not f.table.any()
    other = [r.randbytes(16) for _ in range(2000)]
    assert linededup.CuckooFilter.of(keys).contains(other).mean() < 0.01


# ---- quality rules


def test_quality_base(edge, edge_rows, small):
    for df, rows in ((edge, edge_rows), (small("documents"), pairs(small("documents")))):
        out = quality.judge(df)
        base = list(brute.op2_base(""))
        assert rows_of(out.select("doc_id", *base)) == Counter((d, *brute.op2_base(t).values()) for d, t in rows)
        assert out.filter("kept and base_failed").count() == 0


def test_quality_order_changes_cost_only(small):
    docs = small("documents").select("doc_id", "text")
    kept = rows_of(quality.judge(docs).select("doc_id", "kept"))
    assert kept == rows_of(quality.judge(docs, rules=tuple(reversed(quality.RULES)), sample=5).select("doc_id", "kept"))


def test_quality_cascade_order():
    rules = [quality.Rule(n, lambda d: False) for n in "abc"]
    got = quality.order_rules(rules, [("a", 0.1, 1.0), ("b", 0.1, 0.1), ("c", 0.0, 0.01)])
    assert [r.name for r in got] == ["b", "a", "c"]
    run = []
    trace = [quality.Rule(n, lambda d, n=n: run.append(n) or n == "b") for n in "abc"]
    assert quality.verdict(quality.Doc(b"x"), trace) == "b" and run == ["a", "b"]


def test_quality_rejects_junk():
    good = " ".join(f"Wort{i} und etwas mehr Text." for i in range(40))
    bad = {"symbols": good.replace(" ", " | "), "capitals": good.upper(), "exclamations": good.replace(" ", "! "), "dup_lines": "\n".join([good[:300]] * 2 + [good] * 5),
           "long_words": " ".join(f"{'x' * 40}{i}" for i in range(60)), "one_word": " ".join(f"a b{i}" for i in range(60)), "digits": " ".join(str(10 ** 6 + i) for i in range(60))}
    assert quality.verdict(quality.Doc(good.encode()), quality.RULES) is None
    for name, text in bad.items():
        assert name in [r.name for r in quality.RULES if r.rejects(quality.Doc(text.encode()))]


def test_quality_empty(nothing):
    assert quality.judge(nothing).count() == 0


# ---- decontamination


def op4(docs, items):
    return rows_of(decontaminate.decontaminate(docs, items).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"))


def test_decontaminate_edge(edge, edge_rows, items):
    got = op4(edge, items)
    assert got == brute.op4(edge_rows, [tuple(r) for r in items.collect()])
    assert sum(n for k, n in got.items() if k[-1]) >= 6


def test_decontaminate_small(small):
    want = brute.op4(pairs(small("documents")), [tuple(r) for r in small("benchmark").collect()])
    assert op4(small("documents"), small("benchmark")) == want and any(k[-1] for k in want)


@pytest.mark.parametrize("lists", [1, 3, 10])
def test_decontaminate_any_number_of_lists(edge, edge_rows, items, lists):
    out = decontaminate.decontaminate(edge, items, lists=lists).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(out) == brute.op4(edge_rows, [tuple(r) for r in items.collect()])


def test_decontaminate_random(spark):
    """Few words, so windows overlap, repeat and share their rarest terms."""
    r = random.Random(5)
    text = lambda n: " ".join(r.choice("aAbBcdé") for _ in range(n))
    docs = [(i, text(r.randrange(60))) for i in range(60)]
    items = [(i, text(r.choice([1, 3, 4, 6]))) for i in range(8)]
    d, b = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.decontaminate(d, b, width=4).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert rows_of(out) == brute.op4(docs, items, width=4)


def test_decontaminate_empty(nothing, edge, items):
    assert decontaminate.decontaminate(nothing, items).count() == 0
    assert decontaminate.decontaminate(edge, items.limit(0)).filter("contaminated").count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x b y a z c"), (2, "a x x x x b x c"), (3, "c b a"), (4, "a b"), (5, None)], "doc_id long, text string")
    items = spark.createDataFrame([(9, "A b C")], "item_id long, text string")
    got = {(r.doc_id, r.dpos) for r in decontaminate.proximity_matches(docs, items, 5).collect()}
    assert got == {(1, 1), (3, 0)}


def test_index_of_every_word(spark):
    docs = spark.createDataFrame([(1, "a B. a")], "doc_id long, text string")
    rows = decontaminate.build_index(docs).join(spark.createDataFrame([("a",), ("b",)], "w string").select("w", F.xxhash64("w").alias("term")), "term")
    assert sorted((r.w, r.pos) for r in rows.collect()) == [("a", 0), ("a", 2), ("b", 1)]


# ---- SimHash


def test_fingerprints(edge_rows):
    for _, t in edge_rows:
        assert simhash.fingerprint((t or "").encode()) == brute.op9_fingerprint(t)


def test_simhash_edge(edge, edge_rows, small):
    assert rows_of(simhash.near_duplicates(edge)) == brute.op9(edge_rows)
    assert rows_of(simhash.near_duplicates(small("documents"))) == brute.op9(pairs(small("documents")))


def near_values(n, seed):
    """Fingerprints in tight and loose groups, all 64 bits in use."""
    r = random.Random(seed)
    out = set()
    for _ in range(n // 20):
        base = r.getrandbits(64)
        for _ in range(20):
            out.add(base)
            base ^= sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 3, 4, 5])))
    return sorted(out)


def brute_classes(values, bits):
    up = {v: v for v in values}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, a in enumerate(values):
        for b in values[i + 1:]:
            if (a ^ b).bit_count() <= bits:
                up[find(a)] = find(b)
    groups = {}
    for v in values:
        groups.setdefault(find(v), set()).add(v)
    return {frozenset(g) for g in groups.values()}


def spark_classes(spark, values, bits=3):
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    got = simhash.components(simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), bits)).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.root, set()).add(r.node % (1 << 64))
    linked = set().union(*groups.values()) if groups else set()
    return {frozenset(g) for g in groups.values()} | {frozenset([v]) for v in values if v not in linked}


@pytest.mark.parametrize("bits", [1, 3])
def test_links(spark, bits):
    values = near_values(300, 3)
    assert spark_classes(spark, values, bits) == brute_classes(values, bits)


def test_links_of_a_hot_group(spark, monkeypatch):
    """Values that share one segment go through the second-level keys and lose no link."""
    r = random.Random(9)
    values = sorted({(7 << 32) ^ (1 << r.randrange(32, 64) if r.random() < .3 else 0) ^ r.getrandbits(32) & 0x0F0F00FF for _ in range(400)} | set(near_values(60, 1)))
    monkeypatch.setattr(simhash, "BUCKET", 40)
    assert spark_classes(spark, values) == brute_classes(values, 3)


def test_near_by_lookup():
    """A set beyond the direct comparison's size is solved by looking up its neighbours."""
    r = random.Random(2)
    values = np.array(sorted({r.getrandbits(14) << 20 for _ in range(9000)}), np.uint64)
    old = simhash.BUCKET
    try:
        simhash.BUCKET = 100
        fast = simhash.near(values, 1)
        simhash.BUCKET = 1 << 20
        assert (fast == simhash.near(values, 1)).all()
    finally:
        simhash.BUCKET = old


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)]
    star = [(1000, 1001 + i) for i in range(50)]
    r = random.Random(4)
    rest = [(r.randrange(2000, 2060), r.randrange(2000, 2060)) for _ in range(30)]
    got = {x.node: x.root for x in simhash.components(spark.createDataFrame(chain + star + rest, "a long, b long")).collect()}
    assert len({got[i] for i in range(61)}) == 1 and len({got[i] for i in range(1000, 1051)}) == 1
    for a, b in rest:
        assert a == b or got[a] == got[b]
    assert len({got[0], got[1000]}) == 2


def test_keep_one(edge, edge_rows, nothing):
    kept = simhash.keep_one(edge)
    classes = brute.op9(edge_rows)
    assert kept.columns == edge.columns
    assert kept.count() == len({brute.op9_fingerprint(t) for _, t in edge_rows} and {k[2] for k in classes})
    assert simhash.near_duplicates(nothing).count() == 0 and simhash.keep_one(nothing).count() == 0


# ---- mixing


def test_targets(spark):
    r = random.Random(1)
    for _ in range(4):
        sizes = {s: r.choice([0, 1, 10, 500, 10 ** 6]) for s in ["a", "b", "é", "z", None, "B"]}
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {x.source: x.target for x in mixing.source_targets(df).collect()}
        want = brute.op10_targets(sizes)
        assert all(abs(got[s] - want[s]) < 1e-6 * max(1, want[s]) for s in sizes)


def test_mix(edge, edge_rows, small):
    for df in (edge, small("documents")):
        out = mixing.mix(df).cache()
        assert rows_of(out.select("doc_id", "size")) == Counter((d, len(brute.WORD.findall(t or ""))) for d, t in pairs(df))
        assert out.filter("taken > 2 * size or taken < 0 or copies > 2").count() == 0
        by = out.groupBy("source").agg(F.sum("size").alias("s"), F.first("target").alias("t"), F.sum("taken").alias("k"), F.max("size").alias("m")).collect()
        want = brute.op10_targets({r.source: r.s for r in by})
        for r in by:
            assert abs(r.t - want[r.source]) < 1e-6 * max(1, r.t) and abs(r.k - r.t) <= r.m
        assert rows_of(out.select("doc_id", "source", "taken")) == rows_of(mixing.mix(df.repartition(5)).select("doc_id", "source", "taken"))


def test_mix_comes_near(spark):
    r = random.Random(8)
    rows = [(i, "w " * int(r.lognormvariate(4, 1)), r.choice("aaab")) for i in range(3000)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string"), weights=(1, 5), share=0.8)
    for x in out.groupBy("source").agg(F.first("target").alias("t"), F.sum("taken").alias("k")).collect():
        assert abs(x.k - x.t) < 0.02 * x.t


def test_emit(edge, nothing):
    m = mixing.mix(edge)
    assert mixing.emit(m).count() == m.agg(F.sum("copies")).first()[0]
    assert mixing.mix(nothing).count() == 0
