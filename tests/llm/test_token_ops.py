"""Token shards and token counts: exact round trips and the libraries' own results."""

import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from conftest import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from sensorgrid.llm import tokencounts, tokens

BPE, PIECE = str(public_tokenizers.path("word_bpe_49k.json")), str(public_tokenizers.path("piece_bpe_32k.model"))
ODD = ["", " ", "  ", "a", " a", "a ", "a  b", "   a b  ", "a\nb\tc", "\n", "x▁y ▁", "▁", "<s>a</s>", "\xa0　x", "日本 語", "0 00 a0", "é É İ ß K", "don't I'll 'S",
       "<|endoftext|>x <|startoftext|>", "\x1c\x1fa\x85b", "word" * 200, "a" + " " * 40 + "b", "🙂🙂 🙂", "﻿x", "½①ﬁ", "it's we'll !'s 'S O'Re", "a_b-c1²", "ǅ ŉ ſ", "Ωσς ΑΣ", "ж́й е\u0301", "x</w>y </w>", "मनीष ๑๒ 한국", "AB12cd!!%%%"]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 49407), st.integers(0, 3), st.just(0), st.integers(0, 2 ** 60 + 5), st.integers(2 ** 63, 2 ** 64 - 1)), max_size=900))
def test_simple8b_round_trip(ids):
    blob = tokens.encode_ids(np.array(ids, np.uint64))
    assert tokens.decode_ids(blob).tolist() == ids


def test_simple8b_blocks_and_size():
    ids = np.random.default_rng(1).integers(0, 32768, 70_000).astype(np.uint64)
    blob = tokens.encode_ids(ids)
    assert len(blob) < 2.01 * len(ids)
    n = len(range(0, (len(ids) + 3) // 4, tokens.BLOCK_WORDS))
    parts = [tokens.decode_ids(blob, slice(i, i + 1)) for i in range(n)]
    assert (np.concatenate(parts) == ids).all() and len(parts[0]) == 4 * tokens.BLOCK_WORDS
    assert len(tokens.encode_ids(np.zeros(2400, np.uint64))) < 150


def test_word_encoder_equals_library(edge_rows):
    e = tokens.WordEncoder(BPE)
    import random
    r = random.Random(3)
    mixed = ["".join(r.choice("aAéÉß'.,!%0 9\u0301\u00a0\n-_Ж中<|>/w") for _ in range(r.randrange(30))) for _ in range(400)]
    for t in [*ODD, *mixed, *[t or "" for _, t in edge_rows]]:
        assert e.encode(pa.array([t]))[0].tolist() == e.library.encode(t, add_special_tokens=False).ids, repr(t[:50])
    latin = ["".join(chr(r.randrange(0x20, 0x180)) for _ in range(r.randrange(30))) for _ in range(3000)]
    near = ["".join(r.choice("aAbéÉÀÖÿßµºª×÷ÞÐ'stdmlrve.,!%0 9-\n\t <|>/") for _ in range(r.randrange(40))) for _ in range(6000)]
    ids, size = e.encode(pa.array(latin + near))
    assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == [x.ids for x in e.library.encode_batch(latin + near, add_special_tokens=False)]
    ids, size = e.encode(pa.array(["x", None, *ODD, ""])[1:])
    assert np.split(ids, np.cumsum(size)[:-1])[3].tolist() == e.library.encode(ODD[2]).ids and size.sum() == len(ids) and len(size) == len(ODD) + 2


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_every_tokenizer_file_gives_the_library_ids(name, edge_rows):
    """A file that cuts texts otherwise is noticed, and whole texts go through the library."""
    e = tokens.WordEncoder(str(public_tokenizers.path(name)))
    assert e.by_pieces == (name == "word_bpe_49k.json")
    texts = ["Hello World again", "it's", *ODD, *[t or "" for _, t in edge_rows]]
    ids, size = e.encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(size)[:-1])] == [e.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_segment_counter_equals_library(edge_rows):
    c = tokencounts.SegmentCounter(PIECE)
    assert c.by_segment
    for t in [*ODD, *[t or "" for _, t in edge_rows]]:
        assert c.count([t]) == [len(c.library.encode(t))], repr(t[:50])


def test_segment_counter_equals_library_beside_literal_marks():
    import random
    r = random.Random(5)
    c = tokencounts.SegmentCounter(PIECE)
    texts = ["▁ ▁", "▁ 😀", "plain text", *["".join(r.choice("▁▁  ab😀\n") for _ in range(r.randrange(1, 14))) for _ in range(4000)]]
    assert c.count(texts) == [len(x) for x in c.library.encode(texts)]


def test_shards_small(small):
    docs = small("documents")
    got = [tuple(r) for r in tokens.token_table(docs, BPE).collect()]
    assert sorted(got) == brute.op3([tuple(r) for r in docs.select("doc_id", "text").collect()])


def test_shards_edge(edge, edge_rows, nothing):
    got = tokens.token_table(edge, BPE).collect()
    assert len(got) == len(edge_rows)
    t = tokens.WordEncoder(BPE).library
    want = Counter((d, zlib.crc32(np.array(t.encode(x or "", add_special_tokens=False).ids + [1], "<u4").tobytes())) for d, x in edge_rows)
    assert Counter((r.doc_id, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):  # the files hold every id once, in order of doc_id, null first
        assert r.start == at
        at += r.n_tokens
    ids = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    assert tokens.token_table(nothing, BPE).count() == 0


def test_counts(edge, edge_rows, nothing):
    out = tokencounts.count_tokens(edge, PIECE)
    assert rows_of(out.select("doc_id", "n_bytes", "n_tokens", "over_limit")) == brute.op8(edge_rows)
    assert tokencounts.count_tokens(nothing, PIECE).count() == 0


def test_counts_small(small):
    docs = small("documents")
    out = tokencounts.count_tokens(docs, PIECE, limit=200).select("doc_id", "n_bytes", "n_tokens", "over_limit")
    assert rows_of(out) == brute.op8([tuple(r) for r in docs.select("doc_id", "text").collect()], 200)


@pytest.mark.parametrize("share", [1, 4, 2000])
def test_counts_of_hot_texts(edge, edge_rows, monkeypatch, share):
    """Copies that hold much of the table get their count by broadcast, others by join."""
    monkeypatch.setattr(tokencounts, "HOT", share)
    copies = edge.unionByName(edge.filter("doc_id = 6").crossJoin(edge.sparkSession.range(40).select()))
    rows = edge_rows + [r for r in edge_rows if r[0] == 6] * 40
    assert rows_of(tokencounts.count_tokens(copies, PIECE).select("doc_id", "n_bytes", "n_tokens", "over_limit")) == brute.op8(rows)


def test_cache_encodes_distinct_misses_once(spark, edge, edge_rows, tmp_path):
    cache = str(tmp_path / "cache")
    distinct = len({t or "" for _, t in edge_rows})
    tokencounts.count_tokens(edge, PIECE, cache).count()
    assert spark.read.parquet(cache).count() == distinct
    more = edge.unionByName(spark.createDataFrame([(99, "quite new")], "doc_id long, text string"), allowMissingColumns=True)
    assert tokencounts.count_tokens(more, PIECE, cache).count() == len(edge_rows) + 1
    assert spark.read.parquet(cache).count() == distinct + 1
    stored = spark.read.parquet(cache)
    assert stored.select("digest").distinct().count() == distinct + 1
    # counts come from the cache: a changed entry shows
    version = tokencounts.tokenizer_version(PIECE)
    wrong = stored.selectExpr("digest", "tokenizer", "n_tokens * 0 - 5 as n_tokens")
    wrong.write.parquet(str(tmp_path / "wrong"))
    assert {r.n_tokens for r in tokencounts.count_tokens(edge, PIECE, str(tmp_path / "wrong")).collect()} == {-5}
    # another tokenizer's entries are not hits
    stored.selectExpr("digest", f"'not {version}' as tokenizer", "n_tokens").write.parquet(str(tmp_path / "other"))
    assert tokencounts.count_tokens(edge, PIECE, str(tmp_path / "other")).filter("n_tokens < 0").count() == 0


@pytest.mark.parametrize("memo", [0, 3])
def test_memos_are_bounded(memo, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", memo)
    monkeypatch.setattr(tokencounts, "MEMO", memo)
    e, c = tokens.WordEncoder(BPE), tokencounts.SegmentCounter(PIECE)
    texts = ["some words here", "and others", "some words"] * 50
    for i in range(0, len(texts), 7):
        ids, size = e.encode(pa.array(texts[i:i + 7]))
        assert ids.tolist() == [x for t in texts[i:i + 7] for x in e.library.encode(t, add_special_tokens=False).ids]
    assert c.count(texts) == [len(x) for x in c.library.encode(texts)]


def test_portions_bound_what_is_encoded_together():
    texts = ["aaa", None, "b", "cc", "dddddd", "", "e", "ff", "gg"]
    whole = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(texts)], ["doc_id", "text"])
    for batches in ([whole], [whole.slice(i, 2) for i in range(0, 9, 2)], [whole.slice(0, 0), whole]):
        got = list(tokens.portions(batches, 4))
        assert [k for ks, _ in got for k in ks] == list(range(9)) and [t for _, ts in got for t in ts.to_pylist()] == texts
        assert all(sum(len(t or "") for t in ts.to_pylist()) <= 4 or len(ts) == 1 for _, ts in got)
    assert tokens.as_bytes(pa.array(["x", "é", ""])[1:]) == ["é".encode(), b""] and tokens.as_bytes(pa.array([], pa.string())) == []
