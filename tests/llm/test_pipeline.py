"""The registered training-data queries and the pipeline."""

import os
from collections import Counter

import brute
import pytest
from conftest import SF

import corpus_pipeline
from sensorgrid.llm import quality, queries

pytestmark = pytest.mark.skipif(not os.path.exists(SF), reason="test data not present")


def test_ten_queries_are_registered():
    import __spark_entry__ as entry
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names and set(queries.ORACLE) < set(names)


def test_pipeline_against_brute_force(spark):
    """Every stage's input is what the one before kept; the last gives each emitted document's ids."""
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    kept = [d for d in docs if not brute.op2_base(d[1])["base_failed"] and quality.verdict(quality.Doc((d[1] or "").encode()), quality.RULES) is None]
    component = {k[0]: k[2] for k in brute.op9([d[:2] for d in kept])}
    kept = [d for d in kept if component[d[0]] == d[0]]
    clean = {k[0]: not k[-1] for k in brute.op4([d[:2] for d in kept], items)}
    kept = [d for d in kept if clean[d[0]]]
    from sensorgrid.llm import mixing
    mixed = mixing.mix(spark.createDataFrame(kept, "doc_id long, text string, lang string, source string, n_chars long"))
    copies = {r.doc_id: r.copies for r in mixed.select("doc_id", "copies").collect()}
    want = brute.op3([d[:2] for d in kept for _ in range(copies[d[0]])])
    got = [tuple(r) for r in corpus_pipeline.run(spark, SF).collect()]
    assert len(got) == len(want) and Counter((g[0], *g[1:]) for g in got) == Counter(want)


def test_stages_take_odd_rows_and_return_the_columns_of_documents(spark, edge, nothing):
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, edge, SF)
        assert out.count() <= 2 * edge.count(), name
        if name != "token_shards":
            assert out.columns == edge.columns, name
        assert stage(spark, nothing, SF).count() == 0, name
