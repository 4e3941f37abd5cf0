"""Thin registered queries: each applies its operator to its whole table and derives the result columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorgrid.llm import chat, classifier, collocations, decontaminate, fingerprints, htmltext, linededup, mixing, quality, rankedsearch, simhash, tokencounts, tokens
from sensorgrid.llm.common import read_table
from sensorgrid.llm.oracle import ORACLE  # noqa: F401  (registered beside QUERIES)


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's file; operators take the path as a parameter."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.drop_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality.judge(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op3_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.token_table(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), end_id=1)


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = classifier.fit(docs, read_table(spark, sf_dir, "labels"), label="quality", rows=20_000)
    return classifier.score(docs, model).select("doc_id", "held_out", "score", "predicted")


#: A conversation whose texts look like the template.
ODD = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = chat.format_conversations(turns.unionByName(spark.createDataFrame(ODD, "conv_id long, turn long, role string, text string")))
    return out.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(read_table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = tokencounts.count_tokens(read_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"), limit=4096)
    return out.select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(read_table(spark, sf_dir, "documents"), n=3, bits=3)


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", "taken")


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = collocations.mine(read_table(spark, sf_dir, "documents"), longest=5, min_count=100, top=2000)
    return out.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_pairs(read_table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rankedsearch.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {f.__name__: f for f in (
    op1_line_dedup, op2_quality_rules, op3_token_binary, op4_benchmark_decontamination, op5_quality_classifier, op6_chat_formatting,
    op7_html_extraction, op8_token_counts, op9_simhash_near_dedup, op10_mixing, op11_collocations, op12_fingerprints, op13_ranked_search)}
