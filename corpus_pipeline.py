"""Corpus pipeline: quality rules, near-dedup, decontamination, mixing, token shards.

``STAGES`` are (name, function) pairs. A function takes (spark, docs, sf_dir) and returns a
DataFrame; each result is written as Parquet and reread as the next stage's ``docs``. All but
the last return the columns of ``docs``. Rows that a stage rejects are gone for the next:

1. quality_rules keeps the documents that pass the rule cascade;
2. simhash_near_dedup keeps one document of each class (3-word shingles, at most 3 bits);
3. decontaminate drops documents that hold a 10-word window of a benchmark item;
4. mix emits each document as often as its source's target asks;
5. token_shards writes the token ids and returns what it reads back, one row per document.

Nulls, empty and repeated rows, ties and empty tables: as each operator's docstring says.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sensorgrid.llm import decontaminate, mixing, quality, simhash, tokens  # noqa: E402
from sensorgrid.llm.common import read_table, stash  # noqa: E402
from sensorgrid.llm.queries import vocabulary  # noqa: E402


NEEDED = ["doc_id", "text", "source"]


def apart(docs: DataFrame) -> DataFrame:
    """The columns that operators read, and the others as one, safe from an operator's outputs."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in NEEDED]
    return docs.select(*NEEDED, F.struct(*others or [F.lit(0)]).alias("other_columns"))


def together(out: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again."""
    return out.select(*[F.col(c) if c in NEEDED else F.col(f"other_columns.`{c}`").alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return together(quality.judge(apart(docs)).filter("kept"), docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs, n=3, bits=3)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = decontaminate.decontaminate(apart(docs), read_table(spark, sf_dir, "benchmark"), width=10)
    return together(out.filter("not contaminated"), docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return together(mixing.emit(mixing.mix(apart(docs))), docs)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return tokens.token_table(docs, vocabulary("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("decontaminate", decontaminated),
    ("mix", mixed),
    ("token_shards", token_shards),
]

#: Fingerprints need XXH64 and token ids a tokenizer, which DuckDB lacks; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stage's rows written and reread before the next."""
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stash(docs, f"stage-{name}")
    return docs
