"""The corpus pipeline: documents through five of the training-data operators, each stage on all that its predecessor kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame, which run() writes as
Parquet into the shared folder and reads again as the next one's docs. All stages but the last keep documents' columns.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm import common, jaccard, langid, packing, secrets, suffixes

WORDS, SIMILAR_PCT = 5, 80


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no letters, or mostly words of uncertain language."""
    return langid.recognised(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the row of the smallest id of each group of near copies, null ids last (five-word shingles, similarity of 0.8 or more)."""
    return jaccard.keep_one(docs, WORDS, SIMILAR_PCT)


def unrepeated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts every 200-byte string that also stands elsewhere; texts of nothing else go."""
    return suffixes.cut(docs)


def redacted(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets by a mark."""
    return secrets.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs what is left into sequences of 4096 tokens."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", identified), ("near_duplicates", deduplicated), ("repeats", unrepeated), ("secrets", redacted), ("packing", packed)]
#: The tokenizer, the trained model and the set joins are beyond SQL; tests/llm/test_pipeline.py holds run() against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch, docs = common.Scratch(spark, "pipeline"), common.read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.save(name, stage(spark, docs, sf_dir))
        if k:
            scratch.drop(STAGES[k - 1][0])
    return docs
