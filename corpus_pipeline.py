"""A training corpus from documents: clean, near-duplicates out, benchmarks out, mixed, and written as token ids.

Every stage takes the documents that the one before kept and is written before the next one reads it.
"""
from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formsieve.llm import contamination, mixing, shingles, tokens, toxicity
from formsieve.llm.common import crc_remainder, materialize, prepare, table

REJECTED_FROM = 0.3


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold. The machine learns from the labelled ones that are not held out."""
    labels = table(spark, sf_dir, "labels").where(crc_remainder(F.col("doc_id")) != 2)
    return toxicity.reject(docs, toxicity.learn(docs, labels), REJECTED_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts tied by links of at least 0.8 Jaccard similarity of their five-word shingles.

    SimHash fingerprints of the shingles make the first candidates, min-wise keys those that differ in more bits; the sets decide."""
    prepare(spark)
    return shingles.keep_one(docs, width=5, threshold=0.8)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return contamination.remove(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a document taken twice stands there twice."""
    prepare(spark)
    return mixing.repeat(docs, weights=(3, 1, 2), share=1.5, most=2)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in ascending doc_id order, and of each document what they say."""
    prepare(spark)
    manifest = tokens.encode(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2, vocabulary=49_408)
    return tokens.read_back(manifest).select(F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc32").alias("ids_crc32"))


STAGES = [
    ("toxicity", reject_toxic),
    ("simhash", drop_near_duplicates),
    ("contamination", drop_contaminated),
    ("mixing", mix_sources),
    ("tokens", write_tokens),
]

#: Learnt weights, fingerprints and token ids are beyond SQL; tests/llm/test_pipeline.py has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
