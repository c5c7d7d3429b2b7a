"""Corpus pipeline: language ID, SimHash near-dedup, suffix-array dedup, best-fit packing.

Each stage takes the documents that its predecessor kept. The first three return the columns of the documents; the last returns where each
piece of each document is packed.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroledger.llm import best_fit, language_id, simhash_trie, suffix_dedup, token_counts

#: Least share of a document's n-grams that its language has to contain; texts of a known language have more than half.
MIN_LANGUAGE_SHARE = 0.3


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no known language, go."""
    model = language_id.learn(docs)
    accepted = language_id.accepts(spark, model, MIN_LANGUAGE_SHARE)
    return docs.where(accepted(F.col("text")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id: three-word shingles, fingerprints within two bits."""
    return simhash_trie.keep_one(docs, simhash_trie.WITHIN_TWO_BITS)


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose passages that occur elsewhere; a character that is cut in the middle goes as well."""
    names = docs.columns
    numbered = {c: c if c in ("doc_id", "text") else f"column_{i}" for i, c in enumerate(names)}
    cut = suffix_dedup.remove_repeats(docs.withColumnsRenamed(numbered), as_text=True)
    some, text = F.col("kept").isNotNull(), F.coalesce("kept", "text")
    if "n_chars" in names:
        count = F.col(numbered["n_chars"])
        cut = cut.withColumn(numbered["n_chars"], F.when(some, F.length(text).cast(docs.schema["n_chars"].dataType)).otherwise(count))
    return cut.withColumn("text", text).select(*[F.col(numbered[c]).alias(c) for c in names])


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of the permitted lengths."""
    counted = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return best_fit.pack(counted.select("doc_id", "n_tokens"))


STAGES = [
    ("language ID", identify_languages),
    ("SimHash near-dedup", drop_near_duplicates),
    ("suffix-array dedup", remove_repeats),
    ("best-fit packing", pack),
]

#: SQL cannot express the stages.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
    return docs
