"""The registered queries of the operators, with production parameters, and their DuckDB check SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroledger.llm import (
    best_fit,
    byte_bpe,
    graph_ann,
    language_id,
    lattice_dedup,
    license_scan,
    line_dedup,
    oracle,
    simhash_trie,
    suffix_dedup,
    token_alignment,
    token_counts,
    url_reputation,
    va_clusters,
)
from aeroledger.llm.url_reputation import Rule

URL_RULES = (
    Rule("block", "net/"),
    Rule("allow", "example.net/en/"),
    Rule("block", "example.com/de/"),
    Rule("allow", "org/fr/"),
)
MAX_TOKENS = 4096


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """page_id and good of the labelled pages: a url's path ends with the number of the document that the page shows."""
    shown = pages.select(
        "page_id", F.regexp_extract(url_reputation.path_of(F.col("url")), r"/(\d{1,18})(?:\.html|/)?$", 1).alias("number")
    )
    shown = shown.where(F.col("number") != "").select("page_id", F.col("number").cast("long").alias("doc_id"))
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return shown.join(labels.select("doc_id", good.alias("good")), "doc_id").select("page_id", "good")


def op1_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_reputation.judge_urls(pages, page_outcomes(pages, _table(spark, sf_dir, "labels")), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op2_language_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").withColumn("held_out", language_id.held_out(F.col("doc_id")))
    training = docs.where(F.col("doc_id").isNotNull() & ~F.col("held_out"))
    return language_id.predict(docs, language_id.learn(training), "doc_id", "held_out")


def op3_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    how = (public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
    encoded = byte_bpe.encode(_table(spark, sf_dir, "documents"), *how)
    return byte_bpe.decode(encoded, *how).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counted.withColumn("over_limit", F.col("n_tokens") > MAX_TOKENS)


def op5_graph_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph_ann.search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op6_simhash_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_trie.components(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash_trie.as_hex("fingerprint").alias("fingerprint"), "component_id")


def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(op4_token_counts(spark, sf_dir).select("doc_id", "n_tokens"))


def op8_lattice_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return license_scan.scan(docs, license_scan.learn(docs))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    how = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return token_alignment.score_links(token_alignment.align(_table(spark, sf_dir, "documents"), *how), *how)


def op12_va_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return va_clusters.cluster(_table(spark, sf_dir, "embeddings"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_dedup.drop_frequent_lines(_table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return cleaned.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_reputation": op1_url_reputation,
    "op2_language_bloom": op2_language_bloom,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_token_counts": op4_token_counts,
    "op5_graph_ann": op5_graph_ann,
    "op6_simhash_trie": op6_simhash_trie,
    "op7_best_fit": op7_best_fit,
    "op8_lattice_dedup": op8_lattice_dedup,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_token_alignment": op11_token_alignment,
    "op12_va_clusters": op12_va_clusters,
    "op13_line_dedup": op13_line_dedup,
}

ORACLE_SQL: dict[str, str] = {
    "op1_url_reputation": oracle.URL_REPUTATION,
    "op8_lattice_dedup": oracle.LATTICE_DEDUP,
    "op9_suffix_dedup": oracle.SUFFIX_DEDUP,
    "op12_va_clusters": oracle.centroid_clusters(),
    "op13_line_dedup": oracle.LINE_DEDUP,
}
