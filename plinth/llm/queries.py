"""Registered queries of the training-data operators, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plinth.llm import centroids, decontaminate, htmltext, imatch, langid, mixing, quality, sharding, substrings, tokenfiles, trie, warc
from plinth.llm.common import read
from plinth.llm.simhash import near_duplicates


def op1_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op2_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.digest(read(spark, sf_dir, "pages"))


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.matches(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return langid.identify(docs, langid.fit(docs))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.extract(read(spark, sf_dir, "pages"), htmltext.train())


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return imatch.fingerprints(docs, imatch.fit(docs))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(read(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.digest(read(spark, sf_dir, "documents"))


def op10_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(read(spark, sf_dir, "documents"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.digest(read(spark, sf_dir, "embeddings"))


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokenfiles.digest(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.digest(read(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_quality_classifier": op1_quality_classifier,
    "op2_warc_capture_index": op2_warc_capture_index,
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_language_id": op4_language_id,
    "op5_html_extraction": op5_html_extraction,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_document_fingerprints": op7_document_fingerprints,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_sharding": op9_sharding,
    "op10_source_mixing": op10_source_mixing,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_token_files": op12_token_files,
    "op13_conversation_trie": op13_conversation_trie,
}
ORACLES: dict[str, str] = {
    "op3_benchmark_decontamination": decontaminate.ORACLE,
    "op9_sharding": sharding.ORACLE,
    "op10_source_mixing": mixing.ORACLE,
    "op11_centroid_clustering": centroids.oracle(),
    "op13_conversation_trie": trie.ORACLE,
}
