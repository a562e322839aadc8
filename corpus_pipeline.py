"""The training-corpus pipeline: recognise, deduplicate, decontaminate, mix, shard.

Every stage is a function of (spark, docs, sf_dir); its result is written as Parquet and read back as the next stage's
documents, so each stage works on all that its predecessor kept and can be run again on its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from plinth.llm import decontaminate, langid, mixing, sharding, simhash
from plinth.llm.common import read, saved
from plinth.session import ship

#: Mixing: share of the tokens that reach the stage, and how often a document may be taken.
BUDGET_SHARE, EPOCHS = 0.75, 1
#: Languages the corpus is for, and the score below which a text's language is not told: at 0.5 two are equally near.
TARGET_LANGS, LEAST_SCORE = frozenset({"en", "de", "fr", "es"}), 0.51


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the target languages; those without a letter, in another language, or too near to two go.

    ``lang`` is the prediction from here on, so that mixing budgets by what a text is written in.
    """
    ship(spark)
    return langid.recognised(docs, langid.fit(docs), TARGET_LANGS, LEAST_SCORE, lang_col="lang")


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near copies."""
    ship(spark)
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not contain a benchmark item."""
    return decontaminate.clean(docs, read(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each leaf's token prefix under the hierarchical budget."""
    return mixing.mix(docs, budget_share=BUDGET_SHARE, max_epochs=EPOCHS, tie_cols=("n_chars",)).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and place in it."""
    return sharding.interleave(docs, shards=8, tie_cols=("n_chars",))


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("sharding", shard),
]

#: Language profiles and SimHash cannot be stated in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = saved(docs, name)
    return docs
