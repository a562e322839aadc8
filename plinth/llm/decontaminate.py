"""Benchmark decontamination by size-partitioned MinHash containment search, in DataFrame functions only.

A document is contaminated by a test item if it contains at least ``threshold`` of the item's distinct word shingles.
Items are partitioned by size (powers of two of their shingle count). An item's signature is its bottom-m MinHash: the
m smallest of its shingle hashes, with m set per partition to the most shingles that a match may miss, plus one. So
every document that reaches the threshold holds at least one hash of the signature, however long it is, and no match
is missed. Documents' shingle hashes are looked up in the signatures of one block of items at a time; candidates are
verified by exact containment of shingle strings.

Size: nothing but signatures of a block (``block_hashes`` rows at most, or one item's) is broadcast; a benchmark of any
size goes through block by block. Documents are scanned once per block and their shingles are never shuffled.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.llm.common import among, packed, row_key, saved

SHINGLE = 5


def words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null has none."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def _hashes(column: str) -> Column:
    """Hashes of all shingles of an array of words, in order; fewer words than a shingle make one of their own."""
    at = ", ".join(f"get({column}, i + {j})" for j in range(SHINGLE))
    return F.expr(f"if(size({column}) = 0, cast(array() as array<bigint>), transform(sequence(0, greatest(size({column}) - {SHINGLE}, 0)), i -> xxhash64({at})))")


def _strings(column: str) -> Column:
    """The distinct shingles themselves."""
    return F.expr(f"if(size({column}) = 0, cast(array() as array<string>), array_distinct(transform(sequence(0, greatest(size({column}) - {SHINGLE}, 0)), i -> array_join(slice({column}, i + 1, {SHINGLE}), ' '))))")


def signatures(items: DataFrame, threshold: float) -> DataFrame:
    """``(item_id, partition, h)`` from ``items(item_id, w)``: the bottom-m MinHash of each item."""
    own = items.select("item_id", F.array_distinct(_hashes("w")).alias("hs")).filter("size(hs) > 0")
    own = own.withColumn("partition", F.floor(F.log2(F.size("hs"))).cast("int"))
    largest = F.expr("shiftleft(2, partition) - 1")  # shingles of the largest item of the partition
    most_missed = F.floor((1 - threshold) * largest + 1e-9).cast("int")
    return own.select("item_id", "partition", F.explode(F.slice(F.array_sort("hs"), F.lit(1), most_missed + 1)).alias("h"))


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text", block_hashes: int = 1_000_000, most_broadcast: int = 2_000_000) -> DataFrame:
    """``(id, item_id, n_shingles, n_shared, containment)`` for every pair at or above ``threshold``.

    Items without words match nothing; an item of fewer words than a shingle matches only a document that consists of
    just these words. Rows that share a document id or an item id count as one, by their best pair. Null ids are an id
    like any other. Empty tables give no rows.
    """
    items = saved(benchmark.select("item_id", words(F.col("text")).alias("w")), "items")
    signed = saved(signatures(items, threshold), "signatures")
    blocks = max(1, -(-signed.count() // block_hashes))
    texts = docs.select(F.col(id_col).alias("id"), words(F.col(text_col)).alias("w"))
    shingles = texts.select("id", F.explode(_hashes("w")).alias("h"))
    found = []
    for b in range(blocks):
        block = signed if blocks == 1 else signed.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        found.append(shingles.join(F.broadcast(block.select("item_id", "h")), "h").select("id", "item_id").distinct())
    candidates = saved(reduce(DataFrame.unionByName, found), "candidates")
    names = saved(candidates.select(F.col("id").alias("_id")).distinct(), "candidate-ids")
    if names.count() <= most_broadcast:
        names = F.broadcast(names)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(names, F.col("id").eqNullSafe(F.col("_id")), "left_semi")
    texts = texts.select("id", words(F.col("text")).alias("w")).select(F.col("id").alias("_id"), _strings("w").alias("have"))
    wanted = items.select(F.col("item_id").alias("_item"), _strings("w").alias("want")).filter("size(want) > 0")
    pairs = candidates.join(wanted, F.col("item_id").eqNullSafe(F.col("_item"))).select("id", "item_id", "want")
    pairs = pairs.join(texts, F.col("id").eqNullSafe(F.col("_id"))).select("id", "item_id", F.size("want").alias("n_shingles"), F.size(F.array_intersect("want", "have")).alias("n_shared"))
    held = pairs.filter(F.col("n_shared") >= F.ceil(F.col("n_shingles") * threshold - 1e-9))
    best = held.groupBy("id", "item_id").agg(F.max(F.struct((F.col("n_shared") / F.col("n_shingles")).alias("containment"), "n_shingles", "n_shared")).alias("best"))
    return best.select(F.col("id").alias(id_col), "item_id", "best.n_shingles", "best.n_shared", F.round("best.containment", 6).alias("containment"))


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the rows that have a match; all columns stay, whatever their names. Rows are told apart by id
    and text, so that a row without an id or with another's id goes only for its own text."""
    key = row_key(id_col, text_col).alias("key")
    hit = matches(docs.select(key, F.col(text_col).alias("text")), benchmark, threshold, "key", "text")
    return among(docs.select(key, packed(docs).alias("row")), saved(hit.select("key").distinct(), "contaminated"), "left_anti").select("row.*")


ORACLE = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS w FROM benchmark),
ds AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + 5], ' ') AS s
       FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
bs AS (SELECT DISTINCT item_id, array_to_string(w[i + 1:i + 5], ' ') AS s
       FROM (SELECT item_id, w, unnest(range(greatest(len(w) - 4, 1))) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
j AS (SELECT ds.doc_id, bs.item_id, count(*) AS n_shared FROM ds JOIN bs ON ds.s = bs.s GROUP BY ds.doc_id, bs.item_id)
SELECT j.doc_id, j.item_id, CAST(n.n_shingles AS INTEGER) AS n_shingles, CAST(j.n_shared AS INTEGER) AS n_shared,
       round(j.n_shared / n.n_shingles, 6) AS containment
FROM j JOIN n ON j.item_id = n.item_id WHERE j.n_shared >= ceil(n.n_shingles * 0.8 - 1e-9)
"""
