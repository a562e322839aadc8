"""Sharding by proportional stratified interleaving.

Rows are shuffled by a seeded key within each source and get the fractional rank (rank - 1/2) / size. Sorted by
fractional rank, any contiguous cut holds every source in proportion; cutting at multiples of total / shards makes
shard sizes differ by one row at most.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.llm.common import packed
from plinth.llm.prefix import bucket_of, running, seeded_key


def utf8_size(text: Column) -> Column:
    """UTF-8 bytes plus one; null has no bytes."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("bigint")


def interleave(docs: DataFrame, shards: int = 8, seed: int = 42, id_col: str = "doc_id", stratum_col: str = "source", tie_cols: tuple[str, ...] = (), bucket_rows: int = 20_000) -> DataFrame:
    """``docs`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    Every row is placed, repeated ones too; a null source is a source of its own and a null id sorts like an empty
    one. Columns that are already called ``shard`` or ``slot`` are replaced; all others come back as they were,
    whatever their names. Rows equal in id and ``tie_cols`` take neighbouring places in any order. An empty table stays
    empty. ``bucket_rows`` bounds the rows that one task sorts, also for a source with most of the rows.
    """
    docs = docs.drop("shard", "slot")
    total = docs.count()
    buckets = max(1, -(-total // bucket_rows))
    # the caller's columns travel inside one column, so that none can clash with a working one
    key, stratum = seeded_key(F.col(id_col), seed=seed), F.coalesce(F.concat(F.lit("s"), F.col(stratum_col).cast("string")), F.lit("n"))
    rows = docs.select(packed(docs).alias("row"), F.struct(*[F.col(c) for c in (id_col, *tie_cols)]).alias("tie"), key.alias("key"), stratum.alias("stratum"))
    rows = rows.withColumn("bucket", bucket_of(F.col("key"), buckets))
    rows = running(rows, ["stratum"], "bucket", ["key", "tie"], F.lit(1), "rank", "size")
    rows = rows.withColumn("share", (F.col("rank") + 0.5) / F.col("size"))
    rows = rows.withColumn("bucket", F.floor(F.col("share") * buckets)).withColumn("all", F.lit(0))
    rows = running(rows, ["all"], "bucket", ["share", "stratum"], F.lit(1), "place", "total")
    rows = rows.withColumn("shard", F.expr(f"cast(place * {shards} div total as int)"))
    rows = rows.withColumn("slot", F.expr(f"place - (shard * total + {shards - 1}) div {shards}"))
    return rows.select("row.*", "shard", "slot")


def digest(docs: DataFrame, shards: int = 8, seed: int = 42) -> DataFrame:
    """The contract's columns; texts are read for their size and CRC only and not shuffled."""
    crc = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32")
    light = docs.select("doc_id", "source", utf8_size(F.col("text")).alias("size"), crc)
    placed = interleave(light, shards, seed, tie_cols=("size", "text_crc32"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The same in SQL: rank by seeded md5 within a source, order by fractional rank, cut into equal parts; CRC bit by bit.
ORACLE = r"""
WITH d AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size, coalesce('s' || source, 'n') AS stratum, md5('42|' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k,
         xor(list_reduce(list_concat([4294967295], flatten(list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
           lambda h : [CAST((instr('0123456789ABCDEF', h[1]) - 1) * 16 + instr('0123456789ABCDEF', h[2]) - 1 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
           lambda c, b : xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) AS crc
  FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY k, doc_id) - 1 AS rank, count(*) OVER (PARTITION BY stratum) AS n FROM d),
p AS (SELECT *, row_number() OVER (ORDER BY (rank + 0.5::DOUBLE) / n, stratum) - 1 AS place, count(*) OVER () AS total FROM r),
s AS (SELECT *, CAST(place * 8 // total AS INTEGER) AS shard FROM p)
SELECT doc_id, CAST(size AS BIGINT) AS size, CAST(crc AS BIGINT) AS text_crc32, 'rows' AS law, shard, CAST(place - (shard * total + 7) // 8 AS BIGINT) AS slot, CAST(NULL AS INTEGER) AS grown_shard
FROM s
"""
