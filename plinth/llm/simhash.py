"""SimHash near-duplicates through a byte-position inverted index with count filtering.

A 64-bit fingerprint is eight positional bytes. Fingerprints that differ in at most three bits differ in at most three
bytes, so they share at least five positional bytes. The index posts each distinct fingerprint under fourteen sets of
four byte positions (the blocks of a quadruple system on eight points: every five positions contain one of them), so
any pair that shares five bytes meets under at least one key, and keys are 32 bits wide, which keeps lists short where
single bytes would give lists of a 256th of all fingerprints. Within a list the shared positional bytes of pairs are
tallied, pairs with the guaranteed five are kept, and the bit distance of those is verified.

Size: copies collapse to one row per fingerprint before anything is posted. Lists are read as a sorted stream; only a
spanning forest of a list's links leaves it, never its pairs. A list longer than ``list_cap`` distinct fingerprints is
not held in memory: its members go to an exact second index by flipped bits (``_by_flips``), whose groups are bounded
by geometry (2,081 fingerprints) whatever the size of the input. No link is dropped at either place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.llm.common import among, packed, row_key, saved
from plinth.llm.graph import components

BYTES, SHARED, MOST_BITS = 8, 5, 3


def _blocks() -> list[tuple[int, ...]]:
    """Fourteen sets of four of eight positions such that any five positions contain one.

    Both halves, and for each of the three ways to split a half into two pairs, every pair of the left split with every
    pair of the right one.
    """
    splits = [((0, 1), (2, 3)), ((0, 2), (1, 3)), ((0, 3), (1, 2))]
    crossed = [left + tuple(x + 4 for x in right) for split in splits for left in split for right in split]
    return [(0, 1, 2, 3), (4, 5, 6, 7), *crossed]


def fingerprint(text: str | None, width: int = 3) -> int:
    """The SimHash of one text as an unsigned number; see :func:`fingerprints`."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + width]) for i in range(max(1, len(words) - width + 1))]
    hashes = np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in runs), dtype=">u8", count=len(runs))
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 8192):  # bounded memory for very long texts
        bits = np.unpackbits(hashes[at : at + 8192].view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(">u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``(id, fp)``: words are lower-cased in A-Z only, split at ASCII white space, and taken ``width`` at a time.

    Repeats count. Fewer words than ``width`` make one shingle; no words (or null) give zero. Works on whole texts in
    Arrow batches; needs memory for one text at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x.as_py(), width) for x in batch.column(1)]
            signed = np.array(found, dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(signed)], names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, f"id {kind}, fp bigint")


def _key(block: int, positions: tuple[int, ...]) -> Column:
    parts = [F.shiftleft(F.shiftrightunsigned("fp", 8 * p).bitwiseAND(F.lit(255).cast("bigint")), 8 * i) for i, p in enumerate(positions)]
    key = F.lit(block << 32).cast("bigint")
    for x in parts:
        key = key.bitwiseOR(x)
    return key


def _forest(members: np.ndarray) -> list[tuple[int, int]]:
    """A spanning forest of the links among distinct fingerprints (uint64), by breadth-first search."""
    edges, rest = [], members
    while len(rest) > 1:
        queue, rest = [rest[0]], rest[1:]
        while queue and len(rest):
            at = queue.pop()
            apart = rest ^ at
            tally = (apart.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1)
            near = (tally >= SHARED) & (np.bitwise_count(apart) <= MOST_BITS)
            if near.any():
                edges += [(int(at), int(x)) for x in rest[near]]
                queue += list(rest[near])
                rest = rest[~near]
    return edges


def _lists(list_cap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(edges: list[tuple[int, int]], hot: list[np.ndarray]) -> pa.RecordBatch:
            pairs = np.array(edges, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            more = np.concatenate(hot).view(np.int64) if hot else np.zeros(0, np.int64)
            u, v = np.concatenate([pairs[:, 0], more]), np.concatenate([pairs[:, 1], more])
            flags = pa.array(np.arange(len(u)) >= len(pairs))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), flags], names=["u", "v", "hot"])

        held_key, held, overflown = None, [], False

        def close() -> list[tuple[int, int]]:
            group = np.concatenate(held) if held else np.zeros(0, np.uint64)
            return [] if overflown or len(group) < 2 else _forest(group)

        for batch in batches:
            if not batch.num_rows:
                continue
            edges, hot = [], []
            keys = batch.column(0).to_numpy()
            fps = batch.column(1).to_numpy().view(np.uint64)
            cuts = np.flatnonzero(np.diff(keys)) + 1
            starts, ends = np.concatenate([[0], cuts]), np.concatenate([cuts, [len(keys)]])
            # lists that lie wholly inside the batch and have one member need no look
            keep = (ends - starts > 1) | (starts == 0) | (ends == len(keys))
            for s, e in zip(starts[keep], ends[keep], strict=True):
                if keys[s] != held_key:
                    edges += close()
                    held_key, held, overflown = keys[s], [], False
                held.append(fps[s:e])
                if overflown:
                    hot.append(held.pop())
                elif sum(map(len, held)) > list_cap:
                    hot += held
                    held, overflown = [], True
            if edges or hot:
                yield out(edges, hot)
        if edges := close():
            yield out(edges, [])

    return run


def _by_flips(hot: DataFrame) -> DataFrame:
    """Edges that connect exactly the fingerprints of ``hot(fp)`` that are within three bits, without their pairs.

    Two such fingerprints have a word in common that is at most one flip from one and two from the other. All that
    reach a word are linked to any that reaches it in one flip, so that one is the centre of a star; words that none
    reaches in one flip prove nothing and are skipped. A word is reached by at most 1 + 64 + 2016 fingerprints.
    """
    ones = [1 << i for i in range(64)]
    near, far = [0, *ones], [a ^ b for i, a in enumerate(ones) for b in ones[:i]]
    signed = lambda xs: F.array(*[F.lit(x - (1 << 64) if x >> 63 else x) for x in xs])
    one = hot.select("fp", F.explode(signed(near)).alias("flip"), F.lit(True).alias("one"))
    two = hot.select("fp", F.explode(signed(far)).alias("flip"), F.lit(False).alias("one"))
    reach = one.unionByName(two).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word"), "one")
    stars = reach.groupBy("word").agg(F.min(F.when(F.col("one"), F.col("fp"))).alias("u"), F.collect_set("fp").alias("vs"))
    stars = stars.filter(F.col("u").isNotNull() & (F.size("vs") > 1))
    return stars.select("u", F.explode("vs").alias("v")).filter("u <> v").distinct()


def links(fps: DataFrame, list_cap: int = 4096) -> DataFrame:
    """Edges ``(u, v)`` among distinct ``fps(fp)`` whose components are those of the relation "at most three bits"."""
    posts = F.array(*[F.struct(_key(i, block).alias("key"), F.col("fp").alias("fp")) for i, block in enumerate(_blocks())])
    posted = fps.select(F.explode(posts).alias("post")).select("post.key", "post.fp")
    n = max(int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    lists = posted.repartition(n, "key").sortWithinPartitions("key", "fp")
    found = saved(lists.mapInArrow(_lists(list_cap), "u bigint, v bigint, hot boolean"), "lists")
    edges = found.filter("not hot").select("u", "v")
    hot = found.filter("hot").select(F.col("u").alias("fp")).distinct()
    if not hot.isEmpty():
        edges = edges.unionByName(_by_flips(saved(hot, "hot")))
    return edges


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, list_cap: int = 4096) -> DataFrame:
    """``(id, fingerprint, component_id)``, one row per row of ``docs``.

    ``fingerprint`` has 16 lower-case hex digits; ``component_id`` is the smallest id that can be reached over
    fingerprints with at most three differing bits, itself included. Null and empty texts have fingerprint zero, which
    links like any other. Rows that share an id are fingerprinted each for itself. A null id takes no part in the
    minimum (null if a component has no other). An empty table gives an empty result; other columns are ignored.
    """
    prints = saved(fingerprints(docs, id_col, text_col, width), "fingerprints")
    distinct = saved(prints.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    roots = components(links(distinct.select("fp"), list_cap))
    placed = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    named = placed.join(least, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(named, "fp").select(F.col("id").alias(id_col), hexed, "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """``docs`` with one row of each component, that of the smallest id; all columns stay, whatever their names.

    Rows are told apart by id and text: of rows that share an id the one with the smallest hash of the text counts as
    smaller, null ids are smallest of all, and of rows equal in both one stays.
    """
    rows = docs.select(row_key(id_col, text_col).alias("key"), packed(docs).alias("row"))
    named = near_duplicates(docs.select(row_key(id_col, text_col).alias("key"), F.col(text_col).alias("text")), "key", "text", width)
    named = saved(named, "components")
    kept = among(rows, saved(named.filter("key <> component_id").select("key").distinct(), "near-copies"), "left_anti")
    twice = saved(named.filter("key = component_id").groupBy("key").count().filter("count > 1").select("key"), "repeated")
    if not twice.isEmpty():
        first = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("row")))
        again = among(kept, twice, "left_semi").withColumn("n", first).filter("n = 1").drop("n")
        kept = among(kept, twice, "left_anti").unionByName(again)
    return kept.select("row.*")
