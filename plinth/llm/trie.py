"""Conversation prefix trie by prefix-doubling naming.

Every distinct turn gets a dense number as its name. Blocks of 2, 4, 8 ... turns that start at multiples of their
length are named from the names of their halves, in as many rounds as the longest conversation has bits; each round
halves the rows, so that all rounds together name twice as many blocks as there are turns. A prefix of d turns is the
prefix without the last 2^j turns (2^j: the lowest bit of d) and one such block: going from the highest bit to the lowest,
each prefix is composed once, and equal prefixes of one depth are grouped. The smallest conversation that
begins with a prefix stands for it from then on.

Depth costs rounds by its logarithm only, also in what is summed over subtrees: a node's value is put on the smallest of its
members, summed from the end of each conversation (in stretches of bounded length) and added up by node. No group is gathered: groups are
combined before they are shuffled, hot keys occur on one side of joins with a unique other side, where adaptive execution splits them, and
ids that end at a node are hashed as a stream of sorted pieces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.llm.common import saved
from plinth.llm.prefix import running

_PIECE = 4096  # bytes of ids that travel as one row


def turn_key(role: Column, text: Column) -> Column:
    """SHA-256 of role and text; null is empty. Roles that run into the text are told apart by the role's length."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    return F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256))


def named(keys: DataFrame) -> DataFrame:
    """Distinct ``keys``, written down with the dense numbers ``name`` from 0.

    A row's number is its place in its file and the rows of the files before; only the files' row counts reach the driver.
    """
    spark = keys.sparkSession
    rows = saved(keys.withColumn("_at", F.monotonically_increasing_id()), "names")
    file, place = F.shiftright("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    starts, total = [], 0
    for r in sorted(rows.groupBy(file.alias("f")).agg((F.max(place) + 1).alias("n")).collect()):
        starts.append((r["f"], total))
        total += r["n"]
    offsets = spark.createDataFrame(starts, "_file bigint, _before bigint")
    return rows.withColumn("_file", file).join(F.broadcast(offsets), "_file").select(*keys.columns, (F.col("_before") + place).alias("name"))


def ordered(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Turns in order, and the names of their contents.

    ``(conv, pos, own, turn, chars)``: place from 0 and number of the conversation's turns, name of role and text, code points of
    the text. Null turns come first; rows of one turn follow each other by :func:`turn_key`, repeated rows are turns each. Null role
    and text are empty. Rows without a conversation id belong to none and are left out. A conversation with most of the
    rows is spread over range partitions. The second table is ``(key, name)``.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).alias("at"), turn_key(F.col(role_col), F.col(text_col)).alias("key"), F.char_length(text).cast("bigint").alias("chars"))
    # equal rows can be dealt to different partitions: which of them comes first makes no difference
    dealt = rows.withColumn("salt", F.rand(42)).repartitionByRange("conv", F.col("at").asc_nulls_first(), "key", "salt")
    dealt = saved(dealt.withColumn("part", F.spark_partition_id()), "turns")
    names = named(dealt.select("key").distinct())
    placed = running(dealt, ["conv"], "part", ["at", "key", "salt"], F.lit(1), "pos", "own")
    return saved(placed.join(names, "key").select("conv", "pos", "own", F.col("name").alias("turn"), "chars"), "turns-ordered"), names


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(conv, pos, turn, chars, length)`` of every turn and ``(conv, length)`` of every conversation."""
    return turns.select("conv", "pos", "turn", "chars", F.col("own").alias("length")), turns.filter("pos = 0").select("conv", F.col("own").alias("length"))


def rebuilt(turns: DataFrame, family: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """As :func:`as_they_are`, of conversations whose beginning is that of their family's first.

    Conversation c takes the first h turns of c - c % ``family`` (all if it has fewer, none if it is absent), then its
    own turns after the first h, where h = crc32(c) % ``most``.
    """
    h = (F.crc32(F.col("conv").cast("string").cast("binary")) % most).alias("h")
    convs = turns.filter("pos = 0").select("conv", "own", h, (F.col("conv") - F.col("conv") % family).alias("head"))
    heads = convs.filter("conv = head").select("head", F.col("own").alias("given"))
    taken = F.least("h", F.coalesce("given", F.lit(0)))
    convs = convs.join(heads, "head", "left").select("conv", "head", "h", taken.alias("taken"), (taken + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"))
    convs = saved(convs, "conversations")
    own = turns.join(convs, "conv").filter("pos >= h").select("conv", (F.col("taken") + F.col("pos") - F.col("h")).alias("pos"), "turn", "chars", "length")
    # at most `most` turns of each head, met by at most `family` conversations
    first = turns.filter((F.col("conv") % family == 0) & (F.col("pos") < most)).select(F.col("conv").alias("head"), "pos", "turn", "chars")
    begun = first.join(convs, "head").filter("pos < h").select("conv", "pos", "turn", "chars", "length")
    return own.unionByName(begun), convs.select("conv", "length")


def members(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``(conv, depth, node, n, longest, turn, chars, length)``: a row for every prefix of every conversation, the empty one too.

    ``node`` is the smallest conversation of those (``n``) that begin with the prefix, so that (depth, node) names a node of the
    trie; ``longest`` is the length of their longest, ``turn`` and ``chars`` are the prefix's last turn and its code points.
    """
    first, total, deepest = convs.agg(F.min("conv"), F.count("*"), F.max("length")).first()
    big = lambda x: F.lit(x).cast("bigint")
    root = convs.select("conv", big(0).alias("depth"), big(first).alias("node"), big(total).alias("n"), big(deepest).alias("longest"), big(None).alias("turn"), big(0).alias("chars"), "length")
    levels = [saved(turns.select("conv", F.col("pos").alias("i"), F.col("turn").alias("block"), "turn", "chars", "length"), "blocks")]
    while (deepest or 0) >> len(levels):
        odd = F.col("i") % 2 == 1
        halves = levels[-1].groupBy("conv", F.shiftright("i", 1).alias("i")).agg(
            F.max(F.when(~odd, F.col("block"))).alias("a"), F.max(F.when(odd, F.col("block"))).alias("b"), F.max(F.when(odd, F.col("turn"))).alias("turn"), F.max(F.when(odd, F.col("chars"))).alias("chars"), F.max("length").alias("length")
        )
        halves = halves.filter("b is not null")
        names = named(halves.select("a", "b").distinct())
        levels.append(saved(halves.join(names, ["a", "b"]).select("conv", "i", F.col("name").alias("block"), "turn", "chars", "length"), "blocks"))
    done: list[DataFrame] = []
    for j in range(len(levels) - 1, -1, -1):
        # prefixes whose lowest bit is 2^j end with a block of an even place
        rows = levels[j].filter("i % 2 = 0").withColumn("start", F.shiftleft("i", j)).withColumn("depth", F.col("start") + (1 << j))
        fresh = rows.filter("start = 0").withColumn("before", F.lit(0).cast("bigint"))
        if done:
            known = reduce(DataFrame.unionByName, done).select("conv", F.col("depth").alias("start"), F.col("node").alias("before"))
            fresh = fresh.unionByName(rows.filter("start > 0").join(known, ["conv", "start"]))
        key = ["depth", "before", "block"]
        groups = saved(fresh.groupBy(*key).agg(F.min("conv").alias("node"), F.count("*").alias("n"), F.max("length").alias("longest")), "nodes")
        done.append(saved(fresh.join(groups, key).select(*root.columns), "members"))
    return reduce(DataFrame.unionByName, [root, *done])


def endings(found: DataFrame) -> DataFrame:
    """``(depth, node, ends)``: SHA-256 of the ids, ascending and comma-joined, of the conversations that end at a node.

    Ids are sorted over range partitions and joined to pieces of a few kilobytes there; a node's pieces are then hashed in
    order as a stream, so that a node at which very many end needs no more memory than any other.
    """
    ends = found.filter("depth = length").select("depth", "node", "conv")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        out: list[tuple] = []
        key, size = None, 0

        def close() -> None:
            if held:
                out.append((*key, held[0], ",".join(map(str, held)).encode()))

        for batch in batches:
            for depth, node, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (depth, node) != key or size > _PIECE:
                    close()
                    key, held, size = (depth, node), [], 0
                held.append(conv)
                size += 20
            if out:
                yield _batch(out, ["depth", "node", "first", "ids"], [pa.int64(), pa.int64(), pa.int64(), pa.binary()])
                out = []
        close()
        if out:
            yield _batch(out, ["depth", "node", "first", "ids"], [pa.int64(), pa.int64(), pa.int64(), pa.binary()])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, sha, out = None, None, []
        for batch in batches:
            for depth, node, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), strict=True):
                if (depth, node) != key:
                    if key is not None:
                        out.append((*key, sha.hexdigest()))
                    key, sha = (depth, node), hashlib.sha256(ids)
                else:
                    sha.update(b"," + ids)
            if out:
                yield _batch(out, ["depth", "node", "ends"], [pa.int64(), pa.int64(), pa.string()])
                out = []
        if key is not None:
            yield _batch([(*key, sha.hexdigest())], ["depth", "node", "ends"], [pa.int64(), pa.int64(), pa.string()])

    pieces = ends.repartitionByRange("depth", "node", "conv").sortWithinPartitions("depth", "node", "conv").mapInArrow(join, "depth bigint, node bigint, first bigint, ids binary")
    return pieces.repartition("depth", "node").sortWithinPartitions("depth", "node", "first").mapInArrow(hashed, "depth bigint, node bigint, ends string")


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)


def nodes(found: DataFrame, stretch: int = 20_000) -> DataFrame:
    """One row per node of ``found``, a saved table of :func:`members`.

    ``(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256, turn, chars)``. ``stretch`` bounds the turns
    of one conversation that one task sorts.
    """
    lead = F.col("node") == F.col("conv")
    rows = found.select(
        "conv", "depth", "node", "n", "turn", "chars", "length", F.floor(F.col("depth") / stretch).alias("part"),
        F.when(lead, (F.col("n") - 1) * F.col("chars")).otherwise(0).alias("saves"),
        (lead & (F.col("longest") == F.col("depth"))).cast("bigint").alias("leaf"),
    )
    # what a stretch must know of the others; conversations of one stretch need nothing
    parts = rows.filter(F.col("length") >= stretch).groupBy("conv", "part").agg(F.sum("saves").alias("s"), F.sum("leaf").alias("l"), F.max_by("node", "depth").alias("top"))
    of = Window.partitionBy("conv").orderBy("part")
    after = of.rowsBetween(1, Window.unboundedFollowing)
    parts = parts.select("conv", "part", F.sum("s").over(after).alias("s"), F.sum("l").over(after).alias("l"), F.lag("top").over(of).alias("top"))
    inside = Window.partitionBy("conv", "part").orderBy("depth")
    below = inside.rowsBetween(0, Window.unboundedFollowing)
    rows = rows.join(parts, ["conv", "part"], "left").select(
        "depth", "node", "n", "turn", "chars", lead.alias("lead"),
        (F.sum("saves").over(below) + F.coalesce("s", F.lit(0))).alias("saves"), (F.sum("leaf").over(below) + F.coalesce("l", F.lit(0))).alias("leaf"),
        F.coalesce(F.lag("node").over(inside), "top").alias("parent"),
    )
    none = F.lit(None).cast("bigint")
    entry = lambda depth, node, n, parent, child, leaf, saves, turn, chars, ends: F.struct(depth.alias("depth"), node.alias("node"), n.alias("n"), parent.alias("parent"), child.alias("child"), leaf.alias("leaf"), saves.alias("saves"), turn.alias("turn"), chars.alias("chars"), ends.alias("ends"))
    text = F.lit(None).cast("string")
    own = entry(F.col("depth"), F.col("node"), F.col("n"), F.when(F.col("lead"), F.col("parent")), none, F.col("leaf"), F.col("saves"), F.col("turn"), F.col("chars"), text)
    up = entry(F.col("depth") - 1, F.col("parent"), none, none, F.lit(1).cast("bigint"), none, none, none, none, text)
    told = rows.select(F.inline(F.when(F.col("lead") & (F.col("depth") > 0), F.array(own, up)).otherwise(F.array(own))))
    ended = endings(found).select(entry(F.col("depth"), F.col("node"), none, none, none, none, none, none, none, F.col("ends")).alias("e")).select("e.*")
    by = told.unionByName(ended).groupBy("depth", "node")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return by.agg(
        F.max("parent").alias("parent_conv_id"), F.max("n").alias("n_convs"), F.coalesce(F.sum("child"), F.lit(0)).alias("n_children"), F.sum("leaf").alias("n_leaves"),
        F.sum("saves").alias("saved_tokens"), F.coalesce(F.max("ends"), nothing).alias("ends_sha256"), F.max("turn").alias("turn"), F.max("chars").alias("chars"),
    ).withColumnRenamed("node", "conv_id")


def contents(conversations: DataFrame, names: DataFrame, role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(turn, role, text)`` of every distinct turn, by its name."""
    rows = conversations.select(turn_key(F.col(role_col), F.col(text_col)).alias("key"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.dropDuplicates(["key"]).join(names, "key").select(F.col("name").alias("turn"), "role", "text")


def prefix_trie(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes of the trie of the conversations as they are, and the contents of their last turns.

    See :func:`ordered` for nulls, ties and repeated rows; columns other than conv_id, turn, role and text are not read. An
    empty table has no node, not even a root.
    """
    turns, names = ordered(conversations)
    return nodes(saved(members(*as_they_are(turns)), "trie")), contents(conversations, names)


def digest(conversations: DataFrame) -> DataFrame:
    """The contract's columns, of the conversations as :func:`rebuilt` makes them."""
    turns, _ = ordered(conversations)
    found = nodes(saved(members(*rebuilt(turns)), "trie"))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


#: The same in SQL: rebuilt conversations as lists, nodes by the hash of their prefix, subtrees by joining prefixes of representatives.
ORACLE = r"""
WITH t AS MATERIALIZED (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS p FROM conversations WHERE conv_id IS NOT NULL),
hs AS MATERIALIZED (SELECT c, own, c - c % 100 AS b, xor(list_reduce(list_concat([4294967295], flatten(list_transform(regexp_extract_all(hex(encode(CAST(c AS VARCHAR))), '..'),
           lambda h : [CAST((instr('0123456789ABCDEF', h[1]) - 1) * 16 + instr('0123456789ABCDEF', h[2]) - 1 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
           lambda c, b : xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295) % 6 AS h FROM (SELECT c, count(*) AS own FROM t GROUP BY c)),
k AS MATERIALIZED (SELECT a.*, least(a.h, coalesce(g.own, 0)) AS took FROM hs a LEFT JOIN hs g ON g.c = a.b),
rb AS MATERIALIZED (SELECT k.c, t.p, t.r, t.x FROM k JOIN t ON t.c = k.b AND t.p < k.h UNION ALL SELECT k.c, k.took + t.p - k.h, t.r, t.x FROM k JOIN t ON t.c = k.c AND t.p >= k.h),
m0 AS MATERIALIZED (SELECT c, p + 1 AS d, length(x) AS chars, sha256(string_agg(sha256(length(r) || ':' || r || x), ',') OVER (PARTITION BY c ORDER BY p)) AS id FROM rb
  UNION ALL SELECT c, 0, 0, '' FROM k),
len AS (SELECT c, max(d) AS l FROM m0 GROUP BY c),
m AS MATERIALIZED (SELECT m0.*, l, lag(id) OVER (PARTITION BY c ORDER BY d) AS up, min(c) OVER (PARTITION BY d, id) AS rep FROM m0 JOIN len USING (c)),
n AS MATERIALIZED (SELECT d, id, min(up) AS up, min(c) AS c, count(*) AS n, max(chars) AS chars, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE l = d) AS ends FROM m GROUP BY d, id),
ch AS MATERIALIZED (SELECT d - 1 AS d, up AS id, count(*) AS k FROM n WHERE d > 0 GROUP BY ALL),
full_n AS MATERIALIZED (SELECT n.*, coalesce(ch.k, 0) AS k FROM n LEFT JOIN ch USING (d, id)),
sub AS MATERIALIZED (SELECT m.d, m.id, sum((u.n - 1) * u.chars) AS saved, count(*) FILTER (WHERE u.k = 0) AS leaves FROM full_n u JOIN m ON m.c = u.c AND m.d <= u.d GROUP BY ALL)
SELECT f.c AS conv_id, CAST(f.d AS BIGINT) AS depth, p.c AS parent_conv_id, f.n AS n_convs, CAST(f.k AS BIGINT) AS n_children, CAST(sub.leaves AS BIGINT) AS n_leaves, CAST(sub.saved AS BIGINT) AS saved_tokens, sha256(coalesce(f.ends, '')) AS ends_sha256
FROM full_n f JOIN sub USING (d, id) LEFT JOIN full_n p ON p.d = f.d - 1 AND p.id = f.up
"""
