"""A stored positional full-text index: built in segments, kept up by deltas with tombstones, searched without the texts.

A posting is a word of one record with its sorted positions and the record's length, so that words, prefixes, phrases and
NEAR groups are answered and ranked from the postings of the query's words alone. Files are cut by ranges of words, so that a
query opens the ones that can hold its words; a word of very many records is spread over several.

An update writes one segment: postings of added records, and tombstones of removed ones, which hide them in all segments
before. Segments are never changed; number and summed length of the live records are kept with the list of segments, so that a
search reads no other table.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plinth.functions.text import tokens
from plinth.operators.search import B, K1, Near, Term, leaves, parse

_RECORD = ["record_kind", "record_id"]
_POSTING = "term string, record_kind string, record_id string, length int, positions array<int>"
_LENGTH = "record_kind string, record_id string, length int"


def positions(content: DataFrame) -> DataFrame:
    """``(term, record_kind, record_id, length, positions)`` of ``content(record_kind, record_id, content)``, whose records are unique.

    Each record is taken apart where it is: a shuffle of all words would cost more than the index.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.list_(pa.int32()))
        for whole in batches:
            for start in range(0, whole.num_rows, 64):
                rows = []
                for kind, ident, words in zip(*(c.to_pylist() for c in whole.slice(start, 64).columns), strict=True):
                    places: dict[str, list[int]] = {}
                    for i, word in enumerate(words):
                        places.setdefault(word, []).append(i)
                    rows += [(word, kind, ident, len(words), at) for word, at in places.items()]
                columns = list(zip(*rows, strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["term", *_RECORD, "length", "positions"])

    return content.select(*_RECORD, tokens(F.col("content")).alias("tokens")).mapInArrow(run, _POSTING)


@dataclass(frozen=True)
class Index:
    """A stored index: its folder, its segments from the oldest on, and number and summed length of its live records."""

    spark: SparkSession
    path: str
    segments: tuple[str, ...]
    n: int
    total: int

    def as_dict(self) -> dict:
        return {"segments": list(self.segments), "n": self.n, "total": self.total}

    def _read(self, what: str, shape: str) -> DataFrame:
        parts = [self.spark.read.schema(shape).parquet(f"{self.path}/{s}/{what}").withColumn("segment", F.lit(i)) for i, s in enumerate(self.segments)]
        return reduce(DataFrame.unionByName, parts)

    def _live(self, what: str, shape: str, words: Column | None = None) -> DataFrame:
        """Rows of all segments that no later segment hides."""
        rows = self._read(what, shape)
        if words is not None:
            rows = rows.filter(words)
        if len(self.segments) == 1:
            return rows.drop("segment")
        gone = self._read("tombstones", "record_kind string, record_id string").groupBy(*_RECORD).agg(F.max("segment").alias("hidden"))
        return rows.join(gone, _RECORD, "left").filter(F.col("hidden").isNull() | (F.col("hidden") <= F.col("segment"))).drop("segment", "hidden")

    def postings(self, words: Column | None = None) -> DataFrame:
        """Live postings, of the words that the condition on ``term`` lets through."""
        return self._live("postings", _POSTING, words)

    def lengths(self) -> DataFrame:
        return self._live("lengths", _LENGTH)


def _segment(content: DataFrame, removed: DataFrame | None, path: str, parts: int | None) -> tuple[str, int, int]:
    """Writes a segment: its name, number of records and summed length."""
    spark, name = content.sparkSession, f"segment-{uuid.uuid4().hex}"
    rows = positions(content)
    by = ["term", F.xxhash64(*_RECORD)]
    rows = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
    rows.sortWithinPartitions("term", *_RECORD).write.parquet(f"{path}/{name}/postings")
    content.select(*_RECORD, F.size(tokens(F.col("content"))).alias("length")).write.parquet(f"{path}/{name}/lengths")
    gone = removed.select(*_RECORD).distinct() if removed is not None else spark.createDataFrame([], "record_kind string, record_id string")
    gone.write.parquet(f"{path}/{name}/tombstones")
    n, total = spark.read.schema(_LENGTH).parquet(f"{path}/{name}/lengths").agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    return name, n, total


def build(content: DataFrame, path: str, parts: int | None = None) -> Index:
    """An index of one segment over ``content(record_kind, record_id, content)``, whose records are unique."""
    name, n, total = _segment(content, None, path, parts)
    return Index(content.sparkSession, path, (name,), n, total)


def update(index: Index, added: DataFrame, removed: DataFrame, parts: int | None = None) -> Index:
    """The index without the records ``removed(record_kind, record_id)`` and with the records ``added``; the one given still works.

    A changed record is in both. Removed records that are not there do no harm.
    """
    gone = index.lengths().join(removed.select(*_RECORD).distinct(), _RECORD, "left_semi").agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    name, n, total = _segment(added, removed, index.path, parts)
    return Index(index.spark, index.path, (*index.segments, name), index.n - gone[0] + n, index.total - gone[1] + total)


def compact(index: Index, parts: int | None = None) -> Index:
    """The same index as one segment; the old segments stay until their last reader is gone."""
    name, by = f"segment-{uuid.uuid4().hex}", ["term", F.xxhash64(*_RECORD)]
    rows = index.postings()
    rows = rows.repartitionByRange(parts, *by) if parts else rows.repartitionByRange(*by)
    rows.sortWithinPartitions("term", *_RECORD).write.parquet(f"{index.path}/{name}/postings")
    index.lengths().write.parquet(f"{index.path}/{name}/lengths")
    index.spark.createDataFrame([], "record_kind string, record_id string").write.parquet(f"{index.path}/{name}/tombstones")
    return Index(index.spark, index.path, (name,), index.n, index.total)


def differences(index: Index, content: DataFrame) -> DataFrame:
    """Postings that the index has and should not, or lacks: empty for a sound index."""
    keys = ["term", *_RECORD, "length", "positions"]
    have, want = index.postings().select(*keys), positions(content).select(*keys)
    return have.exceptAll(want).withColumn("problem", F.lit("stale")).unionByName(want.exceptAll(have).withColumn("problem", F.lit("missing")))


def _terms(tree) -> list[Term]:
    """All words, prefixes and phrases of a query, those of NEAR groups too."""
    return list(dict.fromkeys(t for leaf in leaves(tree) for t in (leaf.terms if isinstance(leaf, Near) else (leaf,))))


def _slots(terms: list[Term]) -> list[tuple[str, bool]]:
    """The words whose positions are needed, each whole or as the start of a word."""
    return list(dict.fromkeys((w, t.prefix and i == len(t.words) - 1) for t in terms for i, w in enumerate(t.words)))


def _is(slot: tuple[str, bool]) -> Column:
    return F.col("term").startswith(slot[0]) if slot[1] else F.col("term") == slot[0]


def wanted(tree) -> Column:
    """The condition on ``term`` of the postings that a query needs."""
    return reduce(lambda a, b: a | b, [_is(s) for s in _slots(_terms(tree))])


def _near(rows: DataFrame, group: Near, names: list[str]) -> DataFrame:
    """``(record, f..)``: instances of each phrase of a NEAR group that are part of a clump.

    A clump has an instance of every phrase, the last of which begins at most ``distance`` words after the first ended. Instances are
    merged in order of their places, one window a record: the first of a clump sees the next of every phrase in reach.
    """
    sizes = [len(t.words) for t in group.terms]

    def placed(j: int, name: str) -> Column:
        return F.transform(name, lambda p: F.struct(p.alias("p"), F.lit(j).alias("j"), (p + sizes[j] + group.distance).alias("reach")))

    each = rows.filter(reduce(lambda a, b: a & b, [F.size(n) > 0 for n in names]))
    each = each.select(*_RECORD, F.explode(F.flatten(F.array(*[placed(j, n) for j, n in enumerate(names)]))).alias("x"))
    each = each.select(*_RECORD, "x.p", "x.j", "x.reach")
    order = Window.partitionBy(*_RECORD).orderBy("p")
    ahead, behind = order.rangeBetween(0, Window.unboundedFollowing), order.rangeBetween(Window.unboundedPreceding, 0)
    every = range(len(names))
    first = reduce(lambda a, b: a & b, [F.coalesce(F.min(F.when(F.col("j") == j, F.col("p"))).over(ahead) <= F.col("reach"), F.lit(False)) for j in every])
    each = each.withColumn("first", first)
    # the farthest reach of a first of another phrase; of its own phrase an instance must be a first itself
    others = [F.max(F.when(F.col("first") & (F.col("j") == j), F.col("reach"))).over(behind) for j in every]
    inside = reduce(lambda a, b: a | b, [F.coalesce((F.col("j") != j) & (others[j] >= F.col("p")), F.lit(False)) for j in every])
    each = each.withColumn("inside", F.col("first") | inside)
    return each.groupBy(*_RECORD).agg(*[F.count_if(F.col("inside") & (F.col("j") == j)).alias(f"near{j}") for j in every]).filter("near0 > 0")


def instances(found: DataFrame, group: Near) -> DataFrame:
    """``(record_kind, record_id, near0, near1 ..)``: how many instances of each phrase of a NEAR group are close to the others."""
    return _near(_starts(found, list(group.terms)), group, [f"s{i}" for i in range(len(group.terms))])


def _starts(found: DataFrame, terms: list[Term]) -> DataFrame:
    """``(record, length, s0, s1 ..)``: the places at which each term begins."""
    slots = _slots(terms)
    by = found.groupBy(*_RECORD, "length").agg(*[F.flatten(F.collect_list(F.when(_is(s), F.col("positions")))).alias(f"w{i}") for i, s in enumerate(slots)])

    def moved(slot: int, back: int) -> Column:
        return F.transform(f"w{slot}", lambda p: p - back)

    def starts(t: Term) -> Column:
        return reduce(F.array_intersect, [moved(slots.index((w, t.prefix and i == len(t.words) - 1)), i) for i, w in enumerate(t.words)])

    return by.select(*_RECORD, "length", *[starts(t).alias(f"s{i}") for i, t in enumerate(terms)])


def hits(found: DataFrame, tree, n: int, total: int) -> DataFrame:
    """``(record_kind, record_id, rank)`` of all records that fit, from the :func:`wanted` postings among ``n`` records of ``total`` words."""
    terms = _terms(tree)
    by = _starts(found, terms)
    # parts of the rank: count of instances, and of the records that have any
    parts: list[tuple[Column, int]] = []
    conditions: dict = {}
    with_near = by
    for k, leaf in enumerate(leaves(tree)):
        if isinstance(leaf, Near):
            of = [terms.index(t) for t in leaf.terms]
            near = _near(by, leaf, [f"s{i}" for i in of]).withColumnsRenamed({f"near{j}": f"near{k}_{j}" for j in range(len(of))})
            with_near = with_near.join(near, _RECORD, "left")
            counts = [F.coalesce(F.col(f"near{k}_{j}"), F.lit(0)) for j in range(len(of))]
            parts += [(c, i) for c, i in zip(counts, of, strict=True)]
            conditions[leaf] = counts[0] > 0
        else:
            i = terms.index(leaf)
            parts.append((F.size(f"s{i}"), i))
            conditions[leaf] = F.size(f"s{i}") > 0

    def holds(node) -> Column:
        if not isinstance(node, tuple):
            return conditions[node]
        a, b = holds(node[1]), holds(node[2])
        return a & b if node[0] == "and" else a | b if node[0] == "or" else a & ~b

    have = by.agg(*[F.count_if(F.size(f"s{i}") > 0).alias(f"n{i}") for i in range(len(terms))])  # one row
    mean = total / n if n else 1.0
    rank = F.lit(0.0)
    for f, i in parts:
        df = F.col(f"n{i}")
        idf = F.ln((n - df + 0.5) / (df + 0.5))
        rank = rank + F.when(idf > 0, idf).otherwise(1e-6) * f * (K1 + 1) / (f + K1 * (1 - B + B * F.col("length") / mean))
    return with_near.filter(holds(tree)).join(F.broadcast(have), F.lit(True)).select(*_RECORD, (-rank).alias("rank"))


def search(index: Index, query: str, limit: int | None = None) -> DataFrame:
    """``(record_kind, record_id, rank)`` of the best ``limit`` records, or of all that fit in no order; raises QuerySyntaxError.

    Reads the postings of the query's words and nothing else.
    """
    tree = parse(query)
    found = hits(index.postings(wanted(tree)), tree, index.n, index.total)
    return found if limit is None else found.orderBy("rank", *_RECORD).limit(limit)
