"""Repeated substrings by compacted de Bruijn paths.

Windows of ``width`` words are the edges of a de Bruijn graph over ``width`` - 1 words. A repeated passage is a path of
edges that several documents walk, and it branches only where their texts part. The graph is compacted twice:

1. Every text is read once and cut where the least k-mer of the window changes. Such a segment depends on its words
   alone, so equal text is cut alike wherever it stands: a segment is a stretch of edges in one row.
2. Segments are grouped by their least k-mer, which equal windows share. Every occurrence of a segment but the first is
   a repeated span of the first. Where one k-mer has different segments the graph branches inside them: the first
   occurrence of each goes into single edges, and those are grouped in turn. Later occurrences never need to.
3. A place where one span ends and the next one of the same document and source begins is a node with one edge in and
   one out. Such nodes are contracted by aggregation, and a join of path starts with path ends gives the longest
   spans.
4. The words of every longest span are compared at the source's coordinates, by SHA-256 of both.

Frequent keys: k-mers are counted in ranges of their hash (a table of 65,536 sums). A range is hot with more than twice
the rows of an average task, so there are fewer hot ranges than tasks. Their segments are counted one by one, by sums
that tasks combine before the shuffle, and are then dealt by segment rather than by k-mer; segments that are hot
themselves, again fewer than tasks, are not dealt at all: their first places go to the tasks that hold their rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from plinth.llm.common import forget, hot_join, saved
from plinth.llm.prefix import running
from plinth.llm.rolling import run_hashes

_BYTE_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD1342543DE82EF95
_TEXT = 1 << 20  # bytes hashed at once
_PIECE = 1 << 18  # words whose windows are looked at at once
_SLICE = 1 << 23  # bytes of texts whose word hashes are held at once (or one text)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of texts ``data[offsets[i]:offsets[i + 1]]`` (UTF-8), and where each text's words begin.

    Words are runs of bytes other than ASCII white space. Bytes are hashed in pieces that end between words.
    """
    hashes, begins = [], []
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        stop = min(at + _TEXT, end)
        if stop < end:  # to the next white space or text
            limit = int(offsets[np.searchsorted(offsets, stop)])
            while stop < limit:
                part = data[stop : min(stop + 65536, limit)]
                gap = np.flatnonzero((part == 32) | ((part - np.uint8(9)) < 5))
                if len(gap):
                    stop += int(gap[0])
                    break
                stop += len(part)
        b = data[at:stop]
        inside = np.empty(len(b) + 2, dtype=bool)
        inside[0] = inside[-1] = False
        inside[1:-1] = (b != 32) & ((b - np.uint8(9)) > 4)
        heads = offsets[np.searchsorted(offsets, at, side="right") : np.searchsorted(offsets, stop)] - at  # inner text starts
        first, last = inside[1:-1] & ~inside[:-2], inside[1:-1] & ~inside[2:]
        first[heads], last[heads - 1] = inside[1:-1][heads], inside[1:-1][heads - 1]
        start, after = np.flatnonzero(first), np.flatnonzero(last) + 1
        run = run_hashes(b.astype(np.uint64) + np.uint64(1), _BYTE_BASE)
        hashes.append(run(start, after) + (after - start).astype(np.uint64))
        begins.append(start + at)
        at = stop
    h = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    return h, np.searchsorted(np.concatenate(begins) if begins else np.zeros(0, np.int64), offsets)


def _texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices of a binary column as (first row, end row, bytes, offsets)."""
    wide = pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, dtype=np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64) if len(column) else np.zeros(1, np.int64)
    values = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _SLICE, side="right")) - 1)
        yield i, j, values, offsets[i : j + 1]
        i = j


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of all windows of ``width`` values."""
    size, out = 1, values
    while size * 2 <= width:
        out, size = np.minimum(out[:-size], out[size:]), size * 2
    return np.minimum(out[: len(out) - (width - size)], out[width - size :]) if size < width else out


def _pieces(first: np.ndarray, width: int) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of words (first text, end text, first word, end word): whole texts together, long ones in pieces that
    overlap by ``width`` - 1 words, so that every window is in exactly one."""
    i, n = 0, len(first) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(first, first[i] + _PIECE, side="right")) - 1)
        j = min(j, n)
        if j > i + 1 or first[j] - first[i] <= _PIECE:
            yield i, j, int(first[i]), int(first[j])
        else:
            for at in range(int(first[i]), int(first[j]) - width + 1, _PIECE):
                yield i, j, at, min(at + _PIECE + width - 1, int(first[j]))
        i = j


def segments(h: np.ndarray, first: np.ndarray, width: int, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays (text, least k-mer, segment hash, start, windows) over word hashes of several texts, piece by piece.

    The cut of a segment at a piece's end is a branch like any other.
    """
    counts, mask = np.diff(first), np.uint64((1 << 20) - 1)
    for i, j, at, end in _pieces(first, width):
        n = end - at
        if n < width:
            continue
        run = run_hashes(h[at:end], _WORD_BASE)
        text = np.repeat(np.arange(i, j), counts[i:j]) if j > i + 1 or n == counts[i] else np.full(n, i)
        where = np.arange(n - k + 1)
        kmer = run(where, where + k)
        least = (_least((kmer & ~mask) | where.astype(np.uint64), width - k + 1) & mask).astype(np.int64)
        inside = text[: n - width + 1] == text[width - 1 :]
        new = np.ones(len(least), dtype=bool)
        new[1:] = (least[1:] != least[:-1]) | (inside[1:] != inside[:-1])
        starts = np.flatnonzero(new)
        ends = np.append(starts[1:], len(least))
        starts, ends = starts[inside[starts]], ends[inside[starts]]
        whole = run(starts, ends + width - 1) ^ (ends - starts).astype(np.uint64)
        own = text[starts]
        yield own, kmer[least[starts]], whole, starts + at - first[own], ends - starts


def _numbered(docs: DataFrame, id_col: str, text_col: str, bucket_rows: int = 20_000) -> DataFrame:
    """``(doc, body)``: ``doc`` is a struct of the id and a number from 0 for rows that share an id, by a hash of their
    text. Only texts of repeated ids are moved; prefix sums number them, however many rows one id has."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("body"))
    twice = saved(rows.groupBy(F.struct("id").alias("one")).agg(F.count("*").alias("n")).filter("n > 1"), "repeated-ids")
    total = twice.agg(F.sum("n")).first()[0]
    if not total:
        return rows.select(F.struct("id", F.lit(0).alias("copy")).alias("doc"), "body")
    keyed = rows.withColumn("one", F.struct("id"))
    buckets = max(1, -(-total // bucket_rows))
    again = keyed.join(twice.select("one"), "one", "left_semi").withColumn("key", F.xxhash64("body"))
    again = again.withColumn("bucket", F.floor((F.col("key").cast("double") + 2.0**63) / 2.0**64 * buckets).cast("bigint"))
    again = saved(running(again, ["one"], "bucket", ["key", "body"], F.lit(1), "copy", "all").select(F.struct("id", F.col("copy").cast("int").alias("copy")).alias("doc"), "body"), "repeated")
    once = keyed.join(twice.select("one"), "one", "left_anti").select(F.struct("id", F.lit(0).alias("copy")).alias("doc"), "body")
    return once.unionByName(again)


def _segment_rows(rows: DataFrame, width: int, k: int) -> DataFrame:
    """``(doc, m, c, start, r)``: least k-mer, segment class, first word and windows of every segment of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, _, data, offsets in _texts(batch.column(1)):
                h, first = word_hashes(data, offsets)
                for own, m, c, start, r in segments(h, first, width, k):
                    arrays = [pa.array(x) for x in (m.view(np.int64), c.view(np.int64), start.astype(np.int32), r.astype(np.int32))]
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(own + i)), *arrays], names=["doc", "m", "c", "start", "r"])

    return rows.mapInArrow(run, _schema(rows, m=T.LongType(), c=T.LongType(), start=T.IntegerType(), r=T.IntegerType()))


def _schema(rows: DataFrame, **more: T.DataType) -> T.StructType:
    return T.StructType([T.StructField("doc", rows.schema["doc"].dataType), *[T.StructField(n, t) for n, t in more.items()]])


def _grouped(apart: list[int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From rows sorted by (m, c, doc, start): later rows of a class with the place of its first, and, without a
    source, the first rows of classes whose ``m`` has several. Rows of one ``m`` are held together, but for ranges
    ``apart``, whose classes may be dealt to several tasks: what branches there is known otherwise."""

    def places(batch: pa.RecordBatch) -> pa.RecordBatch:
        m, c = batch.column(1).to_numpy(), batch.column(2).to_numpy()
        new = np.ones(len(m), dtype=bool)
        new[1:] = m[1:] != m[:-1]
        of = np.cumsum(new) - 1
        new[1:] |= c[1:] != c[:-1]
        firsts = np.flatnonzero(new)
        source = firsts[np.cumsum(new) - 1]
        branches = (np.bincount(of[firsts]) > 1)[of] & ~np.isin(m.view(np.uint64) >> np.uint64(48), np.array(apart, dtype=np.uint64))
        later = ~new
        at = np.flatnonzero(later | branches)
        src = pa.array(source[at], mask=~later[at])
        found, rows = batch.take(pa.array(at)), [batch.column(0).take(src), batch.column(3).take(src)]
        return pa.RecordBatch.from_arrays([found.column(0), found.column(1), found.column(3), found.column(4), *rows], names=_PLACE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            m = batch.column(1).to_numpy()
            if held and held[0].column(1)[0].as_py() != m[0]:
                yield places(pa.concat_batches(held))
                held = []
            cut = int(np.searchsorted(m, m[-1]))
            if cut:
                yield places(pa.concat_batches([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield places(pa.concat_batches(held))

    return run


_PLACE = ["doc", "m", "start", "r", "src", "src_start"]
_RANGE = "cast(shiftrightunsigned(m, 48) as int)"


def _places(rows: DataFrame, what: str, least_hot: int, hot_tasks: float) -> DataFrame:
    """Saved ``(doc, m, start, r, src, src_start)`` from saved ``rows(doc, m, c, start, r)``; see :func:`_grouped`."""
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    counts = rows.groupBy(F.expr(_RANGE).alias("range")).agg(F.count("*").alias("n")).collect()  # 65,536 at most
    limit = max(least_hot, int(hot_tasks * sum(r["n"] for r in counts) / n))
    hot = sorted(r["range"] for r in counts if r["n"] > limit)  # fewer than n / hot_tasks
    schema = _schema(rows, m=T.LongType(), start=T.IntegerType(), r=T.IntegerType(), src=rows.schema["doc"].dataType, src_start=T.IntegerType())
    rows = rows.select("doc", "m", "c", "start", "r")
    if not hot:
        dealt = rows.repartition(n, "m").sortWithinPartitions("m", "c", "doc", "start")
        return saved(dealt.mapInArrow(_grouped([]), schema), what)
    is_hot = F.expr(_RANGE).isin(hot)
    classes = saved(rows.filter(is_hot).groupBy("m", "c").agg(F.count("*").alias("n"), F.min(F.struct("doc", "start", "r")).alias("first")), "classes")
    several = saved(classes.groupBy("m").agg(F.count("*").alias("n")).filter("n > 1").select("m"), "branches")
    branching = classes.join(several, "m", "left_semi").select("first.doc", "m", "first.start", "first.r", F.lit(None).cast(schema["src"].dataType).alias("src"), F.lit(None).cast("int").alias("src_start"))
    top = classes.filter(F.col("n") > limit).select("m", "c", "first").orderBy("m", "c").collect()  # fewer than n / hot_tasks
    keys = np.array([(r["m"], r["c"]) for r in top], dtype=np.int64).reshape(-1, 2)
    first_docs, first_starts = pa.array([r["first"]["doc"].asDict() for r in top], to_arrow_type(rows.schema["doc"].dataType)), pa.array([r["first"]["start"] for r in top], pa.int32())

    def later(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = [tuple(k) for k in keys.tolist()]
        index = {k: i for i, k in enumerate(pairs)}
        for batch in batches:
            near = np.flatnonzero(np.isin(batch.column(1).to_numpy(), keys[:, 0]))
            found = [(int(i), j) for i in near if (j := index.get((batch.column(1)[i].as_py(), batch.column(2)[i].as_py()))) is not None]
            own = batch.take(pa.array([i for i, _ in found], pa.int64()))
            to = pa.array([j for _, j in found], pa.int64())
            src, start = first_docs.take(to), first_starts.take(to)
            other = [a != b or x != y for a, b, x, y in zip(own.column(0).to_pylist(), src.to_pylist(), own.column(3).to_pylist(), start.to_pylist(), strict=True)]
            out = pa.RecordBatch.from_arrays([own.column(0), own.column(1), own.column(3), own.column(4), src, start], names=_PLACE)
            yield out.filter(pa.array(other, pa.bool_()))

    is_top = F.struct("m", "c").isin([F.struct(F.lit(r["m"]), F.lit(r["c"])) for r in top]) if top else F.lit(False)
    dealt = rows.filter(~is_top).withColumn("deal", F.when(is_hot, F.xxhash64("m", "c")).otherwise(F.col("m"))).repartition(n, "deal").drop("deal")
    found = dealt.sortWithinPartitions("m", "c", "doc", "start").mapInArrow(_grouped(hot), schema)
    if top:
        found = found.unionByName(rows.filter(is_top).mapInArrow(later, schema))
    return saved(found.unionByName(branching), what)


def _with_texts(rows: DataFrame, wanted: DataFrame, most_broadcast: int) -> DataFrame:
    """``rows(doc, body)`` joined with saved ``wanted(doc, ...)``; texts stay where they are up to ``most_broadcast``
    wanted documents, and are shuffled beyond."""
    names = wanted.select("doc").distinct()
    few = rows.join(F.broadcast(names), "doc", "left_semi") if wanted.count() <= most_broadcast else rows
    return few.join(wanted, "doc")


def _windows(rows: DataFrame, wanted: DataFrame, width: int, most_broadcast: int) -> DataFrame:
    """Single windows ``(doc, m, c, start, r)`` of the segments that ``wanted(doc, places)`` names."""
    joined = _with_texts(rows, wanted, most_broadcast).select("doc", "body", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in _texts(batch.column(1)):
                h, first = word_hashes(data, offsets)
                chosen = batch.column(2).slice(i, j - i)
                lengths, flat = np.diff(chosen.offsets.to_numpy()), chosen.flatten()
                start, r, m = (flat.field(f).to_numpy() for f in ("start", "r", "m"))
                own = np.repeat(np.arange(j - i), lengths)
                within = np.arange(int(r.sum())) - np.repeat(np.cumsum(r) - r, r)
                pos, doc = np.repeat(start, r) + within, np.repeat(own, r)
                w = run_hashes(h, _WORD_BASE)(first[doc] + pos, first[doc] + pos + width)
                arrays = [pa.array(np.repeat(m, r)), pa.array(w.view(np.int64)), pa.array(pos.astype(np.int32)), pa.array(np.ones(len(pos), np.int32))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc + i)), *arrays], names=["doc", "m", "c", "start", "r"])

    return joined.mapInArrow(run, _schema(rows, m=T.LongType(), c=T.LongType(), start=T.IntegerType(), r=T.IntegerType()))


def compacted(spans: DataFrame) -> DataFrame:
    """Longest spans ``(doc, start, r, src, src_start)`` of ``spans``, which name disjoint windows.

    Along one document, source and distance every span adds a path start and a path end. A place with one of each is
    passed through and cancels out; the k-th start that is left belongs to the k-th end.
    """
    line = ["doc", "src", "shift"]
    ends = spans.select("doc", "src", (F.col("start") - F.col("src_start")).alias("shift"), F.explode(F.array(F.struct(F.col("start").alias("at"), F.lit(1).alias("d")), F.struct((F.col("start") + F.col("r")).alias("at"), F.lit(-1).alias("d")))).alias("e"))
    left = saved(ends.groupBy(*line, "e.at").agg(F.sum("e.d").alias("d")).filter("d <> 0"), "path-ends")
    ranked = left.withColumn("k", F.row_number().over(Window.partitionBy(*line, "d").orderBy("at")))
    heads, tails = ranked.filter("d > 0").select(*line, "k", F.col("at").alias("start")), ranked.filter("d < 0").select(*line, "k", F.col("at").alias("end"))
    paths = heads.join(tails, [*line, "k"])
    return paths.select("doc", "start", (F.col("end") - F.col("start")).alias("r"), "src", (F.col("start") - F.col("shift")).alias("src_start"))


def _source_hashes(rows: DataFrame, ranges: DataFrame, width: int, most_broadcast: int) -> DataFrame:
    """``(src, src_start, r, sha)``: SHA-256 of the words at each of ``ranges(src, src_start, r)`` in the source."""
    many = saved(ranges.groupBy("src").agg(F.count("*").alias("n")).filter("n > 4096"), "many-ranges")
    parts = hot_join(ranges, many, ["src"], "n", how="left").withColumn("part", F.pmod(F.xxhash64("src_start", "r"), F.expr("coalesce(n div 1024, 1)")))
    wanted = parts.groupBy(F.col("src").alias("doc"), "part").agg(F.collect_list(F.struct(F.col("src_start").alias("start"), "r")).alias("places"))
    joined = _with_texts(rows, saved(wanted, "ranges"), most_broadcast).select("doc", "body", "places")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                words, places = batch.column(1)[i].as_py().split(), batch.column(2)[i].values
                start, r = places.field("start").to_numpy(), places.field("r").to_numpy()
                shas = [_sha(words, a, n, width) for a, n in zip(start.tolist(), r.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(np.full(len(start), i))), pa.array(start), pa.array(r), pa.array(shas, pa.binary())], names=["doc", "start", "r", "sha"])

    found = joined.mapInArrow(run, _schema(rows, start=T.IntegerType(), r=T.IntegerType(), sha=T.BinaryType()))
    return found.select(F.col("doc").alias("src"), F.col("start").alias("src_start"), "r", "sha")


def _sha(words: list[bytes], start: int, r: int, width: int) -> bytes:
    return sha256(b" ".join(words[start : start + r + width - 1])).digest()


def repeats(docs: DataFrame, width: int = 20, k: int = 10, id_col: str = "doc_id", text_col: str = "text", most_broadcast: int = 500_000, least_hot: int = 4096, hot_tasks: float = 2.0) -> tuple[DataFrame, DataFrame]:
    """All rows as ``(doc, body)`` and the longest repeated spans ``(doc, start, r, src, src_start, sha)``.

    ``r`` windows from word ``start`` on stand word for word from ``src_start`` in the source, an earlier place
    (smaller id, or same document and earlier start; null ids come first; rows with one id are ordered by a hash of
    their text). ``sha`` is that of the source's words.
    """
    rows = _numbered(docs, id_col, text_col)
    cut = saved(_segment_rows(rows, width, k), "segments")
    found = _places(cut, "places", least_hot, hot_tasks)
    later, open_ = found.filter("src_start is not null"), found.filter("src_start is null")
    wanted = saved(open_.groupBy("doc").agg(F.collect_list(F.struct("start", "r", "m")).alias("places")), "branching")
    forget(cut)
    windows = saved(_windows(rows, wanted, width, most_broadcast), "windows")
    single = _places(windows, "window-places", least_hot, hot_tasks).filter("src_start is not null")
    forget(windows)
    paths = saved(compacted(later.unionByName(single).drop("m")), "paths")
    ranges = saved(paths.groupBy("src", "src_start", "r").agg(F.count("*").alias("n")), "source-ranges")
    shas = saved(_source_hashes(rows, ranges.drop("n"), width, most_broadcast), "source-words")
    known = saved(shas.join(ranges, ["src", "src_start", "r"]), "sources")
    return rows, saved(hot_join(paths, known, ["src", "src_start", "r"], "n").select(*paths.columns, "sha"), "spans")


def _kept(rows: DataFrame, width: int) -> DataFrame:
    """``rows(id, body, spans)`` with what is left of each: ``(id, n_words, n_removed, kept)``.

    Every span's words are compared with its source's; a difference would mean that hashes of 128 bits collided, and
    stops the job rather than removing other words.
    """
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, spans in zip(batch.column(1), batch.column(2), strict=True):
                words = body.as_py().split()
                left, n = words, len(words)
                if spans.is_valid:
                    values, edge = spans.values, np.zeros(n + 1, dtype=np.int64)
                    start, r = values.field("start").to_numpy(), values.field("r").to_numpy()
                    for a, m, sha in zip(start.tolist(), r.tolist(), values.field("sha").to_pylist(), strict=True):
                        if _sha(words, a, m, width) != sha:
                            raise ValueError(f"words {a} to {a + m + width - 1} differ from their source's")
                    np.add.at(edge, start, 1)
                    np.add.at(edge, start + r + width - 1, -1)
                    left = list(compress(words, np.cumsum(edge[:-1]) <= 0))
                out.append((n, n - len(left), b" ".join(left)))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.binary())], names=["id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(run, f"id {kind}, n_words bigint, n_removed bigint, kept binary")


def remove_repeats(docs: DataFrame, width: int = 20, k: int = 10, id_col: str = "doc_id", text_col: str = "text", most_broadcast: int = 500_000, least_hot: int = 4096, hot_tasks: float = 2.0) -> DataFrame:
    """``(id, n_words, n_removed, kept)`` per row: ``kept`` is the UTF-8 of the words left, joined by one space.

    Words are runs of bytes other than ASCII white space. A word goes if a window of ``width`` words that covers it
    also starts earlier; windows are judged on the input. Null texts have no words; other columns are ignored. Rows
    that share an id are ordered by a hash of their text, null ids come first.
    """
    rows, spans = repeats(docs, width, k, id_col, text_col, most_broadcast, least_hot, hot_tasks)
    of = saved(spans.groupBy("doc").agg(F.collect_list(F.struct("start", "r", "sha")).alias("spans")), "document-spans")
    kind = of.schema["spans"].dataType
    if of.count() <= most_broadcast:
        untouched = rows.join(F.broadcast(of.select("doc")), "doc", "left_anti").select("doc.id", "body", F.lit(None).cast(kind).alias("spans"))
        touched = _with_texts(rows, of, most_broadcast).select("doc.id", "body", "spans")
        both = [_kept(untouched, width), _kept(touched, width)]
    else:
        both = [_kept(rows.join(of, "doc", "left").select("doc.id", "body", "spans"), width)]
    out = both[0] if len(both) == 1 else both[0].unionByName(both[1])
    return out.withColumnRenamed("id", id_col)


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
