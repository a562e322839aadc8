"""WARC archives with a two-level capture index.

Writing: one gzip member per record, so that any record can be read by its byte range alone. Records with equal
payloads become one response and revisits of it. Spark's text writer puts the bytes down (members are handed over as
strings without being decoded), so archives go to any file system Spark can write, and a task that is run twice leaves
one file. Files hold at most ``FILE_CHUNKS`` chunks of about ``CHUNK_BYTES`` (or one record more), whatever the input.

Index: captures are sorted by (URL key with reversed host, page) over range partitions; each run of ``block_lines``
sorted lines is deflated into a block, and a sparse directory keeps each block's first and last key, file, offset and
length. A lookup searches the bounds of the index files, then the directory of one file, by bisection, reads the
ranges of the blocks that can hold the key, and bisects in them. Records are read by their ranges too.

Ranges are read by seeking, where pyarrow can open the archives' file system (local, HDFS, object stores); on any
other, Spark's ``binaryFile`` reader hands over the (bounded) file and the range is cut out of it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plinth.llm.common import saved, scratch

_EMPTY_DATE = "1970-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNK_BYTES, FILE_CHUNKS = 1 << 20, 64


def url_key(url: str | None) -> str:
    """The host with its labels reversed, then ``)``, path and query: ``com,example)/a?b``. Null is the empty key.

    Scheme, user, a leading ``www``, default ports and the fragment are left out; host case is folded. A text that is
    no URL is its own key.
    """
    url = (url or "").strip()
    try:
        parts = urlsplit(url)
        host, port = (parts.hostname or "").lower(), parts.port
    except ValueError:
        return url
    if not host:
        return url
    host = re.sub(r"^www\d*\.", "", host)
    shown = f":{port}" if port and port not in (80, 443) else ""
    return ",".join(reversed(host.split("."))) + shown + ")" + (parts.path or "/") + (f"?{parts.query}" if parts.query else "")


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def _line(value: object) -> str:
    """A header value on one line."""
    return re.sub(r"[\r\n]+", " ", str(value))


def record(page_id: int | None, url: str | None, kind: str, digest: str, refers_to: int | None, payload: bytes) -> bytes:
    """A gzip member with one WARC record. The block of both kinds is an HTTP response head, which states the payload's
    length; a response's payload follows."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {_EMPTY_DATE}",
        f"WARC-Target-URI: {_line(url or '')}", f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {_PROFILE}"]
    body = http + (payload if kind == "response" else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(body)}"]
    deflate = zlib.compressobj(4, zlib.DEFLATED, 31)
    return deflate.compress("\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + body + b"\r\n\r\n") + deflate.flush()


def parse(raw: bytes) -> tuple[dict[str, str], bytes, int]:
    """Headers of one inflated record, its payload, and the payload's length as the HTTP head states it."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("no WARC record here")
    fields = dict(x.split(": ", 1) if ": " in x else (x.rstrip(":"), "") for x in lines[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    return fields, payload, int(re.search(rb"Content-Length: ([0-9]+)", http)[1])


def members(data: bytes) -> Iterator[tuple[int, int, bytes]]:
    """Offset, length and content of each gzip member that is not empty."""
    at = 0
    while at < len(data):
        inflate = zlib.decompressobj(31)
        parts, seen = [inflate.decompress(data[at : at + (1 << 16)])], at + (1 << 16)
        while not inflate.eof:
            if seen >= len(data):
                raise ValueError("an archive ends inside a record")
            parts.append(inflate.decompress(data[seen : seen + (1 << 20)]))
            seen += 1 << 20
        end, raw = min(seen, len(data)) - len(inflate.unused_data), b"".join(parts)
        if raw:
            yield at, end - at, raw
        at = end


#: A gzip member without content. Like any member below 16 MB it ends in a zero byte, the top of its length.
_NOTHING = zlib.compressobj(9, zlib.DEFLATED, 31).flush()


def _chunks(out: Iterator[bytes], least: int) -> Iterator[pa.RecordBatch]:
    """Members one after another in rows of ``least`` bytes and more, each without its last byte, which is zero."""
    held: list[bytes] = []

    def row() -> pa.RecordBatch:
        data = b"".join(held)
        return pa.RecordBatch.from_arrays([pa.array([data[:-1] if data[-1] == 0 else data + _NOTHING[:-1]], pa.binary())], names=["bytes"])

    size = 0
    for member in out:
        held.append(member)
        size += len(member)
        if size >= least:
            yield row()
            held, size = [], 0
    if held:
        yield row()


def _put(rows: DataFrame, path: str) -> None:
    """Writes rows of :func:`_chunks`; the line separator is the zero byte that each of them lacks."""
    rows.select(F.col("bytes").cast("string").alias("value")).write.option("lineSep", "\x00").option("maxRecordsPerFile", FILE_CHUNKS).text(path)


def decide(pages: DataFrame, min_revisit_bytes: int = 0, most_broadcast: int = 500_000) -> DataFrame:
    """``(page_id, url, payload, sha, record_type, refers_to)`` per row.

    Of equal payloads of at least ``min_revisit_bytes`` the smallest page id is the response; of rows that share it and
    the payload, the first by URL is. A null html is an empty payload. Null ids are never referred to: where a payload
    has no other, all its rows are responses. Payloads stay where they are while those that repeat number at most
    ``most_broadcast``.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload")).withColumn("sha", F.unhex(F.sha1("payload")))
    ids = rows.filter(F.octet_length("payload") >= min_revisit_bytes).groupBy("sha", "page_id").agg(F.count("*").alias("n"))
    least = F.min(F.when(F.col("page_id").isNotNull(), F.struct("page_id", "n")))
    again = saved(ids.groupBy("sha").agg(F.sum("n").alias("all"), least.alias("first")).filter("all > 1 and first is not null").select("sha", "first"), "repeated-payloads")
    joined = rows.join(F.broadcast(again) if again.count() <= most_broadcast else again, "sha", "left")
    lead = F.col("page_id").eqNullSafe(F.col("first.page_id"))
    joined = joined.withColumn("revisits", F.col("first").isNotNull() & ~lead)
    if not again.filter("first.n > 1").isEmpty():
        tied = F.coalesce(lead & (F.col("first.n") > 1), F.lit(False))
        place = F.row_number().over(Window.partitionBy("sha").orderBy("url"))
        joined = joined.filter(~tied).unionByName(joined.filter(tied).withColumn("revisits", place > 1))
    return joined.select("page_id", "url", "payload", "sha", F.when(F.col("revisits"), "revisit").otherwise("response").alias("record_type"), F.when(F.col("revisits"), F.col("first.page_id")).alias("refers_to"))


def write(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> None:
    """Writes all ``pages(page_id, url, html)`` as WARC records below ``path``."""
    chunk = CHUNK_BYTES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                ids, urls, bodies, shas, kinds, refs = (batch.column(i) for i in range(6))
                for i in range(batch.num_rows):
                    yield record(ids[i].as_py(), urls[i].as_py(), kinds[i].as_py(), base64.b32encode(shas[i].as_py()).decode(), refs[i].as_py(), bodies[i].as_py())

        yield from _chunks(records(), chunk)

    _put(decide(pages, min_revisit_bytes).mapInArrow(run, "bytes binary"), path)


def _archives(spark: SparkSession, path: str) -> DataFrame:
    """``(file, content)`` of the archive files, whose size is bounded."""
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), "content")


def _seekable(spark: SparkSession, path: str) -> str | None:
    """The full URI of ``path`` if pyarrow can open its file system."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    uri = where.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(where).toString().replace("s3a://", "s3://")
    uri = re.sub("^file:/(?!/)", "file:///", uri)
    try:
        files, at = fs.FileSystem.from_uri(uri)
        return uri if files.get_file_info(at).type == fs.FileType.Directory else None
    except (OSError, ValueError, ImportError):
        return None


class _Ranges:
    """Reads ranges of the files of one folder; the last file stays open."""

    def __init__(self, uri: str) -> None:
        self.files, self.folder = fs.FileSystem.from_uri(uri)
        self.name, self.file = None, None

    def __call__(self, name: str, offset: int, length: int) -> bytes:
        if name != self.name:
            self.close()
            self.file, self.name = self.files.open_input_file(f"{self.folder}/{name}"), name
        return self.file.read_at(length, offset)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _by_ranges(spark: SparkSession, path: str, wanted: DataFrame, use: Callable[[Iterator[tuple], Callable], Iterator[tuple]], schema: str, seek: bool = True) -> DataFrame:
    """``use(rows, read)`` over ``wanted(file, offset, length, ...)``, sorted by file and offset; ``read(file, offset,
    length)`` gives the bytes of a range. Ranges are dealt in stretches of 8 MB of a file."""
    uri = _seekable(spark, path) if seek else None
    types = T._parse_datatype_string(schema)
    arrow = to_arrow_schema(types)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [()] * len(arrow)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    if uri is not None:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            read = _Ranges(uri)
            found = use((row for b in batches for row in zip(*(c.to_pylist() for c in b.columns), strict=True)), read)
            held, size = [], 0
            for row in found:
                held.append(row)
                size += sum(len(x) for x in row if isinstance(x, bytes)) + 100
                if size > 1 << 22:
                    yield batch_of(held)
                    held, size = [], 0
            if held:
                yield batch_of(held)
            read.close()

        n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
        dealt = wanted.repartition(n, "file", F.expr("offset div 8388608")).sortWithinPartitions("file", "offset")
        return dealt.mapInArrow(run, types)

    def whole(rows: pa.Table, archive: pa.Table) -> pa.Table:
        content = archive.column("content")[0].as_py() if archive.num_rows else b""
        rows = rows.sort_by([("offset", "ascending")])
        found = list(use(zip(*(c.to_pylist() for c in rows.columns), strict=True), lambda _, offset, length: content[offset : offset + length]))
        return pa.Table.from_batches([batch_of(found)])

    return wanted.groupBy("file").cogroup(_archives(spark, path).groupBy("file")).applyInArrow(whole, types)


_CAPTURE = "key string, page_id bigint, file string, offset bigint, length bigint"


def captures(spark: SparkSession, path: str) -> DataFrame:
    """One row per record found in the archives, by walking their members."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = []
                for offset, length, raw in members(batch.column(1)[i].as_py()):
                    fields, _, _ = parse(raw)
                    page = fields["WARC-Record-ID"][len("<urn:page:") : -1]
                    rows.append((_escaped(url_key(fields["WARC-Target-URI"])), int(page) if page else None, batch.column(0)[i].as_py(), offset, length))
                yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=["key", "page_id", "file", "offset", "length"]).astype({"page_id": "Int64"}), schema=_capture_schema(), preserve_index=False)

    return _archives(spark, path).mapInArrow(run, _CAPTURE)


def _capture_schema() -> pa.Schema:
    return pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def _escaped(key: str) -> str:
    """Keys sort and compare in this form; it holds no tab or line break."""
    return key.replace("%", "%25").replace("\t", "%09").replace("\n", "%0A").replace("\r", "%0D")


def build_index(found: DataFrame, path: str, block_lines: int = 512) -> None:
    """Writes sorted, deflated blocks of captures below ``path/blocks`` and their directory below ``path/directory``.

    Range partitions are cut by (key, file, offset), so that a URL with most of the captures is spread over files.
    """
    n, chunk = max(int(found.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1), CHUNK_BYTES
    ordered = found.repartitionByRange(n, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(lines: list[str]) -> bytes:
            deflate = zlib.compressobj(6, zlib.DEFLATED, 31)
            return deflate.compress("\n".join(lines).encode("utf-8", "surrogatepass")) + deflate.flush()

        def blocks() -> Iterator[bytes]:
            held: list[str] = []
            for batch in batches:
                for key, page, file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    held.append(f"{key}\t{'' if page is None else page}\t{file}\t{offset}\t{length}")
                    if len(held) == block_lines:
                        yield block(held)
                        held = []
            if held:
                yield block(held)

        yield from _chunks(blocks(), chunk)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = []
                for offset, length, raw in members(batch.column(1)[i].as_py()):
                    lines = raw.decode("utf-8", "surrogatepass").split("\n")
                    rows.append((batch.column(0)[i].as_py(), lines[0].split("\t")[0], lines[-1].split("\t")[0], offset, length, len(lines)))
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(list(zip(*rows, strict=True)) or [[]] * 6, _directory_types, strict=True)], names=_directory_names)

    _put(ordered.mapInArrow(run, "bytes binary"), f"{path}/blocks")
    schema = "file string, first_key string, last_key string, offset bigint, length bigint, lines bigint"
    _archives(found.sparkSession, f"{path}/blocks").mapInArrow(walk, schema).write.parquet(f"{path}/directory")


_directory_names = ["file", "first_key", "last_key", "offset", "length", "lines"]
_directory_types = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()]


def lookup(spark: SparkSession, path: str, keys: DataFrame, seek: bool = True) -> DataFrame:
    """Captures of the distinct URL keys in ``keys(key)``: ``(key, page_id, file, offset, length)``.

    The driver only sees the bounds of the index files.
    """
    directory = spark.read.parquet(f"{path}/directory")
    bounds = sorted(tuple(r) for r in directory.groupBy("file").agg(F.min("first_key").alias("a"), F.max("last_key").alias("z")).select("a", "z", "file").collect())
    firsts, lasts, files = ([b[i] for b in bounds] for i in range(3))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(files[i], k) for k in batch.column(0).to_pylist() for i in range(bisect_left(lasts, k), bisect_right(firsts, k))]
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in rows], pa.string()), pa.array([x for _, x in rows], pa.string())], names=["file", "key"])

    def blocks(wanted: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        entries = entries.sort_values("offset")
        first, last, at, size = (entries[c].tolist() for c in ("first_key", "last_key", "offset", "length"))
        out = [(f, at[i], size[i], k) for f, k in zip(wanted["file"], wanted["key"], strict=True) for i in range(bisect_left(last, k), bisect_right(first, k))]
        return pd.DataFrame(out, columns=["file", "offset", "length", "key"])

    def search(rows: Iterator[tuple], read: Callable) -> Iterator[tuple]:
        held, lines = None, []
        for file, offset, length, key in rows:
            if (file, offset) != held:
                held, lines = (file, offset), [x.split("\t") for x in zlib.decompress(read(file, offset, length), 31).decode("utf-8", "surrogatepass").split("\n")]
            at = bisect_left(lines, key, key=lambda x: x[0])
            while at < len(lines) and lines[at][0] == key:
                _, page, where, start, size = lines[at]
                yield key, int(page) if page else None, where, int(start), int(size)
                at += 1

    routed = keys.select("key").filter("key is not null").distinct().mapInArrow(route, "file string, key string")
    named = routed.groupBy("file").cogroup(directory.groupBy("file")).applyInPandas(blocks, "file string, offset bigint, length bigint, key string")
    return _by_ranges(spark, f"{path}/blocks", named, search, _CAPTURE, seek)


def fetch(spark: SparkSession, path: str, found: DataFrame, seek: bool = True) -> DataFrame:
    """Reads the byte ranges of ``found(file, offset, length)``: one row per record, its digest checked.

    ``(page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload)``; a revisit has no payload.
    """

    def records(rows: Iterator[tuple], read: Callable) -> Iterator[tuple]:
        for file, offset, length in rows:
            fields, body, size = parse(zlib.decompress(read(file, offset, length), 31))
            kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
            if kind == "response" and (payload_digest(body) != digest or len(body) != size):
                raise ValueError(f"a payload differs from its digest at {offset} of {file}")
            page, refers = (x[len("<urn:page:") : -1] for x in (fields["WARC-Record-ID"], fields.get("WARC-Refers-To", "<urn:page:>")))
            yield int(page) if page else None, fields["WARC-Target-URI"], size, digest, kind, int(refers) if refers else None, body if kind == "response" else None

    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    return _by_ranges(spark, path, found.select("file", "offset", "length"), records, schema, seek)


def keys_of(pages: DataFrame) -> DataFrame:
    """``(key)``, the index key of each row's url."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([_escaped(url_key(x)) for x in batch.column(0).to_pylist()], pa.string())], names=["key"])

    return pages.select("url").mapInArrow(run, "key string")


def archive(pages: DataFrame, min_revisit_bytes: int = 0, block_lines: int = 512) -> tuple[str, str]:
    """Writes archives and their index to the shared folder; returns both paths."""
    spark = pages.sparkSession
    where, index = scratch(spark, "warc"), scratch(spark, "warc-index")
    write(pages, where, min_revisit_bytes)
    build_index(captures(spark, where), index, block_lines)
    return where, index


def digest(pages: DataFrame, min_revisit_bytes: int = 0, block_lines: int = 512) -> DataFrame:
    """Archives all pages, then finds every one through the index and reads it back.

    Line breaks inside a URL are stored as spaces, so such a URL is looked up in that form. Empty tables give empty
    archives and no rows; columns other than page_id, url and html are ignored.
    """
    spark = pages.sparkSession
    where, index = archive(pages, min_revisit_bytes, block_lines)
    clean = pages.select(F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]+", " ").alias("url"))
    found = fetch(spark, where, lookup(spark, index, keys_of(clean)))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
