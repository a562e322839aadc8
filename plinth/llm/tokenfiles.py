"""Token ids in binary files: one zstandard frame a document, all with one shared dictionary, found by an offset index.

Short documents compress badly one by one, as each frame starts without knowledge. A dictionary trained on the
serialized ids of sampled documents gives every frame that knowledge, so that a document can be read alone at the price of a
document.

Files are plain zstandard streams. Everything that is no document is a skippable frame, which every reader passes over:

* at the start of each chunk of about a megabyte, ``PLTK``, version, bytes of an id, SHA-256 of the dictionary;
* before each document's frame its id, whether it has one, number of ids and length of the frame;
* at the end of a chunk one zero byte.

Documents are in ascending order of id, in the files and from file to file. ``index`` has each document's place and
the dictionary's hash; ``dictionary`` the dictionary. Spark's text writer puts files down, as for the archives of
:mod:`plinth.llm.warc`, so any file system that Spark writes will do, and a task that is run twice leaves one file.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from plinth.llm.common import saved, scratch
from plinth.llm.warc import CHUNK_BYTES, FILE_CHUNKS, _archives, _by_ranges, _put

_PIECE = 1 << 20
#: Fixed values of the format: skippable frames of chunks, documents and padding.
_CHUNK, _DOCUMENT, _PAD = 0x184D2A50, 0x184D2A51, 0x184D2A52
_HEAD, _DOC = "<II", "<qBQQ"
#: Characters that the steps before the vocabulary model change in nothing but case: visible ASCII but the apostrophe, which
#: can join letters, and the letters of Latin-1; white space. Parts of text of these: letters, a digit, or marks.
_ODD = re.compile(r"[^\t-\r -&(-~À-ÖØ-öø-ÿ]").search
_PARTS = re.compile(r"[a-zß-öø-ÿ]+|[0-9]|[!-/:-@\[-`{-~]+").findall
_WORDS = re.compile(r"[^\t-\r ]+").findall


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class _Known(dict):
    """Serialized ids by part, asked for once; all are forgotten when there are ``most``, so that memory is bounded."""

    def __init__(self, ask: Callable[[str], bytes], most: int) -> None:
        self.ask, self.most = ask, most

    def __missing__(self, part: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        ids = self[part] = self.ask(part)
        return ids


class Encoder:
    """Serialized ids of texts; strings that look like special tokens are text like any other.

    A tokenizer that drops white space gives a text the ids of its words, one after another. Of such a tokenizer only
    the vocabulary model is asked for the parts of plain words, as its other steps change nothing but case in them, and
    only once for each of ``most`` remembered parts; for other words all its steps are. Any other tokenizer is asked for whole texts.
    """

    def __init__(self, spec: str, end: int | None, most: int = 300_000) -> None:
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.encode_special_tokens = True
        size = max(self.tokenizer.get_vocab_size(with_added_tokens=True), (end or 0) + 1)
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.end = b"" if end is None else self._ids([end])
        self.by_word, letters = _drops_space(json.loads(spec)), _byte_letters()
        model = self.tokenizer.model
        shown = lambda part: part if part.isascii() else part.encode().decode("latin-1").translate(letters)
        self.parts = _Known(lambda part: self._ids([t.id for t in model.tokenize(shown(part))]), most)
        self.words = _Known(self.whole, most // 10)

    def _ids(self, ids: list[int]) -> bytes:
        return array(self.code, ids).tobytes()

    def whole(self, text: str) -> bytes:
        return self._ids(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def __call__(self, text: str) -> bytes:
        """Ids of the whole text, with the end id."""
        if not self.by_word:
            return self.whole(text) + self.end
        out, part = [], self.parts.__getitem__
        for piece in _pieces(text):
            if _ODD(piece) is None:
                out += map(part, _PARTS(piece.lower()))
                continue
            for word in _WORDS(piece):
                if _ODD(word) is None:
                    out += map(part, _PARTS(word.lower()))
                else:
                    out.append(self.words[word])
        out.append(self.end)
        return b"".join(out)


def _pieces(text: str) -> Iterator[str]:
    """A text in pieces of about a megabyte that end before ASCII white space."""
    start, gap = 0, re.compile(r"[\t-\r ]")
    while len(text) - start > _PIECE:
        found = gap.search(text, start + _PIECE)
        if found is None:
            break
        yield text[start : found.start()]
        start = found.start()
    yield text[start:] if start else text


def _drops_space(spec: dict) -> bool:
    """Whether the tokenizer's steps are those that :class:`Encoder` takes words by."""
    norm, split = spec.get("normalizer") or {}, spec.get("pre_tokenizer") or {}
    steps = [x.get("type") for x in norm.get("normalizers", [])]
    cuts = split.get("pretokenizers", [])
    if steps != ["NFC", "Replace", "Lowercase"] or [x.get("type") for x in cuts] != ["Split", "ByteLevel"] or spec.get("post_processor"):
        return False
    #: The pattern of parts, and what white space becomes.
    parts = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    plain = not cuts[1].get("add_prefix_space") and not cuts[1].get("use_regex")
    return plain and norm["normalizers"][1].get("pattern") == {"Regex": r"\s+"} and norm["normalizers"][1].get("content") == " " and cuts[0].get("pattern") == {"Regex": parts} and cuts[0].get("behavior") == "Removed" and bool(cuts[0].get("invert"))


_encoders: dict[tuple, Encoder] = {}


def _encoder(spec: str, end: int | None) -> Encoder:
    """The worker's own encoder, kept from task to task."""
    key = (hashlib.sha256(spec.encode()).digest(), end)
    if key not in _encoders:
        _encoders.clear()
        _encoders[key] = Encoder(spec, end)
    return _encoders[key]


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def train_dictionary(docs: DataFrame, spec, end: int | None, sample_docs: int = 2000, most_bytes: int = 16_384, size: int = 65_536, text_col: str = "text") -> bytes:
    """A dictionary from about ``sample_docs`` rows drawn at random, of texts of at most ``most_bytes`` bytes.

    The driver gets their ids, ``sample_docs`` times ``most_bytes`` bytes at most or so. Where the sample is too small to train
    on, it is the dictionary itself; without any row the dictionary is empty.
    """
    total = docs.count()
    if not total:
        return b""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(spec.value, end)
        for batch in _slices(batches):
            yield pa.RecordBatch.from_arrays([pa.array(map(encoder, batch.column(0).to_pylist()), pa.binary())], names=["ids"])

    drawn = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).sample(False, min(1.0, sample_docs / total), 42).filter(F.octet_length("text") <= most_bytes)
    samples = sorted(r["ids"] for r in drawn.mapInArrow(run, "ids binary").collect())
    samples = [bytes(x) for x in samples if x]
    try:
        return zstandard.train_dictionary(size, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _dictionary(data: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(data) if len(data) >= 8 else None


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack(_HEAD, magic, len(content)) + content


def write(docs: DataFrame, path: str, spec: str, end: int | None = None, level: int = 3, id_col: str = "doc_id", text_col: str = "text", **training) -> None:
    """Writes the ids of all ``docs`` below ``path``: ``ids``, ``index`` and ``dictionary``.

    ``spec`` is the content of a tokenizer's file, which is sent to the tasks. Ids are cast to bigint; null ids come first, rows of one id
    follow each other in a fixed order of their token ids. A null text is an empty one.
    """
    spark = docs.sparkSession
    told = spark.sparkContext.broadcast(spec)
    trained = train_dictionary(docs, told, end, text_col=text_col, **training)
    width = Encoder(spec, end).kind.itemsize

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, zip_ = _encoder(told.value, end), zstandard.ZstdCompressor(level=level, dict_data=_dictionary(trained))
        for batch in _slices(batches):
            n, tie, frames = [], [], []
            for ids in map(encoder, batch.column(1).to_pylist()):
                n.append(len(ids) // width)
                tie.append(int.from_bytes(hashlib.blake2b(ids, digest_size=8).digest(), "little", signed=True))
                frames.append(zip_.compress(ids))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(tie, pa.int64()), pa.array(frames, pa.binary())], names=["id", "n", "tie", "frame"])

    frames = saved(_texts(docs, id_col, text_col).mapInArrow(encode, "id bigint, n bigint, tie bigint, frame binary").withColumn("size", F.octet_length("frame")), "frames")
    head = _skippable(_CHUNK, b"PLTK\x01" + bytes([width]) + hashlib.sha256(trained).digest())
    tail, least = _skippable(_PAD, b"\x00")[:-1], CHUNK_BYTES

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [head], 0
        row = lambda: pa.RecordBatch.from_arrays([pa.array([b"".join([*held, tail])], pa.binary())], names=["bytes"])
        for batch in batches:
            for i, n, frame in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                held.append(_skippable(_DOCUMENT, struct.pack(_DOC, i or 0, i is not None, n, len(frame))) + frame)
                size += len(held[-1])
                if size >= least:
                    yield row()
                    held, size = [head], 0
        if size:
            yield row()

    total = frames.agg(F.sum("size")).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (CHUNK_BYTES * FILE_CHUNKS) + 1)
    keys = [F.col("id").asc_nulls_first(), "tie"]
    dealt = frames.withColumn("salt", F.rand(42)).repartitionByRange(parts, *keys, "salt").sortWithinPartitions(*keys)
    _put(dealt.select("id", "n", "frame").mapInArrow(chunks, "bytes binary"), f"{path}/ids")
    spark.createDataFrame([(hashlib.sha256(trained).hexdigest(), bytearray(trained))], "hash string, dictionary binary").coalesce(1).write.parquet(f"{path}/dictionary")
    _index(spark, path).write.parquet(f"{path}/index")


def walk(content: bytes) -> Iterator[tuple[int | None, int, int, int, str]]:
    """Document id, number of ids, offset and length (head and frame), and the dictionary's hash, of each document of a file."""
    at, using = 0, ""
    while at < len(content):
        magic, size = struct.unpack_from(_HEAD, content, at)
        body = at + struct.calcsize(_HEAD)
        if magic == _CHUNK:
            if content[body : body + 5] != b"PLTK\x01":
                raise ValueError("no file of token ids")
            using = content[body + 6 : body + 38].hex()
        if magic == _DOCUMENT:
            i, has, n, length = struct.unpack_from(_DOC, content, body)
            yield i if has else None, n, at, struct.calcsize(_HEAD) + size + length, using
            at += length
        elif magic not in (_CHUNK, _PAD):
            raise ValueError(f"an unknown frame at {at}")
        at += struct.calcsize(_HEAD) + size


def _index(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens, file, offset, length, dictionary)`` of every document, from the files."""
    shape = "file string, doc_id bigint, n_tokens bigint, offset bigint, length bigint, dictionary string, before bigint"
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
    names = [x.split()[0] for x in shape.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                file, before, rows = batch.column(0)[i].as_py(), 0, []
                for doc_id, n, offset, length, using in walk(batch.column(1)[i].as_py()):
                    rows.append((file, doc_id, n, offset, length, using, before))
                    before += n
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows, strict=True)) or [[]] * 7, kinds, strict=True)], names=names)

    found = saved(_archives(spark, f"{path}/ids").mapInArrow(run, shape), "token-index")
    # file names count partitions and the files of each; one row a file of 64 MB
    place = [F.regexp_extract("file", r"part-(\d+)-.*-c(\d+)", i).cast("bigint") for i in (1, 2)]
    files = found.groupBy("file").agg(F.sum("n_tokens").alias("n"))
    earlier = Window.orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    return found.join(files, "file").select("doc_id", (F.col("first") + F.col("before")).alias("start"), "n_tokens", "file", "offset", "length", "dictionary")


def _read(spark: SparkSession, path: str, wanted: DataFrame | None, use: Callable[[np.ndarray], object], kind: str, seek: bool) -> DataFrame:
    """``(doc_id, start, n_tokens, value)``: ``use`` of the ids of each document of the index that has an id in ``wanted``."""
    stored = spark.read.parquet(f"{path}/dictionary").first()
    trained = bytes(stored["dictionary"])
    if hashlib.sha256(trained).hexdigest() != stored["hash"]:
        raise ValueError("the dictionary differs from its hash")

    def decode(rows: Iterator[tuple], read: Callable) -> Iterator[tuple]:
        unzip = zstandard.ZstdDecompressor(dict_data=_dictionary(trained))
        for file, offset, length, using, doc_id, start, n in rows:
            if using != stored["hash"]:
                raise ValueError(f"a document of {file} needs another dictionary")
            data = read(file, offset, length)
            (i, count, _, whole, _), skip = next(walk(data)), struct.calcsize(_HEAD) + struct.calcsize(_DOC)
            if (i, count, whole) != (doc_id, n, length):
                raise ValueError(f"the index does not fit {file} at {offset}")
            ids = unzip.decompress(data[skip:])
            yield doc_id, start, n, use(np.frombuffer(ids, f"<u{len(ids) // n}") if n else np.zeros(0, "<u4"))

    index = spark.read.parquet(f"{path}/index")
    if wanted is not None:
        index = index.join(wanted.select(F.col("doc_id").cast("bigint")).distinct(), "doc_id", "left_semi")
    rows = index.select("file", "offset", "length", "dictionary", "doc_id", "start", "n_tokens")
    return _by_ranges(spark, f"{path}/ids", rows, decode, f"doc_id bigint, start bigint, n_tokens bigint, value {kind}", seek)


def read(spark: SparkSession, path: str, wanted: DataFrame | None = None, seek: bool = True) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)`` of all documents, or of those with an id in ``wanted(doc_id)``, each read by its range."""
    return _read(spark, path, wanted, lambda ids: ids.tolist(), "array<bigint>", seek).withColumnRenamed("value", "ids")


def digest(docs: DataFrame, tokenizer: str, end: int = 1, seek: bool = True) -> DataFrame:
    """Writes the ids of all documents with the tokenizer of that file, reads the files back, and returns the contract's columns.

    An empty table gives empty files and no rows; columns other than doc_id and text are not read.
    """
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    with open(tokenizer, encoding="utf-8") as file:
        write(docs, path, file.read(), end)
    found = _read(spark, path, None, lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), "bigint", seek)
    return found.withColumnRenamed("value", "ids_crc32")
