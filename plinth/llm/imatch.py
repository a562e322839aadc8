"""I-Match fingerprints over randomised lexicon subsets.

The lexicon keeps terms whose inverse document frequency lies in a band: common words say nothing, very rare ones are
noise. For each of several subsets of the lexicon, a text's distinct terms in the subset are sorted and hashed; two
texts agree on a subset if they hold the same of its terms. Subsets thin out with the text's own number of terms, so
that each holds about ``terms_per_subset`` of them whatever the length: the share of agreeing subsets then falls
exponentially with the share of changed terms, and its logarithm gives the likeness.

Size: document frequencies are combined in each task before the shuffle. The lexicon that goes to all executors has a
proven bound, whatever the number of texts: terms that are in a share s of the texts or more number at most (mean
distinct terms of a text) / s.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from plinth.llm.rolling import run_hashes

_GAP, _PIECE, _BASE = re.compile(r"[\W_]"), 1 << 20, 0xD6E8FEB86659FD93
_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


_alnum: np.ndarray | None = None


def terms(text: str) -> np.ndarray:
    """Sorted hashes of the distinct lower-cased terms of letters and digits, over the whole text.

    Texts are taken apart as arrays of code points, long ones in pieces that end between terms.
    """
    global _alnum
    if _alnum is None:
        _alnum = np.fromiter(map(str.isalnum, map(chr, range(0x110000))), dtype=bool, count=0x110000)
    text, parts, at = text.lower(), [], 0
    while at < len(text):
        gap = _GAP.search(text, at + _PIECE)
        end = gap.start() if gap else len(text)
        codes = np.frombuffer(text[at:end].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        inside = np.zeros(len(codes) + 2, dtype=bool)
        inside[1:-1] = _alnum[codes]
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        parts.append(run_hashes(codes.astype(np.uint64) + np.uint64(1), _BASE)(edges[0::2], edges[1::2]) + (edges[1::2] - edges[0::2]).astype(np.uint64))
        at = end
    return _distinct(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


def _distinct(h: np.ndarray) -> np.ndarray:
    h = np.sort(h)
    new = np.ones(len(h), dtype=bool)
    new[1:] = h[1:] != h[:-1]
    return h[new]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@lru_cache(maxsize=4096)
def _limits(n: int, per_subset: float, subsets: int) -> np.ndarray:
    """The largest dice that keep a term, by subset: one in 2**level of ``n`` terms is kept."""
    level = np.floor(np.log2(n / per_subset) + (np.arange(subsets) + 0.5) / subsets)
    return ((np.uint64(1) << (32 - np.maximum(level, 0)).astype(np.uint64)) - np.uint64(1)).astype(np.uint32)[:, None]


@dataclass
class Lexicon:
    """Sorted term hashes and the parameters of the subsets, whose number is even."""

    terms: np.ndarray
    subsets: int = 32
    terms_per_subset: float = 2.0
    seed: int = 42
    #: Where terms of each value of their top 20 bits begin, and the most terms that share one.
    starts: np.ndarray | None = field(default=None, repr=False)
    longest: int = 0

    def own(self, h: np.ndarray) -> np.ndarray:
        """Those of sorted hashes that are in the lexicon."""
        if self.starts is None:
            self.starts = np.searchsorted(self.terms, np.arange(1 << 20, dtype=np.uint64) << np.uint64(44)).astype(np.int32)
            self.longest = int(np.diff(self.starts, append=len(self.terms)).max())
        at, found = self.starts[(h >> np.uint64(44)).astype(np.int64)], np.zeros(len(h), dtype=bool)
        for i in range(self.longest):
            found |= self.terms.take(at + i, mode="clip") == h
        return h[found]

    def fingerprint(self, text: str) -> str:
        """Eight hex digits per subset, zeros where it has none of the text's terms; ``t`` and a hash of the whole
        text where the lexicon has none at all."""
        own = self.own(terms(text)) if len(self.terms) else self.terms
        if not len(own):
            return f"t{xxhash.xxh64_hexdigest(text.encode('utf-8', 'surrogatepass'))}"
        # each mixed hash gives two subsets a 32-bit number; a level of 32 is beyond any text
        keys = np.arange(1, self.subsets // 2 + 1, dtype=np.uint64) * _GOLDEN + np.uint64(self.seed)
        dice = _mixed(own[None, :] ^ _mixed(keys)[:, None]).view(np.uint32).reshape(len(keys), len(own), 2).transpose(0, 2, 1).reshape(self.subsets, len(own))
        subset, term = np.nonzero(dice <= _limits(len(own), self.terms_per_subset, self.subsets))
        chosen = own[term].tobytes()  # subset by subset, terms in order
        ends = (8 * np.searchsorted(subset, np.arange(1, self.subsets + 1))).tolist()
        return "".join([f"{xxhash.xxh32_intdigest(chosen[a:z], self.seed) or 1:08x}" if z > a else "00000000" for a, z in zip([0, *ends], ends, strict=False)])

    def likeness(self, a: str, b: str) -> float:
        """1 for equal fingerprints, 0 where hardly a subset agrees; between, the estimated share of common terms."""
        if a == b:
            return 1.0
        if a[0] == "t" or b[0] == "t":
            return 0.0
        x, y = (np.frombuffer(v.encode(), dtype="S8") for v in (a, b))
        told, alike = int(((x != b"00000000") | (y != b"00000000")).sum()), int(((x == y) & (x != b"00000000")).sum())
        return float(min(1.0, max(0.0, 1 + np.log(alike / told) / (2 * self.terms_per_subset)))) if alike else 0.0


def fit(docs: DataFrame, least_share: float = 1 / 2000, most_share: float = 0.2, text_col: str = "text", subsets: int = 32, terms_per_subset: float = 2.0, seed: int = 42) -> Lexicon:
    """The lexicon of ``docs``: terms in a share of the texts between both bounds, counted over all texts.

    Where no term is rare enough for the upper bound (a few texts, or all alike) the lexicon is empty or small and
    fingerprints fall back to whole texts.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held, size, rows = np.zeros(0, np.uint64), np.zeros(0, np.int64), [], 0, 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            all_keys = np.concatenate([keys, *held])
            weights = np.concatenate([counts, np.ones(len(all_keys) - len(keys), np.int64)])
            order = np.argsort(all_keys, kind="stable")
            all_keys, weights = all_keys[order], weights[order]
            starts = np.flatnonzero(np.concatenate([[True], all_keys[1:] != all_keys[:-1]])) if len(all_keys) else np.zeros(0, int)
            return all_keys[starts], np.add.reduceat(weights, starts) if len(starts) else weights

        def batch_of(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["term", "n"])

        for batch in batches:
            for text in batch.column(0):
                held.append(terms(text.as_py() or ""))
                size += len(held[-1])
                rows += 1
                if size > 2_000_000:
                    (keys, counts), held, size = merged(), [], 0
                    if len(keys) > 4_000_000:  # a task's vocabulary is passed on in parts, the shuffle adds them up
                        yield batch_of(keys, counts)
                        keys, counts = keys[:0], counts[:0]
        yield batch_of(*merged())

    df = docs.select(text_col).mapInArrow(count, "term bigint, n bigint").groupBy("term").agg(F.sum("n").alias("n"))
    n = docs.count()
    # document frequencies of all terms stay distributed; only the band comes to the driver
    band = df.filter((F.col("n") >= max(1.0, least_share * n)) & (F.col("n") <= most_share * n)).select("term").toPandas()["term"].to_numpy(dtype=np.int64)
    return Lexicon(np.sort(band.view(np.uint64)), subsets, terms_per_subset, seed)


def _bounds(ids: DataFrame, n: int) -> list:
    """About ``n`` - 1 bounds that cut non-null ``ids(id)`` of any ordered type into ranges of similar size.

    They come from the ids with the smallest hashes, at most about 200 a range; where they fall changes no result.
    """
    total = ids.filter("id is not null").count()
    least = F.xxhash64("id").cast("double") / 2.0**64 + 0.5
    chosen = ids.filter("id is not null").filter(least < min(1.0, 100 * n / max(total, 1))).distinct()
    places = chosen.select("id", F.row_number().over(Window.orderBy("id")).alias("k"))
    count = chosen.count()
    step = max(1, count // n)
    return [r["id"] for r in places.filter((F.col("k") % step == 0) & (F.col("k") < count)).orderBy("k").select("id").collect()]


def with_next(docs: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, str]:
    """Rows ``(bucket, extra, id, text)`` dealt so that each bucket holds a range of ids in order and, last and marked
    ``extra``, the first row of the next range (of the first range after the last). Null ids form a range of their own
    before all others.

    Only range bounds and one id a range reach the driver. Each range is one partition.
    """
    spark = docs.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1)
    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bounds = _bounds(rows.select("id"), n)
    after = F.lit(1)
    if bounds and isinstance(docs.schema[id_col].dataType, NumericType):
        cuts = np.array([float(x) for x in bounds])

        @F.pandas_udf("int")
        def place(x: pd.Series) -> pd.Series:
            return pd.Series(1 + np.searchsorted(cuts, x.to_numpy(dtype=float, na_value=-np.inf), side="left").astype(np.int32))

        after = place(F.coalesce(F.col("id").cast("double"), F.lit(float("-inf"))))
    elif bounds:
        after = 1 + F.size(F.filter(F.array(*[F.lit(x).cast(kind) for x in bounds]), lambda x: x < F.col("id")))
    rows = rows.withColumn("bucket", F.when(F.col("id").isNull(), 0).otherwise(after))
    firsts = sorted((r["bucket"], r["first"]) for r in rows.select("bucket", "id").groupBy("bucket").agg(F.min("id").alias("first")).collect())
    ends = spark.createDataFrame([((first,), firsts[i - 1][0]) for i, (_, first) in enumerate(firsts)], f"first struct<id: {kind}>, target int")
    rows = rows.join(F.broadcast(ends), F.struct("id") == F.col("first"), "left")
    own, more = F.struct(F.col("bucket").alias("bucket"), F.lit(0).alias("extra")), F.struct(F.col("target").alias("bucket"), F.lit(1).alias("extra"))
    rows = rows.select("id", "text", F.explode(F.when(F.col("target").isNull(), F.array(own)).otherwise(F.array(own, more))).alias("to"))
    rows = rows.select("to.bucket", "to.extra", "id", "text")
    return rows.repartitionById(len(bounds) + 2, F.col("bucket")).sortWithinPartitions("bucket", "extra", "id", F.xxhash64("text")), kind


def fingerprints(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` per row.

    A row's edited text has its last quarter replaced by the head of the next row's text, ascending by id (null first;
    rows that share an id are ordered by a hash of their text; the first row follows the last). Ids may be of any
    ordered type. Null texts are empty. A single row is followed by itself. Memory is that of an Arrow batch.
    """
    rows, kind = with_next(docs, id_col, text_col)
    names = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before: tuple | None = None
        for batch in batches:
            out: list[tuple] = []
            for bucket, extra, key, value in zip(*batch.columns, strict=True):
                bucket, extra, text = bucket.as_py(), extra.as_py(), value.as_py()
                now = (bucket, extra, key, text, lexicon.fingerprint(text))
                if before and before[0] == bucket and not before[1]:
                    _, _, id_, old, own = before
                    cut = len(old) // 4
                    edited = old[: len(old) - cut] + text[:cut]
                    other = lexicon.fingerprint(edited)
                    sha = hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest()
                    out.append((id_, len(old), sha, own, other, lexicon.likeness(own, other), lexicon.likeness(own, now[4])))
                before = now
            if out:
                columns = list(zip(*out, strict=True))
                arrays = [pa.array([x.as_py() for x in columns[0]], batch.column(2).type)] + [pa.array(c, t) for c, t in zip(columns[1:], types, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    schema = f"id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
