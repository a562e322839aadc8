"""Language identification by rank-order n-gram profiles and out-of-place distance.

A language's profile is its most frequent character n-grams in order of frequency. A document's own most frequent
n-grams are compared with each profile: every n-gram costs the difference of its two ranks, one that the profile lacks
costs the profile length, and the nearest profile names the language.
"""

from __future__ import annotations

import re
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from plinth.llm.common import held_out, unit_hash

_WORDS = re.compile(r"[^\W\d_]+")  # of letters and of numerals that are no digits, such as ½
_LETTERS = regex.compile(r"\p{L}+")
_EDGE, _PIECE = ord("_"), 1 << 20


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if len(parts) == 1:
        return parts[0]
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, weights=np.concatenate([c for _, c in parts])).astype(np.int64)


def _letters(text: str) -> list[str]:
    """Runs of letters (Unicode category L)."""
    words = _WORDS.findall(text)
    return words if text.isascii() or all(map(str.isalpha, words)) else _LETTERS.findall(text)


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of the 1-, 2- and 3-grams of lower-cased words of letters, words padded by one mark each side.

    A key packs up to three code points. Whole texts are read, long ones in pieces of whole words.
    """
    words, parts, held, size = _letters((text or "").lower()), [], [], 0
    for i, w in enumerate(words):
        held.append(w)
        size += len(w) + 1
        if size < _PIECE and i + 1 < len(words):
            continue
        c = np.frombuffer(f"_{'_'.join(held)}_".encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
        two = (c[:-1] << 21) | c[1:]
        three = (two[:-1] << 21) | c[2:]
        inner = c[1:-1] != _EDGE
        keys, counts = np.unique(np.concatenate([c[c != _EDGE], two, three[inner]]), return_counts=True)
        parts.append((keys, counts))
        held, size = [], 0
    return _merge(parts) if parts else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def ranked(keys: np.ndarray, counts: np.ndarray, length: int) -> np.ndarray:
    """The ``length`` most frequent keys, ties by key."""
    return keys[np.lexsort((keys, -counts))[:length]]


class Profiles:
    """Rank tables of all learned languages over their joint vocabulary."""

    def __init__(self, tops: dict[str, list[int]], length: int) -> None:
        self.langs, self.length = sorted(tops), length
        self.vocabulary = np.array(sorted({k for ks in tops.values() for k in ks}), dtype=np.int64)
        self.ranks = np.full((len(self.vocabulary) + 1, len(self.langs)), -1, dtype=np.int64)
        for j, lang in enumerate(self.langs):
            self.ranks[np.searchsorted(self.vocabulary, np.array(tops[lang], dtype=np.int64)), j] = np.arange(len(tops[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        """The nearest language and a score: 1/2 if two languages are equally near, towards 1 the clearer the choice."""
        keys, counts = ngrams(text)
        if not len(keys) or not self.langs:
            return "und", 0.0
        top = ranked(keys, counts, self.length)
        at = np.searchsorted(self.vocabulary, top)
        known = at < len(self.vocabulary)
        known[known] = self.vocabulary[at[known]] == top[known]
        rank = self.ranks[np.where(known, at, len(self.vocabulary))]
        apart = np.where(rank < 0, self.length, np.abs(rank - np.arange(len(top))[:, None])).sum(axis=0)
        order = np.argsort(apart, kind="stable")
        near = float(apart[order[0]])
        far = float(apart[order[1]]) if len(order) > 1 else float(self.length * len(top))
        return self.langs[order[0]], 1 - near / (near + far) if near + far else 0.5


def fit(docs: DataFrame, max_per_lang: int = 4000, length: int = 300, seed: int = 42) -> Profiles:
    """Profiles from documents with a language that are not held out.

    About ``max_per_lang`` documents of each language are used at most, chosen by a seeded hash of the id. Partial
    counts are combined in each task before the shuffle; only ``length`` n-grams a language reach the driver.
    """
    rows = docs.select("doc_id", "lang", "text").filter("doc_id is not null and lang is not null").filter(~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not sizes:
        return Profiles({}, length)
    rates = F.create_map(*[F.lit(x) for k, n in sorted(sizes.items()) for x in (k, min(1.0, max_per_lang / n))])
    chosen = rows.filter(unit_hash(F.col("doc_id"), seed=seed) < rates[F.col("lang")]).select("lang", "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[str, list] = {}
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                held = parts.setdefault(lang, [])
                held.append(ngrams(text.as_py()))
                if len(held) > 200:
                    parts[lang] = [_merge(held)]
        for lang, held in parts.items():
            keys, counts = _merge(held)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys), pa.array(counts.astype(np.int64))], names=["lang", "gram", "n"])

    grams = chosen.mapInArrow(count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    # the most frequent of each of 64 parts first, so that no task sees all n-grams of a language
    order = [F.desc("n"), F.asc("gram")]
    parts = grams.withColumn("part", F.pmod(F.xxhash64("gram"), F.lit(64)))
    parts = parts.withColumn("r", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("r") <= length)
    top = parts.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).filter(F.col("r") <= length)
    tops: dict[str, list[int]] = {}
    for r in sorted(top.select("lang", "r", "gram").collect()):
        tops.setdefault(r["lang"], []).append(r["gram"])
    return Profiles(tops, length)


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, lang_pred, score)`` per row.

    ``und`` with score 0 where the text is null or has no letter (or no language was learned). Repeated rows are
    judged each; a null id is never held out; columns other than id and text are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(x.as_py()) for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x for x, _ in found], pa.string()), pa.array([x for _, x in found], pa.float64())], names=["id", "lang_pred", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, lang_pred string, score double")
    return rows.select(F.col("id").alias(id_col), F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out"), "lang_pred", "score")


def recognised(docs: DataFrame, profiles: Profiles, langs: Collection[str] | None = None, least_score: float = 0.0, text_col: str = "text", lang_col: str | None = None) -> DataFrame:
    """``docs`` whose language is told with ``least_score`` or more and is one of ``langs`` (default: any but ``und``).

    Rows keep all columns and are not moved; ``lang_col``, if given, is replaced by the prediction.
    """
    at = docs.columns.index(text_col)
    put = None if lang_col is None else docs.columns.index(lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [profiles.predict(x.as_py()) for x in batch.column(at)]
            keep = pa.array([lang != "und" and score >= least_score and (langs is None or lang in langs) for lang, score in found], pa.bool_())
            if put is not None:
                batch = batch.set_column(put, batch.schema.field(put), pa.array([lang for lang, _ in found], batch.schema.field(put).type))
            yield batch.filter(keep)

    return docs.mapInArrow(run, docs.schema)
