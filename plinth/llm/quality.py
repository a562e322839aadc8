"""Quality classifier: a Bradley-Terry model over text features, cut at a score quantile.

Training pairs set a good document against a bad one. The model says ``P(good beats bad) = sigmoid(w . (x_good -
x_bad))`` and is fitted by logistic loss on feature differences, so it has no intercept: pairs only fix scores up to a
shift. The shift comes from a quantile: the raw score below which the training documents' share of bad labels lies
becomes ``threshold`` on the probability scale.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.llm.common import forget, held_out, saved

FEATURES = (
    "log_words", "word_length", "upper", "letters", "symbols", "noise", "digits", "marks_per_word", "distinct", "distinct_root",
    "stammer", "longest_run", "top_word", "bigrams", "line_copies", "words_per_line", "wordless", "long_words",
)
_SPACE, _LETTER, _UPPER, _DIGIT, _MARK, _NOISE = range(6)
_classes: np.ndarray | None = None


def _class_table() -> np.ndarray:
    global _classes
    if _classes is None:
        table = np.full(65537, _NOISE, dtype=np.uint8)
        for i in range(65536):
            c = chr(i)
            table[i] = _SPACE if c.isspace() else _UPPER if c.isupper() else _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _MARK if c in ".,;:!?'\"()-" else _NOISE
        table[65536] = _LETTER
        _classes = table
    return _classes


def features(text: str | None) -> list[float]:
    """One value per name in FEATURES; null is the empty text. Reads the whole text, in pieces where it is long."""
    text = text or ""
    kinds, table = np.zeros(6, dtype=np.int64), _class_table()
    for at in range(0, len(text), 1 << 20):
        codes = np.frombuffer(text[at : at + (1 << 20)].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        kinds += np.bincount(table[np.minimum(codes, 65536)], minlength=6)
    words = text.split()
    n, chars, counts = len(words), max(len(text), 1), Counter(words)
    letters = kinds[_LETTER] + kinds[_UPPER]
    same = list(map(eq, words, islice(words, 1, None)))
    run = longest = 0
    if any(same):
        for x in same:
            run = run + 1 if x else 0
            longest = max(longest, run)
    lines = [x for x in text.split("\n") if x.strip()]
    m = max(n, 1)
    return [
        np.log1p(n), min(letters / m, 30.0), kinds[_UPPER] / max(letters, 1), letters / chars, kinds[_MARK] / chars,
        kinds[_NOISE] / chars, kinds[_DIGIT] / chars, min((kinds[_MARK] + kinds[_NOISE]) / m, 10.0), len(counts) / m, len(counts) / m**0.5 / 10,
        sum(same) / m, np.log1p(longest), max(counts.values(), default=0) / m, len(set(zip(words, islice(words, 1, None)))) / m,
        1 - len(set(lines)) / max(len(lines), 1), np.log1p(n / max(len(lines), 1)), sum(c for w, c in counts.items() if not any(map(str.isalpha, w))) / m,
        sum(c for w, c in counts.items() if len(w) > 20) / m,
    ]


@dataclass
class Ranking:
    """A fitted model. ``shift`` is the raw score that maps to ``threshold``."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    mean: np.ndarray = field(default_factory=lambda: np.zeros(len(FEATURES)))
    scale: np.ndarray = field(default_factory=lambda: np.ones(len(FEATURES)))
    shift: float = 0.0
    threshold: float = 0.3

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.raw(x) - self.shift + np.log(self.threshold / (1 - self.threshold))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def fit_pairs(x: np.ndarray, good: np.ndarray, weight: np.ndarray, pairs_per_row: int = 8, ridge: float = 1e-3, threshold: float = 0.3, seed: int = 42) -> Ranking:
    """Newton steps on the pairwise logistic loss; ``weight`` undoes unequal sampling when the quantile is taken.

    With one class only (or no rows) there is no pair: weights stay zero and every score is ``threshold``.
    """
    model = Ranking(threshold=threshold)
    a, b = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(a) or not len(b):
        return model
    model.mean, model.scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-9)
    rng = np.random.default_rng(seed)
    n = pairs_per_row * max(len(a), len(b))
    z = np.clip((x - model.mean) / model.scale, -8, 8)
    apart = z[rng.permutation(np.resize(a, n))] - z[rng.permutation(np.resize(b, n))]
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(apart @ w, -40, 40)))  # of the pair going the wrong way
        gradient = apart.T @ p / n - ridge * w
        curve = (apart * (p * (1 - p))[:, None]).T @ apart / n + ridge * np.eye(len(w))
        step = np.linalg.solve(curve, gradient)
        w += step
        if np.abs(step).max() < 1e-7:
            break
    model.weights = w
    raw = model.raw(x)
    order = np.argsort(raw, kind="stable")
    below = np.cumsum(weight[order]) / weight.sum()
    bad_share = weight[~good].sum() / weight.sum()
    k = int(np.searchsorted(below, bad_share))
    k = min(max(k, 0), len(raw) - 2) if len(raw) > 1 else 0
    model.shift = float(raw[order[k : k + 2]].mean())
    return model


def _features_of(rows: DataFrame, keep: str) -> DataFrame:
    """``keep`` columns of ``rows(text, ...)`` and the features of its text, in Arrow batches."""
    kept = [x.split()[0] for x in keep.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column("text")], dtype=float).reshape(batch.num_rows, len(FEATURES))
            arrays = [batch.column(k) for k in kept] + [pa.array(list(x), type=pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=[*kept, "x"])

    return rows.mapInArrow(run, f"{keep}, x array<double>")


#: Training rows of a block, of each class at least so many (by copies of the rarer one), and bins of a round of the quantile.
BLOCK_ROWS, LEAST_OF_CLASS, BINS = 8192, 64, 256


def _block_arrays(members: pa.ListScalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, class and whether it is no copy, of the rows of one block."""
    rows = members.values
    x = rows.field("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
    return x, rows.field("good").to_numpy(zero_copy_only=False).astype(bool), rows.field("copy").to_numpy() == 0


def _over_blocks(blocks: DataFrame, numbers) -> np.ndarray:
    """``numbers(block, x, good, first)`` of every block, one row a block in order of the blocks: sums do not depend on the tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [numbers(k.as_py(), *_block_arrays(m)).tolist() for k, m in zip(batch.column("block"), batch.column("members"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(found, type=pa.list_(pa.float64()))], names=["block", "v"])

    found = blocks.mapInArrow(run, "block bigint, v array<double>").collect()
    return np.array([r["v"] for r in sorted(found, key=lambda r: r["block"])], dtype=float)


def _blocks(rows: DataFrame, sizes: dict[bool, int], seed: int, block_rows: int) -> DataFrame:
    """``(block, members)``: all rows dealt to blocks by a seeded hash; where a class is rare, its rows are copied to several."""
    n = -(-sum(sizes.values()) // block_rows)
    copies = {k: min(n, -(-LEAST_OF_CLASS * n // size)) for k, size in sizes.items()}
    dealt = rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.when(F.col("good"), copies[True]).otherwise(copies[False]) - 1)))
    dealt = dealt.withColumn("block", F.pmod(F.pmod(F.xxhash64(F.lit(seed), "lid", "x"), F.lit(n)) + F.col("copy"), F.lit(n)).cast("bigint"))
    return dealt.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("lid", "x", "good", "copy"))).alias("members"))


def _nth(blocks: DataFrame, model: Ranking, k: int) -> float:
    """The ``k``-th smallest raw score of all rows (from 0), exactly: rounds of counting by bin narrow down to one value."""
    low, high = -np.inf, np.inf

    def ends(_, x, good, first):
        v = model.raw(x)[first]
        return np.array([v.min(), v.max()]) if len(v) else np.array([np.inf, -np.inf])

    def count(_, x, good, first):
        v = model.raw(x)[first]
        at = np.clip((v - low) / (high - low) * BINS, 0, BINS - 1).astype(int)
        at, v = at[(v >= low) & (v <= high)], v[(v >= low) & (v <= high)]
        least, most = np.full(BINS, np.inf), np.full(BINS, -np.inf)
        np.minimum.at(least, at, v)
        np.maximum.at(most, at, v)
        return np.concatenate([np.bincount(at, minlength=BINS), least, most])

    found = _over_blocks(blocks, ends)
    low, high = found[:, 0].min(), found[:, 1].max()
    while low < high:
        found = _over_blocks(blocks, count).reshape(-1, 3, BINS)
        upto = np.cumsum(found[:, 0].sum(axis=0))
        at = int(np.searchsorted(upto, k, side="right"))
        k -= int(upto[at - 1]) if at else 0
        low, high = found[:, 1, at].min(), found[:, 2, at].max()
    return float(low)


def fit_blocks(blocks: DataFrame, pairs_per_row: int = 8, ridge: float = 1e-3, threshold: float = 0.3, seed: int = 42) -> Ranking:
    """:func:`fit_pairs` over the blocks of all training rows: every row is in pairs, and in the quantile that sets ``shift``."""
    model, d = Ranking(threshold=threshold), len(FEATURES)
    sums = _over_blocks(blocks, lambda _, x, good, first: np.concatenate([[first.sum(), (first & ~good).sum()], x[first].sum(axis=0)])).sum(axis=0)
    n, bad = int(sums[0]), int(sums[1])
    model.mean = mean = sums[2:] / n
    model.scale = np.maximum(np.sqrt(_over_blocks(blocks, lambda _, x, good, first: ((x[first] - mean) ** 2).sum(axis=0)).sum(axis=0) / n), 1e-9)
    w = np.zeros(d)

    def slope(block, x, good, first):
        a, b = np.flatnonzero(good), np.flatnonzero(~good)
        if not len(a) or not len(b):
            return np.zeros(1 + d + d * d)
        rng, m = np.random.default_rng([seed, block]), pairs_per_row * max(len(a), len(b))
        z = np.clip((x - model.mean) / model.scale, -8, 8)
        apart = z[rng.permutation(np.resize(a, m))] - z[rng.permutation(np.resize(b, m))]
        p = 1 / (1 + np.exp(np.clip(apart @ w, -40, 40)))
        return np.concatenate([[m], apart.T @ p, ((apart * (p * (1 - p))[:, None]).T @ apart).ravel()])

    for _ in range(30):
        sums = _over_blocks(blocks, slope).sum(axis=0)
        gradient, curve = sums[1 : 1 + d] / sums[0] - ridge * w, sums[1 + d :].reshape(d, d) / sums[0] + ridge * np.eye(d)
        step = np.linalg.solve(curve, gradient)
        w = w + step
        if np.abs(step).max() < 1e-7:
            break
    model.weights = w
    k = max(min(bad - 1, n - 2), 0)
    model.shift = (_nth(blocks, model, k) + _nth(blocks, model, k + 1)) / 2
    return model


def fit(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, seed: int = 42, block_rows: int = BLOCK_ROWS) -> Ranking:
    """Learns from every labelled row that is not held out.

    Features are taken where the texts are and joined with the labels; blocks of about ``block_rows`` rows are stored, and each step of the
    fit sums over them, so that only sums reach the driver. Null labels are ignored; an id labelled twice counts as its mean label.
    """
    marked = labels.select(F.col("doc_id").alias("lid"), F.col("quality").cast("double").alias("q")).filter("lid is not null and q is not null")
    marked = marked.filter(~held_out(F.col("lid"))).groupBy("lid").agg((F.avg("q") >= 0.5).alias("good"))
    texts = docs.select(F.col("doc_id").alias("lid"), "text").filter(F.col("lid").isNotNull() & ~held_out(F.col("lid")))
    rows = saved(_features_of(texts, "lid bigint").join(marked, "lid"), "quality-rows")
    sizes = {r["good"]: r["n"] for r in rows.groupBy("good").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        forget(rows)
        return Ranking(threshold=threshold)
    blocks = saved(_blocks(rows, sizes, seed, block_rows), "quality-blocks")
    forget(rows)
    model = fit_blocks(blocks, threshold=threshold, seed=seed)
    forget(blocks)
    return model


def score(docs: DataFrame, model: Ranking, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, held_out, score, predicted)`` per row; null and empty texts are scored by their (zero) features.

    Only the text reaches the model. Repeated rows are scored each; a null id is never held out.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array([features(t.as_py()) for t in batch.column(1)], dtype=float).reshape(batch.num_rows, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(x), type=pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(run, f"id {kind}, score double")
    out = F.coalesce(held_out(F.col("id")), F.lit(False)).alias("held_out")
    return rows.select(F.col("id").alias(id_col), out, "score", (F.col("score") >= model.threshold).cast("int").alias("predicted"))
