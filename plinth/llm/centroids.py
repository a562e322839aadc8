"""Centroid clustering (Lloyd's rounds on integer vectors) with annulus search.

By the triangle inequality a centroid at distance u or less from a vector has a norm within u of the vector's own. So
centroids are sorted by norm; the one nearest in norm gives each vector an upper bound u, two binary searches give the
run of centroids whose norms lie in the annulus [norm - u, norm + u], and only these are compared, exactly. The bound
starts from the two neighbours in norm, and the annulus is widened by more than the rounding error, so that centroids
at its very border, which can tie, are always among the compared.

A round is one pass: tasks send a sum per component and centroid, which Spark adds up; the driver gets
``clusters`` x ``dim`` sums, whatever the number of vectors. No row keeps a state between rounds, so a lost executor
costs its tasks of one pass and no more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.llm.common import saved

#: Components stay below this magnitude, so that a squared distance over ``MOST_DIM`` components fits 64 bits.
MOST_COMPONENT, MOST_DIM = 1 << 24, 1 << 12
_BATCH = 8192


def quantised(rows: DataFrame, dim: int = 64, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """``(id, v)``: vectors of exactly ``dim`` components, none null or not finite, each as floor(scale * component).

    Other rows are left out. A component of 2^24 or more after scaling is an error, not a wrong distance.
    """
    if not 0 < dim <= MOST_DIM:
        raise ValueError(f"dim must be from 1 to {MOST_DIM}")
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    part = F.transform("v", lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
    kept = rows.select(F.col(id_col).alias("id"), F.col(vec_col).alias("v")).filter((F.size("v") == dim) & F.forall("v", fine))
    bound = F.array_max(F.transform(part, F.abs)) >= MOST_COMPONENT
    return kept.select("id", F.when(bound, F.raise_error(F.lit("a component is too large for exact distances"))).otherwise(part).alias("v"))


def first_centroids(vectors: DataFrame, clusters: int, salt: str) -> np.ndarray:
    """Vectors of the smallest SHA-256 of ``salt:id``, in its order; ties (repeated ids) by components; null ids as empty."""
    key = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))).cast("binary"), 256)
    found = vectors.select(key.alias("key"), "v").orderBy("key", "v").limit(clusters).collect()
    return np.array([r["v"] for r in found], dtype=np.int64)


class Annulus:
    """Exact nearest centroids; ties go to the smaller number."""

    def __init__(self, centroids: np.ndarray) -> None:
        self.centroids, self.squares = centroids, (centroids * centroids).sum(axis=1)
        norms = np.sqrt(self.squares.astype(np.float64))
        self.order = np.argsort(norms, kind="stable")
        self.norms = norms[self.order]
        # doubles multiply faster and are exact while every sum stays below 2^53
        self.exact = centroids.shape[1] * float(np.abs(centroids).max(initial=1)) * MOST_COMPONENT < 2.0**52
        self.compared = 0

    def _distances(self, x: np.ndarray, squares: np.ndarray, number: int) -> np.ndarray:
        c = self.centroids[number]
        dots = (x.astype(np.float64) @ c.astype(np.float64)).astype(np.int64) if self.exact else x @ c
        self.compared += len(x)
        return squares - 2 * dots + self.squares[number]

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of each vector's nearest centroid and the squared distance."""
        squares = (x * x).sum(axis=1)
        norm = np.sqrt(squares.astype(np.float64))
        best = np.full(len(x), np.iinfo(np.int64).max)
        number = np.zeros(len(x), dtype=np.int64)
        at = np.searchsorted(self.norms, norm)
        probes = [np.clip(at - 1, 0, len(self.norms) - 1), np.clip(at, 0, len(self.norms) - 1)]
        for probe in probes:
            for place in np.unique(probe):
                self._offer(x, squares, best, number, np.flatnonzero(probe == place), int(self.order[place]))
        reach = np.sqrt(best.astype(np.float64))
        slack = 1e-9 * (norm + reach) + 1e-6
        low = np.searchsorted(self.norms, norm - reach - slack, side="left")
        high = np.searchsorted(self.norms, norm + reach + slack, side="right")
        for place in range(int(low.min(initial=len(self.norms))), int(high.max(initial=0))):
            inside = (low <= place) & (place < high) & (probes[0] != place) & (probes[1] != place)
            self._offer(x, squares, best, number, np.flatnonzero(inside), int(self.order[place]))
        return number, best

    def _offer(self, x: np.ndarray, squares: np.ndarray, best: np.ndarray, number: np.ndarray, rows: np.ndarray, centroid: int) -> None:
        """Compares one centroid with some of the vectors and keeps it where it is nearer, or as near and of smaller number."""
        if not len(rows):
            return
        found = self._distances(x[rows], squares[rows], centroid)
        better = (found < best[rows]) | ((found == best[rows]) & (centroid < number[rows]))
        rows = rows[better]
        best[rows], number[rows] = found[better], centroid


def _matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for start in range(0, batch.num_rows, _BATCH):
            part = batch.slice(start, _BATCH)
            yield part, part.column(part.num_columns - 1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _totals(vectors: DataFrame, centroids: np.ndarray) -> dict[int, tuple[int, int, list[int]]]:
    """Rows, summed distance and component sums of each cluster that has rows."""
    dim = centroids.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search, held = Annulus(centroids), {}
        for _, x in _matrices(batches, dim):
            number, distance = search.nearest(x)
            for c in np.unique(number):
                mine = number == c
                n, d, sums = held.get(int(c), (0, 0, np.zeros(dim, dtype=np.int64)))
                held[int(c)] = (n + int(mine.sum()), d + int(distance[mine].sum()), sums + x[mine].sum(axis=0))
        for c, (n, d, sums) in held.items():
            values = np.concatenate([[n, d], sums])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), c)), pa.array(np.arange(len(values))), pa.array(values)], names=["c", "i", "x"])

    parts = vectors.select("v").mapInArrow(run, "c bigint, i bigint, x bigint")
    out: dict[int, dict[int, int]] = {}
    for r in parts.groupBy("c", "i").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x")).collect():
        out.setdefault(r["c"], {})[r["i"]] = int(r["x"])
    return {c: (x[0], x[1], [x[i + 2] for i in range(dim)]) for c, x in out.items()}


def cluster(rows: DataFrame, clusters: int = 8, rounds: int = 10, salt: str = "3", dim: int = 64, scale: int = 1024, id_col: str = "vec_id", vec_col: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """Every kept vector with its cluster, and the final centroids.

    ``(id, cluster, distance, cluster_inertia, inertia)``: squared distance to the final centroid, and its sum over the
    cluster and over all. Each round assigns all vectors and moves every centroid that has some to the
    floor of their mean. Fewer vectors than ``clusters`` make as many centroids; a table without one gives no rows.
    Null and repeated ids are rows like any other. Other columns are not read.
    """
    vectors = saved(quantised(rows, dim, scale, id_col, vec_col), "vectors")
    kind = vectors.schema["id"].dataType.simpleString()
    centroids = first_centroids(vectors, clusters, salt)
    shape = f"id {kind}, cluster int, distance bigint, cluster_inertia bigint, inertia bigint"
    if not len(centroids):
        return rows.sparkSession.createDataFrame([], shape), np.zeros((0, dim), dtype=np.int64)
    for _ in range(rounds):
        moved = centroids.copy()
        for c, (n, _, sums) in _totals(vectors, centroids).items():
            moved[c] = [s // n for s in sums]
        if (moved == centroids).all():
            break  # every later round would be the same
        centroids = moved
    inertia = {c: d for c, (_, d, _) in _totals(vectors, centroids).items()}
    every = sum(inertia.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Annulus(centroids)
        for part, x in _matrices(batches, dim):
            number, distance = search.nearest(x)
            own = pa.array([inertia[int(c)] for c in number], pa.int64())
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(number, pa.int32()), pa.array(distance), own, pa.array([every] * len(x), pa.int64())], names=["id", "cluster", "distance", "cluster_inertia", "inertia"])

    return vectors.select("id", "v").mapInArrow(run, shape), centroids


def digest(rows: DataFrame, clusters: int = 8, rounds: int = 10, salt: str = "3") -> DataFrame:
    """The contract's columns: those of :func:`cluster` and the SHA-256 of the row's final centroid."""
    found, centroids = cluster(rows, clusters, rounds, salt)
    named = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    sha: Column = F.element_at(F.array(*map(F.lit, named)), F.col("cluster") + 1) if named else F.lit(None).cast("string")
    return found.select(F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", sha.alias("centroid_sha256"))


def oracle(clusters: int = 8, rounds: int = 10, salt: str = "3", dim: int = 64) -> str:
    """The same in DuckDB's SQL: one block of tables a round, components as rows."""
    nearest = "SELECT vec_id, rid, arg_min(c, (d, c)) AS c, min(d) AS d FROM (SELECT v.vec_id, v.rid, k.c, sum((v.x - k.x) * (v.x - k.x)) AS d FROM v JOIN {k} k USING (i) GROUP BY ALL) GROUP BY ALL"
    steps = [
        f"kept AS MATERIALIZED (SELECT vec_id, row_number() OVER () AS rid, list_transform(embedding, lambda x : CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x : x IS NOT NULL AND isfinite(x))) = {dim})",
        "v AS MATERIALIZED (SELECT vec_id, rid, unnest(e) AS x, unnest(range(len(e))) AS i FROM kept)",
        f"k0 AS MATERIALIZED (SELECT c, unnest(e) AS x, unnest(range(len(e))) AS i FROM (SELECT row_number() OVER (ORDER BY sha256('{salt}:' || coalesce(CAST(vec_id AS VARCHAR), '')), e) - 1 AS c, e FROM kept) WHERE c < {clusters})",
    ]
    for j in range(rounds):
        steps.append(f"a{j} AS MATERIALIZED ({nearest.format(k=f'k{j}')})")
        steps.append(f"m{j} AS MATERIALIZED (SELECT c, i, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM a{j} JOIN v USING (rid) GROUP BY ALL)")
        steps.append(f"k{j + 1} AS MATERIALIZED (SELECT k.c, k.i, CASE WHEN m.n IS NULL THEN k.x ELSE (m.s - (m.s % m.n + m.n) % m.n) // m.n END AS x FROM k{j} k LEFT JOIN m{j} m USING (c, i))")
    steps.append(f"a AS MATERIALIZED ({nearest.format(k=f'k{rounds}')})")
    steps.append(f"h AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS sha FROM k{rounds} GROUP BY c)")
    return f"WITH {', '.join(steps)} SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha AS centroid_sha256 FROM a JOIN h USING (c)"
