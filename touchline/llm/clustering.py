"""Centroid clustering of vectors of integers, by equal-average equal-variance search.

Centroids are sorted by component mean.  A vector starts at the centroid whose mean is next to
its own and scans outward, always to the side that is nearer in mean.  With d components, sums S
and W = sqrt(d * sum(x^2) - S^2), the squared distance D of two vectors obeys

    d * D >= (S1 - S2)^2                      (means: ends the scan, as what follows is farther)
    d * D >= (S1 - S2)^2 + (W1 - W2)^2        (means and deviations: skips one centroid)

so centroids that cannot win are never measured; those left are measured in exact integers.
The vectors of an Arrow batch take their steps together, each at its own place in the order.

What goes to the driver is bounded by parameters: k centroids of d components a round.

Edge cases: rows are kept if they have exactly ``dims`` components, none of them null, NaN,
infinite or beyond +-``LIMIT`` after scaling (beyond it sums of squares leave 64 bits); others are
dropped.  Repeated rows all count and each is returned; a null id counts as empty text in the
hash order, and rows with equal ids start in the order of their components.  Fewer kept rows than
``k`` give as many centroids as rows; an empty table gives no rows.  Only the id and the vector are
read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from touchline.llm.common import as_table, importable

LIMIT = 1 << 24  # largest scaled component: all squares and products below stay within 64 bits
_SLACK = 1e-9  # deviations are floats: a centroid is skipped only if it is farther by more than this
_FAR = np.int64(1 << 31)  # no centroid on this side; more than any difference of sums


def integer_vectors(rows: DataFrame, key: str, column: str, dims: int, scale: int) -> DataFrame:
    """``key, v`` of the rows kept, ``v`` being floor(scale * x) of every component."""
    vector = F.col(column)

    def scaled(x: Column) -> Column:
        return F.lit(float(scale)) * x.cast("double")

    unfit = F.exists(vector, lambda x: x.isNull() | (F.abs(scaled(x)) >= F.lit(float(LIMIT))))
    kept = rows.where((F.size(vector) == dims) & ~unfit)
    return kept.select(F.col(key).alias("key"), F.transform(vector, lambda x: F.floor(scaled(x)).cast("int")).alias("v"))


def first_by_hash(vectors: DataFrame, k: int, seed: int) -> np.ndarray:
    """The ``k`` vectors whose ``seed:key`` has the least SHA-256, in that order.

    Only keys below a bound on the hash, which few rows meet, are sorted; the bound is raised
    until there are enough.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("key").cast("string"), F.lit(""))).cast("binary"), 256)
    hashed = vectors.select(digest.alias("digest"), "v")
    n = max(1, vectors.count())
    share = (k + 10 * math.sqrt(k) + 10) / n
    while True:
        few = hashed if share >= 1 else hashed.where(F.substring("digest", 1, 8) < F.lit(f"{int(share * 2**32):08x}"))
        rows = few.orderBy("digest", "v").limit(k).collect()
        if len(rows) == k or share >= 1:
            return np.array([r["v"] for r in rows], dtype=np.int64)
        share *= 4


@dataclass(frozen=True)
class Centroids:
    """Centroids by number, and in the order of their means for the search."""

    points: np.ndarray  # k x d integers

    @cached_property
    def _order(self) -> np.ndarray:
        return np.argsort(self.points.sum(axis=1), kind="stable")

    @cached_property
    def _sorted(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        points = self.points[self._order]
        return (points, *_sum_and_deviation(points))

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of the nearest centroid; of equally near ones the least."""
        points, sums, deviations = self._sorted
        k, d = points.shape
        own_sum, own_deviation = _sum_and_deviation(x)
        right = np.searchsorted(sums, own_sum)
        left = right - 1
        best = np.full(len(x), (1 << 62) // d, dtype=np.int64)
        number = np.full(len(x), k, dtype=np.int64)
        active = np.arange(len(x))
        while len(active):
            lo, hi, s = left[active], right[active], own_sum[active]
            below = np.where(lo >= 0, s - sums[lo], _FAR)
            above = np.where(hi < k, sums[np.minimum(hi, k - 1)] - s, _FAR)
            gap = np.minimum(below, above)
            near = (gap < _FAR) & (gap * gap <= d * best[active])
            active, gap, down = active[near], gap[near], (below <= above)[near]
            at = np.where(down, left[active], right[active])
            left[active[down]] -= 1
            right[active[~down]] += 1
            least = gap.astype(float) ** 2 + (own_deviation[active] - deviations[at]) ** 2 * (1 - _SLACK)
            able = least <= d * best[active].astype(float) * (1 + _SLACK) + 1
            rows, at = active[able], at[able]
            apart = x[rows] - points[at]
            distance = np.einsum("ij,ij->i", apart, apart)
            name = self._order[at]
            wins = (distance < best[rows]) | ((distance == best[rows]) & (name < number[rows]))
            best[rows[wins]], number[rows[wins]] = distance[wins], name[wins]
        return number, best

    def digest(self, i: int) -> str:
        return hashlib.sha256(",".join(map(str, self.points[i].tolist())).encode()).hexdigest()


def _sum_and_deviation(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    total = x.sum(axis=1)
    return total, np.sqrt((x.shape[1] * np.einsum("ij,ij->i", x, x) - total * total).astype(float))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).astype(np.int64).reshape(-1, dims)


def _sums(centroids: Centroids):
    """One row per centroid and task: how many vectors it got and their sum."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, d = centroids.points.shape
        counts, sums = np.zeros(k, dtype=np.int64), np.zeros((k, d), dtype=np.int64)
        for batch in batches:
            x = _matrix(batch.column("v"), d)
            number, _ = centroids.nearest(x)
            counts += np.bincount(number, minlength=k)
            order = np.argsort(number, kind="stable")
            present, starts = np.unique(number[order], return_index=True)
            if len(present):
                sums[present] += np.add.reduceat(x[order], starts, axis=0)
        used = np.flatnonzero(counts)
        lists = pa.array(list(sums[used]), type=pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used]), lists], ["cluster", "n", "sums"])

    return run


def _next(vectors: DataFrame, centroids: Centroids) -> Centroids:
    """Every centroid moved to the floor of the mean of its vectors; one without vectors stays."""
    partial = vectors.select("v").mapInArrow(_sums(centroids), "cluster bigint, n bigint, sums array<bigint>")
    d = centroids.points.shape[1]
    total = partial.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("sums")[i]) for i in range(d)]).alias("sums"))
    points = centroids.points.copy()
    for row in total.collect():
        points[row["cluster"]] = [s // row["n"] for s in row["sums"]]
    return Centroids(points)


def _assigned(centroids: Centroids):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, distance = centroids.nearest(_matrix(batch.column("v"), centroids.points.shape[1]))
            columns = [batch.column("key"), pa.array(number.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays(columns, ["key", "cluster", "distance"])

    return run


def cluster(
    rows: DataFrame,
    key: str = "vec_id",
    column: str = "embedding",
    dims: int = 64,
    k: int = 40,
    rounds: int = 5,
    scale: int = 256,
    seed: int = 2,
) -> tuple[DataFrame, Centroids]:
    """``key, cluster, distance`` of every kept row, and the final centroids.

    ``rounds`` times all vectors are assigned and the centroids moved; then they are assigned once
    more.  The integer vectors are written once, as every round reads them.
    """
    importable(rows.sparkSession)
    vectors = as_table(integer_vectors(rows, key, column, dims, scale), "vectors")
    start = first_by_hash(vectors, k, seed)
    centroids = Centroids(start.reshape(-1, dims))
    kind = dict(vectors.dtypes)["key"]
    if not len(start):
        return vectors.selectExpr("key", "0 AS cluster", "0L AS distance").withColumnRenamed("key", key), centroids
    for _ in range(rounds):
        centroids = _next(vectors, centroids)
    found = vectors.mapInArrow(_assigned(centroids), f"key {kind}, cluster int, distance bigint")
    return found.withColumnRenamed("key", key), centroids


def with_inertia(found: DataFrame, centroids: Centroids) -> DataFrame:
    """Adds ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` to assigned rows.

    A sum beyond 64 bits is null.
    """
    found = as_table(found, "assigned")
    sums = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    total = sum(map(int, sums.values()))

    def fits(s: int) -> int | None:
        return int(s) if s < 1 << 63 else None

    rows = [(c, fits(s), fits(total), centroids.digest(c)) for c, s in sums.items()]
    schema = "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string"
    # At most k rows, as there are k clusters.
    return found.join(F.broadcast(found.sparkSession.createDataFrame(rows, schema)), "cluster")
