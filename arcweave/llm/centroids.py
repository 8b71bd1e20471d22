"""Centroid clustering by the equal-average equal-variance search.

For vectors x and c of d components with means m and deviations v (the length
of the vector less its mean), Cauchy and Schwarz give

    |x - c|^2  >=  d (m_x - m_c)^2 + (v_x - v_c)^2.

The centroids are sorted by mean. Each vector starts at its own mean and looks
outward, at the side that is nearer in mean. Once the first term alone is over
the best distance so far, all centroids further out are, and its search ends;
where both terms together are over it, that centroid is passed. What is left is
finished in exact integers, and ties go to the smaller number. The two bounds
are floating-point numbers and reject only beyond a margin far over their
rounding, so that no centroid is lost to it.

A round of Lloyd's method is one pass over the vectors: tasks send one exact sum
for each centroid they met, Spark adds these, and the driver holds the centroids
(their number is a parameter) and nothing else. A heavy cluster is one row a task.

Defined results: rows without exactly ``dimensions`` components, or with a null
or non-finite one, are left out; without any other the result is empty. Every
row counts, repeated ones too. A null id comes after all others as a start, of equal
ids the smaller vector comes first. Fewer rows than centroids start fewer.
Components of any size are exact; a squared distance or a sum of them over 64
bits, or a component sum over 38 digits, raises an error. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arcweave.llm.words import column
from arcweave.scratch import Scratch

DIMENSIONS, CENTROIDS, ROUNDS = 64, 40, 5
SCALE = 256
SEED = "2:"
#: Components up to this size are taken as 64-bit integers, larger ones as Python's.
SMALL = 1 << 20
#: The bounds' margin, as a share of the two squared lengths.
MARGIN = 1e-10
LONGEST = (1 << 63) - 1


class Codebook:
    """Centroids with their means, deviations and squared lengths, sorted by mean."""

    def __init__(self, centroids: list[list[int]]):
        self.centroids = centroids
        self.small = all(abs(c) <= SMALL for row in centroids for c in row)
        rough = np.array([[float(c) for c in row] for row in centroids])
        self.order = np.argsort(rough.mean(1), kind="stable")
        self.mean, self.deviation, self.square = _moments(rough[self.order])
        ordered = [centroids[i] for i in self.order]
        self.wide = np.array(ordered, object)
        self.exact = np.array(ordered, np.int64) if self.small else self.wide

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """Each point's centroid, its squared distance, and how many exact distances that took."""
        rough = points.astype(np.float64)
        size, (n, d) = len(self.order), rough.shape
        mean, deviation, square = _moments(rough)
        exact = self.exact if points.dtype == np.int64 else self.wide
        best = np.full(n, LONGEST, exact.dtype)
        bound = np.full(n, np.inf)
        found = np.full(n, size, np.int64)
        high = np.searchsorted(self.mean, mean)
        low = high - 1
        active = np.arange(n)
        measured = 0
        while len(active):
            a, b = low[active], high[active]
            under = np.where(a >= 0, mean[active] - self.mean[np.maximum(a, 0)], np.inf)
            over = np.where(b < size, self.mean[np.minimum(b, size - 1)] - mean[active], np.inf)
            down = under <= over
            at = np.where(down, a, b)
            apart = d * np.minimum(under, over) ** 2
            limit = bound[active] + MARGIN * (square[active] + self.square[at])
            open_ = apart <= limit
            try_ = open_ & (apart + (deviation[active] - self.deviation[at]) ** 2 <= limit)
            row, place = active[try_], at[try_]
            distance = ((points[row] - exact[place]) ** 2).sum(1)
            measured += len(row)
            number = self.order[place]
            first = found[row] == size
            better = first | (distance < best[row]) | ((distance == best[row]) & (number < found[row]))
            row, distance = row[better], distance[better]
            best[row], bound[row], found[row] = distance, distance.astype(np.float64), number[better]
            low[active] -= down
            high[active] += ~down
            active = active[open_ & ((low[active] >= 0) | (high[active] < size))]
        return found, best, measured


def _moments(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    mean = rows.mean(1)
    return mean, np.sqrt(((rows - mean[:, None]) ** 2).sum(1)), (rows**2).sum(1)


def integer_vectors(vectors: DataFrame, dimensions: int = DIMENSIONS, scale: int = SCALE) -> DataFrame:
    """(vec_id, point) of the rows that count; ``point`` holds whole numbers as doubles, which is exact."""
    value = F.col("embedding")
    finite = F.forall(value, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    whole = F.transform(value, lambda x: _floor(x.cast("double") * F.lit(float(scale))))
    kept = vectors.select("vec_id", "embedding").where(F.coalesce((F.size(value) == dimensions) & finite, F.lit(False)))
    return kept.select("vec_id", whole.alias("point"))


def _floor(x):
    """Of a double, as a double: from 2^53 on all doubles are whole."""
    return F.when(F.abs(x) < F.lit(float(1 << 53)), F.floor(x).cast("double")).otherwise(x)


def _points(batch: pa.RecordBatch, small: bool) -> np.ndarray:
    rows = column(batch, "point")
    flat = rows.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
    if small and (not flat.size or np.abs(flat).max() <= SMALL):
        return flat.astype(np.int64)
    return np.array([[int(x) for x in row] for row in flat], object)


def first_centroids(points: DataFrame, centroids: int = CENTROIDS, seed: str = SEED) -> list[list[int]]:
    """The vectors whose ids have the smallest digests."""
    digest = F.sha2(F.concat(F.lit(seed), F.col("vec_id").cast("string")), 256)
    rows = points.orderBy(digest.asc_nulls_last(), "point").limit(centroids)
    return [[int(x) for x in r.point] for r in rows.select("point").collect()]


def cluster_sums(points: DataFrame, book: Codebook) -> DataFrame:
    """(cluster, n, sums) over all points; each task sends at most one row for each centroid."""

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = _points(batch, book.small)
            found = book.nearest(rows)[0]
            for c in np.unique(found):
                own = rows[found == c]
                counts[c] = counts.get(c, 0) + len(own)
                sums[c] = sums.get(c, 0) + own.sum(0).astype(object)
        keys = list(counts)
        arrays = [
            pa.array(keys, pa.int32()),
            pa.array([counts[c] for c in keys], pa.int64()),
            pa.array([[Decimal(int(s)) for s in sums[c]] for c in keys], pa.list_(pa.decimal128(38, 0))),
        ]
        yield pa.RecordBatch.from_arrays(arrays, ["cluster", "n", "sums"])

    parts = points.mapInArrow(added, "cluster int, n long, sums array<decimal(38,0)>")
    total = F.array(*(F.sum(F.col("sums")[i]) for i in range(len(book.centroids[0]))))
    return parts.groupBy("cluster").agg(F.sum("n").alias("n"), total.alias("sums"))


def fit(points: DataFrame, centroids: int = CENTROIDS, rounds: int = ROUNDS) -> list[list[int]]:
    """The centroids after ``rounds`` rounds; empty ones stay where they are."""
    current = first_centroids(points, centroids)
    for _ in range(rounds if current else 0):
        current = list(current)
        for r in cluster_sums(points, Codebook(current)).collect():
            current[r.cluster] = [int(s) // r.n for s in r.sums]
    return current


def assign(points: DataFrame, centroids: list[list[int]]) -> DataFrame:
    """(vec_id, cluster, distance) of each point."""
    book = Codebook(centroids)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            found, distance, _ = book.nearest(_points(batch, book.small))
            if distance.max() > LONGEST:
                raise OverflowError("a squared distance does not fit in 64 bits")
            arrays = [column(batch, "vec_id"), pa.array(found.astype(np.int32)), pa.array(distance.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(arrays, ["vec_id", "cluster", "distance"])

    return points.mapInArrow(placed, f"vec_id {dict(points.dtypes)['vec_id']}, cluster int, distance long")


def cluster(vectors: DataFrame, scratch: Scratch, centroids: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> DataFrame:
    """Each vector's cluster, with the inertia and the digest of its centroid.

    Columns vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.
    """
    spark = vectors.sparkSession
    points = scratch.save(integer_vectors(vectors, dimensions), "points")
    last = fit(points, centroids, rounds)
    placed = scratch.save(assign(points, last or [[0] * dimensions]), "placed")
    inertia = {r.cluster: r.total for r in placed.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}
    whole = sum(inertia.values())
    kind = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in last]
    facts = spark.createDataFrame([(c, total, whole, digests[c]) for c, total in inertia.items()], kind)
    return placed.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
