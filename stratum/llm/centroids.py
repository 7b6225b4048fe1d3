"""Centroid clustering whose assignment is pruned by Ptolemaic pivots.

For pivots p, s Ptolemy's inequality gives a lower bound of the distance of a
vector v to a centroid c from distances to the pivots alone:

    d(v, c) >= |d(v, p) d(c, s) - d(v, s) d(c, p)| / d(p, s)

The pivots are fixed, so the vectors' distances to them are computed once and
stored beside the vectors; each round only adds those of the centroids.  The
bounds are floats rounded down by more than their error, and every centroid
whose bound does not exceed the best exact distance so far is checked exactly,
in whole numbers, so that assignments and ties are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import stored
from stratum.llm.vectors import matrix, whole_vectors

ASSIGNED = "vec_id long, cluster int, distance long"
UNIT = 2.0**-53
Centers = list[list[int]]


def squared_distances(x: np.ndarray, center: np.ndarray) -> np.ndarray:
    """Exact squared distance of each row to ``center`` (or to its own row of it)."""
    gap = x - center
    return np.einsum("ij,ij->i", gap, gap)


def distances_to(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Distance of each row to each pivot, at most two units in the last place off."""
    if not len(pivots):
        return np.empty((len(x), 0))
    return np.sqrt(np.stack([squared_distances(x, p) for p in pivots], axis=1).astype(np.float64))


def spread_out(candidates: Centers, count: int) -> Centers:
    """Up to ``count`` different candidates, each the farthest from those before."""
    rows = np.array(candidates, np.int64)
    chosen = [0] if len(rows) else []
    while len(chosen) < count:
        nearest = np.min([squared_distances(rows, rows[i]) for i in chosen], axis=0) if chosen else np.empty(0)
        if not nearest.any():
            break
        chosen.append(int(nearest.argmax()))
    return [candidates[i] for i in chosen]


class PtolemaicAssignment:
    """Nearest centroids (ties: the smaller number) of vectors with cached pivot distances."""

    def __init__(self, centers: Centers, pivots: Centers):
        self.centers = np.array(centers, np.int64)
        points = np.array(pivots, np.int64).reshape(len(pivots), self.centers.shape[1])
        self.to_pivots = distances_to(self.centers, points)
        between = distances_to(points, points)
        self.pairs = [(p, s, between[p, s]) for p, s in combinations(range(len(points)), 2) if between[p, s] > 0]
        self.checked = self.possible = 0

    def bounds(self, cached: np.ndarray) -> np.ndarray:
        """Lower bounds of all squared distances, rounded down beyond their error.

        A cached distance is off by at most 2 units, a product of two by 6, their
        difference by 6 units of their sum; 16 units of the sum are taken off,
        and 16 of the quotient's square.
        """
        low = np.zeros((len(cached), len(self.centers)))
        for p, s, gap in self.pairs:
            one = np.outer(cached[:, p], self.to_pivots[:, s])
            other = np.outer(cached[:, s], self.to_pivots[:, p])
            np.maximum(low, (np.abs(one - other) - 16 * UNIT * (one + other)) / gap, out=low)
        return low * low * (1 - 16 * UNIT)

    def nearest(self, x: np.ndarray, cached: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        low = self.bounds(cached)
        first = low.argmin(axis=1)
        choice, best = first.copy(), squared_distances(x, self.centers[first])
        self.checked += len(x)
        for number, center in enumerate(self.centers):
            # an exact distance as a float is off by a unit, which the bounds' slack covers
            left = np.flatnonzero((low[:, number] <= best.astype(np.float64)) & (first != number))
            found = squared_distances(x[left], center)
            better = (found < best[left]) | ((found == best[left]) & (number < choice[left]))
            choice[left[better]], best[left[better]] = number, found[better]
            self.checked += len(left)
        self.possible += len(x) * len(self.centers)
        return choice, best


def _with_pivot_distances(vectors: DataFrame, pivots: Centers) -> DataFrame:
    points = np.array(pivots, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cached = distances_to(matrix(batch.column("x")), points)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(list(cached), pa.list_(pa.float64()))], [*batch.schema.names, "cached"]
                )

    return vectors.select("vec_id", "x").mapInArrow(run, "vec_id long, x array<long>, cached array<double>")


def _assigned(table: DataFrame, centers: Centers, pivots: Centers) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ours = PtolemaicAssignment(centers, pivots)
        for batch in batches:
            if batch.num_rows:
                choice, best = ours.nearest(matrix(batch.column("x")), matrix(batch.column("cached"), np.float64))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(choice, pa.int32()), pa.array(best, pa.int64())],
                    ["vec_id", "cluster", "distance"],
                )

    return table.mapInArrow(run, ASSIGNED)


def _moved(table: DataFrame, centers: Centers, pivots: Centers) -> Centers:
    """Each centroid as the floor of its vectors' mean; one without vectors stays.

    A task sends one row per centroid and position; what comes to the driver
    is their number, whatever the size of the table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ours = PtolemaicAssignment(centers, pivots)
        sums, members = np.zeros(ours.centers.shape, object), np.zeros(len(centers), object)
        for batch in batches:
            if batch.num_rows:
                x = matrix(batch.column("x"))
                choice, _ = ours.nearest(x, matrix(batch.column("cached"), np.float64))
                for cluster in np.unique(choice):
                    mine = x[choice == cluster]
                    sums[cluster] += mine.sum(axis=0)
                    members[cluster] += len(mine)
        rows = [
            (k, i, Decimal(int(v)))
            for k in range(len(centers))
            if members[k]
            for i, v in enumerate([members[k], *sums[k]])
        ]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r[0] for r in rows], pa.int32()),
                pa.array([r[1] for r in rows], pa.int32()),
                pa.array([r[2] for r in rows], pa.decimal128(38, 0)),
            ],
            ["cluster", "place", "total"],
        )

    parts = table.mapInArrow(run, "cluster int, place int, total decimal(38,0)")
    totals = parts.groupBy("cluster", "place").agg(F.sum("total").cast("decimal(38,0)").alias("total")).collect()
    found = {(r.cluster, r.place): int(r.total) for r in totals}
    return [
        [found[k, i + 1] // found[k, 0] for i in range(len(center))] if (k, 0) in found else center
        for k, center in enumerate(centers)
    ]


def cluster_centroids(
    embeddings: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dimensions: int = 64,
    clusters: int = 16,
    rounds: int = 3,
    scale: int = 64,
    salt: str = "1",
    pivots: int = 6,
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every vector kept.

    Kept are vectors of exactly ``dimensions`` entries, none null or
    non-finite; an entry c becomes floor(``scale`` * c).  The first centroids
    are the vectors with the least SHA-256 of ``<salt>:<vec_id>`` (of equal ids
    the least vector first, null ids last), as many as there are vectors at
    most.  Each round assigns all vectors and moves each centroid to the floor
    of its mean; a last assignment follows.  The pivots are chosen among the
    first centroids.  The number of pivots changes no row.

    Repeated rows and null ids are vectors like any other.  Without a vector
    there are no rows.  Other columns are ignored.  Entries so large that a
    squared distance might not fit a long raise an error.
    """
    spark = embeddings.sparkSession
    largest = int((2**61 / max(dimensions, 1)) ** 0.5 / 2)
    vectors = whole_vectors(embeddings, id_col, vector_col, scale=scale, largest=largest)
    vectors = stored(vectors.filter(F.size("x") == dimensions), "vectors")
    rank = F.sha2(F.concat(F.lit(f"{salt}:"), F.col("vec_id").cast("string")), 256)
    first = vectors.select(rank.alias("rank"), "x").orderBy(F.col("rank").asc_nulls_last(), "x").limit(clusters)
    centers: Centers = [list(row.x) for row in first.collect()]
    schema = f"{ASSIGNED}, cluster_inertia decimal(38,0), inertia decimal(38,0), centroid_sha256 string"
    if not centers:
        return spark.createDataFrame([], schema)
    points = spread_out(centers, pivots)
    table = stored(_with_pivot_distances(vectors, points), "pivot-distances")
    for _ in range(rounds):
        centers = _moved(table, centers, points)
    assigned = stored(_assigned(table, centers, points), "assigned")
    sums = assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()
    inertia = {row.cluster: int(row.total) for row in sums}  # a row per centroid at most
    digests = [hashlib.sha256(",".join(map(str, center)).encode()).hexdigest() for center in centers]

    def by_cluster(values: list) -> Column:
        return F.get(F.array(*map(F.lit, values)), F.col("cluster"))

    each = [Decimal(inertia.get(k, 0)) for k in range(len(centers))]
    return assigned.select(
        "vec_id",
        "cluster",
        "distance",
        by_cluster(each).cast("decimal(38,0)").alias("cluster_inertia"),
        F.lit(sum(each)).cast("decimal(38,0)").alias("inertia"),
        by_cluster(digests).alias("centroid_sha256"),
    )
