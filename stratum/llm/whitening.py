"""Embedding whitening by refined eigenvectors of a distributed covariance.

Entries are whole numbers, so the covariance is exact: tasks send exact sums
of products of centred entries, and the driver only holds a matrix of the
vectors' dimension.  Its eigenvectors are computed in float32 and then
corrected by the Ogita-Aishima iteration, which is made of matrix products in
higher precision.  Eigenvalues too close to be told apart by the iteration
form clusters; each cluster's invariant subspace is rotated by a small
eigenproblem of the matrix less the cluster's mean, whose differences are not
lost beside the eigenvalues themselves.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratum.llm.common import stored
from stratum.llm.vectors import matrix, whole_vectors

WIDE = np.longdouble
LIMB = 20
WHITENED = (
    "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
)

# ------------------------------------------------------------ eigenvectors


def _corrected(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], WIDE]:
    """One Ogita-Aishima step: new vectors, clusters of eigenvalues and the size of the correction.

    Neighbouring eigenvalues are a cluster within the reach of the error, and
    where rounding errors over their gap would square to more than one
    rounding.  Within a cluster the step only makes vectors orthogonal.
    """
    r = np.eye(len(a), dtype=WIDE) - x.T @ x
    s = x.T @ (a @ x)
    r, s = (r + r.T) / 2, (s + s.T) / 2  # or rounding errors over small gaps would cost the right angles
    values = np.diag(s) / (1 - np.diag(r))
    reach = 2 * (np.linalg.norm(s - np.diag(values)) + np.linalg.norm(a) * np.linalg.norm(r))
    reach = max(reach, len(a) * np.sqrt(np.finfo(WIDE).eps))
    order, number = np.argsort(values), np.empty(len(a), int)
    clusters = np.split(order, np.flatnonzero(np.diff(values[order]) > reach) + 1)
    for i, group in enumerate(clusters):
        number[group] = i
    apart = number[None, :] != number[:, None]
    gap = np.where(apart, values[None, :] - values[:, None], 1)
    step = np.where(apart, (s + values[None, :] * r) / gap, r / 2)
    return x + x @ step, [group for group in clusters if len(group) > 1], np.abs(step).max()


def _rotated(a: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """``basis`` of an invariant subspace turned to eigenvectors, by the matrix less the cluster's mean."""
    at = (basis * (a @ basis)).sum(axis=0) / (basis * basis).sum(axis=0)
    inner = basis.T @ (a @ basis - at.mean() * basis)
    inner = (inner + inner.T) / 2
    if np.abs(inner - np.diag(np.diag(inner))).max() <= len(a) * np.finfo(WIDE).eps:
        return basis  # as diagonal as rounding lets it be
    if len(inner) < len(a):
        return basis @ refined_eigenvectors(inner)[1]
    turn = np.linalg.eigh((inner / np.abs(inner).max()).astype(np.float64))[1].astype(WIDE)
    return basis @ (turn @ (3 * np.eye(len(turn), dtype=WIDE) - turn.T @ turn) / 2)


def refined_eigenvectors(a: np.ndarray, steps: int = 20) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors of a symmetric matrix in extended precision."""
    a = np.asarray(a, WIDE)
    scale = np.abs(a).max()
    if not scale > 0:
        return np.zeros(len(a), WIDE), np.eye(len(a), dtype=WIDE)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(WIDE)
    settled = 0  # the correction squares its error, so a second small one is the last
    for _ in range(steps):
        x, clusters, size = _corrected(a, x)
        for group in clusters:
            x[:, group] = _rotated(a, x[:, group])
        settled += bool(size * size <= np.finfo(WIDE).eps)
        if settled > 1:
            break
    x /= np.sqrt((x * x).sum(axis=0))
    values = (x * (a @ x)).sum(axis=0)
    order = np.argsort(-values, kind="stable")
    x = x[:, order]
    signs = np.sign(x[np.abs(x).argmax(axis=0), np.arange(len(a))])
    return values[order] * scale, x * signs


# ------------------------------------------------------------- exact sums


def exact_products(y: np.ndarray) -> np.ndarray:
    """y^T y of whole numbers as Python integers.

    Products of limbs of 20 bits, 4096 rows at a time, stay below 2^53, so
    float64 matrix products of them are exact.
    """
    total = np.zeros((y.shape[1], y.shape[1]), object)
    for start in range(0, len(y), 4096):
        part, limbs = y[start : start + 4096], []
        while part.any() or not limbs:
            low = part & (2**LIMB - 1)
            low = np.where((part < 0) & (low > 0), low - 2**LIMB, low)
            limbs.append(low.astype(np.float64))
            part = (part - low) >> LIMB
        for i, one in enumerate(limbs):
            for j, other in enumerate(limbs):
                total += (one.T @ other).astype(np.int64).astype(object) * 2 ** (LIMB * (i + j))
    return total


def _summed(table: DataFrame, part: Callable[[np.ndarray], np.ndarray], like: type) -> dict[int, int | float]:
    """Sum over all rows of ``part`` of a block of them: a vector or matrix, by flat position.

    A task sends its sum once; Spark adds the tasks' sums, and the driver gets
    as many rows as the vector or matrix has entries.
    """
    exact = like is int
    kind = pa.decimal128(38, 0) if exact else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = part(matrix(batch.column(0)))
                total = found if total is None else total + found
        if total is not None:
            flat = total.ravel()
            places = np.flatnonzero(flat)
            values = [Decimal(int(flat[i])) for i in places] if exact else flat[places]
            yield pa.RecordBatch.from_arrays(
                [pa.array(places, pa.int64()), pa.array(values, kind)], ["place", "total"]
            )

    schema = f"place long, total {'decimal(38,0)' if exact else 'double'}"
    sums = table.select("x").mapInArrow(run, schema).groupBy("place").agg(F.sum("total").alias("total"))
    return {row.place: like(row.total) for row in sums.collect()}


def covariance(gram: dict[int, int], rest: list[int], n: int) -> np.ndarray:
    """Covariance in extended precision, each entry from its exact fraction."""
    size = len(rest)
    out = np.zeros((size, size), WIDE)
    for i in range(size):
        for j in range(i, size):
            value = Fraction(n * gram.get(i * size + j, 0) - rest[i] * rest[j], n * n)
            high = float(value)
            out[i, j] = out[j, i] = WIDE(high) + WIDE(float(value - Fraction(high)))
    return out


# ---------------------------------------------------------------- operator


def whiten(
    embeddings: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    components: int = 32,
    scale: int = 64,
    shift: int = 1_000_000,
    max_dimensions: int = 4096,
) -> DataFrame:
    """Whitened coordinates of every vector: a row per vector and component.

    An entry c becomes x = floor(``scale`` * c) + ``shift``; vectors that are
    null or hold null or non-finite entries go, and the rest is the fit list.
    Of vectors that differ in length, those of the most frequent length stay
    (of equally frequent ones the longest).  Columns: ``vec_id``, ``component``
    from 1, ``n`` vectors fitted, ``deviation`` = sum of (n x - S)^2 (S: sums),
    ``whitened`` = projection of x - S/n on the component over the root of its
    eigenvalue, ``explained`` share of the trace, ``identity_error``.

    Components without variance can't be whitened and have no rows, so equal
    vectors, or a single one, give none.  Repeated rows and null ids are
    vectors like any other; an empty table gives no rows.  Other columns are
    ignored.  Entries beyond 2^40 raise an error.
    """
    spark = embeddings.sparkSession
    vectors = whole_vectors(embeddings, id_col, vector_col, scale=scale, shift=shift)
    vectors = stored(vectors.withColumn("length", F.size("x")), "vectors")
    lengths = vectors.filter("length > 0").groupBy("length").count().orderBy(F.desc("count"), F.desc("length")).head(1)
    if not lengths:
        return spark.createDataFrame([], WHITENED)
    size, n = lengths[0]["length"], lengths[0]["count"]
    if size > max_dimensions:
        raise ValueError(f"vectors of {size} entries; their covariance may have {max_dimensions} rows at most")
    vectors = vectors.filter(F.col("length") == size).select("vec_id", "x")

    sums = _summed(vectors, lambda x: x.astype(object).sum(axis=0), int)
    # centred at the whole part of the mean; what is left of the mean, rest / n, is below one
    center = np.array([sums.get(i, 0) // n for i in range(size)], np.int64)
    rest = [sums.get(i, 0) % n for i in range(size)]
    gram = _summed(vectors, lambda x: exact_products(x - center), int)
    matrix_v = covariance(gram, rest, n)
    values, axes = refined_eigenvectors(matrix_v)
    positive = int((values > size * np.finfo(np.float64).eps * values[0]).sum()) if values[0] > 0 else 0
    kept = min(components, positive)
    if not kept:
        return spark.createDataFrame([], WHITENED)
    onto = (axes[:, :kept] / np.sqrt(values[:kept])).astype(np.float64)
    explained = (values[:kept] / np.trace(matrix_v)).astype(np.float64)
    offsets = np.array(rest, object)

    def deviations(x: np.ndarray) -> np.ndarray:
        """n x - S, exact: in longs where these suffice for the sum of squares too."""
        gap = x - center
        fits = size * (n * (int(np.abs(gap).max(initial=0)) + 1)) ** 2 < 2**63
        return n * gap - offsets.astype(np.int64) if fits else n * gap.astype(object) - offsets

    def coordinates(x: np.ndarray) -> np.ndarray:
        return (deviations(x) / n).astype(np.float64) @ onto

    means = _summed(vectors, lambda x: coordinates(x).sum(axis=0), float)
    mean = np.array([means.get(i, 0.0) for i in range(kept)]) / n

    def products(x: np.ndarray) -> np.ndarray:
        centred = coordinates(x) - mean
        return centred.T @ centred

    spread = _summed(vectors, products, float)
    spread = np.array([spread.get(i, 0.0) for i in range(kept * kept)]).reshape(kept, kept) / n
    error = float(np.abs(spread - np.eye(kept)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2048):
                part = batch.slice(start, 2048)
                x = matrix(part.column(1))
                gap = deviations(x)
                squares = [Decimal(int(v)) for v in (gap * gap).sum(axis=1)]
                rows = np.repeat(np.arange(len(x)), kept)
                whitened = ((gap / n).astype(np.float64) @ onto).ravel()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(rows)),
                        pa.array(np.tile(np.arange(1, kept + 1, dtype=np.int32), len(x))),
                        pa.array(squares, pa.decimal128(38, 0)).take(pa.array(rows)),
                        pa.array(whitened),
                    ],
                    ["vec_id", "component", "deviation", "whitened"],
                )

    found = vectors.mapInArrow(run, "vec_id long, component int, deviation decimal(38,0), whitened double")
    share = F.get(F.array(*map(F.lit, explained.tolist())), F.col("component") - 1)
    return found.select(
        "vec_id",
        "component",
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        share.alias("explained"),
        F.lit(error).alias("identity_error"),
    )
