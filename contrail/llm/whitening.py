"""Whitening by a covariance that is assembled from variances alone.

For every dimension and every sum of two dimensions, the squared deviations from
the mean are added up, exactly, in integers. As
var(a + b) = var(a) + var(b) + 2 cov(a, b), differences of these sums give all
cross-covariances; the finished matrix goes to `eigh`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import ship

COMPONENTS = 32
#: Entries become whole numbers: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Larger products of an entry stop here, within the range of a long.
LARGEST = 4.6e18
#: Eigenvalues up to this share of the largest count as zero.
NOTHING = 1e-12
#: Rows whose pair sums a task forms at once.
ROWS_AT_ONCE = 2048
_LIMBS, _BITS = 8, 40
_PART = ", ".join(["at int", *(f"l{k} long" for k in range(_LIMBS))])


def _usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """`vec_id`, `x` (whole numbers) of the vectors that hold finite numbers only."""
    entries = F.col(embedding).cast("array<double>")
    clean = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), entries.alias("c")).where(
        F.col("c").isNotNull() & ~F.exists("c", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    )
    limited = F.transform("c", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(LARGEST)), F.lit(-LARGEST))) + SHIFT)
    return clean.select("vec_id", limited.alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    column = batch.column("x")
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), -1)


def centred(x: np.ndarray, n: int, total: list[int]) -> np.ndarray:
    """n * x - S, exactly: as 64-bit integers where they suffice, else as Python's."""
    near = np.asarray([s // n for s in total], dtype=object)
    rest = np.asarray([s % n for s in total], dtype=object)  # S = n * near + rest
    moved = x.astype(object) - near if max(map(abs, near), default=0) > 2**61 or np.abs(x).max(initial=0) > 2**61 else x - near.astype(np.int64)
    if moved.size and (int(abs(moved).max()) + 1) * n >= 2**61:
        return moved.astype(object) * n - rest
    return moved.astype(np.int64) * n - rest.astype(np.int64)


def square_sums(y: np.ndarray, axis: int = 0) -> np.ndarray:
    """Exact sums of squares along an axis, as Python integers."""
    if y.dtype == object:
        return (y * y).sum(axis=axis)
    if not y.size:
        return np.zeros(y.shape[1 - axis], dtype=object)
    largest = int(np.abs(y).max())
    if largest * largest * y.shape[axis] < 2**63:
        return np.einsum("ij,ij->j" if axis == 0 else "ij,ij->i", y, y).astype(object)
    parts = [y & 0xFFFFFF, (y >> 24) & 0xFFFFFF, y >> 48]  # the highest keeps the sign
    total = np.zeros(y.shape[1 - axis], dtype=object)
    for i, a in enumerate(parts):
        for j, b in enumerate(parts[i:], start=i):
            product = np.einsum("ij,ij->j" if axis == 0 else "ij,ij->i", a, b).astype(object)
            total = total + product * ((1 if i == j else 2) << 24 * (i + j))
    return total


def _limbs(numbers: list[int]) -> pa.RecordBatch:
    """Numbers of any size as columns of 40 bits, which Spark can add as longs."""
    mask = (1 << _BITS) - 1
    columns = [[int(v) >> _BITS * k & mask for v in numbers] for k in range(_LIMBS - 1)]
    columns.append([int(v) >> _BITS * (_LIMBS - 1) for v in numbers])
    arrays = [pa.array(np.arange(len(numbers)), pa.int32()), *(pa.array(c, pa.int64()) for c in columns)]
    return pa.RecordBatch.from_arrays(arrays, ["at", *(f"l{k}" for k in range(_LIMBS))])


def _total(parts: DataFrame) -> list[int]:
    """The sums over all tasks. Their number depends on the dimension only."""
    summed = parts.groupBy("at").agg(*(F.sum(f"l{k}").alias(f"l{k}") for k in range(_LIMBS))).orderBy("at").collect()
    return [sum(row[f"l{k}"] << _BITS * k for k in range(_LIMBS)) for row in summed]


def polarised_sums(usable: DataFrame, n: int, total: list[int]) -> tuple[list[int], list[int]]:
    """Sums of squares of n * x - S, for every dimension, and for every sum of two dimensions in row-major order."""
    d = len(total)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(d * (d + 1) // 2, dtype=object)
        for batch in batches:
            x = _matrix(batch)
            for at in range(0, len(x), ROWS_AT_ONCE):
                y = centred(x[at : at + ROWS_AT_ONCE], n, total)
                pairs = [square_sums(y[:, i + 1 :] + y[:, [i]]) for i in range(d - 1)]
                sums = sums + np.concatenate([square_sums(y), *pairs])
        yield _limbs(sums.tolist())

    sums = _total(usable.select("x").mapInArrow(run, _PART))
    return sums[:d], sums[d:]


def covariance(n: int, own: list[int], pairs: list[int]) -> np.ndarray:
    """The covariance matrix of x, divisor n, each entry rounded once."""
    d, at = len(own), iter(pairs)
    matrix = np.empty((d, d))
    for i in range(d):
        matrix[i, i] = own[i] / n**3
        for j in range(i + 1, d):
            matrix[i, j] = matrix[j, i] = (next(at) - own[i] - own[j]) / (2 * n**3)
    return matrix


def whiten(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """Each vector's whitened components, with the figures of the fit.

    One row for each vector and component: `vec_id`, `component` (from 1 by falling
    eigenvalue), `n` (vectors of the fit), `deviation` (sum over dimensions of
    (n * x - S)^2, exact; NULL from 10^38 on), `whitened`, `explained` (share of
    the total variance), `identity_error` (largest absolute entry of the whitened
    covariance minus the identity).

    Vectors that are NULL or hold NULL or non-finite entries are left out, as are
    those whose length is not the most frequent one (of equals, the larger), and
    empty ones. Repeated rows count as often as they occur; a NULL id stays NULL;
    other columns are not read. Components without variance (eigenvalues up to
    10^-12 of the largest) have no row, and neither has an empty table. Entries
    stop at 4.6e18 / 64, within the range of a long. Eager: the fit runs when called.
    """
    spark = vectors.sparkSession
    ship(spark)
    usable = _usable(vectors, vec_id, embedding)
    lengths = usable.where(F.size("x") > 0).groupBy(F.size("x").alias("d")).agg(F.count("*").alias("n"))
    shape = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    empty = spark.createDataFrame([], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    if shape is None:
        return empty
    d, n = shape.d, shape.n
    usable = usable.where(F.size("x") == d)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for batch in batches:
            x = _matrix(batch)
            exact = x.astype(object) if np.abs(x).max(initial=0) > 2**40 else x
            total = [a + int(b) for a, b in zip(total, exact.sum(axis=0), strict=True)]
        yield _limbs(total)

    total = _total(usable.select("x").mapInArrow(sums, _PART))
    matrix = covariance(n, *polarised_sums(usable, n, total))
    values, axes = np.linalg.eigh(matrix)
    order = [k for k in np.argsort(-values, kind="stable")[:components] if values[k] > NOTHING * values[-1]]
    if not order:
        return empty
    values, scaled = values[order], axes[:, order] / np.sqrt(values[order])
    explained = values / np.trace(matrix)

    def project(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        y = centred(x, n, total)
        return y, (y / n).astype(np.float64) @ scaled

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(order)
        sums = np.zeros((k + 1, k))
        for batch in batches:
            _, w = project(_matrix(batch))
            sums[:k] += w.T @ w
            sums[k] += w.sum(axis=0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(sums.size), pa.int32()), pa.array(sums.ravel())], ["at", "value"])

    summed = usable.select("x").mapInArrow(products, "at int, value double").groupBy("at").agg(F.sum("value").alias("value"))
    moments = np.asarray([r.value for r in summed.orderBy("at").collect()]).reshape(-1, len(order)) / n
    error = float(np.abs(moments[:-1] - np.outer(moments[-1], moments[-1]) - np.eye(len(order))).max())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, w = project(_matrix(batch))
            deviation = [int(v) if v < 10**38 else None for v in square_sums(y, axis=1)]
            whitened = pa.ListArray.from_arrays(np.arange(len(w) + 1, dtype=np.int32) * len(order), pa.array(w.ravel()))
            columns = [batch.column("vec_id"), pa.array(deviation, pa.decimal128(38, 0)), whitened]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "deviation", "whitened"])

    shares = F.array(*map(F.lit, explained.tolist()))
    projected = usable.mapInArrow(rows, "vec_id long, deviation decimal(38,0), whitened array<double>")
    long_form = projected.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return long_form.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(shares, F.col("at")).alias("explained"),
        F.lit(error).alias("identity_error"),
    )
