"""Principal components of all vectors of a table, and vectors whitened with them.

Sums and the matrix of centred products are gathered by Spark, in integers and without rounding:
entries are fixed-point numbers, products are taken about an integer centre near the mean, and
the covariance follows exactly. Each task sends one upper triangle, whatever its rows.

The covariance of ``d`` dimensions is a ``d`` by ``d`` matrix; its eigenvectors are found on the
driver in mixed precision. A decomposition in 32-bit floats gives first vectors; Ogita-Aishima
steps, matrix products in extended precision, correct them and double the correct digits each
time. Where eigenvalues lie too close for a step to tell their vectors apart, the step leaves
the basis of the cluster alone, and a small symmetric problem in that basis, shifted by the
cluster's mean so that no digits are lost, turns it (the sub-solve).

Defined cases: vectors that are null, or hold null or non-finite entries, are dropped; zero
vectors stay. Vectors must have one length, others raise an error. Repeated rows, repeated and
null ids each count as rows. A direction without variance has no whitened value: ``whitened`` is
null there and the direction is left out of ``identity_error``. An empty table, or one without a
remaining vector, gives an empty result. Entries beyond 2^40 in size, and a deviation beyond 64
bits, raise an error instead of wrapping. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialise, short_batches

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
BATCH = 4096
#: Products of centred entries are added in 64-bit integers up to this size.
SAFE = 1 << 62
#: Directions with less than this share of the largest eigenvalue count as without variance.
NO_VARIANCE = 1e-13

HIGH = np.longdouble
#: Eigenvalues closer than this share of the largest are always one cluster: a step divides
#: rounding errors by their difference, and the square of the quotient must stay negligible.
CLOSEST = 1e10 * float(np.finfo(HIGH).eps)


# ---- fixed-point vectors ----------------------------------------------------------


def remaining(rows: DataFrame, column: str = "embedding", id_column: str = "vec_id") -> DataFrame:
    """``(vec_id, v)`` of the rows whose vector is complete and finite."""
    v = F.col(column)
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return rows.filter(v.isNotNull() & finite).select(
        F.col(id_column).cast("long").alias("vec_id"), v.alias("v")
    )


def fixed_point(column: pa.Array) -> np.ndarray:
    """Vectors of an Arrow list column as rows of integers."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = set(lists.value_lengths().to_pylist())
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {sorted(lengths)[:5]}")
    values = np.asarray(lists.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    if values.size and np.abs(values).max() >= 2.0**40:
        raise OverflowError("an entry is too large for a fixed-point number")
    x = np.floor(values * SCALE).astype(np.int64) + OFFSET
    return x.reshape(len(lists), -1)


def _batches(x: np.ndarray, ids: list) -> Iterator[tuple[np.ndarray, list]]:
    for at in range(0, len(x), BATCH):
        yield x[at : at + BATCH], ids[at : at + BATCH]


# ---- sums -------------------------------------------------------------------------


def _sums(vectors: DataFrame) -> tuple[int, list[int]]:
    """Number of vectors and the sums of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = fixed_point(batch.column(0))
            if total is None:
                total = [0] * x.shape[1]
            if len(total) != x.shape[1]:
                raise ValueError("vectors of different lengths")
            n += len(x)
            total = [a + int(b) for a, b in zip(total, x.sum(axis=0), strict=True)]
        if n:
            size = len(total)
            columns = [[n] * size, list(range(size)), [str(t) for t in total]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, [pa.int64(), pa.int32(), pa.string()], strict=True)],
                ["n", "i", "total"],
            )

    partial = vectors.select("v").mapInArrow(add, "n long, i int, total string")
    summed = partial.groupBy("i").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")
    )
    rows = sorted(summed.collect())  # one row per dimension
    if not rows:
        return 0, []
    if len({r["n"] for r in rows}) > 1:
        raise ValueError("vectors of different lengths")
    return rows[0]["n"], [int(r["total"]) for r in rows]


def _products(vectors: DataFrame, centre: np.ndarray) -> dict[tuple[int, int], int]:
    """Sums of ``y_i y_j``, ``y`` being the vector less the integer ``centre``, for i <= j."""
    d = len(centre)
    upper = np.triu_indices(d)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, used = None, 0
        for batch in batches:
            for x, _ in _batches(fixed_point(batch.column(0)), [None] * batch.num_rows):
                y = x - centre
                largest = int(np.abs(y).max()) if y.size else 0
                bound = largest * largest * len(y)
                if bound < 2**53:
                    # Every partial sum is an integer below 2^53, so doubles are exact.
                    f = y.astype(np.float64)
                    product = (f.T @ f)[upper].astype(np.int64)
                elif bound < SAFE:
                    product = (y.T @ y)[upper]
                else:
                    o = y.astype(object)
                    product = (o.T @ o)[upper]
                if total is None:
                    total = product
                elif used + bound < SAFE:
                    total = total + product
                else:
                    total = total.astype(object) + product.astype(object)
                used += bound
        if total is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(upper[0], pa.int32()),
                    pa.array(upper[1], pa.int32()),
                    pa.array([str(int(t)) for t in total], pa.string()),
                ],
                ["i", "j", "total"],
            )

    partial = vectors.select("v").mapInArrow(add, "i int, j int, total string")
    summed = partial.groupBy("i", "j").agg(
        F.sum(F.col("total").cast("decimal(38,0)")).cast("string").alias("total")
    )
    return {(r["i"], r["j"]): int(r["total"]) for r in summed.collect()}  # d (d + 1) / 2 rows


def _as_double(numerator: int, denominator: int) -> tuple[float, float]:
    """A fraction as the nearest double and the double nearest to the rest."""
    exact = Fraction(numerator, denominator)
    head = float(exact)
    return head, float(exact - Fraction(head))


def covariance(n: int, total: list[int], centre: np.ndarray, products: dict) -> np.ndarray:
    """Covariance with divisor ``n``, exact up to one rounding to extended precision."""
    d = len(total)
    rest = [t - n * int(c) for t, c in zip(total, centre, strict=True)]
    v = np.zeros((d, d), dtype=HIGH)
    for (i, j), p in products.items():
        head, tail = _as_double(n * p - rest[i] * rest[j], n * n)
        v[i, j] = v[j, i] = HIGH(head) + HIGH(tail)
    return v


# ---- eigenvectors -----------------------------------------------------------------


def _clusters(values: np.ndarray, gap: float) -> list[np.ndarray]:
    """Runs of neighbouring eigenvalues less than ``gap`` apart, those of several only."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > gap) + 1
    return [run for run in np.split(order, cuts) if len(run) > 1]


def _step(a: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, float, float]:
    """One Ogita-Aishima step: better vectors, their values, the gap and the residual."""
    d = len(a)
    r = np.eye(d, dtype=HIGH) - x.T @ x
    s = x.T @ (a @ x)
    values = np.diag(s) / (1 - np.diag(r))
    off = s - np.diag(values)
    residual = max(float(np.abs(off).max()), float(np.abs(r).max() * np.abs(values).max()))
    largest = float(np.abs(values).max())
    gap = 2 * (np.linalg.norm(off.astype(float)) + largest * np.linalg.norm(r.astype(float)))
    gap = max(float(gap), CLOSEST * largest)
    difference = values[None, :] - values[:, None]
    apart = np.abs(difference) > gap
    e = np.where(apart, (s + values[None, :] * r) / np.where(apart, difference, 1), r / 2)
    return x + x @ e, values, gap, residual


def refine(a: np.ndarray, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors (columns) of a symmetric matrix."""
    scale = HIGH(np.abs(a).max()) if a.size else HIGH(0)
    if scale == 0:
        return np.zeros(len(a)), np.eye(len(a))
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(HIGH)
    best = None
    for _ in range(steps):
        x, values, gap, residual = _step(a, x)
        if best is not None and residual >= best and residual < 1e-15:
            break
        best = residual if best is None else min(best, residual)
        for run in _clusters(np.asarray(values, dtype=float), gap):
            # Inside a cluster, turn the basis: shifted by its mean the small differences
            # of the values keep all their digits in a decomposition in doubles.
            basis, mean = x[:, run], values[run].mean()
            inner = basis.T @ (a @ basis - mean * basis)
            inner = np.asarray((inner + inner.T) / 2, dtype=float)
            x[:, run] = basis @ np.linalg.eigh(inner)[1].astype(HIGH)
    x, values, _, _ = _step(a, x)
    # The nearest orthonormal basis, by one Newton step of the polar decomposition.
    x = x @ (3 * np.eye(len(a), dtype=HIGH) - x.T @ x) / 2
    x = x / np.sqrt((x * x).sum(axis=0))
    order = np.argsort(-values, kind="stable")
    return np.asarray(values[order] * scale, dtype=float), np.asarray(x[:, order], dtype=float)


@dataclass
class Whitening:
    """A fitted transform: ``components`` are rows, by falling ``values``."""

    n: int
    total: list[int]
    values: np.ndarray
    components: np.ndarray
    trace: float


def fit(vectors: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Components of all ``vectors`` of :func:`remaining`; None without any."""
    short_batches(vectors.sparkSession, BATCH)
    n, total = _sums(vectors)
    if not n:
        return None
    centre = np.array([round(Fraction(t, n)) for t in total], dtype=np.int64)
    v = covariance(n, total, centre, _products(vectors, centre))
    values, x = refine(v)
    kept = min(components, len(values))
    rows = x[:, :kept].T.copy()
    # Either sign is right; the largest entry is made positive, so that reruns agree.
    if rows.size:
        largest = np.abs(rows).argmax(axis=1)
        rows *= np.where(rows[np.arange(kept), largest] < 0, -1.0, 1.0)[:, None]
    return Whitening(n, total, values[:kept], rows, float(np.trace(v)))


def has_variance(model: Whitening) -> np.ndarray:
    if not len(model.values):
        return np.zeros(0, dtype=bool)
    return model.values > NO_VARIANCE * max(model.values[0], 0.0)


def deviations(x: np.ndarray, n: int, total: list[int]) -> tuple[np.ndarray, list[int]]:
    """``n x - S`` as doubles, each rounded once, and the exact sums of its squares."""
    largest = int(np.abs(x).max()) if x.size else 0
    bound = n * largest + max(map(abs, total), default=0)
    if bound < SAFE:
        d = x * n - np.array(total, dtype=np.int64)
    else:
        d = x.astype(object) * n - np.array(total, dtype=object)
    reach = max((abs(int(v)) for v in (d.min(), d.max())), default=0) if d.size else 0
    wide = d if reach * reach * d.shape[1] < SAFE else d.astype(object)
    squares = [int(s) for s in (wide * wide).sum(axis=1)] if d.size else [0] * len(x)
    if any(s >= 1 << 63 for s in squares):
        raise OverflowError("a deviation needs more than 64 bits")
    return d.astype(np.float64), squares


def transform(vectors: DataFrame, model: Whitening) -> DataFrame:
    """``(vec_id, deviation, w)``: whitened values of each vector, null without variance."""
    some = has_variance(model)
    root = np.sqrt(np.where(some, model.values, 1.0))
    matrix = model.components.T
    n, total = model.n, model.total

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = fixed_point(batch.column(1))
            for x, ids in _batches(whole, batch.column(0).to_pylist()):
                d, squares = deviations(x, n, total)
                w = (d / n) @ matrix / root
                flat = pa.array(w.ravel(), pa.float64(), mask=~np.tile(some, len(x)))
                ends = pa.array(np.arange(len(x) + 1) * w.shape[1], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(ids, pa.int64()),
                        pa.array(squares, pa.int64()),
                        pa.ListArray.from_arrays(ends, flat),
                    ],
                    ["vec_id", "deviation", "w"],
                )

    return vectors.mapInArrow(project, "vec_id long, deviation long, w array<double>")


def identity_error(whitened: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the covariance of the whitened values less the identity."""
    used = np.flatnonzero(has_variance(model)).tolist()
    if not used:
        return None
    w = {i: F.get("w", F.lit(i)) for i in used}
    means = whitened.agg(*[F.avg(w[i]).alias(str(i)) for i in used]).first()
    pairs = [(i, j) for i in used for j in used if i <= j]
    centred = {i: w[i] - F.lit(float(means[str(i)])) for i in used}
    moments = whitened.agg(*[F.avg(centred[i] * centred[j]) for i, j in pairs]).first()
    return max(abs(m - (i == j)) for m, (i, j) in zip(moments, pairs, strict=True))


def whiten(
    rows: DataFrame,
    column: str = "embedding",
    id_column: str = "vec_id",
    components: int = COMPONENTS,
) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``.

    One row per remaining vector and component; components count from 1 by falling eigenvalue.
    ``deviation`` is the sum of ``(n x - S)^2`` over the dimensions, ``x`` being the vector's
    fixed-point form and ``S`` its sums over all ``n``; ``explained`` is the eigenvalue's share
    of the trace; ``identity_error`` is measured on the written whitened values.
    """
    vectors = remaining(rows, column, id_column)
    model = fit(vectors, components)
    if model is None:
        return rows.sparkSession.createDataFrame(
            [],
            "vec_id long, component int, n long, deviation long, whitened double, "
            "explained double, identity_error double",
        )
    whitened = materialise(transform(vectors, model), "whitened")
    error = identity_error(whitened, model)
    explained = [float(e) / model.trace if model.trace > 0 else None for e in model.values]
    return whitened.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened")).select(
        "vec_id",
        (F.col("at") + 1).cast("int").alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.get(F.lit(explained).cast("array<double>"), F.col("at")).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
