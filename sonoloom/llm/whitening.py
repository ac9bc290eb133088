"""Whitening of embeddings by principal components found with spectral divide and conquer.

1. Usable vectors become integer vectors; each different one is kept once in a written fit table.
2. Its count, sums and centred products are summed by dimension, so the driver gets d * (d + 1) / 2 numbers whatever the number of rows.
3. The covariance is split at a shift: the orthogonal factor U of the polar decomposition of V - shift I (by the QDWH iteration, QR
   factorisations only) has eigenvalues +1 and -1, and (U + I) / 2 projects on the eigenvectors above the shift.  Its range and
   the rest are split again until single directions are left (Nakatsukasa and Higham, 2013); parts below the wanted
   components are left whole.
4. The projection (d numbers per component) goes to all tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sonoloom.session import work_path

EPS = float(np.finfo(float).eps)
INT_ROOM = 1 << 62
SHIFT_TRIES = 40


class Fit(NamedTuple):
    """What the fit table gives: n vectors, their sums, and components by falling eigenvalue, one per row of ``axes``."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float | None


def polar_factor(a: np.ndarray) -> np.ndarray:
    """Orthogonal factor of the polar decomposition of a symmetric matrix by dynamically weighted Halley steps (QDWH)."""
    d = len(a)
    x = a / np.linalg.norm(a)
    try:
        low = 1 / np.linalg.norm(np.linalg.inv(np.linalg.qr(x)[1]))
    except np.linalg.LinAlgError:
        low = EPS
    low = min(max(low, EPS), 1.0)
    for _ in range(60):
        s = low * low
        r = np.cbrt(4 * (1 - s) / (s * s))
        root = np.sqrt(1 + r)
        wa = root + 0.5 * np.sqrt(8 - 4 * r + 8 * (2 - s) / (s * root))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(d)]))[0]
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:d] @ q[d:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x)
        x, low = new, min(low * (wa + wb * s) / (1 + wc * s), 1.0)
        if 1 - low <= 10 * EPS and moved <= np.cbrt(5 * EPS):
            break
    return x


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Places to split a symmetric matrix: the median of its diagonal, then points all over its Gershgorin range."""
    diagonal = np.diag(a)
    yield float(np.median(diagonal))
    yield float(diagonal.mean())
    radius = np.abs(a).sum(axis=1) - np.abs(diagonal)
    low, high = float((diagonal - radius).min()), float((diagonal + radius).max())
    for i in range(1, SHIFT_TRIES):
        yield low + (high - low) * ((i * 0.6180339887498949) % 1)


def split(a: np.ndarray, tolerance: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below a shift; None where all eigenvalues agree to ``tolerance``."""
    d = len(a)
    if np.linalg.norm(a - np.trace(a) / d * np.eye(d)) <= tolerance:
        return None
    start = np.random.default_rng(d).standard_normal((d, d))
    best, least = None, np.inf
    for shift in _shifts(a):
        moved = a - shift * np.eye(d)
        if np.linalg.norm(moved) <= tolerance:
            continue
        above = (polar_factor(moved) + np.eye(d)) / 2
        k = round(float(np.trace(above)))
        if not 0 < k < d:
            continue
        q = np.linalg.qr(above @ start[:, :k])[0]
        q = np.linalg.qr(above @ q, mode="complete")[0]
        off = float(np.linalg.norm(q[:, k:].T @ a @ q[:, :k]))
        if off < least:
            best, least = (q[:, :k], q[:, k:]), off
        if off <= tolerance:
            break
    return best


def eigenpairs(v: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and their unit eigenvectors as rows."""
    d, tolerance = len(v), 8 * len(v) * EPS * np.linalg.norm(v)
    parts, done, values = [np.eye(d)], [], []
    while parts and len(done) < wanted:
        basis = parts.pop()
        block = basis.T @ v @ basis
        halves = split((block + block.T) / 2, tolerance) if basis.shape[1] > 1 else None
        if halves is None:
            done.extend(basis.T)
            values.extend(np.einsum("dk,de,ek->k", basis, v, basis))
        else:
            parts.extend([basis @ halves[1], basis @ halves[0]])
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    return np.array(values)[order], np.array(done)[order]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def scaled_deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, exactly: 64-bit integers where they have room, else Python's."""
    largest = max(int(np.abs(x).max(initial=0)) * n, *map(abs, sums), 1)
    if largest < INT_ROOM // 2:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def square_sums(z: np.ndarray) -> list[int | None]:
    """Exact sum of squares of each row; None where a signed 64-bit number does not hold it."""
    if z.dtype != object and float(np.abs(z).max(initial=0)) ** 2 * z.shape[1] < INT_ROOM:
        return (z * z).sum(axis=1).tolist()
    exact = (sum(int(c) * int(c) for c in row) for row in z)
    return [s if s < 1 << 63 else None for s in exact]


def integer_vector(embedding: str = "embedding") -> Column:
    """floor(256 * c) of every entry as a long; null for vectors that are null or hold null or non-finite entries."""
    vector = F.col(embedding)
    usable = F.forall(vector, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    return F.when(usable, F.transform(vector, lambda c: F.floor(c.cast("double") * 256)))


def _cells(table: DataFrame, d: int, cells: Callable[[np.ndarray], np.ndarray]) -> dict[tuple[int, int], object]:
    """Sums over the fit table of the small symmetric matrices that ``cells`` gives for a batch, on and above the diagonal."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if batch.num_rows:
                found = cells(_matrix(batch.column("x")))
                total = found if total is None else total + found
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(j), pa.array(total[i, j])], ["i", "j", "value"])

    rows = table.filter(F.size("x") == d).mapInArrow(partial, "i bigint, j bigint, value double")
    return {(r.i, r.j): r.value for r in rows.groupBy("i", "j").agg(F.sum("value").alias("value")).collect()}


def fit(table: DataFrame, components: int) -> Fit | None:
    """Components of a table of different integer vectors ``x``; None without rows."""
    lengths = table.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.filter("d > 0").orderBy(F.desc("n"), F.desc("d")).first()
    if first is None:
        return None
    d, n = first.d, first.n

    def sums_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * d
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                wide = x if float(np.abs(x).max()) * len(x) < INT_ROOM else x.astype(object)
                total = [a + int(b) for a, b in zip(total, wide.sum(axis=0))]
        yield pa.RecordBatch.from_arrays([pa.array(range(d), pa.int32()), pa.array(map(str, total))], ["i", "value"])

    parts = table.filter(F.size("x") == d).mapInArrow(sums_of, "i int, value string")
    added = parts.groupBy("i").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    sums = [int(r.value) for r in sorted(added.collect(), key=lambda r: r.i)]

    def products(x: np.ndarray) -> np.ndarray:
        z = (scaled_deviations(x, n, sums) / n).astype(float)
        return z.T @ z

    v = np.zeros((d, d))
    for (i, j), value in _cells(table, d, products).items():
        v[i, j] = v[j, i] = value / n
    trace = float(np.trace(v))
    values, axes = eigenpairs(v, min(components, d)) if trace > 0 else (np.empty(0), np.empty((0, d)))
    kept = values > 8 * d * EPS * np.linalg.norm(v)
    values, axes = values[kept], axes[kept]
    k = len(values)

    def moments(x: np.ndarray) -> np.ndarray:
        w = np.hstack([np.ones((len(x), 1)), project(x, n, sums, axes, values)])
        return w.T @ w

    error = None
    if k:
        m = np.zeros((k + 1, k + 1))
        for (i, j), value in _cells(table, d, moments).items():
            m[i, j] = m[j, i] = value / n
        error = float(np.abs(m[1:, 1:] - np.outer(m[0, 1:], m[0, 1:]) - np.eye(k)).max())
    return Fit(n, sums, axes, values, trace, error)


def project(x: np.ndarray, n: int, sums: list[int], axes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Whitened coordinates: x less the mean along each axis, over the root of its eigenvalue."""
    centred = (scaled_deviations(x, n, sums) / n).astype(float)
    return centred @ (axes / np.sqrt(values)[:, None]).T


def whiten(vectors: DataFrame, components: int = 4, embedding: str = "embedding") -> DataFrame:
    """The usable rows of ``vectors`` with ``_white``: n, deviation, whitened, explained, identity_error.

    Rows whose vector is null or holds null or non-finite entries are dropped, and so are empty vectors and those of another
    length than most different vectors (the longer at a tie).  Each different integer vector counts once in the fit, however often it
    occurs.  ``whitened`` and ``explained`` hold one entry for each component, largest eigenvalue first; directions without
    variance beyond rounding are no components, so the lists can be shorter than ``components`` or empty.  ``deviation`` is
    null where the exact value exceeds a long.  Null and repeated ids do not matter; other columns pass through, but for a former
    ``_white`` or ``_x``.  An empty table, or one without usable vectors, gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.withColumn("_x", integer_vector(embedding)).filter("_x IS NOT NULL")
    path = work_path(spark, "whitening")
    rows.select(F.col("_x").alias("x")).distinct().write.parquet(path)
    found = fit(spark.read.parquet(path), components)
    kind = "n bigint, deviation bigint, whitened array<double>, explained array<double>, identity_error double"
    if found is None:
        return rows.filter(F.lit(False)).drop("_x").withColumn("_white", F.lit(None).cast(f"struct<{kind.replace(' ', ':').replace(',:', ',')}>"))
    n, sums, axes, values, trace, error = found

    @F.arrow_udf("deviation bigint, whitened array<double>")
    def white(column: pa.Array) -> pa.Array:
        x = _matrix(column)
        deviation = pa.array(square_sums(scaled_deviations(x, n, sums)), pa.int64())
        flat = project(x, n, sums, axes, values)
        ends = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(values))
        return pa.StructArray.from_arrays([deviation, pa.ListArray.from_arrays(ends, flat.ravel())], ["deviation", "whitened"])

    done = rows.filter(F.size("_x") == len(sums)).withColumn("_white", white("_x"))
    explained = F.array(*[F.lit(float(e / trace)) for e in values]).cast("array<double>")
    result = F.struct(
        F.lit(n).cast("bigint").alias("n"),
        F.col("_white.deviation"),
        F.col("_white.whitened"),
        explained.alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
    return done.withColumn("_white", result).drop("_x")
