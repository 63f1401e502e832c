"""Embedding whitening: components of the covariance by QDWH spectral
divide-and-conquer, then a broadcast projection of every vector.

Spark takes the distinct vectors, their exact sums and one partial covariance per
task; the covariance itself is as small as the vectors are long.  It is split by
the polar factor U of the matrix shifted by s, computed by dynamically weighted
Halley iterations: (U + I) / 2 projects on the eigenvectors above s, whose span is
invariant, so the matrix falls into two smaller ones, and so on down to single
components.  Only the branches of the wanted components are followed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelframe.llm.common import settle, stored, table

COMPONENTS = 16
SCALE = 64
OFFSET = 1_000_000
EPS = np.finfo(np.float64).eps
ROUNDS = 60


# ---- spectral divide-and-conquer of a symmetric matrix ---------------------------

def polar(a: np.ndarray) -> np.ndarray:
    """Orthogonal polar factor of a symmetric matrix, by QDWH: inverse-free steps by
    QR while the weights are large, then by Cholesky."""
    n = len(a)
    x = a / np.linalg.norm(a)
    low = max(np.linalg.norm(x, -2) * 0.9, EPS)  # bound of the smallest singular value
    for _ in range(ROUNDS):
        d = np.cbrt(4 * (1 - low * low) / low ** 4)
        root = np.sqrt(1 + d)
        wa = root + np.sqrt(max(8 - 4 * d + 8 * (2 - low * low) / (low * low * root), 0.0)) / 2
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        last = x
        if wc > 100:
            q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
            x = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        else:
            factor = np.linalg.cholesky(np.eye(n) + wc * (x.T @ x))
            y = np.linalg.solve(factor, x.T)
            x = wb / wc * x + (wa - wb / wc) * np.linalg.solve(factor.T, y).T
        x = (x + x.T) / 2
        low = min(low * (wa + wb * low * low) / (1 + wc * low * low), 1.0)
        if np.linalg.norm(x - last) <= np.cbrt(EPS) * np.sqrt(n) and 1 - low < 1e-8:
            break
    return x


def _shifts(a: np.ndarray) -> Iterator[float]:
    """Places to cut the spectrum: the median of the diagonal, the mean, the widest
    gaps of the diagonal, then places inside the Gershgorin bounds."""
    d = np.sort(np.diag(a))
    yield float(np.median(d)) if len(d) % 2 == 0 else float(d[len(d) // 2] + d[len(d) // 2 - 1]) / 2
    yield float(d.mean())
    gaps = np.diff(d)
    for i in np.argsort(-gaps)[:4]:
        yield float((d[i] + d[i + 1]) / 2)
    reach = np.abs(a).sum(axis=1) - np.abs(np.diag(a))
    low, high = float((np.diag(a) - reach).min()), float((np.diag(a) + reach).max())
    for steps in (2, 3, 5, 7, 11, 16, 64, 256):
        for i in range(1, steps):
            yield low + (high - low) * i / steps


def split(a: np.ndarray, norm: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the invariant subspaces above and below some shift;
    None if the matrix is a multiple of the identity up to rounding."""
    n = len(a)
    tolerance = 10 * n * EPS * norm
    if np.linalg.norm(a - np.trace(a) / n * np.eye(n)) <= tolerance:
        return None
    best = None
    for shift in _shifts(a):
        shifted = a - shift * np.eye(n)
        if not np.linalg.norm(shifted):
            continue
        c = (polar(shifted) + np.eye(n)) / 2
        k = int(round(float(np.trace(c))))
        if not 0 < k < n:
            continue
        # a basis from the projector's heaviest columns, improved by one more multiplication
        heavy = np.argsort(-(c * c).sum(axis=0), kind="stable")
        basis, _ = np.linalg.qr(c @ np.linalg.qr(c[:, heavy])[0][:, :k], mode="complete")
        rest = np.linalg.norm(basis[:, k:].T @ a @ basis[:, :k])
        if best is None or rest < best[0]:
            best = rest, basis[:, :k], basis[:, k:]
        if rest <= tolerance:
            break
    return None if best is None or best[0] > np.sqrt(EPS) * norm else best[1:]


def components(a: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues of a symmetric matrix, falling, and unit
    eigenvectors as columns; the largest entry of each is positive."""
    a = (a + a.T) / 2
    norm = float(np.linalg.norm(a))
    values: list[float] = []
    vectors: list[np.ndarray] = []
    open_parts = [np.eye(len(a))]  # largest eigenvalues last
    while open_parts and len(values) < wanted:
        basis = open_parts.pop()
        part = basis.T @ a @ basis
        halves = split((part + part.T) / 2, norm) if len(part) > 1 and norm else None
        if halves is not None:
            open_parts += [basis @ halves[1], basis @ halves[0]]
        else:  # a single component, or equal eigenvalues
            for v in basis.T:
                v = v / np.linalg.norm(v)
                vectors.append(v * (1 if v[np.abs(v).argmax()] >= 0 else -1))
                values.append(float(v @ a @ v))
    order = np.argsort(-np.array(values), kind="stable")[:wanted]
    return np.array(values)[order], np.array(vectors).reshape(len(values), len(a))[order].T


# ---- over the table --------------------------------------------------------------

def _rows(column: pa.Array, dtype) -> np.ndarray:
    """Arrays of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return flat.reshape(len(column), -1)


def _spread(mean: np.ndarray, weights: np.ndarray):
    """Partial sums of a task: rows (i, row i of the second moments, sum i) of the
    vectors, centred and then multiplied by ``weights``."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = weights.shape[1]
        moments, total = np.zeros((k, k)), np.zeros(k)
        for batch in batches:
            if batch.num_rows:
                y = (_rows(batch.column(0), np.float64) - mean) @ weights
                moments += y.T @ y
                total += y.sum(axis=0)
        i, j = np.indices((k, k)).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)),
                                          pa.array(moments.ravel())], names=["i", "j", "value"])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(np.full(k, -1, np.int32)),
                                          pa.array(total)], names=["i", "j", "value"])
    return sums


def covariance(distinct: DataFrame, n: int, mean: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Of the vectors ``x`` times ``weights``; as many numbers as its square and
    its side reach the driver."""
    parts = distinct.select("x").mapInArrow(_spread(mean, weights), "i int, j int, value double")
    t = parts.groupBy("i", "j").agg(F.sum("value").alias("value")).toArrow()
    i, j, value = (t.column(c).to_numpy() for c in ("i", "j", "value"))
    k = weights.shape[1]
    moments, total = np.zeros((k, k)), np.zeros(k)
    inner = j >= 0
    moments[i[inner], j[inner]] = value[inner]
    total[i[~inner]] = value[~inner]
    return moments / n - np.outer(total / n, total / n)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Exact sums of a task: rows (i, high halves, low halves, vectors)."""
    high = low = n = 0
    for batch in batches:
        if batch.num_rows:
            x = _rows(batch.column(0), np.int64)
            high, low, n = high + (x >> 32).sum(axis=0), low + (x & 0xFFFFFFFF).sum(axis=0), n + len(x)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(high), dtype=np.int32)), pa.array(high), pa.array(low),
                                          pa.array(np.full(len(high), n))], names=["i", "high", "low", "n"])


def totals(distinct: DataFrame) -> tuple[int, list[int]]:
    """Number of the vectors ``x`` and their exact sums."""
    parts = distinct.select("x").mapInArrow(_totals, "i int, high long, low long, n long")
    rows = parts.groupBy("i").agg(*[F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low", "n")]).collect()
    rows = sorted(rows, key=lambda r: r.i)
    return int(rows[0].n), [(int(r.high) << 32) + int(r.low) for r in rows]


def _projector(n: int, sums: list[int], mean: np.ndarray, weights: np.ndarray):
    """(vec_id, x) -> (vec_id, deviation, whitened)."""
    whole, rest = (np.array(v, np.int64) for v in zip(*[divmod(s, n) for s in sums]))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = weights.shape[1]
        for batch in batches:
            x = _rows(batch.column(1), np.int64)
            # a sum of squares that fits a long has no part beyond one
            size = (x.astype(np.float64) - mean) * n
            fits = (size * size).sum(axis=1) < 9.2e18
            d = np.where(fits[:, None], x - whole, 0) * n - np.where(fits[:, None], rest, 0)
            w = (x - mean) @ weights
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array((d * d).sum(axis=1), mask=~fits),
                 pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * k), pa.array(w.ravel()))],
                names=["vec_id", "deviation", "whitened"])
    return project


OUT = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def _whiten(rows: DataFrame, size: int, wanted: int) -> DataFrame | None:
    """The result for the vectors of one length."""
    distinct = stored(rows.select("x").distinct(), "whitening-distinct")
    n, sums = totals(distinct)
    mean = np.array([s / n for s in sums])
    v = covariance(distinct, n, mean, np.eye(size))
    trace = float(np.trace(v))
    values, vectors = components(v, min(wanted, size))
    kept = values > size * EPS * max(trace, 0.0)  # no component of the null space
    values, vectors = values[kept], vectors[:, kept]
    if not len(values):
        return None
    weights = vectors / np.sqrt(values)
    error = float(np.abs(covariance(distinct, n, mean, weights) - np.eye(len(values))).max())
    out = rows.select("vec_id", "x").mapInArrow(
        _projector(n, sums, mean, weights), "vec_id long, deviation long, whitened array<double>")
    shares = F.array(*[F.lit(float(e) / trace) for e in values])
    out = out.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return out.select("vec_id", (F.col("place") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation",
                      "whitened", F.get(shares, F.col("place")).alias("explained"),
                      F.lit(error).alias("identity_error"))


def whiten(vectors: DataFrame, wanted: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of
    (vec_id, embedding): a row for every vector and component.

    Vectors that are null or hold null or non-finite entries are dropped.  Entries
    c become whole numbers floor(64 c) + 1000000 (floors stop at 2^61 either way).  Repeated rows and null ids keep
    their rows; equal vectors count once in the fit.  Vectors of another length are
    whitened among themselves (a table has few lengths).  Components without variance
    are left out, so a single vector, equal vectors and empty ones give no rows.  A
    deviation beyond a long is null.  Other columns are ignored.
    """
    v = vectors.select(F.col("vec_id").cast("long").alias("vec_id"),
                       F.col("embedding").cast("array<double>").alias("e"))
    finite = F.forall("e", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    most = F.lit(1 << 61)
    x = F.transform("e", lambda c: F.greatest(-most, F.least(most, F.floor(c * SCALE))) + OFFSET)
    spark = vectors.sparkSession

    def build() -> DataFrame:
        rows = stored(v.where(F.coalesce(finite, F.lit(False))).select("vec_id", x.alias("x")), "whitening-rows")
        sizes = sorted(r[0] for r in rows.select(F.size("x")).distinct().collect())
        parts = [_whiten(rows.where(F.size("x") == size), size, wanted) for size in sizes if size]
        out = None
        for part in parts:
            if part is not None:
                out = part if out is None else out.union(part)
        empty = spark.createDataFrame([], "vec_id long, component int, n long, deviation long, whitened double, "
                                          "explained double, identity_error double")
        return empty if out is None else out
    return settle(spark, "whitening", build)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding")).select(*OUT)
