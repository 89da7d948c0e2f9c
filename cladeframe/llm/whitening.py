"""Embedding whitening by mixed-precision refinement (operator 12).

Spark sums the exact covariance: whole-number vectors are centred on their rounded mean,
multiplied in blocks small enough that no product loses a bit, and added up as decimals by
entry. The driver gets one matrix, whose size goes by the dimension alone. Its eigenvectors
are found in float32, then corrected by the iteration of Ogita and Aishima, whose matrix
products are taken in extended precision; eigenvalues too close for that are a cluster,
within whose subspace a small eigenproblem is solved after each step. Rows are projected in
a map, and the covariance of what that gives is summed in Spark once more for its error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.llm.vectors import lists, matrix, usable, whole
from cladeframe.session import read_table

ROWS = 4_096  # multiplied at once
LARGEST = float(1 << 40)  # of a component after scaling
_L = np.longdouble


def refine(v: np.ndarray, steps: int = 12) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues falling, their unit eigenvectors as columns) of a symmetric matrix.

    v: extended precision. The start is float32's; each step of Ogita and Aishima about
    doubles the right digits, until corrections vanish in extended precision.
    """
    d = len(v)
    size = float(np.abs(v).max()) if d else 0.0
    if not size or not np.isfinite(size):
        return np.zeros(d, _L), np.eye(d, dtype=_L)
    a = v / _L(size)  # so that float32 neither overflows nor vanishes
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(_L)
    eye, norm = np.eye(d, dtype=_L), _norm(a)
    floor = d * np.finfo(_L).eps
    before = np.inf
    for _ in range(steps):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        value = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(np.diag(s))
        near = 2 * (_norm(off) + norm * _norm(r)) + floor * norm
        gap = value[None, :] - value[:, None]
        apart = np.abs(gap) > near
        e = np.where(apart, (s + value[None, :] * r) / np.where(apart, gap, 1), r / 2)
        np.fill_diagonal(e, np.diag(r) / 2)
        x = x + x @ e
        groups = _clusters(value, near)
        for group in groups:
            x[:, group] = _within(a, x[:, group])
        change = float(np.abs(e).max())
        if change <= floor or change >= before and change < 1e-12:
            break
        before = change
    for _ in range(2):  # small gaps enlarge what rounding left of products of vectors
        x = x + x @ ((eye - x.T @ x) / 2)
    value = ((a @ x) * x).sum(axis=0)  # Rayleigh quotients: twice the digits of their vectors
    order = np.argsort(-value, kind="stable")
    return value[order] * _L(size), x[:, order]


def _norm(m: np.ndarray) -> float:
    """An upper bound of the spectral norm of a symmetric matrix."""
    return float(min(np.abs(m).sum(axis=1).max(), np.sqrt((m * m).sum()))) if m.size else 0.0


def _clusters(value: np.ndarray, near: float) -> list[np.ndarray]:
    """Runs of two or more eigenvalues whose neighbours are no further apart than near."""
    order = np.argsort(value, kind="stable")
    cut = np.flatnonzero(np.diff(value[order]) > near) + 1
    return [g for g in np.split(order, cut) if len(g) > 1]


def _within(a: np.ndarray, x: np.ndarray) -> np.ndarray:
    """The basis of a cluster's subspace turned to eigenvectors there: the small problem is
    taken without its mean, so that what tells the cluster's values apart keeps its digits."""
    for _ in range(2):  # orthonormal first; twice is enough
        q = np.linalg.qr(x.astype(np.float64))[1].astype(_L)
        x = _solve_upper(x, q)
    small = x.T @ (a @ x)
    small = (small + small.T) / 2 - np.eye(len(small), dtype=_L) * (np.trace(small) / len(small))
    size = np.abs(small).max()
    if not size:
        return x
    return x @ np.linalg.eigh((small / size).astype(np.float64))[1].astype(_L)


def _solve_upper(x: np.ndarray, r: np.ndarray) -> np.ndarray:
    """x r^-1 for an upper triangular r, in extended precision."""
    out = np.empty_like(x)
    for j in range(x.shape[1]):
        out[:, j] = (x[:, j] - out[:, :j] @ r[:j, j]) / r[j, j]
    return out


def _exact_product(y: np.ndarray) -> np.ndarray:
    """y' y of whole numbers, as long or, where that is too small, as Python's numbers."""
    most = int(np.abs(y).max(initial=0))
    rows = (1 << 53) // max(most * most, 1)  # whose products floats of 53 bits add up exactly
    if rows < 1 or most * most * len(y) >= 1 << 63:
        return y.T.astype(object) @ y.astype(object)
    f = y.astype(np.float64)
    return sum(((f[k : k + rows].T @ f[k : k + rows]).astype(np.int64) for k in range(0, len(y), rows)), np.zeros((y.shape[1],) * 2, np.int64))


def _summed(df: DataFrame, run, value: str) -> dict[int, np.ndarray]:
    """Arrays that tasks give by row number, added up by Spark; one row a number comes back.
    Whole numbers add exactly as decimals."""
    parts = df.mapInArrow(run, f"i int, xs array<{value}>")
    sums = parts.select("i", F.posexplode("xs")).groupBy("i", "pos").agg(F.sum("col").alias("s"))
    out: dict[int, dict[int, object]] = {}
    for r in sums.collect():  # (dimension + 1) squared rows at most
        out.setdefault(r["i"], {})[r["pos"]] = r["s"]
    return {i: np.array([xs[p] for p in range(len(xs))], object) for i, xs in out.items()}


def _emit(rows: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.arange(len(rows), dtype=np.int32)), pa.array([list(map(int, r)) if pa.types.is_decimal(kind) else list(map(float, r)) for r in rows], pa.list_(kind))], names=["i", "xs"])


def moments(vectors: DataFrame, dim: int, scale: float, shift: int) -> tuple[int, np.ndarray]:
    """(n, S): how many vectors, and the exact sum of each dimension."""
    exact = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = 0, np.zeros(dim, object)
        for b in batches:
            x = whole(matrix(b.column("v"), dim), scale, LARGEST)
            n += len(x)
            s = s + x.sum(axis=0).astype(object)
        if n:
            yield _emit([np.append([n], s + n * shift)], exact)

    found = _summed(vectors, run, "decimal(38,0)")
    if not found:
        return 0, np.zeros(dim, object)
    whole_sum = np.array([int(x) for x in found[0]], object)
    return int(whole_sum[0]), whole_sum[1:]


def covariance(vectors: DataFrame, dim: int, scale: float, shift: int, n: int, s: np.ndarray) -> np.ndarray:
    """The covariance with divisor n, each entry exact until it is rounded once to extended precision."""
    pivot = np.array([(2 * int(x) + n) // (2 * n) - shift for x in s], np.int64)  # the rounded mean
    exact = pa.decimal128(38, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros((dim, dim), object), False
        for b in batches:
            for k in range(0, b.num_rows, ROWS):
                y = whole(matrix(b.slice(k, ROWS).column("v"), dim), scale, LARGEST) - pivot
                total = total + _exact_product(y).astype(object)
                any_rows = True
        if any_rows:
            yield _emit(list(total), exact)

    found = _summed(vectors, run, "decimal(38,0)")
    rest = [int(x) - n * (int(p) + shift) for x, p in zip(s, pivot, strict=True)]  # sums of what is centred
    v = np.empty((dim, dim), _L)
    for i in range(dim):
        for j in range(dim):
            over = n * int(found[i][j]) - rest[i] * rest[j]
            q, r = divmod(over, n * n)
            v[i, j] = _L(q) + _L(r) / _L(n * n)
    return v


def whiten(df: DataFrame, components: int = 32, scale: float = 64.0, shift: int = 1_000_000, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, component, n, deviation decimal, whitened, explained, identity_error).

    A row per usable vector and component. Usable: neither null nor with null or non-finite
    entries, and as long as most such vectors are (of equally frequent lengths the larger);
    other rows have no row and no part in the fit. Vectors become floor(scale * c) + shift.
    Every row counts by itself, repeated rows and null ids too. Directions without variance
    (up to rounding) have no component, so that one vector alone, or none, gives no rows;
    equal eigenvalues give some basis of their subspace. Columns besides the id and the vector
    are ignored. A component beyond 2**40 after scaling is an error.
    """
    spark = df.sparkSession
    schema = "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    vectors = usable(df, column, key)
    most = vectors.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if most is None or not most["dim"]:
        return spark.createDataFrame([], schema)
    dim = most["dim"]
    vectors = vectors.where(F.size("v") == dim)
    n, s = moments(vectors, dim, scale, shift)
    v = covariance(vectors, dim, scale, shift, n, s)
    value, axes = refine(v)
    trace = np.trace(v)
    kept = min(components, int((value > trace * dim * np.finfo(np.float64).eps).sum()))
    if not kept:
        return spark.createDataFrame([], schema)
    axes, share = axes[:, :kept].astype(np.float64), [float(x / trace) for x in value[:kept]]
    root = np.array(np.sqrt(value[:kept]), np.float64)
    # n * x - S, kept within a long by taking the rounded mean from both first.
    pivot = np.array([(2 * int(x) + n) // (2 * n) - shift for x in s], np.int64)
    rest = np.array([int(x) - n * (int(p) + shift) for x, p in zip(s, pivot, strict=True)], np.int64)

    def centred(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        """(n * x - S exactly, whitened) of a batch's rows."""
        y = whole(matrix(b.column("v"), dim), scale, LARGEST) - pivot
        if y.size and int(np.abs(y).max()) * n >= 1 << 62:
            d = y.astype(object) * n - rest.astype(object)
        else:
            d = y * n - rest
        return d, (d.astype(np.float64) / n) @ axes / root

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The covariance of a task's rows around their own mean, and what that mean adds to it.
        count, mean, m2 = 0, np.zeros(kept), np.zeros((kept, kept))
        for b in batches:
            if not b.num_rows:
                continue
            w = centred(b)[1]
            own = w.mean(axis=0)
            w -= own
            step, both = own - mean, count + len(w)
            m2 += w.T @ w + np.outer(step, step) * (count * len(w) / both)
            mean += step * (len(w) / both)
            count = both
        if count:
            yield _emit([*(m2 + count * np.outer(mean, mean)), count * mean], pa.float64())

    found = _summed(vectors, spread, "double")
    mean = found[kept].astype(float) / n
    error = float(np.abs(np.array([found[i] for i in range(kept)], float) / n - np.outer(mean, mean) - np.eye(kept)).max())

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            d, w = centred(b)
            yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(_squares(d), pa.decimal128(38, 0)), lists(w)], names=["vec_id", "deviation", "w"])

    rows = vectors.mapInArrow(project, "vec_id long, deviation decimal(38,0), w array<double>")
    exploded = rows.select("vec_id", "deviation", F.posexplode("w").alias("at", "whitened"))
    shares = F.array(*map(F.lit, share))
    return exploded.select("vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("long").alias("n"), "deviation", "whitened", F.get(shares, F.col("at")).alias("explained"), F.lit(error).alias("identity_error"))


def _squares(d: np.ndarray) -> list[int]:
    """The exact sum of squares of each row: whole numbers of any size, by two parts of 31 bits."""
    if d.dtype == object:
        return [int(x) for x in (d * d).sum(axis=1)]
    most = int(np.abs(d).max(initial=0))
    if most * most * d.shape[1] < 1 << 63:
        return [int(x) for x in (d * d).sum(axis=1)]
    high, low = d >> 31, d & ((1 << 31) - 1)
    parts = zip((high * high).sum(axis=1, dtype=object), (high * low).sum(axis=1, dtype=object), (low * low).sum(axis=1, dtype=object), strict=True)
    return [(int(a) << 62) + (int(b) << 32) + int(c) for a, b, c in parts]


def op12_refined_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """deviation is null where it is beyond a long."""
    out = whiten(read_table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


QUERIES = {"op12_refined_whitening": op12_refined_whitening}
ORACLES: dict[str, str] = {}
