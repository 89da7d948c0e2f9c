import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeframe.llm import whitening

L = np.longdouble


def turned(values, seed=0):
    """A symmetric matrix with these eigenvalues, and orthonormal vectors, in extended precision."""
    d = len(values)
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(d, d)))[0].astype(L)
    for _ in range(3):
        q = q @ (1.5 * np.eye(d, dtype=L) - 0.5 * (q.T @ q))
    a = (q * np.array(values, L)) @ q.T
    return (a + a.T) / 2, q


CASES = {
    "apart": list(np.linspace(1, 50, 40)),
    "equal": [*np.linspace(1, 50, 30), 50, 50, 50],
    "all equal": [2.0] * 20,
    "clusters": [1 + 1e-9 * i for i in range(10)] + [5 + 1e-7 * i for i in range(10)],
    "tight clusters": [1 + 1e-12 * i for i in range(10)] + [5 + 1e-10 * i for i in range(10)],
    "graded": [10.0**-i for i in range(12)],
    "rank": [0] * 12 + list(range(1, 9)),
    "one": [3.0],
}


@pytest.mark.parametrize("name", CASES)
def test_refined_beyond_double(name):
    """float32 vectors end with residuals below what double precision could give."""
    a, _ = turned(CASES[name])
    value, x = whitening.refine(a)
    size = float(np.abs(a).max())
    assert list(value) == sorted(value, reverse=True)
    assert np.abs(value - np.sort(np.array(CASES[name], L))[::-1]).max() < 1e-17 * max(CASES[name])
    assert np.abs(a @ x - x * value).max() < 2e-17 * size and np.abs(x.T @ x - np.eye(len(a))).max() < 1e-17


def test_vectors_of_separate_values():
    a, q = turned(CASES["apart"])
    _, x = whitening.refine(a)
    assert np.abs(np.abs((x[:, ::-1] * q).sum(axis=0)) - 1).max() < 1e-16
    wild = whitening.refine(a * L(1e60))  # beyond float32
    assert np.abs(wild[0] / L(1e60) - whitening.refine(a)[0]).max() < 1e-15


def table(spark, rows):
    cols = "vec_id long, embedding array<float>, component int, n string, v string, w string, at int, whitened string"
    return spark.createDataFrame([(i, v, 0, "a", "b", "c", 1, "d") for i, v in rows], cols).repartition(3)


def brute(x, components):
    """From the definition: x whole numbers; (n * x - S)'s squares, and whitened up to signs."""
    n, s = len(x), x.sum(axis=0)
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    c = (n * x - s) / n
    v = c.T @ c / n
    e, axes = np.linalg.eigh(v)
    e, axes = e[::-1][:components], axes[:, ::-1][:, :components]
    return deviation, c @ axes / np.sqrt(e), e / np.trace(v)


def test_against_numpy_with_odd_rows(spark):
    r = np.random.default_rng(3)
    x = (r.normal(size=(300, 7)) @ r.normal(size=(7, 7))).astype(np.float32)
    x[17] = x[18]
    rows = [(i, [float(y) for y in v]) for i, v in enumerate(x)] + [(None, [float(y) for y in x[5]]), (9, [float(y) for y in x[9]])]
    odd = [(1000, None), (1001, []), (1002, [1.0] * 6), (1003, [None] + [1.0] * 6), (1004, [float("nan")] + [1.0] * 6), (1005, [float("-inf")] + [1.0] * 6)]
    full = np.floor(64 * np.array([v for _, v in rows], float)).astype(np.int64) + 1_000_000
    deviation, whitened, share = brute(full, 5)
    out = whitening.whiten(table(spark, rows + odd), components=5).collect()
    assert len(out) == 5 * len(rows) and {r.n for r in out} == {len(rows)}
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-12
    sign = {}
    ids = [i for i, _ in rows]
    for got in out:
        k = got.component - 1
        at = ids.index(got.vec_id)
        assert int(got.deviation) == deviation[at] and abs(got.explained / share[k] - 1) < 1e-9
        want = whitened[at][k]
        sign.setdefault(k, np.sign(want * got.whitened)) if abs(want) > 0.1 else None
        assert abs(abs(want) - abs(got.whitened)) < 1e-8 and (abs(want) < 0.1 or np.sign(want * got.whitened) == sign[k])
    assert sorted(r.vec_id for r in out if r.component == 1 and r.vec_id is not None) == sorted([*range(300), 9])


def test_without_variance(spark):
    assert whitening.whiten(table(spark, [(1, [1.0])]).limit(0)).count() == 0
    assert whitening.whiten(table(spark, [(1, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(table(spark, [(1, []), (2, None)])).count() == 0
    # Two of three dimensions vary, alike: one component.
    out = whitening.whiten(table(spark, [(i, [float(i), 2.0 * i, 7.0]) for i in range(20)])).collect()
    assert {r.component for r in out} == {1} and len(out) == 20 and out[0].explained == 1.0
    assert whitening.whiten(table(spark, [(1, [1e30])] * 2).withColumn("embedding", F.array(F.lit(1.0), F.lit(2.0)))).count() == 0


def test_exact_at_any_size():
    r = np.random.default_rng(4)
    for top in (9, 1 << 20, 1 << 30, 1 << 40):
        y = r.integers(-top, top, (50, 6))
        assert (whitening._exact_product(y).astype(object) == y.T.astype(object) @ y.astype(object)).all()
        assert whitening._squares(y) == [sum(int(v) ** 2 for v in row) for row in y]
    y = (r.integers(-(1 << 40), 1 << 40, (5, 3)) * np.int64(1 << 20)).astype(np.int64)
    assert whitening._squares(y) == [sum(int(v) ** 2 for v in row) for row in y]
