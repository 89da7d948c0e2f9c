"""Nearest rows of blocks of vectors, and what is sent to tasks."""

import numpy as np
import pyarrow as pa
import pytest

from cladeframe.operators import rsd


def exact(x, y):
    d = [np.round(np.sqrt(((y - row) ** 2).sum(1)), 6) for row in x]
    return [int(r.argmin()) for r in d], [float(r.min()) for r in d]


@pytest.mark.parametrize("chunk", [1, 700, 1 << 22])
def test_nearest_rows_are_those_of_exact_differences(monkeypatch, chunk):
    """With equal rows, distances that rounding makes equal, and vectors far from the origin."""
    monkeypatch.setattr(rsd, "CHUNK", chunk)
    rnd = np.random.default_rng(3)
    base = rnd.normal(size=(60, 8)).astype("float32").astype(float)
    near = np.concatenate([base, base[::-1], base + rnd.normal(size=base.shape) * 4e-7, base * 0])
    for x, y in ((near, base[rnd.permutation(60)]), (base, near), (near + 1e6, base + 1e6), (near, near), (near[:, :0], base[:, :0])):
        best, least = rsd._nearest_rows(x, y)
        assert (list(best), list(least)) == exact(x, y)
    odd = base.copy()
    odd[3, 2] = np.nan
    assert list(rsd._nearest_rows(base, odd)[0]) == exact(base, odd)[0]


def test_vectors_of_different_lengths_are_an_error():
    for v in ([[1.0], [1.0, 2.0]], [[1.0], None]):
        with pytest.raises(ValueError):
            rsd._matrix(pa.table({"v": pa.array(v, pa.list_(pa.float32()))}))


def test_vectors_are_sent_to_few_tasks_as_floats(spark):
    """A vector went to a task for each 2,048 ones of other genomes, as doubles."""
    rows = spark.range(6000).selectExpr("id AS gene", "CAST(id % 2 AS STRING) AS genome", "array(CAST(id % 7 AS FLOAT), CAST(id % 5 AS FLOAT)) AS vector")
    found = rsd.vector_hits(rows)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "array<double>" not in plan
    assert found.count() <= 6000
    (blocks,) = {r.n for r in rows.groupBy("genome").count().selectExpr(f"greatest(1, ceil(count / {rsd.BLOCK_ROWS})) AS n").collect()}
    assert blocks == 1
