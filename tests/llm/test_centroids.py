import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeframe.llm import centroids


def table(spark, rows):
    cols = "vec_id long, embedding array<float>, cluster string, distance string, v string, codes string, n int"
    return spark.createDataFrame([(i, v, "a", "b", "c", "d", 1) for i, v in rows], cols).repartition(3)


def brute(rows, k, rounds, dim, scale=64):
    kept = [(i, [int(np.floor(scale * float(np.float32(x)))) for x in v]) for i, v in rows if v is not None and len(v) == dim and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted(kept, key=lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    own = [list(v) for _, v in first]
    near = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), j) for j, c in enumerate(own))
    for _ in range(rounds):
        by = {}
        for _, v in kept:
            by.setdefault(near(v)[1], []).append(v)
        for j, vs in by.items():
            own[j] = [sum(c) // len(vs) for c in zip(*vs)]
    found = [(i, *near(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in own]
    return Counter((i, c, d, inertia[c], sum(inertia.values()), sha[c]) for i, c, d in found)


def rows_of(df):
    return Counter(map(tuple, df.withColumn("sha", centroids.digest(F.col("centroid"))).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "sha").collect()))


@pytest.mark.parametrize("block, shard_rows", [(1, 4096), (2, 50), (3, 7), (64, 4096)])
def test_any_blocks_and_shards_give_the_definition(spark, block, shard_rows):
    r = np.random.default_rng(0)
    rows = [(i, [float(x) for x in r.normal(size=5).astype(np.float32)]) for i in range(300)]
    assert rows_of(centroids.cluster(table(spark, rows), 6, 3, 5, block=block, shard_rows=shard_rows)) == brute(rows, 6, 3, 5)


def test_odd_rows(spark):
    rows = [(i, [float(i % 3), -0.3]) for i in range(30)]
    rows += [(5, [2.0, -0.3]), (None, [9.0, 9.0]), (None, [9.0, 9.0]), (40, None), (41, []), (42, [1.0]), (43, [1.0, None]), (44, [1.0, float("nan")]), (45, [float("inf"), 1.0]), (46, [1.0, 2.0, 3.0])]
    for k in (1, 4, 50):  # 50: more than there are; equal vectors among the first leave empty clusters
        assert rows_of(centroids.cluster(table(spark, rows), k, 3, 2)) == brute(rows, k, 3, 2)
    out = centroids.cluster(table(spark, rows).limit(0))
    assert out.count() == 0 and out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    assert rows_of(centroids.cluster(table(spark, [(3, [1.5, -1.5])]), 16, 3, 2)) == brute([(3, [1.5, -1.5])], 16, 3, 2)


def test_one_vector_holds_most_rows(spark):
    r = np.random.default_rng(1)
    rows = [(i, [0.5, 0.25, 1.0]) for i in range(2000)] + [(5000 + i, [float(x) for x in r.normal(size=3).astype(np.float32)]) for i in range(100)]
    assert rows_of(centroids.cluster(table(spark, rows), 8, 3, 3)) == brute(rows, 8, 3, 3)


def test_too_large_is_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        centroids.cluster(table(spark, [(1, [1e30, 1.0])]), 2, 1, 2).count()


def test_dictionaries_hold_each_subvector_once(spark):
    rows = table(spark, [(i, [float(i % 4), float(i % 2), 7.0]) for i in range(100)]).coalesce(1)
    shard = centroids.encode(centroids.usable(rows), 3, block=2).collect()
    assert [list(s.sizes) for s in shard] == [[4, 1]]
