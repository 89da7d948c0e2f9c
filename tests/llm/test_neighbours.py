import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cladeframe.llm import neighbours, smallworld
from cladeframe.session import read_table

SF = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<float>, level int, node string, links string, v string, shard int, kind int, score double"


def table(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 0, "a", "b", "c", 1, 2, 3.0) for i, v in rows], SCHEMA).repartition(3)


def by_query(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    return out


def brute(rows, queries, k):
    usable = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)})
    own = {i: v for i, v in usable}
    out = {}
    for q in queries:
        if q not in own:
            continue
        found = sorted((-sum(float(np.float32(a)) * float(np.float32(b)) for a, b in zip(own[q], v)), i) for i, v in usable if i != q and len(v) == len(own[q]))
        if found:
            out[q] = [(n + 1, i, -s) for n, (s, i) in enumerate(found[:k])]
    return out


def close(got, want):
    assert set(got) == set(want)
    for q in want:
        assert [x[:2] for x in got[q]] == [x[:2] for x in want[q]], q
        assert np.allclose([x[2] for x in got[q]], [x[2] for x in want[q]], rtol=1e-12, atol=0)


def test_small_tables_are_exact_with_odd_rows(spark):
    r = np.random.default_rng(0)
    rows = [(i, [int(x) for x in r.integers(-9, 9, 6)]) for i in range(40)]
    rows += [(50, None), (60, []), (70, [0] * 6), (80, [1, None, 1, 1, 1, 1]), (90, [1, float("nan")] + [1] * 4), (100, [float("inf")] * 6), (None, [1] * 6)]
    rows += [(20, rows[20][1]), (120, [1, 2]), (121, [2, 3]), (140, [5])]  # repeated; two of another length; one alone
    df = table(spark, rows)
    asked = df.where("vec_id % 20 = 0")
    for shard_rows, query_rows in ((1000, 1000), (7, 2)):
        nodes, shards = neighbours.index(df, shard_rows=shard_rows)
        out = neighbours.search(nodes, shards, asked, k=5, query_rows=query_rows)
        assert out.columns == ["query_id", "rank", "vec_id", "score"]
        close(by_query(out), brute(rows, range(0, 200, 20), 5))
    # All candidates where there are fewer than k.
    assert [len(x) for x in by_query(neighbours.search(*neighbours.index(df.where("vec_id < 9")), df.where("vec_id = 0"), k=20)).values()] == [8]


def test_no_rows(spark):
    none = table(spark, [(1, [1.0])]).limit(0)
    some = table(spark, [(20, [1.0, 2.0])])
    for rows, asked in ((none, none), (some, none), (none, some), (some, some)):
        assert neighbours.search(*neighbours.index(rows), asked).count() == 0


def test_copies_are_one_node_and_ties_go_to_the_smaller_id(spark):
    """Two thirds of all rows are one vector: its copies are named by rising ids, and others are found."""
    r = np.random.default_rng(1)
    own = r.normal(size=(400, 16)).astype(np.float32)
    hot = [float(x) for x in (own[0] * 3).astype(np.float32)]
    rows = [(i, [float(x) for x in own[i]]) for i in range(400)] + [(1000 + i, hot) for i in range(800)]
    nodes, shards = neighbours.index(table(spark, rows), shard_rows=300)
    assert shards == 4 and nodes.where(F.size("ids") > 1).count() == 4
    got = by_query(neighbours.search(nodes, shards, table(spark, rows).where("vec_id in (0, 1003, 7)"), k=20))
    close(got, brute(rows, (0, 1003, 7), 20))
    assert [x[1] for x in got[1003]] == [1000, 1001, 1002, *range(1004, 1021)]


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_recall_of_inner_products(spread):
    """Norms alike and norms that differ a lot, in 24 dimensions."""
    r = np.random.default_rng(2)
    x = (r.normal(size=(3000, 24)) * np.exp(spread * r.normal(size=(3000, 1)))).astype(np.float32)
    level = smallworld.levels(r.random(3000))
    order = np.argsort(-level, kind="stable")
    x = x[order]
    g = smallworld.build(smallworld.same_norm(x), level[order])
    assert all(len(a) == (level >= at).sum() for at, a in enumerate(g.links)) and len(g.links) > 2
    q = x[::15]
    ids, _ = g.search(smallworld.as_queries(q), 200)
    true = q.astype(float) @ x.astype(float).T
    kth = -np.sort(-true, axis=1)[:, 19]
    hit = np.mean([np.sort(t[i[i >= 0]])[::-1][:20] >= k for t, i, k in zip(true, ids, kth)])
    assert hit >= 0.97
    assert all(len(set(i[i >= 0])) == (i >= 0).sum() for i in ids)


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_recall_of_the_query(spark):
    rows = read_table(spark, SF, "embeddings").select("vec_id", "embedding").toPandas()
    x = np.stack(rows.embedding.to_numpy()).astype(float)
    got = by_query(neighbours.op11_small_world_search(spark, SF))
    ids = rows.vec_id.to_numpy()
    hit = []
    for j in np.flatnonzero(ids % 20 == 0):
        s = x @ x[j]
        s[j] = -np.inf
        best = sorted(zip(-s, ids))[:20]
        hit += [y[1] in {b[1] for b in best} for y in got[ids[j]]]
    assert len(hit) == 20 * (ids % 20 == 0).sum() and np.mean(hit) >= 0.99
