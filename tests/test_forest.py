"""One spanning forest against clustering anew at every limit."""

import random

import pytest
from pyspark.sql import functions as F

from cladeframe.operators import graph, ranking, rsd


def least_forest(edges):
    """Kruskal's, by (dist, smaller end, larger end)."""
    root, out = {}, set()

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for d, lo, hi in sorted({(d, min(a, b), max(a, b)) for a, b, d in edges if a != b and None not in (a, b)}):
        if find(lo) != find(hi):
            root[find(lo)] = find(hi)
            out.add((d, lo, hi))
    return out


def table(spark, edges):
    return spark.createDataFrame(edges, "q int, s int, dist double").repartition(3)


def random_edges(seed, nodes, n):
    r = random.Random(seed)
    return [(r.randrange(nodes), r.randrange(nodes), r.randrange(12) / 10) for _ in range(n)]


CASES = {
    "sparse": random_edges(0, 60, 40),
    "dense, ties": random_edges(1, 25, 150),
    "falling path": [(i, i + 1, 1 - i / 100) for i in range(40)],
    "star and loops": [(0, i, i / 50) for i in range(1, 30)] + [(7, 7, 0.5), (99, 99, 0.1)],
    "nulls": [(1, None, 0.1), (None, 2, 0.2), (3, 4, 0.3)],
    "none": [],
}


@pytest.mark.parametrize("name", CASES)
def test_forest_is_minimal(spark, name):
    edges = CASES[name]
    got = [(r.dist, min(r.q, r.s), max(r.q, r.s)) for r in graph.spanning_forest(table(spark, edges), "dist", a="q", b="s").collect()]
    assert {g for g in got if g[1] != g[2]} == least_forest(edges) and all(a in {x[0] for x in edges} for _, a, b in got if a == b)


def anew(spark, edges, classes, limit):
    some = edges.where(F.col("dist") <= limit)
    stats = graph.cluster_stats(some, graph.connected_components(some, "q", "s"), classes, "q", "s")
    return graph.clustering_summary(stats)


def near(a, b):
    assert set(a) == set(b)
    for k in a:
        assert a[k] == b[k] or abs(a[k] - b[k]) < 1e-9, (k, a[k], b[k])


@pytest.mark.parametrize("name", ["sparse", "star and loops"])
def test_limits_are_those_of_clustering_anew(spark, name):
    own = table(spark, CASES[name])
    classes = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(50)], "node int, class string")
    limits = [0.05, 0.3, 0.8]
    got = {r.distance: r.asDict() for r in graph.threshold_sweep(own, classes, limits, "q", "s").collect()}
    assert sorted(got) == limits
    for limit in limits:
        near({k: v for k, v in got[limit].items() if k != "distance"}, anew(spark, own, classes, limit).first().asDict())


def test_twenty_samples_are_those_of_clustering_anew(spark):
    own = table(spark, [(a, b, d + i / 1000) for i, (a, b, d) in enumerate(random_edges(3, 40, 100))])
    got = sorted(graph.sampled_summaries(own, None, 5, "dist", a="q", b="s").collect(), key=lambda r: r.n_seen)
    assert [r.n_seen for r in got] == list(range(5, 101, 5))
    for r in got[::6]:
        near({k: v for k, v in r.asDict().items() if k not in ("n_seen", "distance")}, anew(spark, own, None, r.distance).first().asDict())
    assert graph.sampled_summaries(own, None, 101, "dist", a="q", b="s").count() == 0


# Looking sequences up


def most_shared(queries, genes, k):
    grams = lambda s: {s[i : i + k] for i in range(len(s) - k + 1)} if s else set()
    out = {}
    for q, s in queries:
        equal = [g for g, t in genes if t == s and s is not None]
        shared = [(-len(grams(s) & grams(t)), g) for g, t in genes]
        if equal:
            out[q] = min(equal)
        elif min(shared)[0]:
            out[q] = min(shared)[1]
    return out


@pytest.mark.parametrize("common", [1, 4, 1000])
def test_lookup_is_that_of_all_kmers(spark, common):
    """Of low complexity, where common k-mers decide, and of random letters."""
    r = random.Random(4)
    text = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    genes = [(i, "a" * r.randrange(2, 30)) for i in range(30)] + [(100 + i, text("ab", 12)) for i in range(40)] + [(200 + i, "aaaa" + text("abcd", 9)) for i in range(40)] + [(300, None), (301, ""), (302, "b" * 9)]
    queries = [(i, "a" * r.randrange(2, 40)) for i in range(10)] + [(50 + i, text("ab", 10)) for i in range(10)] + [(70 + i, "aaaa" + text("abcd", 7)) for i in range(20)] + [(95, genes[80][1]), (96, None), (97, "zzzzzz")]
    got = rsd.lookup_sequence(spark.createDataFrame(queries, "query int, seq string"), spark.createDataFrame(genes, "gene int, seq string"), 3, common)
    assert {x["query"]: x.gene for x in got.collect()} == most_shared(queries, genes, 3) and got.count() == len({x["query"] for x in got.collect()})


def test_lookup_of_text_ids(spark):
    genes = spark.createDataFrame([("g10", "aaaab"), ("g9", "aaaac"), ("x", None)], "gene string, seq string")
    queries = spark.createDataFrame([("q", "aaaa"), ("r", "aaac"), ("s", "zzz")], "query string, seq string")
    got = {x["query"]: x.gene for x in rsd.lookup_sequence(queries, genes, 3).collect()}
    assert got == {"q": "g10", "r": "g9"}  # of equal ones the smaller as text


def test_dense_ids_are_what_samples_count_by(spark):
    rows = ranking.dense_ids(spark.range(20), "id", name="n").collect()
    assert sorted((r.id + 1, r.n) for r in rows) == [(i, i) for i in range(1, 21)]
