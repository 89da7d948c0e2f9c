import random

import pytest

from cladeframe.operators import graph, profiles


def union_find(edges):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {x: find(x) for x in list(root)}


@pytest.mark.parametrize("seed, n, m", [(1, 40, 30), (2, 60, 80), (3, 200, 150)])
def test_components(spark, seed, n, m):
    r = random.Random(seed)
    edges = [(r.randrange(n), r.randrange(n)) for _ in range(m)]
    got = {x.node: x.component for x in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == union_find(edges)


def test_components_shapes(spark):
    path = [(i, i + 1) for i in range(40)] + [(100, 100)] + [(200, x) for x in range(201, 240)]
    got = {x.node: x.component for x in graph.connected_components(spark.createDataFrame(path, "a long, b long")).collect()}
    assert got == union_find(path)
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
    assert graph.connected_components(spark.createDataFrame([(None, 1), (2, None)], "a long, b long")).count() == 0


def clusters(spark, edges, genome):
    e = spark.createDataFrame(edges, "a string, b string, dist double")
    classes = spark.createDataFrame(list(genome.items()), "node string, class string")
    return graph.cluster_stats(e, graph.connected_components(e), classes)


def test_transitively_closed(spark):
    genome = {"a": "1", "b": "2", "c": "3"}
    triangle = clusters(spark, [("a", "b", 1.0), ("b", "c", 2.0), ("a", "c", 3.0)], genome)
    assert triangle.first()["avg_dist"] == 2.0
    assert graph.transitively_closed(triangle, 3).count() == 1
    assert graph.transitively_closed(triangle, 4).count() == 0
    assert graph.transitively_closed(clusters(spark, [("a", "b", 1.0), ("b", "c", 2.0)], genome), 3).count() == 0
    s = graph.clustering_summary(triangle).first()
    assert (s.n_clusters, s.sum_nodes, s.sum_edges, s.global_tcc, s.bogus) == (1, 3, 3, 1.0, False)


def test_nodes_without_a_class(spark):
    e = [("a", "b", 1.0), ("b", "c", 2.0), ("x", "y", 4.0)]
    some = clusters(spark, e, {"a": "1", "b": "1", "x": "1", "y": "2"})
    assert {r.cid: (r.n_classes, r.unclassified) for r in some.collect()} == {"a": (2, True), "x": (2, False)}
    s = graph.clustering_summary(some).first()
    assert s.bogus and (s.min_avg_dist, s.max_avg_dist, s.avg_avg_dist) == (1.5, 4.0, 2.75)
    edges = spark.createDataFrame(e, "a string, b string, dist double")
    plain = graph.cluster_stats(edges, graph.connected_components(edges))
    assert {r.n_classes for r in plain.collect()} == {1} and not graph.clustering_summary(plain).first().bogus


def test_summary_of_every_nth_edge(spark):
    edges = spark.createDataFrame([(i, i + 1, i / 10) for i in range(7)], "a long, b long, dist double")
    got = graph.sampled_summaries(edges, None, 3, "dist").orderBy("n_seen").collect()
    assert [(r.n_seen, r.distance, r.sum_nodes, r.n_clusters) for r in got] == [(3, 0.2, 4, 1), (6, 0.5, 7, 1)]
    assert graph.sampled_summaries(edges, None, 8, "dist").count() == 0


def test_all_rows_stay_where_they_are(spark):
    plan = profiles.page(spark.range(50), "id", 1, 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "Limit" not in plan and "Offset" not in plan


def members(spark, profs):
    rows = [(c, f"g{i}", f"{c}.{i}") for c, p in enumerate(profs) for i, x in enumerate(p) if x == "1"]
    return spark.createDataFrame(rows, "cid int, genome string, gene string")


def test_hamming(spark):
    profs = ["110", "011", "111"]
    m = members(spark, profs)
    terms = spark.createDataFrame([("t", c) for c in range(3)] + [("u", 0)], "term string, cid int")
    got = {r.term: r.mean_hamming for r in profiles.mean_pairwise_hamming(terms, m).collect()}
    assert got["u"] == 0.0 and abs(got["t"] - (2 + 1 + 1) / 3) < 1e-9
    own = {r.term: r.mean_from for r in profiles.mean_hamming_from(terms, m, 0).collect()}
    assert own == {"t": 1.0, "u": 0.0}
    many = spark.createDataFrame([("x", c) for c in range(101)], "term string, cid int")
    assert profiles.mean_pairwise_hamming(many, members(spark, ["10"] * 101)).first()["mean_hamming"] is None


def test_matrix_and_names(spark):
    m = members(spark, ["101", "010"])
    order = profiles.genome_order(m, "g1")
    assert order == ["g1", "g0", "g2"]
    cells = {r.cid: r.cells for r in profiles.cluster_matrix(m, order).collect()}
    assert cells == {0: [[], ["0.0"], ["0.2"]], 1: [["1.1"], [], []]}
    assert {r.cid: r.profile for r in profiles.profiles(m, order).collect()} == {0: [0, 1, 1], 1: [1, 0, 0]}
    assert profiles.cluster_pivot(m, order).count() == 2
    names = spark.createDataFrame([("0.0", "first"), ("0.2", "second"), ("1.1", "")], "gene string, gene_name string")
    assert {r.cid: r.gene_name for r in profiles.best_gene_name(m, names, order, ["g2"]).collect()} == {0: "second", 1: None}


@pytest.mark.parametrize("num, size, want", [(1, 2, [0, 1]), (3, 2, [4]), (9, 2, [4]), (0, 2, [0, 1]), (1, 0, [0, 1, 2, 3, 4]), (1, "x", [0, 1, 2, 3, 4]), ("x", 2, [0, 1])])
def test_page(spark, num, size, want):
    rows = spark.range(5)
    assert [r.id for r in profiles.page(rows, "id", num, size).collect()] == want
