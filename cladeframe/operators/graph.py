"""Connected components and cluster statistics over an undirected edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeframe.operators.ranking import dense_ids
from cladeframe.session import stage


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge; component = smallest node.

    Alternating large-star and small-star contraction: each round links a node's
    neighbours to their smallest one, so the number of rounds is logarithmic. Hubs
    are only aggregated by min() and joined, never gathered into one row. Each
    round is written to the shared folder. Null ends and self loops link nothing;
    a node with only a self loop is its own component.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a is not null and b is not null")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    links = stage(
        pairs.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links"
    )
    before = None
    while True:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e"))
        links = stage(small.select("e.*").where("a <> b").distinct(), "links")
        now = links.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
        if now == before:
            break
        before = now
    return nodes.join(links.withColumnsRenamed({"a": "node", "b": "component"}), "node", "left").select(
        "node", F.coalesce("component", "node").alias("component")
    )


def cluster_edges(edges: DataFrame, components: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """The edges with the component (cid) that they belong to, self loops included."""
    return edges.join(components.select(F.col("node").alias(a), F.col("component").alias("cid")), a)


def cluster_stats(edges: DataFrame, components: DataFrame, classes: DataFrame | None = None, a: str = "a", b: str = "b") -> DataFrame:
    """cid, n_nodes, n_edges, sum_dist, avg_dist, n_classes, classes, unclassified per component.

    edges has a column dist, summed to 12 places and so alike in any order; classes (node, class) may come from any expression or UDF,
    and nodes without a class there count as one more class and make a cluster unclassified.
    Without classes, all nodes are of class '1'. A node has one class."""
    named = components.withColumn("class", F.lit("1")) if classes is None else components.join(classes, "node", "left")
    nodes = named.groupBy(F.col("component").alias("cid")).agg(
        F.count("*").alias("n_nodes"), F.array_sort(F.collect_set("class")).alias("classes"), F.bool_or(F.col("class").isNull()).alias("unclassified")
    )
    sums = cluster_edges(edges, components, a, b).groupBy("cid").agg(F.count("*").alias("n_edges"), F.sum(F.col("dist").cast("decimal(28,12)")).cast("double").alias("sum_dist"))
    return nodes.join(sums, "cid").select("cid", "n_nodes", "n_edges", "sum_dist", (F.col("sum_dist") / F.col("n_edges")).alias("avg_dist"), (F.size("classes") + F.col("unclassified").cast("int")).alias("n_classes"), "classes", "unclassified")


def clustering_summary(stats: DataFrame, *by: str) -> DataFrame:
    """One row over cluster_stats(), or one for each value of `by`: counts, the global share of
    closed pairs, and least, largest and mean of the closed share, mean distance, nodes, edges
    and classes of the clusters; bogus tells whether a cluster has a node of no class."""
    pairs = F.col("n_nodes") * (F.col("n_nodes") - 1) / 2
    s = stats.withColumn("pairs", pairs).withColumn("tcc", F.try_divide(F.col("n_edges"), F.col("pairs")))
    spread = [
        f(c).alias(f"{n}_{c}")
        for c in ("tcc", "avg_dist", "n_nodes", "n_edges", "n_classes")
        for n, f in (("min", F.min), ("max", F.max), ("avg", F.avg))
    ]
    return s.groupBy(*by).agg(
        F.count("*").alias("n_clusters"), F.sum("n_nodes").alias("sum_nodes"), F.sum("n_edges").alias("sum_edges"),
        F.try_divide(F.sum("n_edges"), F.sum("pairs")).alias("global_tcc"), *spread,
        F.coalesce(F.bool_or("unclassified"), F.lit(False)).alias("bogus"),
    )


def spanning_forest(edges: DataFrame, *order: str, a: str = "a", b: str = "b") -> DataFrame:
    """The edges of the minimum spanning forest, by the order of the given columns and then the
    ends, and every node's first self loop. All columns of edges stay.

    Boruvka's rounds: each component takes the least edge that leaves it, which is in the forest;
    components joined by these become one, edges inside of one go, and of those between the
    same two the least stays. So rounds are logarithmic and edges fewer in each. Every node's
    least edge is in the forest, and the clusters of all edges up to any place in the order are
    those of the forest's edges up to it. Null ends link nothing."""
    whole = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    low, high = F.least(a, b), F.greatest(a, b)
    rank = F.struct(*order, low.alias("_low"), high.alias("_high"))
    least = whole.select(low.alias("x"), high.alias("y"), rank.alias("w")).groupBy("x", "y").agg(F.min("w").alias("w"))
    left = stage(least, "least-edges")
    chosen = left.where("x = y").select("w")
    left = left.where("x <> y")
    while not left.isEmpty():
        ends = left.select(F.col("x").alias("c"), "x", "y", "w").union(left.select(F.col("y").alias("c"), "x", "y", "w"))
        taken = stage(ends.groupBy("c").agg(F.min_by(F.struct(F.when(F.col("c") == F.col("x"), F.col("y")).otherwise(F.col("x")).alias("p"), "w"), "w").alias("e")).select("c", "e.*"), "taken")
        chosen = chosen.union(taken.select("w"))
        joined = _roots(taken.select("c", "p"))
        to = lambda c, n: joined.select(F.col("c").alias(c), F.col("p").alias(n))
        # Every component with an edge that leaves it has taken one, and so is among the joined.
        moved = left.join(to("x", "x2"), "x").join(to("y", "y2"), "y").where("x2 <> y2")
        left = stage(moved.groupBy(F.least("x2", "y2").alias("x"), F.greatest("x2", "y2").alias("y")).agg(F.min("w").alias("w")), "least-edges")
    chosen = stage(chosen.distinct(), "forest")
    return whole.join(chosen, rank == F.col("w"), "left_semi").dropDuplicates([a, b, *order])


def _roots(parents: DataFrame) -> DataFrame:
    """(c, p): p is the root of c's tree, where each c points to one p and the two at the top to each
    other; the lesser of these is the root. Pointers double, so rounds go by the logarithm of depth."""
    up = lambda: parents.select(F.col("c").alias("p"), F.col("p").alias("pp"))
    mutual = (F.col("pp") == F.col("c")) & (F.col("c") < F.col("p"))
    parents = stage(parents.join(up(), "p").select("c", F.when(mutual, F.col("c")).otherwise(F.col("p")).alias("p")), "parents")
    while True:
        jumped = stage(parents.join(up(), "p").select("c", F.col("pp").alias("p"), (F.col("p") != F.col("pp")).alias("moved")), "parents")
        parents = jumped.select("c", "p")
        if jumped.where("moved").isEmpty():
            return parents


def forest_clusters(forest: DataFrame, limits: int, a: str = "a", b: str = "b", limit: str = "_limit") -> DataFrame:
    """(limit, node, component) at limits 0 to limits - 1, of the forest's edges whose number in the
    column `limit` is that or less. All limits are clustered in the same rounds, on at most an
    edge per node and limit, however many edges there were."""
    at = forest.withColumn("_at", F.explode(F.sequence(F.col(limit), F.lit(limits - 1))))
    found = connected_components(at.select(F.struct("_at", F.col(a).alias("n")).alias("a"), F.struct("_at", F.col(b).alias("n")).alias("b")))
    return found.select(F.col("node._at").alias(limit), F.col("node.n").alias("node"), F.col("component.n").alias("component"))


def stats_at_limits(edges: DataFrame, clusters: DataFrame, classes: DataFrame | None, limits: int, a: str = "a", limit: str = "_limit") -> DataFrame:
    """cluster_stats() at every limit. Edges (with their limit's number) are summed by node once
    and added up along the limits there, so that each is read once for all limits."""
    named = clusters.withColumn("class", F.lit("1")) if classes is None else clusters.join(classes, "node", "left")
    nodes = named.groupBy(limit, F.col("component").alias("cid")).agg(
        F.count("*").alias("n_nodes"), F.array_sort(F.collect_set("class")).alias("classes"), F.bool_or(F.col("class").isNull()).alias("unclassified")
    )
    own = edges.groupBy(F.col(a).alias("node"), limit).agg(F.count("*").alias("n"), F.sum(F.col("dist").cast("decimal(28,12)")).alias("d"))
    later = own.withColumn(limit, F.explode(F.sequence(F.col(limit), F.lit(limits - 1))))  # an edge counts at its limit and all beyond
    by_node = later.groupBy("node", limit).agg(F.sum("n").alias("n"), F.sum("d").alias("d"))
    sums = by_node.join(clusters, [limit, "node"]).groupBy(limit, F.col("component").alias("cid")).agg(F.sum("n").alias("n_edges"), F.sum("d").cast("double").alias("sum_dist"))
    return nodes.join(sums, [limit, "cid"]).select(limit, "cid", "n_nodes", "n_edges", "sum_dist", (F.col("sum_dist") / F.col("n_edges")).alias("avg_dist"), (F.size("classes") + F.col("unclassified").cast("int")).alias("n_classes"), "classes", "unclassified")


def _summaries(edges: DataFrame, classes: DataFrame | None, limits: int, order: tuple[str, ...], a: str, b: str) -> DataFrame:
    """clustering_summary() of the edges up to each limit, by _limit, from one forest."""
    forest = stage(spanning_forest(edges, *order, a=a, b=b), "spanning-forest")
    clusters = stage(forest_clusters(forest, limits, a, b), "clusters-at-limits")
    rows = clustering_summary(stats_at_limits(edges, clusters, classes, limits, a), "_limit")
    every = edges.sparkSession.range(limits).select(F.col("id").cast("int").alias("_limit"))
    return every.join(rows, "_limit", "left").fillna(0, ["n_clusters"]).fillna(False, ["bogus"])


def threshold_sweep(edges: DataFrame, classes: DataFrame | None, limits: list[float], a: str = "a", b: str = "b") -> DataFrame:
    """clustering_summary() of the edges up to each limit, with the limit as distance: one spanning
    forest and one run of clustering for all limits, which are listed by the caller."""
    rising = sorted({float(x) for x in limits})
    place = F.size(F.filter(F.array(*map(F.lit, rising)), lambda x: x < F.col("dist")))
    own = stage(edges.where(F.col("dist") <= rising[-1]).withColumn("_limit", place), "edges-to-limits")
    at = F.array(*map(F.lit, rising))
    return _summaries(own, classes, len(rising), ("dist",), a, b).withColumn("distance", F.get(at, F.col("_limit"))).drop("_limit")


def sampled_summaries(edges: DataFrame, classes: DataFrame | None, every: int, *order: str, a: str = "a", b: str = "b") -> DataFrame:
    """clustering_summary() of the first edges in order, after each `every` of them, with n_seen
    and the distance of the last one, from one spanning forest. Its clusters have a row per
    node and sample, so choose `every` for some samples, not for one per edge. Fewer edges
    than that give no rows."""
    numbered = stage(dense_ids(edges, *order, name="_nth"), "numbered-edges")
    samples = numbered.count() // every
    own = numbered.withColumn("_limit", F.floor((F.col("_nth") - 1) / every).cast("int")).where(F.col("_limit") < samples)
    rows = _summaries(own, classes, samples, ("_nth",), a, b)
    last = own.where(F.col("_nth") % every == 0).select("_limit", F.col("_nth").cast("long").alias("n_seen"), F.col("dist").alias("distance"))
    return rows.join(last, "_limit").drop("_limit")


def transitively_closed(stats: DataFrame, n_genomes: int) -> DataFrame:
    """Clusters with an edge for every pair of nodes, in all genomes of the result."""
    return stats.where((F.col("n_edges") >= F.col("n_nodes") * (F.col("n_nodes") - 1) / 2) & (F.col("n_classes") == n_genomes))
