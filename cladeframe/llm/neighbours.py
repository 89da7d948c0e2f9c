"""Approximate nearest neighbours by one small-world graph per shard (operator 11).

Rows are dealt by hash into shards of a bounded number of rows, each of which a task turns
into a graph (see smallworld) and writes as rows of flat arrays: a node, its level, its
vector, the ids that have this vector, and its neighbours, level by level. A search sends
every query to every shard, and every shard's graph to as many tasks as its queries need;
a task reads its graph first and then streams queries past it. Each shard's best are
scored again in double precision on the original vectors; Spark ranks them across shards.
Nothing is gathered beyond a shard or a batch of queries, and equal vectors are one node,
so that a hot vector neither fills the neighbours of its copies nor hides other rows.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeframe.llm import smallworld
from cladeframe.llm.vectors import lists, matrix, usable
from cladeframe.session import read_table, stage

SHARD_ROWS = 8_192  # some 700 bytes each while searched; larger shards mean fewer searches
QUERY_ROWS = 65_536  # that one task sends past a graph
BUILD_WIDTH, SEARCH_WIDTH = 64, 200  # of beams; the latter sets recall
_NODE = "shard int, node int, level int, ids array<long>, v array<double>, links array<int>"


def _vectors(df: DataFrame, column: str, key: str) -> DataFrame:
    """(vec_id, v) of usable rows with an id and an entry that isn't zero; repeated rows once."""
    some = F.exists("v", lambda x: x != 0)
    return usable(df, column, key).where(F.col("vec_id").isNotNull() & some).dropDuplicates(["vec_id", "v"])


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Batches of sorted rows, cut where a key changes."""
    for b in batches:
        if not b.num_rows:
            continue
        values = np.column_stack([b.column(k).to_numpy().astype(np.int64) for k in keys])
        cuts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1), b.num_rows]
        for a, z in zip(cuts[:-1], cuts[1:], strict=True):
            yield tuple(int(x) for x in values[a]), b.slice(a, z - a)


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """All rows of a key at once, for keys of a bounded number of rows."""
    now, held = None, []
    for key, part in _runs(batches, keys):
        if key != now and held:
            yield now, pa.Table.from_batches(held)
            held = []
        now = key
        held.append(part)
    if held:
        yield now, pa.Table.from_batches(held)


def _table_matrix(table: pa.Table, dim: int) -> np.ndarray:
    return matrix(table.column("v").combine_chunks(), dim)


def index(df: DataFrame, column: str = "embedding", key: str = "vec_id", shard_rows: int = SHARD_ROWS, width: int = BUILD_WIDTH) -> tuple[DataFrame, int]:
    """(nodes, number of shards). nodes: shard, node, level, ids (rising), v, links.

    links: 2 * LINKS neighbours at the lowest level, then LINKS at each level up to the node's
    own, -1 where there are fewer. Vectors of different lengths are graphs of their own.
    """
    vectors = stage(_vectors(df, column, key), "vectors")
    shards = max(1, math.ceil(vectors.count() / shard_rows))

    def graph(dim: int, table: pa.Table) -> tuple[list, np.ndarray]:
        x, node = np.unique(_table_matrix(table, dim), axis=0, return_inverse=True)
        ids = table.column("vec_id").to_numpy()
        order = np.lexsort((ids, node))
        by_node = np.split(ids[order], np.cumsum(np.bincount(node))[:-1])
        # A level follows from the node's least id, so that every run builds the same graph.
        u = (np.array([i[0] for i in by_node]).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(11)).astype(float) / (1 << 53)
        level = smallworld.levels(u)
        order = np.argsort(-level, kind="stable")
        level, x, by_node = level[order], x[order], [by_node[i] for i in order]
        g = smallworld.build(smallworld.same_norm(x), level, width)
        links = [np.concatenate([g.links[a][i] for a in range(level[i] + 1)]) for i in range(len(x))]
        return [by_node, level, links], x

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (shard, dim), table in _grouped(batches, ["shard", "dim"]):
            (ids, level, links), x = graph(dim, table)
            for a in range(0, len(x), 4096):
                b = min(a + 4096, len(x))
                nodes = np.arange(a, b, dtype=np.int32)
                cols = [pa.array(np.full(b - a, shard, np.int32)), pa.array(nodes), pa.array(level[a:b].astype(np.int32)), pa.array(ids[a:b], pa.list_(pa.int64())), lists(x[a:b]), pa.array(links[a:b], pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(cols, names=["shard", "node", "level", "ids", "v", "links"])

    dealt = vectors.select("vec_id", "v", F.pmod(F.xxhash64("vec_id", "v"), F.lit(shards)).cast("int").alias("shard"), F.size("v").alias("dim"))
    dealt = dealt.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "dim")
    return stage(dealt.mapInArrow(build, _NODE), "graphs"), shards


def _graph(table: pa.Table, dim: int) -> tuple[smallworld.Graph, np.ndarray, np.ndarray, np.ndarray]:
    """(graph, vectors, ids, first[i]:first[i + 1] the ids of node i) of a shard's rows in the order of nodes."""
    x, level = _table_matrix(table, dim), table.column("level").to_numpy()
    flat = table.column("links").combine_chunks()
    start = flat.offsets.to_numpy() - flat.offsets[0].as_py()
    flat, links = flat.flatten().to_numpy(), []
    for at in range(int(level[0]) + 1):
        n, wide = int((level >= at).sum()), smallworld.LINKS * (1 if at else 2)
        skip = 0 if not at else smallworld.LINKS * (at + 1)
        links.append(flat[start[:n, None] + skip + np.arange(wide)])
    ids = table.column("ids").combine_chunks()
    return smallworld.Graph(smallworld.same_norm(x), links), x, ids.flatten().to_numpy(), ids.offsets.to_numpy() - ids.offsets[0].as_py()


def _best(graph, x, ids, first, own: np.ndarray, q: np.ndarray, k: int, width: int) -> tuple[np.ndarray, ...]:
    """(row of q, id, score) of the k best of each query's nodes, without rows of the query's id."""
    out = []
    for a in range(0, len(q), smallworld.CHUNK):
        part = q[a : a + smallworld.CHUNK]
        found = graph.search(smallworld.as_queries(part), min(width, len(x)))[0]
        r, c = np.nonzero(found >= 0)
        node = found[r, c]
        score = (x[node] * part[r]).sum(axis=1)
        many = np.minimum(first[node + 1] - first[node], k + 1)  # of equal vectors no more can be among the best
        at = np.repeat(first[node] - np.cumsum(many) + many, many) + np.arange(many.sum())
        r, score, vec = np.repeat(r, many), np.repeat(score, many), ids[at]
        other = vec != own[a + r]
        r, score, vec = r[other], score[other], vec[other]
        order = np.lexsort((vec, -score, r))
        r, score, vec = r[order], score[order], vec[order]
        near = np.arange(len(r)) - np.searchsorted(r, r) < k
        out.append((a + r[near], vec[near], score[near]))
    return tuple(np.concatenate(z) for z in zip(*out, strict=True))


def _task(k: int, width: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, ready = None, [], None
        for (place, dim, kind), part in _runs(batches, ["place", "dim", "kind"]):
            if (place, dim) != now:
                now, held, ready = (place, dim), [], None
            if kind == 0:  # nodes come first
                held.append(part)
                continue
            if ready is None and held:
                ready, held = _graph(pa.Table.from_batches(held), dim), []
            if ready is None:
                continue  # no row has a vector of this length
            own = part.column("node").to_numpy()
            q = matrix(part.column("v"), dim)
            r, vec, score = _best(*ready, own, q, k, width)
            yield pa.RecordBatch.from_arrays([pa.array(own[r]), pa.array(part.column("mark").to_numpy()[r]), pa.array(vec), pa.array(score)], names=["query_id", "mark", "vec_id", "score"])

    return run


def search(nodes: DataFrame, shards: int, queries: DataFrame, k: int = 20, width: int = SEARCH_WIDTH, column: str = "embedding", key: str = "vec_id", query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank from 1, vec_id, score): each query's k nearest by inner product.

    Candidates are all indexed rows with another id than the query's, of its vector's length.
    Rows without an id, and null, zero or not finite vectors, are neither queries nor
    candidates. Repeated rows count once; rows of one id with different vectors are queries
    (and candidates of others) of their own. Ties go to the smaller id. Fewer than k
    candidates are all returned; no queries or no candidates give no rows. Columns besides
    the id and the vector are ignored.
    """
    asked = stage(_vectors(queries, column, key), "queries")
    parts = max(1, math.ceil(asked.count() / query_rows))
    # What a query and a node have in common is one schema: its id or number is `node`.
    q = asked.select(F.col("vec_id").alias("node"), F.xxhash64("v").alias("mark"), F.lit(None).cast("int").alias("level"), F.lit(None).cast("array<long>").alias("ids"), "v", F.lit(None).cast("array<int>").alias("links"), F.lit(1).alias("kind"), F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int").alias("part"))
    q = q.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    n = nodes.select(F.col("node").cast("long").alias("node"), F.lit(0).cast("long").alias("mark"), "level", "ids", "v", "links", F.lit(0).alias("kind"), "shard")
    n = n.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    both = n.unionByName(q).withColumns({"place": F.col("shard") * parts + F.col("part"), "dim": F.size("v")}).drop("shard", "part")
    dealt = both.repartitionById(shards * parts, F.col("place")).sortWithinPartitions("place", "dim", "kind", "node")
    found = dealt.mapInArrow(_task(k, width), "query_id long, mark long, vec_id long, score double")
    order = Window.partitionBy("query_id", "mark").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op11_small_world_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(*index(rows), rows.where("vec_id % 20 = 0"))


QUERIES = {"op11_small_world_search": op11_small_world_search}
ORACLES: dict[str, str] = {}
