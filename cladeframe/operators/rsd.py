"""Reciprocal smallest distance over precomputed hits, and sequence lookup."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeframe.session import stage


BLOCK_ROWS = 1 << 15  # vectors of one side that a task compares with as many of another genome
BUNCH_ROWS = 1 << 13  # points of ranges that a task looks up together
CHUNK = 1 << 22  # distances that a task holds at a time


def vector_hits(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(qid, qdb, sid, sdb, dist), qdb < sdb: hits between genes of different genomes that are the
    nearest of either one among a block of vectors, by the Euclidean distance rounded to 6 places;
    of equal ones the smaller id's.

    vectors (gene, genome, vector). Every pair of genomes is compared in full, as in an
    all-pairs comparison of sequences: genomes are cut into blocks, each pair of blocks is one
    matrix product, and only nearest candidates leave it. So a gene's nearest hit in each
    other genome is among the rows, which is all that reciprocal hits need. Rows without a
    gene, genome or vector, and vectors of another length than the block's first, are an error.

    A vector is sent to as many tasks as there are blocks of other genomes, so that large blocks
    shuffle less; floats go as floats."""
    narrow = vectors.schema["vector"].dataType.simpleString() == "array<float>"
    v = vectors.select("gene", "genome", (F.col("vector") if narrow else F.col("vector").cast("array<double>")).alias("v"))
    n = F.greatest(F.lit(1), F.ceil(F.count("*") / block_rows)).cast("int")
    sizes = stage(v.groupBy("genome").agg(n.alias("blocks")), "blocks")
    dealt = stage(v.join(sizes, "genome").withColumn("block", F.pmod(F.xxhash64("gene"), F.col("blocks")).cast("int")).drop("blocks"), "dealt-vectors")
    one = lambda db, i: sizes.select(F.col("genome").alias(db), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias(i))
    # A row per pair of blocks: the square of the number of blocks, not of genes.
    units = stage(one("qdb", "i").join(one("sdb", "j"), F.col("qdb") < F.col("sdb")), "pairs-of-blocks")
    side = lambda db, i, k: units.join(dealt.withColumnsRenamed({"genome": db, "block": i}), [db, i]).select("qdb", "sdb", "i", "j", F.lit(k).alias("side"), "gene", "v")
    kind = vectors.schema["gene"].dataType.simpleString()
    schema = f"qid {kind}, qdb string, sid {kind}, sdb string, dist double"
    return side("qdb", "i", 0).unionByName(side("sdb", "j", 1)).groupBy("qdb", "sdb", "i", "j").applyInArrow(_nearest, schema)


def _nearest(t: pa.Table) -> pa.Table:
    """The nearest of the other side for each row of a pair of blocks."""
    t = t.sort_by("gene")
    is_b = t.column("side").to_numpy() == 1
    a, b = t.filter(pa.array(~is_b)), t.filter(pa.array(is_b))
    x, y = _matrix(a), _matrix(b)
    k, m, d = np.zeros(0, int), np.zeros(0, int), np.zeros(0)
    if len(x) and len(y):
        if x.shape[1] != y.shape[1]:
            raise ValueError("vectors differ in length")
        (to_b, d_a), (to_a, d_b) = _nearest_rows(x, y), _nearest_rows(y, x)
        k, m, d = np.concatenate([np.arange(len(x)), to_a]), np.concatenate([to_b, np.arange(len(y))]), np.concatenate([d_a, d_b])
        once = np.unique(k * len(y) + m, return_index=True)[1]  # each other's nearest come from both sides
        k, m, d = k[once], m[once], d[once]
    db = lambda c: pa.array([t.column(c)[0].as_py()] * len(k), pa.string())
    return pa.Table.from_arrays([a.column("gene").take(pa.array(k)), db("qdb"), b.column("gene").take(pa.array(m)), db("sdb"), pa.array(d)], names=["qid", "qdb", "sid", "sdb", "dist"])


def _matrix(side: pa.Table) -> np.ndarray:
    """The vectors as rows of doubles."""
    column = side.column("v").combine_chunks()
    column = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    lengths = pc.unique(pc.list_value_length(column)).to_pylist()
    if len(lengths) > 1 or None in lengths:
        raise ValueError("vectors are missing or differ in length")
    return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(side.num_rows, -1)


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.round(np.sqrt(((a - b) ** 2).sum(1)), 6)


def _nearest_rows(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the first row of y at the least rounded distance, and that distance.

    Equal rows are compared once. A matrix product bounds the distances; those that its error
    and the rounding leave open are exact differences, so that the result is that of these
    alone. Memory is that of CHUNK distances."""
    best, least = np.zeros(len(x), int), np.full(len(x), np.inf)
    if not (np.isfinite(x).all() and np.isfinite(y).all()):
        for k, row in enumerate(x):
            d = _distances(y, row)
            best[k], least[k] = d.argmin(), d.min()
        return best, least
    asked, back = _distinct(x)[::2]
    y_first = _distinct(y)[1]
    u, rows = x[asked], y[y_first]
    u2, r2 = (u**2).sum(1), (rows**2).sum(1)
    error = 4 * (x.shape[1] + 4) * np.finfo(float).eps * (u2.max() + r2.max())
    to, d_to = np.zeros(len(u), int), np.zeros(len(u))
    step = max(1, CHUNK // len(rows))
    for at in range(0, len(u), step):
        part = slice(at, at + step)
        about = u2[part, None] + r2 - 2 * (u[part] @ rows.T)
        limit = (np.sqrt(np.maximum(about.min(1) + error, 0)) + 1.001e-6) ** 2 + error
        k, m = np.nonzero(about <= limit[:, None])
        d = np.concatenate([_distances(rows[m[i : i + 65536]], u[at + k[i : i + 65536]]) for i in range(0, len(k), 65536)])
        order = np.lexsort((m, d, k))
        first = order[np.unique(k[order], return_index=True)[1]]
        to[part], d_to[part] = m[first], d[first]
    return y_first[to][back], d_to[back]


def _distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of equal rows the first one's number, in any order and in their own; each row's place in the first list."""
    if x.shape[1] == 0:
        return np.zeros(1, int), np.zeros(1, int), np.zeros(len(x), int)
    whole = np.ascontiguousarray(x).view(np.dtype((np.void, x.shape[1] * x.itemsize))).ravel()
    first, back = np.unique(whole, return_index=True, return_inverse=True)[1:]
    return first, np.sort(first), back


def value_hits(points: DataFrame, keys: list[str], limit: int, bunch_rows: int = BUNCH_ROWS) -> DataFrame:
    """(qid, qdb, sid, sdb, apart), qdb < sdb: hits between genes of different genomes by numbers. Two
    points of equal keys are as far apart as their values; a point's nearest one of each other
    genome goes out if it is at most `limit` away, of equal ones the smaller gene's.

    points (keys, gene, genome, value long). No pair of points is made: points of equal keys
    are cut into ranges of values, at least as wide as the limit, which also get what lies
    within the limit beside them. Ranges are dealt into bunches of about that many rows, and
    in a task each point is looked up among the sorted values of each genome. Points with a
    null anywhere have no hits."""
    p = points.select(*keys, "gene", "genome", F.col("value").cast("long").alias("value")).dropna()
    span = F.max("value") - F.min("value") + 1
    cut = p.groupBy(*keys).agg(F.min("value").alias("lo"), F.greatest(F.lit(limit), F.ceil(span / F.ceil(F.count("*") / bunch_rows)), F.lit(1)).cast("long").alias("width"), F.count("*").alias("n"))
    cuts = stage(cut, "value-ranges")
    total = cuts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]  # one number
    at = F.col("value") - F.col("lo")
    home = F.floor(at / F.col("width")).cast("long")
    inside = at - home * F.col("width")
    places = F.array_compact(F.array(home, F.when(inside <= limit, home - 1), F.when(F.col("width") - inside <= limit, home + 1)))
    rows = p.join(cuts.drop("n"), keys).withColumn("home", home).select(*keys, "gene", "genome", "value", "home", F.explode(places).alias("place"))
    cell = F.xxhash64(*keys, "place")
    dealt = rows.select(F.pmod(cell, F.lit(max(1, -(-total // bunch_rows)))).alias("bunch"), F.struct(*keys, "place").alias("cell"), "gene", "genome", "value", (F.col("home") == F.col("place")).alias("own"))
    # Ranges of one bunch are told apart by their text, so that any keys will do.
    dealt = dealt.withColumn("cell", F.to_json("cell"))
    kind = points.schema["gene"].dataType.simpleString()
    return dealt.groupBy("bunch").applyInArrow(lambda t: _nearest_values(limit, t), f"qid {kind}, qdb string, sid {kind}, sdb string, apart long")


def _nearest_values(limit: int, t: pa.Table) -> pa.Table:
    """For each own point of a bunch the nearest of each other genome in its range."""
    t = t.sort_by("gene")  # so that rows' numbers are in the order of genes
    cell, value = (np.unique(t.column("cell").to_numpy(zero_copy_only=False), return_inverse=True)[1], t.column("value").to_numpy())
    names, genome = np.unique(t.column("genome").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    order = np.lexsort((value, cell))
    # Places on one line for all ranges: gaps over the limit, and those between ranges, count one more than it.
    gap = np.where(np.diff(cell[order]) == 0, np.minimum(np.diff(value[order]), limit + 1), limit + 1)
    at = np.empty(len(order), np.int64)
    at[order] = np.concatenate([[0], np.cumsum(gap)])
    own = np.flatnonzero(t.column("own").to_numpy(zero_copy_only=False))
    found = []
    for g in range(len(names)):
        places, first = np.unique(at[genome == g], return_index=True)  # of equal places the smallest gene
        first = np.flatnonzero(genome == g)[first]
        asked = own[genome[own] != g]
        right = np.searchsorted(places, at[asked])
        left = np.maximum(right - 1, 0)
        right = np.minimum(right, len(places) - 1)
        dl, dr = np.abs(at[asked] - places[left]), np.abs(at[asked] - places[right])
        best = first[np.where((dl < dr) | ((dl == dr) & (first[left] < first[right])), left, right)]
        d = np.minimum(dl, dr)
        near = d <= limit
        a, b, d = asked[near], best[near], d[near]
        swap = genome[a] > g
        found.append((np.where(swap, b, a), np.where(swap, a, b), d))
    a, b, d = (np.concatenate([f[k] for f in found]) for k in range(3))
    gene, db = t.column("gene"), lambda i: pa.array(names[genome[i]].astype(object), pa.string())
    return pa.Table.from_arrays([gene.take(pa.array(a)), db(a), gene.take(pa.array(b)), db(b), pa.array(d)], names=["qid", "qdb", "sid", "sdb", "apart"])


def reciprocal_smallest_distance(forward: DataFrame, backward: DataFrame | None = None, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, qdb, sdb, qid, sid, dist) of pairs that are each other's nearest, for qdb < sdb.

    Forward hits go from genes of qdb to those of sdb, and the nearest subject of each gene
    counts; backward hits, the same rows unless given, give the nearest query of each subject.
    Ties go to the smaller id. min_by keeps one candidate per gene and task before the shuffle."""
    backward = forward if backward is None else backward
    nearest = lambda hits, gene, other, db: hits.where("qdb < sdb").groupBy(*keys, "qdb", "sdb", gene).agg(F.min(F.struct("dist", other)).alias("m"))
    fwd = nearest(forward, "qid", "sid", "sdb").select(*keys, "qdb", "sdb", "qid", F.col("m.sid").alias("sid"), F.col("m.dist").alias("dist"))
    rev = nearest(backward, "sid", "qid", "qdb").select(*keys, "qdb", "sdb", F.col("m.qid").alias("qid"), "sid")
    return fwd.join(rev, [*keys, "qdb", "sdb", "qid", "sid"])


def rsd_grid(hits: DataFrame, grid: DataFrame) -> DataFrame:
    """Reciprocal pairs for every parameter set of the grid (div, evalue, limit), of hits up to
    the limit. The nearest hit within a limit is the nearest of all or none, so pairs are
    matched once and then held to the limits."""
    return reciprocal_smallest_distance(hits).join(F.broadcast(grid), F.col("dist") <= F.col("limit")).drop("limit")  # 12 rows


def rsd_params(hits: DataFrame, params: DataFrame) -> DataFrame:
    """Reciprocal pairs for every parameter set (div, evalue, max_div, min_exponent) of hits whose
    div_needed and exponent pass it; all sets share one scan of the hits.

    Hits are dealt out once for each side, by gene and other genome, and meet the sets after
    that, so that what is shuffled is one row for each hit, however many sets it passes."""
    passes = (F.col("div_needed") <= F.col("max_div")) & (F.col("exponent") >= F.col("min_exponent"))

    def nearest(gene: str, other: str, db: str) -> DataFrame:
        dealt = hits.where("qdb < sdb").select("qid", "qdb", "sid", "sdb", "dist", "div_needed", "exponent").repartition(gene, db)
        some = dealt.join(F.broadcast(params), passes)  # 12 rows
        best = some.groupBy("div", "evalue", "qdb", "sdb", gene).agg(F.min(F.struct("dist", other)).alias("m"))
        return best.select("div", "evalue", "qdb", "sdb", gene, F.col(f"m.{other}").alias(other), F.col("m.dist").alias("dist"))

    fwd, rev = nearest("qid", "sid", "sdb"), nearest("sid", "qid", "qdb")
    return fwd.join(rev.drop("dist"), ["div", "evalue", "qdb", "sdb", "qid", "sid"])


def match_best_hits(forward: DataFrame, backward: DataFrame) -> DataFrame:
    """Forward best hits (qid, sid, div, evalue, dist) that are backward best hits too."""
    return forward.join(backward.select("qid", "sid", "div", "evalue"), ["qid", "sid", "div", "evalue"], "left_semi")


COMMON = 256  # genes beyond which a k-mer says little about one of them


def _kmers(df: DataFrame, key: str, k: int) -> DataFrame:
    """(key, kmers): the sorted distinct k-mers of seq, of rows that have any."""
    long = df.where(F.length("seq") >= k)
    all_of = F.transform(F.sequence(F.lit(1), F.length("seq") - k + 1), lambda i: F.substr("seq", i, F.lit(k)))
    return long.select(key, F.array_sort(F.array_distinct(all_of)).alias("kmers"))


def lookup_sequence(queries: DataFrame, genes: DataFrame, k: int = 6, common: int = COMMON) -> DataFrame:
    """(query, gene): the gene of the same sequence, else the one with most k-mers in common;
    ties go to the smaller id, queries that share none are left out.

    queries (query, seq), genes (gene, seq). Sequences of the same k-mers are compared as one.
    k-mers of at most `common` genes are looked up first: a query meets at most so many genes
    by each, and these genes' common k-mers are then counted in full. A gene met by none of
    them shares common k-mers alone, so at most as many as the query has; where the best one
    met has more, it is proven. What is left compares sets of common k-mers, each set once,
    however many genes or queries have it."""
    same = queries.join(genes.select("gene", F.col("seq").alias("g_seq")), F.sha1("seq") == F.sha1("g_seq")).groupBy("query").agg(F.min("gene").alias("gene"))
    own = stage(_kmers(genes, "gene", k).groupBy("kmers").agg(F.min("gene").alias("gene")), "gene-kmers")
    frequency = stage(own.select(F.explode("kmers").alias("kmer")).groupBy("kmer").agg(F.count("*").alias("df")), "kmer-frequencies")
    rare = frequency.where(F.col("df") <= common)
    asked = stage(_kmers(queries.join(same, "query", "left_anti"), "query", k).withColumn("q", F.sha2(F.array_join("kmers", ","), 256)), "query-kmers")
    q = asked.groupBy("q").agg(F.first("kmers").alias("kmers"))
    rows = lambda df, key: df.select(key, F.explode("kmers").alias("kmer"))
    hot = lambda df, key: rows(df, key).join(frequency.where(F.col("df") > common), "kmer").groupBy(key).agg(F.array_sort(F.collect_list("kmer")).alias("hot"))
    hot_g, hot_q = stage(hot(own, "gene"), "common-of-genes"), stage(hot(q, "q"), "common-of-queries")
    # Genes met by rare k-mers, with all that they share.
    met = rows(q, "q").join(rare, "kmer").join(rows(own, "gene"), "kmer").groupBy("q", "gene").agg(F.count("*").alias("n"))
    with_hot = met.join(hot_q, "q", "left").join(hot_g.withColumnRenamed("hot", "g_hot"), "gene", "left")
    none = F.array().cast("array<string>")
    shared = F.size(F.array_intersect(F.coalesce("hot", none), F.coalesce("g_hot", none)))
    best = lambda df: df.groupBy("q").agg(F.min(F.struct((-F.col("n")).alias("less"), "gene")).alias("b")).select("q", (-F.col("b.less")).alias("n"), "b.gene")
    first = stage(best(with_hot.select("q", "gene", (F.col("n") + shared).alias("n"))), "best-by-rare")
    # Queries whose common k-mers alone could do as well or better.
    open_ = hot_q.join(first.select("q", F.col("n").alias("had")), "q", "left").where("had is null or had <= size(hot)").select("q", "hot")
    sets_q = stage(open_.withColumn("hq", F.sha2(F.array_join("hot", ","), 256)), "open-queries")
    sets_g = hot_g.groupBy("hot").agg(F.min("gene").alias("gene"))
    by_set = sets_q.groupBy("hq").agg(F.first("hot").alias("hot")).select("hq", F.explode("hot").alias("kmer")).join(sets_g.select("gene", F.explode("hot").alias("kmer")), "kmer")
    second = best(by_set.groupBy(F.col("hq").alias("q"), "gene").agg(F.count("*").alias("n"))).withColumnRenamed("q", "hq")
    second = sets_q.select("q", "hq").join(second, "hq").select("q", "n", "gene")
    found = asked.select("query", "q").join(best(first.unionByName(second)), "q").select("query", "gene")
    return same.unionByName(found)
