"""The user's queries: retrieve, browse, search, downloads, and the views of a result."""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.model import DEFAULT_DIVERGENCE, DEFAULT_EVALUE
from cladeframe.operators import census, dims, graph, pairs, profiles, ranking
from cladeframe.session import publish, shared_dir, stage
from cladeframe.sources import sinks


def distance_between(lower: float | None, upper: float | None):
    """Both ends included; None is open."""
    test = F.lit(True)
    if lower is not None:
        test = test & (F.col("dist") >= float(lower))
    if upper is not None:
        test = test & (F.col("dist") <= float(upper))
    return test


def orthologs_for(orthologs: DataFrame, qdb: str, sdb: str, div: str = DEFAULT_DIVERGENCE, evalue: str = DEFAULT_EVALUE) -> DataFrame:
    """One pair's orthologs at one parameter set, none where there are none; the pair is sorted first."""
    a, b = sorted((qdb, sdb))
    return orthologs.where((F.col("div") == div) & (F.col("evalue") == evalue) & (F.col("qdb") == a) & (F.col("sdb") == b))


def touching(edges: DataFrame, genes: DataFrame | None, a: str = "q", b: str = "s") -> DataFrame:
    """Edges with either end among genes (column gene); all edges if genes is None."""
    if genes is None:
        return edges
    mark = genes.select("gene").distinct()
    left = edges.join(mark.select(F.col("gene").alias(a), F.lit(True).alias("_a")), a, "left")
    both = left.join(mark.select(F.col("gene").alias(b), F.lit(True).alias("_b")), b, "left")
    return both.where("_a or _b").select(edges.columns)


@dataclass
class Result:
    """Clusters of a query: members (cid, genome, gene), stats per cluster, the edges with their
    cid, and the genomes in column order."""

    members: DataFrame
    stats: DataFrame
    edges: DataFrame
    genomes: list[str]
    description: dict = field(default_factory=dict)

    def matrix(self) -> DataFrame:
        rows = profiles.cluster_matrix(self.members, self.genomes)
        return rows.join(self.stats.select("cid", F.round("avg_dist", 6).alias("avg_dist")), "cid")

    def profiles(self) -> DataFrame:
        return profiles.profiles(self.members, self.genomes)


def orthology_query(
    edges: DataFrame, *, genome: str | None = None, limit_genomes: list[str] | None = None, genomes: list[str] | None = None,
    seq_ids: DataFrame | None = None, tc_only: bool = False, lower: float | None = None, upper: float | None = None, **description,
) -> Result:
    """Clusters of edges (q, s, qdb, sdb, dist) at one parameter set.

    Genomes are chosen as in pairs_for(); none given means all. Columns are the genomes of
    all edges within the distances; seq_ids then keeps edges that touch them, so clusters are
    what these edges join. tc_only keeps transitively closed clusters.
    """
    some = edges.where(distance_between(lower, upper))
    if genome or limit_genomes or genomes:
        wanted = pairs.pairs_for(edges.sparkSession, genome, limit_genomes, genomes)
        some = some.join(wanted, ["qdb", "sdb"], "left_semi")
    some = stage(some.select("q", "s", "qdb", "sdb", "dist"), "query-edges")
    ends = some.select(F.col("q").alias("gene"), F.col("qdb").alias("genome")).union(some.select("s", "sdb"))
    order = profiles.genome_order(ends, genome)
    kept = some if seq_ids is None else stage(touching(some, seq_ids), "touching")
    of = kept.select(F.col("q").alias("node"), F.col("qdb").alias("class")).union(kept.select("s", "sdb")).distinct()
    components = stage(graph.connected_components(kept, "q", "s"), "components")
    stats = graph.cluster_stats(kept, components, of, "q", "s")
    if tc_only:
        stats = graph.transitively_closed(stats, len(order))
    stats = stage(stats, "stats")
    members = components.join(of, "node").select(F.col("component").alias("cid"), F.col("class").alias("genome"), F.col("node").alias("gene"))
    own = graph.cluster_edges(kept, components, "q", "s")
    if tc_only:
        members, own = (x.join(stats.select("cid"), "cid", "left_semi") for x in (members, own))
    return Result(members, stats, own, order, description)


def retrieve(edges: DataFrame, dimension: DataFrame, names: list[str], tc_only: bool = False, **kw) -> Result:
    """Clusters among two or more named genomes."""
    return orthology_query(edges, genomes=dims.resolve_names(dimension, names, 2), tc_only=tc_only, **kw)


def browse(
    edges: DataFrame, dimension: DataFrame, sequences: DataFrame, primary: str, secondary: list[str], identifier: str = "", identifier_type: str = "seq_id", **kw
) -> Result:
    """Clusters of a primary genome with others, of all genes, of ids (by blanks), or of a gene name.

    A primary genome among the others, unknown genomes and names without genes raise ValueError."""
    (first,) = dims.resolve_names(dimension, [primary])
    others = dims.resolve_names(dimension, secondary)
    if first in others:
        raise ValueError("the primary genome can't be among the others")
    seq_ids = None
    if identifier.strip():
        if identifier_type == "gene_name":
            seq_ids = sequences.where((F.col("gene_name") == identifier.strip()) & (F.col("genome") == first)).select("gene").distinct()
            if seq_ids.isEmpty():
                raise ValueError(f"no gene named {identifier.strip()!r} in {primary}")
        elif identifier_type == "seq_id":
            kind = sequences.schema["gene"].dataType
            seq_ids = edges.sparkSession.createDataFrame([(x,) for x in identifier.split()], "gene string").select(F.col("gene").cast(kind))
        else:
            raise ValueError(f"unknown identifier type {identifier_type!r}")
    return orthology_query(edges, genome=first, limit_genomes=others, seq_ids=seq_ids, **kw)


def genes_summary(result: Result, names: DataFrame, terms: DataFrame, priority: list[str] | None = None) -> DataFrame:
    """cid, gene_name, avg_dist, n_terms, profile, n_genes of each cluster."""
    name = profiles.best_gene_name(result.members, names, result.genomes, priority or [])
    n_terms = profiles.cluster_terms(result.members, terms).groupBy("cid").agg(F.count("*").alias("n_terms"))
    rows = result.profiles().join(result.stats.select("cid", F.round("avg_dist", 6).alias("avg_dist"), F.col("n_nodes").alias("n_genes")), "cid")
    rows = rows.join(name, "cid", "left").join(n_terms, "cid", "left")
    return rows.select("cid", "gene_name", "avg_dist", F.coalesce("n_terms", F.lit(0)).alias("n_terms"), F.array_join(F.transform("profile", lambda x: x.cast("string")), "").alias("profile"), "n_genes")


def terms_summary(result: Result, terms: DataFrame) -> DataFrame:
    """Terms of up to MANY_CLUSTERS clusters with their mean pairwise distance, nearest first."""
    per_term = stage(profiles.cluster_terms(result.members, terms), "cluster-terms")
    means = profiles.mean_pairwise_hamming(per_term, result.members).where("mean_hamming is not null")
    return means.select("term", "n_clusters", F.round("mean_hamming", 6).alias("mean_hamming")).orderBy("mean_hamming", "n_clusters", "term")


def gene_view(result: Result, terms: DataFrame, cid) -> DataFrame:
    """The terms of a cluster, by the mean distance from it, then that among the term's clusters."""
    per_term = stage(profiles.cluster_terms(result.members, terms), "cluster-terms")
    own = per_term.join(per_term.where(F.col("cid") == cid).select("term"), "term", "left_semi")
    rows = profiles.mean_pairwise_hamming(own, result.members).join(profiles.mean_hamming_from(own, result.members, cid), "term")
    rows = rows.select("term", "n_clusters", F.round("mean_hamming", 6).alias("mean_hamming"), F.round("mean_from", 6).alias("mean_from"))
    return rows.orderBy("mean_from", "mean_hamming", "n_clusters", "term")


def gene_sequences(result: Result, sequences: DataFrame, cid) -> DataFrame:
    """(genome, gene, value): the FASTA text of each gene of a cluster that has a sequence
    (gene, nameline, sequence), null where it has none."""
    own = result.members.where(F.col("cid") == cid).select("genome", "gene")
    text = sequences.select("gene", sinks.fasta_text().alias("value"))
    return own.join(text, "gene", "left").select("genome", "gene", "value").orderBy("genome", "gene")


def gene_edges(result: Result, cid) -> DataFrame:
    """(q, qdb, s, sdb, dist): the edges of a cluster."""
    return result.edges.where(F.col("cid") == cid).select("q", "qdb", "s", "sdb", "dist").orderBy("q", "s")


def term_view(result: Result, terms: DataFrame, term: str) -> DataFrame:
    """The clusters of one term, each with the term's mean distance (null: too many)."""
    per_term = stage(profiles.cluster_terms(result.members, terms).where(F.col("term") == term), "cluster-terms")
    mean = profiles.mean_pairwise_hamming(per_term, result.members)
    rows = per_term.join(mean, "term").join(result.stats, "cid")
    return rows.select("cid", "term", "n_clusters", F.round("mean_hamming", 6).alias("mean_hamming"), "n_nodes")


def hamming_profile(result: Result, names: DataFrame, terms: DataFrame) -> DataFrame:
    """(profile, n, info): each distinct profile, its clusters, and the best described gene of them:
    id, name and first term."""
    first_term = terms.groupBy("gene").agg(F.min("term").alias("term"))
    genes = result.members.join(names, "gene", "left").join(first_term, "gene", "left")
    info = F.struct(F.col("gene").cast("string").alias("acc"), F.coalesce("gene_name", F.lit("")).alias("name"), F.coalesce("term", F.lit("")).alias("term"))
    per = result.profiles().join(genes, "cid").groupBy("profile").agg(F.count_distinct("cid").alias("n"), profiles.best_info(info, F.col("gene")).alias("best"))
    return per.select(F.array_join(F.transform("profile", lambda x: x.cast("string")), "").alias("profile"), "n", "best").select("profile", "n", F.concat_ws(" ", "best.acc", "best.name", "best.term").alias("info"))


def clusters_view(result: Result, names: DataFrame, terms: DataFrame, page_num=1, page_size=None) -> DataFrame:
    """A page of clusters: cells per genome, average distance, 0/1 profile and terms."""
    rows = result.matrix().join(result.profiles(), "cid")
    own = profiles.cluster_terms(result.members, terms).groupBy("cid").agg(F.array_sort(F.collect_set("term")).alias("terms"))
    rows = rows.join(own, "cid", "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<string>")))
    return profiles.page(rows, "cid", page_num, page_size)


def query_fingerprint(**query) -> str:
    return hashlib.sha1(json.dumps(query, sort_keys=True).encode()).hexdigest()


def reuse(spark: SparkSession, make, **query) -> DataFrame:
    """The saved result of an equal query in the shared folder, made and saved if there is none
    that is whole; a writer that was killed leaves nothing that is taken for one."""
    path = f"{shared_dir(spark)}/results/{query_fingerprint(**query)}"
    publish(spark, path, lambda folder: make().write.parquet(folder))
    return spark.read.parquet(path)


def raw_pair_download(orthologs: DataFrame, qdb: str, sdb: str, div: str, evalue: str, kind: str = "text", genes: DataFrame | None = None) -> DataFrame:
    """One pair's orthologs at one parameter set as PA/OR text or, with genes (gene, genome, num),
    as OrthoXML lines. A pair of one genome raises ValueError."""
    if qdb == sdb:
        raise ValueError("two different genomes are needed")
    own = orthologs_for(orthologs, qdb, sdb, div, evalue)
    if kind == "text":
        return sinks.raw_pair_text(own)
    if kind == "orthoxml" and genes is not None:
        return sinks.orthoxml_pairs(own, genes.join(own.select(F.explode(F.array("qid", "sid")).alias("gene")).distinct(), "gene", "left_semi"))
    raise ValueError(f"unknown kind {kind!r}, or no genes")


def render(result: Result, kind: str, names: DataFrame, terms: DataFrame) -> DataFrame:
    """A result as rows of text: 'text', 'matrix', 'nexus', 'phylip' or 'orthoxml'."""
    spark = result.members.sparkSession
    if kind == "text":
        listed = spark.createDataFrame([(g,) for g in result.genomes], "genome string")
        return sinks.result_lines(result.members, result.stats, listed, names, terms)
    if kind == "matrix":
        return sinks.profile_matrix_text(result.members, result.genomes, names, terms)
    if kind in ("nexus", "phylip"):
        rows = profiles.transposed_profiles(result.members, result.stats, result.genomes)
        return sinks.nexus_matrix(rows) if kind == "nexus" else sinks.phylip_matrix(rows)
    if kind == "orthoxml":
        genes = stage(ranking.dense_ids(result.members.select("gene", "genome").distinct(), "genome", "gene", name="num"), "numbered")
        return sinks.orthoxml_groups(result.members.select("cid", "gene"), result.stats.select("cid", "avg_dist"), genes)
    raise ValueError(f"unknown kind {kind!r}")


def export_matrix(result: Result, kind: str, path: str, size: int = 10_000) -> bool:
    """render() of 'nexus' or 'phylip' as files of any number of clusters, as write_pieces() has
    them; returns whether it wrote."""
    blocks = profiles.genome_blocks(result.members, result.stats, result.genomes, size)
    return sinks.write_pieces(sinks.matrix_pieces(blocks, result.genomes, kind), path, ["line", "piece"])


def release_stats(genomes: DataFrame, orthologs: DataFrame, release: str, date: str) -> DataFrame:
    """release, release_date (from %Y-%m-%d), and the numbers of genomes, pairs and orthologs."""
    stats = census.dataset_stats(genomes, orthologs)
    return stats.select(F.lit(release).alias("release"), F.to_date(F.lit(date), "yyyy-MM-dd").alias("release_date"), *stats.columns)
