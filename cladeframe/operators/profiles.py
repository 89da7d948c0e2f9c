"""Cluster matrices, phylogenetic profiles, and term statistics over them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.functions.scalars import unpack
from cladeframe.operators.ranking import dense_ids
from cladeframe.session import stage

MANY_CLUSTERS = 100  # terms of more clusters have no mean distance


def genome_order(genomes: DataFrame, primary: str | None = None) -> list[str]:
    """Result columns: genomes sorted as text, the primary one first. A query's genomes are few."""
    found = sorted(r[0] for r in genomes.select("genome").distinct().collect())
    return [primary, *(g for g in found if g != primary)] if primary in found else found


def _listed(genomes: list[str]) -> Column:
    """The genomes as one constant array, so that plans don't grow with them."""
    return F.array(*map(F.lit, genomes)) if genomes else F.array().cast("array<string>")


def cluster_matrix(members: DataFrame, genomes: list[str]) -> DataFrame:
    """(cid, cells): the sorted genes of each genome, an array of arrays in the given order.

    members (cid, genome, gene). Genes are gathered per cluster and genome, so any number
    of genomes makes one plan; cluster_pivot() makes columns of them."""
    cells = members.groupBy("cid", "genome").agg(F.array_sort(F.collect_list("gene")).alias("genes"))
    by = cells.groupBy("cid").agg(F.map_from_entries(F.collect_list(F.struct("genome", "genes"))).alias("m"))
    kind = members.schema["gene"].dataType.simpleString()
    empty = F.array().cast(f"array<{kind}>")
    return by.select("cid", F.transform(_listed(genomes), lambda g: F.coalesce(F.element_at("m", g), empty)).alias("cells"))


def cluster_cells(members: DataFrame, size: int = 1000) -> DataFrame:
    """(cid, genome, part, genes): cluster_matrix() as a row per filled cell, of at most `size` sorted
    genes, so that a cluster of most genes is many rows. Parts of a cell ascend: they are cut where
    genes counted over all cells, by cid, genome and gene, come to a multiple of size."""
    if size < 1:
        raise ValueError("cells need a size")
    part = F.floor((F.col("_n") - 1) / size).alias("part")
    return dense_ids(members.select("cid", "genome", "gene"), "cid", "genome", "gene", name="_n").groupBy("cid", "genome", part).agg(F.array_sort(F.collect_list("gene")).alias("genes"))


def cluster_pivot(members: DataFrame, genomes: list[str]) -> DataFrame:
    """cid and a column of genes per genome, for few genomes."""
    return members.groupBy("cid").pivot("genome", genomes).agg(F.array_sort(F.collect_list("gene")))


def packed_profiles(members: DataFrame, genomes: list[str]) -> DataFrame:
    """(cid, longs): a bit for each genome, in order, that the cluster has genes of: 2,000 genomes
    are 32 longs. Bits are combined by cluster and long before they are shuffled."""
    spark = members.sparkSession
    places = spark.createDataFrame([(g, i // 64, i % 64) for i, g in enumerate(genomes)], "genome string, word int, bit int")
    bits = members.select("cid", "genome").join(F.broadcast(places), "genome", "left")  # a result's columns
    own = bits.groupBy("cid", "word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("long"))
    by = own.groupBy("cid").agg(F.map_from_entries(F.collect_list(F.when(F.col("word").isNotNull(), F.struct("word", "long")))).alias("m"))
    if not genomes:
        return by.select("cid", F.array().cast("array<long>").alias("longs"))
    words = F.sequence(F.lit(0), F.lit((len(genomes) - 1) // 64))
    return by.select("cid", F.transform(words, lambda w: F.coalesce(F.element_at("m", w), F.lit(0).cast("long"))).alias("longs"))


def profiles(members: DataFrame, genomes: list[str]) -> DataFrame:
    """(cid, profile): 1 for each genome, in order, that the cluster has genes of."""
    return packed_profiles(members, genomes).select("cid", unpack(F.col("longs"), len(genomes)).alias("profile"))


def transposed_profiles(members: DataFrame, clusters: DataFrame, genomes: list[str]) -> DataFrame:
    """(genome, profile) over all clusters (cid) in order; names lose a closing '.aa'."""
    listed = members.sparkSession.createDataFrame([(g,) for g in genomes], "genome string")
    grid = clusters.select("cid").join(F.broadcast(listed)).join(members.select("cid", "genome", F.lit(1).alias("has")).distinct(), ["cid", "genome"], "left")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("cid", F.coalesce("has", F.lit(0)).alias("x")))), lambda s: s["x"])
    return grid.groupBy("genome").agg(ordered.alias("profile")).withColumn("genome", F.regexp_replace("genome", r"\.aa$", ""))


def transposed_blocks(members: DataFrame, clusters: DataFrame, genomes: list[str], size: int = 10_000) -> DataFrame:
    """(genome, block, part): transposed_profiles() as text of 0 and 1, in rows of `size` clusters
    that follow each other by cid, numbered from 0, so that no row grows with the clusters."""
    return genome_blocks(members, clusters, genomes, size).withColumn("genome", F.regexp_replace("genome", r"\.aa$", ""))


def genome_blocks(members: DataFrame, clusters: DataFrame, genomes: list[str], size: int = 10_000) -> DataFrame:
    """transposed_blocks() with the genomes' whole names."""
    if size < 1:
        raise ValueError("blocks need a size")
    numbered = stage(dense_ids(clusters.select("cid"), "cid", name="n"), "numbered-clusters")
    numbered = numbered.select("cid", F.floor((F.col("n") - 1) / size).alias("block"), F.pmod(F.col("n") - 1, F.lit(size)).cast("int").alias("place"))
    sizes = numbered.groupBy("block").agg(F.count("*").cast("int").alias("n"))
    listed = members.sparkSession.createDataFrame([(g,) for g in genomes], "genome string")
    present = members.select("cid", "genome").distinct().join(numbered, "cid").groupBy("block", "genome").agg(F.array_sort(F.collect_list("place")).alias("places"))
    rows = sizes.join(F.broadcast(listed)).join(present, ["block", "genome"], "left")  # a row per block and genome
    ones = F.transform("places", lambda x, i: F.concat(F.repeat(F.lit("0"), x - F.coalesce(F.get("places", i - 1), F.lit(-1)) - 1), F.lit("1")))
    part = F.rpad(F.coalesce(F.array_join(ones, ""), F.lit("")), F.col("n"), F.lit("0"))
    return rows.select("genome", "block", part.alias("part"))


def profile_members(profiles_: DataFrame, infos: DataFrame) -> DataFrame:
    """(profile, n, info): profile_counts() with a row for each info, so that a profile of many
    clusters stays many rows; n counts its clusters. Clusters without an info have a null."""
    sizes = profiles_.groupBy("profile").agg(F.count("*").alias("n"))
    return profiles_.join(infos, "cid", "left").join(sizes, "profile").select("profile", "n", "info")


def profile_counts(profiles_: DataFrame, infos: DataFrame) -> DataFrame:
    """(profile, n, infos) of distinct profiles; infos (cid, info)."""
    return profiles_.join(infos, "cid", "left").groupBy("profile").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("info")).alias("infos"))


def cluster_terms(members: DataFrame, terms: DataFrame) -> DataFrame:
    """Distinct (cid, term) from members and terms (gene, term)."""
    return members.join(terms, "gene").select("cid", "term").distinct()


def mean_pairwise_hamming(term_clusters: DataFrame, members: DataFrame) -> DataFrame:
    """(term, n_clusters, mean_hamming) over the profiles of each term's clusters.

    The sum of all pairwise distances is the sum over genomes of k (n - k), with k clusters
    present of n, so no pairs are made. One cluster has mean 0, more than MANY_CLUSTERS null."""
    sizes = term_clusters.groupBy("term").agg(F.count("*").alias("n_clusters"))
    present = term_clusters.join(members.select("cid", "genome").distinct(), "cid").groupBy("term", "genome").agg(F.count("*").alias("k"))
    total = present.join(sizes, "term").groupBy("term").agg(F.sum(F.col("k") * (F.col("n_clusters") - F.col("k"))).alias("total"))
    n = F.col("n_clusters")
    mean = F.when(n == 1, F.lit(0.0)).when(n <= MANY_CLUSTERS, F.col("total") / (n * (n - 1) / 2))
    return sizes.join(total, "term").select("term", "n_clusters", mean.alias("mean_hamming"))


def mean_hamming_from(term_clusters: DataFrame, members: DataFrame, cid) -> DataFrame:
    """(term, mean_from): the distances of a cluster's profile to those of the other clusters
    of its terms, over the number of clusters with it; 0 for a term of its own."""
    own_terms = term_clusters.where(F.col("cid") == cid).select("term")
    others = term_clusters.join(own_terms, "term", "left_semi")
    present = members.select("cid", "genome").distinct()
    own = present.where(F.col("cid") == cid).select("genome", F.lit(1).alias("own"))
    n_own = own.agg(F.count("*").alias("n_own"))
    # |A| + |B| - 2 |A and B| differ
    per = present.join(own, "genome", "left").groupBy("cid").agg(F.count("*").alias("n"), F.coalesce(F.sum("own"), F.lit(0)).alias("both"))
    per = per.join(F.broadcast(n_own)).select("cid", (F.col("n") + F.col("n_own") - 2 * F.col("both")).alias("d"))  # one row
    return others.join(per, "cid").groupBy("term").agg((F.sum("d") / F.count("*")).alias("mean_from"))


def best_gene_name(members: DataFrame, names: DataFrame, genomes: list[str], priority: list[str]) -> DataFrame:
    """(cid, gene_name): the first name by the priority genomes, then by column; null if none."""
    rank = lambda order: F.coalesce(F.array_position(F.array(*map(F.lit, order)), F.col("genome")), F.lit(0)) if order else F.lit(0)
    first = rank(priority)
    key = F.struct(F.when(first > 0, first).otherwise(len(priority) + 1), rank(genomes), F.col("gene"))
    named = F.nullif(F.coalesce("gene_name", F.lit("")), F.lit(""))
    return members.join(names, "gene", "left").groupBy("cid").agg(F.min_by(named, F.when(named.isNotNull(), key)).alias("gene_name"))


def info_place(info: Column) -> Column:
    """Where the first blank of a struct<acc, name, term> is; 3 if there is none."""
    blank = lambda c: F.coalesce(info[c], F.lit("")) == ""
    return F.when(blank("acc"), 0).when(blank("name"), 1).when(blank("term"), 2).otherwise(3)


def better_info(infos: Column) -> Column:
    """Of an array of struct<acc, name, term>, the one whose first blank comes latest; ties go
    to the first."""
    keyed = F.transform(infos, lambda x, i: F.struct(info_place(x).alias("p"), (-i).alias("i"), x.alias("x")))
    return F.array_max(keyed)["x"]


def best_info(info: Column, order: Column) -> Column:
    """better_info() of a group's rows in the given order, as an aggregate that keeps one of them."""
    return F.min_by(info, F.struct(-info_place(info), order))


class Pages:
    """Rows dealt once into ranges of their order, of which a page reads the one or two that it
    lies in: what a page costs doesn't depend on its number."""

    def __init__(self, rows: DataFrame, order: str, ranges: int | None = None):
        self.order, self.columns = order, rows.columns
        ranged = rows.repartitionByRange(*([ranges] if ranges else []), order)  # else Spark joins small ones
        self.dealt = stage(ranged.withColumn("_part", F.spark_partition_id()).sortWithinPartitions(order), "pages")
        self.sizes = sorted((r["_part"], r["n"]) for r in self.dealt.groupBy("_part").agg(F.count("*").alias("n")).collect())  # a row per partition
        self.total = sum(n for _, n in self.sizes)

    def rows(self, first: int, count: int) -> DataFrame:
        """`count` rows in order after the `first` ones."""
        parts, before, skip = [], 0, None
        for part, n in self.sizes:
            if before < first + count and before + n > first:
                skip = before if skip is None else skip
                parts.append(part)
            before += n
        some = self.dealt.where(F.col("_part").isin(parts)) if parts else self.dealt.limit(0)
        return some.orderBy(self.order).offset(max(0, first - (skip or 0))).limit(count).select(self.columns)

    def page(self, page_num=1, page_size=None, default: int = 100) -> DataFrame:
        """One page: sizes that aren't numbers mean the default, sizes under 1 or over the number
        of rows all; page numbers are held to those there are."""
        try:
            size = int(page_size) if page_size is not None else default
        except (TypeError, ValueError):
            size = default
        if size < 1 or size >= self.total:
            return self.dealt.orderBy(self.order).select(self.columns)  # all rows stay in their partitions
        pages = max(1, -(-self.total // size))
        try:
            number = min(max(int(page_num), 1), pages)
        except (TypeError, ValueError):
            number = 1
        return self.rows((number - 1) * size, size)


def page(rows: DataFrame, order: str, page_num=1, page_size=None, default: int = 100) -> DataFrame:
    """One page of rows, as Pages has it; keep a Pages for more than one."""
    return Pages(rows, order).page(page_num, page_size, default)


def first_hit(hits: DataFrame, query: str, *order) -> DataFrame:
    """The first row of each query by the given order."""
    w = Window.partitionBy(query).orderBy(*order)
    return hits.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
