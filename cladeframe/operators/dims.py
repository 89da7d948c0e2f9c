"""Dimensions with surrogate ids, lookups and joins against them, and edits by genome."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.functions.scalars import first_or_null
from cladeframe.operators.ranking import dense_ids

LIKE = {"contains": "%{}%", "starts_with": "{}%", "ends_with": "%{}", "equals": "{}"}


def genome_dimension(genomes: DataFrame, names: DataFrame, taxa: DataFrame, counts: DataFrame) -> DataFrame:
    """id, acc, name, ncbi_taxon, taxon_name, taxon_category_code, taxon_category_name, num_seqs."""
    joined = genomes.select("genome").distinct().join(names, "genome", "left").join(taxa, F.col("genome") == F.col("taxon"), "left").join(counts, "genome", "left")
    return dense_ids(joined, "genome").select(
        F.col("id").cast("int").alias("id"), F.col("genome").alias("acc"), "name", F.col("genome").alias("ncbi_taxon"), F.col("taxon_name"),
        F.col("cat_code").alias("taxon_category_code"), F.col("cat_name").alias("taxon_category_name"), F.coalesce("num_seqs", F.lit(0)).cast("long").alias("num_seqs"),
    )


def sequence_dimension(genes: DataFrame, genomes: DataFrame) -> DataFrame:
    """id, external_sequence_id, genome_id, gene_name, gene_id (null where there is none)."""
    rows = genes.join(genomes.select(F.col("acc").alias("genome"), F.col("id").alias("genome_id")), "genome")
    numbered = dense_ids(rows, "acc")
    return numbered.select("id", F.col("acc").alias("external_sequence_id"), "genome_id", "gene_name", first_or_null(F.col("gene_ids")).cast("int").alias("gene_id"))


def gene_term_bridge(genes: DataFrame, sequences: DataFrame, terms: DataFrame) -> DataFrame:
    """id, sequence_id, go_term_acc, go_term_name, go_term_type: a row per sequence and known term."""
    own = genes.select(F.col("acc").alias("external_sequence_id"), F.explode("go_terms").alias("go_term_acc")).distinct()
    rows = own.join(terms.select(F.col("acc").alias("go_term_acc"), F.col("name").alias("go_term_name"), F.col("type").alias("go_term_type")), "go_term_acc")
    rows = rows.join(sequences.select("external_sequence_id", F.col("id").alias("sequence_id")), "external_sequence_id")
    numbered = dense_ids(rows.select("sequence_id", "go_term_acc", "go_term_name", "go_term_type"), "sequence_id", "go_term_acc")
    return numbered.select("id", "sequence_id", "go_term_acc", "go_term_name", "go_term_type")


def sequence_terms(ids: DataFrame, bridge: DataFrame) -> DataFrame:
    """(sequence_id, term_accs, term_names); ids without terms have empty arrays."""
    own = bridge.groupBy("sequence_id").agg(F.array_sort(F.collect_set("go_term_acc")).alias("term_accs"), F.array_sort(F.collect_set("go_term_name")).alias("term_names"))
    empty = F.array().cast("array<string>")
    return ids.join(own, "sequence_id", "left").select("sequence_id", F.coalesce("term_accs", empty).alias("term_accs"), F.coalesce("term_names", empty).alias("term_names"))


def encode_edges(orthologs: DataFrame, genomes: DataFrame, divs: DataFrame, evalues: DataFrame, sequences: DataFrame) -> DataFrame:
    """Orthologs in surrogate ids. Divergences and e-values, 12 parameter sets at most, are broadcast:
    Spark doesn't know the size of such lists, and where all orthologs have one set it would
    make them anew for each part of a list. Other dimensions are joined as their sizes allow."""
    key = lambda dim, value, name, to: dim.select(F.col(value).alias(name), F.col("id").alias(to))
    out = orthologs.join(F.broadcast(key(divs, "name", "div", "divergence")), "div").join(F.broadcast(key(evalues, "name", "evalue", "evalue_id")), "evalue")
    out = out.join(key(genomes, "acc", "qdb", "query_db"), "qdb").join(key(genomes, "acc", "sdb", "subject_db"), "sdb")
    out = out.join(key(sequences, "external_sequence_id", "qid", "q"), "qid").join(key(sequences, "external_sequence_id", "sid", "s"), "sid")
    return out.select("query_db", "subject_db", "divergence", F.col("evalue_id").alias("evalue"), "q", "s", "dist")


def with_sequences(edges: DataFrame, sequences: DataFrame) -> DataFrame:
    """Edges (q, s, ...) with external id, genome and name of both ends."""
    side = lambda p: sequences.select(F.col("id").alias(p), F.col("external_sequence_id").alias(f"{p}_acc"), F.col("genome_id").alias(f"{p}_genome"), F.col("gene_name").alias(f"{p}_name"))
    return edges.join(side("q"), "q").join(side("s"), "s")


def gene_names_like(sequences: DataFrame, text: str, kind: str = "contains", ignore_case: bool = False) -> DataFrame:
    """Distinct gene names; % and _ in text match as in LIKE. Unknown kinds raise ValueError."""
    if kind not in LIKE:
        raise ValueError(f"unknown kind of search {kind!r}")
    like = F.col("gene_name").ilike if ignore_case else F.col("gene_name").like
    return sequences.where(like(LIKE[kind].format(text))).select("gene_name").distinct()


def gene_name_genome_pairs_like(sequences: DataFrame, genomes: DataFrame, text: str, kind: str = "contains", ignore_case: bool = False) -> DataFrame:
    names = gene_names_like(sequences, text, kind, ignore_case)
    rows = sequences.join(names, "gene_name", "left_semi").join(genomes.select(F.col("id").alias("genome_id"), "acc"), "genome_id")
    return rows.select("acc", "gene_name").distinct().orderBy("acc", "gene_name")


def seq_ids_for_gene_name(sequences: DataFrame, genomes: DataFrame, name: str, genome: str | None = None) -> DataFrame:
    rows = sequences.where(F.col("gene_name") == name).join(genomes.select(F.col("id").alias("genome_id"), "acc"), "genome_id")
    return (rows.where(F.col("acc") == genome) if genome else rows).select("external_sequence_id").distinct()


def sequence_by_id(genes: DataFrame, ids: DataFrame) -> DataFrame:
    return genes.join(ids.select("acc"), "acc", "left_semi")


def delete_genome(acc: str, genomes: DataFrame, sequences: DataFrame, bridge: DataFrame, results: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The four tables without a genome; an unknown one leaves them as they are."""
    gone = genomes.where(F.col("acc") == acc).select(F.col("id").alias("gone"))
    gone_sequences = sequences.join(gone, F.col("genome_id") == F.col("gone"), "left_semi").select(F.col("id").alias("gone_id"))
    left = results.join(gone, F.col("query_db") == F.col("gone"), "left_anti").join(gone, F.col("subject_db") == F.col("gone"), "left_anti")
    return (
        genomes.where(F.col("acc") != acc), sequences.join(gone, F.col("genome_id") == F.col("gone"), "left_anti"),
        bridge.join(gone_sequences, F.col("sequence_id") == F.col("gone_id"), "left_anti"), left,
    )


def replace_genome(genes: DataFrame, genomes: DataFrame, genome: str, new_genes: DataFrame, name: str, taxon: str) -> tuple[DataFrame, DataFrame]:
    """Genes with one genome's replaced, and the genome list with its name and taxon put in."""
    kept = genes.where(F.col("genome") != genome).unionByName(new_genes.withColumn("genome", F.lit(genome)))
    row = genomes.sparkSession.createDataFrame([(genome, name, taxon)], "genome string, name string, taxon string")
    return kept, genomes.where(F.col("genome") != genome).select("genome", "name", "taxon").unionByName(row)


def replace_genome_on_disk(path: str, genome: str, new_genes: DataFrame) -> None:
    """Overwrite the rows of one genome in a Parquet table that is partitioned by genome; the
    other genomes' files aren't touched."""
    rows = new_genes.drop("genome").withColumn("genome", F.lit(genome))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("genome").parquet(path)


def resolve_names(genomes: DataFrame, names: list[str], least: int = 1) -> list[str]:
    """Ids of the named genomes, by name, once each. Unknown names and too few raise ValueError."""
    wanted = genomes.sparkSession.createDataFrame([(n,) for n in sorted(set(names))], "name string")
    rows = wanted.join(genomes.select("name", "genome"), "name", "left").orderBy("name").collect()  # as many as asked for
    if unknown := [r["name"] for r in rows if r["genome"] is None]:
        raise ValueError(f"unknown genomes: {', '.join(unknown)}")
    if len(rows) < least:
        raise ValueError(f"at least {least} genomes are needed")
    return [r["genome"] for r in rows]


def load_results(nested: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Results with num_orthologs; of repeated parameter sets the one with the first source (or
    the most orthologs) stays, and sets already there are not added again."""
    keys = ["qdb", "sdb", "div", "evalue"]
    order = [F.col("source")] if "source" in nested.columns else [F.desc(F.size("orthologs")), F.xxhash64("orthologs")]
    first = nested.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")
    if existing is not None:
        first = first.join(existing.select(*keys), keys, "left_anti")
    return first.withColumn("num_orthologs", F.size("orthologs"))
