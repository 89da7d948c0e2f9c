"""Builds of a release: records to genes, genomes, pairs, orthologs and statistics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe import model
from cladeframe.operators import census, changes, dims, pairs, ranking, rsd
from cladeframe.session import publish, stage
from cladeframe.sources import readers, sinks
from cladeframe.streaming.load import stream_load_orthologs


@dataclass
class Release:
    census: DataFrame
    anomalies: DataFrame
    selection: DataFrame
    genes: DataFrame
    genomes: DataFrame
    pairs: DataFrame
    orthologs: DataFrame
    stats: DataFrame
    timings: DataFrame | None = None
    items: DataFrame | None = None
    changes: DataFrame | None = None


def extract_genes(records: DataFrame, selected: DataFrame) -> DataFrame:
    """Genes of complete, not collective organisms of the selected genomes (records carry genome)."""
    return census.complete_only(census.drop_collective_orgs(records), selected)


def genome_names(selected: DataFrame, taxa: DataFrame) -> DataFrame:
    """(genome, name, taxon); names that aren't unique raise ValueError."""
    rows = stage(selected.join(taxa.select(F.col("taxon").alias("genome"), "name"), "genome").select("genome", "name", F.col("genome").alias("taxon")), "genome-names")
    if not census.duplicates(rows, "name").isEmpty():
        raise ValueError("genome names are not unique")
    return rows


def build_release(
    records: DataFrame, taxa: DataFrame, hits: DataFrame, grid: DataFrame, least: int = census.LEAST_SEQUENCES,
    timings: DataFrame | None = None, release: str = "new", before: DataFrame | None = None,
) -> Release:
    """From records (genome, acc, ns, ...), taxa (taxon, cat_code, name) and hits among genes
    (qid, qdb, sid, sdb, dist) to all tables of a release: totals of the timings (type,
    start_time, end_time) of its steps, its items for the change log, and, with the items of
    earlier releases, what differs. export_release() writes its downloads."""
    records = stage(records, "records")  # parsed once
    counted = stage(census.genome_census(records), "census")
    selection = stage(census.select_genomes(counted, taxa, least), "selection")
    selected = selection.where("reason is null").select("genome")
    genomes = genome_names(selected, taxa)
    genes = extract_genes(records, selected)
    all_pairs = pairs.genome_pairs(genomes)
    own = hits.join(all_pairs.select("qdb", "sdb"), ["qdb", "sdb"], "left_semi")
    orthologs = stage(rsd.rsd_grid(own, grid), "orthologs")
    listed = genomes.join(taxa.select("taxon", F.col("cat_code").alias("category")), "taxon", "left")
    items = stage(changes.change_items(listed.select(F.lit(release).alias("release"), "taxon", "name", "category")), "items")
    return Release(
        counted, census.census_anomalies(counted), selection, genes, genomes, all_pairs, orthologs, census.dataset_stats(genomes, orthologs),
        None if timings is None else census.timing_totals(timings), items, None if before is None else changes.change_log_diff(items.unionByName(before)),
    )


def export_release(genes: DataFrame, genomes: DataFrame, orthologs: DataFrame, path: str, div_evalues: DataFrame | None = None, compression: str | None = "gzip") -> dict[str, str]:
    """A release's downloads below path: FASTA by genome, PA/OR text by parameter set, and an OrthoXML
    document, of all orthologs (qdb, sdb, div, evalue, qid, sid, dist) or of the given sets.

    genes (acc, genome, nameline, sequence). Returns the folder of each; what is there as a whole stays, and what a killed run left is made anew."""
    if div_evalues is not None:
        orthologs = orthologs.join(div_evalues.select("div", "evalue"), ["div", "evalue"], "left_semi")
    own = genes.join(genomes.select("genome"), "genome", "left_semi")
    paths = {kind: f"{path}/{kind}" for kind in ("fasta", "orthologs", "orthoxml")}
    spark = genes.sparkSession
    publish(spark, paths["fasta"], lambda folder: sinks.write_genome_fasta(own, folder))
    publish(spark, paths["orthologs"], lambda folder: sinks.collate_orthologs(model.nest(orthologs), folder, compression=compression))
    numbered = stage(ranking.dense_ids(own.select(F.col("acc").alias("gene"), "genome"), "genome", "gene", name="num"), "numbered")
    sinks.write_text(sinks.orthoxml_pairs(orthologs, numbered), paths["orthoxml"], ["section", "ord"], compression)
    return paths


def build_reference_set(genes: DataFrame, taxa: DataFrame, hits: DataFrame, limit: float) -> tuple[DataFrame, DataFrame]:
    """(genomes, orthologs) of a directory of genomes at one parameter set."""
    genomes = genome_names(genes.select("genome").distinct(), taxa)
    own = hits.where(F.col("dist") <= limit).join(pairs.genome_pairs(genomes), ["qdb", "sdb"], "left_semi")
    return genomes, rsd.reciprocal_smallest_distance(own)


def reference_set_from_dir(spark: SparkSession, source: str, taxa: DataFrame, hits: DataFrame, limit: float, div: str, evalue: str, out: str) -> tuple[DataFrame, DataFrame]:
    """build_reference_set() of a directory of FASTA by genome, with its downloads written below out.

    The genes are the directory's records by their ids; hits are among these."""
    found = readers.read_genome_dir(spark, source)
    genes = stage(found.select(F.col("id").alias("acc"), "genome", "nameline", F.col("seq").alias("sequence")), "reference-genes")
    genomes, matched = build_reference_set(genes, taxa, hits, limit)
    orthologs = stage(matched.select("qdb", "sdb", F.lit(div).alias("div"), F.lit(evalue).alias("evalue"), "qid", "sid", "dist"), "reference-orthologs")
    export_release(genes, genomes, orthologs, out)
    return genomes, orthologs


def load_release(tables: dict[str, DataFrame], database: str, release: str, path: str | None = None) -> None:
    """Save a release's tables as <database>.<release>_<table>, over what is there (below path, if
    given, else in the warehouse), and make the views <database>.current_<table> show them.

    The views are replaced last, when all tables are whole: until then readers see the release
    before, and a load that failed is run again."""
    spark = next(iter(tables.values())).sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}" + (f" LOCATION '{path}'" if path else ""))
    saved = {name: f"{database}.`{release}_{name}`" for name in tables}
    for name, table in tables.items():
        out = table.write.mode("overwrite")
        (out.option("path", f"{path}/{release}_{name}") if path else out).saveAsTable(saved[name])
    for name, full in saved.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.current_{name} AS SELECT * FROM {full}")


def release_dimensions(genes: DataFrame, names: DataFrame, taxa: DataFrame, terms: DataFrame) -> dict[str, DataFrame]:
    genomes = stage(dims.genome_dimension(genes.select("genome"), names, taxa, census.count_sequences(genes)), "genomes")
    sequences = stage(dims.sequence_dimension(genes, genomes), "sequences")
    return {"genomes": genomes, "sequence": sequences, "sequence_to_go_term": dims.gene_term_bridge(genes, sequences, terms)}


def load(spark: SparkSession, tables: dict[str, DataFrame], orthdata: str, path: str, release: str, date: str) -> DataFrame:
    """Load a release below path: its tables as Parquet, then the PA/OR files under orthdata as a
    stream, then its row (release, release_date, num_genomes, num_pairs, num_orthologs), which is
    returned. The row comes last, so that a release that has it is whole; a load that is run
    again replaces the tables and adds the files that are missing."""
    genomes = tables["genomes"]
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{path}/{release}/{name}")
    stream_load_orthologs(spark, orthdata, f"{path}/{release}/results", f"{path}/{release}/checkpoint")
    counted = spark.read.parquet(f"{path}/{release}/results").agg(F.coalesce(F.sum("num_orthologs"), F.lit(0)).cast("long").alias("num_orthologs"))
    n = F.count("*")
    stats = genomes.agg(n.alias("num_genomes"), F.floor(n * (n - 1) / 2).cast("long").alias("num_pairs")).join(F.broadcast(counted))  # one row
    row = stats.select(F.lit(release).alias("release"), F.to_date(F.lit(date), "yyyy-MM-dd").alias("release_date"), "num_genomes", "num_pairs", "num_orthologs")
    row.write.mode("overwrite").parquet(f"{path}/{release}/release")
    return spark.read.parquet(f"{path}/{release}/release")
