"""Census and selection of genomes, and counts over datasets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.session import folders, is_published, publish, stage

LEAST_SEQUENCES = 200
CATEGORIES = ("A", "B", "E")


def genome_census(records: DataFrame) -> DataFrame:
    """Per genome: how many records, complete, reference, sprot and trembl ones, and the numbers
    of names, taxons and organism codes with the least of each as representative.

    records (genome, ns, complete, reference, org_name, taxon, org_code)."""
    distinct = lambda c: (F.count_distinct(c).alias(f"n_{c}"), F.min(c).alias(c))
    return records.groupBy("genome").agg(
        F.count("*").alias("count"), F.count_if("complete").alias("complete"), F.count_if("reference").alias("reference"),
        F.count_if(F.col("ns") == "sp").alias("sprot"), F.count_if(F.col("ns") != "sp").alias("trembl"),
        *distinct("org_name"), *distinct("taxon"), *distinct("org_code"),
    )


def census_anomalies(census: DataFrame) -> DataFrame:
    """(genome, anomaly) rows."""
    found = F.array_compact(F.array(
        F.when(F.col("n_org_code") > 1, "multiple_genome_org_codes"), F.when(F.col("n_org_name") > 1, "multiple_genome_names"),
        F.when(F.col("n_taxon") > 1, "multiple_genome_taxons"), F.when(~F.col("reference").isin(0) & (F.col("reference") != F.col("complete")), "reference_not_complete"),
    ))
    return census.select("genome", F.explode(found).alias("anomaly"))


def select_genomes(census: DataFrame, taxa: DataFrame, least: int = LEAST_SEQUENCES, categories: tuple[str, ...] = CATEGORIES) -> DataFrame:
    """(genome, complete, reason): 'too_few', 'missing_taxon', 'filtered_taxon_cat_code', or null
    for those selected; taxa (taxon, cat_code), genomes are taxons."""
    joined = census.select("genome", "complete").join(taxa.select(F.col("taxon").alias("genome"), "cat_code", F.lit(True).alias("known")), "genome", "left")
    reason = F.when(F.col("complete") < least, "too_few").when(F.col("known").isNull(), "missing_taxon")
    reason = reason.when(~F.coalesce(F.col("cat_code").isin(*categories), F.lit(False)), "filtered_taxon_cat_code")
    return joined.select("genome", "complete", reason.alias("reason"))


def funnel(selected: DataFrame) -> DataFrame:
    return selected.groupBy(F.coalesce("reason", F.lit("selected")).alias("reason")).agg(F.count("*").alias("n"))


def missing_taxa(census: DataFrame, taxa: DataFrame, least: int = LEAST_SEQUENCES) -> DataFrame:
    return census.where(F.col("complete") >= least).join(taxa.select(F.col("taxon").alias("genome")), "genome", "left_anti").select("genome", "complete")


def drop_collective_orgs(records: DataFrame) -> DataFrame:
    return records.where(~F.coalesce(F.col("org_code"), F.lit("")).startswith("9"))


def complete_only(records: DataFrame, genomes: DataFrame) -> DataFrame:
    return records.where("complete").join(genomes.select("genome"), "genome", "left_semi")


def count_sequences(genes: DataFrame) -> DataFrame:
    return genes.groupBy("genome").agg(F.count("*").alias("num_seqs"))


def refresh_counts(spark: SparkSession, source: str, table: str) -> tuple[DataFrame, int]:
    """(genome, num_seqs) of FASTA files in folders genome=<id> below source, and how many files were read.

    table keeps each file's count with its path, time and length, in versions of which the
    last whole one counts. Files that are as they were aren't opened; new and changed ones
    are counted, and those that are gone go. Empty files don't count as any. The list of files, a row each, is Spark's own."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[!_.]*").load(source)
    files = files.select("path", F.col("modificationTime").alias("modified"), "length", F.regexp_extract("path", "/genome=([^/]*)/", 1).alias("genome"))
    files = stage(files.where("genome <> ''"), "fasta-files")
    same = ["path", "modified", "length"]
    versions = [v for v in folders(spark, table) if is_published(spark, f"{table}/{v}")]
    last = max((int(v.split("=")[1]) for v in versions), default=0)
    had = spark.read.parquet(f"{table}/version={last}") if last else None
    new = files if had is None else files.join(had.select(same), same, "left_anti")
    paths = [r["path"] for r in new.select("path").collect()]  # names of changed files
    counts = new.select(*same, "genome", F.lit(0).cast("long").alias("num_seqs"))
    if paths:
        heads = spark.read.text(paths).where(F.col("value").startswith(">")).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))
        local = lambda c: F.regexp_replace(c, "^file:/+", "/")  # noqa: E731  two spellings of a local path
        plain = F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B")))  # the one has escapes of its own
        counts = new.join(heads.select(local(plain).alias("_path"), "n"), local(F.col("path")) == F.col("_path"), "left").select(*same, "genome", F.coalesce("n", F.lit(0)).alias("num_seqs"))
    kept = counts if had is None else counts.unionByName(had.join(files.select(same), same, "left_semi").select(counts.columns))
    if paths or had is None or had.count() != files.count():
        publish(spark, f"{table}/version={last + 1}", lambda folder: kept.write.parquet(folder))
        last += 1
    whole = spark.read.parquet(f"{table}/version={last}")
    return whole.groupBy("genome").agg(F.sum("num_seqs").alias("num_seqs")), len(paths)


def fasta_chars(records: DataFrame) -> DataFrame:
    return records.groupBy("genome").agg(F.sum(F.length("seq")).alias("n_chars"), F.count("*").alias("n_records"))


def dataset_stats(genomes: DataFrame, orthologs: DataFrame) -> DataFrame:
    """num_genomes, num_pairs, num_orthologs over all parameter sets."""
    n = genomes.agg(F.count_distinct("genome").alias("num_genomes"))
    return n.select("num_genomes", (F.col("num_genomes") * (F.col("num_genomes") - 1) / 2).cast("long").alias("num_pairs")).join(F.broadcast(orthologs.agg(F.count("*").alias("num_orthologs"))))


def timing_totals(timings: DataFrame) -> DataFrame:
    """(type, n, seconds), and all types together as a null type."""
    return timings.rollup("type").agg(F.count("*").alias("n"), F.sum(F.col("end_time") - F.col("start_time")).alias("seconds"))


def timing_join(timings: DataFrame) -> DataFrame:
    """Per pair (qdb < sdb): seconds of blast both ways and of rsd, zero where missing."""
    a, b = F.least("qdb", "sdb"), F.greatest("qdb", "sdb")
    s = F.col("end_time") - F.col("start_time")
    total = lambda t: F.coalesce(F.sum(F.when(t, s)), F.lit(0.0))
    blast = F.col("type") == "blast"
    return timings.groupBy(a.alias("q"), b.alias("s")).agg(
        total(blast & (F.col("qdb") <= F.col("sdb"))).alias("blast_forward"), total(blast & (F.col("qdb") > F.col("sdb"))).alias("blast_backward"), total(F.col("type") == "rsd").alias("rsd")
    )


def category_counts(genomes: DataFrame) -> DataFrame:
    """(category, n) of E, A, B and V, and their total as a null category."""
    return genomes.where(F.col("category").isin("E", "A", "B", "V")).rollup("category").agg(F.count("*").alias("n"))


def genomes_in_category(genomes: DataFrame, codes: list[str]) -> DataFrame:
    return genomes.where(F.col("category").isin(codes))


def describe_pop(rows: DataFrame, value: str, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.avg(value).alias("mean"), F.var_pop(value).alias("variance"), F.stddev_pop(value).alias("stddev"))


def duplicates(rows: DataFrame, *keys: str) -> DataFrame:
    """Keys that are not unique; empty where they are."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def genome_to_genes(genes: DataFrame) -> DataFrame:
    return genes.groupBy("genome").agg(F.array_sort(F.collect_set("gene")).alias("genes"))
