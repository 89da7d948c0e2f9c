"""Data model: explicit schemas, the parameter grid, pairs of genomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The thresholds that orthologs are computed for. They are join keys, so text.
DIVERGENCES = ("0.8", "0.5", "0.2")
EVALUES = ("1e-5", "1e-10", "1e-15", "1e-20")
DEFAULT_DIVERGENCE, DEFAULT_EVALUE = "0.2", "1e-20"
CATEGORIES = {"A": "Archaea", "B": "Bacteria", "E": "Eukaryota", "V": "Viruses", "U": "Unclassified"}

ORTHOLOGS = "qdb string, sdb string, div string, evalue string, qid string, sid string, dist double"
NESTED = "qdb string, sdb string, div string, evalue string, orthologs array<struct<qid:string,sid:string,dist:double>>"
GENES = "acc string, genome string, gene_name string, gene_desc string, gene_ids array<string>, go_terms array<string>, sequence string, nameline string"
GENOMES = "id int, acc string, name string, ncbi_taxon string, taxon_name string, taxon_category_code string, taxon_category_name string, num_seqs long"


def params(spark: SparkSession) -> DataFrame:
    """The 12 (div, evalue) pairs, with the largest divergence and exponent as numbers."""
    rows = [(d, e, float(d), int(e.split("-")[1])) for d in DIVERGENCES for e in EVALUES]
    return spark.createDataFrame(rows, "div string, evalue string, max_div double, min_exponent int")


def make_pair(a: Column, b: Column) -> tuple[Column, Column]:
    """The two ids in text order ('10090' before '9606')."""
    return F.least(a.cast("string"), b.cast("string")), F.greatest(a.cast("string"), b.cast("string"))


def normalize_pairs(pairs: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Distinct (qdb, sdb), each in text order."""
    first, second = make_pair(F.col(a), F.col(b))
    return pairs.select(first.alias("qdb"), second.alias("sdb")).distinct()


def nest(orthologs: DataFrame, order: tuple[str, ...] = ("qid", "sid", "dist")) -> DataFrame:
    """One row per parameter set with its orthologs in order."""
    one = F.struct("qid", "sid", "dist")
    key = F.struct(*order, one.alias("o"))
    ordered = F.transform(F.array_sort(F.collect_list(F.when(F.col("qid").isNotNull(), key))), lambda x: x["o"])
    return orthologs.groupBy("qdb", "sdb", "div", "evalue").agg(ordered.alias("orthologs"))


def flatten(nested: DataFrame, keep_empty: bool = False) -> DataFrame:
    """One row per ortholog; keep_empty leaves a row of nulls for an empty parameter set."""
    explode = F.explode_outer if keep_empty else F.explode
    return nested.select("qdb", "sdb", "div", "evalue", explode("orthologs").alias("o")).select("qdb", "sdb", "div", "evalue", "o.*")


def num_orthologs(nested: DataFrame) -> DataFrame:
    """Count per parameter set; empty sets count 0."""
    return nested.select("qdb", "sdb", "div", "evalue", F.size(F.coalesce("orthologs", F.array().cast("array<struct<qid:string,sid:string,dist:double>>"))).alias("num_orthologs"))
