"""Differences between releases, as rows (release, kind, item)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeframe.functions.scalars import species_of


def change_items(genomes: DataFrame) -> DataFrame:
    """(release, kind, item) of six kinds from genomes (release, taxon, name, category)."""
    g = genomes.withColumn("species", species_of(F.col("name")))
    euk = F.col("category") == "E"
    multi = multi_taxon_species(g, "release").select("release", "species", F.lit(True).alias("multi"))
    g = g.join(multi, ["release", "species"], "left")
    one = lambda kind, c: F.struct(F.lit(kind).alias("kind"), F.col(c).alias("item"))
    multi = F.col("multi")
    items = F.array(
        one("taxons", "taxon"), one("taxonSpecies", "species"), F.when(euk, one("euks", "taxon")), F.when(euk, one("eukSpecies", "species")),
        F.when(multi, one("multiTaxonSpecies", "species")), F.when(multi & euk, one("multiEukSpecies", "species")),
    )
    return g.select("release", F.explode(F.array_compact(items)).alias("x")).select("release", "x.kind", "x.item").distinct()


def multi_taxon_species(genomes: DataFrame, *by: str) -> DataFrame:
    """Species of more than one distinct name."""
    return genomes.groupBy(*by, "species").agg(F.count_distinct("name").alias("n_names")).where("n_names > 1")


def change_log_sizes(items: DataFrame) -> DataFrame:
    return items.groupBy("release", "kind").agg(F.count("*").alias("n"))


def change_log_diff(items: DataFrame) -> DataFrame:
    """(release_a, release_b, kind, item): what a has and b hasn't, for every ordered pair."""
    releases = items.select(F.col("release").alias("release_b")).distinct()
    a = items.withColumnRenamed("release", "release_a").join(F.broadcast(releases), F.col("release_a") != F.col("release_b"))  # a row per release
    b = items.select(F.col("release").alias("release_b"), "kind", "item")
    return a.join(b, ["release_b", "kind", "item"], "left_anti").select("release_a", "release_b", "kind", "item")


def change_log_names(genomes: DataFrame) -> DataFrame:
    """(release_a, release_b, taxon, name): eukaryotes of a that b hasn't, with their names in a."""
    euks = genomes.where("category = 'E'").select(F.col("release").alias("release_a"), "taxon", "name").distinct()
    releases = genomes.select(F.col("release").alias("release_b")).distinct()
    a = euks.join(F.broadcast(releases), F.col("release_a") != F.col("release_b"))  # a row per release
    b = euks.select(F.col("release_a").alias("release_b"), "taxon")
    return a.join(b, ["release_b", "taxon"], "left_anti").select("release_a", "release_b", "taxon", "name")
