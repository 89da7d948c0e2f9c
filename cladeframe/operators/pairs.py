"""Pairs and subsets of genomes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def genome_pairs(genomes: DataFrame) -> DataFrame:
    """All n (n - 1) / 2 pairs of distinct genomes as (qdb, sdb), in text order; a genome list is a
    small dimension, and every pair of it is the result."""
    g = genomes.select(F.col("genome").cast("string")).distinct()
    return g.select(F.col("genome").alias("qdb")).join(g.select(F.col("genome").alias("sdb")), F.col("qdb") < F.col("sdb"))


def pairs_for(spark: SparkSession, genome: str | None = None, limit_genomes: list[str] | None = None, genomes: list[str] | None = None) -> DataFrame:
    """Pairs of the genomes named anywhere: with `genome` in each, one of limit_genomes in
    each, both of genomes, as far as given."""
    named = sorted({*([genome] if genome else []), *(limit_genomes or []), *(genomes or [])})
    pairs = genome_pairs(spark.createDataFrame([(g,) for g in named], "genome string"))
    if genome:
        pairs = pairs.where((F.col("qdb") == genome) | (F.col("sdb") == genome))
    if limit_genomes:
        pairs = pairs.where(F.col("qdb").isin(limit_genomes) | F.col("sdb").isin(limit_genomes))
    if genomes:
        pairs = pairs.where(F.col("qdb").isin(genomes) & F.col("sdb").isin(genomes))
    return pairs


def combinations(items: DataFrame, n: int, column: str = "item") -> DataFrame:
    """All n-subsets as columns i1 < i2 < ..."""
    return _tuples(items, n, column, lambda a, b: a < b)


def permutations(items: DataFrame, n: int, column: str = "item") -> DataFrame:
    """All ordered choices of n different items as columns i1, i2, ..."""
    return _tuples(items, n, column, lambda a, b: a != b)


def _tuples(items: DataFrame, n: int, column: str, apart) -> DataFrame:
    own = items.select(column).distinct()
    out = own.select(F.col(column).alias("i1"))
    for k in range(2, n + 1):
        on = None
        for j in range(1, k):
            test = apart(F.col(f"i{j}"), F.col(f"i{k}"))
            on = test if on is None else on & test
        out = out.join(own.select(F.col(column).alias(f"i{k}")), on)
    return out
