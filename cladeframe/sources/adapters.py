"""The test tables as the model: genomes are brands, genes parts, and an edge joins two parts
of one order; vectors are genes of the genomes that their labels name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.session import read_table

WITHIN = 0.05  # the distance of the queries whose feature is a limit on it

EVIDENCE_SQL = """
evidence AS (
 SELECT l1.l_partkey q, l2.l_partkey s, p1.p_brand qdb, p2.p_brand sdb,
   CAST(round(greatest(l1.l_discount, l2.l_discount) * 100) AS INT) dneed,
   CAST(least(l1.l_quantity, l2.l_quantity) AS INT) ek,
   CAST(abs(CAST(round(l1.l_extendedprice * 100) AS BIGINT) - CAST(round(l2.l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / CAST(1000000 AS DOUBLE) dist
 FROM lineitem l1 JOIN lineitem l2 ON l1.l_orderkey = l2.l_orderkey AND l1.l_partkey <> l2.l_partkey
 JOIN part p1 ON p1.p_partkey = l1.l_partkey JOIN part p2 ON p2.p_partkey = l2.l_partkey
 WHERE p1.p_brand < p2.p_brand)"""


def edges_sql(max_div: int = 8, min_exponent: int = 5, upper: float | None = None, where: str = "true") -> str:
    limit = "" if upper is None else f" AND min(dist) <= {upper}"
    return f"""{EVIDENCE_SQL},
edges AS (SELECT q, s, qdb, sdb, min(dist) dist FROM evidence WHERE dneed <= {max_div} AND ek >= {min_exponent} GROUP BY q, s, qdb, sdb HAVING {where}{limit})"""


def evidence(spark: SparkSession, sf_dir: str, max_div: int | None = None, min_exponent: int | None = None) -> DataFrame:
    """(q, s, qdb, sdb, dneed, ek, dist) of pairs of lines of one order, of those that pass the
    parameters; these hold for each line of a pair, so lines are filtered before they are joined."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    cents = F.round(F.col("l_extendedprice") * 100).cast("long")
    line = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", F.round(F.col("l_discount") * 100).cast("int").alias("d"), "l_quantity", cents.alias("c"))
    line = line.join(part, F.col("l_partkey") == F.col("p_partkey")).drop("p_partkey")
    if max_div is not None:
        line = line.where(F.col("d") <= max_div)
    if min_exponent is not None:
        line = line.where(F.col("l_quantity").cast("int") >= min_exponent)
    a = line.toDF("o", "q", "d1", "n1", "c1", "qdb")
    b = line.toDF("o", "s", "d2", "n2", "c2", "sdb")
    both = a.join(b, "o").where("q <> s and qdb < sdb")
    dist = F.abs(F.col("c1") - F.col("c2")).cast("double") / F.lit(1000000.0)
    return both.select("q", "s", "qdb", "sdb", F.greatest("d1", "d2").alias("dneed"), F.least("n1", "n2").cast("int").alias("ek"), dist.alias("dist"))


def edges(spark: SparkSession, sf_dir: str, max_div: int = 8, min_exponent: int = 5, upper: float | None = None, lower: float | None = None) -> DataFrame:
    """(q, s, qdb, sdb, dist) at one parameter set: the least distance of each pair of genes."""
    some = evidence(spark, sf_dir, max_div, min_exponent)
    if upper is not None:  # a least distance within the limit is the least of those within it
        some = some.where(F.col("dist") <= upper)
    out = some.groupBy("q", "s", "qdb", "sdb").agg(F.min("dist").alias("dist"))
    return out if lower is None else out.where(F.col("dist") >= lower)


CATEGORY_SQL = "substr('ABEVU', 1 + CAST(substr(p_brand, 7) AS INT) % 5, 1)"


def genes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gene, genome, gene_name, terms, category."""
    p = read_table(spark, sf_dir, "part")
    words = F.array_distinct(F.concat(F.split("p_name", " "), F.split("p_type", " ")))
    return p.select(F.col("p_partkey").alias("gene"), F.col("p_brand").alias("genome"), F.col("p_name").alias("gene_name"), words.alias("terms"), F.expr(CATEGORY_SQL).alias("category"))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genes(spark, sf_dir).select("gene", "gene_name")


def terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return genes(spark, sf_dir).select("gene", F.explode("terms").alias("term")).distinct()


TERMS_SQL = "terms AS (SELECT DISTINCT p_partkey gene, unnest(list_concat(string_split(p_name, ' '), string_split(p_type, ' '))) term FROM part)"


def genomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """genome, name, category, num_seqs."""
    return genes(spark, sf_dir).groupBy("genome", "category").agg(F.count("*").alias("num_seqs")).withColumn("name", F.lower("genome"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").alias("gene"), F.col("label").cast("string").alias("genome"), F.col("embedding").alias("vector"))
