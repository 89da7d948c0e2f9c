"""Mixing sources to target weights by Poisson replication (operator 5).

A document's count is the inverse of the Poisson distribution, whose mean is its
source's target repetition rate, at a number hashed from its id and a seed. So the
outcome needs no shared state, is the same on every run, and a hot source is just
more rows. Rows are exploded by count and dealt out anew in the order of a second
hash: a global shuffle. A document of many copies, as of a tiny source in a huge corpus,
is first exploded into blocks of copies, which are dealt out before they are exploded in turn.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cladeframe.session import read_table, stage

SEED = 17
BLOCK = 1024  # copies of a document that one task makes


def uniform(seed: int, *cols: Column) -> Column:
    """52 hash bits as a number in [0, 1); nulls hash as the empty string."""
    text = F.concat_ws("|", F.lit(str(seed)), *(F.coalesce(c.cast("string"), F.lit("")) for c in cols))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def rates(docs: DataFrame, weights: dict[str, float] | None = None, budget: float = 1.0) -> DataFrame:
    """(source, rate, least, cdf): rate is target share x budget x whole size / source's size;
    cdf is the Poisson distribution with that mean from `least` on.

    A document's size is its text's bytes plus one. Without weights, shares go by the
    square root of the sources' sizes. A source that weights don't name has rate 0.
    """
    sizes = docs.groupBy("source").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + F.lit(1)).alias("size"))
    if weights is None:
        weight = F.sqrt("size")
    else:
        named = F.create_map(*(F.lit(x) for kv in weights.items() for x in kv)) if weights else F.create_map().cast("map<string,double>")
        weight = F.coalesce(F.element_at(named, F.coalesce("source", F.lit(""))).cast("double"), F.lit(0.0))
    sizes = sizes.withColumn("weight", weight)
    whole = sizes.agg(F.sum("size").alias("whole"), F.sum("weight").alias("weights"))
    rated = sizes.join(F.broadcast(whole)).withColumn(  # one row
        "rate", F.coalesce(F.try_divide(F.col("weight") * F.lit(float(budget)) * F.col("whole"), F.col("weights") * F.col("size")), F.lit(0.0))
    )
    # Beyond 12 standard deviations and 20 on either side of the mean there is under 1e-15.
    k, rate, spread = F.col("k"), F.col("rate"), F.ceil(12 * F.sqrt("rate") + 20)
    least, most = F.greatest(F.lit(0).cast("long"), F.floor("rate") - spread), F.ceil("rate") + spread
    steps = rated.select("source", "rate", least.alias("least"), F.explode(F.sequence(least, most)).alias("k"))
    p = F.when(rate > 0, F.exp(k * F.ln("rate") - rate - log_factorial(k))).otherwise(F.when(k == 0, 1.0).otherwise(0.0))
    over = Window.partitionBy("source").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    cdf = F.transform(F.array_sort(F.collect_list(F.struct("k", "c"))), lambda x: x["c"])  # some 24 roots of the rate and 40
    return steps.withColumn("c", F.sum(p).over(over)).groupBy("source", "rate", "least").agg(cdf.alias("cdf"))


def log_factorial(k: Column) -> Column:
    """ln k! of whole numbers: exact up to 20, then Stirling's series, to about 1e-15 of it."""
    x = k.cast("double")
    series = x * F.ln(x) - x + 0.5 * F.ln(2 * math.pi * x) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)
    return F.when(k <= 20, F.ln(F.factorial(F.least(k, F.lit(20)).cast("int")))).otherwise(series)


def below(cdf: Column, u: Column) -> Column:
    """How many numbers of a rising array are u or less, by binary search."""
    start = F.struct(F.lit(0).alias("lo"), F.size(cdf).alias("hi"))

    def step(acc: Column, _: Column) -> Column:
        mid = F.floor((acc["lo"] + acc["hi"]) / 2).cast("int")
        low = (acc["lo"] < acc["hi"]) & (F.get(cdf, mid) <= u)
        return F.struct(F.when(low, mid + 1).otherwise(acc["lo"]).alias("lo"), F.when(low | (acc["lo"] >= acc["hi"]), acc["hi"]).otherwise(mid).alias("hi"))

    halves = F.ceil(F.log2(F.size(cdf).cast("double") + 1)).cast("int")
    return F.aggregate(F.sequence(F.lit(1), halves + 1), start, step)["lo"]


def replicate(docs: DataFrame, weights: dict[str, float] | None = None, budget: float = 1.0, seed: int = SEED) -> DataFrame:
    """The columns of docs, plus mix_rate, mix_copy (from 0) and mix_order, in that global order.

    Null sources form one source of their own. Null texts have size 1. Rows that share
    a doc_id get the same count. No rows give no rows. Columns of docs whose names
    begin with mix_ are replaced.
    """
    docs = docs.drop("mix_rate", "mix_copy", "mix_order", "mix_source", "mix_block")
    # Written, so that its true size decides between a broadcast and a shuffled join.
    rate = stage(rates(docs, weights, budget).select(F.col("source").alias("mix_source"), F.round("rate", 6).alias("mix_rate"), "least", "cdf"), "rates")
    mix_count = below(F.col("cdf"), uniform(seed, F.col("doc_id"))).cast("long") + F.col("least")
    joined = docs.join(rate, F.col("source").eqNullSafe(F.col("mix_source"))).withColumn("mix_count", mix_count)
    copies = lambda df, least, most: df.withColumn("mix_copy", F.explode(F.sequence(least.cast("int"), (most - 1).cast("int"))))
    n = F.col("mix_count")
    kept = copies(joined.where((n > 0) & (n <= BLOCK)), F.lit(0), n)
    highest = rate.agg(F.max(F.col("least") + F.size("cdf"))).first()[0]  # no count is above it
    if highest is not None and highest > BLOCK:
        blocks = joined.where(n > BLOCK).withColumn("mix_block", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / BLOCK))))
        # A number of partitions of its own, so that blocks, small before they are exploded, aren't put together again.
        dealt = blocks.repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "doc_id", "mix_block")
        least = F.col("mix_block") * BLOCK
        kept = kept.unionByName(copies(dealt, least, F.least(least + BLOCK, n)).drop("mix_block"))
    out = kept.withColumn("mix_order", uniform(seed + 1, F.col("doc_id"), F.col("mix_copy")))
    return out.drop("mix_source", "least", "cdf", "mix_count").repartitionByRange("mix_order").sortWithinPartitions("mix_order", "doc_id", "mix_copy")


def op5_poisson_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    return replicate(docs)


ORACLE = f"""
WITH sizes AS (SELECT source, sum(coalesce(strlen(text), 0) + 1) AS size FROM documents GROUP BY source),
rated AS (SELECT source, sqrt(size) * (SELECT sum(size) FROM sizes) / ((SELECT sum(sqrt(size)) FROM sizes) * size) AS rate FROM sizes),
steps AS (SELECT source, rate, k, exp(-rate + k * ln(rate) - lgamma(k + 1)) AS p FROM rated, range(0, 400) t(k)
          WHERE k <= ceil(rate + 12 * sqrt(rate) + 20)),
cdf AS (SELECT source, rate, k, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM steps),
u AS (SELECT *, CAST('0x' || substr(md5('{SEED}|' || doc_id), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0 AS u FROM documents),
counted AS (SELECT u.doc_id, any_value(u.text) AS text, any_value(u.lang) AS lang, any_value(u.source) AS source, any_value(u.n_chars) AS n_chars,
                   any_value(rate) AS rate, count(*) FILTER (c <= u) AS n
            FROM u JOIN cdf ON u.source = cdf.source GROUP BY u.doc_id)
SELECT doc_id, text, lang, source, n_chars, round(rate, 6) AS mix_rate, CAST(copy AS INT) AS mix_copy,
       CAST('0x' || substr(md5('{SEED + 1}|' || doc_id || '|' || copy), 1, 13) AS BIGINT)::DOUBLE / 4503599627370496.0 AS mix_order
FROM counted, LATERAL (SELECT unnest(range(0, n)) AS copy)
"""

QUERIES = {"op5_poisson_mixing": op5_poisson_mixing}
ORACLES = {"op5_poisson_mixing": ORACLE}
