"""Nearest hits by numbers against all pairs."""

import random

from pyspark.sql import functions as F

from cladeframe import releases
from cladeframe.operators import rsd

SCHEMA = "day string, gene long, genome string, value long"


def brute(points, limit):
    """Each point's nearest in each other genome among those of its day."""
    out = set()
    for day, gene, genome, value in points:
        best = {}
        for d, g, other, v in points:
            if d == day and other != genome and abs(v - value) <= limit:
                best[other] = min(best.get(other, (limit + 1, 0)), (abs(v - value), g))
        for other, (apart, g) in best.items():
            out.add((gene, genome, g, other, apart) if genome < other else (g, other, gene, genome, apart))
    return out


def test_nearest_values(spark):
    """In bunches of any size, with many equal values, few and far ones, and those at the very limit."""
    rnd = random.Random(4)
    points = [(rnd.choice("ab"), i, rnd.choice("xyz"), rnd.choice((rnd.randrange(60), rnd.randrange(2000), 10**15 + rnd.randrange(9)))) for i in range(300)]
    points += [("c", 900, "x", 0), ("c", 901, "y", 10), ("d", 902, "x", 0), ("d", 903, "y", 11), ("e", 904, "x", 5), ("f", 906, "x", 5), ("f", 905, "y", 5), ("f", 904, "y", 5)]
    df = spark.createDataFrame(points + [("a", None, "x", 3), (None, 907, "y", 5), ("a", 908, "y", None)], SCHEMA)
    for rows in (3, 40, 10**6):
        got = [tuple(r) for r in rsd.value_hits(df, ["day"], 10, rows).collect()]
        assert set(got) == brute(points, 10)


def test_no_points(spark):
    assert rsd.value_hits(spark.createDataFrame([], SCHEMA), ["day"], 10).isEmpty()


def test_hits_of_a_day_do_not_grow_with_its_square(spark, tmp_path):
    """Copies of one day's orders: hits as many as orders and nations, not pairs of orders."""
    n = 2000
    spark.range(n).select(F.col("id").alias("o_orderkey"), F.col("id").alias("o_custkey"), F.lit("O").alias("o_orderstatus"), (F.col("id") % 7).cast("double").alias("o_totalprice"), F.lit("1998-02-06").cast("timestamp").alias("o_orderdate")).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(n).select(F.col("id").alias("c_custkey"), (F.col("id") % 3).cast("int").alias("c_nationkey")).write.parquet(f"{tmp_path}/customer.parquet")
    assert 0 < releases._day_hits(spark, str(tmp_path)).count() <= 2 * n
