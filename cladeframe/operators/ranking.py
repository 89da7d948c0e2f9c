"""Consecutive ids and groups of ordered rows, without a window over all rows.

Rows are range-partitioned by their order; a row's number is the count of rows in the
partitions before, one number per partition, and its place in its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cladeframe.session import stage


def dense_ids(rows: DataFrame, *order: str, name: str = "id") -> DataFrame:
    """rows with 1-based consecutive ids in the given order. Ties get any order among them."""
    dealt = stage(rows.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranked")
    sizes = dealt.groupBy("_part").agg(F.count("*").alias("n"))
    before = sizes.select("_part", F.coalesce(F.sum("n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_base"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    # One row per partition.
    return dealt.withColumn("_place", place).join(F.broadcast(before), "_part").withColumn(name, F.col("_base") + F.col("_place")).drop("_part", "_base", "_place")


def groups_of_n(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """rows with group_no, from 0: consecutive batches of n."""
    if n < 1:
        raise ValueError("groups need a size")
    return dense_ids(rows, *order, name="_id").withColumn("group_no", F.floor((F.col("_id") - 1) / n)).drop("_id")


def split_into_n(rows: DataFrame, n: int, *order: str) -> DataFrame:
    """rows with group_no from 1 to n: nearly equal groups, the first ones larger."""
    if n < 1:
        raise ValueError("at least one group")
    numbered = dense_ids(rows, *order, name="_id")
    total = rows.count()
    q, r = divmod(total, n)
    i = F.col("_id") - 1
    small = F.lit(r) + F.floor((i - r * (q + 1)) / max(q, 1))
    return numbered.withColumn("group_no", F.when(i < r * (q + 1), F.floor(i / (q + 1))).otherwise(small) + 1).drop("_id")


def every_nth(rows: DataFrame, n: int, *order: str) -> DataFrame:
    return dense_ids(rows, *order, name="_id").where(F.col("_id") % n == 0).drop("_id")


def fasta_head(records: DataFrame, n: int, order: str) -> DataFrame:
    return records.orderBy(order).limit(n)
