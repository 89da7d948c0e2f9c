"""Pairs still to do, worked off in jobs that a killed run doesn't lose.

Below one path: `deals/deal=<n>`, pairs dealt into jobs once and for good, and
`results/deal=<n>/job=<m>`, what each job made of its pairs. Both come into being by one
rename, which is what marks them done: a job killed before it has left nothing that counts,
and a run after it does the jobs that aren't there."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.operators.ranking import split_into_n
from cladeframe.session import folders, is_published, publish
from cladeframe.streaming.load import incremental_pairs


def deal_pending(pairs: DataFrame, path: str, jobs: int) -> list[int]:
    """Deal those of pairs (qdb, sdb) that no deal below path has into that many jobs of nearly
    one size, and list all deals. Without new pairs there is no new deal."""
    spark = pairs.sparkSession
    deals = published_deals(spark, path)
    own = pairs.select("qdb", "sdb").distinct()
    if deals:
        own = incremental_pairs(own, spark.read.option("basePath", f"{path}/deals").parquet(*(f"{path}/deals/deal={d}" for d in deals)))
    if not own.isEmpty():
        new = deals[-1] + 1 if deals else 0
        dealt = split_into_n(own, jobs, "qdb", "sdb").select("qdb", "sdb", F.col("group_no").cast("int").alias("job"))
        publish(spark, f"{path}/deals/deal={new}", lambda folder: dealt.write.partitionBy("job").parquet(folder))
        deals = published_deals(spark, path)
    return deals


def published_deals(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(x.split("=")[1]) for x in folders(spark, f"{path}/deals") if is_published(spark, f"{path}/deals/{x}"))


def pending_jobs(spark: SparkSession, path: str) -> list[tuple[int, int]]:
    """(deal, job) of dealt jobs that have no result yet."""
    dealt = [(d, int(x.split("=")[1])) for d in published_deals(spark, path) for x in folders(spark, f"{path}/deals/deal={d}")]
    return sorted(x for x in dealt if not is_published(spark, _result(path, *x)))


def _result(path: str, deal: int, job: int) -> str:
    return f"{path}/results/deal={deal}/job={job}"


def work_off(pairs: DataFrame, path: str, compute: Callable[[DataFrame], DataFrame], jobs: int = 100) -> DataFrame:
    """compute() of all pairs (qdb, sdb) asked for so far below path, as rows with deal and job.

    Pairs that are new are dealt into jobs; then every job without a result is computed, one
    Spark job after the other, each over all executors. compute gets a job's pairs and must
    depend on nothing else that changes. A run that ends early, whenever that is, is carried
    on by the next one, and the rows are those of a run without a break: a job's result
    replaces what was left of it and is never added twice."""
    spark = pairs.sparkSession
    deal_pending(pairs, path, jobs)
    for deal, job in pending_jobs(spark, path):
        own = spark.read.parquet(f"{path}/deals/deal={deal}/job={job}")
        publish(spark, _result(path, deal, job), lambda folder, own=own: compute(own).write.parquet(folder))
    return finished(spark, path, compute(pairs.select("qdb", "sdb").limit(0)))


def finished(spark: SparkSession, path: str, like: DataFrame) -> DataFrame:
    """The rows of all jobs that are done, with deal and job; like: a table of their columns."""
    done = [(d, j) for d in published_deals(spark, path) for j in (int(x.split("=")[1]) for x in folders(spark, f"{path}/results/deal={d}")) if is_published(spark, _result(path, d, j))]
    columns = [*((f.name, f.dataType.simpleString()) for f in like.schema), ("deal", "int"), ("job", "int")]
    schema = ", ".join(f"`{n}` {t}" for n, t in columns)
    if not done:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", f"{path}/results").parquet(*(_result(path, d, j) for d, j in done))
