"""Incremental loads: ortholog files as a stream, and pairs that are not done yet."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.session import folders
from cladeframe.sources.readers import orthdata_blocks

KEYS = ["qdb", "sdb", "div", "evalue"]
STORE = "spark.sql.streaming.stateStore.providerClass"
#: Fixed value: state on disk; Spark's default keeps all sets that a stream has seen in the executors' heap.
ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _best_of_new(batch: DataFrame) -> DataFrame:
    """(keys, orthologs): the parameter sets of a batch that have a mark, a row without orthologs; of
    several in one batch the one with most orthologs, then of the least hash."""
    block = F.struct((-F.size("orthologs")).alias("less"), F.xxhash64("orthologs").alias("tie"), "orthologs")
    found = batch.groupBy(*KEYS).agg(F.count_if(F.col("orthologs").isNull()).alias("marks"), F.min(F.when(F.col("orthologs").isNotNull(), block)).alias("best"))
    return found.where("marks > 0").select(*KEYS, "best.orthologs")


def stream_load_orthologs(spark: SparkSession, source: str, table: str, checkpoint: str) -> int:
    """Load the PA/OR files under source that the checkpoint doesn't know yet; returns how many
    batches ran. Only parameter sets that are new get in, with num_orthologs, run and batch.

    Which sets were seen is the stream's own keyed state, in its state store, so that a batch
    costs what it holds, however large the table is: the stream's blocks come beside the sets
    that dropDuplicates() lets pass, and those of the new sets are kept. A batch has a partition
    of its own in the table and replaces it when it is run again after a failure. A table that
    other checkpoints have loaded is read for its sets alone, and only those runs of it."""
    run = hashlib.sha1(checkpoint.rstrip("/").encode()).hexdigest()[:12]
    blocks = orthdata_blocks(spark.readStream.option("lineSep", "\n//\n").text(source))
    marks = blocks.select(*KEYS).dropDuplicates(KEYS).withColumn("orthologs", F.lit(None).cast(blocks.schema["orthologs"].dataType))

    def add(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        rows = _best_of_new(batch).withColumn("num_orthologs", F.size("orthologs"))
        if others := [f"{table}/{x}" for x in folders(session, table) if x != f"run={run}"]:
            rows = rows.join(session.read.option("basePath", table).parquet(*others).select(KEYS), KEYS, "left_anti")
        out = rows.withColumns({"run": F.lit(run), "batch": F.lit(number)}).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy("run", "batch").parquet(table)

    stream = blocks.unionByName(marks).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    had = spark.conf.get(STORE)
    if had.endswith(".HDFSBackedStateStoreProvider"):
        spark.conf.set(STORE, ON_DISK)
    try:
        query = stream.start()  # which takes the setting along
        query.awaitTermination()
    finally:
        spark.conf.set(STORE, had)
    return len(query.recentProgress)


def incremental_pairs(pairs: DataFrame, done: DataFrame) -> DataFrame:
    """Pairs (qdb, sdb) that are not done."""
    return pairs.join(done.select("qdb", "sdb"), ["qdb", "sdb"], "left_anti")
