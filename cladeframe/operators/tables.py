"""A release's tables on disk, changed by genome without rewriting the rest.

Each table is Parquet in partitions that a genome decides: genomes by id, sequence and
bridge by genome_id, results by query_db and subject_db. So a genome is deleted by removing
its partitions and replaced by overwriting them, and no other file is opened. The genome's
own row goes, or comes, last: as long as it is there (or not yet), the same call finishes
what a failed one left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.session import folders, remove

#: The partition columns of each table.
PARTITIONS = {"genomes": ["id"], "sequence": ["genome_id"], "bridge": ["genome_id"], "results": ["query_db", "subject_db"]}


def save_tables(path: str, genomes: DataFrame, sequences: DataFrame, bridge: DataFrame, results: DataFrame) -> None:
    """Tables as dims has them: genomes (id, acc, ...), sequence (id, genome_id, ...), bridge
    (sequence_id, ...) and results (query_db, subject_db, ...), which are written over what is there."""
    for name, df in _by_genome(genomes, sequences, bridge, results).items():
        df.hint("rebalance", *PARTITIONS[name]).write.mode("overwrite").partitionBy(*PARTITIONS[name]).parquet(f"{path}/{name}")


def _by_genome(genomes: DataFrame, sequences: DataFrame, bridge: DataFrame, results: DataFrame) -> dict[str, DataFrame]:
    owner = sequences.select(F.col("id").alias("sequence_id"), "genome_id")
    return {"genomes": genomes, "sequence": sequences, "bridge": bridge.join(owner, "sequence_id"), "results": results}


def read_tables(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(genomes, sequence, bridge, results), with the columns that they were saved with."""
    return tuple(spark.read.parquet(f"{path}/{name}").drop(*(["genome_id"] if name == "bridge" else [])) for name in PARTITIONS)


def genome_id(spark: SparkSession, path: str, acc: str) -> int | None:
    """The id of a listed genome; the list has a row per genome."""
    found = spark.read.parquet(f"{path}/genomes").where(F.col("acc") == acc).select("id").first()
    return None if found is None else found["id"]


def _result_folders(spark: SparkSession, path: str, gone: int) -> list[str]:
    """The partitions of results with that genome on either side."""
    out = [f"query_db={gone}"] if f"query_db={gone}" in folders(spark, f"{path}/results") else []
    others = [x for x in folders(spark, f"{path}/results") if x not in out]
    return out + [f"{x}/subject_db={gone}" for x in others if f"subject_db={gone}" in folders(spark, f"{path}/results/{x}")]


def delete_genome(spark: SparkSession, path: str, acc: str) -> bool:
    """Remove a genome from all tables; returns whether it was listed. Results go first, then its
    terms and sequences, and its row last, so that a call after a failure does the rest."""
    gone = genome_id(spark, path, acc)
    if gone is None:
        return False
    for folder in [*(f"results/{x}" for x in _result_folders(spark, path, gone)), f"bridge/genome_id={gone}", f"sequence/genome_id={gone}", f"genomes/id={gone}"]:
        remove(spark, f"{path}/{folder}")
    return True


def replace_genome(spark: SparkSession, path: str, genome: DataFrame, sequences: DataFrame, bridge: DataFrame, results: DataFrame) -> None:
    """Put in or replace one genome: its row, and all its sequences, terms and results.

    genome: one row; its id must be that of the listed genome of its acc, if there is one, or
    a new one. results: all pairs with the genome; pairs that it had and that aren't among
    them go. Partitions of the genome alone are written, its row last; a call after a failure
    gives what one call would have given."""
    row = genome.select("id", "acc").first()
    had = genome_id(spark, path, row["acc"])
    if had is not None and had != row["id"]:
        raise ValueError(f"{row['acc']} is listed as {had}, not {row['id']}")
    new = _by_genome(genome, sequences, bridge, results)
    if not sequences.where(F.col("genome_id") != row["id"]).isEmpty() or not results.where((F.col("query_db") != row["id"]) & (F.col("subject_db") != row["id"])).isEmpty():
        raise ValueError("rows of another genome")
    stays = {f"query_db={r[0]}/subject_db={r[1]}" for r in results.select("query_db", "subject_db").distinct().collect()}  # a pair per listed genome
    for folder in _result_folders(spark, path, row["id"]):
        inner = [folder] if "/" in folder else [f"{folder}/{x}" for x in folders(spark, f"{path}/results/{folder}")]
        for x in inner:
            if x not in stays:
                remove(spark, f"{path}/results/{x}")
    for name in ("results", "bridge", "sequence", "genomes"):
        if name in ("bridge", "sequence") and new[name].isEmpty():
            remove(spark, f"{path}/{name}/genome_id={row['id']}")
        out = new[name].hint("rebalance", *PARTITIONS[name]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        out.partitionBy(*PARTITIONS[name]).parquet(f"{path}/{name}")
