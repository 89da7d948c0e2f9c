"""Shared helpers: table access, lineage cuts in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which driver and executors share.

    Only a local session (tests) without that setting gets a temporary folder;
    on a cluster a missing setting is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder shared by driver and executors")
    made = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", made)
    return made


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it back: a lineage cut that a
    lost executor cannot take along, with known size for later join choices."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/stage-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _at(spark: SparkSession, path: str):
    """(file system, path) as Hadoop has them."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _at(spark, path)
    return fs.exists(p)


def is_published(spark: SparkSession, path: str) -> bool:
    """Whether a folder is there as a whole: Spark writes its mark last."""
    return exists(spark, f"{path}/_SUCCESS")


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _at(spark, path)
    fs.delete(p, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, none if it isn't there; those beginning with _ or . are not shown."""
    fs, p = _at(spark, path)
    if not fs.exists(p):
        return []
    return sorted(x.getPath().getName() for x in fs.listStatus(p) if x.isDirectory() and x.getPath().getName()[0] not in "_.")


def publish(spark: SparkSession, path: str, write: Callable[[str], None]) -> bool:
    """Have write(folder) fill a folder beside path, then rename it to path; returns whether it did.

    A folder that is whole (see is_published) stays, and nothing is written. What a run that
    was killed left at path is removed, so that it blocks nobody; what it left beside path is
    hidden from readers. Of two writers at once, the first to rename wins."""
    if is_published(spark, path):
        return False
    parent, name = path.rstrip("/").rsplit("/", 1)
    aside = f"{parent}/_making-{uuid.uuid4().hex}"
    write(aside)
    fs, made = _at(spark, aside)
    _, mark = _at(spark, f"{aside}/_SUCCESS")
    if not fs.exists(mark):
        fs.create(mark).close()
    if not is_published(spark, path):
        remove(spark, path)
        if fs.rename(made, _at(spark, path)[1]) and not exists(spark, f"{path}/{made.getName()}"):
            return True
    for left in (aside, f"{path}/{made.getName()}"):  # another writer's folder was there first
        remove(spark, left)
    if not is_published(spark, path):
        raise OSError(f"{path} could not be put in place")
    return False
