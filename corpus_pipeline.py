"""The corpus pipeline: toxicity, near-dedup, personal data, mixing, packing.

Each stage calls one operator of cladeframe.llm on all rows that the one before kept, and
all but the last return the columns of documents. Stages are written as Parquet and read
again, so that a lost executor costs a part of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cladeframe.llm import dedup, mixing, packing, pii, textops, toxicity
from cladeframe.session import read_table, stage

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score doesn't reject.

    Every row is judged by its own text, repeated rows and null ids too; null and empty texts
    score as texts without a marked word. No rows give no rows; columns other than COLUMNS go.
    """
    textops.small_batches(spark)
    return toxicity.keep_clean(docs.select(COLUMNS), toxicity.train(docs, read_table(spark, sf_dir, "labels")))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that of the smallest id.

    One row stays of those of equal doc_id and text; rows without a doc_id all stay, as do
    null and empty texts, which are near nothing. Rows of one doc_id with different texts are
    judged one by one. No rows give no rows; columns other than COLUMNS go.
    """
    textops.small_batches(spark)
    return dedup.keep_one(docs.select(COLUMNS))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data in their texts replaced by its kind.

    One row per row, repeated rows and null ids too; null texts stay null. No rows give no
    rows; columns other than COLUMNS go.
    """
    textops.small_batches(spark)
    return pii.redact(docs.select(COLUMNS), pii.train(docs))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out, so that sources get their target weights.

    Rows of one doc_id, null ids among them, get the same count. Null sources are one source;
    null and empty texts have size 1. No rows give no rows; columns other than COLUMNS go.
    """
    return mixing.replicate(docs.select(COLUMNS)).select(COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of 4096 tokens.

    One set of pieces per row, repeated rows and null ids too; null and empty texts are one
    piece of the end id. No rows give no rows; other columns are ignored.
    """
    import public_tokenizers

    textops.small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", clean), ("near-dedup", deduplicate), ("pii", redact), ("mixing", mix), ("packing", pack)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select(COLUMNS)
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
