"""Quality rules by a hashed n-gram log-likelihood ratio (operator 2, DataFrame functions only).

Words and word pairs are hashed into a fixed number of buckets. Bucket counts over the
whole corpus and over trusted documents give two smoothed multinomials; a document's
score is the mean log ratio over its n-grams, and every document is held to one fixed
threshold. Counts are pre-aggregated per task, the model has as many numbers as there
are buckets, and texts are never shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.session import read_table

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
BUCKETS = 1 << 14
TRUSTED_ROWS = 20_000  # at most so many trusted documents make the target multinomial
THRESHOLD = -0.1
RUN = 5


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, also where body uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Runs of characters other than space and \\t to \\r; null: none."""
    return let(
        F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES)),
        lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, "[\\x20\\x09-\\x0D]+")),
    )


def hashes(text: Column) -> Column:
    return F.transform(words(text), lambda w: F.xxhash64(w))


def buckets(hashed: Column, n_buckets: int) -> Column:
    """Bucket numbers of all words and all pairs of neighbours."""
    pairs = F.transform(hashed, lambda h, i: F.pmod(F.xxhash64(h, F.get(hashed, i + 1)), F.lit(n_buckets)).cast("int"))
    return F.concat(F.transform(hashed, lambda h: F.pmod(h, F.lit(n_buckets)).cast("int")), F.slice(pairs, 1, F.greatest(F.size(hashed) - 1, F.lit(0))))


def repeat_words(hashed: Column) -> Column:
    """Words inside runs of RUN words that the text has twice or more, the first included."""

    def covered(runs: Column) -> Column:
        ordered = F.array_sort(F.transform(runs, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        twice = let(
            ordered,
            lambda o: F.filter(
                o, lambda x, k: (x["g"] == F.get(o, k - 1)["g"]) | F.coalesce(x["g"] == F.get(o, k + 1)["g"], F.lit(False))
            ),
        )
        starts = F.sort_array(F.transform(twice, lambda x: x["i"]))
        own = let(starts, lambda s: F.transform(s, lambda p, k: F.least(F.coalesce(F.get(s, k + 1) - p, F.lit(RUN)), F.lit(RUN))))
        return F.aggregate(own, F.lit(0), lambda a, x: a + x)

    runs = F.transform(
        F.sequence(F.lit(0), F.size(hashed) - RUN), lambda i: F.xxhash64(*(F.get(hashed, i + j) for j in range(RUN)))
    )
    some = let(runs, lambda r: F.when(F.size(F.array_distinct(r)) < F.size(r), covered(r)).otherwise(0))
    return F.when(F.size(hashed) > RUN, some).otherwise(0)


def log_ratios(docs: DataFrame, trusted_ids: DataFrame, n_buckets: int = BUCKETS, smoothing: float = 1.0) -> list[float]:
    """log(P(bucket | trusted) / P(bucket | all docs)) of every bucket.

    trusted_ids: a doc_id column of at most TRUSTED_ROWS rows, which bounds the
    broadcast; repeats count once. Only n_buckets rows come to the driver.
    """
    trusted = F.broadcast(trusted_ids.select(F.col("doc_id").alias("trusted_id")).distinct())
    flagged = docs.select("doc_id", "text").join(trusted, F.col("doc_id") == F.col("trusted_id"), "left")
    grams = flagged.select(
        F.col("trusted_id").isNotNull().cast("int").alias("trusted"),
        F.explode(let(hashes(F.col("text")), lambda h: buckets(h, n_buckets))).alias("bucket"),
    )
    counted = grams.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("trusted").alias("t")).collect()
    raw, target = [smoothing] * n_buckets, [smoothing] * n_buckets
    for row in counted:
        raw[row["bucket"]] += row["n"]
        target[row["bucket"]] += row["t"]
    import math

    r, t = sum(raw), sum(target)
    return [math.log(a / t) - math.log(b / r) for a, b in zip(target, raw)]


def judge(docs: DataFrame, model: list[float], threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, llr, kept.

    One row per row of docs, whatever its doc_id; other columns are ignored. Null and
    empty texts have no words, an llr of 0, and fail the base rules. kept: the base
    rules hold and llr >= threshold.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # One literal of the model's numbers, as text that the optimizer folds into an array.
    table = F.split(F.lit(",".join(f"{x:.9g}" for x in model)), ",").cast("array<double>")
    long = lambda c: c.cast("long")
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACES)) != "")
    base = docs.select("doc_id", text.alias("text"), hashes(F.col("text")).alias("h"))
    measured = base.select(
        "doc_id",
        long(F.size("h")).alias("n_words"),
        long(F.length(F.translate("text", SPACES, ""))).alias("word_chars"),
        long(F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        long(let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))).alias("n_dup_lines"),
        long(let(F.col("h"), repeat_words)).alias("n_repeat_words"),
        let(
            let(F.col("h"), lambda h: buckets(h, len(model))),
            lambda b: F.coalesce(F.try_divide(F.aggregate(b, F.lit(0.0), lambda a, x: a + F.get(table, x)), F.size(b)), F.lit(0.0)),
        ).alias("llr"),
    )
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return measured.withColumn("base_failed", failed).withColumn("kept", ~failed & (F.col("llr") >= threshold))


def trusted_sample(labels: DataFrame, rows: int = TRUSTED_ROWS) -> DataFrame:
    """Ids labelled as of good quality, the `rows` first by hash."""
    return labels.where("quality = 1").select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def op2_hashed_ngram_llr(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return judge(docs, log_ratios(docs, trusted_sample(read_table(spark, sf_dir, "labels"))))


QUERIES = {"op2_hashed_ngram_llr": op2_hashed_ngram_llr}
ORACLES: dict[str, str] = {}
