import math

from pyspark.sql import functions as F

from cladeframe.llm import mixing


def test_counts_follow_the_weights(spark, docs):
    df = docs(*((i, "x" * 99, "a" if i % 4 else "b") for i in range(4000)))
    out = mixing.replicate(df, {"a": 1.0, "b": 1.0}).groupBy("source").count().collect()
    n = {r["source"]: r["count"] for r in out}
    assert abs(n["a"] - 2000) < 200 and abs(n["b"] - 2000) < 200
    again = mixing.replicate(df, {"a": 1.0, "b": 1.0})
    assert sorted(r.mix_order for r in again.collect()) == sorted(r.mix_order for r in mixing.replicate(df, {"a": 1.0, "b": 1.0}).collect())


def test_counts_are_poisson(docs):
    df = docs(*((i, "x", "a") for i in range(6000)))
    counts = {r.doc_id: r["count"] for r in mixing.replicate(df, {"a": 1.0}, budget=2.5).groupBy("doc_id").count().collect()}
    for k in range(6):
        share = sum(counts.get(i, 0) == k for i in range(6000)) / 6000
        assert abs(share - math.exp(-2.5) * 2.5**k / math.factorial(k)) < 0.025


def test_high_rates_and_order(docs):
    df = docs((1, "x", "a"), (2, "y" * 5_000, "b"))
    out = mixing.replicate(df, {"a": 1.0, "b": 0.0}).collect()
    assert {r.doc_id for r in out} == {1} and 2000 < len(out) < 3000
    assert [r.mix_copy for r in sorted(out, key=lambda r: r.mix_copy)] == list(range(len(out)))
    orders = [r.mix_order for r in out]
    assert orders == sorted(orders)


def test_copies_of_one_document_are_made_by_many_tasks(docs, monkeypatch):
    """The same rows with and without blocks; and none of the tasks before the global shuffle makes all of them."""
    df = docs((1, "x", "a"), (1, "x", "a"), (None, "x", "a"), (2, "y" * 50_000, "b"), (3, "z", "b"))
    whole = mixing.replicate(df, {"a": 1.0, "b": 1.0})
    monkeypatch.setattr(mixing, "BLOCK", 1 << 30)
    plain = mixing.replicate(df, {"a": 1.0, "b": 1.0})
    assert whole.columns == plain.columns and whole.dtypes == plain.dtypes
    rows = sorted(map(str, whole.collect()))
    assert len(rows) > 12_000 and rows == sorted(map(str, plain.collect()))
    assert [r.mix_order for r in whole.collect()] == sorted(r.mix_order for r in whole.collect())
    monkeypatch.setattr(mixing, "BLOCK", 64)
    monkeypatch.setattr(type(df), "repartitionByRange", lambda self, *_: self)
    made = mixing.replicate(df, {"a": 1.0, "b": 1.0}).groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in made) < 0.6 * len(rows)


def test_odd_rows(docs, odd):
    out = mixing.replicate(odd.withColumn("mix_copy", odd.lang), budget=5.0)
    assert {"doc_id", "text", "mix_rate", "mix_copy", "mix_order"} <= set(out.columns)
    assert None in {r.source for r in out.collect()} and out.count() > 10
    assert mixing.replicate(docs().limit(0)).count() == 0


def test_counts_are_the_inverse_of_the_distribution(spark):
    """By a plain sum over all counts, at rates from none to where exp(-rate) vanishes."""
    import random

    r = random.Random(3)
    rated = {0.0: [1.0], 0.3: [], 2.5: [], 24.0: [], 700.0: [], 4999.5: []}
    for rate, cdf in rated.items():
        total = 0.0
        for k in range(int(rate + 14 * rate**0.5 + 30) if rate else 0):
            total += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
            cdf.append(total)
    names = {f"s{i}": rate for i, rate in enumerate(rated)}
    sizes = spark.createDataFrame([(s, "x" * 9) for s in names], "source string, text string")
    found = mixing.rates(sizes, {s: rate for s, rate in names.items()}, budget=sum(names.values()) / len(names)).select("source", "rate", "least", "cdf")
    assert {x.source: round(x.rate, 9) for x in found.collect()} == names
    us = [(s, r.random()) for s in names for _ in range(200)]
    got = spark.createDataFrame(us, "source string, u double").join(found, "source").select("source", "u", (mixing.below(F.col("cdf"), F.col("u")) + F.col("least")).alias("n"))
    for x in got.collect():
        assert x.n == sum(c <= x.u for c in rated[names[x.source]]), (x.source, x.u)
    assert max(len(x.cdf) for x in found.collect()) < 2000
