import random

import pytest
from pyspark.sql import functions as F

from cladeframe.functions import scalars
from cladeframe.operators import profiles


@pytest.mark.parametrize("n", [0, 1, 63, 64, 65, 200])
def test_packed_profiles(spark, n):
    r = random.Random(n)
    rows = [([r.randrange(2) for _ in range(n)], [r.randrange(2) for _ in range(n)]) for _ in range(20)] + [([1] * n, [0] * n)]
    df = spark.createDataFrame(rows, "a array<int>, b array<int>").withColumns({"x": scalars.pack(F.col("a")), "y": scalars.pack(F.col("b"))})
    for x in df.select("a", "b", "x", scalars.unpack(F.col("x"), n).alias("back"), scalars.hamming_packed(F.col("x"), F.col("y")).alias("d")).collect():
        assert x.back == x.a and len(x.x) == -(-n // 64) and x.d == sum(i != j for i, j in zip(x.a, x.b))


def test_profiles_of_many_genomes(spark):
    r = random.Random(1)
    genomes = [f"g{i:03}" for i in range(150)]
    members = [(c, r.choice([*genomes, "other", None]), i) for i, c in enumerate(r.randrange(30) for _ in range(400))]
    df = spark.createDataFrame(members, "cid int, genome string, gene int")
    want = {c: [int(any(m[0] == c and m[1] == g for m in members)) for g in genomes] for c in {m[0] for m in members}}
    assert {x.cid: x.profile for x in profiles.profiles(df, genomes).collect()} == want
    assert {x.cid: x.profile for x in profiles.profiles(df, []).collect()} == {c: [] for c in want}
