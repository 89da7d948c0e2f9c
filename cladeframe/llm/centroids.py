"""Centroid clustering by dictionaries of subvectors (operator 13).

Vectors of whole numbers are cut into blocks of a few dimensions. The rows of a shard are
stored as codes into a dictionary of the distinct subvectors of each block, which loses
nothing. In a round each entry's exact squared distances to all centroids are computed
once; a vector's distances are sums of its codes' parts, looked up. Dictionaries belong to
shards of a bounded number of rows, as Parquet's belong to row groups: none grows with the
table, vectors aren't shuffled, and a lost executor costs its shards. A round sends Spark
a count and a vector of sums per task and centroid; k centroids come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.llm.vectors import lists, matrix, usable, whole
from cladeframe.session import read_table, stage

SHARD_ROWS = 4_096
BLOCK = 2  # dimensions
LARGEST = float(1 << 26)  # of a component, so that distances of vectors of 64 fit in a long
_SHARD = "ids binary, no_id binary, codes binary, entries binary, sizes array<int>"


def encode(vectors: DataFrame, dim: int = 64, scale: float = 64.0, block: int = BLOCK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Shards: the ids, a code per row and block, and each block's distinct subvectors.

    vectors: (vec_id, v) of dim entries. Components become floor(scale * x).
    """
    spans = [(a, min(a + block, dim)) for a in range(0, dim, block)]

    def shard(ids: pa.Array, x: np.ndarray) -> dict:
        codes, entries, sizes = np.empty((len(spans), len(x)), np.int32), [], []
        for k, (a, b) in enumerate(spans):
            distinct, codes[k] = np.unique(x[:, a:b], axis=0, return_inverse=True)
            entries.append(distinct.astype(np.int64).tobytes())
            sizes.append(len(distinct))
        no_id = ids.is_null().to_numpy(zero_copy_only=False)
        return {"ids": ids.fill_null(0).to_numpy().astype(np.int64).tobytes(), "no_id": np.packbits(no_id).tobytes(), "codes": codes.tobytes(), "entries": b"".join(entries), "sizes": sizes}

    schema = pa.schema([("ids", pa.binary()), ("no_id", pa.binary()), ("codes", pa.binary()), ("entries", pa.binary()), ("sizes", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, shard_rows):
                part = b.slice(at, shard_rows)
                x = whole(matrix(part.column("v"), dim), scale, LARGEST)
                yield pa.RecordBatch.from_pylist([shard(part.column("vec_id"), x)], schema)

    return vectors.mapInArrow(run, _SHARD)


def _nearest(row: dict, centroids: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray], np.ndarray]:
    """(cluster, distance, entries by block, codes) of a shard's rows."""
    k, dim = centroids.shape
    n = len(row["ids"]) // 8
    codes = np.frombuffer(row["codes"], np.int32).reshape(-1, n)
    flat, at, entries = np.frombuffer(row["entries"], np.int64), 0, []
    total = np.zeros((n, k), np.int64)
    for j, size in enumerate(row["sizes"]):
        a, b = j * block, min((j + 1) * block, dim)
        e = flat[at : at + size * (b - a)].reshape(size, b - a)
        at += e.size
        entries.append(e)
        parts = ((e[:, None, :] - centroids[None, :, a:b]) ** 2).sum(axis=2)  # once per entry and round
        total += parts[codes[j]]
    cluster = total.argmin(axis=1)  # the first of equal ones
    return cluster, total[np.arange(n), cluster], entries, codes


def _round(shards: DataFrame, centroids: np.ndarray, block: int) -> list:
    """(cluster, pos, n, sum) of the clusters that have rows and each dimension; k x dim rows at most."""
    k, dim = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = np.zeros(k, np.int64), np.zeros((k, dim), np.int64)
        for b in batches:
            for row in b.to_pylist():
                cluster, _, entries, codes = _nearest(row, centroids, block)
                counts += np.bincount(cluster, minlength=k)
                for j, e in enumerate(entries):
                    # How often each cluster has each entry, times the entry.
                    often = np.bincount(cluster * len(e) + codes[j], minlength=k * len(e)).reshape(k, len(e))
                    sums[:, j * block : j * block + e.shape[1]] += often @ e
        full = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(full.astype(np.int32)), pa.array(counts[full]), lists(sums[full])], names=["cluster", "n", "sums"])

    parts = shards.mapInArrow(run, "cluster int, n long, sums array<long>")
    by_entry = parts.select("cluster", "n", F.posexplode("sums")).groupBy("cluster", "pos")
    return by_entry.agg(F.sum("n").alias("n"), F.sum(F.col("col").cast("decimal(28,0)")).alias("sum")).collect()


def seeds(vectors: DataFrame, k: int, prefix: str = "1:") -> list:
    """The k vectors whose ids hash least, in that order; all if there are fewer. Null ids hash
    as empty text; of equal hashes the lesser vector comes first."""
    key = F.sha2(F.concat(F.lit(prefix), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [r["v"] for r in vectors.orderBy(key, "v").limit(k).select("v").collect()]


def cluster(df: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: float = 64.0, block: int = BLOCK, shard_rows: int = SHARD_ROWS, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid) of every usable vector.

    Usable: exactly dim entries, none null or non-finite; other rows have no row. Distances
    are squared and exact; of equally near centroids the smaller number holds. An empty
    cluster keeps its centroid. Every row counts by itself, repeated rows and null ids too.
    Fewer than k usable rows give as many centroids; none, no rows. Columns besides the id
    and the vector are ignored. A component beyond 2**26 after scaling is an error.
    """
    vectors = usable(df, column, key).where(F.size("v") == dim)
    spark = df.sparkSession
    schema = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid array<long>"
    first = seeds(vectors, k)
    if not first:
        return spark.createDataFrame([], schema)
    shards = stage(encode(vectors, dim, scale, block, shard_rows), "shards")
    centroids = whole(np.array(first, float), scale, LARGEST)
    for _ in range(rounds):
        for r in _round(shards, centroids, block):
            centroids[r["cluster"], r["pos"]] = int(r["sum"]) // r["n"]
    centroids.setflags(write=False)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in b.to_pylist():
                own, distance, _, _ = _nearest(row, centroids, block)
                no_id = np.unpackbits(np.frombuffer(row["no_id"], np.uint8), count=len(own)).astype(bool)
                ids = pa.array(np.frombuffer(row["ids"], np.int64), mask=no_id)
                yield pa.RecordBatch.from_arrays([ids, pa.array(own.astype(np.int32)), pa.array(distance)], names=["vec_id", "cluster", "distance"])

    assigned = stage(shards.mapInArrow(assign, "vec_id long, cluster int, distance long"), "assigned")
    sums = {r["cluster"]: int(r["d"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("d")).collect()}  # k rows
    facts = [(c, sums.get(c, 0), sum(sums.values()), [int(x) for x in centroids[c]]) for c in range(len(centroids))]
    of = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid array<long>")
    return assigned.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid")  # k rows


def digest(centroid: Column) -> Column:
    return F.sha2(F.array_join(centroid.cast("array<string>"), ","), 256)


def op13_subvector_dictionaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = cluster(read_table(spark, sf_dir, "embeddings"))
    return out.withColumn("centroid_sha256", digest(F.col("centroid"))).drop("centroid")


def _oracle(k: int = 16, rounds: int = 3) -> str:
    """Vectors as rows of (vec_id, dimension, component), centroids likewise."""
    steps = []
    for r in range(rounds + 1):
        steps.append(
            f"d{r} AS MATERIALIZED (SELECT vec_id, c, sum((x.x - m.x) * (x.x - m.x)) AS d FROM long_form x JOIN m{r} m USING (i) GROUP BY vec_id, c), "
            f"a{r} AS MATERIALIZED (SELECT vec_id, c, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, c) = 1)"
        )
        if r < rounds:
            steps.append(
                f"t{r} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM long_form JOIN a{r} USING (vec_id) GROUP BY c, i), "
                f"m{r + 1} AS MATERIALIZED (SELECT m.c, m.i, CASE WHEN t.n IS NULL THEN m.x ELSE CAST((t.s - ((t.s % t.n) + t.n) % t.n) / t.n AS BIGINT) END AS x FROM m{r} m LEFT JOIN t{r} t ON t.c = m.c AND t.i = m.i)"
            )
    last = rounds
    return f"""WITH kept AS (SELECT vec_id, embedding AS e FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) = 64
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
long_form AS MATERIALIZED (SELECT vec_id, i, CAST(floor(64 * CAST(e[i] AS DOUBLE)) AS BIGINT) AS x FROM kept, range(1, 65) t(i)),
s AS (SELECT vec_id, row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS c FROM kept ORDER BY c LIMIT {k}),
m0 AS MATERIALIZED (SELECT c, i, x FROM s JOIN long_form USING (vec_id)),
{', '.join(steps)},
text AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM m{last} GROUP BY c)
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
       CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256 FROM a{last} JOIN text USING (c)"""


QUERIES = {"op13_subvector_dictionaries": op13_subvector_dictionaries}
ORACLES = {"op13_subvector_dictionaries": _oracle()}
