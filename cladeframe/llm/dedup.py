"""MinHash near-dedup by a chosen-path set similarity join (operator 1).

Equal shingle sets collapse to one representative each. In every independent tree a
representative starts in the node of one minwise token; a node with too many members
branches by two further minwise tokens that a hash of the node chooses, so a pair of
similarity s stays together in some branch with high probability at any depth. Nodes
that are small are compared exhaustively: first by agreement of minwise tokens, then,
for pairs not linked yet, on full shingle sets. Nodes still large at the last depth
are cut into blocks; each is compared by itself, then members of different blocks that are
no component yet, so nothing is left out.
There are as many trees as it takes for a pair at the limit of similarity to meet with a
probability of TARGET_RECALL even if all of its nodes branch down to the last depth (six at
0.85; in first nodes alone such a pair meets with 0.99999). Links within a group are
redundant besides.

Node sizes are counted with map-side combine; the rows of a node come together only
once it is known to be small. Links of a first tree are made into components before
the others run, which then compare only across components.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.llm import textops
from cladeframe.operators.graph import connected_components
from cladeframe.session import read_table, stage

SHINGLE = 5
COORDINATES = 96
#: Share of the pairs at the limit of similarity that have to meet in a node, whatever sizes nodes have.
TARGET_RECALL = 0.997
LEAF_ROWS, LEAF_SHINGLES = 4096, 4_000_000
#: Nodes that choose a second token to branch by: pairs of similarity s meet in (1 + SECOND) * s children.
SECOND = 0.35
DEPTH = 4
#: Pairs whose minwise tokens agree less are not verified: at 96 tokens, a pair of
#: similarity 0.85 agrees that little with a probability of 2 in 100,000.
SLACK = 0.15

_U = np.uint64
_SEEDS = np.random.default_rng(1).integers(1, 2**63, (2, COORDINATES), dtype=np.uint64)
_MULT, _ADD = _SEEDS[0] * _U(2) + _U(1), _SEEDS[1]
_FP = "doc_id long, n_shingles long, key1 long, key2 long, sig binary, nodes array<long>, text_hash long"


def meeting(similarity: float, depth: int = DEPTH) -> float:
    """The probability that a pair meets in some node of a tree whose nodes all branch `depth` times."""
    p = 1.0
    for _ in range(depth):
        p = 1 - (1 - similarity * p) * (1 - SECOND * similarity * p)
    return similarity * p


def trees_for(similarity: float, recall: float = TARGET_RECALL) -> int:
    """How many independent trees it takes for such pairs to meet with this probability."""
    miss = 1 - meeting(similarity)
    n = 1 if miss <= 0 else math.ceil(math.log(1 - recall) / math.log(miss))
    if n > COORDINATES // 2:
        raise ValueError(f"a similarity of {similarity} takes {n} trees, more than half of the minwise tokens")
    return n


def whole_groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """(rows, first rows of the groups and their end) of a stream sorted by key; no group is cut."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        keys = b.column(key).to_numpy()
        last = int(np.searchsorted(keys, keys[-1]))  # where the group that may go on begins
        if last or (held and held[-1].column(key)[held[-1].num_rows - 1].as_py() != keys[0]):
            t = pa.Table.from_batches([*held, b.slice(0, last)])
            yield t, _starts(t, key)
            held = []
        held.append(b.slice(last))
    if held:
        t = pa.Table.from_batches(held)
        yield t, _starts(t, key)


def _starts(t: pa.Table, key: str) -> np.ndarray:
    keys = t.column(key).to_numpy()
    return np.concatenate([[0], np.flatnonzero(keys[1:] != keys[:-1]) + 1, [len(keys)]])


def _signatures(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, COORDINATES)


def shingle_sets(text: pa.Array) -> list[np.ndarray]:
    """Each row's distinct shingle hashes in order; rows without words have none."""
    out = []
    for _, _, buf, offs in textops.slices(text):
        h, first = textops.windows(textops.Words(buf, offs, True), SHINGLE, short=True)
        out += [np.unique(h[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
    return out


def fingerprints(docs: DataFrame, trees: int) -> DataFrame:
    """Set size, a 128-bit key of the set, minwise tokens, the first node in each tree, and a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, j, buf, offs in textops.slices(b.column(1)):
                h, first = textops.windows(textops.Words(buf, offs, True), SHINGLE, short=True)
                sets = [np.unique(h[a:e]) for a, e in zip(first[:-1].tolist(), first[1:].tolist())]
                n = np.array([len(x) for x in sets])
                h, first = np.concatenate(sets), np.concatenate([[0], np.cumsum(n)])
                sig = np.empty((j - i, COORDINATES), np.uint32)
                for c in range(COORDINATES):
                    sig[:, c] = textops.per_row(np.minimum, (h * _MULT[c] + _ADD[c]) >> _U(32), first, 0)
                keys = [textops.per_row(np.add, x, first, 0).view(np.int64) for x in (h, textops.mix(h ^ _ADD[0]))]
                nodes = textops.mix((sig[:, :trees].astype(np.uint64) << _U(8)) + np.arange(trees, dtype=np.uint64)).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(n), *map(pa.array, keys), pa.array([x.tobytes() for x in sig], pa.binary()), pa.array(nodes.tolist(), pa.list_(pa.int64())), b.column(2).slice(i, j - i)],
                    names=["doc_id", "n_shingles", "key1", "key2", "sig", "nodes", "text_hash"],
                )

    text = F.col("text").cast("string")
    return docs.select(F.col("doc_id").cast("long"), text, F.xxhash64(text)).mapInArrow(run, _FP)


def _branch(trees: int):
    """Each row to one or two child nodes, by minwise tokens that the node chooses."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sig = _signatures(b.column("sig"))
            unit = b.column("unit").to_numpy().view(np.uint64)
            for way in (1, 2):
                h = textops.mix(unit + _U(way * textops._M1 % 2**64))
                c = trees + (h % _U(COORDINATES - trees)).astype(np.int64)
                child = textops.mix(h ^ (sig[np.arange(len(c)), c].astype(np.uint64) << _U(20))).view(np.int64)
                out = pa.RecordBatch.from_arrays([pa.array(child), *(b.column(x) for x in ("rep", "n_shingles", "tree"))], names=["unit", "rep", "n_shingles", "tree"])
                yield out if way == 1 else out.filter(pa.array(textops.mix(h + _U(1)) % _U(100) < _U(int(100 * SECOND))))

    return run


def small_nodes(sets: DataFrame, trees: int) -> tuple[DataFrame, DataFrame | None]:
    """(unit, rep, tree): the members of every node to compare, of two representatives at
    least and small enough for one task; and the rows of nodes still large at the last
    depth, of which each block is a unit (None if there are none)."""
    level = sets.select(F.posexplode("nodes").alias("tree", "unit"), "rep", "n_shingles").select("unit", "rep", "n_shingles", "tree")
    found, rest = [], None
    for depth in range(DEPTH + 1):
        sizes = level.groupBy("unit").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("w")).where("m > 1")
        live = stage(level.join(sizes, "unit"), "nodes")
        fits = (F.col("m") <= LEAF_ROWS) & (F.col("w") <= LEAF_SHINGLES)
        found.append(live.where(fits).select("unit", "rep", "tree"))
        large = live.where(~fits)
        if large.isEmpty():
            break
        if depth < DEPTH:
            members = large.select("unit", "rep", "n_shingles", "tree").join(sets.select("rep", "sig"), "rep")
            level = members.mapInArrow(_branch(trees), "unit long, rep long, n_shingles long, tree int")
        else:
            rest = large.select("unit", "rep", "n_shingles")
            found.append(large.select(F.xxhash64("unit", _block("rep", _blocks("m", "w"))).alias("unit"), "rep", "tree"))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out, rest


def _blocks(rows: str, shingles: str) -> Column:
    """How many blocks half the size of a leaf hold so many rows and shingles."""
    return F.ceil(F.greatest(2 * F.col(rows) / LEAF_ROWS, 2 * F.col(shingles) / LEAF_SHINGLES, F.lit(1.0)))


def _block(rep: str, n: Column) -> Column:
    return F.pmod(F.xxhash64(rep), n)


def across_blocks(rest: DataFrame, components: DataFrame) -> DataFrame:
    """(unit, rep): units in which every two members of a large node meet whose components differ.

    Blocks have been compared by themselves. A node whose members are one component by then, as
    the copies of one text are, needs no more. Of the others, members outside of the node's
    largest component meet its blocks and each other, so that the many rows of that component
    are repeated once for every block of the rest, mostly one."""
    named = components.withColumnRenamed("node", "rep")
    rows = rest.join(named, "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    sizes = rows.groupBy("unit", "component").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("w"))
    whole = sizes.groupBy("unit").agg(
        F.count("*").alias("n"), F.max_by(F.struct("component", "m", "w"), F.struct("m", "component")).alias("most"), F.sum("m").alias("m"), F.sum("w").alias("w")
    ).where("n > 1")
    whole = whole.select("unit", "most.component", F.col("most.m").alias("m1"), F.col("most.w").alias("w1"), (F.col("m") - F.col("most.m")).alias("m2"), (F.col("w") - F.col("most.w")).alias("w2"))
    whole = whole.select("unit", F.col("component").alias("main"), _blocks("m1", "w1").alias("n1"), _blocks("m2", "w2").alias("n2"))
    rows = stage(rows.join(whole, "unit"), "across")
    main = F.col("component") == F.col("main")
    of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    a = rows.where(main).select("unit", "rep", _block("rep", F.col("n1")).alias("i"), of("n2").alias("j"))
    b = rows.where(~main).select("unit", "rep", of("n1").alias("i"), _block("rep", F.col("n2")).alias("j"))
    c = rows.where(~main & (F.col("n2") > 1)).select("unit", "rep", of("n2").alias("i"), _block("rep", F.col("n2")).alias("j")).where("i <> j")
    units = a.unionByName(b).select(F.xxhash64("unit", "i", "j").alias("unit"), "rep")
    return units.unionByName(c.select(F.xxhash64("unit", F.least("i", "j"), F.greatest("i", "j"), F.lit(1)).alias("unit"), "rep"))


def _agreeing(sig: np.ndarray, least: int) -> Iterator[np.ndarray]:
    """Pairs i < j whose minwise tokens agree in at least `least` places: those of some rows at a
    time with all others, the best of them first."""
    step = max(1, 200_000 // len(sig))
    for i in range(0, len(sig), step):
        some = sig[i : i + step]
        same = np.zeros((len(some), len(sig)), np.uint8)
        for c in range(COORDINATES):
            same += some[:, c, None] == sig[None, :, c]
        a, b = np.nonzero(same >= least)
        keep = a + i < b
        a, b = a[keep], b[keep]
        order = np.argsort(-same[a, b].astype(np.int16), kind="stable")
        yield np.stack([a[order] + i, b[order]], 1)


def _candidates(least: int):
    """Members of a node that agree well with another member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, first in whole_groups(batches, "unit"):
            sig, keep = _signatures(t.column("sig")), np.zeros(t.num_rows, bool)
            sizes = np.diff(first)
            two = first[:-1][sizes == 2]
            near = (sig[two] == sig[two + 1]).sum(1) >= least
            keep[two[near]] = keep[two[near] + 1] = True
            for a, n in zip(first[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
                for pairs in _agreeing(sig[a : a + n], least):
                    keep[a + pairs.ravel()] = True
            yield from t.filter(pa.array(keep)).select(["unit", "rep", "tree"]).combine_chunks().to_batches()

    return run


def _linked(x: np.ndarray, y: np.ndarray, num: int, den: int) -> bool:
    if den * min(len(x), len(y)) < num * max(len(x), len(y)):
        return False
    same = len(np.intersect1d(x, y, assume_unique=True))
    return den * same >= num * (len(x) + len(y) - same)


def _verify(num: int, den: int, least: int):
    """Components within nodes by links on full sets, as links to each one's least member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t, first in whole_groups(batches, "unit"):
            comp, sig = t.column("component").to_numpy(), _signatures(t.column("sig"))
            sets = [s for chunk in t.column("text").chunks for s in shingle_sets(chunk)]
            links = []
            for a, e in zip(first[:-1].tolist(), first[1:].tolist()):
                names, label = np.unique(comp[a:e], return_inverse=True)  # in the order of their ids
                if len(names) < 2:
                    continue
                own, left = label.copy(), len(names)
                for pairs in _agreeing(sig[a:e], least):
                    if left == 1:
                        break
                    for k in range(0, len(pairs), 1024):
                        some = pairs[k : k + 1024]
                        for i, j in some[label[some[:, 0]] != label[some[:, 1]]].tolist():
                            if label[i] == label[j] or not _linked(sets[a + i], sets[a + j], num, den):
                                continue
                            label[label == max(label[i], label[j])] = min(label[i], label[j])
                            left -= 1
                moved = np.unique(np.stack([own, label], 1)[own != label], axis=0)
                links += zip(names[moved[:, 0]].tolist(), names[moved[:, 1]].tolist())
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return run


def by_unit(rows: DataFrame) -> DataFrame:
    return rows.repartition("unit").sortWithinPartitions("unit")


def near_duplicates(docs: DataFrame, num: int = 85, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per row of docs.

    Documents are linked if den * intersection >= num * union of their distinct 5-word
    shingles of words in lower case (A-Z); fewer words make one shingle. component_id is
    the least doc_id reachable over links, kept whether it is the document's own.
    Null or empty texts, and texts without words, have no shingles and no links. Rows
    without a doc_id link nothing: their component_id is null, and they are kept. Rows
    that repeat a doc_id count as one document. Other columns are ignored.
    """
    return _grouped(docs, num, den).drop("text_hash")


def _grouped(docs: DataFrame, num: int, den: int) -> DataFrame:
    """near_duplicates(), with the xxhash64 of each row's text as text_hash."""
    least = int(np.ceil(COORDINATES * (num / den - SLACK)))
    trees = trees_for(num / den)
    prints = stage(fingerprints(docs, trees), "fingerprints")
    known = prints.where("n_shingles > 0 and doc_id is not null")
    sets = stage(known.groupBy("key1", "key2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("nodes").alias("nodes")), "sets")
    nodes, rest = small_nodes(sets, trees)

    def candidates(units: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members of units that agree well with another one, and the texts of these."""
        members = by_unit(units.join(sets.select("rep", "sig"), "rep"))
        pairs = stage(members.mapInArrow(_candidates(least), "unit long, rep long, tree int"), "candidates")
        wanted = pairs.select("rep").distinct().join(sets.select("rep", "sig"), "rep")
        return pairs, stage(docs.select(F.col("doc_id").cast("long").alias("rep"), F.col("text").cast("string")).join(wanted, "rep"), "texts")

    pairs, texts = candidates(nodes)
    links = None
    for some in (F.col("tree") == 0, F.col("tree") > 0, None):
        if some is None:
            if rest is None:
                break
            pairs, texts = candidates(across_blocks(rest, components).withColumn("tree", F.lit(0)))  # noqa: F821
            some = F.lit(True)
        rows = pairs.where(some).select("unit", "rep")
        if links is None:
            rows = rows.withColumn("component", F.col("rep"))
        else:
            rows = rows.join(components.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))  # noqa: F821
            mixed = rows.groupBy("unit").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("unit")
            rows = rows.join(mixed, "unit", "left_semi")
        more = by_unit(rows.join(texts, "rep").select("unit", "component", "text", "sig")).mapInArrow(_verify(num, den, least), "a long, b long")
        links = stage(more if links is None else more.unionByName(links), "links")
        components = stage(connected_components(links), "components")
    firsts = sets.select("key1", "key2", "rep").join(components.withColumnRenamed("node", "rep"), "rep", "left")
    firsts = firsts.select("key1", "key2", F.coalesce("component", "rep").alias("component"))
    linked = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    out = prints.select("doc_id", "n_shingles", "key1", "key2", "text_hash").join(firsts, ["key1", "key2"], "left")
    out = out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), linked).alias("component_id"), "text_hash")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def keep_one(docs: DataFrame, num: int = 85, den: int = 100) -> DataFrame:
    """The rows of docs, all columns, that near_duplicates() keeps: one document of each group.

    Rows of equal doc_id and text count once: the one of the least other columns stays. A
    row is judged by its own text, also where others repeat its doc_id. Rows without a
    doc_id all stay, repeated texts too, as nothing tells their documents apart.
    """
    kept = _grouped(docs, num, den).where("kept and doc_id is not null").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash")).distinct()
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    named = docs.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("_id"), F.xxhash64(F.col("text").cast("string")).alias("_hash"))
    once = named.agg(F.min(F.struct(*others, "doc_id", "text")).alias("_row")).join(kept, ["_id", "_hash"], "left_semi")
    return once.select("_row.*").select(docs.columns).unionByName(docs.where("doc_id is null"))


def op1_chosen_path_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES = {"op1_chosen_path_dedup": op1_chosen_path_dedup}
ORACLES: dict[str, str] = {}
