"""Named queries over the test tables and, where SQL can say it, their DuckDB SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe import model
from cladeframe.functions import scalars
from cladeframe.operators import census, changes, dims, graph, pairs, profiles, ranking, rsd
from cladeframe.plans import query as Q
from cladeframe.session import read_table, shared_dir, stage
from cladeframe.sources import adapters as A
from cladeframe.sources import readers, sinks
from cladeframe.streaming.load import incremental_pairs, stream_load_orthologs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


E_SQL = A.edges_sql()


def _R6(x: str) -> str:
    """Six places, rounded half up on the shortest decimal, as Spark does."""
    return f"CAST(round(CAST(CAST({x} AS VARCHAR) AS DECIMAL(38, 20)), 6) AS DOUBLE)"


#: Components of `edges`: n (node), cid; g is the genome of a node. Labels fall until each is its component's least node.
C_SQL = f"""WITH RECURSIVE {E_SQL},
e(a, b) AS (SELECT q, s FROM edges UNION SELECT s, q FROM edges),
comp(n, cid) USING KEY (n) AS (SELECT a, min(least(a, b)) FROM e GROUP BY a
 UNION (SELECT e.b, min(c.cid) FROM comp c JOIN e ON e.a = c.n JOIN recurring.comp o ON o.n = e.b WHERE c.cid < o.cid GROUP BY e.b)),
members AS (SELECT cid, p_brand genome, n gene FROM comp JOIN part ON p_partkey = n),
sums AS (SELECT cid, count(*) n_edges, CAST(sum(CAST(dist AS DECIMAL(28, 12))) AS DOUBLE) sum_dist FROM edges JOIN comp ON n = q GROUP BY cid),
stats AS (SELECT cid, n_nodes, n_edges, {_R6('sum_dist')} sum_dist, {_R6('sum_dist / n_edges')} avg_dist, sum_dist / n_edges AS mean_dist, n_classes, bogus FROM sums
          JOIN (SELECT cid, count(*) n_nodes, count(DISTINCT genome) + CAST(bool_or(genome IS NULL) AS INT) n_classes, bool_or(genome IS NULL) bogus FROM members GROUP BY cid) USING (cid)),
cols AS (SELECT DISTINCT genome FROM (SELECT qdb genome FROM edges UNION SELECT sdb FROM edges)),
{A.TERMS_SQL},
ct AS (SELECT DISTINCT cid, term FROM members JOIN terms USING (gene)),
prof AS (SELECT c.cid, list(CASE WHEN m.genome IS NULL THEN 0 ELSE 1 END ORDER BY cols.genome) profile FROM (SELECT DISTINCT cid FROM comp) c CROSS JOIN cols
         LEFT JOIN (SELECT DISTINCT cid, genome FROM members) m ON m.cid = c.cid AND m.genome = cols.genome GROUP BY c.cid),
ham AS (SELECT a.term, a.cid c1, b.cid c2, list_sum(list_transform(list_zip(x.profile, y.profile), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) d
        FROM ct a JOIN ct b ON a.term = b.term JOIN prof x ON x.cid = a.cid JOIN prof y ON y.cid = b.cid WHERE (SELECT count(*) FROM ct t WHERE t.term = a.term) <= 100)
"""


def _result(spark: SparkSession, sf: str, upper: float | None = None) -> Q.Result:
    return Q.orthology_query(A.edges(spark, sf, upper=upper))


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}/{name}"


# Edges


@query(f"WITH {A.edges_sql(5, 10)} SELECT q, s, qdb, sdb, dist FROM edges")
def edges_at_params(spark, sf):
    return A.edges(spark, sf, 5, 10, None)


@query(f"WITH {A.edges_sql(8, 5, 0.05)} SELECT q, s, qdb, sdb, dist FROM edges WHERE dist >= 0.01")
def edges_distance_band(spark, sf):
    return A.edges(spark, sf, upper=None).where(Q.distance_between(0.01, 0.05))


@query(f"WITH {E_SQL}, g AS (SELECT p_partkey FROM part WHERE p_name LIKE 'cold%') SELECT * FROM edges WHERE q IN (FROM g) OR s IN (FROM g)")
def edges_touching_genes(spark, sf):
    some = A.genes(spark, sf).where("gene_name like 'cold%'").select("gene")
    return Q.touching(A.edges(spark, sf), some)


_GRID = "grid AS (SELECT d.div, e.evalue, CAST(round(CAST(d.div AS DOUBLE) * 10) AS INT) dmax, e.k FROM (VALUES ('0.8'), ('0.5'), ('0.2')) d(div), (VALUES ('1e-5', 5), ('1e-10', 10), ('1e-15', 15), ('1e-20', 20)) e(evalue, k))"


@query(f"""WITH {A.EVIDENCE_SQL}, {_GRID}, found AS (SELECT DISTINCT div, evalue, q, s FROM evidence JOIN grid ON dneed <= dmax AND ek >= k)
SELECT g.div, g.evalue, count(f.q) AS num_orthologs FROM grid g LEFT JOIN found f ON f.div = g.div AND f.evalue = g.evalue GROUP BY ALL""")
def params_grid_counts(spark, sf):
    grid = model.params(spark).select("div", "evalue", F.round(F.col("max_div") * 10).cast("int").alias("dmax"), "min_exponent")
    # A pair of genes counts at every parameter set that its best evidence passes: these are
    # few per pair, so that pairs are reduced to them before they meet the grid.
    best = A.evidence(spark, sf).select("q", "s", "dneed", "ek").groupBy("q", "s", "dneed").agg(F.max("ek").alias("ek"))
    found = best.join(F.broadcast(grid), (F.col("dneed") <= F.col("dmax")) & (F.col("ek") >= F.col("min_exponent")))  # 12 rows
    counts = found.select("div", "evalue", "q", "s").distinct().groupBy("div", "evalue").agg(F.count("*").alias("n"))
    return grid.join(counts, ["div", "evalue"], "left").select("div", "evalue", F.coalesce("n", F.lit(0)).alias("num_orthologs"))


@query(f"""WITH {E_SQL}, b AS (SELECT DISTINCT p_brand FROM part), n AS (SELECT qdb, sdb, count(*) n FROM edges GROUP BY ALL)
SELECT x.p_brand AS qdb, y.p_brand AS sdb, '0.8' AS div, '1e-5' AS evalue, CAST(coalesce(n, 0) AS INT) AS num_orthologs FROM b x JOIN b y ON x.p_brand < y.p_brand LEFT JOIN n ON qdb = x.p_brand AND sdb = y.p_brand""")
def num_orthologs_of_pairs(spark, sf):
    """Counts of the nested form, in which a pair without orthologs is a row too."""
    keys = {"div": F.lit("0.8"), "evalue": F.lit("1e-5")}
    found = A.edges(spark, sf).select("qdb", "sdb", F.col("q").cast("string").alias("qid"), F.col("s").cast("string").alias("sid"), "dist")
    every = pairs.genome_pairs(A.genomes(spark, sf)).join(found, ["qdb", "sdb"], "left").withColumns(keys)
    return model.num_orthologs(model.nest(every))


@query(f"WITH {E_SQL} SELECT q, s, dist FROM edges WHERE qdb = 'Brand#10' AND sdb = 'Brand#9'")
def orthologs_for_pair(spark, sf):
    tagged = A.edges(spark, sf).withColumns({"div": F.lit("0.8"), "evalue": F.lit("1e-5")})
    return Q.orthologs_for(tagged, "Brand#9", "Brand#10", "0.8", "1e-5").select("q", "s", "dist")


@query(f"""WITH {E_SQL}, own AS (SELECT qdb, sdb, string_agg('OR' || chr(9) || q || chr(9) || s, chr(10) ORDER BY q::VARCHAR, s::VARCHAR) body, string_agg(CAST(round(dist * 1000000) AS BIGINT)::VARCHAR, ',' ORDER BY q::VARCHAR, s::VARCHAR) d
 FROM edges WHERE qdb = 'Brand#10' AND sdb = 'Brand#9' GROUP BY qdb, sdb)
SELECT qdb, sdb, concat_ws(chr(10), concat_ws(chr(9), 'PA', qdb, sdb, '0.8', '1e-5'), body) AS value, d AS millionths FROM own""")
def raw_pair_download(spark, sf):
    """The text, with its distances in millionths beside it, as numbers have more than one spelling."""
    rows = A.edges(spark, sf).select("qdb", "sdb", F.lit("0.8").alias("div"), F.lit("1e-5").alias("evalue"), F.col("q").cast("string").alias("qid"), F.col("s").cast("string").alias("sid"), "dist")
    text = Q.raw_pair_download(rows, "Brand#9", "Brand#10", "0.8", "1e-5")
    numbers = F.transform(F.regexp_extract_all("value", F.lit(r"OR\t[^\t]+\t[^\t]+\t(\S+)"), 1), lambda x: F.round(x.cast("double") * 1000000).cast("long").cast("string"))
    return text.select("qdb", "sdb", F.regexp_replace("value", r"(?m)^(OR\t[^\t]+\t[^\t]+)\t.*$", "$1").alias("value"), F.array_join(numbers, ",").alias("millionths"))


@query(f"WITH {E_SQL} SELECT '5' AS release, DATE '2013-06-01' AS release_date, (SELECT count(DISTINCT p_brand) FROM part) AS num_genomes, (SELECT count(DISTINCT p_brand) * (count(DISTINCT p_brand) - 1) // 2 FROM part) AS num_pairs, count(*) AS num_orthologs FROM edges")
def release_stats(spark, sf, upper=None):
    return Q.release_stats(A.genomes(spark, sf), A.edges(spark, sf, upper=upper), "5", "2013-06-01")


# Clusters


@query(f"{C_SQL} SELECT n AS node, cid AS component FROM comp")
def components(spark, sf, upper=None):
    return graph.connected_components(A.edges(spark, sf, upper=upper), "q", "s")


def _classes(spark, sf):
    return A.genes(spark, sf).select(F.col("gene").alias("node"), F.col("genome").alias("class"))


def _stats(spark, sf, upper=None):
    own = stage(A.edges(spark, sf, upper=upper), "edges")
    return graph.cluster_stats(own, graph.connected_components(own, "q", "s"), _classes(spark, sf), "q", "s")


@query(f"{C_SQL} SELECT cid, n_nodes, n_edges, sum_dist, avg_dist, n_classes FROM stats")
def cluster_stats(spark, sf, upper=None):
    return _stats(spark, sf, upper).select("cid", "n_nodes", "n_edges", F.round("sum_dist", 6).alias("sum_dist"), F.round("avg_dist", 6).alias("avg_dist"), "n_classes")


_SUMMARY = """count(*) n_clusters, CAST(sum(n_nodes) AS BIGINT) sum_nodes, CAST(sum(n_edges) AS BIGINT) sum_edges, round(sum(n_edges) / sum(n_nodes * (n_nodes - 1) / 2), 6) global_tcc,
 round(min(n_edges / (n_nodes * (n_nodes - 1) / 2)), 6) min_tcc, round(max(n_edges / (n_nodes * (n_nodes - 1) / 2)), 6) max_tcc, round(avg(n_edges / (n_nodes * (n_nodes - 1) / 2)), 6) avg_tcc,
 min(n_nodes) min_n_nodes, max(n_nodes) max_n_nodes, round(avg(n_nodes), 6) avg_n_nodes, min(n_edges) min_n_edges, max(n_edges) max_n_edges, round(avg(n_edges), 6) avg_n_edges,
 min(n_classes) min_n_classes, max(n_classes) max_n_classes, round(avg(n_classes), 6) avg_n_classes, round(min(mean_dist), 6) min_avg_dist, round(max(mean_dist), 6) max_avg_dist, round(avg(mean_dist), 6) avg_avg_dist, bool_or(bogus) AS bogus"""


def _rounded(df):
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


@query(f"{C_SQL} SELECT {_SUMMARY} FROM stats")
def clustering_summary(spark, sf, upper=None):
    return _rounded(graph.clustering_summary(_stats(spark, sf, upper)))


def _restricted(where: str, upper: float | None = None) -> str:
    return C_SQL.replace(E_SQL, A.edges_sql(upper=upper, where=where))


#: Ids by the kinds of prefix, made from the genes' numbers; one in eight has an unknown one.
_PREFIX_SQL = "['At', 'CE', 'Hs', 'SP', 'EC', 'Y', '', 'q'][CAST(p_partkey % 8 AS INT) + 1] || CAST(10 + p_partkey AS VARCHAR)"
_CLASS_SQL = "['ath', 'cel', 'hsa', 'spo', 'ecu', 'sce', 'dme', NULL][CAST(p_partkey % 8 AS INT) + 1]"


def _prefixed(spark, sf):
    k = F.col("p_partkey")
    first = F.element_at(F.array(*map(F.lit, ("At", "CE", "Hs", "SP", "EC", "Y", "", "q"))), (k % 8 + 1).cast("int"))
    ids = read_table(spark, sf, "part").select(k.alias("node"), F.concat(first, (k + 10).cast("string")).alias("id"))
    return ids.withColumn("class", scalars.class_from_prefix(F.col("id")))


@query(f"SELECT p_partkey AS node, {_PREFIX_SQL} AS id, {_CLASS_SQL} AS class FROM part")
def gene_classes(spark, sf):
    return _prefixed(spark, sf)


@query(f"{C_SQL.replace('p_brand genome', _CLASS_SQL + ' genome')} SELECT {_SUMMARY} FROM stats")
def clustering_summary_of_classes(spark, sf, upper=None):
    """Classes by the ids' prefixes, with nodes of none."""
    own = stage(A.edges(spark, sf, upper=upper), "edges")
    return _rounded(graph.clustering_summary(graph.cluster_stats(own, graph.connected_components(own, "q", "s"), _prefixed(spark, sf).select("node", "class"), "q", "s")))


def _sampled_sql(i: int) -> str:
    own = f"{A.edges_sql().replace('edges AS', 'every_edge AS')}, ordered AS (SELECT *, row_number() OVER (ORDER BY dist, q, s) nth FROM every_edge), edges AS (SELECT q, s, qdb, sdb, dist FROM ordered WHERE nth <= {i} * ((SELECT count(*) FROM every_edge) // 4))"
    return f"(SELECT * FROM ({C_SQL.replace(E_SQL, own)} SELECT (SELECT count(*) FROM edges) AS n_seen, (SELECT max(dist) FROM edges) AS distance, {_SUMMARY} FROM stats))"


@query(" UNION ALL ".join(map(_sampled_sql, range(1, 5))))
def summary_of_every_nth_edge(spark, sf):
    """Clusters of the nearest edges, after each quarter of them."""
    own = stage(A.edges(spark, sf), "edges")
    every = max(1, own.count() // 4)
    return _rounded(graph.sampled_summaries(own, _classes(spark, sf), every, "dist", "q", "s", a="q", b="s"))


def _sweep_sql(limit):
    return _restricted("true", limit) + f"SELECT {limit}::DOUBLE AS distance, {_SUMMARY} FROM stats"


@query(" UNION ALL ".join(f"({_sweep_sql(x)})" for x in (0.01, 0.02, 0.05)))
def threshold_sweep(spark, sf):
    own = stage(A.edges(spark, sf, upper=0.05), "edges")
    return _rounded(graph.threshold_sweep(own, _classes(spark, sf), [0.01, 0.02, 0.05], "q", "s"))


@query(f"{C_SQL} SELECT cid, q, s, dist FROM edges JOIN comp ON n = q")
def cluster_edges(spark, sf, upper=None):
    return _result(spark, sf, upper).edges.select("cid", "q", "s", "dist")


# Queries of users: the genomes of Europe and so on are brands here

_FIVE = ["brand#1", "brand#12", "brand#15", "brand#20", "brand#7"]
_FIVE_SQL = "qdb IN ('Brand#1', 'Brand#12', 'Brand#15', 'Brand#20', 'Brand#7') AND sdb IN ('Brand#1', 'Brand#12', 'Brand#15', 'Brand#20', 'Brand#7')"
_CELLS = "array_to_string(list_transform((SELECT list(genome ORDER BY genome) FROM cols), lambda g: coalesce(array_to_string(list_sort(list_transform(list_filter(list(m), lambda x: x.genome = g), lambda x: x.gene)), ','), '')), ';')"


def _matrix(result: Q.Result) -> DataFrame:
    cells = F.array_join(F.transform("cells", lambda c: F.array_join(c.cast("array<string>"), ",")), ";")
    return result.matrix().select("cid", cells.alias("cells"), "avg_dist")


_MATRIX = "SELECT cid, cells, avg_dist FROM (SELECT cid, " + _CELLS.replace("list(m)", "list({'genome': genome, 'gene': gene})") + " cells FROM members GROUP BY cid) JOIN stats USING (cid)"


@query(f"{_restricted(_FIVE_SQL)} {_MATRIX}")
def retrieve_clusters(spark, sf, upper=None):
    return _matrix(Q.retrieve(A.edges(spark, sf, upper=upper), A.genomes(spark, sf), _FIVE))


_TWO_SQL = "qdb IN ('Brand#1', 'Brand#12') AND sdb IN ('Brand#1', 'Brand#12')"


@query(f"{_restricted(_TWO_SQL)} {_MATRIX} WHERE n_edges >= n_nodes * (n_nodes - 1) / 2 AND n_classes = (SELECT count(*) FROM cols)")
def retrieve_tc_only(spark, sf, upper=None):
    return _matrix(Q.retrieve(A.edges(spark, sf, upper=upper), A.genomes(spark, sf), ["brand#1", "brand#12"], tc_only=True))


_BROWSE_SQL = "(qdb = 'Brand#10' OR sdb = 'Brand#10') AND (qdb IN ('Brand#2', 'Brand#20', 'Brand#5') OR sdb IN ('Brand#2', 'Brand#20', 'Brand#5'))"


@query(f"{_restricted(_BROWSE_SQL)} SELECT cid, genome, gene FROM members")
def browse_clusters(spark, sf, upper=None):
    sequences = A.genes(spark, sf)
    return Q.browse(A.edges(spark, sf, upper=upper), A.genomes(spark, sf), sequences, "brand#10", ["brand#2", "brand#20", "brand#5"]).members


_NAMED_SQL = _BROWSE_SQL + " AND (q IN (SELECT p_partkey FROM part WHERE p_name LIKE 'cold%' AND p_brand = 'Brand#10') OR s IN (SELECT p_partkey FROM part WHERE p_name LIKE 'cold%' AND p_brand = 'Brand#10'))"


@query(f"{_restricted(_NAMED_SQL)} SELECT cid, genome, gene FROM members")
def browse_gene_ids(spark, sf, upper=None):
    own = A.genes(spark, sf).where("genome = 'Brand#10' and gene_name like 'cold%'").select("gene")
    return Q.orthology_query(A.edges(spark, sf, upper=upper), genome="Brand#10", limit_genomes=["Brand#2", "Brand#20", "Brand#5"], seq_ids=own).members


_FIRST_SQL = "(SELECT p_partkey FROM part WHERE p_brand = 'Brand#10' AND p_name = (SELECT min(p_name) FROM part WHERE p_brand = 'Brand#10'))"


@query(f"{_restricted(f'{_BROWSE_SQL} AND (q IN {_FIRST_SQL} OR s IN {_FIRST_SQL})')} SELECT cid, genome, gene FROM members")
def browse_gene_name(spark, sf, upper=None):
    """The clusters of the genes of the first name, of which there may be several, in the primary genome."""
    sequences = A.genes(spark, sf)
    (name,) = sequences.where("genome = 'Brand#10'").agg(F.min("gene_name")).first()
    return Q.browse(A.edges(spark, sf, upper=upper), A.genomes(spark, sf), sequences, "brand#10", ["brand#2", "brand#20", "brand#5"], name or "", "gene_name").members


@query(f"{C_SQL} {_MATRIX}")
def cluster_matrix(spark, sf, upper=None):
    return _matrix(_result(spark, sf, upper))


@query(f"{C_SQL} SELECT cid, genome, part, list(gene ORDER BY gene) AS genes FROM (SELECT *, (row_number() OVER (ORDER BY cid, genome NULLS FIRST, gene) - 1) // 1000 AS part FROM members) GROUP BY ALL")
def cluster_cells(spark, sf, upper=None):
    return profiles.cluster_cells(_result(spark, sf, upper).members)


@query(f"{C_SQL} SELECT cid, array_to_string(profile, '') AS profile FROM prof")
def profile_rows(spark, sf, upper=None):
    return _result(spark, sf, upper).profiles().select("cid", F.array_join(F.transform("profile", lambda x: x.cast("string")), "").alias("profile"))


@query(f"""{C_SQL} SELECT cols.genome, string_agg(CASE WHEN m.genome IS NULL THEN '0' ELSE '1' END, '' ORDER BY c.cid) AS profile FROM cols CROSS JOIN (SELECT DISTINCT cid FROM comp) c
LEFT JOIN (SELECT DISTINCT cid, genome FROM members) m ON m.cid = c.cid AND m.genome = cols.genome GROUP BY cols.genome""")
def transposed_profiles(spark, sf, upper=None):
    r = _result(spark, sf, upper)
    rows = profiles.transposed_profiles(r.members, r.stats, r.genomes)
    return rows.select("genome", F.array_join(F.transform("profile", lambda x: x.cast("string")), "").alias("profile"))


@query(f"{C_SQL} SELECT array_to_string(profile, '') AS profile, count(*) AS n, string_agg(CAST(cid AS VARCHAR), ',' ORDER BY cid) AS clusters FROM prof GROUP BY 1")
def profile_counts(spark, sf, upper=None):
    p = _result(spark, sf, upper).profiles()
    rows = profiles.profile_counts(p, p.select("cid", F.col("cid").alias("info")))
    return rows.select(F.array_join(F.transform("profile", lambda x: x.cast("string")), "").alias("profile"), "n", F.array_join(F.col("infos").cast("array<string>"), ",").alias("clusters"))


@query(f"""{C_SQL}, k AS (SELECT cid, row_number() OVER (ORDER BY cid) - 1 p FROM (SELECT DISTINCT cid FROM comp)) SELECT cols.genome, p // 20 AS block,
string_agg(CASE WHEN m.genome IS NULL THEN '0' ELSE '1' END, '' ORDER BY k.cid) AS part FROM cols CROSS JOIN k LEFT JOIN (SELECT DISTINCT cid, genome FROM members) m ON m.cid = k.cid AND m.genome = cols.genome GROUP BY ALL""")
def transposed_profile_blocks(spark, sf, upper=None):
    r = _result(spark, sf, upper)
    return profiles.transposed_blocks(r.members, r.stats, r.genomes, 20)


@query(f"{C_SQL} SELECT array_to_string(profile, '') AS profile, count(*) OVER (PARTITION BY profile) AS n, cid FROM prof")
def profile_clusters(spark, sf, upper=None):
    p = _result(spark, sf, upper).profiles()
    rows = profiles.profile_members(p, p.select("cid", F.col("cid").alias("info")))
    return rows.select(F.array_join(F.transform("profile", lambda x: x.cast("string")), "").alias("profile"), "n", F.col("info").alias("cid"))


@query(f"{C_SQL} SELECT cid, string_agg(term, ',' ORDER BY term) AS terms FROM ct GROUP BY cid")
def cluster_terms(spark, sf, upper=None):
    own = profiles.cluster_terms(_result(spark, sf, upper).members, A.terms(spark, sf))
    return own.groupBy("cid").agg(F.array_join(F.array_sort(F.collect_list("term")), ",").alias("terms"))


_PAIRWISE = "SELECT term, count(DISTINCT c1) AS n_clusters, round(coalesce(sum(CASE WHEN c1 < c2 THEN d END) / nullif(count(*) FILTER (c1 < c2), 0), 0.0), 6) AS mean_hamming FROM ham GROUP BY term"


@query(f"{C_SQL} {_PAIRWISE}")
def terms_summary(spark, sf, upper=None):
    return Q.terms_summary(_result(spark, sf, upper), A.terms(spark, sf))


@query(f"""{C_SQL}, t AS (SELECT term, count(*) n FROM ct GROUP BY term), pick AS (SELECT term FROM t WHERE n <= 100 ORDER BY n DESC, term LIMIT 1), mean AS ({_PAIRWISE})
SELECT cid, term, n_clusters, mean_hamming, n_nodes FROM ct JOIN pick USING (term) JOIN mean USING (term) JOIN stats USING (cid)""")
def term_view(spark, sf, upper=None):
    r, terms = _result(spark, sf, upper), A.terms(spark, sf)
    counts = profiles.cluster_terms(r.members, terms).groupBy("term").agg(F.count("*").alias("n")).where("n <= 100")
    first = counts.orderBy(F.desc("n"), "term").first()
    return Q.term_view(r, terms, first["term"] if first else "")


@query(f"""{C_SQL}, pick AS (SELECT cid FROM stats ORDER BY n_nodes DESC, cid LIMIT 1), many AS (SELECT term, count(*) n FROM ct GROUP BY term), mean AS ({_PAIRWISE}),
own AS (SELECT ct.term, x.d, ct.cid FROM ct JOIN (SELECT term FROM ct WHERE cid = (FROM pick)) USING (term)
        JOIN (SELECT y.cid, list_sum(list_transform(list_zip(y.profile, z.profile), lambda w: CASE WHEN w[1] <> w[2] THEN 1 ELSE 0 END)) d FROM prof y, prof z WHERE z.cid = (FROM pick)) x ON x.cid = ct.cid)
SELECT term, many.n AS n_clusters, mean_hamming, round(sum(d) / count(*), 6) AS mean_from FROM own JOIN many USING (term) LEFT JOIN mean USING (term) GROUP BY ALL""")
def gene_view(spark, sf, upper=None):
    r = _result(spark, sf, upper)
    first = r.stats.orderBy(F.desc("n_nodes"), "cid").first()
    return Q.gene_view(r, A.terms(spark, sf), first["cid"] if first else -1)


@query(f"""{C_SQL}, pick AS (SELECT cid FROM stats ORDER BY n_nodes DESC, cid LIMIT 1) SELECT genome, gene, '>' || p_brand || '|' || gene || chr(10) || upper(p_type) AS value FROM members JOIN part ON p_partkey = gene WHERE cid = (FROM pick)""")
def gene_view_sequences(spark, sf, upper=None):
    r = _result(spark, sf, upper)
    first = r.stats.orderBy(F.desc("n_nodes"), "cid").first()
    part = read_table(spark, sf, "part")
    sequences = part.select(F.col("p_partkey").alias("gene"), F.concat(F.lit(">"), F.concat_ws("|", "p_brand", F.col("p_partkey").cast("string"))).alias("nameline"), F.upper("p_type").alias("sequence"))
    return Q.gene_sequences(r, sequences, first["cid"] if first else -1)


@query(f"""{C_SQL}, pick AS (SELECT cid FROM stats ORDER BY n_nodes DESC, cid LIMIT 1) SELECT q, qdb, s, sdb, dist FROM edges JOIN comp ON n = q WHERE cid = (FROM pick)""")
def gene_view_edges(spark, sf, upper=None):
    r = _result(spark, sf, upper)
    first = r.stats.orderBy(F.desc("n_nodes"), "cid").first()
    return Q.gene_edges(r, first["cid"] if first else -1)


@query(f"""{C_SQL}, named AS (SELECT cid, first(p_name ORDER BY CASE genome WHEN 'Brand#5' THEN 1 WHEN 'Brand#11' THEN 2 ELSE 3 END, genome, gene) gene_name FROM members JOIN part ON p_partkey = gene WHERE p_name <> '' GROUP BY cid)
SELECT cid, gene_name, avg_dist, (SELECT count(*) FROM ct WHERE ct.cid = stats.cid) AS n_terms, array_to_string(profile, '') AS profile, n_nodes AS n_genes FROM stats JOIN named USING (cid) JOIN prof USING (cid)""")
def genes_summary(spark, sf, upper=None):
    return Q.genes_summary(_result(spark, sf, upper), A.names(spark, sf), A.terms(spark, sf), ["Brand#5", "Brand#11"])


@query(f"""{C_SQL}, info AS (SELECT cid, gene, concat_ws(' ', gene, p_name, (SELECT min(term) FROM terms WHERE terms.gene = members.gene)) info FROM members JOIN part ON p_partkey = gene)
SELECT array_to_string(profile, '') AS profile, count(DISTINCT cid) AS n, first(info ORDER BY gene) AS info FROM prof JOIN info USING (cid) GROUP BY 1""")
def hamming_profile(spark, sf, upper=None):
    return Q.hamming_profile(_result(spark, sf, upper), A.names(spark, sf), A.terms(spark, sf))


@query(f"""{_restricted('true', A.WITHIN)}, m AS ({_MATRIX}) SELECT cid, cells, avg_dist FROM m ORDER BY cid LIMIT 10 OFFSET 10""")
def page_clusters(spark, sf):
    """The second page of the clusters within a distance."""
    return profiles.page(_matrix(_result(spark, sf, A.WITHIN)), "cid", 2, 10)


@query(f"""{C_SQL}, top AS (SELECT cid FROM stats ORDER BY cid LIMIT 5), m AS ({_MATRIX})
SELECT cid, cells, avg_dist, array_to_string(profile, '') AS profile, (SELECT string_agg(term, ',' ORDER BY term) FROM ct WHERE ct.cid = prof.cid) AS terms FROM prof JOIN top USING (cid) JOIN m USING (cid)""")
def clusters_view(spark, sf, upper=None):
    rows = Q.clusters_view(_result(spark, sf, upper), A.names(spark, sf), A.terms(spark, sf), 1, 5)
    cells = F.array_join(F.transform("cells", lambda c: F.array_join(c.cast("array<string>"), ",")), ";")
    return rows.select("cid", cells.alias("cells"), "avg_dist", F.array_join(F.transform("profile", lambda x: x.cast("string")), "").alias("profile"), F.array_join("terms", ",").alias("terms"))


@query(f"""{C_SQL}, i AS (SELECT cid, genome, string_agg(CAST(gene AS VARCHAR), ', ' ORDER BY CAST(gene AS VARCHAR)) ids FROM members GROUP BY ALL),
x AS (SELECT c.cid, string_agg(coalesce(ids, ''), '; ' ORDER BY cols.genome) ids FROM (SELECT DISTINCT cid FROM comp) c CROSS JOIN cols LEFT JOIN i ON i.cid = c.cid AND i.genome = cols.genome GROUP BY c.cid)
SELECT p.cid, array_to_string(profile, chr(9)) || chr(9) || concat_ws(' | ', ids, coalesce((SELECT string_agg(DISTINCT p_name, ', ' ORDER BY p_name) FROM members m JOIN part ON p_partkey = gene WHERE m.cid = p.cid), ''),
 coalesce((SELECT string_agg(term, ', ' ORDER BY term) FROM ct WHERE ct.cid = p.cid), '')) AS value FROM prof p JOIN x USING (cid)
UNION ALL SELECT NULL, (SELECT string_agg(genome, chr(9) ORDER BY genome) FROM cols) || chr(9) || 'Cluster_Info=gene, ids; per; genome | gene, names | go, terms'""")
def profile_matrix_text(spark, sf, upper=None):
    r = _result(spark, sf, upper)
    return sinks.profile_matrix_text(r.members, r.genomes, A.names(spark, sf), A.terms(spark, sf))


@query(f"""{C_SQL}, f AS (SELECT c.cid, cols.genome, m.gene FROM (SELECT DISTINCT cid FROM comp) c CROSS JOIN cols LEFT JOIN members m ON m.cid = c.cid AND m.genome = cols.genome)
SELECT NULL AS cid, 0 AS part, NULL AS genome, NULL AS gene, 'Orthology Search Results' AS value UNION ALL SELECT NULL, 1, NULL, NULL, '' UNION ALL SELECT NULL, 3, NULL, NULL, ''
UNION ALL SELECT NULL, 2, NULL, NULL, CASE WHEN count(*) = 0 THEN 'No results' WHEN count(*) = 1 THEN '1 result' ELSE count(*) || ' results' END || ' found for your search.' FROM stats
UNION ALL SELECT cid, 0, NULL, NULL, 'Gene Cluster #' || row_number() OVER (ORDER BY cid) || ' | Average Evolutionary Distance: ' || CAST(avg_dist AS DECIMAL(18, 6)) FROM stats
UNION ALL SELECT cid, 1, NULL, NULL, concat_ws(chr(9), 'Id', 'Genome', 'Gene Name', 'GO Terms') FROM stats UNION ALL SELECT cid, 3, NULL, NULL, '' FROM stats
UNION ALL SELECT cid, 2, genome, gene, concat_ws(chr(9), coalesce(CAST(gene AS VARCHAR), '-'), genome, coalesce(p_name, '-'), coalesce((SELECT string_agg(term, ', ' ORDER BY term) FROM terms WHERE terms.gene = f.gene), '-')) AS value
FROM f LEFT JOIN part ON p_partkey = gene""")
def result_text(spark, sf, upper=None):
    r = _result(spark, sf, upper)
    listed = spark.createDataFrame([(g,) for g in r.genomes], "genome string")
    return sinks.result_lines(r.members, r.stats, listed, A.names(spark, sf), A.terms(spark, sf))


_LINES = "t AS (SELECT cols.genome, list(CASE WHEN m.genome IS NULL THEN 0 ELSE 1 END ORDER BY c.cid) profile FROM cols CROSS JOIN (SELECT DISTINCT cid FROM comp) c LEFT JOIN (SELECT DISTINCT cid, genome FROM members) m ON m.cid = c.cid AND m.genome = cols.genome GROUP BY cols.genome)"


@query(f"{C_SQL}, {_LINES} SELECT 0 AS line_no, (SELECT count(*) || ' ' || max(len(profile)) FROM t) AS value UNION ALL SELECT 1, rpad(substr(genome, 1, 10), 10, ' ') || array_to_string(profile, ' ') FROM t")
def phylip_matrix(spark, sf, upper=None):
    r = _result(spark, sf, upper)
    return sinks.phylip_matrix(profiles.transposed_profiles(r.members, r.stats, r.genomes))


@query(f"""{C_SQL}, {_LINES} SELECT 0 AS line_no, '#Nexus' AS value UNION ALL SELECT 1, 'Begin data;' UNION ALL SELECT 2, 'Dimensions ntax=' || count(*) || ' nchar=' || max(len(profile)) || ';' FROM t
UNION ALL SELECT 3, 'Format datatype=standard symbols="01";' UNION ALL SELECT 4, 'Matrix' UNION ALL SELECT 5, genome || ' ' || array_to_string(profile, '') FROM t UNION ALL SELECT 6, ';' || chr(10) || 'End;'""")
def nexus_matrix(spark, sf, upper=None):
    r = _result(spark, sf, upper)
    return sinks.nexus_matrix(profiles.transposed_profiles(r.members, r.stats, r.genomes))


_PIECES = """k AS (SELECT cid, row_number() OVER (ORDER BY cid) - 1 p FROM (SELECT DISTINCT cid FROM comp)), o AS (SELECT genome, CAST(row_number() OVER (ORDER BY genome) AS INT) i FROM cols),
b AS (SELECT i, p // 20 block, string_agg(CASE WHEN m.genome IS NULL THEN '0' ELSE '1' END, '' ORDER BY k.cid) part FROM o CROSS JOIN k LEFT JOIN (SELECT DISTINCT cid, genome FROM members) m ON m.cid = k.cid AND m.genome = o.genome GROUP BY ALL)"""


@query(f"""{C_SQL}, {_PIECES}, pieces(line, piece, value) AS (SELECT 0, 0, '#Nexus' || chr(10) UNION ALL SELECT 1, 0, 'Begin data;' || chr(10)
UNION ALL SELECT 2, 0, 'Dimensions ntax=' || (SELECT count(*) FROM o) || ' nchar=' || (SELECT count(*) FROM k) || ';' || chr(10)
UNION ALL SELECT 3, 0, 'Format datatype=standard symbols="01";' || chr(10) UNION ALL SELECT 4, 0, 'Matrix' || chr(10) UNION ALL SELECT 4 + i, 0, genome || ' ' FROM o
UNION ALL SELECT 4 + i, block + 1, part FROM b UNION ALL SELECT 4 + i, (SELECT max(block) + 2 FROM b), chr(10) FROM o
UNION ALL SELECT 5 + (SELECT count(*) FROM o), 0, ';' || chr(10) UNION ALL SELECT 6 + (SELECT count(*) FROM o), 0, 'End;' || chr(10)) SELECT * FROM pieces""")
def nexus_pieces(spark, sf, upper=None):
    """The matrix in pieces that don't grow with the clusters."""
    r = _result(spark, sf, upper)
    return sinks.matrix_pieces(profiles.genome_blocks(r.members, r.stats, r.genomes, 20), r.genomes, "nexus")


def _counted(kind: str, line: str) -> str:
    n = lambda c: f"sum(length({line}) - length(replace({line}, '{c}', '')))"
    return f"SELECT '{kind}' AS kind, CAST(sum(length({line})) AS BIGINT) chars, CAST({n(0)} AS BIGINT) zeros, CAST({n(1)} AS BIGINT) ones FROM"


@query(f"""{C_SQL}, {_LINES}, nx AS (SELECT '#NexusBegin data;Format datatype=standard symbols="01";Matrix;End;' AS v UNION ALL SELECT 'Dimensions ntax=' || count(*) || ' nchar=' || max(len(profile)) || ';' FROM t
UNION ALL SELECT genome || ' ' || array_to_string(profile, '') FROM t), ph AS (SELECT count(*) || ' ' || max(len(profile)) AS v FROM t UNION ALL SELECT rpad(substr(genome, 1, 10), 10, ' ') || array_to_string(profile, ' ') FROM t)
{_counted('nexus', 'v')} nx UNION ALL {_counted('phylip', 'v')} ph""")
def matrix_files(spark, sf, upper=None):
    """Both matrices written as files whose lines no task holds, and what is read back of them."""
    r, found = _result(spark, sf, upper), []
    for kind in ("nexus", "phylip"):
        path = _scratch(spark, kind)
        Q.export_matrix(r, kind, path)
        n = lambda c: F.sum(F.length("value") - F.length(F.replace("value", F.lit(c), F.lit(""))))
        found.append(spark.read.text(path).agg(F.lit(kind).alias("kind"), F.sum(F.length("value")).alias("chars"), n("0").alias("zeros"), n("1").alias("ones")))
    return found[0].unionByName(found[1])


def _numbered(spark, sf, members):
    return ranking.dense_ids(members.select("gene", "genome").distinct(), "genome", "gene", name="num")


def _xml_sql(score: str, groups: str) -> str:
    """All lines of a document, with the values of its scores as numbers beside them; num and groups are at hand."""
    return f"""SELECT section, ord, value, score FROM (SELECT 0 AS section, '' AS ord, '<orthoXML xmlns="http://orthoXML.org/2011/" version="0.3">' AS value, CAST(NULL AS DOUBLE) AS score
UNION ALL SELECT 1, genome, '<species name="' || genome || '"><database><genes>' || string_agg('<gene id="' || num || '" protId="' || gene || '"/>', '' ORDER BY num) || '</genes></database></species>', NULL FROM num GROUP BY genome
UNION ALL SELECT 2, '', '<scores><scoreDef id="{score}" desc="distance"/></scores>', NULL UNION ALL SELECT 3, '', '<groups>', NULL UNION ALL SELECT 5, '', '</groups></orthoXML>', NULL
UNION ALL {groups})"""


def _xml_lines(xml: DataFrame, *more: str) -> DataFrame:
    number = F.nullif(F.regexp_extract("value", '<score [^>]* value="([^"]*)"', 1), F.lit("")).cast("double")
    return xml.select("section", "ord", *more, F.regexp_replace("value", '(<score [^>]*) value="[^"]*"', "$1").alias("value"), F.round(number, 6).alias("score"))


@query(f"""{C_SQL}, num AS (SELECT gene, genome, row_number() OVER (ORDER BY genome, gene) num FROM (SELECT DISTINCT gene, genome FROM members)) """ + _xml_sql("avgdist", """SELECT 4, lpad(cid::VARCHAR, 20, '0'),
'<orthologGroup id="' || cid || '"><score id="avgdist"/>' || (SELECT string_agg('<geneRef id="' || num || '"/>', '' ORDER BY num) FROM members m JOIN num USING (gene) WHERE m.cid = stats.cid) || '</orthologGroup>', avg_dist FROM stats"""))
def orthoxml_groups(spark, sf, upper=None):
    r = _result(spark, sf, upper)
    genes = stage(_numbered(spark, sf, r.members), "numbered")
    return _xml_lines(sinks.orthoxml_groups(r.members.select("cid", "gene"), r.stats.select("cid", "avg_dist"), genes))


@query(f"""{C_SQL}, num AS (SELECT gene, genome, row_number() OVER (ORDER BY genome, gene) num FROM (SELECT DISTINCT gene, genome FROM members)),
p(section, ord, piece, value, score) AS (SELECT 0, '', 0, '<orthoXML xmlns="http://orthoXML.org/2011/" version="0.3">', CAST(NULL AS DOUBLE) UNION ALL SELECT 2, '', 0, '<scores><scoreDef id="avgdist" desc="distance"/></scores>', NULL
UNION ALL SELECT 3, '', 0, '<groups>', NULL UNION ALL SELECT 5, '', 0, '</groups></orthoXML>', NULL
UNION ALL SELECT DISTINCT 1, genome, 0, '<species name="' || genome || '"><database><genes>', NULL FROM num UNION ALL SELECT 1, genome, num, '<gene id="' || num || '" protId="' || gene || '"/>', NULL FROM num
UNION ALL SELECT DISTINCT 1, genome, 9223372036854775807, '</genes></database></species>', NULL FROM num
UNION ALL SELECT 4, lpad(cid::VARCHAR, 20, '0'), 0, '<orthologGroup id="' || cid || '"><score id="avgdist"/>', avg_dist FROM stats
UNION ALL SELECT 4, lpad(cid::VARCHAR, 20, '0'), num, '<geneRef id="' || num || '"/>', NULL FROM stats JOIN members USING (cid) JOIN num USING (gene)
UNION ALL SELECT 4, lpad(cid::VARCHAR, 20, '0'), 9223372036854775807, '</orthologGroup>', NULL FROM stats) SELECT section, ord, piece, value, score FROM p""")
def orthoxml_group_pieces(spark, sf, upper=None):
    """orthoxml_groups with a row per gene."""
    r = _result(spark, sf, upper)
    genes = stage(_numbered(spark, sf, r.members), "numbered")
    return _xml_lines(sinks.orthoxml_group_pieces(r.members, r.stats.select("cid", "avg_dist"), genes), "piece")


@query(f"""WITH {E_SQL}, g AS (SELECT DISTINCT q gene, qdb genome FROM edges UNION SELECT s, sdb FROM edges), num AS (SELECT gene, genome, row_number() OVER (ORDER BY genome, gene) num FROM g) """ + _xml_sql("dist", """SELECT 4, q || '|' || s || '|0.8|1e-5',
'<orthologGroup><score id="dist"/><geneRef id="' || a.num || '"/><geneRef id="' || b.num || '"/></orthologGroup>', dist FROM edges JOIN num a ON a.gene = q JOIN num b ON b.gene = s"""))
def orthoxml_pairs(spark, sf):
    own = stage(A.edges(spark, sf), "edges")
    ends = own.select(F.col("q").alias("gene"), F.col("qdb").alias("genome")).union(own.select("s", "sdb"))
    genes = stage(_numbered(spark, sf, ends), "numbered")
    rows = own.select(F.col("q").alias("qid"), F.col("s").alias("sid"), F.lit("0.8").alias("div"), F.lit("1e-5").alias("evalue"), "dist")
    return _xml_lines(sinks.orthoxml_pairs(rows, genes))


@query(f"""WITH {A.edges_sql(where="qdb = 'Brand#10' AND sdb = 'Brand#9'")}, num AS (SELECT * FROM (SELECT p_partkey gene, p_brand genome, row_number() OVER (ORDER BY p_brand, p_partkey) num FROM part) WHERE gene IN (SELECT q FROM edges UNION SELECT s FROM edges)) """ + _xml_sql("dist", """SELECT 4, q || '|' || s || '|0.8|1e-5',
'<orthologGroup><score id="dist"/><geneRef id="' || a.num || '"/><geneRef id="' || b.num || '"/></orthologGroup>', dist FROM edges JOIN num a ON a.gene = q JOIN num b ON b.gene = s"""))
def raw_orthoxml_download(spark, sf):
    """One pair's orthologs as a document that names their genes alone, by their numbers in the whole release."""
    genes = stage(_numbered(spark, sf, A.genes(spark, sf)), "numbered")
    rows = A.edges(spark, sf).select("qdb", "sdb", F.lit("0.8").alias("div"), F.lit("1e-5").alias("evalue"), F.col("q").alias("qid"), F.col("s").alias("sid"), "dist")
    return _xml_lines(Q.raw_pair_download(rows, "Brand#9", "Brand#10", "0.8", "1e-5", "orthoxml", genes))


# Reciprocal smallest distance

_HITS_SQL = """v AS (SELECT vec_id, CAST(label AS VARCHAR) label, CAST(embedding AS DOUBLE[]) e FROM embeddings),
hits AS (SELECT a.vec_id qid, a.label qdb, b.vec_id sid, b.label sdb, round(sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))), 6) dist FROM v a JOIN v b ON a.label < b.label)"""


def _mutual_sql(keys: str, source: str) -> str:
    return f"""f AS (SELECT *, row_number() OVER (PARTITION BY {keys}qid, sdb ORDER BY dist, sid) rf, row_number() OVER (PARTITION BY {keys}sid, qdb ORDER BY dist, qid) rr FROM {source})
SELECT {keys}qdb, sdb, qid, sid, dist FROM f WHERE rf = 1 AND rr = 1"""


@query(f"""WITH {_HITS_SQL}, fwd AS (SELECT qid, qdb, sid, sdb, dist FROM (SELECT *, row_number() OVER (PARTITION BY qid, sdb ORDER BY dist, sid) n FROM hits) WHERE n = 1),
rev AS (SELECT qid, sid FROM (SELECT *, row_number() OVER (PARTITION BY sid, qdb ORDER BY dist, qid) n FROM hits WHERE dist <= 1.18) WHERE n = 1) SELECT fwd.qid, fwd.sid, dist FROM fwd JOIN rev USING (qid, sid)""")
def rsd_two_hit_lists(spark, sf):
    """Backward hits from a shorter list than the forward ones."""
    hits = stage(rsd.vector_hits(A.vectors(spark, sf)), "hits")
    return rsd.reciprocal_smallest_distance(hits, hits.where("dist <= 1.18")).select("qid", "sid", "dist")


@query(f"WITH {_HITS_SQL}, {_mutual_sql('', 'hits')}")
def rsd_vectors(spark, sf):
    return rsd.reciprocal_smallest_distance(stage(rsd.vector_hits(A.vectors(spark, sf)), "hits"))


_LIMITS = [(d, e, round(1.05 + 0.25 * float(d) - 0.004 * int(e[3:]), 6)) for d in model.DIVERGENCES for e in model.EVALUES]


@query(f"""WITH {_HITS_SQL}, grid(div, evalue, lim) AS (VALUES {', '.join(f"('{d}', '{e}', CAST({x} AS DOUBLE))" for d, e, x in _LIMITS)}),
h AS (SELECT div, evalue, hits.* FROM hits JOIN grid ON dist <= lim), {_mutual_sql('div, evalue, ', 'h')}""")
def rsd_param_grid(spark, sf):
    grid = spark.createDataFrame(_LIMITS, 'div string, evalue string, `limit` double')
    return rsd.rsd_grid(stage(rsd.vector_hits(A.vectors(spark, sf)), "hits"), grid).select("div", "evalue", "qdb", "sdb", "qid", "sid", "dist")


@query(f"""WITH {A.EVIDENCE_SQL}, {_GRID}, h AS (SELECT div, evalue, q qid, s sid, qdb, sdb, min(dist) dist FROM evidence JOIN grid ON dneed <= dmax AND ek >= k GROUP BY ALL), {_mutual_sql('div, evalue, ', 'h')}""")
def rsd_evidence_params(spark, sf):
    grid = model.params(spark).withColumn("max_div", F.round(F.col("max_div") * 10).cast("int"))
    widest = grid.agg(F.max("max_div"), F.min("min_exponent")).first()  # what no set passes is no hit
    hits = A.evidence(spark, sf, *widest).select(F.col("q").alias("qid"), F.col("s").alias("sid"), "qdb", "sdb", F.col("dneed").alias("div_needed"), F.col("ek").alias("exponent"), "dist")
    return rsd.rsd_params(stage(hits, "hits"), grid).select("div", "evalue", "qdb", "sdb", "qid", "sid", "dist")


@query("""WITH g AS (SELECT p_partkey gene, p_name || p_type || p_brand seq FROM part), q AS (SELECT gene AS query, CASE WHEN gene % 200 = 0 THEN seq ELSE substr(seq, 3) END seq FROM g WHERE gene % 100 = 0),
same AS (SELECT query, min(gene) gene FROM q JOIN g USING (seq) GROUP BY query),
gk AS (SELECT DISTINCT gene, substr(seq, i, 6) k FROM g, range(1, 100) t(i) WHERE i <= length(seq) - 5), qk AS (SELECT DISTINCT query, substr(seq, i, 6) k FROM q, range(1, 100) t(i) WHERE i <= length(seq) - 5 AND query NOT IN (SELECT query FROM same)),
n AS (SELECT query, gene, count(*) n FROM qk JOIN gk USING (k) GROUP BY ALL)
SELECT query, gene FROM same UNION ALL SELECT query, gene FROM (SELECT *, row_number() OVER (PARTITION BY query ORDER BY n DESC, gene) r FROM n) WHERE r = 1""")
def lookup_sequence(spark, sf):
    """Texts of parts as sequences; every hundredth is a query, every other one of them cut."""
    genes = read_table(spark, sf, "part").select(F.col("p_partkey").alias("gene"), F.concat("p_name", "p_type", "p_brand").alias("seq"))
    cut = F.when(F.col("gene") % 200 == 0, F.col("seq")).otherwise(F.substring("seq", 3, 1000))
    return rsd.lookup_sequence(genes.where("gene % 100 = 0").select(F.col("gene").alias("query"), cut.alias("seq")), genes)


# Genomes and census


@query("SELECT a.p_brand AS qdb, b.p_brand AS sdb FROM (SELECT DISTINCT p_brand FROM part) a JOIN (SELECT DISTINCT p_brand FROM part) b ON a.p_brand < b.p_brand")
def genome_pairs(spark, sf):
    return pairs.genome_pairs(A.genomes(spark, sf))


@query("""WITH g AS (SELECT DISTINCT p_brand b FROM part WHERE substr(p_brand, 7) IN ('1', '3', '10', '20')) SELECT x.b AS qdb, y.b AS sdb FROM g x JOIN g y ON x.b < y.b
WHERE (x.b = 'Brand#3' OR y.b = 'Brand#3') AND (x.b IN ('Brand#1', 'Brand#10', 'Brand#20') OR y.b IN ('Brand#1', 'Brand#10', 'Brand#20'))""")
def pairs_for_primary(spark, sf):
    wanted = pairs.pairs_for(spark, "Brand#3", ["Brand#1", "Brand#10", "Brand#20"])
    known = A.genomes(spark, sf).select("genome")
    return wanted.join(known.withColumnRenamed("genome", "qdb"), "qdb", "left_semi").join(known.withColumnRenamed("genome", "sdb"), "sdb", "left_semi").select("qdb", "sdb")


@query("SELECT DISTINCT least(CAST(c_nationkey AS VARCHAR), CAST(c_custkey % 30 AS VARCHAR)) AS qdb, greatest(CAST(c_nationkey AS VARCHAR), CAST(c_custkey % 30 AS VARCHAR)) AS sdb FROM customer")
def normalize_pairs(spark, sf):
    return model.normalize_pairs(read_table(spark, sf, "customer").select(F.col("c_nationkey").alias("a"), (F.col("c_custkey") % 30).alias("b")))


@query("SELECT a.r_name AS i1, b.r_name AS i2, c.r_name AS i3 FROM region a JOIN region b ON a.r_name < b.r_name JOIN region c ON b.r_name < c.r_name")
def region_combinations(spark, sf):
    return pairs.combinations(read_table(spark, sf, "region"), 3, "r_name")


@query("SELECT a.r_name AS i1, b.r_name AS i2 FROM region a JOIN region b ON a.r_name <> b.r_name")
def region_permutations(spark, sf):
    return pairs.permutations(read_table(spark, sf, "region"), 2, "r_name")


_RECORDS_SQL = """rec AS (SELECT CAST(c_nationkey AS VARCHAR) genome, CASE WHEN c_acctbal > 0 THEN 'sp' ELSE 'tr' END ns, c_custkey % 3 <> 0 complete, c_custkey % 6 = 1 reference,
 'name ' || (c_nationkey + CASE WHEN c_nationkey % 5 = 0 THEN c_custkey % 2 ELSE 0 END) org_name, CAST(c_nationkey AS VARCHAR) taxon, substr(c_mktsegment, 1, CASE WHEN c_nationkey % 4 = 0 THEN 2 ELSE 0 END) org_code FROM customer)"""


def _records(spark, sf):
    c, k, n = read_table(spark, sf, "customer"), F.col("c_custkey"), F.col("c_nationkey")
    return c.select(
        n.cast("string").alias("genome"), F.when(F.col("c_acctbal") > 0, "sp").otherwise("tr").alias("ns"), (k % 3 != 0).alias("complete"), (k % 6 == 1).alias("reference"),
        F.concat(F.lit("name "), (n + F.when(n % 5 == 0, k % 2).otherwise(0)).cast("string")).alias("org_name"), n.cast("string").alias("taxon"),
        F.substr(F.col("c_mktsegment"), F.lit(1), F.when(n % 4 == 0, 2).otherwise(0)).alias("org_code"), k.alias("acc"),
    )


_CENSUS_SQL = f"""WITH {_RECORDS_SQL}, census AS (SELECT genome, count(*) AS count, count(*) FILTER (complete) AS complete, count(*) FILTER (reference) AS reference, count(*) FILTER (ns = 'sp') AS sprot,
 count(*) FILTER (ns <> 'sp') AS trembl, count(DISTINCT org_name) n_org_name, min(org_name) org_name, count(DISTINCT taxon) n_taxon, min(taxon) taxon, count(DISTINCT org_code) n_org_code, min(org_code) org_code FROM rec GROUP BY genome),
taxa AS (SELECT CAST(n_nationkey AS VARCHAR) taxon, substr('ABEVU', n_regionkey + 1, 1) cat_code FROM nation WHERE n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000))"""


def _taxa(spark, sf):
    """Nations with a supplier in credit; the others' genomes miss their taxon."""
    known = read_table(spark, sf, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("n_nationkey"))
    n = read_table(spark, sf, "nation").join(known, "n_nationkey", "left_semi")
    return n.select(F.col("n_nationkey").cast("string").alias("taxon"), F.expr("substr('ABEVU', n_regionkey + 1, 1)").alias("cat_code"))


@query(f"{_CENSUS_SQL} SELECT * FROM census")
def genome_census(spark, sf):
    return census.genome_census(_records(spark, sf))


@query(f"""{_CENSUS_SQL} SELECT genome, 'multiple_genome_org_codes' AS anomaly FROM census WHERE n_org_code > 1 UNION ALL SELECT genome, 'multiple_genome_names' FROM census WHERE n_org_name > 1
UNION ALL SELECT genome, 'multiple_genome_taxons' FROM census WHERE n_taxon > 1 UNION ALL SELECT genome, 'reference_not_complete' FROM census WHERE reference <> 0 AND reference <> complete""")
def census_anomalies(spark, sf):
    return census.census_anomalies(census.genome_census(_records(spark, sf)))


_REASON = "CASE WHEN complete < 35 THEN 'too_few' WHEN t.taxon IS NULL THEN 'missing_taxon' WHEN cat_code NOT IN ('A', 'B', 'E') THEN 'filtered_taxon_cat_code' END"


@query(f"{_CENSUS_SQL} SELECT genome, complete, {_REASON} AS reason FROM census c LEFT JOIN taxa t ON t.taxon = genome")
def select_genomes(spark, sf):
    return census.select_genomes(census.genome_census(_records(spark, sf)), _taxa(spark, sf), 35)


@query(f"{_CENSUS_SQL} SELECT coalesce({_REASON}, 'selected') AS reason, count(*) AS n FROM census c LEFT JOIN taxa t ON t.taxon = genome GROUP BY 1")
def genome_funnel(spark, sf):
    return census.funnel(select_genomes(spark, sf))


@query(f"{_CENSUS_SQL} SELECT genome, complete FROM census WHERE complete >= 35 AND genome NOT IN (SELECT taxon FROM taxa)")
def missing_taxa(spark, sf):
    return census.missing_taxa(census.genome_census(_records(spark, sf)), _taxa(spark, sf), 35)


@query(f"{_CENSUS_SQL} SELECT concat_ws(chr(9), count, complete, reference, sprot, trembl, genome) AS value FROM census")
def counts_report(spark, sf):
    return sinks.counts_report(census.genome_census(_records(spark, sf)))


@query(f"WITH {_RECORDS_SQL.replace('SELECT CAST', 'SELECT c_custkey acc, CAST', 1)} SELECT acc, genome, ns, complete, reference, org_name, taxon, org_code FROM rec WHERE complete AND genome IN ('1', '2', '5', '8') AND org_code NOT LIKE '9%'")
def extract_genes(spark, sf):
    chosen = spark.createDataFrame([("1",), ("2",), ("5",), ("8",)], "genome string")
    kept = census.complete_only(census.drop_collective_orgs(_records(spark, sf)), chosen)
    return kept.select("acc", "genome", "ns", "complete", "reference", "org_name", "taxon", "org_code")


@query(f"WITH {E_SQL} SELECT (SELECT count(DISTINCT p_brand) FROM part) AS num_genomes, (SELECT count(DISTINCT p_brand) * (count(DISTINCT p_brand) - 1) // 2 FROM part) AS num_pairs, count(*) AS num_orthologs FROM edges")
def dataset_stats(spark, sf, upper=None):
    return census.dataset_stats(A.genomes(spark, sf), A.edges(spark, sf, upper=upper))


_TIMES_SQL = "t AS (SELECT event_type, user_id, epoch_us(min(ts)) / 1000000 a, epoch_us(max(ts)) / 1000000 b FROM events GROUP BY ALL)"


def _timings(spark, sf):
    e = read_table(spark, sf, "events").groupBy(F.col("event_type").alias("type"), "user_id").agg(F.unix_micros(F.min("ts").cast("timestamp")).alias("a"), F.unix_micros(F.max("ts").cast("timestamp")).alias("b"))
    return e.select("type", "user_id", (F.col("a") / 1000000).alias("start_time"), (F.col("b") / 1000000).alias("end_time"))


@query(f"WITH {_TIMES_SQL} SELECT event_type AS type, count(*) AS n, round(sum(b - a), 2) AS seconds FROM t GROUP BY ROLLUP (event_type)")
def timing_totals(spark, sf):
    return census.timing_totals(_timings(spark, sf)).withColumn("seconds", F.round("seconds", 2))


_PAIR_TIMES = "p AS (SELECT CASE WHEN event_type IN ('click', 'view') THEN 'blast' ELSE 'rsd' END type, CAST(user_id % 9 AS VARCHAR) qdb, CAST(user_id % 11 AS VARCHAR) sdb, value FROM events)"


@query(f"""WITH {_PAIR_TIMES} SELECT least(qdb, sdb) AS q, greatest(qdb, sdb) AS s, round(coalesce(sum(value) FILTER (type = 'blast' AND qdb <= sdb), 0), 2) AS blast_forward,
round(coalesce(sum(value) FILTER (type = 'blast' AND qdb > sdb), 0), 2) AS blast_backward, round(coalesce(sum(value) FILTER (type = 'rsd'), 0), 2) AS rsd FROM p GROUP BY ALL""")
def timing_join(spark, sf):
    e = read_table(spark, sf, "events")
    t = e.select(F.when(F.col("event_type").isin("click", "view"), "blast").otherwise("rsd").alias("type"), (F.col("user_id") % 9).cast("string").alias("qdb"), (F.col("user_id") % 11).cast("string").alias("sdb"), F.lit(0.0).alias("start_time"), F.col("value").alias("end_time"))
    joined = census.timing_join(t)
    return joined.select("q", "s", *(F.round(c, 2).alias(c) for c in ("blast_forward", "blast_backward", "rsd")))


@query(f"SELECT category, count(*) AS n FROM (SELECT DISTINCT p_brand, {A.CATEGORY_SQL} category FROM part) WHERE category IN ('E', 'A', 'B', 'V') GROUP BY ROLLUP (category)")
def category_counts(spark, sf):
    return census.category_counts(A.genomes(spark, sf))


@query("SELECT c_mktsegment AS segment, round(avg(c_acctbal), 4) AS mean, round(var_pop(c_acctbal), 2) AS variance, round(stddev_pop(c_acctbal), 4) AS stddev FROM customer GROUP BY 1")
def describe_pop(spark, sf):
    d = census.describe_pop(read_table(spark, sf, "customer").withColumnRenamed("c_mktsegment", "segment"), "c_acctbal", "segment")
    return d.select("segment", F.round("mean", 4).alias("mean"), F.round("variance", 2).alias("variance"), F.round("stddev", 4).alias("stddev"))


@query(f"SELECT p_brand AS genome, lower(p_brand) AS name, {A.CATEGORY_SQL} AS category, count(*) AS num_seqs FROM part GROUP BY ALL HAVING {A.CATEGORY_SQL} IN ('A', 'E')")
def genomes_page(spark, sf):
    return census.genomes_in_category(A.genomes(spark, sf), ["A", "E"]).select("genome", "name", "category", "num_seqs").orderBy(F.lower("name"))


@query("SELECT p_brand AS genome, string_agg(CAST(p_partkey AS VARCHAR), ',' ORDER BY p_partkey) AS genes FROM part GROUP BY 1")
def genome_to_genes(spark, sf):
    return census.genome_to_genes(A.genes(spark, sf)).select("genome", F.array_join(F.col("genes").cast("array<string>"), ",").alias("genes"))


@query("SELECT p_name AS gene_name, count(*) AS n FROM part GROUP BY 1 HAVING count(*) > 1")
def duplicate_names(spark, sf):
    return census.duplicates(A.genes(spark, sf), "gene_name")


# Searches


def _sequences(spark, sf):
    g = A.genes(spark, sf)
    return g.select(F.col("gene").alias("external_sequence_id"), F.col("genome").alias("genome_id"), "gene_name")


def _genome_ids(spark, sf):
    return A.genomes(spark, sf).select(F.col("genome").alias("id"), F.col("genome").alias("acc"))


for _kind, _like in (("contains", "%all%"), ("starts_with", "s%"), ("ends_with", "%get"), ("equals", "cold widget")):
    _name = f"gene_name_search_{_kind}"
    QUERIES[_name] = lambda spark, sf, k=_kind, t=_like.strip("%"): dims.gene_name_genome_pairs_like(_sequences(spark, sf), _genome_ids(spark, sf), t, k)
    ORACLES[_name] = f"SELECT DISTINCT p_brand AS acc, p_name AS gene_name FROM part WHERE p_name LIKE '{_like}'"


@query("SELECT p_partkey AS external_sequence_id FROM part WHERE p_name = 'cold widget' AND p_brand = 'Brand#13'")
def gene_ids_for_name(spark, sf):
    return dims.seq_ids_for_gene_name(_sequences(spark, sf), _genome_ids(spark, sf), "cold widget", "Brand#13")


# Changes between releases: customers by the years of their orders

_RELEASE_SQL = """g AS (SELECT DISTINCT CAST(year(o_orderdate) AS VARCHAR) AS release, CAST(c_custkey AS VARCHAR) taxon, c_mktsegment || ' x' || (c_custkey // 3) || ' ' || c_custkey AS name, c_mktsegment || ' x' || (c_custkey // 3) species, substr('ABEVU', 1 + c_custkey % 5, 1) category
 FROM orders JOIN customer ON c_custkey = o_custkey),
multi AS (SELECT release, species FROM g GROUP BY ALL HAVING count(DISTINCT name) > 1),
items AS (SELECT DISTINCT * FROM (SELECT release, 'taxons' kind, taxon item FROM g UNION ALL SELECT release, 'taxonSpecies', species FROM g UNION ALL SELECT release, 'euks', taxon FROM g WHERE category = 'E'
 UNION ALL SELECT release, 'eukSpecies', species FROM g WHERE category = 'E' UNION ALL SELECT release, 'multiTaxonSpecies', species FROM multi UNION ALL SELECT g.release, 'multiEukSpecies', g.species FROM g JOIN multi USING (release, species) WHERE category = 'E'))"""


def _releases(spark, sf):
    """release, taxon, name, category: one row for each customer and year with an order; three
    customers of a segment make a species."""
    c, k = read_table(spark, sf, "customer"), F.col("c_custkey")
    o = read_table(spark, sf, "orders").select("o_custkey", F.year("o_orderdate").cast("string").alias("release")).distinct()
    name = F.concat_ws(" ", "c_mktsegment", F.concat(F.lit("x"), F.floor(k / 3).cast("string")), k.cast("string"))
    return o.join(c, k == F.col("o_custkey")).select("release", k.cast("string").alias("taxon"), name.alias("name"), F.expr("substr('ABEVU', int(1 + c_custkey % 5), 1)").alias("category")).distinct()


@query(f"WITH {_RELEASE_SQL} SELECT a.release AS release_a, b.release AS release_b, kind, item FROM items a, (SELECT DISTINCT release FROM items) b WHERE a.release <> b.release AND NOT EXISTS (SELECT 1 FROM items c WHERE c.release = b.release AND c.kind = a.kind AND c.item = a.item)")
def change_log_diff(spark, sf):
    return changes.change_log_diff(stage(changes.change_items(_releases(spark, sf)), "items"))


@query(f"WITH {_RELEASE_SQL} SELECT DISTINCT a.release AS release_a, b.release AS release_b, taxon, name FROM g a, (SELECT DISTINCT release FROM g) b WHERE a.release <> b.release AND category = 'E' AND NOT EXISTS (SELECT 1 FROM g c WHERE c.release = b.release AND c.category = 'E' AND c.taxon = a.taxon)")
def change_log_names(spark, sf):
    return changes.change_log_names(stage(_releases(spark, sf), "genomes"))


@query(f"WITH {_RELEASE_SQL} SELECT release, kind, count(*) AS n FROM items GROUP BY ALL")
def change_log_sizes(spark, sf):
    return changes.change_log_sizes(changes.change_items(_releases(spark, sf)))


@query(f"WITH {_RELEASE_SQL} SELECT release, species, count(DISTINCT name) AS n_names FROM g GROUP BY ALL HAVING count(DISTINCT name) > 1")
def multi_taxon_species(spark, sf):
    return changes.multi_taxon_species(_releases(spark, sf).withColumn("species", scalars.species_of(F.col("name"))), "release")


# Dimensions

_SEQ_SQL = """gd AS (SELECT p_brand acc, row_number() OVER (ORDER BY p_brand) id, count(*) num_seqs FROM part GROUP BY p_brand),
sd AS (SELECT row_number() OVER (ORDER BY p_partkey) id, p_partkey external_sequence_id, gd.id genome_id, p_name gene_name, p_size gene_id, p_brand FROM part JOIN gd ON gd.acc = p_brand)"""


def _gene_rows(spark, sf):
    p = read_table(spark, sf, "part")
    return p.select(F.col("p_partkey").alias("acc"), F.col("p_brand").alias("genome"), F.col("p_name").alias("gene_name"), F.array(F.col("p_size")).alias("gene_ids"), F.concat(F.split("p_name", " "), F.array("p_type")).alias("go_terms"))


def _genome_table(spark, sf):
    g = A.genomes(spark, sf)
    taxa = g.select(F.col("genome").alias("taxon"), F.col("category").alias("cat_code"), F.lit("x").alias("cat_name"), F.col("name").alias("taxon_name"))
    return dims.genome_dimension(g.select("genome"), g.select("genome", "name"), taxa, g.select("genome", "num_seqs"))


@query(f"WITH {_SEQ_SQL} SELECT DISTINCT gd.id, gd.acc, lower(gd.acc) AS name, gd.acc AS ncbi_taxon, lower(gd.acc) AS taxon_name, {A.CATEGORY_SQL} AS taxon_category_code, 'x' AS taxon_category_name, num_seqs FROM gd JOIN part ON p_brand = gd.acc")
def genome_dimension(spark, sf):
    return _genome_table(spark, sf)


@query(f"WITH {_SEQ_SQL} SELECT id, external_sequence_id, genome_id, gene_name, gene_id FROM sd")
def sequence_dimension(spark, sf):
    return dims.sequence_dimension(_gene_rows(spark, sf), _genome_table(spark, sf))


_KNOWN = "k AS (SELECT DISTINCT p_type acc, 'type ' || p_type AS name, 'biological_process' AS type FROM part)"


def _known_terms(spark, sf):
    return read_table(spark, sf, "part").select(F.col("p_type").alias("acc"), F.concat(F.lit("type "), "p_type").alias("name"), F.lit("biological_process").alias("type")).distinct()


@query(f"WITH {_SEQ_SQL}, {_KNOWN} SELECT row_number() OVER (ORDER BY sd.id, k.acc) AS id, sd.id AS sequence_id, k.acc AS go_term_acc, name AS go_term_name, type AS go_term_type FROM sd JOIN part ON p_partkey = external_sequence_id JOIN k ON k.acc = p_type")
def term_bridge(spark, sf):
    sequences = stage(dims.sequence_dimension(_gene_rows(spark, sf), _genome_table(spark, sf)), "sequences")
    return dims.gene_term_bridge(_gene_rows(spark, sf), sequences, _known_terms(spark, sf))


@query(f"WITH {_SEQ_SQL}, {_KNOWN} SELECT id AS sequence_id, p_type AS term_accs, 'type ' || p_type AS term_names FROM sd JOIN part ON p_partkey = external_sequence_id")
def sequence_terms(spark, sf):
    sequences = stage(dims.sequence_dimension(_gene_rows(spark, sf), _genome_table(spark, sf)), "sequences")
    bridge = dims.gene_term_bridge(_gene_rows(spark, sf), sequences, _known_terms(spark, sf))
    rows = dims.sequence_terms(sequences.select(F.col("id").alias("sequence_id")), bridge)
    return rows.select("sequence_id", F.array_join("term_accs", ",").alias("term_accs"), F.array_join("term_names", ",").alias("term_names"))


_ENC = f"enc AS (SELECT gq.id query_db, gs.id subject_db, 1 AS divergence, 2 AS evalue, a.id q, b.id s, dist FROM edges JOIN gd gq ON gq.acc = qdb JOIN gd gs ON gs.acc = sdb JOIN sd a ON a.external_sequence_id = q JOIN sd b ON b.external_sequence_id = edges.s)"


def _dimensions(spark, sf):
    genomes = stage(_genome_table(spark, sf), "genomes")
    return genomes, stage(dims.sequence_dimension(_gene_rows(spark, sf), genomes), "sequences")


def _encoded(spark, sf, upper=None):
    genomes, sequences = _dimensions(spark, sf)
    rows = A.edges(spark, sf, upper=upper).select("qdb", "sdb", F.lit("0.8").alias("div"), F.lit("1e-10").alias("evalue"), F.col("q").alias("qid"), F.col("s").alias("sid"), "dist")
    divs = spark.createDataFrame([(i, d) for i, d in enumerate(model.DIVERGENCES, 1)], "id int, name string")
    evalues = spark.createDataFrame([(i, e) for i, e in enumerate(model.EVALUES, 1)], "id int, name string")
    return dims.encode_edges(rows, genomes, divs, evalues, sequences), genomes, sequences


@query(f"WITH {E_SQL}, {_SEQ_SQL}, {_ENC} SELECT * FROM enc")
def encode_edges(spark, sf, upper=None):
    return _encoded(spark, sf, upper)[0]


@query(f"WITH {E_SQL}, {_SEQ_SQL}, {_ENC} SELECT q, s, dist, a.external_sequence_id AS q_acc, a.genome_id AS q_genome, a.gene_name AS q_name, b.external_sequence_id AS s_acc, b.genome_id AS s_genome, b.gene_name AS s_name FROM enc JOIN sd a ON a.id = q JOIN sd b ON b.id = enc.s")
def edges_with_sequences(spark, sf):
    coded, _, sequences = _encoded(spark, sf)
    return dims.with_sequences(coded.select("q", "s", "dist"), sequences)


def _texts(name: str, df: DataFrame) -> DataFrame:
    """Whole rows as text, numbers with a fraction in millionths."""
    cells = [F.round(F.col(c) * 1000000).cast("long") if t == "double" else F.col(c) for c, t in df.dtypes]
    return df.select(F.lit(name).alias("tbl"), F.concat_ws("|", *(c.cast("string") for c in cells)).alias("row"))


@query(f"""WITH {E_SQL}, {_SEQ_SQL}, {_ENC}, {_KNOWN}, gone AS (SELECT id FROM gd WHERE acc = 'Brand#7'),
bridge AS (SELECT row_number() OVER (ORDER BY sd.id, k.acc) id, sd.id sequence_id, sd.genome_id, k.acc, name, type FROM sd JOIN part ON p_partkey = external_sequence_id JOIN k ON k.acc = p_type)
SELECT DISTINCT 'genomes' AS tbl, concat_ws('|', gd.id, gd.acc, lower(gd.acc), gd.acc, lower(gd.acc), {A.CATEGORY_SQL}, 'x', num_seqs) AS row FROM gd JOIN part ON p_brand = gd.acc WHERE gd.acc <> 'Brand#7'
UNION ALL SELECT 'sequence', concat_ws('|', id, external_sequence_id, genome_id, gene_name, gene_id) FROM sd WHERE genome_id NOT IN (FROM gone)
UNION ALL SELECT 'bridge', concat_ws('|', id, sequence_id, acc, name, type) FROM bridge WHERE genome_id NOT IN (FROM gone)
UNION ALL SELECT 'results', concat_ws('|', query_db, subject_db, divergence, evalue, q, s, CAST(round(dist * 1000000) AS BIGINT)) FROM enc WHERE query_db NOT IN (FROM gone) AND subject_db NOT IN (FROM gone)""")
def delete_genome(spark, sf):
    coded, genomes, sequences = _encoded(spark, sf)
    bridge = dims.gene_term_bridge(_gene_rows(spark, sf), sequences, _known_terms(spark, sf))
    left = dims.delete_genome("Brand#7", genomes, sequences, bridge, coded)
    out = _texts("genomes", left[0])
    for name, df in zip(("sequence", "bridge", "results"), left[1:]):
        out = out.unionByName(_texts(name, df))
    return out


@query("""SELECT 'genes' AS tbl, p_partkey || '|' || p_brand AS row FROM part WHERE p_brand <> 'Brand#7' UNION ALL SELECT 'genes', p_partkey || '|Brand#7' FROM part WHERE p_brand = 'Brand#8'
UNION ALL SELECT DISTINCT 'genomes', CASE WHEN p_brand = 'Brand#7' THEN 'Brand#7|brand seven|7' ELSE p_brand || '|' || lower(p_brand) || '|' || p_brand END FROM part""")
def replace_genome(spark, sf):
    genes, g = A.genes(spark, sf).select("gene", "genome"), A.genomes(spark, sf).select("genome", "name", F.col("genome").alias("taxon"))
    new, listed = dims.replace_genome(genes, g, "Brand#7", genes.where("genome = 'Brand#8'"), "brand seven", "7")
    return _texts("genes", new.select("gene", "genome")).unionByName(_texts("genomes", listed))


@query("SELECT o_custkey AS qdb, o_orderstatus AS sdb, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderkey) r FROM orders) WHERE r = 1 GROUP BY ALL")
def load_results_dedupe(spark, sf):
    o = read_table(spark, sf, "orders")
    one = F.array(F.struct(F.col("o_orderkey").cast("string").alias("qid"), F.lit("x").alias("sid"), F.lit(1.0).alias("dist")))
    rows = o.select(F.col("o_custkey").alias("qdb"), F.col("o_orderstatus").alias("sdb"), F.lit("0.2").alias("div"), F.lit("1e-5").alias("evalue"), F.col("o_orderkey").alias("source"), one.alias("orthologs"))
    return dims.load_results(rows).groupBy("qdb", "sdb").agg(F.sum("num_orthologs").alias("n"))


# Ranks and groups


@query("SELECT o_orderkey, ntile(7) OVER (ORDER BY o_orderkey) AS group_no FROM orders")
def split_into_n(spark, sf):
    return ranking.split_into_n(read_table(spark, sf, "orders").select("o_orderkey"), 7, "o_orderkey")


@query("SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS group_no FROM orders")
def groups_of_n(spark, sf):
    return ranking.groups_of_n(read_table(spark, sf, "orders").select("o_orderkey"), 100, "o_orderkey")


@query("SELECT o_orderkey FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) r FROM orders) WHERE r % 9 = 0")
def every_nth(spark, sf):
    return ranking.every_nth(read_table(spark, sf, "orders").select("o_orderkey"), 9, "o_orderkey")


@query("SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) r FROM orders) WHERE r = 1")
def first_hit(spark, sf):
    return profiles.first_hit(read_table(spark, sf, "orders"), "o_custkey", F.desc("o_totalprice"), "o_orderkey").select("o_custkey", "o_orderkey")


# Text formats, written and read back


@query("SELECT CAST(o_orderkey AS VARCHAR) AS qdb, count(l_orderkey) AS num_orthologs, coalesce(round(sum(l_quantity), 2), 0) AS total, min(CAST(l_partkey AS VARCHAR)) AS first_qid FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def orthdata_roundtrip(spark, sf):
    o, line = read_table(spark, sf, "orders"), read_table(spark, sf, "lineitem")
    flat = o.select("o_orderkey").join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        F.col("o_orderkey").cast("string").alias("qdb"), F.lit("s").alias("sdb"), F.lit("0.2").alias("div"), F.lit("1e-20").alias("evalue"),
        F.col("l_partkey").cast("string").alias("qid"), F.col("l_suppkey").cast("string").alias("sid"), F.col("l_quantity").alias("dist"),
    )
    path = _scratch(spark, "orthdata")
    sinks.write_orthdata(model.nest(flat), path)
    back = readers.read_orthdata(spark, path)
    ids = F.array_min(F.transform("orthologs", lambda o: o["qid"]))
    total = F.aggregate("orthologs", F.lit(0.0), lambda a, o: a + o["dist"])
    return back.select("qdb", F.size("orthologs").alias("num_orthologs"), F.round(total, 2).alias("total"), ids.alias("first_qid"))


@query("SELECT CAST(l_partkey AS VARCHAR) AS qid, CAST(l_suppkey AS VARCHAR) AS sid, l_quantity AS dist FROM lineitem")
def ortholog_tsv_roundtrip(spark, sf):
    line = read_table(spark, sf, "lineitem").select(F.col("l_partkey").cast("string").alias("qid"), F.col("l_suppkey").cast("string").alias("sid"), F.col("l_quantity").alias("dist"))
    path = _scratch(spark, "tsv")
    sinks.write_ortholog_tsv(line, path, 1)
    return readers.read_ortholog_tsv(spark, path, 1)


def _fasta(spark, sf):
    d = read_table(spark, sf, "documents").where("text is not null")
    name = F.concat_ws("|", F.concat(F.lit(">"), "source"), F.col("doc_id").cast("string"), "lang")
    return d.select("source", name.alias("nameline"), F.regexp_replace("text", r"\s", "").alias("sequence")).where("sequence <> ''")


@query(r"SELECT CAST(doc_id AS VARCHAR) AS id, length(regexp_replace(text, '[ \t\n\r\f\v]', '', 'g')) AS n, md5(regexp_replace(text, '[ \t\n\r\f\v]', '', 'g')) AS digest FROM documents WHERE regexp_replace(text, '[ \t\n\r\f\v]', '', 'g') <> ''")
def fasta_roundtrip(spark, sf):
    path = _scratch(spark, "fasta")
    _fasta(spark, sf).select(sinks.fasta_text().alias("value")).write.text(path)
    return readers.read_fasta(spark, path).select("id", F.length("seq").alias("n"), F.md5("seq").alias("digest"))


@query(r"SELECT source AS genome, count(*) AS n_records, sum(length(regexp_replace(text, '[ \t\n\r\f\v]', '', 'g'))) AS n_chars FROM documents WHERE regexp_replace(text, '[ \t\n\r\f\v]', '', 'g') <> '' GROUP BY 1")
def fasta_chars(spark, sf):
    return census.fasta_chars(_fasta(spark, sf).select(F.col("source").alias("genome"), F.col("sequence").alias("seq"))).select("genome", "n_records", "n_chars")


@query("SELECT doc_id, text FROM documents ORDER BY doc_id LIMIT 12")
def fasta_head(spark, sf):
    return ranking.fasta_head(read_table(spark, sf, "documents").select("doc_id", "text"), 12, "doc_id")


@query("""SELECT 'P' || p_partkey AS acc, CASE WHEN p_size % 2 = 0 THEN 'sp' ELSE 'tr' END AS ns, 'ORG' || p_size AS org_code, p_brand AS org_name, CAST(p_size AS VARCHAR) AS taxon, p_name AS gene_name, p_type AS gene_desc,
p_size % 3 = 0 AS complete, CAST(p_partkey % 5 + 1 AS VARCHAR) AS evidence, 'GO:' || p_size AS terms, upper(replace(p_name, ' ', '')) AS sequence, concat_ws(',', CASE WHEN p_partkey % 11 = 0 THEN 'many_ox' END, CASE WHEN p_partkey % 13 = 0 THEN 'many_pe' END) AS anomalies FROM part""")
def dat_parse(spark, sf):
    p, s = read_table(spark, sf, "part"), lambda c: F.col(c).cast("string")
    line = lambda code, *parts: F.concat(F.lit(f"{code}   "), *(x if not isinstance(x, str) else F.lit(x) for x in parts))
    size = s("p_size")
    rows = p.select(F.concat_ws(
        "\n",
        line("ID", F.concat(F.lit("E"), s("p_partkey"), F.lit("_ORG"), size), F.when(F.col("p_size") % 2 == 0, "            Reviewed;").otherwise("            Unreviewed;"), "         365 AA."),
        line("AC", F.lit("P"), s("p_partkey"), "; Q0; O0;"), line("DT", "01-DEC-2001, sequence version 1."), line("DE", "RecName: Full=", F.col("p_type"), ";"),
        line("GN", "Name=", F.col("p_name"), "; ORFNames=x;"), line("OS", F.col("p_brand"), "."), line("OX", "NCBI_TaxID=", size, ";"), F.when(F.col("p_partkey") % 11 == 0, "OX   NCBI_TaxID=1;"), F.when(F.col("p_partkey") % 13 == 0, "PE   9: Evidence;"), line("PE", (F.col("p_partkey") % 5 + 1).cast("string"), ": Evidence;"),
        line("KW", F.when(F.col("p_size") % 3 == 0, "Complete proteome; x.").otherwise("x.")), line("DR", "GO; GO:", size, "; P:x."), line("DR", "GeneID; 1; -."), F.lit("SQ   SEQUENCE   3 AA;"),
        F.concat(F.lit("     "), F.upper("p_name")),
    ).alias("value"))
    path = _scratch(spark, "dat")
    rows.write.option("lineSep", "\n//\n").text(path)
    back = readers.read_dat(spark, path)
    return back.select("acc", "ns", "org_code", "org_name", "taxon", "gene_name", "gene_desc", "complete", "evidence", F.array_join("go_terms", ",").alias("terms"), "sequence", F.array_join("anomalies", ",").alias("anomalies"))


@query("SELECT p_partkey, 'sp' AS ns, 'P' || p_partkey AS acc, 'G_' || p_size AS entry_id, p_type AS gene_desc, p_brand AS org_name, p_name AS gene_name, CAST(p_size AS VARCHAR) AS org_code FROM part")
def nameline_parse(spark, sf):
    p, s = read_table(spark, sf, "part"), lambda c: F.col(c).cast("string")
    line = scalars.make_nameline(F.lit("sp"), F.concat(F.lit("P"), s("p_partkey")), F.concat(F.lit("G_"), s("p_size")), F.col("p_type"), F.col("p_brand"), F.col("p_name"), F.lit("1"), F.lit("2"))
    return p.select("p_partkey", scalars.parse_nameline(line).alias("n")).select("p_partkey", "n.ns", "n.acc", "n.entry_id", "n.gene_desc", "n.org_name", "n.gene_name", "n.org_code")


@query("SELECT p_partkey, array_to_string(string_split(p_name, ' ')[1:2], ' ') AS species, p_name || ' (' || p_type || ' (' || p_size || '))' AS prefix, replace(p_brand || '_x', '_', ' ') AS display, CAST(p_partkey AS VARCHAR) AS id FROM part")
def scalar_functions(spark, sf):
    p, s = read_table(spark, sf, "part"), lambda c: F.col(c).cast("string")
    parens = F.concat("p_name", F.lit(" ("), "p_type", F.lit(" ("), s("p_size"), F.lit(")) (rest)"))
    return p.select(
        "p_partkey", scalars.species_of(F.col("p_name")).alias("species"), scalars.up_to_first_parens(parens).alias("prefix"),
        scalars.genome_display_name(F.concat("p_brand", F.lit("_x.aa")), F.lit(None).cast("string")).alias("display"), scalars.id_from_name(F.concat(F.lit(">ns|"), s("p_partkey"), F.lit(" more|x"))).alias("id"),
    )


@query("SELECT n_name AS name, CAST(n_nationkey AS VARCHAR) AS taxon, substr('ABEVU', n_regionkey + 1, 1) AS cat_code, ['Archaea', 'Bacteria', 'Eukaryota', 'Viruses', 'Unclassified'][n_regionkey + 1] AS cat_name FROM nation")
def taxa_join(spark, sf):
    n = read_table(spark, sf, "nation")
    key = F.col("n_nationkey").cast("string")
    cats = n.select(F.concat_ws(" ", F.expr("substr('ABEVU', n_regionkey + 1, 1)"), key, key).alias("value"))
    lines = n.select(F.concat(key, F.lit("\t|\t"), "n_name", F.lit("\t|\t\t|\tscientific name\t|")).alias("value")).union(n.select(F.concat(key, F.lit("\t|\tother\t|\t\t|\tsynonym\t|"))))
    return readers.taxa_from(cats, lines)


# Incremental loads


@query("SELECT CAST(o_orderkey AS VARCHAR) AS qdb, count(l_orderkey) AS num_orthologs FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1")
def stream_load_orthologs_twice(spark, sf):
    """Loaded in two goes from one checkpoint, the second with files that came later."""
    o, line = read_table(spark, sf, "orders"), read_table(spark, sf, "lineitem")
    key, line = F.col("o_orderkey").cast("string").alias("qdb"), line.withColumn("qdb", F.col("l_orderkey").cast("string"))
    # Joined by the text that they are nested by, so that rows are dealt out once.
    flat = o.select(key).join(line, "qdb", "left").select(
        "qdb", F.lit("s").alias("sdb"), F.lit("0.2").alias("div"), F.lit("1e-20").alias("evalue"),
        F.col("l_partkey").cast("string").alias("qid"), F.col("l_suppkey").cast("string").alias("sid"), F.col("l_quantity").alias("dist"),
    )
    path = _scratch(spark, "stream")
    text = stage(sinks.orthdata_text(model.nest(flat)), "orthdata-text")
    for half in (0, 1):
        text.where(F.pmod(F.xxhash64("qdb"), F.lit(2)) == half).select("value").write.option("lineSep", "\n//\n").mode("append").text(f"{path}/in")
        stream_load_orthologs(spark, f"{path}/in", f"{path}/table", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/table").select("qdb", "num_orthologs")


@query(f"WITH {E_SQL} SELECT a.p_brand AS qdb, b.p_brand AS sdb FROM (SELECT DISTINCT p_brand FROM part) a JOIN (SELECT DISTINCT p_brand FROM part) b ON a.p_brand < b.p_brand WHERE NOT EXISTS (SELECT 1 FROM edges WHERE qdb = a.p_brand AND sdb = b.p_brand)")
def incremental_genome_pairs(spark, sf):
    return incremental_pairs(pairs.genome_pairs(A.genomes(spark, sf)), A.edges(spark, sf).select("qdb", "sdb").distinct())


def _typed(name: str, **kinds: str) -> None:
    """Columns of a query's SQL in the types that the query returns."""
    ORACLES[name] = f"SELECT * REPLACE ({', '.join(f'CAST({c} AS {t}) AS {c}' for c, t in kinds.items())}) FROM ({ORACLES[name]})"


_typed("cluster_stats", n_classes="INT")
_typed("clustering_summary", min_n_classes="INT", max_n_classes="INT")
_typed("threshold_sweep", min_n_classes="INT", max_n_classes="INT")
_typed("clustering_summary_of_classes", min_n_classes="INT", max_n_classes="INT")
_typed("summary_of_every_nth_edge", min_n_classes="INT", max_n_classes="INT")
_typed("genome_dimension", id="INT")
_typed("sequence_dimension", genome_id="INT")
_typed("encode_edges", query_db="INT", subject_db="INT")
_typed("edges_with_sequences", q_genome="INT", s_genome="INT")
_typed("orthdata_roundtrip", num_orthologs="INT")
_typed("fasta_roundtrip", n="INT")
_typed("fasta_chars", n_chars="BIGINT")
_typed("stream_load_orthologs_twice", num_orthologs="INT")
