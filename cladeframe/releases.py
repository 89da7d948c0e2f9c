"""Queries of text formats, exports and releases: what is written is read back and compared."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cladeframe import model, queries
from cladeframe.functions import scalars
from cladeframe.operators import census, dims, rsd
from cladeframe.plans import query as Q
from cladeframe.plans import release
from cladeframe.queries import E_SQL, _mutual_sql, _scratch
from cladeframe.session import read_table, stage
from cladeframe.sources import adapters as A
from cladeframe.sources import gzipped, readers, sinks

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def _text(c: str):
    return F.col(c).cast("string")


# Sources


@query("""SELECT 'P' || p_partkey AS acc, CASE WHEN p_size % 3 = 0 THEN '' WHEN p_size % 3 = 1 THEN '' || p_size ELSE p_size || ',' || p_partkey END AS gene_ids,
CASE WHEN p_partkey % 5 = 0 THEN '' ELSE CASE WHEN p_size = p_partkey THEN 'GO:' || p_size ELSE 'GO:' || p_size || ',GO:' || p_partkey END END AS go_terms FROM part""")
def idmapping_roundtrip(spark, sf):
    p = read_table(spark, sf, "part")
    ids = F.when(F.col("p_size") % 3 == 0, "").when(F.col("p_size") % 3 == 1, _text("p_size")).otherwise(F.concat_ws("; ", _text("p_size"), _text("p_partkey")))
    terms = F.when(F.col("p_partkey") % 5 == 0, "").otherwise(F.array_join(F.array_distinct(F.array(F.concat(F.lit("GO:"), _text("p_size")), F.concat(F.lit("GO:"), _text("p_partkey")))), "; "))
    cells = [F.concat(F.lit("P"), _text("p_partkey")), F.lit("e"), ids, F.lit("x"), F.lit("x"), F.lit("x"), terms, *[F.lit("z")] * 16]
    path = _scratch(spark, "idmapping")
    p.select(F.concat_ws("\t", *cells).alias("value")).write.text(path)
    return readers.read_idmapping(spark, path).select("acc", F.array_join("gene_ids", ",").alias("gene_ids"), F.array_join("go_terms", ",").alias("go_terms"))


@query("SELECT 'T' || p_partkey AS acc, p_name AS name, 'biological_process' AS type FROM part WHERE p_size % 4 <> 0 AND p_partkey % 3 <> 0")
def terms_roundtrip(spark, sf):
    p = read_table(spark, sf, "part")
    kind = F.when(F.col("p_partkey") % 3 == 0, "molecular_function").otherwise("biological_process")
    path = _scratch(spark, "terms")
    p.select(F.concat_ws("\t", _text("p_partkey"), "p_name", kind, F.concat(F.lit("T"), _text("p_partkey")), F.when(F.col("p_size") % 4 == 0, "1").otherwise("0")).alias("value")).write.text(path)
    return readers.read_terms(spark, path)


@query("SELECT 'g' || l_partkey AS id1, 's' || l_suppkey AS id2, l_quantity / 4 AS distance FROM lineitem")
def edge_file_roundtrip(spark, sf):
    path = _scratch(spark, "edge-file")
    rows = read_table(spark, sf, "lineitem").select(F.concat_ws("  ", F.concat(F.lit("g"), _text("l_partkey")), F.concat(F.lit("s"), _text("l_suppkey")), (F.col("l_quantity") / 4).cast("string")).alias("value"))
    rows.write.text(path)
    return readers.read_edges(spark, path)


_CLEAN = r"regexp_replace(text, '[ \t\n\r\f\v]', '', 'g')"


@query(f"SELECT source AS genome, CAST(doc_id AS VARCHAR) AS id, '>' || source || '|' || doc_id || '|' || lang AS nameline, length({_CLEAN}) AS n, md5({_CLEAN}) AS digest FROM documents WHERE {_CLEAN} <> ''")
def genome_fasta_roundtrip(spark, sf):
    """Written in folders by genome, read as a directory of genomes."""
    path = _scratch(spark, "genome-fasta")
    sinks.write_genome_fasta(queries._fasta(spark, sf).withColumnRenamed("source", "genome"), path)
    return readers.read_genome_dir(spark, path).select("genome", "id", "nameline", F.length("seq").cast("long").alias("n"), F.md5("seq").alias("digest"))


#: A file per brand: those of brands with an even number begin with two lines of data; some records have no or blank lines.
_FILES_SQL = """SELECT substr(p_brand, 7) AS brand, '>n|' || p_partkey || '|' || p_size AS nameline, CASE WHEN p_size % 10 = 3 THEN '' ELSE replace(upper(p_name), ' ', '') || p_type[1:2] END AS seq,
CASE WHEN p_size % 10 = 3 THEN 'no_sequence' WHEN p_size % 10 = 7 THEN 'blank_line' ELSE 'ok' END AS status FROM part
UNION ALL SELECT DISTINCT substr(p_brand, 7), '', 'LOSTDATA', 'no_nameline' FROM part WHERE CAST(substr(p_brand, 7) AS INT) % 2 = 0"""


def _files(spark, sf) -> str:
    p, brand = read_table(spark, sf, "part"), F.substring("p_brand", 7, 9)
    head, tail = F.concat(F.lit(">n|"), _text("p_partkey"), F.lit("|"), _text("p_size")), F.replace(F.upper("p_name"), F.lit(" "), F.lit(""))
    kind = F.col("p_size") % 10
    record = F.when(kind == 3, head).when(kind == 7, F.concat_ws("\n", head, tail, F.lit(" "), F.substring("p_type", 1, 2))).otherwise(F.concat_ws("\n", head, tail, F.substring("p_type", 1, 2)))
    whole = p.groupBy(brand.alias("brand")).agg(F.array_join(F.collect_list(record), "\n").alias("body"))  # a small file each
    lost = F.when(F.col("brand").cast("int") % 2 == 0, "LOST\nDATA\n").otherwise("")
    path = _scratch(spark, "files")
    whole.select("brand", F.concat(lost, "body").alias("value")).repartition("brand").write.partitionBy("brand").text(path)
    return path


@query(_FILES_SQL)
def fasta_small_files(spark, sf):
    """Many files in few partitions, malformed records and headless files among them."""
    found = readers.read_fasta(spark, _files(spark, sf), "keep")
    return found.select(F.regexp_extract("path", r"/brand=(\d+)/", 1).alias("brand"), "nameline", "seq", "status")


@query(f"SELECT CAST(regexp_extract(nameline, '[|]([0-9]+)[|]', 1) AS VARCHAR) AS id, nameline FROM ({_FILES_SQL}) WHERE status = 'ok'")
def fasta_ids_and_namelines(spark, sf):
    path = _files(spark, sf)
    lines = readers.read_namelines(spark, path).select("nameline", scalars.id_from_name(F.col("nameline")).alias("id"))
    return readers.read_ids(spark, path).join(lines, "id").select("id", "nameline")


def _dat_record(acc, name):
    head = (F.concat(F.lit("ID   E_X            Reviewed;         3 AA.")), F.concat(F.lit("AC   "), acc, F.lit(";")), F.concat(F.lit("OS   "), name, F.lit(".")))
    return F.concat_ws("\n", *head, F.lit("SQ   SEQUENCE   3 AA;"), F.lit("     MKV"))


@query("SELECT 'P' || p_partkey AS acc, p_brand AS org_name FROM part UNION ALL SELECT 'S' || s_suppkey, s_name FROM supplier")
def dat_of_several_files(spark, sf):
    """Two sources as one stream, one of them compressed."""
    record = _dat_record
    path = _scratch(spark, "dats")
    read_table(spark, sf, "part").select(record(F.concat(F.lit("P"), _text("p_partkey")), F.col("p_brand")).alias("value")).write.option("lineSep", "\n//\n").text(f"{path}/a")
    read_table(spark, sf, "supplier").select(record(F.concat(F.lit("S"), _text("s_suppkey")), F.col("s_name")).alias("value")).write.option("lineSep", "\n//\n").option("compression", "gzip").text(f"{path}/b")
    return readers.read_dat(spark, f"{path}/a", f"{path}/b").select("acc", "org_name")


@query("SELECT 'L' || l_orderkey || '_' || l_linenumber AS acc, l_returnflag || l_linestatus AS org_name, count(*) AS n FROM lineitem GROUP BY ALL")
def dat_of_gzip_members(spark, sf):
    """A record per line of an order in gzip files of many members, whose ranges are read by tasks of their own."""
    acc = F.concat_ws("_", F.concat(F.lit("L"), _text("l_orderkey")), _text("l_linenumber"))
    path = _scratch(spark, "members")
    gzipped.write_gzip_records(read_table(spark, sf, "lineitem").select(_dat_record(acc, F.concat("l_returnflag", "l_linestatus")).alias("value")), f"{path}/dat.gz", "\n//\n", 1 << 16)
    return readers.read_dat(spark, f"{path}/dat.gz", range_bytes=1 << 15).groupBy("acc", "org_name").agg(F.count("*").alias("n"))


@query("WITH gd AS (SELECT p_brand acc, row_number() OVER (ORDER BY p_brand) id FROM (SELECT DISTINCT p_brand FROM part)) SELECT p_partkey, CAST(id AS INT) AS id FROM part JOIN gd ON acc = p_brand")
def lookup_ids(spark, sf):
    ids = readers.lookup(queries._genome_table(spark, sf), "acc", "id")
    return read_table(spark, sf, "part").join(ids, F.col("p_brand") == F.col("acc")).select("p_partkey", "id")


# Operators on genes, hits and profiles


@query("SELECT p_brand AS genome, count(*) AS num_seqs FROM part GROUP BY 1")
def count_sequences(spark, sf):
    return census.count_sequences(A.genes(spark, sf))


@query("SELECT p_partkey AS acc, p_name AS gene_name FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49)")
def sequence_by_id(spark, sf):
    ids = read_table(spark, sf, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("acc"))
    return dims.sequence_by_id(A.genes(spark, sf).withColumnRenamed("gene", "acc"), ids).select("acc", "gene_name")


@query("SELECT a.vec_id AS q, b.vec_id AS s, CAST(list_sum(list_transform(list_zip(a.embedding, b.embedding), lambda z: CASE WHEN (z[1] > 0) <> (z[2] > 0) THEN 1 ELSE 0 END)) AS INT) AS d FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def hamming_of_neighbours(spark, sf):
    """Signs of vectors as profiles."""
    signs = read_table(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: (x > 0).cast("int")).alias("profile"))
    a, b = signs.toDF("q", "pq"), signs.toDF("s", "ps")
    return a.join(b, F.col("s") == F.col("q") + 1).select("q", "s", scalars.hamming(F.col("pq"), F.col("ps")).alias("d"))


@query(ORACLES["hamming_of_neighbours"])
def packed_hamming_of_neighbours(spark, sf):
    """The same, of profiles packed into longs."""
    signs = read_table(spark, sf, "embeddings").select("vec_id", scalars.pack(F.transform("embedding", lambda x: (x > 0).cast("int"))).alias("profile"))
    a, b = signs.toDF("q", "pq"), signs.toDF("s", "ps")
    return a.join(b, F.col("s") == F.col("q") + 1).select("q", "s", scalars.hamming_packed(F.col("pq"), F.col("ps")).alias("d"))


@query(f"""WITH {A.EVIDENCE_SQL}, f AS (SELECT q, s, dneed, min(dist) dist FROM evidence WHERE ek >= 20 GROUP BY ALL), b AS (SELECT DISTINCT q, s, dneed FROM evidence WHERE ek >= 30)
SELECT q AS qid, s AS sid, CAST(dneed AS VARCHAR) AS div, '1e-20' AS evalue, dist FROM f JOIN b USING (q, s, dneed)""")
def match_best_hits(spark, sf):
    hits = A.evidence(spark, sf, min_exponent=20).select(F.col("q").alias("qid"), F.col("s").alias("sid"), _text("dneed").alias("div"), F.lit("1e-20").alias("evalue"), "dist", "ek")
    forward = hits.groupBy("qid", "sid", "div", "evalue").agg(F.min("dist").alias("dist"))
    return rsd.match_best_hits(forward, hits.where("ek >= 30").distinct())


@query("SELECT CAST(l_orderkey AS VARCHAR) AS qdb, CAST(l_partkey AS VARCHAR) AS qid, CAST(l_suppkey AS VARCHAR) AS sid, l_quantity AS dist FROM lineitem UNION ALL SELECT CAST(o_orderkey AS VARCHAR), NULL, NULL, NULL FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def nest_and_flatten(spark, sf):
    return model.flatten(model.nest(_orthologs(spark, sf)), keep_empty=True).select("qdb", "qid", "sid", "dist")


def _orthologs(spark, sf) -> DataFrame:
    """Lines of orders as orthologs of twelve parameter sets, by the day of the month; orders without lines as empty ones."""
    o, line = read_table(spark, sf, "orders"), read_table(spark, sf, "lineitem")
    i = F.dayofmonth("o_orderdate") % 12
    div, evalue = F.element_at(F.array(*map(F.lit, model.DIVERGENCES)), (i % 3 + 1).cast("int")), F.element_at(F.array(*map(F.lit, model.EVALUES)), (F.floor(i / 3) + 1).cast("int"))
    return o.join(line, F.col("o_orderkey") == F.col("l_orderkey"), "left").select(
        _text("o_orderkey").alias("qdb"), F.lit("s").alias("sdb"), div.alias("div"), evalue.alias("evalue"),
        _text("l_partkey").alias("qid"), _text("l_suppkey").alias("sid"), F.col("l_quantity").alias("dist"),
    )


# Sinks


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS qdb, ['0.8', '0.5', '0.2'][CAST(day(o_orderdate) % 12 % 3 + 1 AS INT)] AS div, ['1e-5', '1e-10', '1e-15', '1e-20'][CAST(day(o_orderdate) % 12 // 3 + 1 AS INT)] AS evalue,
CAST(count(l_orderkey) AS INT) AS num_orthologs, coalesce(sum(l_quantity), 0) AS total FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey WHERE day(o_orderdate) % 12 % 3 <> 1 GROUP BY ALL""")
def collate_orthologs(spark, sf):
    """Two of three divergences, a folder for each parameter set."""
    wanted = model.params(spark).where("div <> '0.5'")
    path = _scratch(spark, "collated")
    sinks.collate_orthologs(model.nest(_orthologs(spark, sf)), path, wanted, "gzip")
    back = readers.read_orthdata(spark, f"{path}/*/*")
    return back.select("qdb", "div", "evalue", F.size("orthologs").alias("num_orthologs"), F.aggregate("orthologs", F.lit(0.0), lambda a, o: a + o["dist"]).alias("total"))


@query("SELECT value, 'false' AS wrote_again FROM (SELECT l_partkey || chr(9) || l_suppkey AS value FROM lineitem)")
def gzip_export_once(spark, sf):
    """Pairs for upload, compressed; a second export finds the first one."""
    rows = read_table(spark, sf, "lineitem").select(_text("l_partkey").alias("qid"), _text("l_suppkey").alias("sid"))
    path = _scratch(spark, "upload")
    again = [sinks.write_text(sinks.pairs_for_upload(rows), path, ["value"], "gzip") for _ in range(2)][1]
    return spark.read.text(path).select("value", F.lit(str(again).lower()).alias("wrote_again"))


@query("SELECT p_brand AS genome, p_partkey AS gene FROM part WHERE p_brand <> 'Brand#7' UNION ALL SELECT 'Brand#7', p_partkey FROM part WHERE p_brand = 'Brand#8'")
def replace_genome_on_disk(spark, sf):
    genes, path = A.genes(spark, sf).select("gene", "genome"), _scratch(spark, "genes")
    genes.write.partitionBy("genome").parquet(path)
    dims.replace_genome_on_disk(path, "Brand#7", genes.where("genome = 'Brand#8'"))
    return spark.read.parquet(path).select(_text("genome").alias("genome"), "gene")


@query(f"WITH {E_SQL} SELECT qdb, sdb, count(*) AS n FROM edges WHERE dist <= 0.05 GROUP BY ALL")
def reuse_of_a_result(spark, sf):
    """The second time from the saved result."""
    name = _scratch(spark, "query")
    made = lambda: A.edges(spark, sf, upper=0.05).groupBy("qdb", "sdb").agg(F.count("*").alias("n"))
    Q.reuse(spark, made, sf=sf, run=name, upper=0.05)
    return Q.reuse(spark, lambda: made().limit(0), upper=0.05, run=name, sf=sf)


# Releases


@query(f"{queries._CENSUS_SQL} SELECT genome, n_name AS name, genome AS taxon FROM census JOIN taxa USING (genome) JOIN nation ON CAST(n_nationkey AS VARCHAR) = genome".replace("taxa AS (SELECT CAST(n_nationkey AS VARCHAR) taxon", "taxa AS (SELECT CAST(n_nationkey AS VARCHAR) genome"))
def genome_names(spark, sf):
    counted = census.genome_census(queries._records(spark, sf))
    return release.genome_names(counted.select("genome"), _named_taxa(spark, sf))


def _named_taxa(spark, sf) -> DataFrame:
    names = read_table(spark, sf, "nation").select(_text("n_nationkey").alias("taxon"), F.col("n_name").alias("name"))
    return queries._taxa(spark, sf).join(names, "taxon")


#: Hits join customers of one day's orders of one status.
_DAY_SQL = """oc AS (SELECT o_orderdate, o_orderstatus, c_custkey, CAST(c_nationkey AS VARCHAR) db, CAST(round(o_totalprice * 100) AS BIGINT) c FROM orders JOIN customer ON c_custkey = o_custkey),
day_hits AS (SELECT a.c_custkey qid, b.c_custkey sid, a.db qdb, b.db sdb, CAST(min(abs(a.c - b.c)) AS DOUBLE) / CAST(100000000 AS DOUBLE) dist FROM oc a JOIN oc b ON a.o_orderdate = b.o_orderdate AND a.o_orderstatus = b.o_orderstatus AND a.db < b.db GROUP BY ALL)"""


def _day_hits(spark, sf) -> DataFrame:
    """Of these hits the nearest ones of each customer in each other nation, up to the largest limit of the grid."""
    o, c = read_table(spark, sf, "orders"), read_table(spark, sf, "customer")
    oc = o.join(c, F.col("c_custkey") == F.col("o_custkey"))
    points = oc.select("o_orderdate", "o_orderstatus", F.col("c_custkey").alias("gene"), _text("c_nationkey").alias("genome"), F.round(F.col("o_totalprice") * 100).cast("long").alias("value"))
    found = rsd.value_hits(points, ["o_orderdate", "o_orderstatus"], int(max(x[2] for x in _GRID_ROWS) * 1e8) + 1)
    return stage(found.select("qid", "sid", "qdb", "sdb", (F.col("apart").cast("double") / F.lit(1e8)).alias("dist")), "day-hits")


_GRID_ROWS = [("0.8", "1e-5", 0.0004), ("0.5", "1e-10", 0.0001), ("0.2", "1e-20", 0.00001)]
_BUILD_SQL = f"""{queries._CENSUS_SQL}, {_DAY_SQL}, chosen AS (SELECT genome FROM census c LEFT JOIN taxa t ON t.taxon = genome WHERE {queries._REASON} IS NULL),
named AS (SELECT genome, n_name AS name, cat_code FROM chosen JOIN taxa ON taxon = genome JOIN nation ON CAST(n_nationkey AS VARCHAR) = genome),
own AS (SELECT * FROM day_hits WHERE qdb IN (SELECT genome FROM named) AND sdb IN (SELECT genome FROM named)), mutual AS ({_mutual_sql('', 'own').replace('f AS (', 'SELECT * FROM (', 1).replace(')' + chr(10) + 'SELECT qdb, sdb, qid, sid, dist FROM f WHERE', ') WHERE')}),
sp AS (SELECT genome, cat_code, array_to_string(string_split(name, ' ')[1:2], ' ') species FROM named)"""


def _build(spark, sf) -> release.Release:
    grid = spark.createDataFrame(_GRID_ROWS, "div string, evalue string, `limit` double")
    e = read_table(spark, sf, "events")
    timings = e.groupBy(F.col("event_type").alias("type"), "user_id").agg(F.min("value").alias("start_time"), F.max("value").alias("end_time"))
    before = queries._taxa(spark, sf).select(F.lit("old").alias("release"), F.lit("taxons").alias("kind"), F.col("taxon").alias("item"))
    return release.build_release(queries._records(spark, sf), _named_taxa(spark, sf), _day_hits(spark, sf), grid, 35, timings, "new", before)


@query(_BUILD_SQL + " SELECT '0.8' AS div, '1e-5' AS evalue, qdb, sdb, qid, sid, dist FROM mutual WHERE dist <= 0.0004 UNION ALL SELECT '0.5', '1e-10', qdb, sdb, qid, sid, dist FROM mutual WHERE dist <= 0.0001 UNION ALL SELECT '0.2', '1e-20', qdb, sdb, qid, sid, dist FROM mutual WHERE dist <= 0.00001")
def release_orthologs(spark, sf):
    return _build(spark, sf).orthologs.select("div", "evalue", "qdb", "sdb", "qid", "sid", "dist")


@query(_BUILD_SQL + """ SELECT 'genomes' AS what, CAST(NULL AS VARCHAR) AS part, count(*) AS n FROM named UNION ALL SELECT 'pairs', NULL, count(*) * (count(*) - 1) // 2 FROM named
UNION ALL SELECT 'orthologs', NULL, count(*) FILTER (dist <= 0.0004) + count(*) FILTER (dist <= 0.0001) + count(*) FILTER (dist <= 0.00001) FROM mutual
UNION ALL SELECT 'genes', NULL, count(*) FROM rec WHERE complete AND genome IN (SELECT genome FROM chosen) AND org_code NOT LIKE '9%'
UNION ALL SELECT 'steps', event_type, count(*) FROM (SELECT DISTINCT event_type, user_id FROM events) GROUP BY ROLLUP (event_type)
UNION ALL SELECT 'items', 'taxons', count(*) FROM named HAVING count(*) > 0 UNION ALL SELECT 'items', 'taxonSpecies', count(DISTINCT species) FROM sp HAVING count(*) > 0
UNION ALL SELECT 'items', 'euks', n FROM (SELECT count(*) n FROM sp WHERE cat_code = 'E') WHERE n > 0 UNION ALL SELECT 'items', 'eukSpecies', n FROM (SELECT count(DISTINCT species) n FROM sp WHERE cat_code = 'E') WHERE n > 0
UNION ALL SELECT 'gone', 'taxons', n FROM (SELECT count(*) n FROM taxa WHERE taxon NOT IN (SELECT genome FROM named)) WHERE n > 0 AND EXISTS (SELECT 1 FROM named)""")
def release_build(spark, sf):
    """A release of no genomes has no items, and so is none that others are compared with."""
    r = _build(spark, sf)
    none = F.lit(None).cast("string").alias("part")
    stats = r.stats.select(F.explode(F.array(*(F.struct(F.lit(k).alias("what"), none, F.col(f"num_{k}").alias("n")) for k in ("genomes", "pairs", "orthologs")))).alias("x")).select("x.*")
    out = stats.unionByName(r.genes.agg(F.count("*").alias("n")).select(F.lit("genes").alias("what"), none, "n"))
    out = out.unionByName(r.timings.select(F.lit("steps").alias("what"), F.col("type").alias("part"), "n"))
    out = out.unionByName(r.items.groupBy(F.col("kind").alias("part")).agg(F.count("*").alias("n")).select(F.lit("items").alias("what"), "part", "n"))
    gone = r.changes.where("release_a = 'old'").groupBy(F.col("kind").alias("part")).agg(F.count("*").alias("n"))
    return out.unionByName(gone.select(F.lit("gone").alias("what"), "part", "n"))


@query(f"WITH {E_SQL}, near AS (SELECT q qid, s sid, substr(qdb, 7) qdb, substr(sdb, 7) sdb, dist FROM edges WHERE dist <= 0.01), {_mutual_sql('', 'near')}")
def reference_set(spark, sf):
    """From a directory of FASTA by genome to the text of its orthologs, read back."""
    part, path = read_table(spark, sf, "part"), _scratch(spark, "reference")
    genome = F.substring("p_brand", 7, 9)
    named = part.select(genome.alias("genome"), F.concat_ws("|", F.lit(">n"), _text("p_partkey"), F.col("p_name")).alias("nameline"), F.upper(F.regexp_replace("p_type", r"\s", "")).alias("sequence"))
    sinks.write_genome_fasta(named, f"{path}/in")
    taxa = part.select(genome.alias("taxon"), F.lower("p_brand").alias("name")).distinct()
    near = A.edges(spark, sf).select(_text("q").alias("qid"), _text("s").alias("sid"), F.substring("qdb", 7, 9).alias("qdb"), F.substring("sdb", 7, 9).alias("sdb"), "dist")
    # Ties go to the smaller id as a number, which hits carry along in their text's length.
    wide = lambda c: F.lpad(c, 12, "0")
    hits = near.withColumns({"qid": wide("qid"), "sid": wide("sid")})
    release.reference_set_from_dir(spark, f"{path}/in", taxa, hits, 0.01, "0.8", "1e-5", f"{path}/out")
    back = model.flatten(readers.read_orthdata(spark, f"{path}/out/orthologs/*/*"))
    return back.select("qdb", "sdb", F.col("qid").cast("long").alias("qid"), F.col("sid").cast("long").alias("sid"), "dist")


@query(f"WITH {E_SQL}, g AS (SELECT count(DISTINCT p_brand) n FROM part) SELECT '5' AS release, DATE '2013-06-01' AS release_date, n AS num_genomes, n * (n - 1) // 2 AS num_pairs, (SELECT count(*) FROM edges) AS num_orthologs FROM g")
def load_of_a_release(spark, sf):
    """Dimensions and ortholog files; loaded twice, which adds nothing."""
    genomes = stage(queries._genome_table(spark, sf), "genomes")
    sequences = stage(dims.sequence_dimension(queries._gene_rows(spark, sf), genomes), "sequences")
    flat = A.edges(spark, sf).select("qdb", "sdb", F.lit("0.8").alias("div"), F.lit("1e-5").alias("evalue"), _text("q").alias("qid"), _text("s").alias("sid"), "dist")
    path = _scratch(spark, "load")
    sinks.write_orthdata(model.nest(flat), f"{path}/in")
    for _ in range(2):
        row = release.load(spark, {"genomes": genomes, "sequence": sequences}, f"{path}/in", f"{path}/db", "5", "2013-06-01")
    return row
