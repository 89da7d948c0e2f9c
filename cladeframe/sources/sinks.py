"""Writers and text renderings. Texts are columns, ordered rows are written by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.functions.scalars import genome_display_name, wrap_seq
from cladeframe.model import nest
from cladeframe.operators.ranking import dense_ids
from cladeframe.session import publish, stage
from cladeframe.sources.gzipped import write_gzip_records


def xml_escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def orthdata_text(nested: DataFrame) -> DataFrame:
    """qdb, sdb, div, evalue, value: each parameter set as a PA/OR block without the final //."""
    lines = F.transform("orthologs", lambda o: F.concat_ws("\t", F.lit("OR"), o["qid"], o["sid"], o["dist"].cast("string")))
    head = F.concat_ws("\t", F.lit("PA"), "qdb", "sdb", "div", "evalue")
    return nested.select("qdb", "sdb", "div", "evalue", F.array_join(F.concat(F.array(head), lines), "\n").alias("value"))


def write_orthdata(nested: DataFrame, path: str, compression: str | None = None) -> None:
    out = orthdata_text(nested).select("value").write.option("lineSep", "\n//\n")
    (out.option("compression", compression) if compression else out).text(path)


def write_ortholog_tsv(orthologs: DataFrame, path: str, version: int = 2) -> None:
    if version not in (1, 2, -1):
        raise ValueError(f"unknown version {version}")
    orthologs.select(*(("sid", "qid") if version == 1 else ("qid", "sid")), "dist").write.csv(path, sep="\t", quote="")


def _salt(df: DataFrame, *columns: str) -> Column:
    """A number that deals the rows of a few large keys over all tasks."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return F.pmod(F.xxhash64(*columns), F.lit(n))


def collate_orthologs(nested: DataFrame, path: str, div_evalues: DataFrame | None = None, compression: str | None = None) -> None:
    """One folder of PA/OR text per (div, evalue), of all or of the given ones; pairs are dealt
    over as many files as there are shuffle partitions."""
    if div_evalues is not None:
        nested = nested.join(div_evalues.select("div", "evalue"), ["div", "evalue"], "left_semi")
    rows = orthdata_text(nested).withColumn("salt", _salt(nested, "qdb", "sdb"))
    out = rows.repartition("div", "evalue", "salt").select("div", "evalue", "value").write.partitionBy("div", "evalue").option("lineSep", "\n//\n")
    (out.option("compression", compression) if compression else out).text(path)


def fasta_text(nameline: str = "nameline", seq: str = "sequence", width: int = 60) -> Column:
    return F.concat_ws("\n", F.col(nameline), wrap_seq(F.col(seq), width))


def write_genome_fasta(genes: DataFrame, path: str, width: int = 60) -> None:
    """FASTA in a folder genome=<id> per genome, which read_genome_dir() reads; rows of one genome
    fill up to eight files."""
    rows = genes.select("genome", fasta_text(width=width).alias("value"), (_salt(genes, "nameline") % 8).alias("salt"))
    rows.repartition("genome", "salt").select("genome", "value").write.partitionBy("genome").text(path)


def pairs_for_upload(orthologs: DataFrame) -> DataFrame:
    return orthologs.select(F.concat_ws("\t", "qid", "sid").alias("value"))


def counts_report(census: DataFrame) -> DataFrame:
    """One tab-separated line per genome, ascending by its counts and then names."""
    cols = ["count", "complete", "reference", "sprot", "trembl", "genome"]
    return census.orderBy(*cols).select(F.concat_ws("\t", *(F.col(c).cast("string") for c in cols)).alias("value"))


def _profile_text(profiles: DataFrame, sep: str) -> Column:
    return F.array_join(F.transform("profile", lambda x: x.cast("string")), sep)


def nexus_matrix(rows: DataFrame) -> DataFrame:
    """(line_no, value) from (genome, profile), the profile over all clusters in order."""
    first = rows.agg(F.count("*").alias("n"), F.max(F.size("profile")).alias("c"))
    head = first.select(F.posexplode(F.array(F.lit("#Nexus"), F.lit("Begin data;"), F.concat(F.lit("Dimensions ntax="), "n", F.lit(" nchar="), "c", F.lit(";")), F.lit('Format datatype=standard symbols="01";'), F.lit("Matrix"))).alias("line_no", "value"))
    body = rows.select(F.lit(5).alias("line_no"), F.concat_ws(" ", "genome", _profile_text(rows, "")).alias("value"))
    return head.unionByName(body).unionByName(first.select(F.lit(6).alias("line_no"), F.lit(";\nEnd;").alias("value")))


def phylip_matrix(rows: DataFrame) -> DataFrame:
    """(line_no, value): the counts of genomes and clusters, then names of 10 characters and 0/1."""
    head = rows.agg(F.count("*").alias("n"), F.max(F.size("profile")).alias("c")).select(F.lit(0).alias("line_no"), F.concat_ws(" ", "n", "c").alias("value"))
    return head.unionByName(rows.select(F.lit(1).alias("line_no"), F.concat(F.rpad(F.substring("genome", 1, 10), 10, " "), _profile_text(rows, " ")).alias("value")))


#: Lines of a Nexus file before and after those of genomes.
NEXUS_HEAD = ["#Nexus", "Begin data;", "Dimensions ntax={n} nchar={c};", 'Format datatype=standard symbols="01";', "Matrix"]
NEXUS_END = [";", "End;"]


def matrix_pieces(blocks: DataFrame, genomes: list[str], kind: str) -> DataFrame:
    """(line, piece, value): a 'nexus' or 'phylip' matrix whose values, put one after the other in
    order of line and piece, are the file, ends of lines among them. No value grows with the clusters.

    blocks (genome, block, part) as genome_blocks() has them. Lines of genomes follow the given
    order; without clusters they are names only."""
    if kind not in ("nexus", "phylip"):
        raise ValueError(f"unknown kind {kind!r}")
    spark, nexus, blocks = blocks.sparkSession, kind == "nexus", stage(blocks, "matrix-blocks")
    head, end = (NEXUS_HEAD, NEXUS_END) if nexus else (["{n} {c}"], [])
    places = spark.createDataFrame([(g, len(head) + i) for i, g in enumerate(genomes)], "genome string, line int")
    name = F.regexp_replace("genome", r"\.aa$", "")
    first = F.concat(name, F.lit(" ")) if nexus else F.rpad(F.substring(name, 1, 10), 10, " ")
    last = blocks.agg(F.coalesce(F.max("block") + 2, F.lit(1)).cast("long").alias("last"))  # one row
    names = places.select("line", F.lit(0).cast("long").alias("piece"), first.alias("value"))
    ends = places.join(F.broadcast(last)).select("line", F.col("last").alias("piece"), F.lit("\n").alias("value"))
    spaced = F.concat(F.when(F.col("block") > 0, " ").otherwise(""), F.regexp_replace("part", "(.)(?=.)", "$1 "))
    body = blocks.join(F.broadcast(places), "genome").select("line", (F.col("block") + 1).cast("long").alias("piece"), (F.col("part") if nexus else spaced).alias("value"))
    fixed = spark.createDataFrame([*enumerate(head), *enumerate(end, len(head) + len(genomes))], "line int, value string")
    wide = blocks.where(F.col("genome") == F.lit(genomes[0] if genomes else None)).agg(F.coalesce(F.sum(F.length("part")), F.lit(0)).alias("c"))  # one row
    text = F.replace(F.replace("value", F.lit("{n}"), F.lit(str(len(genomes)))), F.lit("{c}"), F.col("c").cast("string"))
    around = fixed.join(F.broadcast(wide)).select("line", F.lit(0).cast("long").alias("piece"), F.concat(text, F.lit("\n")).alias("value"))
    return around.unionByName(names).unionByName(body).unionByName(ends)


def write_pieces(pieces: DataFrame, path: str, order: list[str]) -> bool:
    """Values in order, with nothing between them, as gzip files that make the whole one when joined
    by name (`cat part-*`, which is a gzip file too). A line may go on in the next file, so that
    tasks needn't hold lines. A folder that is whole stays: returns whether it wrote."""
    return publish(pieces.sparkSession, path, lambda folder: write_gzip_records(pieces.orderBy(*order), folder, sep=""))


def orthoxml_pairs(orthologs: DataFrame, genes: DataFrame) -> DataFrame:
    """(section, ord, value) of a document with a group per ortholog; genes are (gene, genome, num)."""
    a, b = (genes.select(F.col("gene").alias(c), F.col("num").alias(f"{c}_n")) for c in ("qid", "sid"))
    pairs = orthologs.join(a, "qid").join(b, "sid")
    ref = lambda c: F.concat(F.lit('<geneRef id="'), F.col(c).cast("string"), F.lit('"/>'))
    score = F.concat(F.lit('<score id="dist" value="'), F.col("dist").cast("string"), F.lit('"/>'))
    groups = pairs.select(F.lit(4).alias("section"), F.concat_ws("|", "qid", "sid", "div", "evalue").alias("ord"), F.concat(F.lit("<orthologGroup>"), score, ref("qid_n"), ref("sid_n"), F.lit("</orthologGroup>")).alias("value"))
    return _xml_document(genes, groups, "dist")


def orthoxml_groups(members: DataFrame, averages: DataFrame, genes: DataFrame) -> DataFrame:
    """As orthoxml_pairs, with a group per cluster: members (cid, gene), averages (cid, avg_dist)."""
    own = members.join(genes.select("gene", "num"), "gene").groupBy("cid").agg(F.array_sort(F.collect_list("num")).alias("nums")).join(averages, "cid")
    refs = F.array_join(F.transform("nums", lambda n: F.concat(F.lit('<geneRef id="'), n.cast("string"), F.lit('"/>'))), "")
    score = F.concat(F.lit('<score id="avgdist" value="'), F.round("avg_dist", 6).cast("string"), F.lit('"/>'))
    groups = own.select(F.lit(4).alias("section"), F.lpad(F.col("cid").cast("string"), 20, "0").alias("ord"), F.concat(F.lit('<orthologGroup id="'), F.col("cid").cast("string"), F.lit('">'), score, refs, F.lit("</orthologGroup>")).alias("value"))
    return _xml_document(genes, groups, "avgdist")


def orthoxml_group_pieces(members: DataFrame, averages: DataFrame, genes: DataFrame) -> DataFrame:
    """(section, ord, piece, value): orthoxml_groups() with a row for each gene of a species or group and
    one before and after them, so that no row grows with a genome or a cluster. In order of the three,
    values make the document; write_text() puts each into a line of its own."""
    wrap = lambda rows, section, key, before, after: rows.select(F.lit(section).alias("section"), key.alias("ord"), F.explode(F.array(F.struct(F.lit(0).cast("long").alias("piece"), before.alias("value")), F.struct(F.lit(2**63 - 1).alias("piece"), after.alias("value")))).alias("x")).select("section", "ord", "x.*")
    name, num = xml_escape(F.col("genome").cast("string")), F.col("num").cast("string")
    species = wrap(genes.select("genome").distinct(), 1, F.col("genome").cast("string"), F.concat(F.lit('<species name="'), name, F.lit('"><database><genes>')), F.lit("</genes></database></species>"))
    own = genes.select(F.lit(1).alias("section"), F.col("genome").cast("string").alias("ord"), F.col("num").cast("long").alias("piece"), F.concat(F.lit('<gene id="'), num, F.lit('" protId="'), xml_escape(F.col("gene").cast("string")), F.lit('"/>')).alias("value"))
    cid = F.col("cid").cast("string")
    score = F.concat(F.lit('<score id="avgdist" value="'), F.round("avg_dist", 6).cast("string"), F.lit('"/>'))
    groups = wrap(averages, 4, F.lpad(cid, 20, "0"), F.concat(F.lit('<orthologGroup id="'), cid, F.lit('">'), score), F.lit("</orthologGroup>"))
    kept = members.select("cid", "gene").join(averages.select("cid"), "cid", "left_semi").join(genes.select("gene", "num"), "gene")
    refs = kept.select(F.lit(4).alias("section"), F.lpad(cid, 20, "0").alias("ord"), F.col("num").cast("long").alias("piece"), F.concat(F.lit('<geneRef id="'), num, F.lit('"/>')).alias("value"))
    return _xml_frame(genes.sparkSession, "avgdist").withColumn("piece", F.lit(0).cast("long")).unionByName(species).unionByName(own).unionByName(groups).unionByName(refs)


def _xml_document(genes: DataFrame, groups: DataFrame, score: str) -> DataFrame:
    spark = genes.sparkSession
    gene = F.concat(F.lit('<gene id="'), F.col("num").cast("string"), F.lit('" protId="'), xml_escape(F.col("gene").cast("string")), F.lit('"/>'))
    species = genes.groupBy("genome").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("num", gene.alias("x")))), lambda s: s["x"]), "").alias("genes"))
    blocks = species.select(F.lit(1).alias("section"), F.col("genome").cast("string").alias("ord"), F.concat(F.lit('<species name="'), xml_escape(F.col("genome").cast("string")), F.lit('"><database><genes>'), "genes", F.lit("</genes></database></species>")).alias("value"))
    return _xml_frame(spark, score).unionByName(blocks).unionByName(groups)


def _xml_frame(spark: SparkSession, score: str) -> DataFrame:
    """(section, ord, value): what stands around species and groups."""
    return spark.createDataFrame(
        [(0, "", '<orthoXML xmlns="http://orthoXML.org/2011/" version="0.3">'), (2, "", f'<scores><scoreDef id="{score}" desc="distance"/></scores>'), (3, "", "<groups>"), (5, "", "</groups></orthoXML>")],
        "section int, ord string, value string",
    )


def profile_matrix_text(members: DataFrame, genomes: list[str], names: DataFrame, terms: DataFrame) -> DataFrame:
    """(cid, value): 0/1 per genome and a last column of ids by genome, distinct names and distinct
    terms, joined by tabs; the column heads in a row without a cid, which comes first in order.

    members (cid, genome, gene); names (gene, gene_name); terms (gene, term)."""
    per = members.groupBy("cid", "genome").agg(F.array_join(F.array_sort(F.collect_list(F.col("gene").cast("string"))), ", ").alias("ids"))
    cells = per.groupBy("cid").agg(F.map_from_entries(F.collect_list(F.struct("genome", "ids"))).alias("by_genome"))
    joined = lambda side, c: members.join(side, "gene").where(f"{c} is not null and {c} <> ''").groupBy("cid").agg(F.array_join(F.array_sort(F.collect_set(c)), ", ").alias(c))
    rows = cells.join(joined(names, "gene_name"), "cid", "left").join(joined(terms, "term"), "cid", "left")
    listed = F.array(*map(F.lit, genomes)) if genomes else F.array().cast("array<string>")  # one constant, whatever their number
    flags = F.array_join(F.transform(listed, lambda g: F.map_contains_key("by_genome", g).cast("int").cast("string")), "\t")
    ids = F.array_join(F.transform(listed, lambda g: F.coalesce(F.element_at("by_genome", g), F.lit(""))), "; ")
    info = F.concat_ws(" | ", ids, F.coalesce("gene_name", F.lit("")), F.coalesce("term", F.lit("")))
    body = rows.select("cid", F.concat_ws("\t", flags, info).alias("value"))
    # Fixed value: the head of the last column.
    head = "\t".join([*genomes, "Cluster_Info=gene, ids; per; genome | gene, names | go, terms"])
    return members.sparkSession.createDataFrame([(head,)], "value string").select(F.lit(None).cast(members.schema["cid"].dataType).alias("cid"), "value").unionByName(body)


def result_text(members: DataFrame, genomes: DataFrame, names: DataFrame, terms: DataFrame) -> DataFrame:
    """(cid, genome, gene, value): Id, Genome, Gene Name, Terms by tabs; '-' for an absent genome."""
    gene_terms = terms.groupBy("gene").agg(F.array_join(F.array_sort(F.collect_set("term")), ", ").alias("terms"))
    full = members.select("cid").distinct().join(F.broadcast(genomes.select("genome")))  # result columns of one query
    rows = full.join(members, ["cid", "genome"], "left").join(names, "gene", "left").join(gene_terms, "gene", "left")
    cell = lambda c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit("-"))
    return rows.select("cid", "genome", "gene", F.concat_ws("\t", cell("gene"), genome_display_name(F.col("genome"), F.lit(None).cast("string")), cell("gene_name"), cell("terms")).alias("value"))


def result_lines(members: DataFrame, stats: DataFrame, genomes: DataFrame, names: DataFrame, terms: DataFrame, title: str = "Orthology Search Results") -> DataFrame:
    """(cid, part, genome, gene, value): result_text() as a whole document. The title and the number
    of clusters come first (cid null), each with an empty line after it; then of each cluster
    its number with its average distance (part 0), the column heads (1), the lines (2) and an
    empty line (3), in the order of these columns."""
    cluster = stats.select("cid", F.round("avg_dist", 6).alias("avg_dist"))
    numbered = dense_ids(cluster, "cid", name="nth")
    none = [F.lit(None).cast("string").alias("genome"), F.lit(None).cast(members.schema["gene"].dataType).alias("gene")]
    # The sentences and heads of the text format.
    n = F.count("*")
    said = F.when(n == 0, "No results found for your search.").when(n == 1, "1 result found for your search.").otherwise(F.concat(n.cast("string"), F.lit(" results found for your search.")))
    first = cluster.agg(F.array(F.lit(title), F.lit(""), said, F.lit("")).alias("all")).select(F.posexplode("all").alias("part", "value"))
    total = first.select(F.lit(None).cast(members.schema["cid"].dataType).alias("cid"), "part", *none, "value")
    about = F.concat(F.lit("Gene Cluster #"), F.col("nth").cast("string"), F.lit(" | Average Evolutionary Distance: "), F.col("avg_dist").cast("decimal(18,6)").cast("string"))
    line = lambda part, value: F.struct(F.lit(part).alias("part"), value.alias("value"))
    around = F.array(line(0, about), line(1, F.lit("Id\tGenome\tGene Name\tGO Terms")), line(3, F.lit("")))
    frame = numbered.select("cid", F.explode(around).alias("a")).select("cid", "a.part", *none, "a.value")
    lines = result_text(members, genomes, names, terms).select("cid", F.lit(2).alias("part"), "genome", "gene", "value")
    return total.unionByName(frame).unionByName(lines)


def raw_pair_text(orthologs: DataFrame, nested_only: bool = False) -> DataFrame:
    """One pair's orthologs as PA/OR text, in external ids."""
    return orthdata_text(orthologs if nested_only else nest(orthologs))


def write_text(lines: DataFrame, path: str, order: list[str], compression: str | None = None) -> bool:
    """Rows' value in order, as parts that are read one after the other. A folder that is whole
    stays, and one that a killed run left is made anew: returns whether it wrote."""

    def write(folder: str) -> None:
        out = lines.orderBy(*order).select("value").write
        (out.option("compression", compression) if compression else out).text(folder)

    return publish(lines.sparkSession, path, write)
