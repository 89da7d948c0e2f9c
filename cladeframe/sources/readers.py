"""Readers of the text formats. Records end in their own separators, so files stay
splittable; files named .gz are read by their members (see gzipped)."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cladeframe.functions.scalars import id_from_name, up_to_first_parens
from cladeframe.model import CATEGORIES
from cladeframe.sources.gzipped import RANGE, read_gzip_records


def _split_paths(paths: str | list[str]) -> tuple[list[str], list[str]]:
    """Files to be read by Spark, and those by their gzip members."""
    given = [paths] if isinstance(paths, str) else list(paths)
    return [x for x in given if not x.endswith(".gz")], [x for x in given if x.endswith(".gz")]


def _records(spark: SparkSession, paths: str | list[str], sep: str, range_bytes: int = RANGE) -> DataFrame:
    plain, gzipped = _split_paths(paths)
    text = spark.read.option("lineSep", sep).text(plain) if plain or not gzipped else None
    if not gzipped:
        return text
    more = read_gzip_records(spark, gzipped, sep, range_bytes).select("value")
    return more if text is None else text.unionByName(more)


def _lines(record: Column, code: str) -> Column:
    """The rest of the record's lines that begin with a two-letter code and blanks."""
    own = F.filter(F.split(record, "\n"), lambda x: x.startswith(code))
    return F.transform(own, lambda x: F.trim(F.substring(x, len(code) + 1, 1 << 30)))


def read_dat(spark: SparkSession, *paths: str, range_bytes: int = RANGE) -> DataFrame:
    """Annotated protein records (ID to //), one row each; several files are one stream.

    anomalies lists what is odd in a record: many_ox, many_pe, many_versions,
    empty_seq_line, no_id. Records without an AC line have a null acc. range_bytes: of a gzip
    file that a task looks for members in.
    """
    text = _records(spark, list(paths), "\n//\n", range_bytes)
    rec = text.select(F.regexp_replace("value", r"\n//\s*$", "").alias("r")).where(F.trim("r") != "")
    rows = rec.select(*(_lines(F.col("r"), c).alias(c) for c in ("ID", "AC", "DT", "DE", "GN", "OS", "OX", "PE", "KW", "DR")), F.filter(F.split("r", "\n"), lambda x: x.startswith("  ")).alias("seq"), "r")
    cross = lambda label: F.transform(F.filter("DR", lambda x: x.startswith(label + ";")), lambda x: F.get(F.split(x, "; "), F.lit(1)))
    keywords = F.array_join("KW", " ")
    versions = F.filter("DT", lambda x: x.contains("sequence version"))
    tokens = F.split(F.get("ID", F.lit(0)), r"\s+")
    names = F.filter(F.transform("DE", lambda x: F.regexp_extract(x, r"^RecName: Full=([^;]+)", 1)), lambda x: x != "")
    genes = F.filter(F.transform("GN", lambda x: F.regexp_extract(x, r"(?:^|[^A-Za-z])Name=([^;]+)", 1)), lambda x: x != "")
    taxa = F.filter(F.transform("OX", lambda x: F.regexp_extract(x, r"NCBI_TaxID=([^;]+)", 1)), lambda x: x != "")
    organism = F.array_join("OS", " ")
    return rows.select(
        F.when(F.get(tokens, F.lit(1)) == "Reviewed;", "sp").otherwise("tr").alias("ns"),
        F.regexp_extract(F.get("AC", F.lit(0)), r"^([^;\s]+)", 1).alias("acc"),
        F.get(tokens, F.lit(0)).alias("entry_id"),
        F.get(F.split(F.get(tokens, F.lit(0)), "_"), F.lit(1)).alias("org_code"),
        F.when(organism != "", up_to_first_parens(F.regexp_replace(organism, r"\.$", ""))).otherwise("").alias("org_name"),
        F.get(taxa, F.lit(0)).alias("taxon"),
        F.coalesce(F.get(genes, F.lit(0)), F.lit("")).alias("gene_name"),
        F.coalesce(F.get(names, F.lit(0)), F.lit("")).alias("gene_desc"),
        F.regexp_extract(F.coalesce(F.element_at(F.when(F.size("PE") > 0, F.col("PE")), -1), F.lit("")), r"^(\d+)", 1).alias("evidence"),
        F.regexp_extract(F.coalesce(F.get(versions, F.lit(0)), F.lit("")), r"sequence version (\d+)", 1).alias("seq_version"),
        keywords.contains("Complete proteome").alias("complete"),
        keywords.contains("Reference proteome").alias("reference"),
        cross("GeneID").alias("gene_ids"),
        cross("GO").alias("go_terms"),
        F.regexp_replace(F.array_join("seq", ""), r"\s+", "").alias("sequence"),
        F.array_compact(F.array(
            F.when(F.size("OX") > 1, "many_ox"), F.when(F.size("PE") > 1, "many_pe"), F.when(F.size(versions) > 1, "many_versions"),
            F.when(F.exists("seq", lambda x: F.trim(x) == ""), "empty_seq_line"), F.when(F.size("ID") == 0, "no_id"),
        )).alias("anomalies"),
    )


def _mark_first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds whether a record is its file's first: of the rows of one block, which come one after
    the other, the first one, where the block begins the file."""
    last = None
    for b in batches:
        key = [*zip(b.column("path").to_pylist(), b.column("at").to_pylist())]
        first = [k != before and k[1] == 0 for k, before in zip(key, [last, *key])]
        last = key[-1] if key else last
        yield b.append_column("first", pa.array(first, pa.bool_()))


def read_fasta(spark: SparkSession, paths: str | list[str], mode: str = "drop") -> DataFrame:
    """nameline, id, seq, status, path of FASTA records.

    Malformed are lines before a file's first name line (no_nameline, one record with an empty
    name line), name lines without any line after them (no_sequence), and records with a blank
    line. mode: 'drop' leaves them out, 'keep' keeps them with their status, 'strict' raises.
    """
    if mode not in ("drop", "keep", "strict"):
        raise ValueError(f"unknown mode {mode!r}")
    plain, gzipped = _split_paths(paths)
    text = None
    if plain or not gzipped:
        text = spark.read.option("lineSep", "\n>").text(plain).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))
        text = text.mapInArrow(_mark_first, "value string, path string, at long, first boolean").drop("at")
    if gzipped:
        more = read_gzip_records(spark, gzipped, "\n>")
        text = more if text is None else text.unionByName(more)
    value = F.regexp_replace(F.regexp_replace("value", r"\n\z", ""), r"\r", "")
    # The separator took the '>' of all records but a file's first one.
    headless = F.col("first") & ~value.startswith(">")
    body = F.when(headless, F.concat(F.lit("\n"), value)).when(F.col("first"), F.substring(value, 2, 1 << 30)).otherwise(value)
    name, seq = F.regexp_extract(body, r"^([^\n]*)", 1), F.regexp_extract(body, r"(?s)^[^\n]*\n(.*)$", 1)
    blank = F.exists(F.split(seq, "\n"), lambda x: F.trim(x) == "")
    status = F.when(headless, "no_nameline").when(~body.contains("\n"), "no_sequence").when(blank, "blank_line").otherwise("ok")
    nameline = F.when(headless, F.lit("")).otherwise(F.concat(F.lit(">"), F.rtrim(name)))
    rows = text.select(nameline.alias("nameline"), F.regexp_replace(seq, r"\s", "").alias("seq"), status.alias("status"), "path")
    if mode == "strict":
        rows = rows.withColumn("seq", F.when(F.col("status") == "ok", F.col("seq")).otherwise(F.raise_error(F.concat(F.lit("malformed record: "), "status")).cast("string")))
    elif mode == "drop":
        rows = rows.where("status = 'ok'")
    return rows.select("nameline", id_from_name(F.col("nameline")).alias("id"), "seq", "status", "path")


def read_ids(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return read_fasta(spark, paths).select("id")


def read_namelines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return read_fasta(spark, paths).select("nameline")


def read_genome_dir(spark: SparkSession, path: str) -> DataFrame:
    """FASTA records of a directory: of files <digits>.fasta, whose genome is the number, or of
    folders genome=<id>, as write_genome_fasta() leaves them."""
    found = read_fasta(spark, path)
    folder = F.try_url_decode(F.try_url_decode(F.regexp_extract("path", r"/genome=([^/]+)/[^/]+$", 1)))
    genome = F.coalesce(F.nullif(folder, F.lit("")), F.regexp_extract("path", r"/(\d+)\.fasta$", 1))
    return found.withColumn("genome", genome).where("genome <> ''").select("genome", "nameline", "id", "seq")


def orthdata_blocks(text: DataFrame) -> DataFrame:
    """PA/OR blocks (column value) to one row per parameter set; empty ones stay."""
    block = text.select(F.regexp_replace("value", r"\n?//\s*$", "").alias("b")).where(F.trim("b") != "").select(F.split("b", "\n").alias("lines"))
    head = F.split(F.filter("lines", lambda x: x.startswith("PA\t"))[0], "\t")
    rows = F.transform(F.transform(F.filter("lines", lambda x: x.startswith("OR\t")), lambda x: F.split(x, "\t")), lambda x: F.struct(x[1].alias("qid"), x[2].alias("sid"), x[3].cast("double").alias("dist")))
    return block.select(*(head[i].alias(c) for i, c in enumerate(("qdb", "sdb", "div", "evalue"), 1)), rows.alias("orthologs"))


def read_orthdata(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return orthdata_blocks(_records(spark, paths, "\n//\n"))


def read_ortholog_tsv(spark: SparkSession, paths: str | list[str], version: int = 2) -> DataFrame:
    """qid, sid, dist; version 1 files have the subject first, versions 2 and -1 the query."""
    if version not in (1, 2, -1):
        raise ValueError(f"unknown version {version}")
    cols = "sid string, qid string, dist double" if version == 1 else "qid string, sid string, dist double"
    return spark.read.csv(paths, sep="\t", schema=cols, quote="").select("qid", "sid", "dist")


def read_idmapping(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """acc, gene_ids, go_terms from columns 1, 3 and 7 of 23."""
    rows = spark.read.csv(paths, sep="\t", schema=", ".join(f"c{i} string" for i in range(1, 24)), quote="")
    items = lambda c: F.when(F.coalesce(c, F.lit("")) != "", F.split(c, "; ")).otherwise(F.array().cast("array<string>"))
    return rows.select(F.col("c1").alias("acc"), items(F.col("c3")).alias("gene_ids"), items(F.col("c7")).alias("go_terms"))


def taxa_from(categories: DataFrame, names: DataFrame) -> DataFrame:
    """taxon, cat_code, cat_name, name from lines (value) of categories.dmp and names.dmp."""
    c = F.split(F.trim("value"), r"\s+")
    cats = categories.select(c[2].alias("taxon"), c[0].alias("cat_code"))
    n = F.split("value", r"\s*\|\s*")
    own = names.select(n.alias("n")).where("size(n) = 5 and n[3] = 'scientific name'").select(F.col("n")[0].alias("taxon"), F.col("n")[1].alias("name"))
    full = F.create_map(*(F.lit(x) for kv in CATEGORIES.items() for x in kv))
    return cats.join(own, "taxon", "full").select("taxon", "cat_code", F.element_at(full, F.col("cat_code")).alias("cat_name"), "name")


def read_taxa(spark: SparkSession, categories: str, names: str) -> DataFrame:
    return taxa_from(spark.read.text(categories), spark.read.text(names))


def read_terms(spark: SparkSession, path: str) -> DataFrame:
    """acc, name, type of the terms in use of the aspect biological_process."""
    rows = spark.read.csv(path, sep="\t", schema="id string, name string, type string, acc string, is_obsolete string", quote="")
    return rows.where("is_obsolete = '0' and type = 'biological_process'").select("acc", "name", "type")


def read_edges(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """id1, id2, distance of lines of three words."""
    w = F.split(F.trim("value"), r"\s+")
    return spark.read.text(paths).where(F.trim("value") != "").select(w[0].alias("id1"), w[1].alias("id2"), w[2].cast("double").alias("distance"))


def lookup(table: DataFrame, key: str, value: str) -> DataFrame:
    """Two columns of a dimension as a join side (acc or name to surrogate id)."""
    return table.select(key, value).distinct()
