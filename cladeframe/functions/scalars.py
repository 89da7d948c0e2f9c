"""Scalar functions on protein name lines, sequences and ids; all are column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def up_to_first_parens(s: Column) -> Column:
    """The prefix through the end of the first balanced block of parentheses, nested ones
    included; the whole text if there is none. Unbalanced texts raise an error."""
    start = F.struct(F.lit(0).alias("depth"), F.lit(0).alias("at"), F.lit(0).alias("end"), F.lit(False).alias("bad"))

    def step(acc: Column, c: Column) -> Column:
        depth = acc["depth"] + F.when(c == "(", 1).when(c == ")", -1).otherwise(0)
        open_ = acc["end"] == 0
        return F.struct(
            F.when(open_, depth).otherwise(acc["depth"]).alias("depth"),
            (acc["at"] + 1).alias("at"),
            F.when(open_ & (c == ")") & (depth == 0), acc["at"] + 1).otherwise(acc["end"]).alias("end"),
            (acc["bad"] | (open_ & (depth < 0))).alias("bad"),
        )

    done = F.aggregate(F.split(s, ""), start, step)
    # split() ends with no empty text for characters of a non-empty one
    return F.transform(
        F.array(done),
        lambda d: F.when(d["bad"] | ((d["end"] == 0) & (d["depth"] != 0)), F.raise_error(F.concat(F.lit("parentheses don't match: "), s)).cast("string"))
        .when(d["end"] > 0, F.substr(s, F.lit(1), d["end"]))
        .otherwise(s),
    )[0]


def make_nameline(ns: Column, acc: Column, entry_id: Column, desc: Column, organism: Column, gene: Column, evidence: Column, version: Column) -> Column:
    """>ns|acc|entry desc OS=... GN=... PE=... SV=..., leaving out what is empty."""
    part = lambda label, c: F.when(F.coalesce(c, F.lit("")) != "", F.concat(F.lit(label), c)).otherwise("")
    return F.concat(F.lit(">"), F.concat_ws("|", ns, acc, entry_id), part(" ", desc), part(" OS=", organism), part(" GN=", gene), part(" PE=", evidence), part(" SV=", version))


def parse_nameline(line: Column) -> Column:
    """struct<ns, entry_id, acc, gene_desc, gene_name ('' if none), org_name, org_code>."""
    head = r"^>?([^|]*)\|([^|]*)\|(\S+)"
    field = lambda label: F.regexp_extract(line, rf"\s{label}=(.*?)(?=\s[A-Z][A-Z]=|$)", 1)
    return F.struct(
        F.regexp_extract(line, head, 1).alias("ns"),
        F.regexp_extract(line, head, 3).alias("entry_id"),
        F.regexp_extract(line, head, 2).alias("acc"),
        F.regexp_extract(line, rf"{head}\s+(.*?)(?=\s[A-Z][A-Z]=|$)", 4).alias("gene_desc"),
        field("GN").alias("gene_name"),
        field("OS").alias("org_name"),
        F.regexp_extract(F.regexp_extract(line, head, 3), r"_(.*)$", 1).alias("org_code"),
    )


def id_from_name(name: Column) -> Column:
    """The id of a FASTA name: without '>', after a first '|' and before the next, first word."""
    bare = F.regexp_replace(name, "^>", "")
    parts = F.split(bare, r"\|")
    return F.split(F.when(F.size(parts) > 1, parts[1]).otherwise(parts[0]), r"\s+")[0]


def wrap_seq(seq: Column, n: int = 60) -> Column:
    if n < 1:
        raise ValueError("line length must be positive")
    return F.regexp_replace(F.regexp_replace(seq, f"(.{{{n}}})", "$1\n"), "\n$", "")


def first_or_null(items: Column) -> Column:
    return F.get(items, F.lit(0))


def genome_display_name(genome: Column, known: Column) -> Column:
    """The known name, else the id without '.aa' and with blanks for underscores."""
    return F.coalesce(known, F.regexp_replace(F.regexp_replace(genome, r"\.aa$", ""), "_", " "))


def species_of(name: Column) -> Column:
    return F.array_join(F.slice(F.split(F.trim(name), r"\s+"), 1, 2), " ")


def class_from_prefix(gene: Column) -> Column:
    """The organism that the first two characters of a gene id tell, or null; ids that begin
    with a whole number are of the fly."""
    two = F.substring(gene, 1, 2)
    # Organism codes by the prefixes of gene ids.
    codes = {"At": "ath", "CE": "cel", "Hs": "hsa", "SP": "spo", "EC": "ecu"}
    yeast, fly = "sce", "dme"
    known = F.create_map(*(F.lit(x) for kv in codes.items() for x in kv))
    return F.coalesce(F.element_at(known, two), F.when(two.startswith("Y"), yeast).when(two.rlike(r"^\s*[+-]?[0-9]+\s*$"), fly))


def hamming(a: Column, b: Column) -> Column:
    """How many positions of two profiles of one length differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x != y).cast("int")), F.lit(0), lambda acc, x: acc + x)


def hamming_packed(a: Column, b: Column) -> Column:
    """hamming() of two profiles packed into longs: 64 positions a step."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda acc, x: acc + x)


def pack(profile: Column) -> Column:
    """A profile of 0 and 1 as longs: position i is bit i mod 64 of long i div 64, counted from 0."""
    longs = F.sequence(F.lit(0), F.ceil(F.size(profile) / 64).cast("int") - 1)
    bit = lambda x, i: F.when(x == 1, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    one = lambda w: F.aggregate(F.transform(F.slice(profile, w * 64 + 1, F.lit(64)), bit), F.lit(0).cast("long"), lambda acc, x: acc.bitwiseOR(x))
    return F.when(F.size(profile) == 0, F.array().cast("array<long>")).otherwise(F.transform(longs, one))


def unpack(longs: Column, size: int) -> Column:
    """The 0/1 profile of that many positions."""
    if not size:
        return F.array().cast("array<int>")
    at = lambda i: F.get(longs, F.floor(i / 64).cast("int"))
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.call_function("shiftrightunsigned", at(i), i % 64).bitwiseAND(F.lit(1).cast("long")).cast("int"))
