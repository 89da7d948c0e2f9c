import pytest
from pyspark.sql import functions as F

from cladeframe.functions import scalars


def one(spark, column, *values):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{i} string" for i in range(len(values))))
    return df.select(column(*(F.col(f"c{i}") for i in range(len(values)))).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "text, want",
    [
        ("oak (red (tall)) (old)", "oak (red (tall))"), ("plain words", "plain words"), ("(lead) then more", "(lead)"), ("", ""), ("a(b)c(d)", "a(b)"), ("()x", "()"),
        ("Lake phage 12 (strain Kivu) (LP-12)", "Lake phage 12 (strain Kivu)"), ("one (two) (three", "one (two)"), ("one (two)) three)", "one (two)"), ("deep ((((x)))) y", "deep ((((x))))"),
    ],
)
def test_first_parens(spark, text, want):
    assert one(spark, scalars.up_to_first_parens, text) == want


@pytest.mark.parametrize("text", ["never ((closed) here", "closed)) first (then)", "("])
def test_first_parens_unbalanced(spark, text):
    with pytest.raises(Exception, match="parentheses don't match"):
        one(spark, scalars.up_to_first_parens, text)


@pytest.mark.parametrize("name", [f"{mark}{space}id{rest}" for mark in ("", ">") for space in ("", "db|") for rest in ("", " words after", *(("|", "|entry", " words|entry") if space else ()))])
def test_id_from_name(spark, name):
    assert one(spark, scalars.id_from_name, name) == "id"


def test_nameline(spark):
    line = ">sp|P38398|BRCA1_HUMAN Breast cancer type 1 susceptibility protein OS=Homo sapiens GN=BRCA1 PE=1 SV=2"
    n = one(spark, scalars.parse_nameline, line)
    assert (n.ns, n.acc, n.entry_id, n.org_code, n.gene_name, n.org_name) == ("sp", "P38398", "BRCA1_HUMAN", "HUMAN", "BRCA1", "Homo sapiens")
    assert n.gene_desc == "Breast cancer type 1 susceptibility protein"
    assert one(spark, scalars.parse_nameline, ">sp|P1|A_B Some desc OS=X y").gene_name == ""
    args = ("sp", "P38398", "BRCA1_HUMAN", "Breast cancer type 1 susceptibility protein", "Homo sapiens", "BRCA1", "1", "2")
    assert one(spark, scalars.make_nameline, *args) == line
    assert one(spark, scalars.make_nameline, "tr", "Q1", "X_Y", "", "", "", "", "") == ">tr|Q1|X_Y"


def test_small_ones(spark):
    assert one(spark, lambda c: scalars.wrap_seq(c, 3), "ABCDEFG") == "ABC\nDEF\nG"
    assert one(spark, lambda c: scalars.wrap_seq(c, 3), "ABCDEF") == "ABC\nDEF"
    with pytest.raises(ValueError):
        scalars.wrap_seq(F.col("x"), 0)
    assert one(spark, scalars.species_of, " Homo sapiens neanderthalensis") == "Homo sapiens"
    assert one(spark, scalars.genome_display_name, "Homo_sapiens.aa", None) == "Homo sapiens"
    for gene, organism in (("At3g1", "ath"), ("CE01", "cel"), ("Hs12", "hsa"), ("SPAC", "spo"), ("EC7", "ecu"), ("YAL1", "sce"), ("12345", "dme"), ("7", "dme"), ("1a2", None), ("", None)):
        assert one(spark, scalars.class_from_prefix, gene) == organism, gene
    assert one(spark, scalars.class_from_prefix, "zz") is None
    assert one(spark, lambda a, b: scalars.hamming(F.split(a, ","), F.split(b, ",")), "1,1,0", "0,1,1") == 2
