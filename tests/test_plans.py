"""Plans of queries whose work must grow with their rows alone."""

import os
import re

import pytest

from cladeframe import queries, recovery
from cladeframe.operators import rsd

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["encode_edges", "edges_with_sequences", "delete_genome"])
def test_encoding_makes_edges_once(spark, name):
    """A product with a list of parameter sets would make all edges anew for each of its parts."""
    assert "Cartesian" not in physical(queries.QUERIES[name](spark, SF))


def test_release_views_encode_no_edges(spark, monkeypatch):
    """Their tables are the genomes and sequences; orthologs that none of them holds aren't made."""

    def none(*args, **kwargs):
        raise AssertionError("edges are made")

    monkeypatch.setattr(queries, "_encoded", none)
    assert recovery.QUERIES["current_release_views"](spark, SF).count() > 0


def test_hits_meet_the_parameter_sets_after_they_are_dealt_out(spark):
    """Only nearest ones are shuffled by parameter set, not a row per hit and set."""
    hits = spark.createDataFrame([(1, "a", 2, "b", 3, 9, 0.5), (1, "a", 4, "b", 8, 20, 0.1), (5, "a", 4, "b", 2, 20, 0.3)], "qid long, qdb string, sid long, sdb string, div_needed int, exponent int, dist double")
    params = spark.createDataFrame([("0.8", "1e-5", 8, 5), ("0.5", "1e-5", 5, 5), ("0.2", "1e-20", 2, 20)], "div string, evalue string, max_div int, min_exponent int")
    found = rsd.rsd_params(hits, params)
    assert sorted((r.div, r.qid, r.sid, r.dist) for r in found.collect()) == [("0.2", 5, 4, 0.3), ("0.5", 1, 2, 0.5), ("0.5", 5, 4, 0.3), ("0.8", 1, 4, 0.1)]
    dealt = re.findall(r"Exchange hashpartitioning\((div#[^)]*)\)", physical(found))
    assert dealt and all("qid#" in x and "sid#" in x for x in dealt)
