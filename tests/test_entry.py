"""Queries against their SQL on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__
from cladeframe import queries, releases, within
from cladeframe.operators import rsd
from cladeframe.sources import adapters as A

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SOME = ["edges_at_params", "params_grid_counts", "components", "cluster_stats", "retrieve_clusters", "terms_summary", "rsd_vectors", "genome_census", "change_log_diff", "term_bridge", "orthdata_roundtrip", "fasta_roundtrip", "dat_parse", "raw_pair_download", "clustering_summary_of_classes", "summary_of_every_nth_edge", "orthoxml_groups_within", "gene_view_within", "page_clusters", "transposed_profile_blocks_within", "profile_clusters_within", "nexus_pieces_within", "matrix_files_within", "cluster_cells_within", "orthoxml_group_pieces_within", "change_log_names", "fasta_small_files", "genome_fasta_roundtrip", "collate_orthologs", "replace_genome_on_disk", "release_build", "reference_set", "load_of_a_release"]

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def text(x):
    if isinstance(x, float):
        return f"{x:.6g}"
    return f"[{','.join(map(text, x))}]" if isinstance(x, (list, tuple)) else str(x)


@pytest.mark.parametrize("name", SOME)
def test_query_is_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = __spark_entry__.queries()[name](spark, SF)
    cur = con.execute(__spark_entry__.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    want = sorted(tuple(text(r[cols.index(c)]) for c in sorted(cols)) for r in cur.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert sorted(tuple(map(text, r)) for r in df.select(sorted(df.columns)).collect()) == want


def test_registry():
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    for module in (queries, within, releases):
        assert set(module.ORACLES) == set(module.QUERIES)


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns == ["cid", "cells", "avg_dist"]


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def test_edges_are_filtered_before_they_are_joined(spark):
    logical, physical = plan_of(A.edges(spark, SF, 5, 10))
    assert "NestedLoop" not in physical and "Cartesian" not in physical
    join = max(logical.split("\n").index(x) for x in logical.split("\n") if "Join Inner" in x)
    filters = [i for i, x in enumerate(logical.split("\n")) if "Filter" in x and "l_quantity" in x]
    assert len(filters) == 2 and logical.split("\n").index(next(x for x in logical.split("\n") if "Join Inner" in x)) < min(filters) and join


def test_nearest_vectors_by_blocks(spark):
    """The same in blocks of any size, and no pair of genes outside of a block's task."""
    own = A.vectors(spark, SF)
    whole = rsd.reciprocal_smallest_distance(rsd.vector_hits(own)).collect()
    blocked = rsd.vector_hits(own, 7)
    assert sorted(map(tuple, rsd.reciprocal_smallest_distance(blocked).collect())) == sorted(map(tuple, whole))
    assert "NestedLoop" not in plan_of(blocked)[1] and "Cartesian" not in plan_of(blocked)[1]
    assert blocked.where("qdb >= sdb").isEmpty()
