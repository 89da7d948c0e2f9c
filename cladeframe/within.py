"""Queries of clusters within a distance: those of cladeframe.queries over the edges up to
adapters.WITHIN, a limit that users give a query. It leaves many small clusters, where all edges
of a parameter set make one component of most genes."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cladeframe import queries
from cladeframe.sources.adapters import WITHIN

NAMES = """components cluster_stats clustering_summary cluster_edges cluster_matrix profile_rows transposed_profiles profile_counts transposed_profile_blocks profile_clusters cluster_terms profile_matrix_text terms_summary
gene_view gene_view_sequences gene_view_edges retrieve_clusters retrieve_tc_only browse_clusters browse_gene_ids term_view genes_summary hamming_profile clusters_view result_text
phylip_matrix nexus_matrix nexus_pieces matrix_files orthoxml_groups orthoxml_group_pieces cluster_cells""".split()

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f"{n}_within": functools.partial(queries.QUERIES[n], upper=WITHIN) for n in NAMES}
ORACLES = {f"{n}_within": queries.ORACLES[n].replace("sdb HAVING ", f"sdb HAVING min(dist) <= {WITHIN} AND ") for n in NAMES}
