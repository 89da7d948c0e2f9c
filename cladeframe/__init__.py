"""Ortholog edge-table analytics on Spark DataFrames: cladeframe."""
