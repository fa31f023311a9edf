"""Operators over vector, cluster and prune tables: DataFrame in, DataFrame out."""
