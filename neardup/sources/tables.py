"""Stage outputs of an earlier run. Filters on partition columns prune folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neardup.config import eps_name


def read_centroids(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("cluster_id int, centroid array<double>").parquet(path)


def read_assignment(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_sorted_clusters(
    spark: SparkSession, path: str, first: int | None = None, last: int | None = None
) -> DataFrame:
    """Ranked members, optionally of a range of clusters only."""
    ranked = spark.read.parquet(path)
    if first is not None:
        ranked = ranked.where(F.col("cluster_id") >= first)
    if last is not None:
        ranked = ranked.where(F.col("cluster_id") <= last)
    return ranked


def read_prior(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_kept(spark: SparkSession, path: str, eps: float) -> DataFrame:
    """``id`` kept at one threshold; reads that threshold's folder only."""
    # The folder name is text: a float read back from it need not compare equal.
    kept = spark.read.schema("id long, eps string").parquet(path)
    return kept.where(F.col("eps") == eps_name(eps)).select(F.lit(float(eps)).alias("eps"), "id")
