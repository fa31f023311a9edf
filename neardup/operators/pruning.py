"""Prune tables: which rows are duplicates at which threshold."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neardup.config import BLOCK_ROWS, eps_name, validate_eps
from neardup.operators.pairs import max_prior_similarity
from neardup.operators.ranking import split_into_chunks
from neardup.session import broadcast_if_small


def is_duplicate(eps: float, max_sim: str = "max_sim") -> Column:
    """Strictly more similar to an earlier row than 1 - eps."""
    return F.col(max_sim) > F.lit(1 - float(eps))


def flag_duplicates(prior: DataFrame, eps_list) -> DataFrame:
    """Long prune table: one row per input row and threshold, ``eps`` and ``is_dup``.

    The similarities are computed once; thresholds are expanded row by row.
    """
    flags = [
        F.struct(F.lit(e).alias("eps"), is_duplicate(e).alias("is_dup"))
        for e in validate_eps(eps_list)
    ]
    kept = [F.col(c) for c in prior.columns]
    return prior.select(*kept, F.inline(F.array(*flags)))


def flag_duplicates_wide(prior: DataFrame, eps_list) -> DataFrame:
    """Wide prune table: one boolean column ``eps=<value>`` per threshold."""
    flags = [is_duplicate(e).alias(f"eps={eps_name(e)}") for e in validate_eps(eps_list)]
    return prior.select("*", *flags)


def least_threshold(eps_list) -> float | None:
    """The similarity that a row must exceed to be flagged at all; None if that is negative."""
    least = min(1 - e for e in validate_eps(eps_list))
    return least if least >= 0 else None


def flags_by_bounds(
    members: DataFrame,
    eps_list,
    by: list[str] | tuple[str, ...] = ("cluster_id",),
    order: list[str] | tuple[str, ...] = ("rank",),
    id_col: str = "id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Long prune table, equal in its flags to that of the full comparison.

    Pairs that bounds prove too far apart for any threshold are not compared, so
    that no similarity comes with the flags.
    """
    prior = max_prior_similarity(
        members, by, order, id_col, vector_col, block_rows, above=least_threshold(eps_list)
    )
    return flag_duplicates(prior.select(*by, id_col, "max_sim"), eps_list).drop("max_sim")


def prune_clusters(
    ranked: DataFrame,
    limit: int | None = None,
    cluster_col: str = "cluster_id",
    id_col: str = "id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    collapse_copies: bool = True,
) -> DataFrame:
    """``max_sim`` and mate of every ranked row.

    With ``limit``, clusters above it are cut into contiguous runs of ranks and
    rows are compared only within their run. Without it the result is exact
    for any cluster size.
    """
    by = [cluster_col]
    if limit is not None:
        ranked = split_into_chunks(ranked, limit, cluster_col)
        by.append("chunk")
    prior = max_prior_similarity(
        ranked, by, ("rank",), id_col, vector_col, block_rows, collapse_copies
    )
    return prior


def duplicate_ids(
    members: DataFrame, cluster_col: str = "cluster_id", id_col: str = "id"
) -> DataFrame:
    """Ids that occur more than once in a cluster; empty for sound input."""
    return (
        members.groupBy(cluster_col, id_col)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def assert_unique_ids(
    members: DataFrame, cluster_col: str = "cluster_id", id_col: str = "id"
) -> None:
    example = duplicate_ids(members, cluster_col, id_col).take(1)
    if example:
        raise ValueError(f"id occurs more than once in its cluster: {example[0].asDict()}")


def assert_unique_row_ids(vectors: DataFrame, id_col: str = "id") -> None:
    """Raise if an id occurs twice in a table; only the ids are read."""
    counts = vectors.groupBy(id_col).agg(F.count(F.lit(1)).alias("n_rows"))
    example = counts.where("n_rows > 1").take(1)
    if example:
        raise ValueError(f"id occurs more than once: {example[0].asDict()}")


def pending_clusters(members: DataFrame, done: DataFrame, cluster_col: str = "cluster_id"):
    """Members of clusters that have no finished output yet."""
    # One row per cluster: a shuffle join would gather a large cluster in one task.
    done = broadcast_if_small(done.select(cluster_col).distinct(), 32)
    return members.join(done, cluster_col, "left_anti")
