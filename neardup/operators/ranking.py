"""Order of the members inside their cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from neardup.config import MAX_WINDOW_ROWS, validate_survivor_rule
from neardup.session import broadcast_if_small, materialize


def survivor_order(
    which_to_keep: str = "hard",
    keep_hard: bool = True,
    seed: int = 1234,
    dist_col: str = "dist",
    id_col: str = "id",
) -> list[Column]:
    """Ascending sort keys whose first row survives.

    ``hard`` follows the distance to the centroid, farthest first when
    ``keep_hard``, ids ascending among ties. ``easy`` is exactly that order
    reversed, ids included. ``random`` is a seeded hash order.
    """
    rule = validate_survivor_rule(which_to_keep)
    dist, row_id = F.col(dist_col), F.col(id_col)
    if rule == "random":
        return [F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string"))).asc(), row_id.asc()]
    farthest_first = keep_hard if rule == "hard" else not keep_hard
    return [
        dist.desc() if farthest_first else dist.asc(),
        row_id.asc() if rule == "hard" else row_id.desc(),
    ]


def with_order_keys(
    members: DataFrame,
    which_to_keep: str = "hard",
    keep_hard: bool = True,
    seed: int = 1234,
    dist_col: str = "dist",
    id_col: str = "id",
) -> DataFrame:
    """Add ``order_0, order_1``: the survivor order as two ascending columns.

    They place a row among its cluster without ranking the cluster.
    """
    rule = validate_survivor_rule(which_to_keep)
    dist, row_id = F.col(dist_col).cast("double"), F.col(id_col).cast("long")
    if rule == "random":
        keys = [F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string"))), row_id]
    else:
        farthest_first = keep_hard if rule == "hard" else not keep_hard
        keys = [-dist if farthest_first else dist, row_id if rule == "hard" else -row_id]
    return members.withColumn("order_0", keys[0]).withColumn("order_1", keys[1])


def rank_in_cluster(
    members: DataFrame,
    order: list[Column],
    cluster_col: str = "cluster_id",
    max_window_rows: int = MAX_WINDOW_ROWS,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add ``rank``, 1 for the first member of each cluster.

    The largest cluster is measured first. While it fits one task this is a
    plain window. Above ``max_window_rows`` the table is range-sorted by
    (cluster, order) into evenly sized pieces, each piece is numbered by
    itself, and the number of members in earlier pieces of the same cluster is
    added, so that a cluster with a third of all rows still uses every task.
    """
    largest = members.groupBy(cluster_col).count().agg(F.max("count")).first()[0] or 0
    if largest <= max_window_rows:
        window = Window.partitionBy(cluster_col).orderBy(*order)
        return members.withColumn("rank", F.row_number().over(window).cast("long"))
    spark = members.sparkSession
    if num_partitions is None:
        num_partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Written out: the piece of a row must not change between the two uses.
    pieces = materialize(
        members.repartitionByRange(num_partitions, F.col(cluster_col), *order).withColumn(
            "_piece", F.spark_partition_id()
        ),
        "rank-pieces",
    )
    # One row per (cluster, piece): at most clusters + num_partitions rows.
    earlier = Window.partitionBy(cluster_col).orderBy("_piece").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = (
        pieces.groupBy(cluster_col, "_piece")
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
        .select(F.col(cluster_col).alias("_c"), F.col("_piece").alias("_p"), "_before")
    )
    window = Window.partitionBy(cluster_col, "_piece").orderBy(*order)
    same = F.col(cluster_col).eqNullSafe(F.col("_c")) & (F.col("_piece") == F.col("_p"))
    return (
        pieces.withColumn("_in_piece", F.row_number().over(window))
        .join(offsets, same)
        .withColumn("rank", F.col("_before") + F.col("_in_piece"))
        .drop("_piece", "_p", "_c", "_n", "_before", "_in_piece")
    )


def rank_within_cluster(
    members: DataFrame,
    keep_hard: bool = True,
    which_to_keep: str = "hard",
    seed: int = 1234,
    dist_col: str = "dist",
    id_col: str = "id",
    cluster_col: str = "cluster_id",
    max_window_rows: int = MAX_WINDOW_ROWS,
) -> DataFrame:
    order = survivor_order(which_to_keep, keep_hard, seed, dist_col, id_col)
    return rank_in_cluster(members, order, cluster_col, max_window_rows)


def cluster_slice(
    members: DataFrame, first: int, last: int, cluster_col: str = "cluster_id"
) -> DataFrame:
    """Members of clusters ``first`` to ``last``, both included."""
    return members.where(F.col(cluster_col).between(first, last))


def gather_vectors(members: DataFrame, vectors: DataFrame, id_col: str = "id") -> DataFrame:
    """Put the vectors beside members that carry ids only; ids spread the join evenly."""
    return members.join(vectors, id_col)


def cluster_sizes(members: DataFrame, cluster_col: str = "cluster_id") -> DataFrame:
    return members.groupBy(cluster_col).agg(F.count(F.lit(1)).alias("cluster_size"))


def chunk_of_rank(rank: Column, size: Column, limit: Column) -> Column:
    """Chunk of a 1-based rank when ``size`` members are cut into ceil(size/limit) runs.

    Run i starts at ``floor(i * (size / chunks))``, computed in floating point:
    exact integer arithmetic places some boundaries one row later. The
    estimate from plain division is off by at most one run, which the two
    comparisons with the run's own start put right.
    """
    chunks = F.ceil(size / limit.cast("double"))
    step = size.cast("double") / chunks
    at = (rank - 1).cast("double")
    guess = F.least(F.floor(at / step), chunks - 1)
    start = lambda i: F.floor(i * step)
    return (
        F.when((guess > 0) & (start(guess) > at), guess - 1)
        .when((guess + 1 < chunks) & (start(guess + 1) <= at), guess + 1)
        .otherwise(guess)
        .cast("int")
    )


def split_into_chunks(
    ranked: DataFrame, limit: int, cluster_col: str = "cluster_id"
) -> DataFrame:
    """Add ``chunk``: oversize clusters become runs of at most ``limit`` ranks."""
    if limit < 1:
        raise ValueError("limit must be positive")
    # One row per cluster; joining them by shuffle would gather a large cluster in one task.
    sizes = broadcast_if_small(ranked.groupBy(cluster_col).agg(F.max("rank").alias("_size")), 64)
    return (
        ranked.join(sizes, cluster_col)
        .withColumn("chunk", chunk_of_rank(F.col("rank"), F.col("_size"), F.lit(limit)))
        .drop("_size")
    )
