"""Writers of stage outputs and of the pruned corpus."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neardup.operators.extraction import eps_text, with_output_label


def write_centroids(centroids: DataFrame, path: str) -> None:
    centroids.select(
        F.col("cluster_id").cast("int"), F.col("centroid").cast("array<double>")
    ).write.mode("overwrite").parquet(path)


def write_assignment(assigned: DataFrame, path: str, batch_col: str | None = None) -> None:
    """Assigned rows; with ``batch_col`` in one folder per batch, without a shuffle.

    Each task writes a file for each batch: keep batches few.
    """
    writer = assigned.write.mode("overwrite")
    (writer.partitionBy(batch_col) if batch_col else writer).parquet(path)


def _by_folder(table: DataFrame, buckets: int | None) -> tuple[DataFrame, str]:
    """A folder per cluster, or per hash bucket of clusters when there are many."""
    if buckets is None:
        return table, "cluster_id"
    bucket = F.pmod("cluster_id", F.lit(buckets))
    return table.withColumn("cluster_bucket", bucket), "cluster_bucket"


def write_sorted_clusters(ranked: DataFrame, path: str, buckets: int | None = None) -> None:
    """Members in rank order, one folder per cluster (or per ``buckets`` group of clusters).

    The range shuffle on (cluster, rank) cuts a large cluster into several
    files, each a run of ranks.
    """
    ranked, folder = _by_folder(ranked, buckets)
    keys = [folder] if folder == "cluster_id" else [folder, "cluster_id"]
    (
        ranked.repartitionByRange(*keys, "rank")
        .sortWithinPartitions(*keys, "rank")
        .write.mode("overwrite")
        .partitionBy(folder)
        .parquet(path)
    )


def write_by_cluster(rows: DataFrame, path: str, buckets: int | None = None) -> None:
    """Prune or statistics rows in one folder per cluster.

    Folders of other clusters are left alone, so an interrupted run is
    repeated for its unfinished clusters only. With ``buckets`` a folder holds
    several clusters: write whole buckets.
    """
    rows, folder = _by_folder(rows, buckets)
    # Rebalance: small folders share a task, a large one is cut over several.
    (
        rows.hint("rebalance", folder)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(folder)
        .parquet(path)
    )


def write_stats(stats: DataFrame, path: str) -> None:
    stats.write.mode("overwrite").parquet(path)


def write_kept(kept: DataFrame, path: str, eps_list) -> None:
    """One folder of ids per threshold, named as the threshold was written.

    No shuffle: rows times thresholds would move for the sake of file sizes.
    """
    (
        kept.withColumn("eps", eps_text(eps_list))
        .write.mode("overwrite")
        .partitionBy("eps")
        .parquet(path)
    )


def write_retained(ratios: DataFrame, path: str, eps_list) -> None:
    """One JSON file with one object per threshold (the table has one row per threshold)."""
    (
        ratios.withColumn("eps", eps_text(eps_list))
        .coalesce(1)
        .write.mode("overwrite")
        .json(path)
    )


def compressed_text(compression: str) -> dict[str, str]:
    """Options of a text writer; the fast level of a codec that has levels.

    A file of gzip is read by one task: keep files small.
    """
    return {"compression": compression, "zlib.compress.level": "BEST_SPEED"}


def write_pruned_corpus(
    rows: DataFrame,
    ratios: DataFrame,
    path: str,
    eps_list,
    value_col: str = "value",
    order_col: str | None = None,
    split_col: str | None = None,
    mode: str = "overwrite",
    compression: str = "none",
) -> None:
    """The kept lines as text, in folders ``eps=<threshold>/ratio=<retained fraction>``.

    All thresholds are written by one job; lines pass through unchanged. With
    ``order_col``, by which the rows must be range-partitioned, the files of a
    folder hold the lines in its order, from one file to the next. With
    ``split_col`` too, the rows need not be: those of one split, which lie in one
    partition, go to a folder ``lines=<split>`` of their own, twelve digits long. Each
    threshold keeps most of the corpus: ``compression`` names a codec of Spark's text files.
    """
    labelled = with_output_label(rows, ratios).withColumn("eps", eps_text(eps_list))
    folders = ["eps", "ratio"]
    # Never null: else the writer replaces them and sorts anew, without the line order.
    for name in folders:
        labelled = labelled.withColumn(name, F.coalesce(name, F.lit("none")))
    if split_col is not None:
        number = F.lpad(F.col(split_col).cast("string"), 12, "0")
        labelled = labelled.withColumn("lines", F.coalesce(number, F.lit("none")))
        folders.append("lines")
    if order_col is not None:
        labelled = labelled.sortWithinPartitions(*folders, order_col)
    (
        labelled.select(F.col(value_col).alias("value"), *folders)
        .write.mode(mode)
        .partitionBy(*folders)
        .options(**compressed_text(compression))
        .text(path)
    )
