"""k-means over a vector table: MLlib training and explicit Lloyd steps."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neardup.config import MAX_BROADCAST_BYTES, PruneConfig
from neardup.functions.vectors import l2_normalize
from neardup.operators.arrow_blocks import matrix
from neardup.operators.assignment import assign_nearest, centroid_matrix, nearest
from neardup.session import fits_broadcast, materialize

CENTROID_SCHEMA = "cluster_id int, centroid array<double>"


def train_kmeans(
    vectors: DataFrame,
    num_clusters: int,
    niter: int,
    seed: int = PruneConfig.seed,
    spherical: bool = False,
    vector_col: str = "embedding",
    train_fraction: float = 1.0,
    tol: float = 0.0,
) -> KMeansModel:
    """Train with MLlib; ``spherical`` gives unit-norm centroids and cosine distance.

    All ``niter`` steps are run unless no centroid moves by more than ``tol``.

    ``train_fraction`` below 1 trains on a seeded sample; every row is still
    assigned afterwards. Spherical training fails on zero vectors, see
    :func:`neardup.operators.assignment.valid_vectors`.
    """
    if not 0 < train_fraction <= 1:
        raise ValueError("train_fraction must be in (0, 1]")
    if train_fraction < 1:
        vectors = vectors.sample(fraction=train_fraction, seed=seed)
    return KMeans(
        k=num_clusters,
        maxIter=niter,
        tol=tol,
        seed=seed,
        distanceMeasure="cosine" if spherical else "euclidean",
        initMode="random",
        featuresCol="_features",
    ).fit(vectors.select(array_to_vector(vector_col).alias("_features")))


def saved_centroids(spark: SparkSession, path: str) -> DataFrame:
    """Centroids of a model saved at ``path``, read as a table by the executors."""
    return spark.read.parquet(f"{path.rstrip('/')}/data").select(
        F.col("clusterIdx").cast("int").alias("cluster_id"),
        vector_to_array("clusterCenter").alias("centroid"),
    )


def model_centroids(spark: SparkSession, model: KMeansModel) -> DataFrame:
    """Centroids of a model in memory; beyond the broadcast limit save it and read them."""
    k, dim = model.getK(), model.numFeatures
    if not fits_broadcast(k, 8 * dim):
        raise ValueError(f"{k} centroids of dimension {dim}: save the model, use saved_centroids")
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, CENTROID_SCHEMA)


def _is_saved(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path, "metadata")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def train_or_load_kmeans(
    vectors: DataFrame, path: str, reuse: bool = True, **train_args
) -> KMeansModel:
    """Load the model saved at ``path`` when ``reuse`` is set, else train and save it."""
    if reuse and _is_saved(vectors.sparkSession, path):
        return KMeansModel.load(path)
    model = train_kmeans(vectors, **train_args)
    model.write().overwrite().save(path)
    return model


def _lloyd_step_in_parts(
    vectors: DataFrame, centroids: DataFrame, spherical, vector_col, max_broadcast_bytes
) -> DataFrame:
    """One step with the centroids as a table, written so that lineage does not grow."""
    rows = vectors.where(F.col(vector_col).isNotNull()).select(vector_col)
    assigned = assign_nearest(
        rows, centroids, "ip" if spherical else "l2", vector_col, max_broadcast_bytes
    )
    means = assigned.groupBy("cluster_id").agg(
        vector_to_array(Summarizer.mean(array_to_vector(vector_col))).alias("_mean")
    )
    moved = F.col("_mean")
    if spherical:
        # A mean of length zero has no direction; the centroid stays.
        moved = F.when(F.exists("_mean", lambda x: x != 0), l2_normalize("_mean"))
    return materialize(
        centroids.join(means, "cluster_id", "left").select(
            "cluster_id", F.coalesce(moved, "centroid").alias("centroid")
        ),
        "centroids",
    )


def _partial_sums(centroids_bc, spherical: bool):
    """Per task: assign each batch and keep one running sum per centroid."""

    def run(batches):
        centroids = centroids_bc.value
        total = np.zeros_like(centroids)
        count = np.zeros(len(centroids), dtype=np.int64)
        for batch in batches:
            rows = matrix(batch.column(0), centroids.shape[1])
            if not len(rows):
                continue
            pick, _, _ = nearest(rows, centroids, "ip" if spherical else "l2")
            order = np.argsort(pick, kind="stable")
            found, starts, sizes = np.unique(pick[order], return_index=True, return_counts=True)
            total[found] += np.add.reduceat(rows[order], starts, axis=0)
            count[found] += sizes
        hit = np.flatnonzero(count)
        if len(hit):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(hit, pa.int32()),
                    pa.array(list(total[hit]), pa.list_(pa.float64())),
                    pa.array(count[hit]),
                ],
                ["position", "total", "n"],
            )

    return run


def lloyd(
    vectors: DataFrame,
    initial: DataFrame,
    niter: int,
    spherical: bool = False,
    vector_col: str = "embedding",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Lloyd iterations from given centroids; an empty cluster keeps its centroid.

    A step is one narrow pass that leaves at most k partial sums per task and a
    shuffle of those sums; rows never move. Centroids beyond the limit stay a
    table that is broadcast in parts (:func:`assign_nearest`); sums of a task then
    leave it as Spark's partial aggregates.
    """
    spark = vectors.sparkSession
    k, dim = initial.agg(F.count(F.lit(1)), F.max(F.size("centroid"))).first()
    if k * dim * 8 > max_broadcast_bytes:
        centroids = initial.select("cluster_id", F.col("centroid").cast("array<double>"))
        for _ in range(niter):
            centroids = _lloyd_step_in_parts(
                vectors, centroids, spherical, vector_col, max_broadcast_bytes
            )
        return centroids
    ids, centroids = centroid_matrix(initial)
    rows = vectors.where(F.col(vector_col).isNotNull()).select(F.col(vector_col))
    for _ in range(niter):
        broadcast = spark.sparkContext.broadcast(centroids)
        sums = (
            rows.mapInArrow(
                _partial_sums(broadcast, spherical), "position int, total array<double>, n long"
            )
            .groupBy("position")
            .agg(
                vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("total"),
                F.sum("n").alias("n"),
            )
            .toArrow()
        )
        centroids = centroids.copy()
        if sums.num_rows:
            at = sums["position"].to_numpy()
            moved = matrix(sums["total"]) / sums["n"].to_numpy()[:, None]
            if spherical:
                lengths = np.linalg.norm(moved, axis=1, keepdims=True)
                moved = np.where(lengths > 0, moved / np.maximum(lengths, 1e-300), centroids[at])
            centroids[at] = moved
        broadcast.unpersist()
    return spark.createDataFrame(
        [(int(i), [float(x) for x in c]) for i, c in zip(ids, centroids)], CENTROID_SCHEMA
    )
