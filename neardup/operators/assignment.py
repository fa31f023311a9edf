"""Nearest-centroid assignment and the distance stored with it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neardup.config import MAX_BROADCAST_BYTES, SIM_DECIMALS, SIM_METRICS, validate_metric
from neardup.functions.vectors import (
    COSINE_EPS,
    cosine_distance,
    is_valid_vector,
    l2_normalize,
)
from neardup.operators.arrow_blocks import matrix
from neardup.session import materialize

_ASSIGNMENT = "struct<cluster_id:int,score:double>"
# Score blocks of at most this many cells are held at once inside a task.
_SCORE_CELLS = 1 << 23


def _check_score(score: str) -> None:
    if score not in ("ip", "l2"):
        raise ValueError(f"score must be 'ip' or 'l2', got {score!r}")


def nearest(rows: np.ndarray, centroids: np.ndarray, score: str):
    """Best centroid of each row: its position, the score against it and its closeness.

    Closeness (the inner product, for L2 less half the squared length) is
    rounded to SIM_DECIMALS before it is compared; among equals the lowest
    position wins, however the centroids are cut into blocks.
    """
    best = np.zeros(len(rows), dtype=np.int64)
    closest = np.zeros(len(rows))
    value = np.zeros(len(rows))
    half_sq = 0.5 * np.einsum("ij,ij->i", centroids, centroids)
    step = max(1, _SCORE_CELLS // len(centroids))
    for at in range(0, len(rows), step):
        part = rows[at : at + step]
        ip = part @ centroids.T
        closeness = ip if score == "ip" else ip - half_sq
        top = np.round(closeness.max(axis=1), SIM_DECIMALS)
        # Not below this: rounds to the top value.
        pick = np.argmax(closeness >= top[:, None] - 0.5 * 10.0**-SIM_DECIMALS, axis=1)
        best[at : at + step] = pick
        closest[at : at + step] = top
        if score == "ip":
            value[at : at + step] = ip[np.arange(len(part)), pick]
        else:
            gap = part - centroids[pick]
            value[at : at + step] = np.einsum("ij,ij->i", gap, gap)
    return best, np.round(value, SIM_DECIMALS), closest


def _centroid_shape(centroids: DataFrame) -> tuple[int, int]:
    k, dim = centroids.agg(F.count(F.lit(1)), F.max(F.size("centroid"))).first()
    if not k:
        raise ValueError("no centroids")
    return k, dim


def _collect_centroids(centroids: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    table = (
        centroids.select(
            F.col("cluster_id").cast("int").alias("cluster_id"),
            F.col("centroid").cast("array<double>").alias("centroid"),
        )
        .toArrow()
        .sort_by("cluster_id")
    )
    return table["cluster_id"].to_numpy().astype(np.int32), matrix(table["centroid"], dim)


def centroid_matrix(centroids: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Ascending ids and ``[k, D]`` matrix on the driver, refused beyond the broadcast limit."""
    k, dim = _centroid_shape(centroids)
    if k * dim * 8 > MAX_BROADCAST_BYTES:
        raise ValueError(f"{k} centroids of dimension {dim} exceed the broadcast limit")
    return _collect_centroids(centroids, dim)


def _centroid_parts(centroids: DataFrame, k: int, dim: int, max_broadcast_bytes: int) -> list:
    """Broadcast (ids, matrix) pairs in ascending ids, each within the limit.

    The driver collects and sends one part at a time; of the rest it holds the ids only.
    """
    sc = centroids.sparkSession.sparkContext
    each = max(1, max_broadcast_bytes // (dim * 8))
    if k <= each:
        return [sc.broadcast(_collect_centroids(centroids, dim))]
    ids = centroids.select(F.col("cluster_id").cast("int").alias("cluster_id")).toArrow()
    ids = np.sort(ids["cluster_id"].to_numpy())
    if np.any(ids[1:] == ids[:-1]):
        raise ValueError("cluster_id occurs more than once in the centroids")
    parts = []
    for at in range(0, k, each):
        first, last = int(ids[at]), int(ids[min(at + each, k) - 1])
        part = centroids.where(F.col("cluster_id").between(first, last))
        parts.append(sc.broadcast(_collect_centroids(part, dim)))
    return parts


def _in_turn(parts: list):
    """The value of each broadcast; of several, only one is held by the worker.

    Encrypted broadcasts reach a worker with their value and stay in its memory.
    """
    for part in parts:
        yield part.value
        if len(parts) > 1 and hasattr(part, "_path"):
            vars(part).pop("_value", None)


def nearest_of_parts(rows: np.ndarray, parts: list, score: str):
    """Id of the best centroid of each row over all ``parts`` and the score against it.

    Ids ascend from part to part, so that only a strictly closer centroid replaces
    the best so far: the result is that of one part.
    """
    cluster = np.zeros(len(rows), dtype=np.int32)
    value = np.zeros(len(rows))
    closest = np.full(len(rows), -np.inf)
    for ids, centroids in _in_turn(parts):
        pick, won, close = nearest(rows, centroids, score)
        better = np.flatnonzero(close > closest)
        cluster[better] = ids[pick[better]]
        value[better] = won[better]
        closest[better] = close[better]
    return cluster, value


def _assign_udf(parts: list, dim: int, score: str) -> Callable[[str], Column]:
    @F.arrow_udf(_ASSIGNMENT)
    def assign(vectors: pa.Array) -> pa.Array:
        present = ~vectors.is_null().to_numpy(zero_copy_only=False)
        cluster = np.zeros(len(vectors), dtype=np.int32)
        value = np.zeros(len(vectors))
        if present.any():
            rows = matrix(vectors.drop_null(), dim)
            cluster[present], value[present] = nearest_of_parts(rows, parts, score)
        return pa.StructArray.from_arrays(
            [pa.array(cluster, mask=~present), pa.array(value, mask=~present)],
            ["cluster_id", "score"],
        )

    # Filters on the result are not pushed below it, which would compute it twice.
    return assign.asNondeterministic()


def assign_nearest(
    vectors: DataFrame,
    centroids: DataFrame,
    score: str = "ip",
    vector_col: str = "embedding",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Add ``cluster_id`` and ``score`` of the nearest centroid.

    ``score='ip'`` takes the largest inner product, ``'l2'`` the smallest
    squared distance; rows without a vector get NULL. A narrow stage: vectors
    are never shuffled. Centroids beyond the limit are broadcast in parts of
    that size, which a worker loads from its local copy one after another, each
    row carrying its best so far.
    """
    _check_score(score)
    k, dim = _centroid_shape(centroids)
    assign = _assign_udf(_centroid_parts(centroids, k, dim, max_broadcast_bytes), dim, score)
    return (
        vectors.withColumn("_nearest", assign(vector_col))
        .withColumn("cluster_id", F.col("_nearest.cluster_id"))
        .withColumn("score", F.col("_nearest.score"))
        .drop("_nearest")
    )


def distance_to_centroid(
    assigned: DataFrame,
    sim_metric: str,
    spherical: bool,
    centroids: DataFrame | None = None,
    vector_col: str = "embedding",
) -> DataFrame:
    """Add ``dist`` in the metric of the run.

    Spherical clusters: 1 - inner product. Cosine without spherical training:
    1 - cosine similarity to the centroid (``centroids`` is joined in). L2: the
    squared distance. ``score`` must come from the matching assignment.
    """
    validate_metric(sim_metric, spherical)
    if sim_metric == "l2":
        return assigned.withColumn("dist", F.col("score"))
    if spherical:
        return assigned.withColumn("dist", F.round(cosine_distance("score"), SIM_DECIMALS))
    if centroids is None:
        raise ValueError("cosine distance to a non-unit centroid needs the centroids")
    return with_centroid_distance(assigned, centroids, "cosine", "dist", vector_col)


def with_centroid_distance(
    assigned: DataFrame,
    centroids: DataFrame,
    metric: str = "l2",
    output_col: str = "sq_dist",
    vector_col: str = "embedding",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Distance of each row to the centroid it already belongs to.

    ``metric='l2'`` is the squared distance, ``'cosine'`` is 1 - cosine
    similarity. A narrow stage, whatever the number of rows of a cluster;
    centroids beyond the limit are broadcast in parts, loaded one after another.
    Rows without a vector or of an unknown cluster get NULL.
    """
    if metric not in SIM_METRICS:
        raise ValueError(f"metric must be one of {SIM_METRICS}, got {metric!r}")
    k, dim = _centroid_shape(centroids)
    measure = _measure_udf(_centroid_parts(centroids, k, dim, max_broadcast_bytes), dim, metric)
    return assigned.withColumn(output_col, measure(vector_col, F.col("cluster_id").cast("int")))


def _distances(rows: np.ndarray, own: np.ndarray, metric: str) -> np.ndarray:
    """Distance of each row to the centroid at the same position."""
    if metric == "l2":
        return np.einsum("ij,ij->i", rows - own, rows - own)
    lengths = [
        np.maximum(np.sqrt(np.einsum("ij,ij->i", x, x)), COSINE_EPS) for x in (rows, own)
    ]
    return 1 - np.einsum("ij,ij->i", rows, own) / (lengths[0] * lengths[1])


def _measure_udf(parts: list, dim: int, metric: str):
    @F.arrow_udf("double")
    def measure(vectors: pa.Array, clusters: pa.Array) -> pa.Array:
        both = pc.and_(vectors.is_valid(), clusters.is_valid())
        rows = matrix(vectors.filter(both), dim)
        wanted = clusters.filter(both).to_numpy(zero_copy_only=False)
        found, seen = np.zeros(len(rows)), np.zeros(len(rows), dtype=bool)
        for ids, centroids in _in_turn(parts) if len(rows) else ():
            at = np.minimum(np.searchsorted(ids, wanted), len(ids) - 1)
            here = np.flatnonzero(ids[at] == wanted)
            found[here] = _distances(rows[here], centroids[at[here]], metric)
            seen[here] = True
        known = both.to_numpy(zero_copy_only=False).copy()
        out = np.zeros(len(vectors))
        out[known] = np.round(found, SIM_DECIMALS)
        known[known] = seen
        return pa.array(out, mask=~known)

    # Filters on the result are not pushed below it, which would compute it twice.
    return measure.asNondeterministic()


def assign_and_measure(
    vectors: DataFrame,
    centroids: DataFrame,
    sim_metric: str = "cosine",
    spherical: bool = True,
    vector_col: str = "embedding",
) -> DataFrame:
    """Assignment with the distance of the run's metric: ``cluster_id``, ``dist``.

    Spherical training searches by inner product, ordinary training by L2.
    """
    validate_metric(sim_metric, spherical)
    assigned = assign_nearest(vectors, centroids, "ip" if spherical else "l2", vector_col)
    return distance_to_centroid(assigned, sim_metric, spherical, centroids, vector_col).drop(
        "score"
    )


def label_centroids(
    vectors: DataFrame, label_col: str, vector_col: str = "embedding", spherical: bool = True
) -> DataFrame:
    """Mean vector of each given label, for runs whose clusters are known beforehand.

    One pass over the rows; the means are kept as a table.
    """
    means = vectors.groupBy(F.col(label_col).cast("int").alias("cluster_id")).agg(
        vector_to_array(Summarizer.mean(array_to_vector(vector_col))).alias("centroid")
    )
    if spherical:
        means = means.withColumn("centroid", l2_normalize("centroid"))
    return materialize(means, "centroids")


def valid_vectors(
    vectors: DataFrame, dim: int | None = None, vector_col: str = "embedding"
) -> DataFrame:
    """Rows that can be clustered: non-null, finite, non-zero, of dimension ``dim``."""
    return vectors.where(is_valid_vector(vector_col, dim))


def invalid_vectors(
    vectors: DataFrame, dim: int | None = None, vector_col: str = "embedding"
) -> DataFrame:
    """The rows :func:`valid_vectors` leaves out; a run keeps them in the corpus."""
    return vectors.where(~is_valid_vector(vector_col, dim))
