"""Training of very many clusters: coarse clusters first, then centroids inside each.

A plain step holds every row against all k centroids, and MLlib keeps them on the
driver. Here a row is held against the c coarse centroids and then against the
centroids of its own coarse cluster, some c + k / c in all. The centroids are a table
throughout: they go out in broadcast parts of a bounded size and come back as partial
sums, so that neither the driver nor a task holds all of them. Rows never move. Any
coarse cluster may hold most of the rows: its share of the centroids grows with it,
and no task works for one cluster.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from neardup.config import MAX_BROADCAST_BYTES, PruneConfig
from neardup.functions.vectors import l2_normalize
from neardup.operators.arrow_blocks import matrix
from neardup.operators.assignment import (
    _centroid_parts,
    _in_turn,
    assign_nearest,
    centroid_matrix,
    nearest,
)
from neardup.operators.kmeans import model_centroids, train_kmeans
from neardup.session import materialize

# Sums of at most this many centroids wait in a task before they are sent.
_HELD_SUMS = 8192
# First centroids are drawn from so many candidates for each, and so many more.
_DRAWN, _MORE = 4, 32


def shares(sizes: np.ndarray, most: np.ndarray, total: int) -> np.ndarray:
    """``total`` dealt out in proportion to ``sizes``: at least 1, at most ``most`` each."""
    ideal = total * sizes / sizes.sum()
    got = np.minimum(np.maximum(1, np.floor(ideal).astype(np.int64)), most)
    total = min(total, int(most.sum()))
    while got.sum() != total:
        short = got.sum() < total
        open_ = got < most if short else got > 1
        need = np.where(open_, ideal - got if short else got - ideal, -np.inf)
        if not open_.any():
            break
        got[np.argmax(need)] += 1 if short else -1
    return got


def _first_centroids(
    vectors: DataFrame, coarse: DataFrame, num_clusters: int, score: str, seed: int, vector_col: str
) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """Different rows of each coarse cluster as its first centroids, drawn by a hash.

    Also the coarse ids that have rows and the first number of each, both ascending.
    """
    spark = vectors.sparkSession
    placed = assign_nearest(vectors.select(vector_col), coarse, score, vector_col).select(
        F.col("cluster_id").alias("_coarse"),
        F.col(vector_col).cast("array<double>").alias("centroid"),
        F.xxhash64(F.lit(seed), vector_col).alias("_draw"),
    )
    # As many rows as there are coarse clusters.
    counted = (
        placed.groupBy("_coarse")
        .agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct("_draw", 0.02).alias("d"))
        .toArrow()
        .sort_by("_coarse")
    )
    found, n, different = (counted[c].to_numpy() for c in ("_coarse", "n", "d"))
    if not len(found):
        raise ValueError("no vectors to train on")
    got = shares(n, np.minimum(n, np.maximum(different, 1)), num_clusters)
    first = np.concatenate([[0], np.cumsum(got)[:-1]])
    part = np.minimum(1.0, (_DRAWN * got + _MORE) / np.maximum(different, 1))
    plan = spark.createDataFrame(
        [(int(c), int(g), int(f), float(p)) for c, g, f, p in zip(found, got, first, part)],
        "_coarse int, _got int, _first int, _part double",
    )
    drawn = F.col("_draw").cast("double") / F.lit(2.0**64) + F.lit(0.5) <= F.col("_part")
    # Equal vectors have equal draws and count once. The window sees candidates only,
    # some four for each centroid.
    candidates = (
        placed.join(F.broadcast(plan), "_coarse")
        .where(drawn)
        .groupBy("_coarse", "_draw")
        .agg(F.any_value("_got").alias("_got"), F.any_value("_first").alias("_first"),
             F.any_value("centroid").alias("centroid"))
    )
    place = F.row_number().over(Window.partitionBy("_coarse").orderBy("_draw"))
    chosen = (
        candidates.withColumn("_place", place)
        .where("_place <= _got")
        .select((F.col("_first") + F.col("_place") - 1).cast("int").alias("cluster_id"), "centroid")
    )
    return chosen, found, first


def _sums(cluster: np.ndarray, totals: np.ndarray, n: np.ndarray):
    """Sums and counts by cluster."""
    order = np.argsort(cluster, kind="stable")
    found, starts = np.unique(cluster[order], return_index=True)
    return (
        found,
        np.add.reduceat(totals[order], starts, axis=0),
        np.add.reduceat(n[order], starts),
    )


def _step_task(coarse_bc, first_bc, parts: list, score: str):
    """Per task: the nearest centroid within the coarse cluster of each row, summed up."""

    def pick(rows: np.ndarray) -> np.ndarray:
        (coarse_ids, coarse), (found, first) = coarse_bc.value, first_bc.value
        near, _, _ = nearest(rows, coarse, score)
        own = np.searchsorted(found, coarse_ids[near])
        cluster = np.zeros(len(rows), dtype=np.int32)
        closest = np.full(len(rows), -np.inf)
        by_own = np.argsort(own, kind="stable")
        groups, starts = np.unique(own[by_own], return_index=True)
        rows_of = np.split(by_own, starts[1:])
        for ids, centroids in _in_turn(parts):
            owner = np.searchsorted(first, ids, side="right") - 1
            for group, at in zip(groups, rows_of):
                a, b = np.searchsorted(owner, [group, group + 1])
                if a == b:
                    continue
                won, _, close = nearest(rows[at], centroids[a:b], score)
                better = close > closest[at]
                cluster[at[better]] = ids[a:b][won[better]]
                closest[at[better]] = close[better]
        return cluster

    def sent(held) -> pa.RecordBatch:
        found, totals, n = held
        return pa.RecordBatch.from_arrays(
            [
                pa.array(found, pa.int32()),
                pa.array(list(totals), pa.list_(pa.float64())),
                pa.array(n, pa.int64()),
            ],
            ["cluster_id", "total", "n"],
        )

    def run(batches):
        dim = coarse_bc.value[1].shape[1]
        held = None
        for batch in batches:
            rows = matrix(batch.column(0), dim)
            if not len(rows):
                continue
            new = _sums(pick(rows), rows, np.ones(len(rows), dtype=np.int64))
            if held is not None:
                new = _sums(*[np.concatenate(x) for x in zip(held, new)])
            held = new
            if len(held[0]) > _HELD_SUMS:
                yield sent(held)
                held = None
        if held is not None:
            yield sent(held)

    return run


def refine_clusters(
    vectors: DataFrame,
    coarse: DataFrame,
    num_clusters: int,
    niter: int,
    seed: int = PruneConfig.seed,
    spherical: bool = False,
    vector_col: str = "embedding",
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """``cluster_id, centroid`` of ``num_clusters`` centroids within given coarse clusters.

    Each coarse cluster gets centroids in proportion to its rows, at first different
    vectors of its own, which ``niter`` Lloyd steps move; a step compares a row with
    the centroids of its coarse cluster only. Rows whose vector is null are left out.
    Where there are fewer different vectors than centroids, fewer come back. Assign
    with :func:`neardup.operators.assignment.assign_nearest`, over all of them.
    """
    spark = vectors.sparkSession
    score = "ip" if spherical else "l2"
    rows = vectors.where(F.col(vector_col).isNotNull()).select(vector_col)
    centroids, found, first = _first_centroids(rows, coarse, num_clusters, score, seed, vector_col)
    if spherical:
        centroids = centroids.withColumn("centroid", l2_normalize("centroid"))
    centroids = materialize(centroids, "centroids")
    sc = spark.sparkContext
    coarse_bc = sc.broadcast(centroid_matrix(coarse))
    first_bc = sc.broadcast((found, first))
    dim = coarse_bc.value[1].shape[1]
    for _ in range(niter):
        parts = _centroid_parts(centroids, centroids.count(), dim, max_broadcast_bytes)
        sums = (
            rows.mapInArrow(
                _step_task(coarse_bc, first_bc, parts, score),
                "cluster_id int, total array<double>, n long",
            )
            .groupBy("cluster_id")
            .agg(
                vector_to_array(Summarizer.sum(array_to_vector("total"))).alias("_total"),
                F.sum("n").alias("_n"),
            )
        )
        moved = F.transform("_total", lambda x: x / F.col("_n"))
        if spherical:
            # A sum of length zero has no direction; the centroid stays.
            moved = F.when(F.exists("_total", lambda x: x != 0), l2_normalize("_total"))
        centroids = materialize(
            centroids.join(sums, "cluster_id", "left").select(
                "cluster_id", F.coalesce(moved, "centroid").alias("centroid")
            ),
            "centroids",
        )
        for part in parts:
            part.unpersist()
    return centroids


def train_two_level(
    vectors: DataFrame,
    num_clusters: int,
    niter: int,
    coarse_clusters: int | None = None,
    seed: int = PruneConfig.seed,
    spherical: bool = False,
    vector_col: str = "embedding",
    train_fraction: float = 1.0,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Coarse clusters by MLlib (the root of ``num_clusters`` by default), then their centroids."""
    if not 0 < train_fraction <= 1:
        raise ValueError("train_fraction must be in (0, 1]")
    if train_fraction < 1:
        vectors = vectors.sample(fraction=train_fraction, seed=seed)
    if coarse_clusters is None:
        coarse_clusters = max(2, math.ceil(math.sqrt(num_clusters)))
    if not 2 <= coarse_clusters <= num_clusters:
        raise ValueError("coarse_clusters must lie between 2 and num_clusters")
    model = train_kmeans(vectors, coarse_clusters, niter, seed, spherical, vector_col)
    coarse = model_centroids(vectors.sparkSession, model)
    return refine_clusters(
        vectors, coarse, num_clusters, niter, seed, spherical, vector_col, max_broadcast_bytes
    )
