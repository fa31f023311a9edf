import numpy as np
import pytest
from pyspark.sql import functions as F

from neardup.config import PruneConfig, validate_metric
from neardup.functions.vectors import (
    cosine_similarity,
    dot,
    is_valid_vector,
    l2_normalize,
    pool_last_token,
    squared_l2,
)
from neardup.operators import assignment, kmeans, two_level

VECTORS = "/root/testdata/sf0.001/embeddings.parquet"


@pytest.fixture(scope="module")
def rows(spark):
    return spark.read.parquet(VECTORS).select(F.col("vec_id").alias("id"), "embedding", "label")


def test_metric_validation():
    validate_metric("cosine", True)
    validate_metric("l2", False)
    with pytest.raises(ValueError):
        validate_metric("dot", False)
    with pytest.raises(ValueError):
        validate_metric("l2", True)
    for bad in (
        {"sim_metric": "l1"},
        {"sim_metric": "l2", "spherical": True},
        {"which_to_keep": "none"},
        {"eps_list": ()},
        {"eps_list": (0.1,), "save_eps_list": (0.2,)},
        {"num_clusters": 0},
        {"largest_cluster_size_to_process": 0},
    ):
        with pytest.raises(ValueError):
            PruneConfig(**bad)


def test_vector_functions(spark):
    df = spark.createDataFrame(
        [([3.0, 4.0], [1.0, 0.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<double>"
    )
    got = df.select(
        dot("a", "b").alias("d"),
        squared_l2("a", "b").alias("q"),
        cosine_similarity("a", "b").alias("c"),
        l2_normalize("a").alias("n"),
        is_valid_vector("a").alias("ok"),
    ).collect()
    assert (got[0].d, got[0].q, got[0].c, got[0].n) == (3.0, 20.0, pytest.approx(0.6), [0.6, 0.8])
    assert (got[1].c, got[1].n, got[1].ok) == (0.0, [0.0, 0.0], False)


def test_invalid_vectors(spark):
    bad = [None, [], [0.0, 0.0], [float("nan"), 1.0], [float("inf"), 1.0], [1.0]]
    df = spark.createDataFrame([(v,) for v in bad + [[1.0, 2.0]]], "embedding array<double>")
    assert assignment.valid_vectors(df, dim=2).count() == 1
    assert assignment.invalid_vectors(df, dim=2).count() == len(bad)


def test_last_token(spark):
    df = spark.createDataFrame(
        [([[1.0], [2.0], [3.0]], [1, 1, 0]), ([[1.0]], [1]), ([], [])],
        "states array<array<float>>, mask array<int>",
    )
    got = df.select(pool_last_token("states", "mask").alias("m"), pool_last_token("states").alias("l"))
    assert [(r.m, r.l) for r in got.collect()] == [([2.0], [3.0]), ([1.0], [1.0]), (None, None)]


@pytest.mark.parametrize("score", ["ip", "l2"])
def test_block_join_equals_broadcast(rows, score):
    centroids = assignment.label_centroids(rows, "label", spherical=score == "ip")
    wide = assignment.assign_nearest(rows, centroids, score)
    tiny = assignment.assign_nearest(rows, centroids, score, max_broadcast_bytes=3 * 64 * 8)
    want = sorted(wide.select("id", "cluster_id", "score").collect())
    assert sorted(tiny.select("id", "cluster_id", "score").collect()) == want
    far = assignment.with_centroid_distance(tiny, centroids, max_broadcast_bytes=3 * 64 * 8)
    for narrow in (tiny, far):
        plan = narrow._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Join" not in plan


def test_parts_of_centroids_are_held_one_at_a_time(spark):
    class Part:
        _path = "local copy"

        def __init__(self, value):
            self.loaded, self.stored = 0, value

        @property
        def value(self):
            if not hasattr(self, "_value"):
                self.loaded, self._value = self.loaded + 1, self.stored
            return self._value

    parts = [Part((np.array([i]), np.eye(3)[[i]])) for i in range(3)]
    for _ in range(2):
        cluster, score = assignment.nearest_of_parts(np.eye(3)[[2, 0, 1, 1]], parts, "ip")
        assert cluster.tolist() == [2, 0, 1, 1] and score.tolist() == [1.0] * 4
    assert [p.loaded for p in parts] == [2, 2, 2]
    assert not any(hasattr(p, "_value") for p in parts)
    alone = [Part((np.arange(3), np.eye(3)))]
    for _ in range(2):
        assignment.nearest_of_parts(np.eye(3), alone, "l2")
    assert alone[0].loaded == 1


def test_a_centroid_id_given_twice_is_refused_by_parts(spark, rows):
    twice = spark.createDataFrame(
        [(1, [0.0] * 64), (1, [1.0] * 64), (2, [2.0] * 64)],
        "cluster_id int, centroid array<double>",
    )
    with pytest.raises(ValueError, match="more than once"):
        assignment.assign_nearest(rows, twice, max_broadcast_bytes=64 * 8)


def test_assignment_is_the_argmax_and_nulls_pass_through(spark, rows):
    centroids = assignment.label_centroids(rows, "label")
    with_null = rows.select("id", "embedding").union(
        spark.createDataFrame([(-1, None)], "id long, embedding array<float>")
    )
    got = assignment.assign_nearest(with_null, centroids).toPandas().set_index("id")
    ids, matrix = assignment.centroid_matrix(centroids)
    ip = np.stack(got.loc[0:, "embedding"].drop(-1, errors="ignore")) @ matrix.T
    assert (ids[ip.argmax(1)] == got.drop(-1).cluster_id).all()
    assert np.isnan(got.loc[-1].score)


def test_wrong_dimension_fails(spark, rows):
    centroids = assignment.label_centroids(rows, "label")
    bad = spark.createDataFrame([(1, [1.0, 2.0])], "id long, embedding array<double>")
    with pytest.raises(Exception, match="dimension"):
        assignment.assign_nearest(bad, centroids).collect()


def test_equal_centroids_go_to_the_lower_id(spark):
    centroids = spark.createDataFrame(
        [(7, [1.0, 0.0]), (3, [1.0, 0.0]), (5, [0.0, 1.0])], kmeans.CENTROID_SCHEMA
    )
    rows = spark.createDataFrame([(0, [2.0, 0.1])], "id long, embedding array<double>")
    for score in ("ip", "l2"):
        assert assignment.assign_nearest(rows, centroids, score).first().cluster_id == 3


def test_spherical_training(spark, rows, tmp_path):
    args = {"num_clusters": 5, "niter": 10, "seed": 7, "spherical": True}
    path = str(tmp_path / "model")
    model = kmeans.train_or_load_kmeans(rows, path, **args)
    centers = np.array(model.clusterCenters())
    assert np.allclose(np.linalg.norm(centers, axis=1), 1)
    again = kmeans.train_kmeans(rows, **args)
    assert np.allclose(centers, np.array(again.clusterCenters()))
    # Saved model wins over other parameters, unless asked not to.
    loaded = kmeans.train_or_load_kmeans(rows, path, num_clusters=2)
    assert np.array_equal(centers, np.array(loaded.clusterCenters()))
    fresh = kmeans.train_or_load_kmeans(rows, path, reuse=False, num_clusters=2, niter=2)
    assert len(fresh.clusterCenters()) == 2
    sampled = kmeans.train_kmeans(rows, train_fraction=0.5, **args)
    assert len(sampled.clusterCenters()) == 5


def test_lloyd_lowers_the_cost_and_keeps_empty_clusters(spark, rows):
    start = assignment.label_centroids(rows, "label", spherical=False)
    far = spark.createDataFrame([(99, [1000.0] * 64)], kmeans.CENTROID_SCHEMA)
    start = start.unionByName(far)
    costs = []
    for niter in (0, 1, 3):
        now = kmeans.lloyd(rows, start, niter)
        costs.append(
            assignment.assign_nearest(rows, now, "l2").agg(F.sum("score")).first()[0]
        )
    assert costs[0] > costs[1] > costs[2]
    assert now.where("cluster_id = 99").first().centroid == [1000.0] * 64


def test_distance_metrics(rows):
    centroids = assignment.label_centroids(rows, "label")
    spherical = assignment.assign_and_measure(rows, centroids, "cosine", True)
    plain = assignment.assign_and_measure(rows, centroids, "cosine", False)
    # Unit centroids and unit rows: both searches and both distances agree.
    a = {r.id: (r.cluster_id, r.dist) for r in spherical.collect()}
    b = {r.id: (r.cluster_id, r.dist) for r in plain.collect()}
    assert all(a[i][0] == b[i][0] and abs(a[i][1] - b[i][1]) < 1e-6 for i in a)
    l2 = assignment.assign_and_measure(rows, centroids, "l2", False).collect()
    assert all(abs(r.dist - 2 * a[r.id][1]) < 1e-5 for r in l2)


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_joined_distances_equal_the_broadcast_ones(spark, rows, metric):
    centroids = assignment.label_centroids(rows, "label", spherical=False)
    placed = rows.withColumnRenamed("label", "cluster_id").unionByName(
        spark.createDataFrame(
            [(-1, None, 3), (-2, [1.0] * 64, 77), (-3, [1.0] * 64, None), (-4, [0.0] * 64, 2)],
            "id long, embedding array<float>, cluster_id int",
        )
    )
    wide, joined = (
        assignment.with_centroid_distance(placed, centroids, metric, "d", max_broadcast_bytes=b)
        for b in (1 << 20, 10)
    )
    want = {r.id: r.d for r in joined.collect()}
    got = {r.id: r.d for r in wide.collect()}
    assert want.keys() == got.keys()
    assert [got[i] for i in (-1, -2, -3)] == [want[i] for i in (-1, -2, -3)] == [None] * 3
    assert all(abs(got[i] - want[i]) < 1e-11 for i in want if want[i] is not None)
    with pytest.raises(ValueError):
        assignment.with_centroid_distance(placed, centroids, "dot")


def test_one_tie_rule_however_centroids_are_cut(spark):
    """Centroids closer than the rounding tie, in one matrix and over blocks."""
    rng = np.random.default_rng(9)
    base = rng.normal(size=(5, 4))
    near = [base[i % 5] * (1 + (i // 5) * 2e-14) for i in range(20)]
    centroids = spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(near)],
        "cluster_id int, centroid array<double>",
    )
    rows = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 4)))],
        "id long, embedding array<double>",
    )
    for score in ("ip", "l2"):
        one = sorted(assignment.assign_nearest(rows, centroids, score).select("id", "cluster_id").collect())
        cut = assignment.assign_nearest(rows, centroids, score, max_broadcast_bytes=100)
        assert sorted(cut.select("id", "cluster_id").collect()) == one
        tied = sum(r.cluster_id < 5 for r in one)
        # Twins tie unless their values round apart; most do not.
        assert 200 < tied <= 300


def test_distances_by_parts_equal_those_by_one_broadcast(spark):
    rng = np.random.default_rng(10)
    centroids = spark.createDataFrame(
        [(i, [float(x) for x in c]) for i, c in enumerate(rng.normal(size=(4, 6)))],
        "cluster_id int, centroid array<double>",
    )
    rows = spark.createDataFrame(
        [(i, 0 if i % 3 else i % 5, [float(x) for x in v])
         for i, v in enumerate(rng.normal(size=(200, 6)))] + [(200, None, [0.0] * 6), (201, 1, None)],
        "id long, cluster_id int, embedding array<double>",
    )
    for metric in ("l2", "cosine"):
        one = assignment.with_centroid_distance(rows, centroids, metric).select("id", "sq_dist")
        cut = assignment.with_centroid_distance(
            rows, centroids, metric, max_broadcast_bytes=1
        ).select("id", "sq_dist")
        assert sorted(cut.collect(), key=str) == sorted(one.collect(), key=str)


def test_lloyd_goes_on_beyond_the_broadcast_limit(spark):
    rng = np.random.default_rng(11)
    rows = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(size=(300, 4)))],
        "id long, embedding array<double>",
    )
    start = rows.where("id < 12").select(
        F.col("id").cast("int").alias("cluster_id"), F.col("embedding").alias("centroid")
    )
    for spherical in (False, True):
        one = dict(kmeans.lloyd(rows, start, 2, spherical).collect())
        cut = dict(kmeans.lloyd(rows, start, 2, spherical, max_broadcast_bytes=100).collect())
        assert one.keys() == cut.keys()
        assert all(np.allclose(one[i], cut[i]) for i in one)


def _two_level_steps(rows, coarse, start, owner, niter, spherical):
    """The steps of a training in two levels, in NumPy."""
    def closest(x, c):
        return x @ c.T if spherical else x @ c.T - 0.5 * (c * c).sum(axis=1)

    centroids = start.copy()
    own = closest(rows, coarse).argmax(axis=1)
    for _ in range(niter):
        allowed = owner[None, :] == own[:, None]
        pick = np.where(allowed, closest(rows, centroids), -np.inf).argmax(axis=1)
        for c in set(pick):
            mean = rows[pick == c].mean(axis=0)
            centroids[c] = mean / np.linalg.norm(mean) if spherical else mean
    return centroids


@pytest.mark.parametrize("spherical", [False, True])
@pytest.mark.parametrize("max_bytes", [1 << 20, 8 * 4 * 3])
def test_training_in_two_levels(spark, spherical, max_bytes, monkeypatch):
    monkeypatch.setattr(two_level, "_HELD_SUMS", 2)
    rng = np.random.default_rng(5)
    values = rng.normal(size=(400, 4)) + np.repeat(rng.normal(size=(4, 4)) * 6, 100, axis=0)
    values[:130] = values[0]  # a third of all rows are one vector
    rows = spark.createDataFrame(
        [(i, [float(x) for x in v]) for i, v in enumerate(values)] + [(400, None)],
        "id long, embedding array<double>",
    )
    coarse = values[[150, 250, 350]]
    if spherical:
        coarse = coarse / np.linalg.norm(coarse, axis=1, keepdims=True)
    given = spark.createDataFrame(
        [(i * 7, [float(x) for x in c]) for i, c in enumerate(coarse)], kmeans.CENTROID_SCHEMA
    )

    def refined(niter):
        found = two_level.refine_clusters(
            rows, given, 20, niter, spherical=spherical, max_broadcast_bytes=max_bytes
        )
        found = sorted(found.collect())
        assert [r.cluster_id for r in found] == list(range(20))
        return np.array([r.centroid for r in found])

    start = refined(0)
    assert len(np.unique(start.round(9), axis=0)) == 20
    closest = start @ coarse.T if spherical else start @ coarse.T - 0.5 * (coarse**2).sum(axis=1)
    owner = closest.argmax(axis=1)
    assert (np.diff(owner) >= 0).all() and len(set(owner)) == 3
    want = _two_level_steps(values, coarse, start, owner, 3, spherical)
    assert np.allclose(refined(3), want)


def test_centroids_of_two_levels_are_dealt_by_size(spark):
    sizes = np.array([700, 200, 99, 1])
    assert two_level.shares(sizes, sizes, 10).tolist() == [6, 2, 1, 1]
    assert two_level.shares(sizes, np.array([2, 200, 99, 1]), 10).sum() == 10
    assert two_level.shares(sizes, np.array([1, 1, 1, 1]), 10).tolist() == [1, 1, 1, 1]
    few = spark.createDataFrame([(i, [1.0, i % 2.0]) for i in range(50)], "id long, embedding array<double>")
    assert two_level.train_two_level(few, 8, 2, 2).count() == 2
    with pytest.raises(ValueError, match="no vectors"):
        start = spark.createDataFrame([(0, [1.0, 0.0])], kmeans.CENTROID_SCHEMA)
        two_level.refine_clusters(few.where("id < 0"), start, 3, 1)
    with pytest.raises(ValueError, match="coarse_clusters"):
        PruneConfig(num_clusters=3, coarse_clusters=4)
