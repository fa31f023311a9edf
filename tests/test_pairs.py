import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from neardup.operators.bounds import near_blocks
from neardup.operators.extraction import kept_ids, removed_ids, retained_ratio
from neardup.operators.pairs import compare_within_clusters, max_prior_similarity
from neardup.operators.pruning import (
    flag_duplicates,
    flags_by_bounds,
    least_threshold,
    prune_clusters,
)
from neardup.operators.statistics import member_similarity, members_of
from tests import brute

SCHEMA = "cluster_id int, id long, rank long, embedding array<double>"


def at_angles(*degrees):
    return [[math.cos(math.radians(d)), math.sin(math.radians(d))] for d in degrees]


def members(spark, vectors, cluster=None, order=None):
    n = len(vectors)
    cluster = cluster or [0] * n
    order = order or list(range(1, n + 1))
    return spark.createDataFrame(
        [(c, i, r, [float(x) for x in v]) for i, (v, c, r) in enumerate(zip(vectors, cluster, order))],
        SCHEMA,
    )


def collected(df):
    return {r.id: (r.max_sim, r.mate_id) for r in df.collect()}


def assert_prior(got, want):
    assert set(got) == set(want)
    for row, (sim, mate) in want.items():
        assert got[row][0] == pytest.approx(sim, abs=2e-12), row
        assert got[row][1] == mate, row


@pytest.mark.parametrize("block_rows", [1, 2, 4096])
def test_golden_angles(spark, block_rows):
    rows = members(spark, at_angles(0, 10, 20, 90))
    got = max_prior_similarity(rows, block_rows=block_rows)
    by_id = {r.id: r for r in got.collect()}
    assert [round(by_id[i].max_sim, 6) for i in range(4)] == [0, 0.984808, 0.984808, 0.342020]
    assert [by_id[i].mate_rank for i in range(4)] == [None, 1, 2, 3]
    # 20 degrees goes although its only near neighbour goes too.
    removed = {r.id for r in removed_ids(got, [0.02]).collect()}
    assert removed == {1, 2}
    backwards = members(spark, at_angles(0, 10, 20, 90), order=[4, 3, 2, 1])
    got = max_prior_similarity(backwards, block_rows=block_rows)
    assert {r.id for r in removed_ids(got, [0.02]).collect()} == {0, 1}


def test_opposite_vectors_floor_at_zero(spark):
    got = collected(max_prior_similarity(members(spark, at_angles(0, 180))))
    assert got == {0: (0.0, None), 1: (0.0, None)}


def test_threshold_is_strict(spark):
    rows = members(spark, [[1.0, 0.0], [0.5, 0.0]])
    flagged = flag_duplicates(max_prior_similarity(rows), [0.5, 0.6]).where("is_dup")
    assert [(r.id, r.eps) for r in flagged.collect()] == [(1, 0.6)]


def test_rows_without_vector_and_singletons_are_kept(spark):
    rows = spark.createDataFrame(
        [(0, 0, 1, [1.0, 0.0]), (0, 1, 2, None), (0, 2, 3, [1.0, 0.0]), (1, 3, 1, [0.0, 2.0])],
        SCHEMA,
    )
    assert collected(max_prior_similarity(rows)) == {
        0: (0.0, None), 1: (0.0, None), 2: (1.0, 0), 3: (0.0, None),
    }


def test_mixed_dimensions_fail(spark):
    rows = members(spark, [[1.0, 0.0], [1.0, 0.0, 0.0]])
    with pytest.raises(Exception, match="different dimensions"):
        max_prior_similarity(rows).collect()


@pytest.mark.parametrize("collapse", [True, False])
@pytest.mark.parametrize("block_rows", [7, 4096])
def test_copies_of_unequal_lengths_in_shuffled_order(spark, collapse, block_rows):
    """Copies far apart, with longer vectors between them: a copy is not its own best mate."""
    rng = np.random.default_rng(3)
    base = rng.normal(size=(12, 3)) * rng.uniform(0.2, 3, size=(12, 1))
    vectors = [base[i] for i in rng.integers(0, 12, 90)]
    order = [int(x) + 1 for x in rng.permutation(90)]
    cluster = [int(x) for x in rng.integers(0, 3, 90)]
    rows = members(spark, vectors, cluster, order)
    got = max_prior_similarity(rows, block_rows=block_rows, collapse_copies=collapse)
    assert_prior(collected(got), brute.prior(vectors, order, cluster))


def test_composite_order(spark):
    vectors = at_angles(5, 0, 3, 2, 40, 41)
    dist = [0.2, 0.1, 0.1, 0.2, 0.1, 0.3]
    rows = members(spark, vectors).withColumn(
        "dist", F.element_at(F.array(*[F.lit(d) for d in dist]), (F.col("id") + 1).cast("int"))
    )
    got = max_prior_similarity(rows, order=("dist", "id"), block_rows=2)
    order = [(d, i) for i, d in enumerate(dist)]
    assert_prior(collected(got), brute.prior(vectors, order, [0] * 6))


@settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(data=st.data())
def test_any_small_input_matches_brute_force(spark, data):
    grid = st.tuples(*[st.integers(-2, 2)] * 2).map(lambda v: [float(x) for x in v])
    vectors = data.draw(st.lists(grid, min_size=1, max_size=25))
    n = len(vectors)
    order = [x + 1 for x in data.draw(st.permutations(range(n)))]
    cluster = data.draw(st.lists(st.integers(0, 1), min_size=n, max_size=n))
    block_rows = data.draw(st.sampled_from([1, 3, 100]))
    got = max_prior_similarity(members(spark, vectors, cluster, order), block_rows=block_rows)
    assert_prior(collected(got), brute.prior(vectors, order, cluster))


def test_result_does_not_depend_on_blocks_or_partitions(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 16))
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    vectors = np.concatenate([vectors, vectors[:60]])
    rows = members(spark, vectors.tolist())
    want = collected(max_prior_similarity(rows))
    for block_rows, partitions in ((17, 1), (64, 13), (1000, 3)):
        again = max_prior_similarity(rows.repartition(partitions), block_rows=block_rows)
        assert collected(again) == want


def test_one_hot_vector_with_a_third_of_all_rows(spark):
    """Copies merge before the pair join: three distinct vectors, one row per block."""
    n = 3000
    rows = spark.range(n).select(
        F.lit(0).alias("cluster_id"),
        "id",
        (F.col("id") + 1).alias("rank"),
        F.when(F.col("id") % 3 == 0, F.array(F.lit(1.0), F.lit(0.0)))
        .otherwise(F.array(F.cos(F.col("id").cast("double")), F.sin(F.col("id").cast("double"))))
        .alias("embedding"),
    )
    got = max_prior_similarity(rows, block_rows=256)
    local = rows.orderBy("id").toPandas()
    want = brute.prior(local.embedding.tolist(), local["rank"].tolist(), [0] * n)
    got = {r.id: r.max_sim for r in got.collect()}
    assert all(abs(got[i] - want[i][0]) < 1e-11 for i in range(n))
    assert got[0] == 0.0 and got[3] == 1.0


def test_planted_copies_are_found_once(spark):
    path = "/root/testdata/sf0.001/embeddings.parquet"
    base = spark.read.parquet(path).select(
        F.col("label").alias("cluster_id"), F.col("vec_id").alias("id"), "embedding"
    )
    copies = base.withColumn("id", F.col("id") + 1_000_000)
    prior = max_prior_similarity(base.union(copies), order=("id",))
    flagged = flag_duplicates(prior, [0.01]).where("is_dup")
    assert flagged.where("id < 1000000").count() == 0
    assert flagged.where("mate_id = id - 1000000").count() == base.count()


def test_kept_and_removed_partition_the_rows(spark):
    path = "/root/testdata/sf0.001/embeddings.parquet"
    rows = spark.read.parquet(path).select(
        F.col("label").alias("cluster_id"), F.col("vec_id").alias("id"), "embedding"
    )
    eps = [0.6, 0.7, 0.8]
    prior = max_prior_similarity(rows, order=("id",)).cache()
    kept = {(r.eps, r.id) for r in kept_ids(prior, eps).collect()}
    removed = {(r.eps, r.id) for r in removed_ids(prior, eps).collect()}
    every = {(e, r.id) for e in eps for r in rows.select("id").collect()}
    assert removed and not kept & removed and kept | removed == every
    pct = [r.retained_pct for r in retained_ratio(prior, eps).orderBy("eps").collect()]
    assert pct == sorted(pct, reverse=True)
    prior.unpersist()


def test_chunks_remove_no_more_than_the_whole_cluster(spark):
    path = "/root/testdata/sf0.001/embeddings.parquet"
    rows = spark.read.parquet(path).select(
        F.lit(0).alias("cluster_id"), F.col("vec_id").alias("id"),
        (F.col("vec_id") + 1).alias("rank"), "embedding",
    )
    whole = {r.id for r in removed_ids(prune_clusters(rows), [0.7]).collect()}
    cut = {r.id for r in removed_ids(prune_clusters(rows, limit=60), [0.7]).collect()}
    assert cut and cut < whole


def test_hot_copies_are_salted(spark):
    """The shape of a large run: no automatic broadcasts, and a vector with a third of all rows."""
    n = 4000
    rng = np.random.default_rng(8)
    vectors = rng.normal(size=(n, 4))
    vectors[::3] = vectors[0]
    rows = members(spark, vectors.tolist(), [int(i % 5 == 0) for i in range(n)])
    rows = rows.withColumn("dist", F.lit(0.0))
    want = collected(max_prior_similarity(rows, block_rows=500))
    want_stats = sorted(member_similarity(rows).collect())
    broadcasts = (
        "spark.sql.autoBroadcastJoinThreshold",
        "spark.sql.adaptive.autoBroadcastJoinThreshold",
    )
    for name in broadcasts:
        spark.conf.set(name, "-1")
    try:
        pairs = compare_within_clusters(rows, order=("rank",), block_rows=500, hot_copies=100)
        salts = {r._salts for r in pairs.hot.collect()}
        joined = pairs.prior_similarity()
        rows_seen = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        stats = sorted(members_of(pairs).collect())
    finally:
        for name in broadcasts:
            spark.conf.unset(name)
    assert salts == {3, 11}
    assert {r.id: (r.max_sim, r.mate_id) for r in rows_seen} == want
    assert "_salt" in plan and "SortMergeJoin" in plan
    for a, b in zip(stats, want_stats):
        assert a[:2] == b[:2] and np.allclose(a[2:], b[2:])


@pytest.mark.parametrize("bad", [[float("nan"), 1.0], [float("inf"), 0.0], None])
def test_vectors_that_are_not_finite_leave_the_others_alone(spark, bad):
    rows = [(0, 0, [1.0, 0.0]), (0, 1, [1.0, 0.0]), (0, 2, bad), (0, 3, [0.6, 0.8]), (0, 4, bad)]
    table = spark.createDataFrame(rows, "cluster_id int, id long, embedding array<double>")
    got = {r.id: r.max_sim for r in max_prior_similarity(table, order=("id",)).collect()}
    assert got == {0: 0.0, 1: 1.0, 2: 0.0, 3: 0.6, 4: 0.0}


def test_group_size_agrees_with_the_flag_at_the_threshold(spark):
    s = 0.93
    rows = [(0, 0, [1.0, 0.0]), (0, 1, [s, (1 - s * s) ** 0.5])]
    table = spark.createDataFrame(rows, "cluster_id int, id long, embedding array<double>")
    pairs = compare_within_clusters(table, order=("id",), eps_list=(0.07,))
    over = {r._id: r._over0 for r in pairs.with_reductions(["_over0"]).collect()}
    prior = {r.id: r.max_sim for r in pairs.prior_similarity().collect()}
    assert over == {0: 1, 1: 1} and prior[1] > 1 - 0.07


@pytest.mark.parametrize("copies", [0, 3])
def test_vectors_move_once(spark, copies):
    """Copies are found on narrow rows; only the shuffle to the block pairs carries vectors."""
    draw = np.random.default_rng(3)
    vectors = draw.normal(size=(40, 4))
    vectors[5 : 5 + copies] = vectors[0]
    rows = members(spark, vectors.tolist(), cluster=[i % 2 for i in range(40)])
    pairs = compare_within_clusters(rows, order=("rank",), block_rows=8, with_sums=False)
    plan = pairs.vectors._jdf.queryExecution().executedPlan().toString()
    lines = [x for x in plan.split("\n") if "Exchange hashpartitioning" in x or "REPARTITION" in x]
    assert len([x for x in lines if "REPARTITION_BY_NUM" in x]) == 1
    assert "any_value" not in plan and "_v" not in "".join(
        x for x in plan.split("\n") if "SortAggregate" in x
    )
    order = list(range(40))
    want = brute.prior(vectors, order, [i % 2 for i in range(40)])
    assert_prior(collected(pairs.prior_similarity()), want)


def test_rows_that_repeat_whole_rows_are_no_copies_of_themselves(spark):
    rows = members(spark, at_angles(0, 10, 20))
    twice = rows.unionByName(rows.where("id = 1"))
    got = sorted((r.id, round(r.max_sim, 6)) for r in max_prior_similarity(twice).collect())
    assert got == [(0, 0.0), (1, 0.984808), (1, 0.984808), (2, 0.984808)]


# --- bounds ----------------------------------------------------------------


def clumps(rng, n, clumps, dim=16, spread=0.05):
    """Unit vectors around a few directions, and copies of some of them."""
    middle = rng.normal(size=(clumps, dim))
    v = middle[rng.integers(0, clumps, n)] + spread * rng.normal(size=(n, dim)) * rng.random((n, 1))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[n // 2 : n // 2 + n // 10] = v[: n // 10]
    return v


@pytest.mark.parametrize("lengths", [False, True])
def test_bounds_leave_out_pairs_and_lose_none(spark, lengths):
    rng = np.random.default_rng(21)
    vectors = clumps(rng, 1500, 12)
    if lengths:
        vectors = vectors * rng.uniform(0.8, 1.3, size=(len(vectors), 1))
    cluster = [0 if i % 10 else i % 7 for i in range(1500)]
    rows = members(spark, vectors, cluster, rng.permutation(1500).tolist())
    eps = (0.01, 0.03, 0.07)
    full = max_prior_similarity(rows, block_rows=64)
    want = {r.id: r for r in full.collect()}
    pairs = compare_within_clusters(
        rows, order=("rank",), block_rows=64, with_sums=False, above=0.93, cells=40
    )
    got = {r.id: r for r in pairs.prior_similarity().collect()}
    assert got.keys() == want.keys()
    for i, w in want.items():
        if w.max_sim > 0.93:
            assert got[i].max_sim == pytest.approx(w.max_sim, abs=2e-12)
            assert (got[i].mate_id, got[i].mate_rank) == (w.mate_id, w.mate_rank)
        else:
            assert got[i][1:] == (i, 0.0, None, None)
    assert sum(w.max_sim > 0.93 for w in want.values()) > 700
    flags = sorted(flag_duplicates(full, eps).select("id", "eps", "is_dup").collect())
    by_bounds = flags_by_bounds(rows, eps, block_rows=64).select("id", "eps", "is_dup")
    assert sorted(by_bounds.collect()) == flags
    hot = pairs.compared_pairs().where("cluster_id = 0").first()
    assert hot.n_pairs > 700_000
    # Twelve clumps: about a twelfth of the pairs is near.
    assert hot.n_compared < (0.7 if lengths else 0.35) * hot.n_pairs
    plain = compare_within_clusters(rows, order=("rank",), block_rows=64, with_sums=False)
    assert all(r.n_compared == r.n_pairs for r in plain.compared_pairs().collect())


def test_bounds_of_vectors_without_clumps_zero_and_copies(spark):
    rng = np.random.default_rng(22)
    vectors = rng.normal(size=(300, 3)) * rng.choice([0, 1, 5], size=(300, 1))
    vectors[200:] = vectors[17]
    rows = members(spark, vectors, [i % 2 for i in range(300)])
    for above in (0.0, 0.5, 24.9):
        want = collected(max_prior_similarity(rows))
        got = collected(max_prior_similarity(rows, block_rows=8, above=above))
        assert_prior(got, {i: w if w[0] > above else (0.0, None) for i, w in want.items()})
    empty = rows.limit(0)
    assert max_prior_similarity(empty, above=0.5).collect() == []
    with pytest.raises(ValueError, match="threshold"):
        compare_within_clusters(rows, order=("rank",), above=0.5)
    assert least_threshold([0.01, 1.5]) is None and least_threshold([0.25, 0.5]) == 0.5


def test_pivots_that_do_not_fit_leave_blocks_by_hash(spark):
    rows = members(spark, clumps(np.random.default_rng(23), 100, 4))
    distinct = rows.selectExpr(
        "cluster_id", "embedding as _v", "xxhash64(embedding) as _f1", "id as _f2"
    )
    sizes = rows.groupBy("cluster_id").agg(F.count("id").alias("_vectors"))
    args = (distinct, sizes, 1, ["cluster_id"], 10, 0.9)
    assert near_blocks(*args, max_bytes=16 * 8) is None
    assert near_blocks(*args, max_bytes=4 * 16 * 8).select("_b").distinct().count() >= 10


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bounds_that_leave_out_nothing_do_not_repeat_rows(spark):
    """Vectors without clumps, in blocks of which each row must meet nearly all."""
    rng = np.random.default_rng(24)
    vectors = rng.random((1200, 32)) + 1
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = members(spark, vectors)
    args = {"order": ("rank",), "block_rows": 16, "with_sums": False}
    pairs = compare_within_clusters(rows, **args, above=0.93)
    assert pairs.sent.count() <= 16 * 1200
    # 75 blocks of 16 rows would be run as 2,850 tasks.
    assert "REPARTITION_BY_NUM" in plan_of(pairs.vectors)
    assert "2850)" not in plan_of(pairs.vectors)
    want = collected(max_prior_similarity(rows))
    got = collected(pairs.prior_similarity())
    assert_prior(got, {i: w if w[0] > 0.93 else (0.0, None) for i, w in want.items()})
    assert sum(w[0] > 0.93 for w in want.values()) > 1000
