import numpy as np
import pytest
from pyspark.sql import functions as F

from neardup.operators.ranking import (
    chunk_of_rank,
    rank_within_cluster,
    split_into_chunks,
    with_order_keys,
)
from neardup.operators.skew import hot_keys, salted_left_join


def frame(spark, rows):
    return spark.createDataFrame(rows, "cluster_id int, id long, dist double")


@pytest.mark.parametrize(
    "rule, keep_hard, want",
    [
        ("hard", True, [3, 1, 2, 0]),
        ("hard", False, [0, 1, 2, 3]),
        ("easy", True, [0, 2, 1, 3]),
        ("easy", False, [3, 2, 1, 0]),
        ("HARD", True, [3, 1, 2, 0]),
    ],
)
def test_orders_and_ties(spark, rule, keep_hard, want):
    rows = frame(spark, [(0, 0, 0.1), (0, 1, 0.2), (0, 2, 0.2), (0, 3, 0.4)])
    ranked = rank_within_cluster(rows, keep_hard, rule)
    assert [r.id for r in ranked.orderBy("rank").collect()] == want
    keyed = with_order_keys(rows, rule, keep_hard)
    assert [r.id for r in keyed.orderBy("order_0", "order_1").collect()] == want


def test_random_order_depends_on_the_seed_only(spark):
    rows = frame(spark, [(0, i, 0.0) for i in range(50)])

    def order(seed, df):
        ranked = rank_within_cluster(df, which_to_keep="random", seed=seed)
        return [r.id for r in ranked.orderBy("rank").collect()]

    assert order(1, rows) == order(1, rows.repartition(5)) != order(2, rows)
    keyed = with_order_keys(rows, "random", seed=1).orderBy("order_0", "order_1")
    assert [r.id for r in keyed.collect()] == order(1, rows)


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        rank_within_cluster(frame(spark, [(0, 0, 0.1)]), which_to_keep="hardest")


@pytest.mark.parametrize("rule", ["hard", "easy", "random"])
def test_range_sorted_ranks_equal_the_window(spark, rule):
    """One cluster with most rows, many ties in it, and some small clusters."""
    rows = spark.range(5000).select(
        F.when(F.col("id") % 5 == 0, F.col("id") % 7).otherwise(100).cast("int").alias("cluster_id"),
        "id",
        F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.sin("id")).alias("dist"),
    )
    window = rank_within_cluster(rows, which_to_keep=rule)
    ranged = rank_within_cluster(rows, which_to_keep=rule, max_window_rows=100)
    columns = ["cluster_id", "id", "rank"]
    assert sorted(ranged.columns) == sorted(window.columns)
    assert sorted(ranged.select(columns).collect()) == sorted(window.select(columns).collect())


def test_chunk_boundaries_equal_floating_linspace(spark):
    cases = [(n, limit) for n in range(1, 80) for limit in range(1, n + 2)]
    cases += [(4999, 7), (5000, 3), (3001, 13)]
    sizes = spark.createDataFrame(cases, "n long, lim long")
    ranks = sizes.withColumn("rank", F.explode(F.sequence(F.lit(1).cast("long"), "n")))
    chunk = chunk_of_rank(F.col("rank"), F.col("n"), F.col("lim"))
    got = ranks.select("n", "lim", "rank", chunk.alias("chunk")).toPandas()
    for (n, limit), part in got.groupby(["n", "lim"]):
        edges = np.linspace(0, n, -(-n // limit) + 1, dtype=np.int64)
        want = np.searchsorted(edges, np.arange(n), side="right") - 1
        assert part.sort_values("rank").chunk.tolist() == want.tolist(), (n, limit)


def test_chunk_limits(spark):
    rows = spark.createDataFrame([(0, r) for r in range(1, 12)], "cluster_id int, rank long")
    for limit, chunks in ((11, 1), (10, 2), (4, 3), (1, 11)):
        sizes = split_into_chunks(rows, limit).groupBy("chunk").count().collect()
        assert len(sizes) == chunks and max(r["count"] for r in sizes) <= limit
    with pytest.raises(ValueError):
        split_into_chunks(rows, 0)


def test_salted_join_equals_the_plain_join(spark):
    left = spark.range(2000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 50).alias("k")
    )
    left = left.withColumn("k", F.when(F.col("id") % 11 != 0, F.col("k")))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    hot = hot_keys(left.where("k is not null"), ["k"], 100)
    assert [(r.k, r._salts) for r in hot.collect()] == [(7, 7)]
    got = salted_left_join(left, right, ["k"], hot, "id").select("id", "k", "v")
    assert sorted(got.collect(), key=lambda r: r.id) == sorted(
        left.join(right, "k", "left").select("id", "k", "v").collect(), key=lambda r: r.id
    )
    assert hot_keys(left, ["k"], 5000) is None
