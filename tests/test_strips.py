"""Clusters of very many blocks: rows are stored once, not once for each block."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from neardup.operators.pairs import compare_within_clusters, max_prior_similarity
from neardup.operators.statistics import members_of, summary_of
from neardup.operators.strips import SENT_BLOCKS
from neardup.session import scratch_scope
from tests import brute
from tests.test_pairs import assert_prior, collected, members


def sample():
    """Few distinct lengths and directions, so that similarities tie, with far-apart copies."""
    rng = np.random.default_rng(41)
    base = rng.integers(-2, 3, size=(60, 3)) * rng.choice([0.5, 1.0, 2.0], size=(60, 1))
    vectors = np.concatenate([rng.normal(size=(200, 3)), base[rng.integers(0, 60, 140)]])
    vectors = vectors[rng.permutation(340)]
    order = [int(x) + 1 for x in rng.permutation(340)]
    return vectors, [0 if i % 9 else 1 for i in range(340)], order


@pytest.mark.parametrize("collapse", [True, False])
def test_rows_are_sent_a_few_times_at_most(spark, collapse):
    vectors, cluster, order = sample()
    rows = members(spark, vectors, cluster, order)
    want = brute.prior(vectors, order, cluster)
    with scratch_scope(spark):
        pairs = compare_within_clusters(
            rows, order=("rank",), eps_list=(0.3,), block_rows=40, collapse_copies=collapse
        )
        # Blocks of 40 rows: the larger cluster has some eight.
        assert pairs.sent.count() <= SENT_BLOCKS * 38
        assert_prior(collected(pairs.prior_similarity()), want)
        sums = sorted(members_of(pairs).collect())
        summary = summary_of(pairs).orderBy("cluster_id").collect()
        alone = compare_within_clusters(
            rows, order=("rank",), block_rows=40, collapse_copies=collapse, with_sums=False
        )
        assert_prior(collected(alone.prior_similarity()), want)
        assert all(r.n_compared == r.n_pairs for r in alone.compared_pairs().collect())
    plain = compare_within_clusters(rows, order=("rank",), eps_list=(0.3,), collapse_copies=collapse)
    for got, exact in ((sums, sorted(members_of(plain).collect())),
                       (summary, summary_of(plain).orderBy("cluster_id").collect())):
        assert len(got) == len(exact)
        for a, b in zip(got, exact):
            assert np.allclose(np.array(a, float), np.array(b, float), atol=1e-9)


def test_rows_that_repeat_whole_rows_at_the_end_of_a_block(spark):
    vectors = np.random.default_rng(43).normal(size=(30, 3))
    rows = members(spark, vectors)
    twice = rows.unionByName(rows.where("id % 3 = 0"))
    want = collected(max_prior_similarity(rows))
    for block_rows in (4, 5):
        got = max_prior_similarity(twice, block_rows=block_rows).collect()
        assert len(got) == 40
        assert all((r.max_sim, r.mate_id) == want[r.id] for r in got)


def test_several_columns_as_cluster_and_order(spark):
    vectors, cluster, order = sample()
    rows = members(spark, vectors, cluster, order).withColumns(
        {"lang": F.concat(F.lit("l"), F.col("cluster_id").cast("string")), "dist": F.col("rank") % 7}
    )
    args = {"by": ("lang", "cluster_id"), "order": ("dist", "id")}
    want = collected(max_prior_similarity(rows, **args))
    got = max_prior_similarity(rows, **args, block_rows=40)
    assert collected(got) == want
    assert got.columns == max_prior_similarity(rows, **args).columns


def test_bounds_that_leave_out_too_little_send_no_row_to_each_block(spark, monkeypatch):
    from neardup.operators import bounds, pairs

    monkeypatch.setattr(pairs, "BLOCK_ROWS", 16)
    monkeypatch.setattr(
        bounds.near_block_pairs, "__defaults__",
        tuple(16 if x == 16_384 else x for x in bounds.near_block_pairs.__defaults__),
    )
    rng = np.random.default_rng(44)
    vectors = rng.random((400, 8)) + 1
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = members(spark, vectors)
    found = compare_within_clusters(
        rows, order=("rank",), block_rows=8, with_sums=False, above=0.93
    )
    # 25 blocks of 16 rows, each of which every row must meet.
    assert found.sent.count() <= SENT_BLOCKS * 400
    want = collected(max_prior_similarity(rows))
    got = collected(found.prior_similarity())
    assert_prior(got, {i: w if w[0] > 0.93 else (0.0, None) for i, w in want.items()})
    assert found.compared_pairs().first().n_compared == 400 * 399 // 2


def test_the_corpus_and_its_copies_are_stored_compressed(spark, tmp_path, monkeypatch):
    from neardup.plans import table_queries

    monkeypatch.setattr(table_queries, "scratch_path", lambda _, name: f"{tmp_path}/{name}")
    texts = [f"{i} some words that come again and again " * 40 for i in range(300)]
    docs = spark.createDataFrame(
        [(i, t, "en", "web", len(t)) for i, t in enumerate(texts)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    docs.orderBy(F.desc("doc_id")).write.parquet(f"{tmp_path}/in/documents.parquet")
    rows = table_queries.pruned_corpus_lines(spark, f"{tmp_path}/in").collect()
    assert {r.eps for r in rows} == set(table_queries.LINE_EPS)
    for eps in table_queries.LINE_EPS:
        kept = sorted((r.line_no, r.doc_id) for r in rows if r.eps == eps)
        assert [n for n, _ in kept] == list(range(len(kept)))
        assert sorted(d for _, d in kept) == [d for _, d in kept]
    plain = sum(len(t) for t in texts)
    for name in ("corpus", "pruned"):
        files = [p for p in (tmp_path / name).rglob("part-*") if not p.name.startswith(".")]
        assert files and all(p.name.endswith(".txt.gz") for p in files)
        assert sum(p.stat().st_size for p in files) < plain / 2
