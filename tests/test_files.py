import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from neardup import sinks, sources
from neardup.config import PruneConfig
from neardup.operators import bitmaps, extraction, pairs, pruning
from neardup.operators.ranking import rank_within_cluster
from neardup.plans import prune_corpus, prune_vectors
from neardup.plans.prune import compare_members, prune_rows, prune_table, write_kept_lines


def test_raw_vectors_and_ids(spark, tmp_path):
    values = np.arange(12, dtype=np.float32).reshape(3, 4) / 7
    values.tofile(tmp_path / "raw.npy")
    got = sources.read_raw_vectors(spark, str(tmp_path / "raw.npy"), 4).orderBy("id").collect()
    assert [r.id for r in got] == [0, 1, 2]
    assert np.array_equal(np.array([r.embedding for r in got], dtype=np.float32), values)
    np.array([b"a/1.jpg", b"b/22.jpg"], dtype="S24").tofile(tmp_path / "ids")
    ids = sources.read_fixed_width_ids(spark, str(tmp_path / "ids"), 24).orderBy("id").collect()
    assert [(r.id, r.path) for r in ids] == [(0, "a/1.jpg"), (1, "b/22.jpg")]


@pytest.mark.parametrize("run_bytes", [1, 100, 1 << 20])
def test_raw_records_of_several_files_are_numbered_by_place(spark, tmp_path, monkeypatch, run_bytes):
    monkeypatch.setattr("neardup.sources.vectors.RUN_BYTES", run_bytes)
    values = np.arange(4000, dtype=np.float32).reshape(1000, 4)
    for name, rows in (("b", values[700:]), ("a", values[:700]), ("ab", values[:0]), ("_x", values)):
        rows.tofile(tmp_path / name)
    found = sources.read_raw_vectors(spark, str(tmp_path), 4)
    got = {r.id: r.embedding for r in found.collect()}
    assert sorted(got) == list(range(1000)) and all(got[i] == values[i].tolist() for i in got)
    ids = sources.read_fixed_width_ids(spark, str(tmp_path / "[a]"), 16).count()
    assert ids == 700
    (tmp_path / "b").write_bytes(b"12345")
    with pytest.raises(ValueError, match="no records"):
        sources.read_raw_vectors(spark, str(tmp_path), 4)
    with pytest.raises(FileNotFoundError):
        sources.read_raw_vectors(spark, str(tmp_path / "none"), 4)
    (tmp_path / "empty").write_bytes(b"")
    assert sources.read_raw_vectors(spark, str(tmp_path / "empty"), 4).count() == 0


def test_corpus_lines_across_splits(spark, tmp_path):
    folder = tmp_path / "corpus"
    folder.mkdir()
    lines, rng = [], np.random.default_rng(0)
    for part in range(3):
        own = [json.dumps({"n": len(lines) + i, "t": "x" * int(rng.integers(0, 90))}) for i in range(400)]
        own[17] = ""
        (folder / f"part-{part}.jsonl").write_text("\n".join(own) + "\n")
        lines += own
    limit = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(limit)
    spark.conf.set(limit, "4096")
    try:
        corpus = sources.read_corpus(spark, str(folder), split_bytes=4096)
        assert corpus.rdd.getNumPartitions() > 3
        got = sorted((r.line_no, r.value) for r in corpus.collect())
    finally:
        spark.conf.set(limit, before)
    assert got == list(enumerate(lines))


def test_ratio_label_rounds_like_the_binary_value(spark):
    values = [n / 1000 for n in range(1001)] + [0.125, 0.375, 0.565, 0.545]
    df = spark.createDataFrame([(v * 100,) for v in values], "pct double")
    got = [r[0] for r in df.select(extraction.ratio_label("pct")).collect()]
    assert got == [f"{(v * 100) / 100:.2f}" for v in values]


def test_kept_round_trip_reads_one_folder(spark, tmp_path):
    eps = [0.01, 0.015, 0.1]
    prior = spark.createDataFrame([(1, 0.0), (2, 0.95), (3, 0.988)], "id long, max_sim double")
    path = str(tmp_path / "kept")
    sinks.write_kept(extraction.kept_ids(prior, eps), path, eps)
    for e, want in ((0.01, {1, 2, 3}), (0.015, {1, 2}), (0.1, {1})):
        kept = sources.read_kept(spark, path, e)
        assert {r.id for r in kept.collect()} == want
        assert {r.eps for r in kept.collect()} == {e}
    plan = sources.read_kept(spark, path, 0.01)._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(eps" in plan


def test_bucketed_folders(spark, tmp_path):
    """Many clusters share a folder; a large one still spreads over several files."""
    cluster = F.when(F.col("id") < 2000, F.lit(5)).otherwise(F.col("id") % 40)
    rows = spark.range(3000).select(
        "id",
        cluster.cast("int").alias("cluster_id"),
        F.col("id").cast("double").alias("dist"),
    )
    ranked = rank_within_cluster(rows)
    path = str(tmp_path / "sorted")
    # At this size adaptive execution would join the ranges into one file.
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")
    try:
        sinks.write_sorted_clusters(ranked, path, buckets=4)
    finally:
        spark.conf.unset(coalesce)
    assert len(list((tmp_path / "sorted").glob("cluster_bucket=*"))) == 4
    files = spark.read.parquet(path).where("cluster_id = 5").select(F.input_file_name()).distinct()
    assert files.count() > 1
    back = sources.read_sorted_clusters(spark, path, 5, 5).drop("cluster_bucket")
    want = ranked.where("cluster_id = 5").select(back.columns)
    assert sorted(back.collect()) == sorted(want.collect())


def test_an_id_in_several_clusters_is_kept_once(spark):
    prior = spark.createDataFrame(
        [(0, 1, 0.99), (1, 1, 0.0), (1, 2, 0.99)], "cluster_id int, id long, max_sim double"
    )
    assert [r.id for r in extraction.kept_ids(prior, [0.05]).collect()] == [1]
    assert {r.id for r in extraction.removed_ids(prior, [0.05]).collect()} == {1, 2}
    assert extraction.retained_ratio(prior, [0.05]).first().retained_pct == 50.0
    assert extraction.retained_ratio(prior, [0.05], 10).first().retained_pct == 10.0


def test_unique_ids(spark):
    rows = spark.createDataFrame([(0, 1), (1, 1)], "cluster_id int, id long")
    pruning.assert_unique_ids(rows)
    with pytest.raises(ValueError, match="more than once"):
        pruning.assert_unique_ids(rows.union(rows.limit(1)))


def _run_inputs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select(
        F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    copies = docs.withColumn("id", F.col("id") + 500)
    odd = spark.createDataFrame(
        [(1000, None), (1001, [0.0] * 64)], "id long, embedding array<double>"
    )
    return docs.union(copies).union(odd)


@pytest.mark.parametrize("limit", [None, 40])
def test_whole_run_on_files(spark, tmp_path, limit):
    vectors = _run_inputs(spark)
    corpus_file = tmp_path / "corpus.jsonl"
    lines = [json.dumps({"b": i, "a": "é" * (i % 3)}, ensure_ascii=False) for i in range(1002)]
    corpus_file.write_text("\n".join(lines) + "\n", encoding="utf-8")
    out = str(tmp_path / "out")
    config = PruneConfig(
        num_clusters=6, niter=5, eps_list=(0.01, 0.7), save_eps_list=(0.01, 0.7),
        largest_cluster_size_to_process=limit,
    )
    named = vectors.withColumn("path", F.concat(F.lit("doc-"), "id"))
    result = prune_vectors(named, out, config, cluster_batches=2, with_stats=True)
    table = result["prune_table"].toPandas().set_index("id").sort_index()
    assert len(table) == 1000
    assert (table[table["rank"] == 1].max_sim == 0).all()
    assert table["eps=0.7"].sum() > table["eps=0.01"].sum()
    if limit is None:
        # A copy ranks right behind its original, which has the lower id.
        copies = table.loc[500:]
        assert copies["eps=0.01"].all() and not table.loc[:499, "eps=0.01"].any()
        assert (copies.mate_id == copies.index - 500).all()
        assert (table.loc[copies.mate_id, "rank"].to_numpy() == copies.mate_rank).all()
    sorted_clusters = sources.read_sorted_clusters(spark, f"{out}/sorted_clusters", 1, 2)
    assert {r.cluster_id for r in sorted_clusters.select("cluster_id").distinct().collect()} == {1, 2}
    assert sorted_clusters.where("path = concat('doc-', id)").count() == sorted_clusters.count()
    stats = result["cluster_stats"].toPandas()
    assert stats.cluster_size.sum() == 1000
    assert result["member_stats"].count() == 1000
    assert result["eps_stats"].count() == 2 * len(stats)
    ratios = {r.eps: r for r in result["retained"].collect()}
    assert ratios[0.01].n_kept == 1002 - table["eps=0.01"].sum()

    if limit is None:
        corpus = sources.index_corpus(spark, str(corpus_file), split_bytes=2000)
    else:
        corpus = sources.read_corpus(spark, str(corpus_file))
    prune_corpus(corpus, out, config)
    written = spark.read.text(f"{out}/pruned_corpus").withColumn("eps", F.col("eps").cast("string"))
    for e in (0.01, 0.7):
        rows = written.where(F.col("eps") == str(e)).collect()
        gone = set(table[table[f"eps={e}"]].index)
        assert sorted(r.value for r in rows) == sorted(x for i, x in enumerate(lines) if i not in gone)
        folder = f"ratio={ratios[e].retained_pct / 100:.2f}"
        assert (tmp_path / "out" / "pruned_corpus" / f"eps={e}" / folder).is_dir()
    kept = sources.read_kept(spark, f"{out}/kept", 0.01)
    assert {1000, 1001} <= {r.id for r in kept.collect()}


def test_resume_repeats_unfinished_clusters_only(spark, tmp_path):
    vectors = _run_inputs(spark)
    out = str(tmp_path / "out")
    config = PruneConfig(num_clusters=5, niter=3, eps_list=(0.01,), save_eps_list=(0.01,))
    want = prune_vectors(vectors, out, config)["prune_table"].toPandas()
    done = spark.read.parquet(f"{out}/finished_clusters").toPandas()
    with pytest.raises(ValueError, match="other parameters"):
        prune_vectors(vectors, out, PruneConfig(num_clusters=4))
    # Forget two clusters and damage one of them, as a lost run would.
    lost = done.cluster_id.sort_values().head(2).tolist()
    spark.createDataFrame(done[~done.cluster_id.isin(lost)], "cluster_id int").write.mode(
        "overwrite"
    ).parquet(f"{out}/finished_clusters")
    folders = {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "prune_table").glob("*/*.parquet")}
    got = prune_vectors(vectors, out, config)["prune_table"].toPandas()
    key = ["cluster_id", "id"]
    assert got.sort_values(key).reset_index(drop=True).equals(
        want.sort_values(key).reset_index(drop=True)
    )
    now = {p: p.stat().st_mtime_ns for p in (tmp_path / "out" / "prune_table").glob("*/*.parquet")}
    changed = {p.parent.name for p in set(folders) ^ set(now)}
    assert changed == {f"cluster_id={c}" for c in lost}
    again = spark.read.parquet(f"{out}/finished_clusters").toPandas()
    assert sorted(again.cluster_id) == sorted(done.cluster_id)
    fresh = PruneConfig(num_clusters=2, niter=3, eps_list=(0.01,), save_eps_list=(0.01,))
    table = prune_vectors(vectors, out, fresh, resume=False)["prune_table"]
    assert table.count() == 1000 and table.select("cluster_id").distinct().count() == 2


def test_hot_mates_are_salted(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(600, 4))
    vectors[::2] = vectors[0]
    vectors /= np.linalg.norm(vectors, axis=1, keepdims=True)
    rows = spark.createDataFrame(
        [(0, i, float(i), [float(x) for x in v]) for i, v in enumerate(vectors)],
        "cluster_id int, id long, dist double, embedding array<double>",
    )
    config = PruneConfig(keep_hard=False)
    ranked = rank_within_cluster(rows.drop("embedding"), keep_hard=False)
    pairs = compare_members(rows, ranked, config)
    plain = sorted(prune_rows(pairs, ranked).collect())
    assert sum(r.mate_id == 0 for r in plain) >= 299
    assert sorted(prune_rows(pairs, ranked, hot_mates=50).collect()) == plain
    ranks = {r.id: r.rank for r in plain}
    assert all(r.mate_id is None or r.mate_rank == ranks[r.mate_id] for r in plain)


def test_corpus_lines_survive_another_way_of_cutting_the_files(spark, tmp_path):
    lines = [f"line {i} " + "x" * (i % 50) for i in range(3000)]
    (tmp_path / "a.jsonl").write_text("\n".join(lines) + "\n")
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "20000")
        corpus = sources.read_corpus(spark, str(tmp_path / "a.jsonl"), split_bytes=9000)
        spark.conf.set(key, "7000")
        got = [r.value for r in corpus.orderBy("line_no").collect()]
    finally:
        spark.conf.set(key, before)
    assert got == lines
    assert [r.line_no for r in corpus.orderBy("line_no").collect()] == list(range(3000))


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_line_index_is_all_that_is_stored(spark, tmp_path):
    folder = tmp_path / "a [1] corpus+%20"
    folder.mkdir()
    lines = [f"line {i} " + "é" * (i % 40) for i in range(5000)]
    for part in range(4):
        own = lines[part * 1250 : (part + 1) * 1250]
        (folder / f"p {part}.jsonl").write_text("\n".join(own) + "\n" * (part != 2), encoding="utf-8")
    (folder / "p 9.jsonl").write_text("")
    index = str(tmp_path / "index")
    corpus = sources.index_corpus(spark, str(tmp_path / "a*"), index, split_bytes=5000)
    assert corpus.index.count() > 10 and "value" not in corpus.index.columns
    plan = plan_of(corpus.read())
    assert "Exchange hashpartitioning" not in plan and "Sort" not in plan
    again = sources.open_corpus(spark, str(tmp_path / "a*"), index)
    got = [tuple(r) for r in again.read().orderBy("line_no").collect()]
    assert got == list(enumerate(lines))
    some = again.read((1300, 2600)).orderBy("line_no").collect()
    assert [tuple(r) for r in some] == list(enumerate(lines))[1300:2600]
    assert again.read((9000, 9999)).count() == 0
    batches = list(again.batches(700))
    assert batches[0][0] == 0 and batches[-1][1] == 5000
    assert all(a[1] == b[0] for a, b in zip(batches, batches[1:]))
    # The rows belong to the caller's session.
    assert again.read().sparkSession is spark
    assert again.read().join(spark.range(10), F.col("id") == F.col("line_no")).count() == 10
    (folder / "p 1.jsonl").write_text("another\n")
    with pytest.raises(Exception, match="changed since"):
        again.read().collect()


def test_bitmaps_hold_any_whole_number(spark):
    draw = np.random.default_rng(1)
    ids = [-1, 0, 1, 7, 8, 32767, 32768, -32768, -32769, 2**62, -(2**62)]
    ids += draw.integers(-200_000, 200_000, 3000).tolist()
    rows = spark.createDataFrame([(i, i % 3 == 0) for i in ids] + [(None, True)], "id long, third boolean")
    made = bitmaps.id_bitmaps(rows, "id", [F.lit(True), F.col("third")])
    probe = spark.createDataFrame([(i + d,) for i in ids for d in (-1, 0, 1)] + [(None,)], "k long").distinct()
    found = probe.join(made, bitmaps.chunk_of(F.col("k")) == F.col("_chunk"), "left")
    got = found.select("k", *[bitmaps.contains(F.get("_sets", F.lit(i)), F.col("k")) for i in (0, 1)])
    for k, one, two in got.collect():
        assert one == (k in set(ids)) and two == (k in {i for i in ids if i % 3 == 0})


@pytest.mark.parametrize("fits", [True, False])
def test_filters_by_bitmap_and_by_join_agree(spark, monkeypatch, fits):
    monkeypatch.setattr(bitmaps, "MAX_BROADCAST_BYTES", 1 << 28 if fits else 0)
    corpus = spark.range(-50, 70_000, 7).select(F.col("id").alias("line_no"), F.md5(F.col("id").cast("string")).alias("value"))
    corpus = corpus.unionByName(spark.createDataFrame([(None, "none")], "line_no long, value string"))
    rows = [(i, 0.5 + (i % 50) / 100) for i in range(0, 60_000, 3)] + [(21, 0.0), (None, 0.99)]
    prior = spark.createDataFrame(rows, "id long, max_sim double")
    eps = (0.3, 0.05, 0.1)
    found = extraction.filter_corpus_multi(corpus, prior, eps)
    if fits:
        assert "Exchange hashpartitioning" not in plan_of(found) and "Sort" not in plan_of(found)
    least = {}
    for i, m in rows:
        least[i] = min(m, least.get(i, 9.0))
    least[None] = 0.0
    want = sorted((e, i) for e in eps for i in [*range(-50, 70_000, 7)] if not least.get(i, 0.0) > 1 - e)
    got = found.where("line_no is not null").select("eps", "line_no").collect()
    assert sorted(map(tuple, got)) == want
    assert found.where("line_no is null").count() == 3
    kept = extraction.kept_ids(prior, eps)
    one = extraction.filter_corpus(corpus, kept, 0.05)
    assert sorted(r.line_no for r in one.collect()) == [
        i for i in range(-50, 70_000, 7) if i in least and not least[i] > 0.95
    ]


def test_lines_are_written_in_batches_of_files(spark, tmp_path):
    folder = tmp_path / "corpus"
    folder.mkdir()
    lines = [f"{i}" for i in range(120_000)]
    for part in range(6):
        (folder / f"{part}.txt").write_text("\n".join(lines[part * 20_000 : (part + 1) * 20_000]) + "\n")
    corpus = sources.index_corpus(spark, str(folder), split_bytes=30_000)
    prior = spark.range(100_000).select("id", F.when(F.col("id") % 3 == 0, 0.99).otherwise(0.0).alias("max_sim"))
    eps = (0.001, 0.05)
    ratios = extraction.retained_ratio(prior, eps)
    kept = {0.001: lines, 0.05: [x for i, x in enumerate(lines) if i >= 100_000 or i % 3]}
    for chunks in (1, 2, None):
        path = tmp_path / f"out{chunks}"
        write_kept_lines(corpus, prior, ratios, str(path), eps, chunks=chunks)
        for e in eps:
            files = sorted((path / f"eps={e}").glob("*/*/*.txt"))
            assert [x for f in files for x in f.read_text().split()] == kept[e]


def test_prune_table_keeps_rows_without_a_vector_and_refuses_repeated_ids(spark):
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [float("nan"), 1.0])]
    vectors = spark.createDataFrame(rows, "id long, embedding array<double>")
    centroids = spark.createDataFrame([(0, [1.0, 0.0])], "cluster_id int, centroid array<double>")
    config = PruneConfig(num_clusters=1)
    got = {r.id: r.max_sim for r in prune_table(vectors, centroids, config).collect()}
    assert got == {0: 0.0, 1: 1.0, 2: 0.0, 3: 0.0, 4: 0.0}
    with pytest.raises(ValueError):
        prune_table(vectors.union(vectors.limit(1)), centroids, config)


def test_a_stopped_run_goes_on_inside_a_large_cluster(spark, tmp_path, monkeypatch):
    vectors = _run_inputs(spark)
    config = PruneConfig(num_clusters=2, eps_list=(0.3,), save_eps_list=(0.3,), block_rows=64)
    start = vectors.where("id < 2").select(
        F.col("id").cast("int").alias("cluster_id"), F.col("embedding").alias("centroid")
    )
    whole = prune_vectors(vectors, str(tmp_path / "whole"), config, centroids=start)
    out, write, written = tmp_path / "out", pairs._write_part, []

    def stop_at(n):
        def run(reduced, folder):
            if len(written) == n:
                raise RuntimeError("stopped")
            written.append(folder.rsplit("/", 1)[1])
            write(reduced, folder)

        return run

    args = (vectors, str(out), config)
    for stop in (2, 3):
        monkeypatch.setattr(pairs, "_write_part", stop_at(stop))
        with pytest.raises(RuntimeError, match="stopped"):
            prune_vectors(*args, centroids=start, block_parts=4)
    monkeypatch.setattr(pairs, "_write_part", stop_at(9))
    got = prune_vectors(*args, centroids=start, block_parts=4)
    assert written == [f"part-{i}-of-4" for i in range(4)]
    rows = [sorted(r["prune_table"].collect(), key=str) for r in (got, whole)]
    assert rows[0] == rows[1] and any(r["eps=0.3"] for r in rows[0])
    assert not any((out / "block_pairs").iterdir())


def test_run_over_a_range_of_given_clusters_reads_its_batch_only(spark, tmp_path):
    vectors = _run_inputs(spark)
    out, whole = str(tmp_path / "out"), str(tmp_path / "whole")
    config = PruneConfig(num_clusters=6, eps_list=(0.01,), save_eps_list=(0.01,))
    start = vectors.where("id < 6").select(
        F.col("id").cast("int").alias("cluster_id"), F.col("embedding").alias("centroid")
    )
    given = {"centroids": start, "cluster_batches": 3, "buckets": 4, "with_stats": True}
    part = prune_vectors(vectors, out, config, clusters=(0, 2), **given)
    assert "retained" not in part and not (tmp_path / "out" / "kept").exists()
    # Clusters 0 to 2 lie in three of the four folders, which are written whole.
    assert {r[0] for r in part["prune_table"].select("cluster_id").distinct().collect()} == {
        0, 1, 2, 4, 5,
    }
    got = prune_vectors(vectors, out, config, clusters=(3, 5), **given)
    want = prune_vectors(vectors, whole, config, centroids=start, with_stats=True)
    order = ["cluster_id", "id", "rank", "max_sim", "mate_id", "mate_rank"]
    assert sorted(got["prune_table"].select(order).collect(), key=str) == sorted(
        want["prune_table"].select(order).collect(), key=str
    )
    assert got["retained"].collect() == want["retained"].collect()
    stats = [x["cluster_stats"].toPandas().set_index("cluster_id").sort_index() for x in (got, want)]
    assert len(stats[0]) == 6 and np.allclose(*stats)
    assert len(list((tmp_path / "out" / "cluster_stats").glob("*.parquet"))) < 6
    batch = got["assignment"].where("batch = 1")
    assert "PartitionFilters: [isnotnull(batch" in batch._jdf.queryExecution().toString()
    with pytest.raises(ValueError, match="other parameters"):
        prune_vectors(vectors, out, config, centroids=start, cluster_batches=2)


def test_a_run_for_flags_only_removes_the_same_rows(spark, tmp_path):
    vectors = _run_inputs(spark)
    start = vectors.where("id < 3").select(
        F.col("id").cast("int").alias("cluster_id"), F.col("embedding").alias("centroid")
    )
    runs = []
    for flags_only in (False, True):
        config = PruneConfig(
            num_clusters=3, eps_list=(0.01, 0.3), save_eps_list=(0.01, 0.3), block_rows=32,
            flags_only=flags_only,
        )
        out = str(tmp_path / str(flags_only))
        runs.append(prune_vectors(vectors, out, config, centroids=start, cluster_batches=2))
    flags = [
        sorted(r["prune_table"].select("cluster_id", "id", "rank", "`eps=0.01`", "`eps=0.3`").collect())
        for r in runs
    ]
    assert flags[0] == flags[1] and any(f[3] for f in flags[0])
    low = runs[1]["prune_table"].where("max_sim > 0").agg(F.min("max_sim")).first()[0]
    assert low > 0.7
    assert runs[0]["retained"].collect() == runs[1]["retained"].collect()
    with pytest.raises(ValueError, match="flags_only"):
        prune_vectors(vectors, str(tmp_path / "x"), config, centroids=start, with_stats=True)


def test_pruned_corpus_keeps_the_order_of_its_lines(spark, tmp_path):
    corpus = spark.range(4000).select(
        F.col("id").alias("line_no"), F.col("id").cast("string").alias("value")
    )
    prior = spark.range(4000).select(
        "id", F.when(F.col("id") % 3 == 0, 0.99).otherwise(0.0).alias("max_sim")
    )
    eps = (0.001, 0.05)
    path = str(tmp_path / "pruned")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        rows = extraction.filter_corpus_multi(corpus, prior, eps, order_col="line_no")
        ratios = extraction.retained_ratio(prior, eps)
        sinks.write_pruned_corpus(rows, ratios, path, eps, order_col="line_no")
    finally:
        for key in settings:
            spark.conf.unset(key)
    for e, want in ((0.001, range(4000)), (0.05, [i for i in range(4000) if i % 3])):
        files = sorted((tmp_path / "pruned" / f"eps={e}").glob("*/*.txt"))
        assert len(files) > 1
        assert [int(x) for f in files for x in f.read_text().split()] == list(want)
