"""The whole run: cluster, rank, prune, extract, filter the corpus.

Each stage ends in a table below the output folder, so that a stage reads
finished input, lost executors recompute a stage at most, and a repeated call
goes on where the last one stopped.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neardup import sinks
from neardup.config import HOT_COPIES, PruneConfig
from neardup.operators import bitmaps, extraction, pruning, ranking, statistics
from neardup.operators.assignment import assign_and_measure, invalid_vectors, valid_vectors
from neardup.operators.kmeans import saved_centroids, train_or_load_kmeans
from neardup.operators.pairs import ClusterPairs, Ledger, compare_within_clusters, copy_keys
from neardup.operators.skew import hot_keys, salted_left_join
from neardup.operators.two_level import train_two_level
from neardup.session import (
    broadcast_if_small,
    hadoop_path,
    materialize,
    path_exists,
    scratch_scope,
)
from neardup.sources.corpus import IndexedCorpus


# What a finished cluster's marker says of it; null for a cluster of one row.
_REPORT = (
    "cluster_size long, avg_sim_to_cent double, std_sim_to_cent double, "
    "std_pair_w_sim double, max_sim double, min_sim double"
)


@dataclass(frozen=True)
class RunPaths:
    root: str

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root.rstrip('/')}/{name}"


def _check_same_run(
    spark: SparkSession, path: str, config: PruneConfig, resume: bool, more: dict
) -> None:
    """Keep the parameters with the output; refuse to go on under other ones."""
    mine = json.dumps(asdict(config) | more, sort_keys=True)
    if resume and path_exists(spark, path):
        saved = spark.read.text(path, wholetext=False).first()[0]
        if saved != mine:
            raise ValueError(f"output belongs to a run with other parameters: {saved}")
        return
    spark.createDataFrame([(mine,)], "value string").coalesce(1).write.mode("overwrite").text(path)


def compare_members(
    assigned: DataFrame,
    ranked: DataFrame,
    config: PruneConfig,
    with_sums: bool = False,
    ledger: Ledger | None = None,
) -> ClusterPairs:
    """The pair comparison of a run.

    Rows are ordered by distance and id directly, so vectors are not shuffled
    for the sake of a rank. Only chunked pruning needs the rank beside the
    vector.
    """
    limit = config.largest_cluster_size_to_process
    if limit is None:
        keyed = ranking.with_order_keys(
            assigned, config.which_to_keep, config.keep_hard, config.seed
        )
        by, order = ("cluster_id",), ("order_0", "order_1")
    else:
        placed = ranking.split_into_chunks(ranked.select("cluster_id", "id", "rank"), limit)
        keyed = assigned.join(placed, ["cluster_id", "id"])
        by, order = ("cluster_id", "chunk"), ("rank",)
    above = pruning.least_threshold(config.eps_list) if config.flags_only else None
    return compare_within_clusters(
        keyed, by, order, block_rows=config.block_rows, with_sums=with_sums, above=above,
        ledger=ledger,
    )


def prune_rows(
    pairs: ClusterPairs, ranked: DataFrame, hot_mates: int = HOT_COPIES
) -> DataFrame:
    """``cluster_id, id, rank, max_sim, mate_id, mate_rank``: ranks join the narrow result.

    One row may be the mate of very many; above ``hot_mates`` it is salted.
    """
    ranks = ranked.select("cluster_id", "id", "rank")
    mates = ranks.withColumnsRenamed({"id": "mate_id", "rank": "mate_rank"})
    # Stored: the pair join must not run again to count the mates.
    prior = materialize(
        pairs.prior_similarity().select("cluster_id", "id", "max_sim", "mate_id"), "prior"
    )
    keys = ["cluster_id", "mate_id"]
    hot = hot_keys(prior.where(F.col("mate_id").isNotNull()), keys, hot_mates)
    return (
        salted_left_join(prior, mates, keys, hot, "id")
        .join(ranks, ["cluster_id", "id"])
        .select("cluster_id", "id", "rank", "max_sim", "mate_id", "mate_rank")
    )


def prune_table(
    vectors: DataFrame, centroids: DataFrame, config: PruneConfig
) -> DataFrame:
    """Prune rows of a vector table for given centroids, without an output folder.

    Rows whose vector is null, zero or not finite come back with ``max_sim`` 0
    and no cluster. Ids must be unique.
    """
    pruning.assert_unique_row_ids(vectors)
    assigned = assign_and_measure(
        valid_vectors(vectors), centroids, config.sim_metric, config.spherical
    )
    # Ranking and comparison each read it: assign once.
    assigned = materialize(
        assigned.select("id", "embedding", "cluster_id", "dist", *copy_keys()), "assignment"
    )
    ranked = ranking.rank_within_cluster(
        assigned.select("cluster_id", "id", "dist"),
        config.keep_hard,
        config.which_to_keep,
        config.seed,
    )
    rows = prune_rows(compare_members(assigned, ranked, config), ranked)
    unusable = invalid_vectors(vectors).select("id", F.lit(0.0).alias("max_sim"))
    return rows.unionByName(unusable, allowMissingColumns=True)


def prune_vectors(
    vectors: DataFrame,
    output: str,
    config: PruneConfig,
    resume: bool = True,
    cluster_batches: int = 1,
    with_stats: bool = False,
    train_fraction: float = 1.0,
    centroids: DataFrame | None = None,
    clusters: tuple[int, int] | None = None,
    buckets: int | None = None,
    block_parts: int = 1,
) -> dict[str, DataFrame]:
    """Cluster and prune ``id, embedding`` rows; returns the result tables by name.

    With ``resume`` finished stages are read back. The pruning stage works in
    ``cluster_batches`` parts and records the clusters it has finished; with
    ``with_stats`` the same comparison also yields the statistics. Rows whose
    vector cannot be clustered (null, zero, not finite) are kept. A ``path``
    column, the external name of a row, is carried into the sorted clusters.
    Ids must be unique; repeated ones raise before anything is written.

    Given ``centroids`` (``cluster_id, centroid``) take the place of training.
    ``clusters`` limits the pruning stage of this call to a range of clusters,
    both ends included; kept ids and ratios are written by the call that
    finishes the last cluster. Outputs by cluster have a folder per cluster, or
    with ``buckets`` a folder per group of clusters: set it for very many. A
    batch is made of whole folders, and its part of the assignment is stored
    by itself, so that a batch and a resume read no other part.

    ``block_parts`` above 1 cuts the comparison of a batch further, whatever the size
    of its clusters: its block pairs are run and stored in so many jobs, and a call that
    was stopped goes on with the first one missing, also inside one large cluster.
    """
    if with_stats and config.flags_only:
        raise ValueError("statistics need every similarity: flags_only goes without them")
    if block_parts < 1 or (block_parts > 1 and config.flags_only):
        raise ValueError("block_parts must be positive, and 1 with flags_only")
    spark = vectors.sparkSession
    at = RunPaths(output)
    read = spark.read.parquet

    def finished(path: str) -> bool:
        return resume and path_exists(spark, path)

    if not finished(at.assignment):
        pruning.assert_unique_row_ids(vectors)
    layout = {"cluster_batches": cluster_batches, "buckets": buckets}
    layout |= {"train_fraction": train_fraction, "given_centroids": centroids is not None}
    layout |= {"columns": vectors.select("id", "embedding").schema.simpleString()}
    _check_same_run(spark, at.parameters, config, resume, layout)
    if not resume:
        # Stages written cluster by cluster do not replace the folder as a whole.
        for path in (at.prune_table, at.member_stats, at.block_pairs):
            fs, target = hadoop_path(spark, path)
            fs.delete(target, True)
    usable = valid_vectors(vectors)
    names = [c for c in ("path",) if c in vectors.columns]
    if not finished(at.centroids) and centroids is not None:
        sinks.write_centroids(centroids, at.centroids)
    elif not finished(at.centroids) and config.coarse_clusters is not None:
        with scratch_scope(spark):
            trained = train_two_level(
                usable,
                config.num_clusters,
                config.niter,
                config.coarse_clusters,
                config.seed,
                config.spherical,
                train_fraction=train_fraction,
            )
            sinks.write_centroids(trained, at.centroids)
    elif not finished(at.centroids):
        train_or_load_kmeans(
            usable,
            at.kmeans_model,
            resume,
            num_clusters=config.num_clusters,
            niter=config.niter,
            seed=config.seed,
            spherical=config.spherical,
            train_fraction=train_fraction,
        )
        sinks.write_centroids(saved_centroids(spark, at.kmeans_model), at.centroids)
    folder = F.col("cluster_id") if buckets is None else F.pmod("cluster_id", F.lit(buckets))
    batch_of = F.pmod(F.xxhash64(folder), F.lit(cluster_batches)).cast("int")
    if not finished(at.assignment):
        assigned = assign_and_measure(
            usable, read(at.centroids), config.sim_metric, config.spherical
        )
        # The copy key is stored so that later passes need not read the vectors for it.
        sinks.write_assignment(
            assigned.select(
                "id", *names, "embedding", "cluster_id", "dist", *copy_keys(),
                batch_of.alias("batch"),
            ),
            at.assignment,
            "batch",
        )
    assigned = read(at.assignment)
    if not finished(at.sorted_clusters):
        with scratch_scope(spark):
            ranked = ranking.rank_within_cluster(
                assigned.select("id", *names, "cluster_id", "dist"),
                config.keep_hard,
                config.which_to_keep,
                config.seed,
            )
            sinks.write_sorted_clusters(ranked, at.sorted_clusters, buckets)
    ranked = read(at.sorted_clusters)

    done_path = at.finished_clusters_with_stats if with_stats else at.finished_clusters
    marker = f"cluster_id int, {_REPORT}" if with_stats else "cluster_id int"
    if not finished(done_path):
        spark.createDataFrame([], marker).write.mode("overwrite").parquet(done_path)

    def done() -> DataFrame:
        return spark.read.schema(marker).parquet(done_path)

    every = materialize(ranked.select("cluster_id").distinct(), "clusters")
    wanted = every if clusters is None else ranking.cluster_slice(every, *clusters)
    for batch in range(cluster_batches):
        # The intermediate tables of a batch go when its results are stored.
        with scratch_scope(spark):
            pending = pruning.pending_clusters(wanted.where(batch_of == batch), done())
            if buckets is not None:
                # A folder is written as a whole.
                folders = pending.select(folder.alias("_folder")).distinct()
                pending = every.join(folders, folder == F.col("_folder"), "left_semi")
            pending = materialize(pending, "pending-clusters")
            if not pending.isEmpty():
                own = assigned.where(F.col("batch") == batch).drop("batch")
                ranks = ranked.where(batch_of == batch)
                ledger = _ledger_of(pending, at, block_parts, with_stats)
                report = _prune_clusters(
                    own, ranks, pending, at, config, with_stats, buckets, ledger
                )
                again = pruning.pending_clusters(report, done())
                again.select(*[f.name for f in done().schema]).write.mode("append").parquet(
                    done_path
                )
                if ledger is not None:
                    fs, target = hadoop_path(spark, ledger.path)
                    fs.delete(target, True)

    prior = read(at.prune_table)
    out = {"assignment": assigned, "sorted_clusters": ranked, "prune_table": prior}
    if clusters is not None and not pruning.pending_clusters(every, done()).isEmpty():
        return out
    unusable = invalid_vectors(vectors).select("id", F.lit(0.0).alias("max_sim"))
    everything = prior.select("id", "max_sim").unionByName(unusable)
    eps = config.eps_list
    # Ids were checked to be unique: none of these shuffles the rows.
    sinks.write_kept(extraction.kept_ids(everything, eps, unique_ids=True), at.kept, eps)
    sinks.write_kept(extraction.removed_ids(everything, eps, unique_ids=True), at.removed, eps)
    ratios = extraction.retained_ratio(everything, eps, config.dataset_size, unique_ids=True)
    sinks.write_retained(ratios, at.retained_ratios, eps)
    out["retained"] = ratios
    if with_stats:
        # One small table: a cluster's row came with its marker.
        sinks.write_stats(done().where("cluster_size > 1"), at.cluster_stats)
        sinks.write_stats(statistics.eps_cluster_stats(prior, eps), at.eps_stats)
        for name in ("cluster_stats", "member_stats", "eps_stats"):
            out[name] = read(f"{at.root}/{name}")
    return out


def _ledger_of(pending, at: RunPaths, parts: int, with_stats: bool) -> Ledger | None:
    """The ledger of a set of clusters, which its count and the sum of its hashes name."""
    if parts == 1:
        return None
    total = F.sum(F.xxhash64("cluster_id").cast("decimal(38,0)"))
    n, named = pending.agg(F.count(F.lit(1)), total).first()
    return Ledger(f"{at.block_pairs}/{n}_{named}{'_stats' if with_stats else ''}", parts)


def _prune_clusters(
    assigned,
    ranked,
    pending,
    at: RunPaths,
    config,
    with_stats: bool,
    buckets: int | None,
    ledger: Ledger | None = None,
) -> DataFrame:
    """Compare and store the clusters listed in ``pending``; returns their markers."""
    side = broadcast_if_small(pending, 16)
    members = assigned.join(side, "cluster_id", "left_semi")
    ranks = ranked.join(side, "cluster_id", "left_semi")
    pairs = compare_members(members, ranks, config, with_stats, ledger)
    if with_stats:
        pairs = pairs.materialized()
        sinks.write_by_cluster(statistics.members_of(pairs), at.member_stats, buckets)
    rows = pruning.flag_duplicates_wide(prune_rows(pairs, ranks), config.eps_list)
    sinks.write_by_cluster(rows, at.prune_table, buckets)
    if not with_stats:
        return pending
    return pending.join(statistics.report_of(pairs, members), "cluster_id", "left")


def prune_corpus(
    corpus: DataFrame | IndexedCorpus,
    output: str,
    config: PruneConfig,
    key: str = "line_no",
    value_col: str = "value",
) -> None:
    """Write the corpus once per threshold of ``save_eps_list`` from a finished run.

    Lines whose number has no prune row (they had no usable vector) are kept.
    Lines of a threshold stand in the order of ``key``, over files in path order.

    The lines of an :class:`IndexedCorpus` are not shuffled: removed numbers
    come as bitmaps, in as many jobs over consecutive files as the broadcast limit
    asks for. Any other table is sorted by ``key``.
    """
    spark = corpus.index.sparkSession if isinstance(corpus, IndexedCorpus) else corpus.sparkSession
    at = RunPaths(output)
    prior = spark.read.parquet(at.prune_table)
    eps = config.save_eps_list
    ratios = spark.read.schema("eps string, n_kept long, retained_pct double").json(
        at.retained_ratios
    )
    ratios = ratios.withColumn("eps", F.col("eps").cast("double"))
    if isinstance(corpus, IndexedCorpus):
        write_kept_lines(corpus, prior, ratios, at.pruned_corpus, eps)
        return
    rows = extraction.filter_corpus_multi(corpus, prior, eps, key=key, order_col=key)
    sinks.write_pruned_corpus(rows, ratios, at.pruned_corpus, eps, value_col, order_col=key)


def write_kept_lines(
    corpus: IndexedCorpus,
    prior: DataFrame,
    ratios: DataFrame,
    path: str,
    eps_list,
    chunks: int | None = None,
) -> None:
    """The lines of files that each threshold keeps, one narrow job for ``chunks`` bitmaps.

    As many bitmaps as the broadcast limit allows by default.
    """
    chunks = chunks or bitmaps.chunks_that_fit(len(eps_list))
    removed = materialize(extraction.removal_bitmaps(prior, eps_list), "removed-lines")
    mode = "overwrite"
    for first, end in corpus.batches(chunks * bitmaps.IDS_EACH):
        last = (end - 1) // bitmaps.IDS_EACH
        part = removed.where(F.col("_chunk").between(first // bitmaps.IDS_EACH, last))
        # At most ``chunks`` + 1 rows; more only for one byte range of very many lines.
        part = F.broadcast(part) if part.count() <= chunks + 1 else part
        lines = corpus.read((first, end), with_split=True)
        rows = extraction.keep_by_bitmaps(lines, part, eps_list, "line_no")
        sinks.write_pruned_corpus(
            rows, ratios, path, eps_list, order_col="line_no", split_col="first_line", mode=mode
        )
        mode = "append"
