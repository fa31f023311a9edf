"""The operators applied to whole driver tables, one query per operator."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neardup import sinks, sources
from neardup.config import DEFAULT_EPS_LIST, SIM_METRICS, PruneConfig, eps_name, validate_metric
from neardup.functions.embedding import embed, hashed_bag_of_words, last_token_vectors
from neardup.functions.vectors import l2_normalize, pool_last_token
from neardup.operators import assignment, extraction, kmeans, pairs, pruning, ranking, statistics, two_level
from neardup.plans.prune import prune_table, prune_vectors
from neardup.session import brief_session, materialize, scratch_path
from neardup.sources import numbered_ids, read_corpus, read_vectors

DIM = 64
# The embeddings table has no near-duplicates: thresholds that flag its rows.
WIDE_EPS = (0.6, 0.7, 0.8, 0.9)
DOC_EPS = DEFAULT_EPS_LIST
LINE_EPS = (0.01, 0.03, 0.07)
CHUNK_LIMIT = 150
DOC_CHUNK_LIMIT = 200

_stage_tables: dict[tuple[str, str], DataFrame] = {}


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, embedding, label`` of the embeddings table."""
    return read_vectors(spark, f"{sf_dir}/embeddings.parquet", "vec_id", extra=("label",))


def by_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors(spark, sf_dir).withColumnRenamed("label", "cluster_id")


def embedded_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``id, lang, n_chars, embedding`` of every document, computed anew."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("id"), "lang", F.col("n_chars").cast("int"), "text"
    )
    spread = spark.sparkContext.defaultParallelism
    return embed(docs, hashed_bag_of_words(DIM), num_partitions=spread).drop("text")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embedded documents as a stage table, written once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stage_tables:
        _stage_tables[key] = materialize(embedded_documents(spark, sf_dir), "documents")
    return _stage_tables[key]


def _lang_ranked(spark, sf_dir) -> DataFrame:
    """Documents with their language as cluster, in order of their id."""
    return ranking.rank_in_cluster(
        documents(spark, sf_dir), [F.col("id").asc()], cluster_col="lang"
    )


def _lang_prior(spark, sf_dir) -> DataFrame:
    return pairs.max_prior_similarity(documents(spark, sf_dir), ("lang",), ("id",))


def _assigned(spark, sf_dir) -> DataFrame:
    rows = vectors(spark, sf_dir)
    centroids = assignment.label_centroids(rows, "label")
    return assignment.assign_and_measure(rows.drop("label"), centroids)


def _label_dist(spark, sf_dir) -> DataFrame:
    """Embeddings clustered by label with their cosine distance to the label's mean."""
    rows = by_label(spark, sf_dir)
    means = assignment.label_centroids(rows, "cluster_id", spherical=False)
    return assignment.distance_to_centroid(rows, "cosine", False, means)


def _label_ranked(spark, sf_dir, **order) -> DataFrame:
    return ranking.rank_within_cluster(_label_dist(spark, sf_dir), **order)


def _label_prior(spark, sf_dir) -> DataFrame:
    return pruning.prune_clusters(_label_ranked(spark, sf_dir))


def _six(name: str):
    return F.round(name, 6).alias(name)


def _elements(rows: DataFrame, key: str, vector: str) -> DataFrame:
    values = F.col(vector).cast("array<double>")
    return rows.select(key, F.posexplode(values).alias("dim", "value")).select(
        key, "dim", _six("value")
    )


def _vector_sum(vector: str, decimals: int = 6):
    total = F.aggregate(F.col(vector).cast("array<double>"), F.lit(0.0), lambda s, x: s + x)
    return F.round(total, decimals)


# --- sources ---------------------------------------------------------------


def scan_vectors(spark, sf_dir):
    return vectors(spark, sf_dir).select(
        "id", "label", F.size("embedding").alias("n_dims"), _vector_sum("embedding").alias("total")
    )


def vector_ids(spark, sf_dir):
    return numbered_ids(vectors(spark, sf_dir))


#: Four bytes after each record: a line end for the writer, one more float for the reader.
_LINE_END = "ABCD"


def raw_vectors_round_trip(spark, sf_dir):
    """The vectors as headerless float32 records, one float longer, read back by record number."""

    def records(batches):
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype("<f4")
            rows = values.reshape(batch.num_rows, -1)
            raw = pa.array([row.tobytes() for row in rows], pa.binary())
            yield pa.RecordBatch.from_arrays([raw], ["value"])

    path = scratch_path(spark, "raw-vectors")
    in_order = vectors(spark, sf_dir).orderBy("id").select("embedding")
    lines = in_order.mapInArrow(records, "value binary").select(F.col("value").cast("string"))
    lines.write.option("lineSep", _LINE_END).text(path)
    read = sources.read_raw_vectors(spark, path, DIM + 1)
    own = read.select("id", F.slice("embedding", 1, DIM).alias("embedding"))
    return own.select(
        "id", F.size("embedding").alias("n_dims"), _vector_sum("embedding").alias("total")
    )


def fixed_width_ids_round_trip(spark, sf_dir):
    """Names of the vectors as byte strings of 24 padded with NUL, read back by record number."""
    path = scratch_path(spark, "fixed-ids")
    name = F.concat(F.lit("item/"), F.col("label").cast("string"), F.lit("/"), F.col("id").cast("string"))
    padded = F.rpad(name, 23, "\0").alias("value")
    vectors(spark, sf_dir).orderBy("id").select(padded).write.option("lineSep", "\0").text(path)
    return sources.read_fixed_width_ids(spark, path, 24)


def corpus_lines(spark, sf_dir):
    """The documents written as JSON lines and read back with line numbers."""
    path = scratch_path(spark, "corpus")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs.orderBy("doc_id").select(F.to_json(F.struct("doc_id", "text"))).write.text(path)
    return read_corpus(spark, path).select(
        "line_no",
        F.get_json_object("value", "$.doc_id").cast("long").alias("doc_id"),
        F.get_json_object("value", "$.text").alias("text"),
    )


# --- vectors ---------------------------------------------------------------


def embed_hashed(spark, sf_dir):
    return _elements(embedded_documents(spark, sf_dir), "id", "embedding")


def normalize_vectors(spark, sf_dir):
    scaled = vectors(spark, sf_dir).select(
        "id",
        F.zip_with(
            F.col("embedding").cast("array<double>"),
            F.array_repeat(F.col("label") + 2, F.size("embedding")),
            lambda x, n: x * n,
        ).alias("embedding"),
    )
    return _elements(scaled.withColumn("unit", l2_normalize("embedding")), "id", "unit")


def last_token_pool(spark, sf_dir):
    pooled = last_token_vectors(vectors(spark, sf_dir), "label", "id", "embedding")
    return _elements(pooled, "label", "embedding")


#: Tokens of the nested form: each vector is cut into so many.
TOKENS = 16


def last_token_pool_nested(spark, sf_dir):
    """Vectors cut into tokens of a few values each, pooled within their row."""
    width = DIM // TOKENS
    tokens = F.transform(
        F.sequence(F.lit(0), F.lit(TOKENS - 1)),
        lambda t: F.slice("embedding", t * width + 1, F.lit(width)),
    )
    nested = vectors(spark, sf_dir).withColumn("tokens", tokens)
    return _elements(nested.withColumn("pooled", pool_last_token("tokens")), "id", "pooled")


def dist_cosine(spark, sf_dir):
    return _label_dist(spark, sf_dir).select("id", "cluster_id", _six("dist"))


def dist_spherical(spark, sf_dir):
    return _assigned(spark, sf_dir).select("id", "cluster_id", _six("dist"))


def dist_l2(spark, sf_dir):
    rows = by_label(spark, sf_dir)
    means = assignment.label_centroids(rows, "cluster_id", spherical=False)
    return assignment.with_centroid_distance(rows, means).select(
        "id", "cluster_id", _six("sq_dist")
    )


# --- clustering ------------------------------------------------------------


def assign_ip(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    centroids = assignment.label_centroids(rows, "label")
    return assignment.assign_nearest(rows, centroids, "ip").select(
        "id", "cluster_id", _six("score")
    )


def assign_l2(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    centroids = assignment.label_centroids(rows, "label", spherical=False)
    return assignment.assign_nearest(rows, centroids, "l2").select(
        "id", "cluster_id", _six("score")
    )


def lloyd_2iter(spark, sf_dir):
    rows = vectors(spark, sf_dir)
    start = assignment.label_centroids(rows, "label")
    final = kmeans.lloyd(rows, start, niter=2, spherical=True)
    return assignment.assign_nearest(rows, final, "ip").select("id", "cluster_id", _six("score"))


def kmeans_train(spark, sf_dir):
    rows = vectors(spark, sf_dir).drop("label")
    model = kmeans.train_kmeans(rows, num_clusters=10, niter=20, seed=1234, spherical=True)
    assigned = assignment.assign_and_measure(rows, kmeans.model_centroids(spark, model))
    return assigned.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("cluster_size"), F.round(F.sum("dist"), 6).alias("cost")
    )


def kmeans_invariants(spark, sf_dir):
    """What holds of any training: every row is assigned, the means give back the
    sum of all vectors, centroids have length 1, and more steps cost no more."""
    rows = vectors(spark, sf_dir).drop("label")
    found = []
    for steps in (1, 20):
        path = scratch_path(spark, "kmeans")
        kmeans.train_or_load_kmeans(
            rows, path, num_clusters=10, niter=steps, seed=1234, spherical=True
        )
        found.append(materialize(kmeans.saved_centroids(spark, path), "centroids"))
    first, last = (assignment.assign_and_measure(rows, c) for c in found)
    start = first.agg(F.sum("dist").alias("start"))
    per_cluster = last.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("dist").alias("cost"),
        vector_to_array(Summarizer.mean(array_to_vector("embedding"))).alias("mean"),
    )
    end = per_cluster.agg(
        F.sum("n").alias("n_rows"),
        F.sum("cost").alias("cost"),
        F.round(F.sum(F.col("n") * _vector_sum("mean", 15)), 4).alias("total"),
    )
    length = F.sqrt(F.aggregate("centroid", F.lit(0.0), lambda s, x: s + x * x))
    units = found[1].agg(
        F.count_if(F.abs(length - 1) < 1e-9).alias("unit_centroids"),
        F.count(F.lit(1)).alias("n_clusters"),
    )
    # Three tables of one row each.
    one = F.lit(1)
    start, end, units = (x.withColumn("_one", one) for x in (start, end, units))
    return (
        end.join(start, "_one")
        .join(units, "_one")
        .select(
            "n_rows", "total", "n_clusters", "unit_centroids",
            (F.col("cost") <= F.col("start") + 1e-6).alias("not_above_start"),
        )
    )


def kmeans_two_level(spark, sf_dir):
    """What holds of any training in two levels: every row is assigned, centroids have
    length 1, and the cost is not above that of the coarse clusters."""
    rows = vectors(spark, sf_dir).drop("label")
    model = kmeans.train_kmeans(rows, num_clusters=5, niter=5, seed=1234, spherical=True)
    coarse = kmeans.model_centroids(spark, model)
    # A small limit, so that centroids go out in several parts.
    fine = two_level.refine_clusters(
        rows, coarse, num_clusters=24, niter=5, spherical=True, max_broadcast_bytes=8 * DIM * 10
    )
    length = F.sqrt(F.aggregate("centroid", F.lit(0.0), lambda s, x: s + x * x))
    units = fine.agg(
        F.count(F.lit(1)).alias("n_clusters"),
        F.count_if(F.abs(length - 1) < 1e-9).alias("unit_centroids"),
    )
    costs = [
        assignment.assign_and_measure(rows, c).agg(
            F.count("cluster_id").alias("n_rows"), F.sum("dist").alias("cost")
        )
        for c in (coarse, fine)
    ]
    start, end = costs
    every = units.unionByName(end, True).unionByName(
        start.select(F.col("cost").alias("start")), True
    )
    names = ("n_rows", "n_clusters", "unit_centroids")
    return every.agg(
        *[F.max(c).alias(c) for c in names],
        (F.max("cost") <= F.max("start") + 1e-6).alias("not_above_coarse"),
    )


def saved_model_reused(spark, sf_dir):
    """A saved model is loaded in place of training, whatever the training asked for."""
    rows = vectors(spark, sf_dir).drop("label")
    path = scratch_path(spark, "kmeans")
    placed = []
    for steps, seed in ((5, 1234), (1, 99)):
        kmeans.train_or_load_kmeans(
            rows, path, num_clusters=10, niter=steps, seed=seed, spherical=True
        )
        found = kmeans.saved_centroids(spark, path)
        placed.append(materialize(assignment.assign_and_measure(rows, found), "assigned"))
    first, again = placed
    again = again.select("id", F.struct("cluster_id", "dist").alias("again"))
    same = F.struct("cluster_id", "dist").eqNullSafe(F.col("again"))
    return first.join(again, "id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(same).alias("n_same")
    )


def metric_options(spark, sf_dir):
    """Cost of every combination of metric and training; one that is refused has none."""
    rows = vectors(spark, sf_dir)
    costs = []
    for metric in (*SIM_METRICS, "dot"):
        for spherical in (True, False):
            option = [F.lit(metric).alias("metric"), F.lit(spherical).alias("spherical")]
            try:
                validate_metric(metric, spherical)
            except ValueError:
                none = rows.agg(F.count("id").alias("n_rows")).select("n_rows", *option)
                costs.append(none.withColumn("cost", F.lit(None).cast("double")))
                continue
            means = assignment.label_centroids(rows, "label", spherical=spherical)
            placed = assignment.assign_and_measure(rows, means, metric, spherical)
            cost = F.round(F.sum("dist"), 4).alias("cost")
            summed = placed.agg(F.count("id").alias("n_rows"), cost)
            costs.append(summed.select("n_rows", *option, "cost"))
    return reduce(DataFrame.unionByName, costs)


def assign_and_sort(spark, sf_dir):
    return ranking.rank_within_cluster(_assigned(spark, sf_dir)).select(
        "cluster_id", "rank", "id", _six("dist")
    )


# --- rank, filter, join ----------------------------------------------------


def rank_within_cluster(spark, sf_dir):
    return _label_ranked(spark, sf_dir, keep_hard=False).select(
        "cluster_id", "rank", "id", _six("dist")
    )


def _order(rule: str):
    def query(spark, sf_dir):
        return _label_ranked(spark, sf_dir, which_to_keep=rule).select("cluster_id", "rank", "id")

    return query


def cluster_slice(spark, sf_dir):
    ranked = _label_ranked(spark, sf_dir)
    return ranking.cluster_slice(ranked, 2, 5).select("cluster_id", "rank", "id")


def gather_vectors(spark, sf_dir):
    members = _label_ranked(spark, sf_dir).select("cluster_id", "rank", "id")
    gathered = ranking.gather_vectors(members, vectors(spark, sf_dir).drop("label"))
    return gathered.select(
        "cluster_id", "rank", "id", _vector_sum("embedding").alias("total")
    )


def cluster_sizes(spark, sf_dir):
    return ranking.cluster_sizes(by_label(spark, sf_dir))


def duplicate_ids(spark, sf_dir):
    """Documents of one language that share their whole text, as repeated external ids."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return pruning.duplicate_ids(
        docs.select(F.col("lang").alias("cluster_id"), F.md5("text").alias("id"))
    )


def resume_pending(spark, sf_dir):
    """Clusters of more than a tenth of all rows count as done; the rest is pending."""
    members = by_label(spark, sf_dir).select("cluster_id", "id")
    share = members.count() / 10
    done = ranking.cluster_sizes(members).where(F.col("cluster_size") > share)
    return pruning.pending_clusters(members, done)


# --- pruning ---------------------------------------------------------------


def pairs_within_cluster(spark, sf_dir):
    return statistics.pair_summary(by_label(spark, sf_dir)).select(
        "cluster_id", "n_pairs", _six("sum_sim"), _six("sum_sq_sim"), _six("max_sim"),
        _six("min_sim"),
    )


def max_prior_sim(spark, sf_dir):
    return _lang_prior(spark, sf_dir).select("lang", "id", _six("max_sim"))


def teammate(spark, sf_dir):
    return _label_prior(spark, sf_dir).select(
        "cluster_id", "id", _six("max_sim"), "mate_id", "mate_rank"
    )


def flag_long(spark, sf_dir):
    return pruning.flag_duplicates(_lang_prior(spark, sf_dir), DOC_EPS).select(
        "lang", "id", "eps", "is_dup"
    )


def flag_wide(spark, sf_dir):
    wide = pruning.flag_duplicates_wide(_label_prior(spark, sf_dir), WIDE_EPS)
    return wide.select(
        "cluster_id", "id", _six("max_sim"), "mate_id",
        *[F.col(f"`eps={eps_name(e)}`") for e in WIDE_EPS],
    )


#: Blocks small enough that the largest language takes several at every scale.
BOUNDED_BLOCK = 512


def flag_by_bounds(spark, sf_dir):
    return pruning.flags_by_bounds(
        documents(spark, sf_dir), DOC_EPS, ("lang",), ("id",), block_rows=BOUNDED_BLOCK
    ).select("lang", "id", "eps", "is_dup")


def singletons(spark, sf_dir):
    """Documents clustered by their length: many clusters of one, never flagged."""
    members = documents(spark, sf_dir).withColumnRenamed("n_chars", "cluster_id")
    prior = pairs.max_prior_similarity(members, ("cluster_id",), ("id",))
    sizes = ranking.cluster_sizes(members)
    return (
        prior.join(sizes, "cluster_id")
        .where(F.col("cluster_size") == 1)
        .select("cluster_id", "id", "max_sim", pruning.is_duplicate(0.07).alias("is_dup"))
    )


def flag_chunked(spark, sf_dir):
    prior = pruning.prune_clusters(
        _lang_ranked(spark, sf_dir), limit=DOC_CHUNK_LIMIT, cluster_col="lang"
    )
    return pruning.flag_duplicates(prior, DOC_EPS).select("lang", "chunk", "id", "eps", "is_dup")


def prune_given_centroids(spark, sf_dir):
    """Documents pruned end to end for given centroids: the mean of each language."""
    docs = documents(spark, sf_dir)
    code = F.ascii("lang") * 256 + F.ascii(F.substring("lang", 2, 1))
    coded = docs.withColumn("label", code)
    centroids = assignment.label_centroids(coded, "label")
    rows = prune_table(docs.select("id", "embedding"), centroids, PruneConfig())
    return extraction.retained_ratio(rows, DOC_EPS).select("eps", "n_kept", _six("retained_pct"))


def prune_table_rows(spark, sf_dir):
    """Prune rows of the embeddings for given centroids, with ranks and mates."""
    rows = vectors(spark, sf_dir)
    centroids = assignment.label_centroids(rows, "label")
    return prune_table(rows.drop("label"), centroids, PruneConfig()).select(
        "cluster_id", "id", "rank", _six("max_sim"), "mate_id", "mate_rank"
    )


def prune_invalid_vectors(spark, sf_dir):
    """The embeddings with null, zero and NaN vectors put in, pruned for given centroids."""
    rows = vectors(spark, sf_dir)
    centroids = assignment.label_centroids(rows, "label")
    vector = F.col("embedding").cast("array<double>")
    damaged = (
        F.when(F.col("id") % 7 == 3, F.lit(None).cast("array<double>"))
        .when(F.col("id") % 11 == 5, F.transform(vector, lambda x: F.lit(0.0)))
        .when(F.col("id") % 13 == 6, F.transform(vector, lambda x: F.lit(float("nan"))))
        .otherwise(vector)
    )
    pruned = prune_table(
        rows.select("id", damaged.alias("embedding")), centroids, PruneConfig()
    )
    return pruned.select("cluster_id", "id", "rank", _six("max_sim"), "mate_id")


def run_given_centroids(spark, sf_dir):
    """The run on files for given centroids, its prune table read back."""
    rows = vectors(spark, sf_dir)
    centroids = assignment.label_centroids(rows, "label")
    path = scratch_path(spark, "run")
    prune_vectors(
        rows.drop("label"), path, PruneConfig(), centroids=centroids, cluster_batches=2, buckets=4
    )
    return sources.read_prior(spark, f"{path}/prune_table").select(
        "cluster_id", "id", "rank", _six("max_sim"), "mate_id", "mate_rank"
    )


def run_with_statistics(spark, sf_dir):
    """Cluster statistics of a run on files, from the comparison that prunes."""
    rows = vectors(spark, sf_dir)
    centroids = assignment.label_centroids(rows, "label")
    path = scratch_path(spark, "run")
    config = PruneConfig(eps_list=WIDE_EPS, save_eps_list=WIDE_EPS)
    tables = prune_vectors(
        rows.drop("label"), path, config, centroids=centroids, with_stats=True, buckets=4
    )
    flagged = tables["eps_stats"].where(F.col("eps") == WIDE_EPS[-1])
    return (
        tables["cluster_stats"]
        .join(flagged.select("cluster_id", "num_duplicates"), "cluster_id")
        .select(
            "cluster_id", "cluster_size", "num_duplicates", _six("avg_sim_to_cent"),
            _six("std_sim_to_cent"), _six("std_pair_w_sim"), _six("max_sim"), _six("min_sim"),
        )
    )


# --- written and read back -------------------------------------------------


def assignment_round_trip(spark, sf_dir):
    path = scratch_path(spark, "assigned")
    sinks.write_assignment(_assigned(spark, sf_dir), path)
    return sources.read_assignment(spark, path).select("id", "cluster_id", _six("dist"))


def sorted_clusters_round_trip(spark, sf_dir):
    path = scratch_path(spark, "sorted")
    sinks.write_sorted_clusters(
        _label_ranked(spark, sf_dir).drop("embedding"), path, buckets=4
    )
    return sources.read_sorted_clusters(spark, path).select(
        "cluster_id", "rank", "id", _six("dist")
    )


def prune_table_round_trip(spark, sf_dir):
    path = scratch_path(spark, "flags")
    wide = pruning.flag_duplicates_wide(_label_prior(spark, sf_dir), WIDE_EPS)
    sinks.write_by_cluster(wide, path)
    return sources.read_prior(spark, path).select(
        "cluster_id", "id", _six("max_sim"), "mate_id",
        *[F.col(f"`eps={eps_name(e)}`") for e in WIDE_EPS],
    )


def stats_round_trip(spark, sf_dir):
    path = scratch_path(spark, "stats")
    members = statistics.member_similarity(by_label(spark, sf_dir))
    sinks.write_by_cluster(members, path, buckets=4)
    return spark.read.parquet(path).select("cluster_id", "id", _six("avg_sim_to_others"))


def kept_round_trip(spark, sf_dir):
    """Ids kept per threshold, written in folders and read threshold by threshold."""
    path = scratch_path(spark, "kept")
    sinks.write_kept(extraction.kept_ids(_lang_prior(spark, sf_dir), DOC_EPS), path, DOC_EPS)
    parts = [sources.read_kept(spark, path, e) for e in DOC_EPS]
    return reduce(DataFrame.union, parts)


def retained_round_trip(spark, sf_dir):
    path = scratch_path(spark, "retained")
    ratios = extraction.retained_ratio(_lang_prior(spark, sf_dir), DOC_EPS)
    sinks.write_retained(ratios, path, DOC_EPS)
    saved = spark.read.schema("eps string, n_kept long, retained_pct double").json(path)
    return saved.select(F.col("eps").cast("double"), "n_kept", _six("retained_pct"))


def pruned_corpus_lines(spark, sf_dir):
    """The pruned corpus per threshold: its lines numbered as they stand in the files.

    The corpus and what each threshold keeps of it lie on disk at once, all compressed.
    """
    source, path = scratch_path(spark, "corpus"), scratch_path(spark, "pruned")
    docs = brief_session(spark).read.parquet(f"{sf_dir}/documents.parquet")
    lines = docs.orderBy("doc_id").select(F.to_json(F.struct("doc_id", "text")))
    lines.write.options(**sinks.compressed_text("gzip")).text(source)
    number = F.get_json_object("value", "$.doc_id").cast("long")
    corpus = read_corpus(spark, source, with_split=True).withColumn("doc_id", number)
    prior = materialize(_lang_prior(spark, sf_dir), "prior")
    rows = extraction.filter_corpus_multi(corpus, prior, LINE_EPS, key="doc_id")
    ratios = extraction.retained_ratio(prior, LINE_EPS)
    sinks.write_pruned_corpus(
        rows, ratios, path, LINE_EPS, order_col="line_no", split_col="first_line",
        compression="gzip",
    )
    parts = [
        read_corpus(spark, f"{path}/eps={eps_name(e)}/*/*").select(
            F.lit(e).alias("eps"), "line_no", number.alias("doc_id")
        )
        for e in LINE_EPS
    ]
    return reduce(DataFrame.union, parts)


# --- statistics ------------------------------------------------------------


def avg_sim_to_others(spark, sf_dir):
    return statistics.member_similarity(by_label(spark, sf_dir)).select(
        "cluster_id", "id", _six("avg_sim_to_others")
    )


def minmax_sim(spark, sf_dir):
    return statistics.member_similarity(by_label(spark, sf_dir)).select(
        "cluster_id", "id", _six("max_pair_w_sim"), _six("min_pair_w_sim")
    )


def group_size(spark, sf_dir):
    """Similar-group size of every document within its language."""
    eps = (0.01, 0.03, 0.07)
    return statistics.member_similarity(documents(spark, sf_dir), ("lang",), eps).select(
        "lang", "id", *[F.col(f"`group_size_{eps_name(e)}`").alias(f"group_size_{i}")
                        for i, e in enumerate(eps)]
    )


def std_pair_sim(spark, sf_dir):
    return statistics.pair_summary(documents(spark, sf_dir), ("lang",)).select(
        "lang", "cluster_size", _six("std_pair_w_sim")
    )


def sim_to_centroid(spark, sf_dir):
    return statistics.centroid_similarity(_label_dist(spark, sf_dir)).select(
        "cluster_id", "cluster_size", _six("avg_sim_to_cent"), _six("std_sim_to_cent")
    )


def eps_cluster_stats(spark, sf_dir):
    stats = statistics.eps_cluster_stats(_lang_prior(spark, sf_dir), DOC_EPS, "lang")
    return stats.select("lang", "eps", "num_duplicates", _six("duplicates_ratio"))


def cluster_stats(spark, sf_dir):
    return statistics.cluster_stats(_label_dist(spark, sf_dir)).select(
        "cluster_id", "cluster_size", _six("avg_sim_to_cent"), _six("std_sim_to_cent"),
        _six("std_pair_w_sim"), _six("max_sim"), _six("min_sim"),
    )


def cluster_stats_chunked(spark, sf_dir):
    chunked = ranking.split_into_chunks(
        _label_ranked(spark, sf_dir), CHUNK_LIMIT // 10
    )
    return statistics.cluster_stats(chunked, chunk_col="chunk").select(
        "cluster_id", "cluster_size", _six("std_pair_w_sim"), _six("max_sim"), _six("min_sim")
    )


# --- extraction ------------------------------------------------------------


def kept_ids(spark, sf_dir):
    return extraction.kept_ids(_lang_prior(spark, sf_dir), DOC_EPS)


def removed_ids(spark, sf_dir):
    return extraction.removed_ids(_lang_prior(spark, sf_dir), DOC_EPS)


def retained_ratio(spark, sf_dir):
    return extraction.retained_ratio(_lang_prior(spark, sf_dir), DOC_EPS).select(
        "eps", "n_kept", _six("retained_pct")
    )


def output_label(spark, sf_dir):
    ratios = extraction.retained_ratio(_lang_prior(spark, sf_dir), DOC_EPS)
    return ratios.select("eps", extraction.ratio_label("retained_pct").alias("ratio"))


def filter_corpus(spark, sf_dir):
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    kept = extraction.kept_ids(_lang_prior(spark, sf_dir), DOC_EPS)
    return extraction.filter_corpus(corpus, kept, 0.05, key="doc_id")


def filter_corpus_multi(spark, sf_dir):
    corpus = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return extraction.filter_corpus_multi(
        corpus, _lang_prior(spark, sf_dir), DOC_EPS, key="doc_id"
    ).select("eps", "doc_id", F.md5("text").alias("text_md5"))


def table_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    named = [
        scan_vectors, vector_ids, raw_vectors_round_trip, fixed_width_ids_round_trip, corpus_lines,
        embed_hashed, normalize_vectors, last_token_pool,
        dist_cosine, dist_spherical, dist_l2,
        assign_ip, assign_l2, lloyd_2iter, kmeans_train, assign_and_sort,
        rank_within_cluster, cluster_slice, gather_vectors, cluster_sizes,
        duplicate_ids, resume_pending,
        pairs_within_cluster, max_prior_sim, teammate, flag_long, flag_wide,
        singletons, flag_chunked, prune_given_centroids, prune_table_rows,
        avg_sim_to_others, minmax_sim, group_size, std_pair_sim, sim_to_centroid,
        eps_cluster_stats, cluster_stats, cluster_stats_chunked,
        kept_ids, removed_ids, retained_ratio, output_label,
        filter_corpus, filter_corpus_multi,
        prune_invalid_vectors, run_given_centroids, kmeans_invariants,
        assignment_round_trip, sorted_clusters_round_trip, prune_table_round_trip,
        stats_round_trip, kept_round_trip, retained_round_trip, pruned_corpus_lines,
        flag_by_bounds, kmeans_two_level, last_token_pool_nested, saved_model_reused, metric_options, run_with_statistics,
    ]
    queries = {q.__name__: q for q in named}
    queries["l2_normalize"] = queries.pop("normalize_vectors")
    for rule in ("hard", "easy", "random"):
        queries[f"order_{rule}"] = _order(rule)
    return queries
