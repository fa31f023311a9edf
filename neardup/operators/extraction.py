"""Kept and removed ids, retained ratios, and the corpus filtered by them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neardup.config import eps_name, validate_eps
from neardup.operators import bitmaps
from neardup.operators.pruning import flag_duplicates


def _ids(prior: DataFrame, eps_list, removed: bool, id_col: str, unique_ids: bool) -> DataFrame:
    """Several clusters may hold one id: it is kept as soon as one of them keeps it."""
    top = F.min("max_sim") if not removed else F.max("max_sim")
    one = prior if unique_ids else prior.groupBy(id_col).agg(top.alias("max_sim"))
    return flag_duplicates(one, eps_list).where(F.col("is_dup") == removed).select("eps", id_col)


def kept_ids(
    prior: DataFrame, eps_list, id_col: str = "id", unique_ids: bool = False
) -> DataFrame:
    """Distinct ``(eps, id)`` of the rows that survive each threshold.

    Where an id is known to occur once, ``unique_ids`` saves the shuffle.
    """
    return _ids(prior, eps_list, False, id_col, unique_ids)


def removed_ids(
    prior: DataFrame, eps_list, id_col: str = "id", unique_ids: bool = False
) -> DataFrame:
    """Distinct ``(eps, id)`` of the rows that are flagged at each threshold."""
    return _ids(prior, eps_list, True, id_col, unique_ids)


def retained_ratio(
    prior: DataFrame,
    eps_list,
    dataset_size: int | None = None,
    id_col: str = "id",
    unique_ids: bool = False,
) -> DataFrame:
    """``eps, n_kept, retained_pct``; the denominator is the number of ids by default."""
    eps_list = validate_eps(eps_list)
    one = prior if unique_ids else prior.groupBy(id_col).agg(F.min("max_sim").alias("max_sim"))
    counted = one.agg(
        F.count(F.lit(1)).alias("_n"),
        *[
            F.count_if(F.col("max_sim") <= F.lit(1 - e)).alias(f"_kept{i}")
            for i, e in enumerate(eps_list)
        ],
    )
    total = F.col("_n") if dataset_size is None else F.lit(dataset_size)
    rows = [
        F.struct(
            F.lit(e).alias("eps"),
            F.col(f"_kept{i}").alias("n_kept"),
            (F.lit(100.0) * F.col(f"_kept{i}") / total).alias("retained_pct"),
        )
        for i, e in enumerate(eps_list)
    ]
    return counted.select(F.inline(F.array(*rows)))


def ratio_label(retained_pct: str | Column) -> Column:
    """Retained fraction with two decimals, as output names carry it.

    ``format_number`` rounds the binary value itself, half to even.
    """
    pct = F.col(retained_pct) if isinstance(retained_pct, str) else retained_pct
    return F.format_number(pct / 100, 2)


def filter_corpus(
    corpus: DataFrame, kept: DataFrame, eps: float, key: str = "line_no", id_col: str = "id"
) -> DataFrame:
    """Corpus rows kept at one threshold; a partition of ``kept`` when it is on disk.

    Whole-number ids travel as bitmaps, and the rows of the corpus stay where they
    are; only bitmaps beyond the broadcast limit, or other ids, make it a join.
    """
    ids = kept.where(F.col("eps") == eps).select(F.col(id_col).alias(key))
    if bitmaps.holds_ids(corpus, key) and bitmaps.holds_ids(ids, key):
        found = bitmaps.small_bitmaps(bitmaps.id_bitmaps(ids, key, [F.lit(True)]), 1)
        if found is not None:
            chunk = bitmaps.chunk_of(F.col(key))
            joined = corpus.join(found, chunk == F.col("_chunk"), "left")
            within = bitmaps.contains(F.get("_sets", F.lit(0)), F.col(key))
            return joined.where(within).drop("_chunk", "_sets")
    return corpus.join(ids, key, "left_semi")


def removal_bitmaps(prior: DataFrame, eps_list, id_col: str = "id") -> DataFrame:
    """Bitmaps of the ids that no cluster keeps, one per threshold in the given order."""
    eps_list = validate_eps(eps_list)
    loosest = F.col(id_col).isNotNull() & (F.col("_max_sim") > F.lit(1.0) - F.lit(max(eps_list)))
    one = prior.groupBy(id_col).agg(F.min("max_sim").alias("_max_sim")).where(loosest)
    removed = [F.col("_max_sim") > F.lit(1.0) - F.lit(e) for e in eps_list]
    return bitmaps.id_bitmaps(one, id_col, removed)


def keep_by_bitmaps(corpus: DataFrame, removed: DataFrame, eps_list, key: str) -> DataFrame:
    """Corpus rows once per threshold whose bitmap does not remove them; one narrow stage.

    ``removed``: bitmaps to be broadcast. Rows keep their order.
    """
    joined = corpus.join(removed, bitmaps.chunk_of(F.col(key)) == F.col("_chunk"), "left")
    thresholds = F.array(*[F.lit(e) for e in validate_eps(eps_list)])
    keeping = F.filter(
        thresholds, lambda _, i: ~bitmaps.contains(F.get("_sets", i), F.col(key))
    )
    # Most chunks of a sparse prune table remove nothing.
    keeping = F.when(F.col("_sets").isNull(), thresholds).otherwise(keeping)
    return joined.withColumn("eps", F.explode(keeping)).drop("_chunk", "_sets")


def filter_corpus_multi(
    corpus: DataFrame,
    prior: DataFrame,
    eps_list,
    key: str = "line_no",
    id_col: str = "id",
    order_col: str | None = None,
) -> DataFrame:
    """Corpus rows once per threshold that keeps them, with ``eps``.

    Rows absent from ``prior`` (they had no vector) are kept. Whole-number ids
    travel as bitmaps, one per threshold and 32,768 ids; the texts are not
    shuffled, and rows keep their order. Beyond the broadcast limit, or for
    other ids, the corpus is joined once with one small row per id and expanded
    after the join, so texts are shuffled once however many thresholds there
    are. With ``order_col`` the rows are then range-partitioned by it, as they are
    for a corpus that is not in that order.
    """
    eps_list = validate_eps(eps_list)
    if order_col is None and bitmaps.holds_ids(corpus, key) and bitmaps.holds_ids(prior, id_col):
        removed = removal_bitmaps(prior, eps_list, id_col)
        found = bitmaps.small_bitmaps(removed, len(eps_list))
        if found is not None:
            return keep_by_bitmaps(corpus, found, eps_list, key)
    one = prior.groupBy(F.col(id_col).alias(key)).agg(F.min("max_sim").alias("_max_sim"))
    keeping = F.filter(
        F.array(*[F.lit(e) for e in eps_list]),
        lambda e: ~F.coalesce(F.col("_max_sim") > F.lit(1.0) - e, F.lit(False)),
    )
    joined = corpus.join(one, key, "left")
    if order_col is not None:
        joined = joined.repartitionByRange(order_col)
    return joined.withColumn("eps", F.explode(keeping)).drop("_max_sim")


def with_output_label(rows: DataFrame, ratios: DataFrame) -> DataFrame:
    """Add the partition labels ``eps`` (text) and ``ratio`` to rows that carry ``eps``.

    ``ratios`` holds one row per threshold.
    """
    labels = ratios.select("eps", ratio_label("retained_pct").alias("ratio"))
    return rows.join(F.broadcast(labels), "eps")


def eps_text(eps_list, eps_col: str = "eps") -> Column:
    """The threshold as text, exactly as the parameter was written."""
    out = F.col(eps_col).cast("string")
    for e in eps_list:
        out = F.when(F.col(eps_col) == F.lit(float(e)), F.lit(eps_name(e))).otherwise(out)
    return out
