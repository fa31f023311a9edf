"""Joins in which one key may hold a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neardup.config import HOT_COPIES
from neardup.session import fits_broadcast


def hot_keys(rows: DataFrame, keys: list[str], limit: int = HOT_COPIES) -> DataFrame | None:
    """Keys with more than ``limit`` rows and the number of ``_salts`` to spread them over.

    At most rows / limit keys; counted before they are broadcast. None if there
    are none.
    """
    hot = (
        rows.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > limit)
        .select(*keys, F.ceil(F.col("_n") / F.lit(limit)).alias("_salts"))
    )
    n = hot.count()
    if n == 0:
        return None
    return F.broadcast(hot) if fits_broadcast(n, 64 + 32 * len(keys)) else hot


def salted_left_join(
    left: DataFrame, right: DataFrame, keys: list[str], hot: DataFrame | None, spread_by: str
) -> DataFrame:
    """Left join on ``keys``, of which ``right`` has one row each.

    The rows of a hot key are spread over its salts by a hash of ``spread_by``;
    the one row of the other side is repeated for each salt.
    """
    if hot is None:
        return left.join(right, keys, "left")
    salts = F.coalesce("_salts", F.lit(1).cast("long"))
    left = left.join(hot, keys, "left").withColumn("_salt", F.pmod(F.xxhash64(spread_by), salts))
    right = right.join(hot, keys, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))
    )
    joined = left.drop("_salts").join(right.drop("_salts"), [*keys, "_salt"], "left")
    return joined.drop("_salt")
