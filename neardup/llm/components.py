"""Connected components of a table of links.

Alternates two star operations (each node hands its smallest neighbour to its
larger neighbours, then to itself and its smaller ones) until the links form
stars around the smallest node of each component. Every step is one
aggregation and one join on narrow rows; the minima are stored tables, so that
a hub with very many links is split by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neardup.session import materialize

MAX_ROUNDS = 100


def _sum_of(links: DataFrame) -> tuple:
    return tuple(
        links.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first()
    )


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` of every node of a link; the component is its smallest node."""
    links = materialize(
        edges.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "links",
    )
    state = _sum_of(links)
    for _ in range(MAX_ROUNDS):
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        smallest = both.groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
        smallest = materialize(smallest, "smallest")
        # Large star: neighbours larger than the node itself.
        large = both.where("v > u").join(smallest, "u").select(F.col("v").alias("u"), "m")
        large = materialize(large.withColumnRenamed("m", "v").distinct(), "large-star")
        smallest = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "smallest")
        # Small star: the node and its smaller neighbours.
        small = large.join(smallest, "u").where("v > m").select(F.col("v").alias("u"), "m")
        small = small.unionByName(smallest).withColumnRenamed("m", "v").distinct()
        links = materialize(small, "small-star")
        before, state = state, _sum_of(links)
        if state == before:
            break
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    roots = links.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
