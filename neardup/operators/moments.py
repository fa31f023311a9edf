"""Sums over all pairs of a cluster, without a look at the pairs.

The products of every row with every row of a cluster, itself included, sum up to the
squared length of the sum of its vectors, and their squares to the sum of the squared
entries of the sum of its outer products. What a row has with itself is taken away. A
cluster is cut into groups of rows; a vector moves once, and what a group leaves has the
size of one outer product and merges by ordinary aggregation.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from neardup.operators.arrow_blocks import matrix
from neardup.operators.pairs import ClusterPairs
from neardup.session import fits_broadcast

# Rows of one group: many to one outer product, few enough to spread a hot cluster.
GROUP_ROWS = 4096

# Kinds of sums: rows, squared lengths, their squares, entries of vectors and of outer products.
_ROWS, _OWN, _OWN_SQUARES, _VECTOR, _OUTER = range(5)


def _sums(rows: np.ndarray, whole: bool) -> dict[int, np.ndarray]:
    """Sums of a group by kind; of a ``whole`` cluster lengths in place of entries."""
    n, dim = rows.shape
    own = np.einsum("ij,ij->i", rows, rows)
    vector = rows.sum(axis=0)
    if whole:
        # Both products have the same length.
        outer = rows @ rows.T if n < dim else rows.T @ rows
        vector, outer = [np.linalg.norm(vector)], [np.linalg.norm(outer)]
    else:
        # Squares of the entries beside the diagonal count twice.
        i, j = np.triu_indices(dim)
        outer = (rows.T @ rows)[i, j] * np.where(i == j, 1.0, math.sqrt(2.0))
    sums = {_ROWS: [n], _OWN: [own.sum()], _OWN_SQUARES: [own @ own], _VECTOR: vector, _OUTER: outer}
    return {kind: np.asarray(values, dtype=np.float64) for kind, values in sums.items()}


def _group_task(by: list[str], schema: pa.Schema):
    def run(key: tuple, table: pa.Table) -> pa.Table:
        rows = matrix(table["_v"])
        sums = _sums(rows, key[-2].as_py() == 1)
        n = sum(len(values) for values in sums.values())
        columns = {c: [key[i].as_py()] * n for i, c in enumerate(by)}
        columns |= {
            "_kind": np.concatenate([np.full(len(v), kind) for kind, v in sums.items()]),
            "_place": np.concatenate([np.arange(len(v)) for v in sums.values()]),
            "_value": np.concatenate(list(sums.values())),
            "_dim": np.full(n, rows.shape[1]),
        }
        return pa.table(columns).select(schema.names).cast(schema)

    return run


def pair_sums(pairs: ClusterPairs, group_rows: int = GROUP_ROWS) -> DataFrame:
    """Per cluster: its rows ``_rows``, and over its ordered pairs of two rows the sum
    ``_s`` and the sum of squares ``_q`` of their similarities.

    Takes the rows of a comparison and does not run it.
    """
    by, shape = pairs.by, pairs.shape
    # Only clusters of several groups are looked up.
    groups = shape.sizes.where(F.col("_rows") > group_rows).select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        F.ceil(F.col("_rows") / F.lit(group_rows)).cast("int").alias("_groups"),
    )
    if fits_broadcast(shape.clusters, 64 + 32 * len(by)):
        groups = F.broadcast(groups)
    known = pairs.rows.where(F.expr(" and ".join(f"`{c}` is not null" for c in by)))
    dealt = (
        known.join(groups, [F.col(c) == F.col(f"_by_{c}") for c in by], "left")
        .withColumn("_groups", F.coalesce("_groups", F.lit(1)))
        .withColumn("_group", F.pmod(F.xxhash64("_id"), F.col("_groups").cast("long")))
        .select(*by, "_groups", "_group", "_v")
    )
    schema = T.StructType(
        [T.StructField(c, pairs.rows.schema[c].dataType) for c in by]
        + [T.StructField(c, T.IntegerType()) for c in ("_kind", "_place", "_dim")]
        + [T.StructField("_value", T.DoubleType())]
    )
    task = _group_task(by, to_arrow_schema(schema))
    entries = dealt.groupBy(*by, "_groups", "_group").applyInArrow(task, schema)
    merged = entries.groupBy(*by, "_kind", "_place").agg(
        F.sum("_value").alias("_value"), F.min("_dim").alias("_least"), F.max("_dim").alias("_most")
    )

    def total(kind: int, value):
        return F.sum(F.when(F.col("_kind") == kind, value))

    value = F.col("_value")
    mixed = F.min("_least") != F.max("_most")
    return merged.groupBy(*by).agg(
        F.when(mixed, F.raise_error("vectors of different dimensions in one cluster"))
        .otherwise(total(_ROWS, value).cast("long"))
        .alias("_rows"),
        (total(_VECTOR, value * value) - total(_OWN, value)).alias("_s"),
        (total(_OUTER, value * value) - total(_OWN_SQUARES, value)).alias("_q"),
    )
