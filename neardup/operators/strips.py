"""Block pairs of very large clusters, without sending a row to each of them.

A row that is sent to every block pair is stored once for each block of its cluster, so
that disk grows with the square of the cluster. Here rows move once: a cluster is sorted,
cut into blocks of consecutive rows, and each block is stored as one cell, a file of its
own. A strip is one block held against a share of the blocks of its cluster, read from
their files one after another by a task that keeps the results of the one block only. So
a row's results are stored once for each share, a few times however many blocks there are.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from neardup.session import fits_broadcast, materialize, scratch_scope, stage_path

# Blocks up to which the rows of a cluster are sent to each block pair by a shuffle.
SENT_BLOCKS = 4
# Shares into which the blocks of a cluster are cut, and blocks of one share at most.
_SHARES = 4
_SHARE_BLOCKS = 128
# Blocks that one task cuts; clusters compared by one job.
_BLOCKS_CUT = 4
_CLUSTERS_EACH = 32
# Of one file for each partition.
_SPLIT_BYTES = 1 << 30


def packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, table.schema, options=options) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def unpacked(cell: pa.Scalar) -> pa.Table:
    return pa.ipc.open_stream(cell.as_buffer()).read_all().combine_chunks()


def _cut_task(block_rows: int):
    """Task body: sorted rows become blocks, numbered in their order over all tasks."""

    def cut(batches):
        first = TaskContext.get().partitionId() << 32
        held, n, made, before = [], 0, 0, None

        def block() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held)
            key = rows["_key"][0].as_py()
            columns = [[key], [first + made], [packed(rows.drop_columns("_key"))]]
            types = [pa.int32(), pa.int64(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], ["_key", "_at", "_block"]
            )

        for batch in batches:
            if batch.num_rows == 0:
                continue
            names = np.stack([batch[c].to_numpy().astype(np.int64) for c in ("_key", "_f1", "_f2")])
            last = names[:, :1] - 1 if before is None else before
            changed = np.diff(np.concatenate([last, names], axis=1), axis=1) != 0
            before = names[:, -1:]
            # A row that repeats a whole row of the input stands next to it.
            batch = batch.filter(pa.array(changed.any(axis=0)))
            keys = batch["_key"].to_numpy()
            ends = np.append(np.flatnonzero(np.diff(keys)) + 1, len(keys))
            start = 0
            for end in ends.tolist():
                while start < end:
                    if held and (n == block_rows or held[0]["_key"][0].as_py() != keys[start]):
                        yield block()
                        held, n, made = [], 0, made + 1
                    some = batch.slice(start, min(end - start, block_rows - n))
                    held.append(some)
                    n, start = n + some.num_rows, start + some.num_rows
        if held:
            yield block()

    return cut


def _blocks(rows: DataFrame, sizes: DataFrame, by: list[str], order: list[str], block_rows: int):
    """The rows of the clusters of ``sizes`` as blocks, and how many each of these has."""
    spark = rows.sparkSession
    numbers = Window.orderBy(*by)
    listed = sizes.select(
        *[F.col(c).alias(f"_by_{c}") for c in by],
        (F.row_number().over(numbers) - 1).cast("int").alias("_key"),
        "_vectors",
    )
    listed = materialize(listed, "very-large-clusters")
    n, vectors = listed.agg(F.count(F.lit(1)), F.sum("_vectors")).first()
    numbered = listed.drop("_vectors")
    if fits_broadcast(n, 64 + 32 * len(by)):
        numbered = F.broadcast(numbered)
    own = rows.join(numbered, [F.col(c) == F.col(f"_by_{c}") for c in by])
    keys = ["_key", *order, "_f1", "_f2"]
    sorted_rows = (
        own.drop(*[f"_by_{c}" for c in by])
        .repartitionByRange(max(1, math.ceil(vectors / (_BLOCKS_CUT * block_rows))), *keys)
        .sortWithinPartitions(*keys)
    )
    path = stage_path(spark, "blocks")
    (
        sorted_rows.mapInArrow(_cut_task(block_rows), "_key int, _at long, _block binary")
        .write.option("maxRecordsPerFile", 1)
        .option("compression", "uncompressed")
        .option("parquet.enable.dictionary", "false")
        .partitionBy("_key")
        .parquet(path)
    )
    stored = spark.read.schema("_at long, _block binary, _key int").parquet(path)
    counts = stored.groupBy("_key").agg(F.count("_at").alias("n")).collect()
    return path, {r["_key"]: r.n for r in counts}


def _strip_session(spark: SparkSession) -> SparkSession:
    """A session in which a partition is one file, and one pair of blocks goes to a worker."""
    own = spark.newSession()
    own.conf.set("spark.sql.files.maxPartitionBytes", str(_SPLIT_BYTES))
    own.conf.set("spark.sql.files.openCostInBytes", str(_SPLIT_BYTES))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")
    return own


def _met(own: SparkSession, folder: str, blocks: int, earlier_only: bool) -> DataFrame:
    """Each block ``_right`` with every block ``_left``, or with those up to its place."""
    read = own.read.schema("_at long, _block binary")
    shares = max(_SHARES, math.ceil(blocks / _SHARE_BLOCKS))
    left = read.parquet(folder).coalesce(shares)
    left = left.select(F.col("_at").alias("_p"), F.col("_block").alias("_left"))
    right = read.parquet(folder).select(F.col("_at").alias("_q"), F.col("_block").alias("_right"))
    # A task holds the rows of one partition on the right, which is one block.
    met = F.col("_p") <= F.col("_q") if earlier_only else F.lit(True)
    return left.join(right.hint("shuffle_replicate_nl"), met)


def compared_in_strips(
    rows: DataFrame,
    sizes: DataFrame,
    by: list[str],
    order: list[str],
    block_rows: int,
    earlier_only: bool,
    task,
    schema,
) -> DataFrame:
    """What ``task`` leaves of the block pairs of the clusters of ``sizes``, stored.

    ``task`` gets the rows ``_p, _left, _q, _right`` of :func:`_met` one by one, those of a
    ``_q`` one after another but in no order of ``_p``. Blocks are numbered in ``order``.
    """
    spark = rows.sparkSession
    path = stage_path(spark, "strips")
    with scratch_scope(spark):
        folder, counts = _blocks(rows, sizes, by, order, block_rows)
        own = _strip_session(spark)
        keys = sorted(counts)
        for at in range(0, len(keys), _CLUSTERS_EACH):
            some = [
                _met(own, f"{folder}/_key={k}", counts[k], earlier_only).mapInArrow(task, schema)
                for k in keys[at : at + _CLUSTERS_EACH]
            ]
            reduce(DataFrame.union, some).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path) if counts else spark.createDataFrame([], schema)
