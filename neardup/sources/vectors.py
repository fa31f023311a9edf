"""Vector tables and headerless fixed-length record files."""

from __future__ import annotations

from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neardup.session import hadoop_path

#: Bytes of records that follow each other and travel as one row.
RUN_BYTES = 1 << 20
_FORMAT = "org.apache.spark.input.FixedLengthBinaryInputFormat"


def read_vectors(
    spark: SparkSession,
    path: str,
    id_col: str = "id",
    vector_col: str = "embedding",
    extra: tuple[str, ...] = (),
) -> DataFrame:
    """``id, embedding`` of a parquet table; only the named columns are scanned."""
    return spark.read.parquet(path).select(
        F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("embedding"), *extra
    )


def numbered_ids(vectors: DataFrame, path_col: str | None = None) -> DataFrame:
    """``id, path``: the external name of each row, its own number by default."""
    path = F.col(path_col) if path_col else F.col("id")
    return vectors.select("id", path.cast("string").alias("path"))


def _files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Path and bytes of the files that ``path`` names, in path order."""
    fs, target = hadoop_path(spark, path)
    found = fs.globStatus(target) or []
    files = []
    for status in found:
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        files += [x for x in inside if x.isFile() and x.getPath().getName()[0] not in "._"]
    if not files:
        raise FileNotFoundError(path)
    return sorted((x.getPath().toString(), x.getLen()) for x in files)


def _runs(width: int, before: int):
    """Joins records that follow each other into runs that start with their number."""

    def run(records):
        while some := list(islice(records, max(1, RUN_BYTES // width))):
            yield before + some[0][0], b"".join([record for _, record in some])

    return run


def _record_runs(spark: SparkSession, path: str, width: int) -> DataFrame:
    """``first, records``: runs of fixed-length records and the number of the first.

    Spark's input format cuts files between records and numbers the records of a
    file; what earlier files hold follows from their sizes. Nothing is counted.
    """
    before, parts = 0, []
    for file, size in _files(spark, path):
        if size % width:
            raise ValueError(f"{file} has {size} bytes, which are no records of {width}")
        if size:
            numbered = spark.sparkContext.newAPIHadoopFile(
                file,
                _FORMAT,
                "org.apache.hadoop.io.LongWritable",
                "org.apache.hadoop.io.BytesWritable",
                conf={f"{_FORMAT}.recordLength": str(width)},
            )
            parts.append(numbered.mapPartitions(_runs(width, before)))
        before += size // width
    schema = "first long, records binary"
    if not parts:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame(spark.sparkContext.union(parts), schema)


def _numbers(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, bytes]:
    """The numbers of all records of some runs, and the records."""
    firsts = batch.column(0).to_numpy()
    records = batch.column(1).to_pylist()
    sizes = np.array([len(r) // width for r in records], dtype=np.int64)
    within = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(firsts, sizes) + within, b"".join(records)


def read_raw_vectors(spark: SparkSession, path: str, dim: int) -> DataFrame:
    """Headerless little-endian float32 ``[N, dim]``; ``id`` is the row number."""

    def decode(batches):
        for batch in batches:
            ids, raw = _numbers(batch, 4 * dim)
            values = np.frombuffer(raw, dtype="<f4").astype(np.float32, copy=False)
            offsets = np.arange(0, len(values) + 1, dim, dtype=np.int32)
            vectors = pa.ListArray.from_arrays(offsets, pa.array(values))
            yield pa.RecordBatch.from_arrays([pa.array(ids), vectors], ["id", "embedding"])

    return _record_runs(spark, path, 4 * dim).mapInArrow(decode, "id long, embedding array<float>")


def read_fixed_width_ids(spark: SparkSession, path: str, width: int) -> DataFrame:
    """``id, path`` from fixed-width byte strings padded with NUL."""

    def decode(batches):
        for batch in batches:
            ids, raw = _numbers(batch, width)
            # NumPy's strings of fixed width leave out the padding.
            names = np.frombuffer(raw, dtype=f"S{width}").tolist()
            columns = [pa.array(ids), pa.array(names, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "path"])

    found = _record_runs(spark, path, width).mapInArrow(decode, "id long, path binary")
    return found.select("id", F.decode("path", "UTF-8").alias("path"))
