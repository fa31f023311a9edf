"""What the operators of this subpackage share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator
from contextlib import suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words: space and \t \n \v \f \r.
SPACE_CLASS = "\\x20\\x09-\\x0D"
#: Characters of text that one vectorised step inside a task works on.
STEP_CHARS = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(text: str | Column) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.coalesce(column.cast("string"), F.lit(""))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fresh_name(df: DataFrame, base: str) -> str:
    """A column name that ``df`` does not have, whatever columns a caller brings."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base


def held_out(id_col: str, folds: int, fold: int) -> Column:
    """Whether a row belongs to the fold kept from training; a null id always does."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(True))


def steps(sizes: Iterable[int], limit: int = STEP_CHARS) -> Iterator[tuple[int, int]]:
    """Slices of rows that sum up to ``limit`` or are one larger row."""
    start, total, i = 0, 0, -1
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield start, i
            start, total = i, 0
        total += n
    if i >= start:
        yield start, i + 1


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values (the finaliser of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def return_memory() -> None:
    """Hands free memory of this Python worker back to the system.

    Workers stay for later tasks; what allocators keep would add up beside the
    memory of the executor's JVM.
    """
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # other systems than glibc's do without
        ctypes.CDLL(None).malloc_trim(0)


def batches_of(batch: pa.RecordBatch, text_col: str) -> Iterator[pa.RecordBatch]:
    """A batch cut into parts of bounded text."""
    lengths = pc.binary_length(batch.column(text_col)).fill_null(0).to_pylist()
    for a, b in steps(lengths):
        yield batch.slice(a, b - a)
