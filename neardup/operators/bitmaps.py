"""Sets of ids as bitmaps, so that a filter by id leaves the filtered rows where they are.

One bitmap holds 32,768 consecutive ids. Bitmaps are aggregated from narrow rows
and looked up by broadcast; beyond the limit of a broadcast the caller takes
ranges of ids one after another, or joins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from neardup.config import MAX_BROADCAST_BYTES
from neardup.session import materialize

#: Fixed by Spark's bitmap functions.
IDS_EACH = 32_768
_BYTES_EACH = IDS_EACH // 8 + 128


def holds_ids(df: DataFrame, column: str) -> bool:
    """Whether a column can be the place of a bit."""
    return isinstance(df.schema[column].dataType, (T.LongType, T.IntegerType, T.ShortType))


def chunk_of(value: Column) -> Column:
    return F.shiftright(value.cast("long"), 15)


def _position(value: Column) -> Column:
    return value.cast("long").bitwiseAND(IDS_EACH - 1)


def id_bitmaps(rows: DataFrame, id_col: str, members: list[Column]) -> DataFrame:
    """``_chunk, _sets``: for each chunk of ids a bitmap per condition of ``members``."""
    at = rows.select(
        chunk_of(F.col(id_col)).alias("_chunk"),
        _position(F.col(id_col)).alias("_at"),
        *[m.alias(f"_in{i}") for i, m in enumerate(members)],
    ).where("_chunk is not null")
    made = [
        F.expr(f"bitmap_construct_agg(_at) filter (where _in{i})").alias(f"_set{i}")
        for i in range(len(members))
    ]
    grouped = at.groupBy("_chunk").agg(*made)
    return grouped.select("_chunk", F.array(*[f"_set{i}" for i in range(len(members))]).alias("_sets"))


def contains(bitmap: Column, value: Column) -> Column:
    """Whether the bit of an id is set in the bitmap of its chunk; false without a bitmap."""
    at = _position(value)
    byte = F.substring(bitmap, F.shiftright(at, 3).cast("int") + 1, F.lit(1))
    bits = F.conv(F.hex(byte), 16, 10).cast("int")
    # The bit's value in its byte, lowest first.
    own = F.get(F.array(*[F.lit(1 << k) for k in range(8)]), at.bitwiseAND(7).cast("int"))
    bit = bits.bitwiseAND(own)
    return F.coalesce(bit != 0, F.lit(False))


def chunks_that_fit(n_sets: int) -> int:
    return max(1, MAX_BROADCAST_BYTES // (n_sets * _BYTES_EACH))


def small_bitmaps(bitmaps: DataFrame, n_sets: int) -> DataFrame | None:
    """The bitmaps with a broadcast hint if their counted size fits the limit, else None."""
    stored = materialize(bitmaps, "id-bitmaps")
    return F.broadcast(stored) if stored.count() <= chunks_that_fit(n_sets) else None
