"""Blocks of near vectors, and bounds that prove block pairs irrelevant above a threshold.

Where only similarities above a threshold count, a large cluster is cut by pivots
instead of a hash: every row belongs to the cell of its nearest pivot, and a cell
knows its largest distance to the pivot (radius) and its longest vector. For a row
x and any y of a cell with pivot q, radius r and length l

    x . y = (|x|^2 + |y|^2 - |x - y|^2) / 2 <= (|x|^2 + l^2 - max(0, |x - q| - r)^2) / 2

so x is sent to those cells only for which the right side exceeds the threshold. A
pair above it is always met, since each of its rows reaches the cell of the other.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from neardup.config import BLOCK_ROWS, MAX_BROADCAST_BYTES
from neardup.operators.arrow_blocks import matrix
from neardup.operators.strips import SENT_BLOCKS
from neardup.session import fits_broadcast

# Pivots of one cluster at most; below that, one for each block of rows it fills.
CELLS = 256
# Rows drawn by hash for each pivot wanted, before the lowest hashes are taken.
_DRAWN = 4
_HASHES = 1 << 40
# Share of the squared lengths by which a bound must miss the threshold: far more
# than the rounding of distances.
_SLACK = 1e-7
# Blocks a row is sent to on an average, above which blocks are made larger.
_SENT = 16
# Share of its cluster's blocks that a row meets, above which cells leave out too little.
_WORTH = 0.5

_CELL = "struct<cell:int,gap:double,length:double>"
_PLACE = "struct<b:int,reached:array<struct<first:int,last:int>>>"


@dataclass
class _Cells:
    """Pivots of one cluster with the measures of their cells, their numbers of blocks and rows."""

    pivots: np.ndarray
    radius: np.ndarray
    length: np.ndarray
    blocks: np.ndarray
    rows: np.ndarray

    def distances(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Squared length of every row, and its distance to every pivot."""
        squares = np.einsum("ij,ij->i", rows, rows)
        own = np.einsum("ij,ij->i", self.pivots, self.pivots)
        far = squares[:, None] + own - 2 * (rows @ self.pivots.T)
        return squares, np.sqrt(np.maximum(far, 0))

    def reached(self, squares: np.ndarray, far: np.ndarray, above: float) -> np.ndarray:
        """Whether a row may be more similar than ``above`` to a row of a cell."""
        apart = np.maximum(far - self.radius, 0)
        both = squares[:, None] + self.length**2
        return ((both * (1 + _SLACK) - apart * apart) / 2 > above) & (self.blocks > 0)


def _by_cluster(keys: pa.Array, vectors: pa.Array):
    """Row positions and matrix of each cluster of a batch that has pivots."""
    of = keys.fill_null(0).to_numpy(zero_copy_only=False)
    cut = np.flatnonzero(keys.is_valid().to_numpy(zero_copy_only=False))
    cut = cut[np.argsort(of[cut], kind="stable")]
    for at in np.split(cut, np.flatnonzero(np.diff(of[cut])) + 1):
        if len(at):
            yield int(of[at[0]]), at, matrix(vectors.take(pa.array(at)))


def _measure_udf(cells_bc):
    @F.arrow_udf(_CELL)
    def measure(keys: pa.Array, vectors: pa.Array) -> pa.Array:
        cell = np.zeros(len(keys), dtype=np.int32)
        gap, length = np.zeros(len(keys)), np.zeros(len(keys))
        for key, at, rows in _by_cluster(keys, vectors):
            squares, far = cells_bc.value[key].distances(rows)
            cell[at] = far.argmin(axis=1)
            gap[at], length[at] = far.min(axis=1), np.sqrt(squares)
        return pa.StructArray.from_arrays(
            [pa.array(cell), pa.array(gap), pa.array(length)], ["cell", "gap", "length"]
        )

    return measure.asNondeterministic()


def _fewer_blocks(cells: _Cells, sent: float, block_rows: int, full_rows: int) -> _Cells:
    """The cells, in larger blocks if a row is sent to very many: ``sent`` on an average.

    Where that is most of the cluster, it becomes one cell, of which every row reaches
    each block.
    """
    if sent <= _SENT or full_rows <= block_rows:
        return cells
    if sent <= _WORTH * cells.blocks.sum():
        larger = min(full_rows, block_rows * math.ceil(sent / _SENT))
        return replace(cells, blocks=-(-cells.rows // larger))
    far, n = np.full(1, np.inf), cells.rows.sum(keepdims=True)
    return _Cells(np.zeros((1, cells.pivots.shape[1])), far, far, -(-n // full_rows), n)


def _met_udf(cells_bc, above: float):
    @F.arrow_udf("long")
    def met(keys: pa.Array, vectors: pa.Array) -> pa.Array:
        """Blocks of all cells that a row reaches."""
        out = np.zeros(len(keys), dtype=np.int64)
        for key, at, rows in _by_cluster(keys, vectors):
            cells = cells_bc.value[key]
            squares, far = cells.distances(rows)
            out[at] = cells.reached(squares, far, above) @ cells.blocks
        return pa.array(out)

    return met.asNondeterministic()


def _place_udf(cells_bc, above: float):
    @F.arrow_udf(_PLACE)
    def place(keys: pa.Array, vectors: pa.Array, hashes: pa.Array) -> pa.Array:
        block = np.zeros(len(keys), dtype=np.int32)
        # A cluster of one block: the row meets block 0 only.
        row, first = [np.flatnonzero(keys.is_null().to_numpy(zero_copy_only=False))], []
        first.append(np.zeros(len(row[0]), dtype=np.int32))
        last = [first[0]]
        hashed = hashes.to_numpy(zero_copy_only=False)
        for key, at, rows in _by_cluster(keys, vectors):
            cells = cells_bc.value[key]
            squares, far = cells.distances(rows)
            own = far.argmin(axis=1)
            start = np.cumsum(cells.blocks) - cells.blocks
            block[at] = start[own] + hashed[at] % np.maximum(cells.blocks[own], 1)
            met = cells.reached(squares, far, above)
            met[np.arange(len(at)), own] = True
            i, cell = np.nonzero(met)
            row.append(at[i])
            first.append(start[cell])
            last.append(start[cell] + np.maximum(cells.blocks[cell], 1) - 1)
        row = np.concatenate(row)
        order = np.argsort(row, kind="stable")
        ends = np.cumsum(np.bincount(row, minlength=len(keys)))
        spans = [
            pa.array(np.concatenate(x)[order].astype(np.int32)) for x in (first, last)
        ]
        reached = pa.ListArray.from_arrays(
            pa.array(np.concatenate([[0], ends]).astype(np.int32)),
            pa.StructArray.from_arrays(spans, ["first", "last"]),
        )
        return pa.StructArray.from_arrays([pa.array(block), reached], ["b", "reached"])

    return place.asNondeterministic()


def _pivots(rows: DataFrame, block_rows: int, cells: int) -> dict[int, np.ndarray]:
    """Vectors of lowest hash of the large clusters; their number is bounded by ``cells``."""
    wanted = F.least(F.lit(cells), F.ceil(F.col("_vectors") / F.lit(block_rows)))
    # Few rows of each cluster pass, so that the window sorts bounded groups.
    share = F.lit(float(_DRAWN * _HASHES)) * wanted / F.col("_vectors")
    drawn = rows.where("_key is not null").withColumn(
        "_h", F.pmod(F.xxhash64(F.lit(7), "_f1", "_f2"), F.lit(_HASHES))
    )
    lowest = Window.partitionBy("_key").orderBy("_h", "_f1", "_f2")
    table = (
        drawn.where(F.col("_h") < share)
        .withColumn("_at", F.row_number().over(lowest))
        .where(F.col("_at") <= wanted)
        .select("_key", "_v")
        .toArrow()
    )
    keys = table["_key"].to_numpy()
    return {
        int(k): matrix(table["_v"].take(pa.array(np.flatnonzero(keys == k))))
        for k in np.unique(keys)
    }


def near_block_pairs(
    distinct: DataFrame,
    sizes: DataFrame,
    large_clusters: int,
    by: list[str],
    block_rows: int,
    above: float,
    cells: int = CELLS,
    max_bytes: int = MAX_BROADCAST_BYTES,
    full_rows: int = BLOCK_ROWS,
    strips: bool = False,
) -> tuple[DataFrame, int, list[int]] | None:
    """Rows with their block ``_b`` and each block ``_other`` that they must meet,
    about how many pairs of blocks of the large clusters meet, and, with ``strips``, the
    hashes of clusters that are left out since their rows would be sent to too many blocks.

    None where the pivots of all large clusters would exceed ``max_bytes`` at two
    each: more ``cluster_batches`` make room. Vectors are read up to four times (pivots,
    measures, what is reached, blocks) and not moved.

    A row is sent once for each block that it must meet. Where these are very many, blocks
    have up to ``full_rows`` rows; where they are most of the cluster, cells would leave
    out nothing, and it is cut by the hash alone.
    """
    dim = distinct.select(F.size("_v").alias("n")).first()
    cells = min(cells, max_bytes // (8 * max(dim.n if dim else 1, 1) * large_clusters))
    if cells < 2:
        return None
    large = sizes.where(F.col("_vectors") > block_rows).select(
        *[F.col(c).alias(f"_by_{c}") for c in by], "_vectors"
    )
    if fits_broadcast(large_clusters, 64 + 32 * len(by)):
        large = F.broadcast(large)
    rows = distinct.join(large, [F.col(c) == F.col(f"_by_{c}") for c in by], "left").withColumn(
        "_key", F.when(F.col("_vectors").isNotNull(), F.xxhash64(*by))
    )
    sc = distinct.sparkSession.sparkContext
    keys = large.select(F.xxhash64(*[f"_by_{c}" for c in by]).alias("k")).toArrow()["k"].to_pylist()
    # A cluster of which the hash drew nothing is one cell, around the origin.
    pivots = dict.fromkeys(keys, np.zeros((1, dim.n))) | _pivots(rows, block_rows, cells)
    bare = {k: _Cells(p, *[np.zeros(len(p))] * 4) for k, p in pivots.items()}
    measure = _measure_udf(sc.broadcast(bare))
    measured = (
        rows.where("_key is not null")
        .select("_key", measure("_key", "_v").alias("m"))
        .groupBy("_key", "m.cell")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.max("m.gap").alias("radius"),
            F.max("m.length").alias("length"),
        )
        .toArrow()
    )
    full = {
        k: _Cells(
            p, *[np.zeros(len(p)) for _ in range(2)], *[np.zeros(len(p), np.int64) for _ in range(2)]
        )
        for k, p in pivots.items()
    }
    for m in measured.to_pylist():
        of = full[m["_key"]]
        of.radius[m["cell"]], of.length[m["cell"]] = m["radius"], m["length"]
        of.rows[m["cell"]] = m["n"]
        of.blocks[m["cell"]] = -(-m["n"] // block_rows)
    met = _met_udf(sc.broadcast(full), above)
    reached = (
        rows.where("_key is not null")
        .select("_key", met("_key", "_v").alias("met"))
        .groupBy("_key")
        .agg(F.sum("met").alias("met"))
        .toArrow()
    )
    pairs, left_out = 0, []
    for m in reached.to_pylist():
        of = full[m["_key"]]
        sent = m["met"] / of.rows.sum()
        share = sent / of.blocks.sum()
        of = full[m["_key"]] = _fewer_blocks(of, sent, block_rows, full_rows)
        n = int(of.blocks.sum())
        by_hash = bool(np.isinf(of.radius).all())
        if strips and (n > SENT_BLOCKS if by_hash else share * n > _SENT):
            left_out.append(m["_key"])
        else:
            pairs += n + math.ceil(share * n * (n - 1) / 2)
    if left_out:
        rows = rows.where(F.col("_key").isNull() | ~F.col("_key").isin(left_out))
    place = _place_udf(sc.broadcast(full), above)
    near = (
        rows.withColumn("_place", place("_key", "_v", "_f1"))
        .withColumn("_b", F.col("_place.b"))
        .withColumn("_span", F.explode("_place.reached"))
        .withColumn("_other", F.explode(F.sequence("_span.first", "_span.last")))
        .drop("_place", "_span", "_key", "_vectors", *[f"_by_{c}" for c in by])
    )
    return near, pairs, left_out


def near_blocks(*args, **options) -> DataFrame | None:
    """The rows of :func:`near_block_pairs` alone."""
    found = near_block_pairs(*args, **options)
    return None if found is None else found[0]
