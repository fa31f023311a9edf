"""All-pairs similarity inside clusters, reduced per row and never listed pair by pair.

A cluster of n distinct vectors is hashed into G = ceil(n / block_rows) blocks
and every row is sent to the G block pairs it takes part in. A block pair is
one group of about two blocks at most: its similarities are one matrix
product, and only a per-row reduction (a maximum, or sums) leaves the task.
Maxima and sums merge by ordinary aggregation, so a cluster of any size is
exact, bounded in memory and spread over G * (G + 1) / 2 groups.

Exact copies would make that quadratic work pointless: a cluster in which one
vector occurs a million times is first reduced to its distinct vectors, each
with its first and last place in the cluster order and its multiplicity. That is
found on narrow rows; the vectors themselves move once, to their block pairs.
"""

from __future__ import annotations

import math
from copy import copy
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from neardup.config import BLOCK_ROWS, HOT_COPIES, SIM_DECIMALS
from neardup.operators.arrow_blocks import matrix
from neardup.operators.bounds import CELLS, near_block_pairs
from neardup.operators.skew import salted_left_join
from neardup.operators.strips import SENT_BLOCKS, compared_in_strips, unpacked
from neardup.session import fits_broadcast, materialize, path_exists

# Side of the square of similarities held at once inside a task.
_TILE = 1024
# Full block pairs one task should work through, and a bound on the tasks.
_PAIRS_PER_TASK = 1
_MAX_PARTITIONS = 100_000
# Two similarities closer than this are equal at SIM_DECIMALS.
_HALF = 0.5 * 10.0**-SIM_DECIMALS
# Entries of a column near its maximum, up to which they are computed one by one.
_FEW = 32
# Share of a tile above a threshold, up to which its entries are counted one by one.
_SPARSE = 0.02

# Kinds of rows a block pair emits.
_BEFORE, _COPY, _BETWEEN, _SUMS = 0, 1, 2, 3

COPY_KEYS = ("copy_key_0", "copy_key_1")


def copy_keys(vector_col: str = "embedding") -> list[Column]:
    """128-bit key that equal vectors share; NULL for one that is null or not finite.

    A table that stores it as ``copy_key_0, copy_key_1`` saves the pair join a
    second scan of its vectors. Vectors of floats and of doubles have equal keys.
    """
    v = F.col(vector_col).cast("array<double>")
    usable = _is_finite(vector_col)
    return [
        F.when(usable, key).alias(name)
        for key, name in zip((F.xxhash64(v), F.xxhash64(F.lit(1), v)), COPY_KEYS)
    ]


def _is_finite(vector_col: str) -> Column:
    """Whether a vector is there and finite; NULL if it is null or empty."""
    v, infinite = F.col(vector_col), F.lit(float("inf"))
    # NaN sorts above infinity.
    return (F.array_max(v) < infinite) & (F.array_min(v) > -infinite)


# --- preparation -----------------------------------------------------------


def _own_keys(id_col: str) -> list[Column]:
    return [F.xxhash64(id_col), F.xxhash64(F.lit(1), F.col(id_col))]


def _keyed_members(members, by, id_col, vector_col, order, collapse_copies) -> DataFrame:
    """Common columns but the vector: the keys, ``_id``, copy key ``_f1, _f2``, order ``_o0...``.

    ``_usable``: whether a row has a vector to compare. The others get a key of their
    own, since the one of NULL could be shared by a large part of a cluster. Of a table
    that stores the copy key the vectors are not read.
    """
    own = _own_keys(id_col)
    if set(COPY_KEYS) <= set(members.columns):
        stored = [F.col(c) for c in COPY_KEYS]
    else:
        stored = copy_keys(vector_col)
    keys = [F.coalesce(k, o) for k, o in zip(stored, own)] if collapse_copies else own
    return members.select(
        *by,
        F.col(id_col).alias("_id"),
        stored[0].isNotNull().alias("_usable"),
        keys[0].alias("_f1"),
        keys[1].alias("_f2"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
    )


def _keyed_vectors(members, by, id_col, vector_col, order, collapse_copies) -> DataFrame:
    """The rows with a vector ``_v``; their key follows from it, whether it is stored or not."""
    keys = copy_keys(vector_col) if collapse_copies else _own_keys(id_col)
    return members.where(_is_finite(vector_col)).select(
        *by,
        F.col(id_col).alias("_id"),
        F.col(vector_col).alias("_v"),
        keys[0].alias("_f1"),
        keys[1].alias("_f2"),
        *[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
    )


def _copy_groups(keyed: DataFrame, by: list[str], orders: list[str]) -> DataFrame:
    """One narrow row per distinct vector of a cluster, without the vector.

    ``_first, _last``: order and id of its first and last occurrence; ``_n``: how
    often it occurs. Copies merge before the shuffle.
    """
    place = F.struct(*orders, "_id")
    return keyed.where("_usable").groupBy(*by, "_f1", "_f2").agg(
        F.count(F.lit(1)).alias("_n"), F.min(place).alias("_first"), F.max(place).alias("_last")
    )


def _first_occurrences(
    rows: DataFrame, groups: DataFrame, shape: Shape, by: list[str], orders: list[str]
) -> DataFrame:
    """The rows at which a vector occurs first, with its last place and count.

    Vectors stay where they are: each row is held against the groups of several
    rows only, by broadcast while these fit.
    """
    if shape.repeated_vectors == 0:
        return _every_vector(rows, by, orders)
    keys = [*by, "_f1", "_f2"]
    repeated = groups.where("_n > 1").select(
        *[F.col(k).alias(f"_of{k}") for k in keys], "_n", "_first", "_last"
    )
    if fits_broadcast(shape.repeated_vectors, 96 + 32 * (len(by) + 2 * len(orders))):
        repeated = F.broadcast(repeated)
    joined = rows.join(repeated, [F.col(k) == F.col(f"_of{k}") for k in keys], "left")
    here = F.struct(*orders, "_id")
    return joined.where(F.col("_first").isNull() | F.col("_first").eqNullSafe(here)).select(
        *keys,
        "_v",
        F.coalesce("_n", F.lit(1).cast("long")).alias("_n"),
        "_id",
        *orders,
        *[
            F.when(F.col("_last").isNull(), F.col(o))
            .otherwise(F.col(f"_last.{o}"))
            .alias(o.replace("_o", "_l"))
            for o in orders
        ],
    )


def _every_vector(rows: DataFrame, by: list[str], orders: list[str]) -> DataFrame:
    """The same columns with every row taken as a vector of its own."""
    return rows.select(
        *by,
        "_f1",
        "_f2",
        "_v",
        F.lit(1).cast("long").alias("_n"),
        "_id",
        *orders,
        *[F.col(o).alias(o.replace("_o", "_l")) for o in orders],
    )


def _block_pairs(
    distinct: DataFrame,
    shape: Shape,
    by: list[str],
    block_rows: int,
    above: float | None,
    cells: int,
    strips: bool,
):
    """Send every row to each pair of blocks it belongs to: adds ``_p <= _q`` and ``_b``.

    With ``above`` it goes only to those in which a similarity may exceed it. Also
    returns how many pairs of blocks the large clusters have, and, with ``strips``, the
    sizes of the clusters whose rows are not sent since each would go to very many; None
    where there are none.
    """
    full, whole = shape.full_block_pairs, None
    zero = F.lit(0).alias("_b"), F.lit(0).alias("_p"), F.lit(0).alias("_q")
    sent = distinct.where(F.expr(" and ".join(f"`{c}` is not null" for c in by)))
    near = None
    if above is not None and shape.large_clusters:
        near = near_block_pairs(
            sent, shape.sizes, shape.large_clusters, by, block_rows, above, cells, strips=strips
        )
    if shape.large_clusters == 0:
        sent = sent.select("*", *zero)
    elif near is not None:
        rows, full, left_out = near
        if left_out:
            whole = shape.sizes.where(F.xxhash64(*by).isin(left_out))
        sent = (
            rows.withColumn("_p", F.least("_b", "_other"))
            .withColumn("_q", F.greatest("_b", "_other"))
            .drop("_other")
        )
    else:
        # Only clusters of several blocks are looked up: few rows, and counted.
        blocks = shape.sizes.where(F.col("_vectors") > block_rows).select(
            *[F.col(c).alias(f"_by_{c}") for c in by],
            F.ceil(F.col("_vectors") / F.lit(block_rows)).cast("int").alias("_blocks"),
        )
        if fits_broadcast(shape.large_clusters, 64 + 32 * len(by)):
            blocks = F.broadcast(blocks)
        sent = (
            sent.join(blocks, [F.col(c) == F.col(f"_by_{c}") for c in by], "left")
            .withColumn("_blocks", F.coalesce("_blocks", F.lit(1)))
            .drop(*[f"_by_{c}" for c in by])
        )
        if strips and shape.very_large_clusters:
            full -= shape.very_large_block_pairs
            whole = shape.sizes.where(F.col("_vectors") > SENT_BLOCKS * block_rows)
            sent = sent.where(F.col("_blocks") <= SENT_BLOCKS)
        sent = (
            sent.withColumn("_b", F.pmod("_f1", F.col("_blocks").cast("long")).cast("int"))
            .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
            .withColumn("_p", F.least("_b", "_other"))
            .withColumn("_q", F.greatest("_b", "_other"))
            .drop("_blocks", "_other")
        )
    if whole is not None:
        whole = whole.where(F.expr(" and ".join(f"`{c}` is not null" for c in by)))
    return sent, full, whole


def _reduced(sent: DataFrame, full_block_pairs: int, by: list[str], task, schema) -> DataFrame:
    """One Arrow group for each block pair."""
    # An explicit partition count: the groups are small in bytes but heavy in
    # work, and must not be coalesced by size. A large cluster raises it.
    partitions = int(sent.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(partitions, min(full_block_pairs // _PAIRS_PER_TASK, _MAX_PARTITIONS))
    keys = [*by, "_p", "_q"]
    return sent.repartition(partitions, *keys).groupBy(*keys).applyInArrow(task, schema)


@dataclass(frozen=True)
class Ledger:
    """Finished block pairs below ``path``, dealt into ``parts`` by a hash of their names.

    Each part is a job of its own and a folder of its own, which a repeated call takes
    as it is. A part reads the vectors once more and shuffles its own block pairs only,
    so that it also bounds the disk held at once. The folder belongs to one
    comparison: the same rows, order, thresholds and block size.
    """

    path: str
    parts: int

    def folder(self, part: int) -> str:
        return f"{self.path.rstrip('/')}/part-{part}-of-{self.parts}"


def _write_part(reduced: DataFrame, folder: str) -> None:
    reduced.write.mode("overwrite").parquet(folder)


def _stored(sent: DataFrame, shape: Shape, by: list[str], task, schema, ledger: Ledger) -> DataFrame:
    """What all block pairs leave; parts that are not stored yet are run now."""
    spark = sent.sparkSession
    part_of = F.pmod(F.xxhash64(*by, "_p", "_q"), F.lit(ledger.parts))
    for part in range(ledger.parts):
        folder = ledger.folder(part)
        if not path_exists(spark, folder):
            own = sent.where(part_of == part)
            pairs = shape.full_block_pairs // ledger.parts
            _write_part(_reduced(own, pairs, by, task, schema), folder)
    return spark.read.schema(schema).parquet(*[ledger.folder(p) for p in range(ledger.parts)])


@dataclass(frozen=True)
class Shape:
    """Measured sizes: what is looked up, salted or broadcast depends on them.

    ``sizes`` has ``_rows`` and ``_vectors`` per cluster.
    """

    sizes: DataFrame
    clusters: int
    large_clusters: int
    full_block_pairs: int
    hot_vectors: int
    repeated_vectors: int
    very_large_clusters: int = 0
    very_large_block_pairs: int = 0


def _measure(distinct: DataFrame, by: list[str], block_rows: int, hot_copies: int) -> Shape:
    sizes = distinct.groupBy(*by).agg(
        F.sum("_n").alias("_rows"),
        F.count(F.lit(1)).alias("_vectors"),
        F.count_if(F.col("_n") > hot_copies).alias("_hot"),
        F.count_if(F.col("_n") > 1).alias("_repeated"),
    )
    blocks = F.ceil(F.col("_vectors") / F.lit(block_rows))
    counted = sizes.agg(
        F.count(F.lit(1)),
        F.count_if(blocks > 1),
        F.sum(F.when(blocks > 1, blocks * (blocks + 1) / 2)),
        F.sum("_hot"),
        F.sum("_repeated"),
        F.count_if(blocks > SENT_BLOCKS),
        F.sum(F.when(blocks > SENT_BLOCKS, blocks * (blocks + 1) / 2)),
    ).first()
    return Shape(sizes.drop("_hot", "_repeated"), *[int(c or 0) for c in counted])


def _hot_vectors(distinct: DataFrame, shape: Shape, by: list[str], hot_copies: int):
    """Vectors with more than ``hot_copies`` copies, at most rows / hot_copies of them."""
    if shape.hot_vectors == 0:
        return None
    hot = distinct.where(F.col("_n") > hot_copies).select(
        *by, "_f1", "_f2", F.ceil(F.col("_n") / F.lit(hot_copies)).alias("_salts")
    )
    fits = fits_broadcast(shape.hot_vectors, 64 + 32 * len(by))
    return F.broadcast(hot) if fits else hot


# --- inside a task ---------------------------------------------------------


def _sides(table: pa.Table, p: int, q: int) -> tuple[np.ndarray, np.ndarray]:
    """Row positions of the two blocks of a group."""
    if p == q:
        every = np.arange(table.num_rows)
        return every, every
    block = table["_b"].to_numpy()
    return np.flatnonzero(block == p), np.flatnonzero(block == q)


def _tiles(left: np.ndarray, right: np.ndarray, same: bool):
    """Pairs of position slices that cover each unordered pair of rows once."""
    for i in range(0, len(left), _TILE):
        for j in range(i if same else 0, len(right), _TILE):
            yield left[i : i + _TILE], right[j : j + _TILE], same and i == j


def _marked(marks: np.ndarray) -> np.ndarray:
    """Positions of the few marks of a flat array, looked for eight at a time."""
    whole = len(marks) // 8 * 8
    words = np.flatnonzero(marks[:whole].view(np.int64))
    some = (words[:, None] * 8 + np.arange(8)).ravel()
    some = some[marks[some]]
    return np.concatenate([some, whole + np.flatnonzero(marks[whole:])])


def _places(marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of every mark, read in the order in which they lie."""
    if marks.flags.c_contiguous:
        return np.divmod(_marked(marks.ravel()), marks.shape[1])
    column, row = np.divmod(_marked(np.ascontiguousarray(marks.T).ravel()), marks.shape[0])
    return row, column


class _Products:
    """Dot products of the rows of a group: quick ones by tiles, exact ones where asked.

    A tile is computed in single precision of rows scaled to a length of at most 1 and
    is off by less than its margin, which follows from the lengths of its rows. What a
    result depends on is computed again in double precision; a quick value never leaves
    the task. Rows beyond the range of single precision have tiles of doubles.
    """

    def __init__(self, rows: np.ndarray):
        self.rows, self.dim = rows, rows.shape[1]
        self.norms = np.sqrt(np.einsum("ij,ij->i", rows, rows))
        longest = float(self.norms.max(initial=0.0))
        single = 1e-100 < longest < 1e100
        # A power of two, so that scaling is exact.
        self.unit = 2.0 ** math.ceil(math.log2(longest)) if single else 1.0
        self.quick = (rows / self.unit).astype(np.float32) if single else rows
        self.square = self.unit * self.unit
        rounding = 2.0**-24 if single else 2.0**-53
        self.relative = 1.1 * (self.dim + 4) * rounding
        # What may be lost to underflow.
        self.least = 8 * self.dim * 2.0**-126 if single else 0.0
        self.buffer = np.empty(_TILE * _TILE, dtype=self.quick.dtype)

    def tile(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
        """Quick products in units of ``square``, and their margin; valid until the next tile."""
        out = self.buffer[: len(a) * len(b)].reshape(len(a), len(b))
        np.matmul(self.quick[a], self.quick[b].T, out=out)
        lengths = float(self.norms[a].max()) * float(self.norms[b].max()) / self.square
        return out, self.relative * lengths + self.least

    def exact(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Products of row pairs in double precision, a bounded number at a time."""
        step = max(1, (1 << 19) // max(self.dim, 1))
        parts = [
            np.einsum("ij,ij->i", self.rows[i[k : k + step]], self.rows[j[k : k + step]])
            for k in range(0, len(i), step)
        ]
        return np.concatenate(parts) if parts else np.empty(0)

    def raised(self, quick, margin: float, a, b, best: np.ndarray, decimals=None, sign=1):
        """Columns whose exact maximum over rows ``a`` exceeds ``best``: place, row, value.

        ``best`` holds a value for each row ``b``. Of equal values, rounded to
        ``decimals``, the first row counts. Entries of -inf are left out. With a
        ``sign`` of -1 it is the maximum of the negative products, without those of inf.
        """
        slack = 0.0 if decimals is None else 2 * _HALF
        top = (quick.max(axis=0) if sign > 0 else -quick.min(axis=0)).astype(np.float64)
        at = np.flatnonzero((top + margin) * self.square + slack > best)
        if len(at) == 0:
            return at, at, np.empty(0)
        # Near the maximum; elsewhere nothing is.
        level = top[at] - 2 * margin - slack / self.square
        least = (level - np.abs(level) * 2.0**-22).astype(quick.dtype)
        some = quick if len(at) == len(b) else quick[:, at]
        near = some >= least if sign > 0 else some <= -least
        if np.count_nonzero(near) > _FEW * len(at):
            # Very many are: whole columns.
            sims = sign * (self.rows[a] @ self.rows[b[at]].T)
            sims = sims if decimals is None else np.round(sims, decimals)
            sims = np.where(np.isfinite(some), sims, -np.inf)
            row = sims.argmax(axis=0)
            value = sims[row, np.arange(len(at))]
        else:
            row, column = _places(near)
            value = sign * self.exact(a[row], b[at[column]])
            value = value if decimals is None else np.round(value, decimals)
            order = np.lexsort((row, -value, column))
            order = order[np.flatnonzero(np.diff(column[order], prepend=-1))]
            row, value = row[order], value[order]
        more = value > best[at]
        return at[more], a[row[more]], value[more]


class _BestEarlier:
    """Best earlier neighbour of every distinct vector of a block pair.

    Emits three kinds of candidates. BEFORE: the best vector that first occurs
    before this one. COPY: the vector itself, which its second and later copies
    may use. BETWEEN: a vector that first occurs after this one but before its
    last copy and is more similar than the copy itself (possible only where
    lengths differ); only entries that raise the maximum are kept.
    """

    def __init__(self, table: pa.Table, products: _Products, same: bool, orders: list[str]):
        rows = products.rows
        n = len(rows)
        self.table, self.products, self.same, self.orders = table, products, same, orders
        self.best = np.full(n, -np.inf)
        self.mate = np.zeros(n, dtype=np.int64)
        self.copied = table["_n"].to_numpy() > 1
        self.between: list[tuple] = []
        self.spread = np.zeros(n, dtype=bool)
        if self.copied.any():
            self.own = np.round(np.einsum("ij,ij->i", rows, rows), SIM_DECIMALS)
            self.last = self._last_positions()
            # Copies that other vectors of this group come between.
            self.spread = self.copied & (self.last > np.arange(n) + 1)

    def _last_positions(self) -> np.ndarray:
        """For each row, how many rows of the sorted table come before its last copy."""
        n = self.table.num_rows
        columns = [
            pa.concat_arrays(
                [
                    self.table[o].combine_chunks(),
                    self.table[o.replace("_o", "_l")].combine_chunks(),
                ]
            )
            for o in self.orders
        ]
        both = pa.table([*columns, pa.array(np.arange(2 * n))], [*self.orders, "_row"])
        row = both.sort_by([(o, "ascending") for o in self.orders])["_row"].to_numpy()
        firsts = np.cumsum(row < n)
        out = np.zeros(n, dtype=np.int64)
        out[row[row >= n] - n] = firsts[row >= n]
        return out

    def _offer(self, quick: np.ndarray, margin: float, a: np.ndarray, b: np.ndarray) -> None:
        """Best of rows ``a`` for each column ``b``; ``quick`` is -inf where a is not earlier.

        Every row sees its candidates in ascending tiles, so a later tile must
        be strictly better.
        """
        at, mate, value = self.products.raised(quick, margin, a, b, self.best[b], SIM_DECIMALS)
        self.mate[b[at]] = mate
        self.best[b[at]] = value

    def tile(self, a, b, quick: np.ndarray, margin: float, diagonal: bool) -> None:
        # Positions ascend, so most tiles lie wholly on one side of the order.
        if a[-1] < b[0]:
            self._offer(quick, margin, a, b)
        elif b[-1] < a[0]:
            self._offer(quick.T, margin, b, a)
        else:
            earlier = a[:, None] < b[None, :]
            none = quick.dtype.type(-np.inf)
            self._offer(np.where(earlier, quick, none), margin, a, b)
            if not self.same:
                self._offer(np.where(earlier, none, quick).T, margin, b, a)
        if self.spread.any():
            turns = [(quick, a, b)] if self.same else [(quick, a, b), (quick.T, b, a)]
            for s, x, y in turns:
                self._come_between(s, margin, x, y)

    def _come_between(self, quick: np.ndarray, margin: float, x, y) -> None:
        norms = self.products.norms
        # No product exceeds that of the lengths: none of rows that are not longer.
        most = norms[x] * (norms[y].max() * (1 + 4e-16 * (self.products.dim + 4)))
        own = self.own[x] if len(x) else most
        use = np.flatnonzero(self.spread[x] & (most > own + _HALF))
        if len(use) == 0:
            return
        at = x[use][:, None]
        least = (self.own[at] + _HALF) / self.products.square - margin
        i, j = np.nonzero((at < y) & (y < self.last[at]) & (quick[use] >= least))
        sims = self.products.exact(x[use[i]], y[j])
        hit = sims > self.own[x[use[i]]] + _HALF
        found = np.round(sims[hit], SIM_DECIMALS)
        self.between.append((x[use[i[hit]]], y[j[hit]], found))

    def _rising(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The entries between copies that beat every earlier entry of their row."""
        pos, later, sim = (np.concatenate(x) for x in zip(*self.between))
        keep, row, top = [], -1, 0.0
        for at in np.lexsort((later, pos)):
            if pos[at] != row or sim[at] > top:
                keep.append(at)
                row, top = pos[at], sim[at]
        keep = np.array(keep, dtype=np.int64)
        return pos[keep], later[keep], sim[keep]

    def result(self, with_best: bool = True) -> tuple[np.ndarray, dict]:
        """Rows and candidates; without the best, those of copies alone."""
        found = np.flatnonzero(np.isfinite(self.best) & with_best)
        parts = [(found, self.mate[found], self.best[found], _BEFORE)]
        if self.same and self.copied.any():
            repeated = np.flatnonzero(self.copied)
            parts.append((repeated, repeated, self.own[repeated], _COPY))
        if self.between:
            parts.append((*self._rising(), _BETWEEN))
        row, mate, sim = (np.concatenate([x[i] for x in parts]) for i in range(3))
        kinds = [np.full(len(x[0]), x[3], dtype=np.int32) for x in parts]
        columns = {"_kind": np.concatenate(kinds), "_down": -sim}
        columns |= {o: self.table[o].take(mate) for o in self.orders}
        return row, columns | {"_mate": self.table["_id"].take(mate)}


class _SumsOverOthers:
    """Weighted sums, extremes and counts over the other rows of a block pair.

    Sums and squares follow from the sum of the other side's vectors and of their outer
    products, without a look at the pairs. With ``right_only`` the rows of the left side get
    nothing.
    """

    def __init__(
        self, table: pa.Table, products: _Products, left, right, same: bool, eps_list,
        right_only: bool = False,
    ):
        n = len(products.rows)
        self.products, self.eps_list, self.right_only = products, eps_list, right_only
        self.n = table["_n"].to_numpy()
        self.weight = self.n.astype(np.float64)
        # Counts are whole numbers, exact in single precision while they are small.
        self.light = self.weight.astype(np.float32 if self.weight.sum() < 1 << 24 else np.float64)
        self.total, self.squares = np.zeros(n), np.zeros(n)
        self.top, self.low = np.full(n, -np.inf), np.full(n, np.inf)
        self.over = np.zeros((len(eps_list), n))
        self._sum_up(right, left)
        if same:
            self._without_itself()
        elif not right_only:
            self._sum_up(left, right)

    def _sum_up(self, at: np.ndarray, others: np.ndarray) -> None:
        rows, y = self.products.rows, self.products.rows[others]
        weighted = y * self.weight[others][:, None]
        self.total[at] += rows[at] @ weighted.sum(axis=0)
        self.squares[at] += np.einsum("ij,ij->i", rows[at] @ (weighted.T @ y), rows[at])

    def _without_itself(self) -> None:
        """The row itself is no neighbour, its copies are."""
        own = np.einsum("ij,ij->i", self.products.rows, self.products.rows)
        self.total -= own
        self.squares -= own * own
        for e, eps in enumerate(self.eps_list):
            self.over[e] += (np.round(own, SIM_DECIMALS) > 1 - eps) * (self.weight - 1)
        copied = self.n > 1
        self.top[copied] = self.low[copied] = own[copied]

    def tile(self, a, b, quick: np.ndarray, margin: float, diagonal: bool) -> None:
        none = quick.dtype.type(np.inf)
        if diagonal:
            quick = quick.copy()
            np.fill_diagonal(quick, none)
        turns = [(quick, a, b)]
        if not diagonal and not self.right_only:
            turns.append((quick.T, b, a))
        for s, x, y in turns:
            at, _, value = self.products.raised(s, margin, x, y, -self.low[y], sign=-1)
            self.low[y[at]] = -value
        if diagonal:
            np.fill_diagonal(quick, -none)
        for s, x, y in turns:
            at, _, value = self.products.raised(s, margin, x, y, self.top[y])
            self.top[y[at]] = value
        if self.eps_list:
            self._count(a, b, quick, margin, diagonal)

    def _count(self, a, b, quick: np.ndarray, margin: float, diagonal: bool) -> None:
        """Others above each threshold: the same comparison of the same value as in the flags."""
        square = self.products.square
        left = sorted(range(len(self.eps_list)), key=lambda e: -self.eps_list[e])
        while left:
            e = left[0]
            level = 1 - self.eps_list[e]
            # Beyond the margin the quick value decides.
            off = margin + (2 * _HALF + 2.0**-22 * abs(level)) / square
            least = quick > quick.dtype.type(level / square - off)
            n = np.count_nonzero(least)
            if n < _SPARSE * least.size:
                return self._count_few(a, b, quick, least, left, margin, diagonal)
            sure = quick > quick.dtype.type(level / square + off)
            i, j = _places(least != sure)
            self._add_exact(e, a[i], b[j], diagonal)
            sure = sure.astype(self.light.dtype)
            if not self.right_only:
                self.over[e, a] += sure @ self.light[b]
            if not diagonal:
                self.over[e, b] += self.light[a] @ sure
            left = left[1:]

    def _count_few(self, a, b, quick, least, levels, margin, diagonal) -> None:
        i, j = _places(least)
        value, i, j = quick[i, j].astype(np.float64) * self.products.square, a[i], b[j]
        off = margin * self.products.square + 2 * _HALF
        for e in levels:
            level = 1 - self.eps_list[e]
            sure = value > level + off
            self._add(e, i[sure], j[sure], diagonal)
            open_ = ~sure & (value >= level - off)
            self._add_exact(e, i[open_], j[open_], diagonal)

    def _add_exact(self, e: int, i: np.ndarray, j: np.ndarray, diagonal: bool) -> None:
        above = np.round(self.products.exact(i, j), SIM_DECIMALS) > 1 - self.eps_list[e]
        self._add(e, i[above], j[above], diagonal)

    def _add(self, e: int, i: np.ndarray, j: np.ndarray, diagonal: bool) -> None:
        if not self.right_only:
            np.add.at(self.over[e], i, self.weight[j])
        if not diagonal:
            np.add.at(self.over[e], j, self.weight[i])

    def take_over(self, so_far: _SumsOverOthers, own: np.ndarray) -> None:
        """Extremes that rows ``own`` have had, below which nothing is looked for."""
        self.top[own] = np.maximum(self.top[own], so_far.top)
        self.low[own] = np.minimum(self.low[own], so_far.low)

    def narrowed(self, own: np.ndarray, so_far: _SumsOverOthers | None) -> _SumsOverOthers:
        """What rows ``own`` have, with what they have had."""
        out = copy(self)
        out.products = None
        for name in ("n", "weight", "light", "top", "low", "total", "squares"):
            setattr(out, name, getattr(self, name)[own])
        out.over = self.over[:, own]
        if so_far is not None:
            for name in ("total", "squares", "over"):
                setattr(out, name, getattr(out, name) + getattr(so_far, name))
        return out

    def result(self) -> tuple[np.ndarray, dict]:
        alone = ~np.isfinite(self.top)
        columns = {
            "_kind": np.full(len(self.n), _SUMS, dtype=np.int32),
            "_n": self.n,
            "_sum": self.total,
            "_squares": self.squares,
            "_max": pa.array(self.top, mask=alone),
            "_min": pa.array(self.low, mask=alone),
        }
        for e in range(len(self.eps_list)):
            columns[f"_over{e}"] = np.round(self.over[e]).astype(np.int64)
        return np.arange(len(self.n)), columns


def _one_of_each(table: pa.Table) -> pa.Table:
    """The rows without those that repeat a whole row, key and place, of the input."""
    keys = np.stack([table["_f1"].to_numpy(), table["_f2"].to_numpy()])
    if len(np.unique(keys[0])) == table.num_rows:
        return table
    _, first = np.unique(keys, axis=1, return_index=True)
    return table.take(np.sort(first))


def _block_pair_task(by, orders, eps_list, with_prior: bool, with_sums: bool, schema: pa.Schema):
    """Task body: one quick matrix product per tile, handed to the wanted reductions."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = _one_of_each(table)
        if orders:
            table = table.sort_by([(o, "ascending") for o in orders])
        products = _Products(matrix(table["_v"]))
        p, q = key[-2].as_py(), key[-1].as_py()
        left, right = _sides(table, p, q)
        reductions = []
        if with_prior:
            reductions.append(_BestEarlier(table, products, p == q, orders))
        if with_sums:
            reductions.append(_SumsOverOthers(table, products, left, right, p == q, eps_list))
        _compare(products, left, right, p == q, reductions)
        cluster = [key[i] for i in range(len(by))]
        parts = [_emitted(table, *r.result(), by, cluster, schema) for r in reductions]
        return pa.concat_tables(parts)

    return run


def _compare(products: _Products, left, right, same: bool, reductions) -> None:
    for a, b, diagonal in _tiles(left, right, same):
        quick, margin = products.tile(a, b)
        for reduction in reductions:
            reduction.tile(a, b, quick, margin, diagonal)


def _emitted(table: pa.Table, at, columns: dict, by, cluster, schema: pa.Schema) -> pa.Table:
    """The result ``columns`` of rows ``at`` with their keys."""
    columns |= {"_f1": table["_f1"].take(at), "_f2": table["_f2"].take(at)}
    columns |= {c: [value.as_py()] * len(at) for c, value in zip(by, cluster)}
    missing = {c: pa.nulls(len(at), schema.field(c).type) for c in schema.names}
    return pa.table({**missing, **columns}).select(schema.names).cast(schema)


class _Strip:
    """Results of the rows of one block, held against others of its cluster one by one.

    Blocks are numbered in order, so that each comes wholly before or after this one. What
    has been found bounds what is looked for in the next. Nothing is kept of the rows of
    other blocks but the names of mates; copies of theirs get what comes between them here.
    """

    def __init__(self, at: int, table: pa.Table, by, orders, eps_list, with_prior, with_sums, schema):
        self.at, self.by, self.orders, self.eps_list, self.schema = at, by, orders, eps_list, schema
        self.with_prior, self.with_sums = with_prior, with_sums
        self.rows = matrix(table["_v"])
        self.table = table.drop_columns("_v")
        self.cluster = [table[c][0] for c in by]
        n = len(self.rows)
        self.best = np.full(n, -np.inf)
        # The block that a mate is in, and its row there.
        self.block, self.mate = np.full(n, -1, dtype=np.int64), np.zeros(n, dtype=np.int64)
        self.names: dict[int, pa.Table] = {}
        self.sums: _SumsOverOthers | None = None

    def meet(self, p: int, other: pa.Table | None):
        """Compare with block ``p``, which is ``other``, or None for this one."""
        same, n = other is None, len(self.rows)
        rows, table = self.rows, self.table
        if not same:
            theirs = matrix(other["_v"])
            if theirs.shape[1] != rows.shape[1]:
                raise ValueError("vectors of different dimensions in one cluster")
            rows = np.concatenate([theirs, rows])
            table = pa.concat_tables([other.drop_columns("_v"), table])
        products = _Products(rows)
        own = np.arange(len(rows) - n, len(rows))
        left = own if same else np.arange(len(rows) - n)
        reductions = []
        prior = sums = None
        if self.with_prior and p <= self.at:
            prior = _BestEarlier(table, products, same, self.orders)
            # Of equal values, that of the earlier block counts, in whatever turn it comes.
            again = np.nextafter(self.best, -np.inf)
            prior.best[own] = np.where(self.block > p, again, self.best)
            prior.mate[:] = -1
            reductions.append(prior)
        if self.with_sums:
            sums = _SumsOverOthers(table, products, left, own, same, self.eps_list, not same)
            if self.sums is not None:
                sums.take_over(self.sums, own)
            reductions.append(sums)
        _compare(products, left, own, same, reductions)
        if sums is not None:
            self.sums = sums.narrowed(own, self.sums)
        if prior is not None:
            better = np.flatnonzero(prior.mate[own] >= 0)
            self.best[better], self.block[better] = prior.best[own[better]], p
            self.mate[better] = prior.mate[own[better]]
            names = self.table if same else other
            self.names[p] = names.select(list(dict.fromkeys([*self.orders, "_id"])))
            at, columns = prior.result(with_best=False)
            if len(at):
                yield _emitted(table, at, columns, self.by, self.cluster, self.schema)

    def result(self):
        for p in np.unique(self.block[self.block >= 0]).tolist():
            at = np.flatnonzero(self.block == p)
            mates = self.names[p].take(self.mate[at])
            columns = {"_kind": np.full(len(at), _BEFORE, dtype=np.int32), "_down": -self.best[at]}
            columns |= {o: mates[o] for o in self.orders} | {"_mate": mates["_id"]}
            yield _emitted(self.table, at, columns, self.by, self.cluster, self.schema)
        if self.sums is not None:
            yield _emitted(self.table, *self.sums.result(), self.by, self.cluster, self.schema)


def _strip_task(by, orders, eps_list, with_prior: bool, with_sums: bool, schema: pa.Schema):
    """Task body: the block pairs of strips, one pair a row."""

    def run(batches):
        strip = None
        for batch in batches:
            for row in range(batch.num_rows):
                p, q = batch["_p"][row].as_py(), batch["_q"][row].as_py()
                if strip is None or strip.at != q:
                    if strip is not None:
                        for part in strip.result():
                            yield from part.to_batches()
                    table = unpacked(batch["_right"][row])
                    strip = _Strip(q, table, by, orders, eps_list, with_prior, with_sums, schema)
                for part in strip.meet(p, None if p == q else unpacked(batch["_left"][row])):
                    yield from part.to_batches()
        if strip is not None:
            for part in strip.result():
                yield from part.to_batches()

    return run


# --- the operator ----------------------------------------------------------


def _fields(df: DataFrame, names: dict[str, str]) -> list[T.StructField]:
    return [T.StructField(new, df.schema[old].dataType) for old, new in names.items()]


@dataclass(frozen=True)
class ClusterPairs:
    """Reduced pair similarities of a member table.

    ``members``: the keys, ``_id``, copy key and order of every row, without
    vectors. ``vectors``: one row per cluster and distinct vector with the
    reductions. ``shape``: sizes per cluster and their counts. ``hot``: the
    vectors with very many copies and the number of ``_salts`` to spread them
    over; None where there are none. ``sent``: the rows of every block pair. ``rows``:
    the keys, ``_id`` and vector ``_v`` of every row that has one.
    """

    by: list[str]
    order: list[str]
    id_col: str
    eps_list: list[float]
    members: DataFrame
    vectors: DataFrame
    shape: Shape
    hot: DataFrame | None = None
    above: float | None = None
    sent: DataFrame | None = None
    rows: DataFrame | None = None

    def materialized(self) -> ClusterPairs:
        """Run the pair join once for several uses of its result."""
        return replace(self, vectors=materialize(self.vectors, "pairs"))

    def with_reductions(self, columns: list[str]) -> DataFrame:
        """Every member with the reductions of its vector; copies share the join key."""
        keys = [*self.by, "_f1", "_f2"]
        vectors = self.vectors.select(*keys, *columns)
        return salted_left_join(self.members, vectors, keys, self.hot, "_id")

    def prior_similarity(self) -> DataFrame:
        """Per row: ``max_sim``, ``mate_id`` and the mate's order columns.

        Of a comparison ``above`` a threshold, ``max_sim`` is 0 up to it.
        """
        orders = [f"_o{i}" for i in range(len(self.order))]
        joined = self.with_reductions(["_before", "_copy", "_between"])
        here = F.struct(*orders)

        def is_earlier(candidate: Column) -> Column:
            return F.struct(*[candidate[o].alias(o) for o in orders]) < here

        plain = F.array("_before", F.when(is_earlier(F.col("_copy")), F.col("_copy")))
        with_between = F.concat(plain, F.filter("_between", is_earlier))
        # Ascending (-similarity, order) puts the most similar, then earliest, mate first.
        best = F.array_min(F.when(F.size("_between") > 0, with_between).otherwise(plain))
        positive = -F.col("_best._down") > F.lit(float(self.above or 0))
        return joined.withColumn("_best", best).select(
            *self.by,
            F.col("_id").alias(self.id_col),
            F.when(positive, -F.col("_best._down")).otherwise(F.lit(0.0)).alias("max_sim"),
            F.when(positive, F.col("_best._mate")).alias("mate_id"),
            *[
                F.when(positive, F.col(f"_best.{o}")).alias(f"mate_{c}")
                for o, c in zip(orders, self.order)
                if c != self.id_col
            ],
        )


    def compared_pairs(self) -> DataFrame:
        """Per cluster: ``n_pairs`` of distinct vectors, and ``n_compared`` of them.

        For reports; the blocks are made again.
        """
        left, right = (F.count_if(F.col("_b") == F.col(c)) for c in ("_p", "_q"))
        pairs = F.when(F.col("_p") == F.col("_q"), left * (left - 1) / 2).otherwise(left * right)
        met = self.sent.groupBy(*self.by, "_p", "_q").agg(pairs.alias("_n"))
        met = met.groupBy(*self.by).agg(F.sum("_n").cast("long").alias("n_compared"))
        n = F.col("_vectors")
        every = self.shape.sizes.select(*self.by, (n * (n - 1) / 2).cast("long").alias("n_pairs"))
        # Clusters compared in strips have no rows there: all their pairs are.
        known = every.where(F.expr(" and ".join(f"`{c}` is not null" for c in self.by)))
        compared = F.coalesce("n_compared", "n_pairs").alias("n_compared")
        return known.join(met, self.by, "left").select(*self.by, "n_pairs", compared)


def compare_within_clusters(
    members: DataFrame,
    by: list[str] | tuple[str, ...] = ("cluster_id",),
    order: list[str] | tuple[str, ...] = (),
    eps_list: list[float] | tuple[float, ...] = (),
    id_col: str = "id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    collapse_copies: bool = True,
    with_sums: bool = True,
    hot_copies: int = HOT_COPIES,
    above: float | None = None,
    cells: int = CELLS,
    ledger: Ledger | None = None,
    deferred: bool = False,
) -> ClusterPairs:
    """Compare all rows of each cluster in one pass.

    With ``order`` the best earlier row of each row is found; with
    ``with_sums`` each row is summed up over all others (and counted per
    threshold of ``eps_list``). A vector with more than ``hot_copies`` copies
    is salted where results go back to the rows.

    ``above`` asks for similarities above a threshold only: large clusters are cut
    into at most ``cells`` cells of near vectors each, and what bounds prove to stay
    at or below it is not compared (:mod:`neardup.operators.bounds`).

    With a ``ledger`` the block pairs are run by this call, part by part, and parts that
    an earlier call finished are not repeated. Blocks of a full comparison follow from
    the rows alone, those by a threshold from drawn pivots: the two exclude each other.

    Clusters of more than ``SENT_BLOCKS`` blocks are compared by this call, in strips
    (:mod:`neardup.operators.strips`), unless a ledger or ``deferred`` asks for block
    pairs. A ``deferred`` comparison is all in the plan, so that Spark leaves it out where
    no reduction is read; each row of it is sent once for each block of its cluster.
    """
    if ledger is not None and (above is not None or ledger.parts < 1):
        raise ValueError("a ledger has positive parts and goes without a threshold")
    if above is not None and (with_sums or above < 0):
        raise ValueError("a threshold must not be negative and goes without sums")
    by, order, eps_list = list(by), list(order), list(eps_list)
    with_prior = bool(order)
    orders = [f"_o{i}" for i in range(len(order))]
    keyed = _keyed_members(members, by, id_col, vector_col, order, collapse_copies)
    rows = _keyed_vectors(members, by, id_col, vector_col, order, collapse_copies)
    if collapse_copies:
        # Narrow, and written once: read for sizes, hot vectors and first occurrences.
        groups = materialize(_copy_groups(keyed, by, orders), "copy-groups")
        shape = _measure(groups, by, block_rows, hot_copies)
        hot = _hot_vectors(groups, shape, by, hot_copies)
        distinct = _first_occurrences(rows, groups, shape, by, orders)
    else:
        distinct = _every_vector(rows, by, orders)
        shape = _measure(distinct, by, block_rows, hot_copies)
        hot = None
    fields = _fields(distinct, {c: c for c in by})
    fields += [T.StructField(c, T.LongType()) for c in ("_f1", "_f2")]
    fields.append(T.StructField("_kind", T.IntegerType()))
    wanted = []
    if with_prior:
        fields.append(T.StructField("_down", T.DoubleType()))
        fields += _fields(distinct, {o: o for o in orders} | {"_id": "_mate"})
        candidate = F.struct("_down", *orders, "_mate")
        for kind, merge, name in (
            (_BEFORE, F.min, "_before"),
            (_COPY, F.min, "_copy"),
            (_BETWEEN, F.collect_list, "_between"),
        ):
            wanted.append(merge(F.when(F.col("_kind") == kind, candidate)).alias(name))
    if with_sums:
        overs = [f"_over{e}" for e in range(len(eps_list))]
        fields.append(T.StructField("_n", T.LongType()))
        fields += [T.StructField(c, T.DoubleType()) for c in ("_sum", "_squares", "_max", "_min")]
        fields += [T.StructField(c, T.LongType()) for c in overs]
        wanted += [F.max(c).alias(c) for c in ("_n", "_max")]
        wanted.append(F.min("_min").alias("_min"))
        wanted += [F.sum(c).alias(c) for c in ("_sum", "_squares", *overs)]
    schema = T.StructType(fields)
    task = _block_pair_task(
        by, orders, eps_list, with_prior, with_sums, to_arrow_schema(schema)
    )
    strips = ledger is None and not deferred
    sent, full, whole = _block_pairs(distinct, shape, by, block_rows, above, cells, strips)
    if ledger is None:
        reduced = _reduced(sent, full, by, task, schema)
    else:
        reduced = _stored(sent, shape, by, task, schema, ledger)
    if whole is not None:
        strip_task = _strip_task(
            by, orders, eps_list, with_prior, with_sums, to_arrow_schema(schema)
        )
        # Blocks of fewer rows would only be more.
        rows_each = block_rows if above is None else max(block_rows, BLOCK_ROWS)
        stored = compared_in_strips(
            distinct, whole, by, orders, rows_each, not with_sums, strip_task, schema
        )
        reduced = reduced.unionByName(stored)
    vectors = reduced.groupBy(*by, "_f1", "_f2").agg(*wanted)
    return ClusterPairs(
        by, order, id_col, eps_list, keyed.drop("_usable"), vectors, shape, hot, above, sent, rows
    )


def max_prior_similarity(
    members: DataFrame,
    by: list[str] | tuple[str, ...] = ("cluster_id",),
    order: list[str] | tuple[str, ...] = ("rank",),
    id_col: str = "id",
    vector_col: str = "embedding",
    block_rows: int = BLOCK_ROWS,
    collapse_copies: bool = True,
    above: float | None = None,
) -> DataFrame:
    """Largest similarity of each row to any earlier row of its cluster.

    Similarity is the raw dot product; earlier means smaller in ``order``, one
    or more columns compared ascending that identify a row within the cluster.
    Returns ``by``, the id, ``max_sim`` (0 where no earlier row has a positive
    similarity), ``mate_id`` (the earliest row that attains it, NULL at 0) and
    ``mate_<order column>`` for other order columns. Rows without a vector have
    ``max_sim`` 0, and so have rows whose vector is not finite.

    With ``above`` only similarities above it are found, and ``max_sim`` is 0 up to it.
    """
    return compare_within_clusters(
        members, by, order, (), id_col, vector_col, block_rows, collapse_copies,
        with_sums=False, above=above,
    ).prior_similarity()
