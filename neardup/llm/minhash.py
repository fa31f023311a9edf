"""Near-duplicates by b-bit MinHash: low bits of minima, estimated, then confirmed.

1. One pass sketches every text: the number of its word shingles, a 128-bit key
   of its shingle set, a key per band of minima, and the low ``bits`` of all
   minima packed together.
2. Texts with equal sets become one class, so copies never meet one another.
3. Classes that share a band are candidates. Within a band the packed low bits
   are compared by counting equal groups; the estimate is corrected for groups
   that agree by chance (1 / 2 ** bits of the unlike ones). Of the pairs that
   may reach the similarity (``SLACK`` standard deviations below it) only a
   forest is kept. Its components hold every link that a band found.
4. Within these components all pairs are compared on the full sets; links that
   hold leave as a forest again, and its components are the result.

Large bands and components are cut into blocks and compared block by block, so
that a group of near copies of any size is exact, spread over tasks and never
listed pair by pair. The work within one such group grows with the square of
its different texts.

Defined results: words are runs of bytes other than space and \\t to \\r, in
lower case for A to Z only; with fewer words than a shingle the whole sequence
is one; without words the set is empty and linked with nothing. Null texts
count as empty. Rows that repeat an id are one document, linked where any of
them is, whatever texts they have; ``without_copies`` judges each text by itself.
A null id is linked with nothing: its component is null, and it stays.
Other columns of the input are ignored. Ids are whole numbers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neardup.llm.common import mix64, return_memory, steps
from neardup.llm.components import components
from neardup.session import broadcast_if_small, fits_broadcast, materialize

#: Standard deviations by which an estimate may miss before a link is lost.
SLACK = 5.0
#: Bytes of text hashed at once, and classes of a band or component per block.
STEP_BYTES = 1 << 18
BAND_BLOCK, SET_BLOCK = 1024, 256
#: Columns of the dense matrix in which sets are compared.
SET_COLUMNS = 4096
#: Words whose hashes a task remembers before it starts anew.
CACHED_WORDS = 1 << 17
#: Ids broadcast to find the texts of candidates; beyond it they are joined.
BROADCAST_IDS = 2_000_000


@dataclass(frozen=True)
class Settings:
    """``words`` per shingle, similarity in ``percent``, ``bands`` of ``rows`` minima.

    A pair of the given similarity s shares no band with probability
    (1 - s ** rows) ** bands.
    """

    words: int = 5
    percent: int = 80
    bands: int = 40
    rows: int = 5
    bits: int = 2
    seed: int = 1

    def __post_init__(self):
        if self.bits not in (1, 2, 4, 8) or not 0 < self.percent <= 100 or self.words < 1:
            raise ValueError("bits must be 1, 2, 4 or 8, percent 1 to 100, words positive")

    @property
    def slots(self) -> int:
        return self.bands * self.rows

    @cached_property
    def constants(self) -> tuple[np.ndarray, np.ndarray]:
        n = np.arange(1, self.slots + 1, dtype=np.uint64) + np.uint64(self.seed * 1_000_003)
        return mix64(n), mix64(n + np.uint64(1 << 40)) | np.uint64(1)

    @property
    def chance(self) -> float:
        """Probability that the low bits of different minima agree."""
        return 2.0**-self.bits

    def estimate(self, equal: float) -> float:
        """Similarity from the number of equal low-bit groups, corrected for chance."""
        return max(0.0, (equal / self.slots - self.chance) / (1 - self.chance))

    @property
    def least_equal(self) -> int:
        """Equal groups below which a pair is no candidate."""
        s = self.percent / 100
        p = self.chance + (1 - self.chance) * s
        return math.ceil(self.slots * p - SLACK * math.sqrt(self.slots * p * (1 - p)))


# --- sketches --------------------------------------------------------------


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_word_hashes = _Hashes()


def shingle_sets(texts: list[bytes | None], words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of all texts, ascending per text, and where each starts."""
    split = [t.lower().split() if t else [] for t in texts]
    counts = np.array([len(w) for w in split], dtype=np.int64)
    n = int(counts.sum())
    known = _word_hashes.__getitem__
    h = np.fromiter((known(w) for ws in split for w in ws), np.uint64, n)
    ends = np.cumsum(counts)
    sizes = np.where(counts >= words, counts - words + 1, counts > 0)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    # First word of each shingle, and how many words it has.
    at = np.arange(starts[-1]) + np.repeat(ends - counts - starts[:-1], sizes)
    length = np.repeat(np.minimum(counts, words), sizes)
    s = np.zeros(len(at), dtype=np.uint64)
    for k in range(words):
        inside = length > k
        s[inside] = mix64(s[inside]) + h[at[inside] + k]
    s = mix64(s + length.astype(np.uint64))
    for a, b in zip(starts[:-1], starts[1:]):
        s[a:b].sort()
    of = np.repeat(np.arange(len(texts)), sizes)
    first = np.ones(len(s), dtype=bool)
    first[1:] = (s[1:] != s[:-1]) | (of[1:] != of[:-1])
    distinct = np.bincount(of[first], minlength=len(texts))
    return s[first], np.concatenate([[0], np.cumsum(distinct)])


def _minima(s: np.ndarray, starts: np.ndarray, settings: Settings) -> np.ndarray:
    """``[slots, sets]`` minima of non-empty sets."""
    flip, times = settings.constants
    out = np.empty((settings.slots, len(starts)), dtype=np.uint64)
    buffer = np.empty_like(s)
    for j in range(settings.slots):
        np.bitwise_xor(s, flip[j], out=buffer)
        np.multiply(buffer, times[j], out=buffer)
        np.minimum.reduceat(buffer, starts, out=out[j])
    return out


def pack(minima: np.ndarray, bits: int) -> np.ndarray:
    """``[sets, bytes]``: the low bits of the upper half of each minimum, side by side."""
    low = ((minima >> np.uint64(32)) & np.uint64((1 << bits) - 1)).astype(np.uint8).T
    per = 8 // bits
    low = np.pad(low, ((0, 0), (0, -low.shape[1] % (8 * per))))
    groups = low.reshape(len(low), -1, per)
    return np.bitwise_or.reduce(groups << np.arange(0, 8, bits, dtype=np.uint8), axis=2)


def count_equal(a: np.ndarray, b: np.ndarray, settings: Settings) -> np.ndarray:
    """Equal low-bit groups of packed signatures (64-bit words, last axis), by bit counts."""
    differs = a ^ b
    shift = 1
    while shift < settings.bits:
        differs |= differs >> np.uint64(shift)
        shift *= 2
    one_each = np.uint64(int("1".rjust(settings.bits, "0") * (64 // settings.bits), 2))
    return settings.slots - np.bitwise_count(differs & one_each).sum(axis=-1, dtype=np.int32)


_SKETCH = "id long, h long, n long, k0 long, k1 long, bands array<long>, low binary"


def _set_keys(s: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128-bit key of each set, in two halves; 0 for an empty one."""
    full = np.flatnonzero(np.diff(starts) > 0)
    k0, k1 = np.zeros(len(starts) - 1, np.uint64), np.zeros(len(starts) - 1, np.uint64)
    if len(full):
        at = starts[:-1][full]
        k0[full] = np.add.reduceat(mix64(s), at)
        k1[full] = np.add.reduceat(mix64(s ^ np.uint64(0x9E3779B97F4A7C15)), at)
    return k0.view(np.int64), k1.view(np.int64)


def _sketch_task(settings: Settings):
    schema = pa.schema(
        [(c, pa.int64()) for c in ("id", "h", "n", "k0", "k1")]
        + [("bands", pa.list_(pa.int64())), ("low", pa.binary())]
    )

    def sketch(ids: pa.Array, hashes: pa.Array, texts: list[bytes | None]) -> pa.RecordBatch:
        s, starts = shingle_sets(texts, settings.words)
        n = np.diff(starts)
        full = np.flatnonzero(n > 0)
        k0, k1 = _set_keys(s, starts)
        bands, low = [[]] * len(n), [b""] * len(n)
        if len(full):
            at = starts[:-1][full]
            minima = _minima(s, at, settings)
            keys = np.arange(settings.bands, dtype=np.uint64)[:, None] * np.ones(len(at), np.uint64)
            for r in range(settings.rows):
                keys = mix64(keys) + minima[r :: settings.rows]
            keys = np.ascontiguousarray(mix64(keys).T).view(np.int64)
            packed = pack(minima, settings.bits)
            for i, row in enumerate(full):
                bands[row], low[row] = keys[i], packed[i].tobytes()
        columns = [ids, hashes, pa.array(n), pa.array(k0), pa.array(k1)]
        columns += [pa.array(bands, pa.list_(pa.int64())), pa.array(low, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, schema=schema)

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for a, b in steps((len(t or b"") for t in texts), STEP_BYTES):
                yield sketch(*(batch.column(c).slice(a, b - a) for c in ("id", "h")), texts[a:b])
        _word_hashes.clear()  # the worker lives on
        return_memory()

    return run


# --- groups inside a task --------------------------------------------------


def runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Rows with equal keys of a sorted partition, one group at a time."""
    pending: list[pa.Table] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        k = np.stack([table[c].to_numpy() for c in keys], axis=1)
        if pending and not np.array_equal(k[0], last):
            yield pa.concat_tables(pending)
            pending = []
        cuts = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), len(k)]
        for a, b in zip(bounds[:-2], bounds[1:-1]):
            yield pa.concat_tables([*pending, table.slice(a, b - a)])
            pending = []
        pending.append(table.slice(bounds[-2]))
        last = k[-1]
    if pending:
        yield pa.concat_tables(pending)


def forest(linked: np.ndarray) -> np.ndarray:
    """For each row of a symmetric boolean matrix the smallest row that it is connected with."""
    label = np.arange(len(linked))
    far = len(linked)
    while True:
        near = np.where(linked, label[None, :], far).min(axis=1)
        new = np.minimum(label, near)
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Rows of the two blocks of a group."""
    p, q = table["p"][0].as_py(), table["q"][0].as_py()
    block = table["block"].to_numpy()
    every = np.arange(table.num_rows)
    return (every, every) if p == q else (every[block == p], every[block == q])


def _square(n: int, left: np.ndarray, right: np.ndarray, hit: np.ndarray) -> np.ndarray:
    linked = np.zeros((n, n), dtype=bool)
    linked[np.ix_(left, right)] = hit
    return linked | linked.T


_EDGES = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _edges(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    differ = a != b
    return pa.RecordBatch.from_arrays([pa.array(a[differ]), pa.array(b[differ])], schema=_EDGES)


def _candidate_task(settings: Settings):
    """Forest of the pairs of a band whose estimate may reach the similarity."""
    least = settings.least_equal

    def words_of(table: pa.Table) -> np.ndarray:
        low = b"".join(table["low"].to_pylist())
        return np.frombuffer(low, dtype=np.uint64).reshape(table.num_rows, -1)

    def pairs(tables: list[pa.Table]) -> pa.RecordBatch:
        table = pa.concat_tables(tables)
        ids, words = table["id"].to_numpy(), words_of(table)
        near = count_equal(words[::2], words[1::2], settings) >= least
        return _edges(ids[::2][near], ids[1::2][near])

    def run(batches):
        twos: list[pa.Table] = []
        for table in runs(batches, ["key", "p", "q"]):
            if table.num_rows == 2 and table["p"][0] == table["q"][0]:
                twos.append(table)
                if len(twos) == 4096:
                    yield pairs(twos)
                    twos = []
                continue
            left, right = _sides(table)
            if not len(left) or not len(right) or table.num_rows < 2:
                continue
            ids, words = table["id"].to_numpy(), words_of(table)
            hit = np.empty((len(left), len(right)), dtype=bool)
            for i, row in enumerate(left):
                hit[i] = count_equal(words[row][None, :], words[right], settings) >= least
            root = forest(_square(len(ids), left, right, hit))
            yield _edges(ids, ids[root])
        if twos:
            yield pairs(twos)

    return run


def _confirm_task(settings: Settings):
    """Forest of the pairs of a component whose full sets reach the similarity."""

    def common(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
        if len(sets) == 2:
            both = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
            sizes = np.diag([len(s) for s in sets]) + both * (1 - np.eye(2, dtype=int))
            return sizes[np.ix_(left, right)].astype(np.float64)
        row = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        _, column, n = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        # Shingles of one set only have no part in an intersection of two.
        shared = n > 1
        number = np.cumsum(shared) - 1
        keep = shared[column]
        row, column = row[keep], number[column[keep]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        total = np.zeros((len(left), len(right)))
        width = int(shared.sum())
        for at in range(0, width, SET_COLUMNS):
            a, b = np.searchsorted(column, [at, at + SET_COLUMNS])
            has = np.zeros((len(sets), min(SET_COLUMNS, width - at)), dtype=np.float32)
            has[row[a:b], column[a:b] - at] = 1
            total += has[left] @ has[right].T
        return total

    def run(batches):
        for table in runs(batches, ["root", "p", "q"]):
            left, right = _sides(table)
            if not len(left) or not len(right) or table.num_rows < 2:
                continue
            ids = table["id"].to_numpy()
            sets = [np.frombuffer(s, dtype=np.uint64) for s in table["shingles"].to_pylist()]
            size = np.array([len(s) for s in sets], dtype=np.float64)
            both = common(sets, left, right)
            union = size[left][:, None] + size[right][None, :] - both
            hit = 100 * both >= settings.percent * union
            root = forest(_square(len(ids), left, right, hit))
            yield _edges(ids, ids[root])
        return_memory()

    return run


def _in_blocks(rows: DataFrame, key: str, block_rows: int) -> DataFrame:
    """Sends the rows of a group (size ``size``) to each pair of blocks they belong to."""
    blocks = F.ceil(F.col("size") / F.lit(block_rows)).cast("long")
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        rows.withColumn("block", F.pmod(F.xxhash64(F.col("id"), F.lit(7)), blocks))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        .withColumn("p", F.least("block", "other"))
        .withColumn("q", F.greatest("block", "other"))
        .drop("other", "size")
        .repartition(n, key, "p", "q")
        .sortWithinPartitions(key, "p", "q")
    )


# --- the operator ----------------------------------------------------------


def _set_task(settings: Settings):
    """Shingles of the texts whose set is the one asked for: an id may have others too."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            rest = batch.drop_columns(["text", "n", "k0", "k1"])
            wanted = [batch.column(c).to_numpy() for c in ("n", "k0", "k1")]
            for a, b in steps((len(t or b"") for t in texts), STEP_BYTES):
                s, starts = shingle_sets(texts[a:b], settings.words)
                own = (np.diff(starts), *_set_keys(s, starts))
                same = np.logical_and.reduce([x == w[a:b] for x, w in zip(own, wanted)])
                sets = [s[starts[i] : starts[i + 1]].tobytes() for i in np.flatnonzero(same)]
                part = rest.slice(a, b - a).filter(pa.array(same))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(sets, pa.binary())],
                    [*part.schema.names, "shingles"],
                )
        _word_hashes.clear()
        return_memory()

    return run


def _judged(docs: DataFrame, settings: Settings, id_col: str, text_col: str, by_id: bool) -> DataFrame:
    """``id, h, n, part, component`` of every row, ``h`` being the hash of its text.

    ``part`` names the group of linked texts (null without words), whose smallest
    id is the component: two groups may share that id.
    With ``by_id`` the texts of one id are linked, else each text stands for itself.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    sketched = rows.withColumn("h", F.xxhash64("text")).mapInArrow(_sketch_task(settings), _SKETCH)
    # The place of a row is stored with it, and so stays what it is.
    sketches = materialize(
        sketched.withColumn("row", F.monotonically_increasing_id()), "sketches"
    )
    usable = sketches.where((F.col("n") > 0) & F.col("id").isNotNull())
    keys = ["k0", "k1", "n"]
    # One row stands for its class; ids cannot, since one may have texts of several classes.
    classes = materialize(
        usable.groupBy(*keys).agg(F.min("id").alias("id"), F.min("row").alias("row")), "classes"
    )
    of_class = usable.select("row", "bands", "low").join(classes.select("row"), "row")
    of_class = of_class.withColumnRenamed("row", "id")
    in_bands = of_class.select("id", F.explode("bands").alias("key"))
    sizes = in_bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    sizes = materialize(sizes, "bands")
    members = materialize(in_bands.join(sizes, "key"), "band-members")
    low = of_class.select("id", "low")
    candidates = (
        _in_blocks(members.join(low, "id"), "key", BAND_BLOCK)
        .mapInArrow(_candidate_task(settings), "a long, b long")
    )
    groups = materialize(
        components(candidates).withColumnsRenamed({"node": "row", "component": "root"}), "groups"
    )
    group_sizes = materialize(groups.groupBy("root").agg(F.count(F.lit(1)).alias("size")), "sizes")
    wanted = groups.join(group_sizes, "root").join(classes, "row")
    if fits_broadcast(groups.count(), 96) and groups.count() <= BROADCAST_IDS:
        wanted = F.broadcast(wanted)
    in_groups = (
        rows.join(wanted, "id")
        .select(F.col("row").alias("id"), "root", "size", *keys, "text")
        .mapInArrow(_set_task(settings), "id long, root long, size long, shingles binary")
    )
    ids = sketches.where("id is not null").groupBy("id").agg(F.count(F.lit(1)).alias("m"))
    repeated = materialize(ids.where("m > 1").select("id"), "repeated")
    repeats = not repeated.isEmpty()
    if repeats:  # rows that repeat an id and its text bring a set more than once
        in_groups = in_groups.dropDuplicates(["id"])
    links = _in_blocks(in_groups, "root", SET_BLOCK).mapInArrow(
        _confirm_task(settings), "a long, b long"
    )
    if repeats and by_id:
        of_id = usable.join(repeated, "id").select("id", *keys)
        of_id = of_id.join(classes.select(*keys, "row"), keys).select("id", "row").distinct()
        of_id = materialize(of_id, "classes-of-ids")
        first = materialize(of_id.groupBy("id").agg(F.min("row").alias("first")), "first-classes")
        same = of_id.join(first, "id").select(F.col("row").alias("a"), F.col("first").alias("b"))
        links = links.unionByName(same)
    linked = classes.select("row", "id").join(
        components(links).withColumnRenamed("node", "row"), "row"
    )
    linked = materialize(linked, "linked")
    least = linked.groupBy("component").agg(F.min("id").alias("least"))
    least = broadcast_if_small(materialize(least, "components"), 64)
    least = linked.join(least, "component").select("row", "component", "least")
    named = classes.join(least, "row", "left").select(
        *keys, F.coalesce("component", "row").alias("part"), F.coalesce("least", "id").alias("least")
    )
    named = materialize(named, "named-classes")
    out = sketches.select("id", "h", *keys).join(named, keys, "left")
    if repeats and by_id:
        # Rows without words follow the texts that their id has elsewhere.
        of_ids = sketches.join(repeated, "id").where("n > 0").select("id", *keys)
        of_ids = of_ids.join(named, keys).groupBy("id").agg(F.min("least").alias("of_id"))
        out = out.join(materialize(of_ids, "components-of-ids"), "id", "left")
        out = out.withColumn("least", F.coalesce("of_id", "least"))
    return out.select("id", "h", "n", "part", F.coalesce("least", "id").alias("component"))


def near_duplicates(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row.

    The component is the smallest id reachable over links; the row of that id
    is kept.
    """
    return _judged(docs, settings, id_col, text_col, by_id=True).select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(True)).alias("kept"),
    )


def without_copies(
    docs: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row of each group of near-duplicates, with the columns of the input.

    Only rows whose own text is a copy go. Of the rows of one id whose texts are
    linked, or without words, the one whose text has the smallest hash stays.
    Rows with a null id all stay.
    """
    found = _judged(docs, settings, id_col, text_col, by_id=False)
    found = materialize(found.where(F.col("id").isNotNull()), "judged")
    ids = found.groupBy("id").agg(F.count(F.lit(1)).alias("m"))
    repeated = materialize(ids.where("m > 1").select("id"), "repeated-ids")
    several = not repeated.isEmpty()
    once = found.join(repeated, "id", "left_anti") if several else found
    gone = materialize(once.where("id <> component").select(F.col("id").alias(id_col)), "copies")
    n = gone.count()
    side = F.broadcast(gone) if fits_broadcast(n, 64) and n <= BROADCAST_IDS else gone
    rest = docs.join(side, id_col, "left_anti")
    if not several:
        return rest
    stay = (
        found.join(repeated, "id").where("id = component")
        .groupBy("id", "part").agg(F.min("h").alias("h"))
        .select(F.col("id").alias(id_col), F.col("h").alias("_h")).distinct()
    )
    again = materialize(repeated.select(F.col("id").alias(id_col)), "repeated-again")
    row = F.struct(*[F.col(c) for c in rest.columns])
    own = F.xxhash64(F.col(text_col).cast("string"))
    one_each = (
        rest.join(again, id_col, "left_semi")
        .select(F.col(id_col).alias("_id"), own.alias("_h"), row.alias("_row"))
        .join(materialize(stay.withColumnRenamed(id_col, "_id"), "staying"), ["_id", "_h"], "left_semi")
        .groupBy("_id", "_h")
        .agg(F.first("_row").alias("_row"))
        .select(*[F.col(f"_row.`{c}`").alias(c) for c in rest.columns])
    )
    return rest.join(again, id_col, "left_anti").unionByName(one_each)
