"""Document fingerprints by locally consistent parsing.

A text is a sequence of code points. Each level cuts it into phrases of a few
symbols and names every phrase by a hash of its symbols; the names are the
symbols of the next level. Cuts come from deterministic coin tossing: runs of
one symbol become one symbol, each symbol then takes the place and value of the
lowest bit in which it differs from its left neighbour, again and again until
few colours are left, and phrases begin at the local maxima of the colours. A
cut so depends on a handful of neighbours only: equal substrings are cut and
named alike inside, wherever they stand.

A fingerprint is the minima of ``SLOTS`` hashes over the phrase names of level
``LEVELS``, 16 bits each, in hexadecimal; the likeness of two is the share of
equal slots, an estimate of how many phrases they share.

Defined results: a null text counts as empty; the empty text's fingerprint is
all f, alike (1) to another empty text and unlike (0) any other. Equal texts
have equal fingerprints. Rows with one id are ordered by a hash of their text;
a null id comes first. In a table of one row the next document is itself.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neardup.llm.common import mix64, steps, text_or_empty

LEVELS, SLOTS = 3, 64
#: Code points worked on at once.
STEP_CHARS = 1 << 17
#: Ranges of ids per shuffle partition: many, so that partitions even out.
RANGES_EACH = 8

_FLIP = mix64(np.arange(1, SLOTS + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
_TIMES = mix64(_FLIP) | np.uint64(1)
_PLACES = mix64(_FLIP + np.uint64(1)) | np.uint64(1)
_EMPTY = "ffff" * SLOTS


def _lowest_bit(power: np.ndarray) -> np.ndarray:
    """Exponents of powers of two, which doubles hold exactly."""
    return ((power.astype(np.float64).view(np.uint64) >> np.uint64(52)) - np.uint64(1023)).astype(
        np.uint8
    )


def _toss_table(size: int) -> np.ndarray:
    """New colour by (left colour, colour) for colours below ``size``."""
    out = np.zeros((size, size), dtype=np.uint8)
    for a in range(size):
        for b in range(size):
            if a != b:
                k = ((a ^ b) & -(a ^ b)).bit_length() - 1
                out[a, b] = 2 * k + (b >> k & 1)
    return out.ravel()


# Colours stay below 128, then 14, 8 and 6.
_TOSSES = [(128, _toss_table(128)), (16, _toss_table(16)), (8, _toss_table(8))]


def _phrases(x: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrases of symbols ``x``, and their texts; ``doc`` ascends."""
    # Runs of one symbol become one symbol.
    first = np.ones(len(x), dtype=bool)
    first[1:] = (x[1:] != x[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(first)
    length = np.diff(at, append=len(x)).astype(np.uint64)
    x, doc = x[at], doc[at]
    long = np.flatnonzero(length > 1)
    if len(long):
        x[long] = mix64(x[long] + length[long] * np.uint64(0x9E3779B97F4A7C15))
    opens = np.ones(len(x), dtype=bool)
    opens[1:] = doc[1:] != doc[:-1]
    # First toss on the symbols; the start of a text stands beside its complement in bit 0.
    left = np.empty_like(x)
    left[1:] = x[:-1]
    left[opens] = x[opens] ^ np.uint64(1)
    differ = x ^ left
    lowest = differ & (~differ + np.uint64(1))
    k = _lowest_bit(lowest)
    colour = (2 * k + ((x >> k.astype(np.uint64)) & np.uint64(1)).astype(np.uint8)).astype(np.uint8)
    for size, table in _TOSSES:
        before = np.empty_like(colour)
        before[1:] = colour[:-1]
        before[opens] = colour[opens] ^ 1
        colour = table[before.astype(np.int32) * size + colour]
    # Local maxima of the colours open phrases, and so does every start of a text.
    rise = np.ones(len(x), dtype=bool)
    rise[1:] = colour[1:] > colour[:-1]
    fall = np.zeros(len(x), dtype=bool)
    fall[:-1] = (colour[:-1] > colour[1:]) & ~opens[1:]
    cut = np.flatnonzero((rise & fall & ~np.roll(opens, 1)) | opens)
    place = np.arange(len(x)) - np.repeat(cut, np.diff(cut, append=len(x)))
    # Phrases have a few symbols; each place has a multiplier of its own.
    value = (x + np.uint64(1)) * _PLACES[np.minimum(place, len(_PLACES) - 1)]
    return mix64(np.add.reduceat(value, cut)), doc[cut]


def fingerprints(texts: list[str]) -> list[str]:
    """Fingerprints of texts, worked on together."""
    out = [_EMPTY] * len(texts)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    if not sizes.sum():
        return out
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    x, doc = points.astype(np.uint64), np.repeat(np.arange(len(texts)), sizes)
    for _ in range(LEVELS):
        x, doc = _phrases(x, doc)
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    slots = np.empty((len(starts), SLOTS), dtype=">u2")
    for j in range(SLOTS):
        low = np.minimum.reduceat((x ^ _FLIP[j]) * _TIMES[j], starts)
        # Never ffff, which stands for no phrase.
        slots[:, j] = np.minimum(mix64(low) >> np.uint64(48), np.uint64(0xFFFE))
    for d, row in zip(doc[starts], slots):
        out[d] = row.tobytes().hex()
    return out


def likeness(a: str, b: str) -> float:
    """Share of equal slots of two fingerprints."""
    if a == b:
        return 1.0
    if _EMPTY in (a, b):
        return 0.0
    x, y = (np.frombuffer(bytes.fromhex(s), dtype=np.uint16) for s in (a, b))
    return float((x == y).sum()) / SLOTS


def fingerprint(text: str | Column) -> Column:
    """Fingerprint of a text column."""

    @F.arrow_udf("string")
    def run(texts: pa.Array) -> pa.Array:
        rows, out = texts.to_pylist(), []
        for a, b in steps(map(len, rows), STEP_CHARS):
            out += fingerprints(rows[a:b])
        return pa.array(out, pa.string())

    return run(text_or_empty(text))


# --- each document, edited, and the next one --------------------------------


def edited(text: str, after: str) -> str:
    """The text with its last quarter replaced by the start of the next document."""
    n = len(text) // 4
    return text[: len(text) - n] + after[:n]


def _ranges(docs: DataFrame, id_col: str, n: int) -> list[int]:
    """Cuts of the ids into about ``n`` even ranges."""
    levels = [i / n for i in range(1, n)]
    at = F.percentile_approx(F.col(id_col), levels, max(10_000, 10 * n))
    return sorted(set(docs.agg(at).first()[0] or []))


_PAIR = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
    "edited_fingerprint string, near_edited double, near_next double"
)


def compare_with_next(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Every document beside its edited form and the next document by id (the last: the first).

    Texts are shuffled once, compressed, by ranges of ids. A range also gets
    the first document of the next range, so that no row looks for its
    neighbour elsewhere. A task streams through its ranges in order.
    """
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ids = docs.select(F.col(id_col).cast("long").alias("id"))
    cuts = np.array(_ranges(ids, "id", parts * RANGES_EACH), dtype=np.int64)

    def range_of(values: np.ndarray) -> np.ndarray:
        return np.searchsorted(cuts, values, side="right")

    @F.arrow_udf("int")
    def range_udf(values: pa.Array) -> pa.Array:
        filled = values.fill_null(least).to_numpy()
        return pa.array(range_of(filled).astype(np.int32))

    least = int(np.iinfo(np.int64).min)
    # Smallest id of each range that has rows: as many rows as ranges.
    lowest = (
        ids.groupBy(range_udf("id").alias("r"))
        .agg(F.min(F.coalesce("id", F.lit(least).cast("long"))).alias("low"))
        .toArrow()
        .sort_by("r")
    )
    used, low = lowest["r"].to_pylist(), lowest["low"].to_pylist()
    # The range before each used one; the first follows the last.
    before = {r: used[i - 1] for i, r in enumerate(used)}
    firsts = dict(zip(used, low))

    def send(batches):
        """(range, order, text): the rows, and the first rows of a range once more before it."""
        for batch in batches:
            given = batch.column(0)
            keys = given.fill_null(least).to_pylist()
            texts = batch.column(1).to_pylist()
            for a, b in steps((len(t) for t in texts), 1 << 20):
                out = []
                for key, known, text in zip(keys[a:b], given[a:b].is_valid().to_pylist(), texts[a:b]):
                    data = text.encode()
                    packed, tie = zlib.compress(data, 1), zlib.crc32(data)
                    r = int(range_of(np.array([key]))[0])
                    out.append((r, 0, key, tie, known, packed))
                    if key == firsts[r]:
                        out.append((before[r], 1, key, tie, known, packed))
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x, t) for x, t in zip(zip(*out), kinds)],
                    ["r", "borrowed", "id", "tie", "known", "packed"],
                )

    def compare(rows: list[tuple]) -> pa.RecordBatch:
        changed = [edited(t, after) for _, t, after in rows]
        prints = fingerprints([t for _, t, _ in rows])
        edits = fingerprints(changed)
        # The next document's is known but for the last row's.
        nexts = [*prints[1:], *fingerprints([rows[-1][2]])]
        for i in range(len(rows) - 1):
            if rows[i][2] != rows[i + 1][1]:
                nexts[i] = fingerprints([rows[i][2]])[0]
        return pa.RecordBatch.from_arrays(
            [
                pa.array([i for i, *_ in rows], pa.int64()),
                pa.array([len(t) for _, t, _ in rows], pa.int64()),
                pa.array([hashlib.sha256(t.encode()).hexdigest() for t in changed]),
                pa.array(prints),
                pa.array(edits),
                pa.array([likeness(a, b) for a, b in zip(prints, edits)]),
                pa.array([likeness(a, b) for a, b in zip(prints, nexts)]),
            ],
            [c.split()[0] for c in _PAIR.split(", ")],
        )

    def run(batches):
        last, ready, size = None, [], 0
        for batch in batches:
            for i in range(batch.num_rows):
                r, borrowed, key, _, known, packed = (c[i].as_py() for c in batch.columns)
                text = zlib.decompress(packed).decode()
                if last is not None and last[0] == r:
                    ready.append((last[1], last[2], text))
                    size += 2 * len(last[2])
                # Only the first of the borrowed rows follows the range.
                last = None if borrowed else (r, key if known else None, text)
                if size > STEP_CHARS:
                    yield compare(ready)
                    ready, size = [], 0
        if ready:
            yield compare(ready)

    texts = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    sent = texts.mapInArrow(
        send, "r int, borrowed int, id long, tie long, known boolean, packed binary"
    )
    placed = sent.repartition(parts, "r").sortWithinPartitions("r", "borrowed", "id", "tie")
    return placed.mapInArrow(run, _PAIR)
