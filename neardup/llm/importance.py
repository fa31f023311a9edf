"""Target-distribution importance resampling over hashed word n-grams.

A table of 256 bytes lower-cases A-Z and blanks what separates words, in the
UTF-8 bytes of a text; ``bytes.split`` then yields the words. The CRC-32 of a run
of words is the seed from which the run with one more word goes on. Counters of
buckets are reduced in each task and then summed by Spark, for the documents and
for the texts of the target; the log ratio of both is the gain of a bucket. The
sum of a document's gains plus seeded Gumbel noise is its score, and the highest
scores are drawn.

Defined results: a null or empty text has no features and weight 0, and is
scored but too short to be drawn; a null id takes the noise of the empty string and
comes after all others of its score; repeated rows score alike and get ranks of
their own, in any order; an empty table draws nothing, and an empty target
prefers what is rare. Other columns of the input have no influence. Long texts
are split a part at a time, cut at blanks only; nothing of them is left out.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neardup.llm.common import batches_of, fresh_name
from neardup.session import materialize

#: Bytes of one text that are split into words at once.
PART_BYTES = 1 << 20
BLANK = 32


@dataclass(frozen=True)
class Settings:
    """Runs of up to ``words`` words in ``buckets``; the best ``percent`` of the documents.

    Documents with fewer than ``min_words`` words are scored but never drawn.
    """

    words: int = 3
    buckets: int = 10_000
    percent: int = 5
    min_words: int = 20
    seed: int = 42


def _byte_table() -> bytes:
    table = bytearray(range(256))
    for c in range(128):
        if not chr(c).isalnum():
            table[c] = BLANK
        elif chr(c).isupper():
            table[c] = ord(chr(c).lower())
    return bytes(table)


WORD_BYTES = _byte_table()


def _parts(text: bytes) -> Iterator[bytes]:
    """A translated text cut at blanks into parts of about PART_BYTES, or longer words."""
    start = 0
    while len(text) - start > PART_BYTES:
        cut = text.rfind(b" ", start + 1, start + PART_BYTES)
        if cut < 0:
            cut = text.find(b" ", start + PART_BYTES)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def run_hashes(text: bytes, longest: int) -> Iterator[tuple[int, list[int]]]:
    """For each part of a text its number of words and the CRC-32 of all runs that end in it."""
    # By length of run, the hash of the one that ends with the last word so far.
    ends: list[int | None] = [None] * longest
    for part in _parts(text.translate(WORD_BYTES)):
        words = part.split()
        if not words:
            continue
        spaced = [b" " + w for w in words]
        runs = list(map(crc32, words))
        every = list(runs)
        for k in range(longest):
            end, ends[k] = ends[k], runs[-1] if runs else None
            if k + 1 < longest:
                seeds = runs[:-1] if end is None else [end, *runs[:-1]]
                runs = list(map(crc32, spaced[len(spaced) - len(seeds) :], seeds))
                every += runs
        yield len(words), every


def _buckets(hashes: list[int], settings: Settings) -> np.ndarray:
    return np.array(hashes, dtype=np.uint32) % np.uint32(settings.buckets)


def bucket_counts(
    docs: DataFrame, target: DataFrame, settings: Settings, text_col: str = "text"
) -> tuple[np.ndarray, np.ndarray]:
    """Features per bucket of all documents and of all target texts.

    A task keeps two counters of at most ``buckets`` entries; as many rows reach the driver.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters = {False: Counter(), True: Counter()}
        for batch in batches:
            for part in batches_of(batch, "text"):
                for wanted, text in zip(*(part.column(c).to_pylist() for c in ("wanted", "text"))):
                    for _, hashes in run_hashes(text or b"", settings.words):
                        counters[wanted].update(_buckets(hashes, settings).tolist())
        for wanted, counter in counters.items():
            columns = [[wanted] * len(counter), list(counter), list(counter.values())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.bool_(), pa.int32(), pa.int64()))],
                ["wanted", "bucket", "n"],
            )

    def texts(df: DataFrame, wanted: bool) -> DataFrame:
        return df.select(F.lit(wanted).alias("wanted"), F.col(text_col).cast("binary").alias("text"))

    both = texts(docs, False).unionByName(texts(target, True))
    found = both.mapInArrow(count, "wanted boolean, bucket int, n long")
    out = {False: np.zeros(settings.buckets, np.int64), True: np.zeros(settings.buckets, np.int64)}
    for row in found.groupBy("wanted", "bucket").agg(F.sum("n").alias("n")).collect():
        out[row.wanted][row.bucket] = row.n
    return out[False], out[True]


def gains(corpus: np.ndarray, target: np.ndarray) -> list[int]:
    """Thousandths of the log ratio of the smoothed shares, per bucket."""
    n, of_corpus, of_target = len(corpus), int(corpus.sum()), int(target.sum())
    return [
        math.floor(
            1000
            * math.log(
                (float(t + 1) * float(of_corpus + n)) / (float(s + 1) * float(of_target + n))
            )
        )
        for s, t in zip(corpus.tolist(), target.tolist())
    ]


def noise(doc_id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel draw that the seed and the id decide."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def score(
    docs: DataFrame,
    gain: list[int],
    settings: Settings,
    id_col: str = "doc_id",
    text_col: str = "text",
    output_col: str = "importance",
) -> DataFrame:
    """Adds a struct of ``n_words, n_features, weight, score``; one narrow stage."""
    table = docs.sparkSession.sparkContext.broadcast(np.array(gain, dtype=np.int64))

    @F.arrow_udf("struct<n_words:long,n_features:long,weight:long>")
    def weigh(texts: pa.Array) -> pa.Array:
        gain_of, out = table.value, []
        for part in batches_of(pa.RecordBatch.from_arrays([texts], ["text"]), "text"):
            for text in part.column(0).to_pylist():
                n_words = n_features = weight = 0
                for n, hashes in run_hashes(text or b"", settings.words):
                    n_words += n
                    n_features += len(hashes)
                    weight += int(gain_of[_buckets(hashes, settings)].sum())
                out.append((n_words, n_features, weight))
        columns = zip(*out) if out else ((), (), ())
        return pa.StructArray.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["n_words", "n_features", "weight"]
        )

    found = fresh_name(docs, "_weighed")
    weighed = docs.withColumn(found, weigh.asNondeterministic()(F.col(text_col).cast("binary")))
    names = ("n_words", "n_features", "weight")
    columns = [F.col(f"{found}.{c}").alias(c) for c in names]
    total = F.col(f"{found}.weight") + noise(F.col(id_col), settings.seed)
    return weighed.withColumn(output_col, F.struct(*columns, total.alias("score"))).drop(found)


def _order(settings: Settings) -> list[Column]:
    long_enough = F.col("n_words") >= settings.min_words
    return [long_enough.desc(), F.desc("score"), F.asc_nulls_last("doc_id")]


def rank_scores(scored: DataFrame, settings: Settings) -> DataFrame:
    """Adds ``rank`` to ``doc_id, n_words, score, ...``: 1 for the first drawn, null for the rest.

    The narrow rows are sorted by ranges, each range numbers its own rows, and the
    rows of earlier ranges are added; the numbers of rows per range are all that
    reaches the driver.
    """
    spark = scored.sparkSession
    stored = materialize(scored, "importance-scores")
    long_enough = stored.where(F.col("n_words") >= settings.min_words).count()
    drawn = settings.percent * long_enough // 100
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = _order(settings)
    # The id is the range's number over the row's place in it. Written out, so that
    # counts and ranks see the same ranges.
    at = F.monotonically_increasing_id()
    in_order = stored.repartitionByRange(n, *order).sortWithinPartitions(*order)
    placed = materialize(in_order.withColumn("_at", at), "importance-ranges")
    range_of = F.shiftright("_at", 33)
    sizes = dict(placed.groupBy(range_of.alias("r")).count().collect())
    before, offsets = 0, []
    for r in sorted(sizes):
        offsets.append((r, before))
        before += sizes[r]
    starts = spark.createDataFrame(offsets, "_range long, _before long")
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1
    return (
        placed.withColumn("_range", range_of)
        .join(F.broadcast(starts), "_range")  # as many rows as ranges
        .withColumn("rank", F.when(place <= drawn, place))
        .drop("_range", "_before", "_at")
    )


def importance(
    docs: DataFrame,
    target: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score, rank`` of every document."""
    corpus, wanted = bucket_counts(docs, target, settings, text_col)
    narrow = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    found = score(narrow, gains(corpus, wanted), settings)
    return rank_scores(found.select("doc_id", "importance.*"), settings)


def resample(
    docs: DataFrame,
    target: DataFrame,
    settings: Settings = Settings(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The drawn rows of ``docs`` with their own columns.

    Nothing is joined: rows are scored where they are and compared with the last
    drawn score and id. Repeats of that very row all come along.
    """
    corpus, wanted = bucket_counts(docs, target, settings, text_col)
    gain = gains(corpus, wanted)
    found = fresh_name(docs, "_importance")
    scored = score(docs, gain, settings, id_col, text_col, found)
    narrow = scored.select(F.col(id_col).alias("doc_id"), f"{found}.*")
    last = rank_scores(narrow, settings).where("rank is not null")
    last = last.orderBy(F.desc("rank")).select("score", "doc_id").first()
    if last is None:
        return docs.where(F.lit(False))
    of = F.col(f"{found}.score")
    tied = (of == last.score) if last.doc_id is None else (of == last.score) & (F.col(id_col) <= last.doc_id)
    enough = F.col(f"{found}.n_words") >= settings.min_words
    return scored.where(enough & ((of > last.score) | tied)).drop(found)
