"""Line-delimited corpora with line numbers, without a copy of the corpus."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from neardup.session import broadcast_if_small, scratch_path

#: Bytes of a file that one task reads, whatever the session says.
SPLIT_BYTES = 128 << 20
# The place of a row in its task, in the numbers of monotonically_increasing_id.
_PLACE = (1 << 33) - 1
_SPLIT = ("file_path", "file_block_start")


def _cut_session(spark: SparkSession, split_bytes: int) -> SparkSession:
    """A session in which every file is cut into ranges of ``split_bytes``, one for a task.

    A scan takes its ranges from the session that made it, so that neither later
    settings nor a join with other tables change them.
    """
    cut = spark.newSession()
    cut.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    cut.conf.set("spark.sql.files.openCostInBytes", str(split_bytes))
    return cut


def _lines(spark: SparkSession, paths: str | list[str], split_bytes: int) -> DataFrame:
    """Every line with its range of bytes and its place among the lines of its task."""
    return _cut_session(spark, split_bytes).read.text(paths).select(
        "value",
        *[F.col(f"_metadata.{c}").alias(c) for c in (*_SPLIT, "file_size")],
        F.monotonically_increasing_id().bitwiseAND(_PLACE).alias("_place"),
    )


def _literal(file_path: str) -> str:
    """A path that reads the one file which Spark's metadata names so."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", unquote(file_path))


@dataclass(frozen=True)
class IndexedCorpus:
    """The lines of text files and how many of them come before each range of bytes.

    ``index``: one row per range, with the file's size at that time; the ranges
    are ``split_bytes`` long. It is all that is stored.
    """

    path: str
    index: DataFrame
    split_bytes: int

    def read(self, lines: tuple[int, int] | None = None, with_split: bool = False) -> DataFrame:
        """``line_no, value``, of the files with line numbers from ``lines[0]`` up to ``lines[1]``.

        ``with_split`` adds ``first_line``, the first line number of the row's range.
        No line is shuffled while the index can be broadcast. A file that changed
        since it was indexed is an error.
        """
        spark, index, paths = self.index.sparkSession, self.index, self.path
        if lines is not None:
            touched = (F.col("_before") < lines[1]) & (F.col("_before") + F.col("_n") > lines[0])
            files = index.where(touched).select("file_path").distinct().collect()
            paths = sorted(_literal(r.file_path) for r in files)
            if not paths:
                return self.read(with_split=with_split).where(F.lit(False))
        found = _lines(spark, paths, self.split_bytes)
        place = broadcast_if_small(index.withColumnRenamed("file_size", "_size"), 512)
        # The session's own table on the left: the result belongs to the session.
        numbered = place.join(found, list(_SPLIT), "right")
        known = F.col("_size").eqNullSafe(F.col("file_size"))
        changed = F.concat(F.lit("not indexed, or changed since: "), F.col("file_path"))
        first = F.when(known, F.col("_before")).otherwise(F.raise_error(changed).cast("long"))
        out = numbered.select(
            (first + F.col("_place") - F.col("_start")).alias("line_no"),
            "value",
            F.col("_before").alias("first_line"),
        )
        if lines is not None:
            out = out.where(F.col("line_no").between(lines[0], lines[1] - 1))
        return out if with_split else out.drop("first_line")

    def batches(self, most: int) -> Iterator[tuple[int, int]]:
        """Line ranges of whole byte ranges, each of about ``most`` lines or one byte range."""
        begin = end = 0
        for before, n in sorted(self.index.select("_before", "_n").collect()):
            if before + n - begin > most and end > begin:
                yield begin, end
                begin = before
            end = before + n
        if end > begin:
            yield begin, end


def index_corpus(
    spark: SparkSession,
    path: str,
    index_path: str | None = None,
    split_bytes: int = SPLIT_BYTES,
) -> IndexedCorpus:
    """Count the lines of every range of the files below ``path``, in path order.

    The index is written to ``index_path``, or to scratch. One row per range is
    ordered globally; no line moves.
    """
    counts = _lines(spark, path, split_bytes).groupBy(*_SPLIT, "file_size").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_start")
    )
    earlier = Window.orderBy(*_SPLIT).rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    rows = counts.select(*_SPLIT, "file_size", "_n", "_start", before)
    rows = rows.withColumn("_split_bytes", F.lit(split_bytes).cast("long"))
    index_path = index_path or scratch_path(spark, "line-index")
    rows.write.mode("overwrite").parquet(index_path)
    # Read by the caller's session, not by the one that cut the files.
    return open_corpus(spark, path, index_path)


def open_corpus(spark: SparkSession, path: str, index_path: str) -> IndexedCorpus:
    """A corpus with the index of an earlier session; the files are cut as then."""
    stored = spark.read.parquet(index_path)
    sizes = stored.select("_split_bytes").distinct().collect()
    return IndexedCorpus(path, stored.drop("_split_bytes"), sizes[0][0] if sizes else SPLIT_BYTES)


def read_corpus(
    spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, with_split: bool = False
) -> DataFrame:
    """``line_no, value`` with 0-based numbers running through the files in path order.

    The files are read twice, to count lines and to number them, both times cut at
    the same bytes.
    """
    return index_corpus(spark, path, None, split_bytes).read(with_split=with_split)
