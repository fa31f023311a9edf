"""How filters of documents interact: all orders of five filters over whole texts.

Four filters look at a text alone. The fifth asks whether an equal text has a
smaller id, by an existential self-join: a left semi join on hash, exact text and
smaller id, of the documents whose hash occurs again with the smallest id of each
text. Its ids are united with those that fail the other filters, and documents are
counted by source and combination of failures, 32 of them at most. What every
order keeps, removes and loses follows from these counts.

Defined results: a null text is empty, so all null and empty texts are equal; a
null source is the empty string; a row with a null id has no smaller id and
passes no other's test; rows that repeat an id and text count as documents of
their own but are not copies of each other; of several labels of an id any 1
counts; an empty table gives no rows. Only the named columns are read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from neardup.llm.common import SPACE_CLASS, let, text_or_empty
from neardup.session import broadcast_if_small, materialize

FILTERS = "ABCDE"
BIT = {f: 1 << i for i, f in enumerate(FILTERS)}
#: Share of words, of code points and number of words at which a text fails.
MIN_WORDS, MIN_DISTINCT_PERCENT, MAX_CAPITAL_PERCENT = 200, 50, 2
#: Copies of one hash that are joined in one task.
HOT_TEXTS = 5_000
SIGNS = "#$%&*|"


def own_failures(text: Column) -> Column:
    """Bits of the filters A to D for a text without nulls."""
    words = F.array_remove(F.split(text, f"[{SPACE_CLASS}]+"), "")
    of_words = let(
        words,
        lambda w: F.when(F.size(w) < MIN_WORDS, BIT["A"]).otherwise(0)
        + F.when(
            100 * F.size(F.array_distinct(w)).cast("long") < MIN_DISTINCT_PERCENT * F.size(w).cast("long"),
            BIT["B"],
        ).otherwise(0),
    )
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    return (
        of_words
        + F.when(100 * capitals > MAX_CAPITAL_PERCENT * F.length(text).cast("long"), BIT["C"]).otherwise(0)
        + F.when(text.rlike(f"[{SIGNS}]"), BIT["D"]).otherwise(0)
    )


def with_smaller_copy(rows: DataFrame, hashes: DataFrame, hot: int = HOT_TEXTS) -> DataFrame:
    """Rows ``id, hash, text, ...`` whose text occurs with a smaller id.

    ``hashes`` has a row with the ``hash`` of each of them. Only rows whose hash
    occurs again are joined, and each text's smallest id is found before that, so
    that a text meets one row however many copies there are. The rows of a hash
    with more than ``hot`` of them are dealt out by their id.
    """
    again = hashes.groupBy("hash").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = broadcast_if_small(materialize(again, "audit-hashes"), 64)
    salts = F.ceil(F.col("_n") / hot)
    members = rows.join(again, "hash").withColumn("_salts", salts).drop("_n")
    members = materialize(members, "audit-members")
    first = members.groupBy("hash", "_salts", "text").agg(F.min("id").alias("_first"))
    salt = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_salts") - 1))
    first = first.withColumn("_salt", salt).drop("_salts")
    left = members.withColumn("_salt", F.pmod(F.xxhash64("id"), "_salts")).alias("l")
    right = first.alias("r")
    smaller = (
        (F.col("l.hash") == F.col("r.hash"))
        & (F.col("l._salt") == F.col("r._salt"))
        & (F.col("l.text") == F.col("r.text"))
        & (F.col("r._first") < F.col("l.id"))
    )
    return left.join(right, smaller, "left_semi").drop("_salt", "_salts")


def failure_counts(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    part_col: str = "source",
    hot: int = HOT_TEXTS,
) -> DataFrame:
    """``part, bits, n, n_good, n_toxic``: documents by combination of failed filters."""
    rows = docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        text_or_empty(text_col).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    own = rows.select("id", "part", "hash", own_failures(F.col("text")).alias("bits"))
    own = materialize(own, "audit-rows")
    copies = with_smaller_copy(rows, own, hot)
    # One text has one hash, so (id, part, hash) stands for rows that fail alike.
    failing = own.withColumn("n", F.lit(1).cast("long")).unionByName(
        copies.select(
            "id", "part", "hash", F.lit(BIT["E"]).alias("bits"), F.lit(0).cast("long").alias("n")
        )
    )
    failing = failing.groupBy("id", "part", "hash").agg(
        F.bit_or("bits").alias("bits"), F.sum("n").alias("n")
    )
    good, toxic = (F.max(F.when(F.col(c) == 1, 1).otherwise(0)) for c in ("quality", "toxic"))
    judged = labels.groupBy(F.col("doc_id").alias("id")).agg(
        good.alias("good"), toxic.alias("toxic")
    )
    # Written out: then the join splits what one id brings too much of.
    judged = broadcast_if_small(materialize(judged.where("good + toxic > 0"), "audit-labels"), 64)
    return (
        failing.join(judged, "id", "left")
        .groupBy("part", "bits")
        .agg(
            F.sum("n").alias("n"),
            F.sum(F.col("n") * F.coalesce("good", F.lit(0))).alias("n_good"),
            F.sum(F.col("n") * F.coalesce("toxic", F.lit(0))).alias("n_toxic"),
        )
    )


def _places() -> tuple[list[tuple], list[tuple]]:
    """(filters before as bits, filter's bit, orders that have them so), and every step of every order."""
    steps = []
    for order in map("".join, permutations(FILTERS)):
        before = 0
        for i, f in enumerate(order):
            steps.append((before, BIT[f], order, i + 1))
            before |= BIT[f]
    rest = len(FILTERS) - 1
    places = sorted({(b, f) for b, f, _, _ in steps})
    weighed = [
        (b, f, factorial(b.bit_count()) * factorial(rest - b.bit_count())) for b, f in places
    ]
    return weighed, steps


def _values(spark, rows: list[tuple], columns: str) -> DataFrame:
    listed = ", ".join("(" + ", ".join(map(repr, r)) + ")" for r in rows)
    return spark.sql(f"select * from values {listed} as t({columns})")


def order_audit(counts: DataFrame) -> DataFrame:
    """Every order and step of the filters for each part of :func:`failure_counts`."""
    spark = counts.sparkSession
    places, steps = _places()
    struct = "named_struct('before', {}, 'own', {}, 'orders', {}L)"
    listed = F.expr("array(" + ", ".join(struct.format(*p) for p in places) + ")")
    # 80 fixed places for each of the at most 32 combinations of a part.
    at = counts.withColumn("at", F.explode(listed)).select("*", "at.*").drop("at")
    early = F.col("bits").bitwiseAND(F.col("before")) != 0
    fails = F.col("bits").bitwiseAND(F.col("own")) != 0

    def total(condition: Column, n: str = "n") -> Column:
        return F.sum(F.when(condition, F.col(n)).otherwise(0))

    summed = at.groupBy("part", "before", "own", "orders").agg(
        total(~early & ~fails).alias("kept"),
        total(~early & fails).alias("removed"),
        total(early & fails).alias("redundant"),
        total(F.col("bits") == F.col("own")).alias("unique_fails"),
        total(~early & fails, "n_good").alias("good_lost"),
        total(~early & fails, "n_toxic").alias("toxic_lost"),
    )
    # 16 rows for each filter of a part.
    every = Window.partitionBy("part", "own")
    summed = summed.withColumn("shapley", F.sum(F.col("removed") * F.col("orders")).over(every))
    orders = F.broadcast(_values(spark, steps, "before, own, filter_order, step"))  # 600 rows
    measures = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    return summed.join(orders, ["before", "own"]).select("part", "filter_order", "step", *measures)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Per part, order of the filters and step: what this filter does there."""
    return order_audit(failure_counts(docs, labels))
