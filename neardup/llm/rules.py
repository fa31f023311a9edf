"""Quality rules as a ledger of failure bits (DataFrame functions only).

Every rule is evaluated once per document. The ledger keeps what was measured
and one bit per failed rule; a policy is a named set of bits, so that policies
of any version, and what each rule costs, follow from the stored bits without
reading a text again.

Defined results: a null text counts as the empty text; the empty text has zero
measurements and fails ``few_words``; repeated rows and null ids are judged row
by row; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from neardup.llm.common import SPACE_CLASS, let, text_or_empty

#: Fixed: hashes of windows are joined by doubling from 1 to 2, 4 and 8 words.
WINDOW_WORDS = 8
MEASUREMENTS = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_exclamations",
)

#: Rule by bit position; each is true where a document of measurements ``m`` fails.
RULES = (
    ("few_words", lambda m: m["n_words"] < 20),
    ("repeated_windows", lambda m: 100 * m["n_repeat_words"] > 30 * m["n_words"]),
    ("symbols", lambda m: 100 * m["n_symbols"] > 10 * m["n_words"]),
    ("repeated_lines", lambda m: 100 * m["n_dup_lines"] > 30 * m["n_lines"]),
    (
        "word_length",
        lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 15 * m["n_words"]),
    ),
    ("exclamations", lambda m: 100 * m["n_exclamations"] > 10 * m["n_words"]),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version and the rules that it enforces."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base", ("few_words", "repeated_windows"))
POLICIES = {
    p.version: p
    for p in (
        BASE,
        Policy("v1", (*BASE.rules, "symbols", "exclamations")),
        Policy("v2", tuple(name for name, _ in RULES)),
    )
}


def _repeated_words(words: Column) -> Column:
    """Words that lie in 8-word windows found twice or more.

    Different hashes prove that nothing repeats, which ends the work for most
    texts. In the others windows of equal hash are compared word by word.
    """
    n_windows = F.size(words) - (WINDOW_WORDS - 1)

    def joined(h: Column, width: int) -> Column:
        # Hashes of windows twice as wide; those that reach over the end are cut off later.
        after = F.slice(h, width + 1, F.greatest(F.size(h) - width, F.lit(0)))
        return F.zip_with(h, after, lambda a, b: F.xxhash64(a, b))

    wide = let(joined(words, 1), lambda h: let(joined(h, 2), lambda h: joined(h, 4)))
    hashes = F.slice(wide, F.lit(1), n_windows)

    def covered(windows: Column) -> Column:
        def same(x: Column, y: Column) -> Column:
            equal = F.slice(words, x["at"], WINDOW_WORDS) == F.slice(words, y["at"], WINDOW_WORDS)
            return F.when(x["h"] == y["h"], equal).otherwise(F.lit(False))

        repeated = F.filter(
            windows,
            lambda x, j: same(x, F.get(windows, j - 1)) | same(x, F.get(windows, j + 1)),
        )
        places = F.array_sort(F.transform(repeated, lambda x: x["at"]))
        start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW_WORDS).alias("last"))
        return F.aggregate(
            places,
            start,
            lambda acc, at: F.struct(
                (acc["n"] + F.least(F.lit(WINDOW_WORDS), at - acc["last"])).alias("n"),
                at.alias("last"),
            ),
            lambda acc: acc["n"],
        )

    def exact(h: Column) -> Column:
        windows = F.transform(h, lambda x, i: F.struct(x.alias("h"), (i + 1).alias("at")))
        return let(F.sort_array(windows), covered)

    some = let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(exact(h)),
    )
    return F.when(F.size(words) <= WINDOW_WORDS, F.lit(0)).otherwise(some)


def measure(text: str | Column) -> Column:
    """Struct of MEASUREMENTS of a text."""
    text = text_or_empty(text)

    def count_of(chars: str) -> Column:
        return F.length(F.regexp_replace(text, f"[^{chars}]+", "")).cast("long")

    words = F.array_remove(F.split(text, f"[{SPACE_CLASS}]+"), "")
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(f"[^{SPACE_CLASS}]"))
    of_words = let(
        words,
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeated_words(w).cast("long").alias("n_repeat_words"),
        ),
    )
    of_lines = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        ),
    )
    return F.struct(
        of_words.alias("w"),
        of_lines.alias("l"),
        count_of("#*$%&|<>").alias("n_symbols"),
        count_of("!").alias("n_exclamations"),
    )


def _flat(m: str) -> dict[str, Column]:
    """The measurements in a column made by :func:`measure`."""
    part = {"n_lines": "l.", "n_dup_lines": "l.", "n_symbols": "", "n_exclamations": ""}
    return {c: F.col(f"{m}.{part.get(c, 'w.')}{c}") for c in MEASUREMENTS}


def _fail_bits(measured: dict[str, Column]) -> Column:
    """Bits of the failed rules; the rules see the measurements as a row of their own."""
    row = F.struct(*[c.alias(n) for n, c in measured.items()])
    bits = let(
        row,
        lambda m: sum(
            (F.when(fails(m), F.lit(BIT[name])).otherwise(F.lit(0)) for name, fails in RULES),
            start=F.lit(0),
        ),
    )
    return bits.cast("long")


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, MEASUREMENTS and ``fail_bits`` of every document, in one pass."""
    measured = docs.select(F.col(id_col).alias("doc_id"), measure(text_col).alias("m"))
    flat = measured.select("doc_id", *[c.alias(n) for n, c in _flat("m").items()])
    return flat.withColumn("fail_bits", _fail_bits({c: F.col(c) for c in MEASUREMENTS}))


def apply_policy(led: DataFrame, policy: Policy) -> DataFrame:
    """Adds ``kept`` and ``only_rule``: the one rule that alone removes a document."""
    failed = F.col("fail_bits").bitwiseAND(policy.mask)
    alone = F.coalesce(*[F.when(failed == BIT[r], F.lit(r)) for r in policy.rules])
    return led.withColumn("kept", failed == 0).withColumn("only_rule", alone)


def keep_passing(docs: DataFrame, policy: Policy, text_col: str = "text") -> DataFrame:
    """The rows that pass a policy, with the columns of the input.

    The measurement stands once in the condition, so that a pushed filter does not repeat it.
    """

    def passes(m: Column) -> Column:
        part = {"n_lines": "l", "n_dup_lines": "l"}
        whole = ("n_symbols", "n_exclamations")
        flat = {c: m[c] if c in whole else m[part.get(c, "w")][c] for c in MEASUREMENTS}
        return _fail_bits(flat).bitwiseAND(policy.mask) == 0

    return docs.where(let(measure(text_col), passes))


def ablations(led: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of a policy: documents that fail it, and those kept if it were dropped.

    The ledger is first counted by combination of bits, 2 ** rules at most.
    """
    failed = F.col("fail_bits").bitwiseAND(policy.mask)
    combined = led.groupBy(failed.alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    rules = F.explode(
        F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BIT[r]).alias("bit")) for r in policy.rules])
    )
    pairs = combined.select("bits", "n", rules.alias("r"))
    hit = F.col("bits").bitwiseAND(F.col("r.bit")) != 0
    return pairs.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_regained"),
        F.bit_or(F.when(hit, F.col("bits")).otherwise(0)).alias("seen_with"),
    )
