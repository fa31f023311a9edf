"""From raw documents to token ids: rules, near-duplicates, personal data, mixing, pieces."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neardup.llm import minhash, mixing, pieces, pii, rules
from neardup.llm.queries import DOMAIN, MODEL_PATH
from neardup.session import materialize

#: Every leaf keeps one whole epoch, so that no clean document goes. This counts
#: against its target: what is added, a quarter of the tokens, goes by a second
#: epoch to the leaves below theirs. ``mixing.shares`` tells how near they come.
MIX = mixing.Mix(
    levels=(DOMAIN, "lang", "source"),
    weights={
        ("domain0",): 1,
        ("domain1",): 2,
        ("domain2",): 2,
        ("domain3",): 2,
        **{(f"domain{i}", "en"): 2 for i in range(4)},
    },
    budget_percent=125,
    max_epochs=2,
    floor_epochs=1,
    seed=29,
    floor_counts=True,
)
NEAR = minhash.Settings(words=5, percent=80)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the policy go."""
    return rules.keep_passing(docs, rules.POLICIES["v1"])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    return minhash.without_copies(docs, NEAR)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind; ``n_chars`` follows the text."""
    masked = pii.mask_pii(docs)
    if "n_chars" not in docs.columns:
        return masked
    return masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def mixing_weights(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows as often as the target weights take them."""
    return mixing.mixed_rows(docs, MIX)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids in place of the text, decoded once more to see that nothing is lost."""
    rows = docs.select("doc_id", "lang", "source", "text")
    encoded = pieces.encode(rows, MODEL_PATH, round_trip_col="round_trip")
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        F.size("pieces").cast("long").alias("n_pieces"),
        "pieces",
        "round_trip",
    )


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("personal_data", personal_data),
    ("mixing", mixing_weights),
    ("sentencepiece", sentencepiece),
]

#: SQL has no SentencePiece model; tests hold the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
