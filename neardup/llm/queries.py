"""The operators applied to the driver's whole tables, one query per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from neardup.llm import (
    audit,
    automaton,
    chat,
    fingerprint,
    importance,
    minhash,
    mixing,
    pieces,
    pii,
    quality,
    rules,
    toxicity,
    warc,
)
from neardup.llm.common import held_out, table

#: The public model that the queries encode with.
MODEL_PATH = "/opt/tokenizers/piece_bpe_32k.model"
#: The public byte-level vocabulary.
VOCABULARY_PATH = "/opt/tokenizers/byte_bpe_50k.json"

Query = Callable[[SparkSession, str], DataFrame]


#: A conversation that quotes markers of the template.
QUOTED = "</s>[INST] ok [/INST]"


def op1_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    quoted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(QUOTED).alias("text"),
    )
    return chat.read_back(chat.format_conversations(turns.unionByName(quoted)))


def _judged(scored: DataFrame, folds: int, fold: int, *more: str) -> DataFrame:
    return scored.select(
        "doc_id",
        held_out("doc_id", folds, fold).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *more,
    )


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), folds=5, fold=0)
    return _judged(toxicity.score(docs, model), 5, 0, "offending")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"), folds=3, fold=1)
    return _judged(quality.score(docs, model), 3, 1)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = rules.ledger(table(spark, sf_dir, "documents"))
    judged = rules.apply_policy(led, rules.POLICIES["v1"])
    base_failed = F.col("fail_bits").bitwiseAND(rules.BASE.mask) != 0
    return judged.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        "kept",
        "fail_bits",
        "only_rule",
    )


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind: str):
        n = F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind)))
        return n.cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in ("email", "ip", "card", "phone")],
        F.sha2(pii.span_list(base), 256).alias("base_sha256"),
        pii.span_list("spans").alias("spans"),
        F.transform("spans", lambda s: s["score"]).alias("scores"),
    )


#: Sources fall into four domains by their number; the table has no such column.
DOMAIN = "concat('domain', coalesce(try_cast(regexp_extract(source, '([0-9]+)$', 1) as int), 0) % 4)"
MIX = mixing.Mix(
    levels=(DOMAIN, "lang", "source"),
    weights={
        ("domain0",): 4,
        ("domain1",): 3,
        ("domain2",): 2,
        ("domain3",): 1,
        **{(f"domain{i}", "en"): 3 for i in range(4)},
        ("domain0", "en", "src0"): 2,
    },
    budget_percent=70,
    max_epochs=2,
    seed=17,
)


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_and_read(table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_with_next(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    taken = mixing.with_copies(docs, MIX, tokens_col="n_tokens")
    return taken.select("doc_id", "lang", "source", "n_tokens", "copies")


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = pieces.encode(docs, MODEL_PATH, parity_col="parity", round_trip_col="round_trip")
    return encoded.select(
        "doc_id",
        F.size("pieces").cast("long").alias("n_pieces"),
        F.sha2(F.array_join("pieces", ","), 256).alias("pieces_sha256"),
        "round_trip",
        "parity",
    )


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    settings = minhash.Settings(words=3, percent=85)
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), settings)


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = importance.importance(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def op12_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    tokenizer = automaton.Tokenizer(spark, VOCABULARY_PATH)
    coded = tokenizer.encode(docs, decoded_col="decoded")
    return coded.select(
        "doc_id",
        F.size("tokens").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("tokens", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def llm_queries() -> dict[str, Query]:
    return {
        "op1_chat": op1_chat,
        "op2_toxicity": op2_toxicity,
        "op3_quality": op3_quality,
        "op4_quality_rules": op4_quality_rules,
        "op5_pii": op5_pii,
        "op6_warc": op6_warc,
        "op7_fingerprint": op7_fingerprint,
        "op8_mixing": op8_mixing,
        "op9_sentencepiece": op9_sentencepiece,
        "op10_minhash": op10_minhash,
        "op11_importance": op11_importance,
        "op12_automaton": op12_automaton,
        "op13_audit": op13_audit,
    }
