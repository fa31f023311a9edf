"""Quality by pairwise ranking (Bradley-Terry): better documents win their comparisons.

A document's strength is linear in features of its text. Pairs of a good and a
poor document are preferences; the logistic loss of the difference of features
trains the weights. The score is the chance to win against a document at the
threshold, which is a quantile of the strengths of all documents: the emptiest
place between quantiles near the share of poor labels.

Training takes at most ``MAX_EACH`` labelled documents of either kind, those
with the smallest hash of their id, and ``PAIRS_EACH`` pairs for each; both
bounds are parameters. The threshold and the scores cover every document.

Defined results: a null, empty or blank text scores 0, whatever the model, and has
no part in the threshold; without labels of both kinds every other score is 0.5. Of
several labels of one id the largest counts; null labels do not. Rows with a null
id are scored and count as held out. Repeated rows score alike; other columns are
ignored. The threshold follows the whole table, so a document's score may differ
between two tables that hold it.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neardup.llm.common import held_out
from neardup.llm.toxicity import sample_labelled
from neardup.session import materialize

MAX_EACH, PAIRS_EACH = 4000, 8
ROUNDS, RIDGE = 60, 1e-3
#: Share of labels within which the emptiest place is sought, in standard errors and at least.
NEAR, NEAREST, PLACES = 4.0, 0.01, 81

_SYMBOL = re.compile(r"[#*$%&|<>=\\{}\[\]~^]")
FEATURES = (
    "log_words", "word_length", "symbols", "any_symbols", "upper", "any_upper", "marks",
    "any_marks", "repeats", "any_repeats", "distinct", "line_repeats", "digits", "long_line",
)


def features(text: str) -> list[float]:
    """Features of a whole text, in the order of FEATURES."""
    words = text.split()
    n = len(words)
    if n == 0:
        return [0.0] * len(FEATURES)

    def both(count: int, of: int) -> tuple[float, float]:
        return count / of, math.log1p(100 * count / of)

    lines = [x for x in text.split("\n") if x.strip()]
    upper = sum(w.isupper() and len(w) > 1 for w in words)
    same = sum(a == b for a, b in zip(words, words[1:]))
    return [
        math.log(n),
        sum(map(len, words)) / n,
        *both(len(_SYMBOL.findall(text)), n),
        *both(upper, n),
        *both(text.count("!"), n),
        *both(same, n),
        len(set(words)) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(w.isdigit() for w in words) / n,
        math.log(n / max(1, len(lines))),
    ]


def fit(x: np.ndarray, y: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weights and scales from preference pairs, by Newton steps on the logistic loss."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    good, poor = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    # Partners are drawn by a seeded generator in the order of ids.
    draw = np.random.default_rng(7)
    a = np.concatenate([np.repeat(good, PAIRS_EACH), draw.choice(good, len(poor) * PAIRS_EACH)])
    b = np.concatenate([draw.choice(poor, len(good) * PAIRS_EACH), np.repeat(poor, PAIRS_EACH)])
    d = (x[a] - x[b]) / scale
    w = np.zeros(x.shape[1])
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(np.clip(d @ w, -40, 40)))  # chance that the poor one wins
        slope = -(d * p[:, None]).mean(axis=0) + RIDGE * w
        curve = (d * (p * (1 - p))[:, None]).T @ d / len(d) + RIDGE * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w / scale, scale


def train(docs: DataFrame, labels: DataFrame, folds: int = 3, fold: int = 1):
    """Weights, share of poor labels and their number, outside the held-out fold."""
    rows = sample_labelled(docs, labels, "quality", folds, fold, {1: MAX_EACH, 0: MAX_EACH})

    def measure(batches):
        for batch in batches:
            found = [features(t.as_py() or "") for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array(found, pa.list_(pa.float64()))],
                ["doc_id", "y", "x"],
            )

    table = (
        rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("y").cast("int").alias("y"), "text")
        .mapInArrow(measure, "doc_id long, y int, x array<double>")
        .toArrow()
        .sort_by("doc_id")
    )
    y = table["y"].to_numpy()
    if len(set(y.tolist())) < 2:
        return None
    x = np.array(table["x"].to_pylist())
    weights, _ = fit(x, y, table["doc_id"].to_numpy())
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .where(~held_out("doc_id", folds, fold))
        .groupBy("doc_id")
        .agg(F.max("quality").alias("y"))
        .join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    )
    n, good = known.agg(F.count("y"), F.sum("y")).first()
    return weights.tolist(), 1 - good / n, n


def strengths(docs: DataFrame, weights: list[float]) -> DataFrame:
    """``doc_id, strength`` of every row; null without a word."""
    w = np.array(weights)

    @F.arrow_udf("double")
    def run(texts: pa.Array) -> pa.Array:
        rows = [t.as_py() or "" for t in texts]
        x = np.array([features(t) for t in rows]).reshape(len(rows), len(w))
        return pa.array(x @ w, mask=np.array([not t.strip() for t in rows], dtype=bool))

    return docs.select("doc_id", run.asNondeterministic()("text").alias("strength"))


def threshold(strong: DataFrame, poor_share: float, n_labels: int) -> float:
    """The emptiest place among quantiles of all strengths near the share of poor labels."""
    error = math.sqrt(poor_share * (1 - poor_share) / n_labels)
    reach = max(NEAREST, NEAR * error)
    levels = np.clip(np.linspace(poor_share - reach, poor_share + reach, PLACES), 0.0, 1.0)
    at = F.percentile_approx("strength", levels.tolist(), 100_000)
    found = strong.agg(at).first()[0]
    if not found:
        return 0.0
    gaps = np.diff(found)
    widest = int(np.argmax(gaps))
    return (found[widest] + found[widest + 1]) / 2


def score(docs: DataFrame, model) -> DataFrame:
    """``doc_id, score``: the chance to win against a document at the threshold."""
    if model is None:
        blank = F.coalesce(~F.col("text").rlike(r"(?U)\S"), F.lit(True))
        return docs.select("doc_id", F.when(blank, 0.0).otherwise(0.5).alias("score"))
    weights, share, n = model
    strong = materialize(strengths(docs, weights), "strengths")
    cut = threshold(strong, share, n)
    chance = 1 / (1 + F.exp(F.lit(cut) - F.col("strength")))
    return strong.select("doc_id", F.coalesce(chance, F.lit(0.0)).alias("score"))
