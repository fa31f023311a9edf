"""Toxicity by multiple-instance learning: sentences are scored, documents are labelled.

A sentence's score is a logistic function of its words, scaled to 0 for a
sentence without known words and for any below it; a document is toxic with the
noisy-or of its sentences, 1 - prod(1 - p), so that harmless sentences add
nothing however many they are. Only documents have labels: the likelihood of the
noisy-or trains the words' weights, and the sentence scores then show where the
offence lies.

Training takes at most ``MAX_TOXIC`` and ``MAX_CLEAN`` labelled documents, those
with the smallest hash of their id, and the words found in ``MIN_DOCS`` of them;
both bounds are parameters. Every document is scored, whole.

Defined results: a null or empty text has no sentence and scores 0; so does
every text where no training label says toxic. Of several labels of one id the
largest counts; null labels do not. Rows with a null id are scored and count as
held out. Repeated rows score alike; other columns are ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from neardup.llm.common import held_out

MAX_TOXIC, MAX_CLEAN = 1500, 1500
MIN_DOCS = 5
#: A word is a feature if toxic documents have it this many times as often as
#: clean ones, by so many standard errors.
LIFT, ERRORS = 3.0, 4.0
COPY_MINIMA = 4
#: Lengths of the starts of words that are terms too.
STEMS = (4, 5)
ROUNDS, STEP, RIDGE = 300, 0.5, 1e-4
#: Starts of the bias, which says how words of a sentence add up, and of the weights.
BIAS, WEIGHT = -7.0, 1.0
#: Score from which a sentence is reported.
OFFENDING = 0.5

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W\d_]+")


def sentences(text: str) -> list[tuple[int, int, set[str]]]:
    """(start, end, terms) of the sentences of a text that have words.

    Terms are distinct words and, marked by ``^``, starts of longer words: an
    offensive stem may take many endings.
    """
    out = []
    low = text.lower()
    if len(low) != len(text):  # a few letters get longer: keep places right
        low = "".join(c if len(c.lower()) > 1 else c.lower() for c in text)
    for m in _SENTENCE.finditer(low):
        words = set(_WORD.findall(m.group()))
        if words:
            terms = words.union(*({"^" + w[:n] for w in words if len(w) > n} for n in STEMS))
            out.append((*m.span(), terms))
    return out


def sample_labelled(
    docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, most: dict[int, int]
) -> DataFrame:
    """``text, y`` of at most ``most[y]`` labelled documents outside the held-out fold.

    Those with the smallest hash of their id; the ids alone are ranked.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .where(~held_out("doc_id", folds, fold))
        .groupBy("doc_id")
        .agg(F.max(label).alias("y"))
    )
    parts = [
        known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        for y, n in most.items()
    ]
    chosen = parts[0]
    for p in parts[1:]:
        chosen = chosen.unionByName(p)
    # At most sum(most) ids: their bound is the parameter.
    side = F.broadcast(chosen)
    return docs.select("doc_id", "text").join(side, "doc_id").select("doc_id", "text", "y")


def _descend(doc, sent, word, y, n_words: int) -> tuple[np.ndarray, float]:
    """Gradient steps on the likelihood of the noisy-or."""
    n_sent = len(doc)
    weights, bias = np.full(n_words, WEIGHT), BIAS
    squares, bias_squares = np.full(n_words, 1e-8), 1e-8
    share = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum()))
    for _ in range(ROUNDS):
        z = bias + np.bincount(sent, weights=weights[word], minlength=n_sent)
        p = 1 / (1 + np.exp(-np.clip(z, -40, 40)))
        none = 1 / (1 + math.exp(-bias))
        # The chance that a sentence is clean is (1 - p) / (1 - none), 1 from the bias down.
        log_sent = np.minimum(0, np.log1p(-np.minimum(p, 1 - 1e-12)) - math.log1p(-none))
        clean = np.exp(np.bincount(doc, weights=log_sent, minlength=len(y)))
        # d loss / d z: p for a clean document, -p * clean / toxic for a toxic one.
        pull = np.where(y > 0, -clean / np.maximum(1 - clean, none), 1.0) * share
        above = pull[doc] * (z > bias)
        g_sent = above * p
        g = np.bincount(word, weights=g_sent[sent], minlength=n_words) + RIDGE * weights
        squares += g * g
        weights = weights - STEP * g / np.sqrt(squares)
        g_bias = (above * (p - none)).sum()
        bias_squares += g_bias * g_bias
        bias = min(bias - 0.1 * STEP * g_bias / math.sqrt(bias_squares), BIAS / 2)
    return weights, bias


def _telling_words(bags: list[list[list[str]]], y: np.ndarray) -> list[str]:
    """Words that toxic documents have beyond chance more often than clean ones."""
    seen = [Counter(), Counter()]
    for bag, label in zip(bags, y):
        seen[int(label)].update({w for s in bag for w in s})
    n1, n0 = max(1.0, y.sum()), max(1.0, (1 - y).sum())
    out = []
    for w, k1 in seen[1].items():
        k0 = seen[0][w]
        r1, r0, r = k1 / n1, k0 / n0, (k1 + k0) / (n1 + n0)
        error = math.sqrt(r * (1 - r) * (1 / n1 + 1 / n0))
        if k1 + k0 >= MIN_DOCS and r1 >= LIFT * r0 and r1 - r0 >= ERRORS * error:
            out.append(w)
    return sorted(out)


def _without_copies(bags: list[list[list[str]]]) -> list[int]:
    """Places of the bags that share none of ``COPY_MINIMA`` minimal sentences with an earlier one.

    Copies of one text would make its rare words look telling.
    """
    seen: set[tuple[int, int]] = set()
    out = []
    for i, bag in enumerate(bags):
        texts = [" ".join(s).encode() for s in bag if len(s) > 3] or [b"%d" % i]
        keys = {(j, min(zlib.crc32(t, j) for t in texts)) for j in range(COPY_MINIMA)}
        if not keys & seen:
            out.append(i)
        seen |= keys
    return out


def fit(bags: list[list[list[str]]], y: list[int]) -> tuple[dict[str, float], float]:
    """Weights of the telling words and the bias."""
    own = _without_copies(bags)
    bags, y = [bags[i] for i in own], np.array([y[i] for i in own], dtype=np.float64)
    words = _telling_words(bags, y)
    if not words:
        return {}, -math.inf
    at = {w: i for i, w in enumerate(words)}
    doc, sent, word = [], [], []
    for d, bag in enumerate(bags):
        for s in bag:
            known = [at[w] for w in s if w in at]
            if not known:  # adds nothing to its document
                continue
            sent += [len(doc)] * len(known)
            word += known
            doc.append(d)
    doc, sent, word = (np.array(x, dtype=np.int64) for x in (doc, sent, word))
    weights, bias = _descend(doc, sent, word, y, len(words))
    return dict(zip(words, map(float, weights))), bias


def train(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0):
    """Model of the ``toxic`` labels outside the held-out fold."""
    rows = sample_labelled(docs, labels, "toxic", folds, fold, {1: MAX_TOXIC, 0: MAX_CLEAN})

    def to_bags(batches):
        for batch in batches:
            bags = [
                [sorted(w) for *_, w in sentences(t.as_py() or "")] for t in batch.column("text")
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array(bags, pa.list_(pa.list_(pa.string())))],
                ["doc_id", "y", "bag"],
            )

    table = (
        rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("y").cast("int").alias("y"), "text")
        .mapInArrow(to_bags, "doc_id long, y int, bag array<array<string>>")
        .toArrow()
        .sort_by("doc_id")
    )
    return fit(table["bag"].to_pylist(), table["y"].to_pylist())


def score_text(text: str, weights: dict[str, float], bias: float):
    """Score of a text and its offending sentences as (start, end, score)."""
    log_clean, found, known = 0.0, [], weights.keys()
    if bias == -math.inf:
        return 0.0, found
    none = 1 / (1 + math.exp(-bias))
    for start, end, words in sentences(text):
        # Summed in order, so that equal texts score alike in every process.
        more = sum(weights[w] for w in sorted(words & known))
        if more <= 0:
            continue
        p = (1 / (1 + math.exp(-min(40.0, bias + more))) - none) / (1 - none)
        log_clean += math.log1p(-min(p, 1 - 1e-12))
        if p >= OFFENDING:
            found.append({"start": start, "end": end, "score": p})
    return 1 - math.exp(log_clean), found


def score(docs: DataFrame, model: tuple[dict[str, float], float]) -> DataFrame:
    """``doc_id, score, offending`` of every row: sentences are code points, end exclusive."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(
        pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())])
    )

    @F.arrow_udf("struct<score:double,offending:array<struct<start:int,end:int,score:double>>>")
    def run(texts: pa.Array) -> pa.Array:
        found = [score_text(t.as_py() or "", *shared.value) for t in texts]
        parts = [pa.array([s for s, _ in found], pa.float64()), pa.array([o for _, o in found], kind)]
        return pa.StructArray.from_arrays(parts, ["score", "offending"])

    scored = docs.select("doc_id", run.asNondeterministic()("text").alias("s"))
    return scored.select("doc_id", "s.score", "s.offending")
