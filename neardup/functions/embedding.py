"""Embedding of a text column with a model the caller supplies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from neardup.functions.vectors import l2_normalize


def embed(
    df: DataFrame,
    make_predict_fn: Callable,
    text_col: str = "text",
    output_col: str = "embedding",
    batch_size: int = 256,
    normalize: bool = True,
    num_partitions: int | None = None,
) -> DataFrame:
    """Add the vector of each text.

    ``make_predict_fn()`` runs once per Python worker and returns a function
    from an array of texts to a 2-D array. ``num_partitions`` spreads an input
    of fewer partitions over more tasks before the model runs.
    """
    if num_partitions is not None and df.rdd.getNumPartitions() < num_partitions:
        df = df.repartition(num_partitions)
    predict = predict_batch_udf(
        make_predict_fn, return_type=T.ArrayType(T.DoubleType()), batch_size=batch_size
    )
    # A later filter on the vector must not be pushed below the model: it would
    # run the model a second time, before the repartition.
    predict = predict.asNondeterministic()
    raw = predict(F.coalesce(F.col(text_col), F.lit("")))
    df = df.withColumn(output_col, raw)
    return df.withColumn(output_col, l2_normalize(output_col)) if normalize else df


def hashed_bag_of_words(dim: int = 64) -> Callable:
    """A stand-in model: counts of lower-cased alphanumeric words by md5 bucket."""

    def make_predict_fn():
        import hashlib
        import re
        from collections import Counter
        from functools import lru_cache

        import numpy as np

        words = re.compile("[a-z0-9]+")

        @lru_cache(maxsize=1 << 18)
        def bucket(word: str) -> int:
            return int(hashlib.md5(word.encode()).hexdigest()[:4], 16) % dim

        def predict(texts: np.ndarray) -> np.ndarray:
            out = np.zeros((len(texts), dim))
            for i, text in enumerate(texts):
                for word, n in Counter(words.findall(text.lower())).items():
                    out[i, bucket(word)] += n
            return out

        return predict

    return make_predict_fn


def last_token_vectors(
    tokens: DataFrame, doc_col: str, pos_col: str, vector_col: str
) -> DataFrame:
    """One vector per document: that of its last token, from a row-per-token table."""
    last: Column = F.max_by(vector_col, pos_col)
    return tokens.groupBy(doc_col).agg(last.alias(vector_col))
