"""Small tables with every awkward case, and helpers."""

from __future__ import annotations

import random

LONG = "palabra larga sin fin " * 20_000


def words(n: int, seed: int, size: int = 400) -> list[str]:
    draw = random.Random(seed)
    return [f"w{draw.randrange(size)}" for _ in range(n)]


def edge_texts() -> list[tuple[int | None, str | None]]:
    """(doc_id, text): nulls, empty, blank, very long, ties and repeated rows."""
    plain = " ".join(words(60, 1))
    return [
        (1, plain),
        (2, plain),
        (3, None),
        (4, ""),
        (5, " \t\n\x0b\r "),
        (6, LONG),
        (7, "one two"),
        (8, "one two"),
        (9, "ein Über-Wort 😀 mail a.b@c.de"),
        (9, "ein Über-Wort 😀 mail a.b@c.de"),
        (None, "nobody knows my id " * 6),
        (None, None),
    ]


#: Names that operators use themselves.
CLASHING = "score string, words string, id string, n long, m long, _level0 string, copies string, root string, key string, s string, pieces string, spans string, _id string, w string"


def with_clashes(df):
    from pyspark.sql import functions as F

    for column in CLASHING.split(", "):
        name, kind = column.split(" ")
        df = df.withColumn(name, F.lit("9").cast(kind))
    return df


def documents(spark, rows):
    full = [(i, t, "en", "src1", len(t or "")) for i, t in rows]
    return spark.createDataFrame(
        full, "doc_id long, text string, lang string, source string, n_chars long"
    )
