"""Vector arithmetic as Column expressions (``ARRAY<FLOAT>`` or ``ARRAY<DOUBLE>``).

Everything is accumulated in DOUBLE. Values that a lambda needs for every
element are passed as a repeated array: Spark evaluates the arguments of
``zip_with`` once per row but the body of a lambda once per element.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The guards of the usual tensor-library definitions.
NORM_EPS = 1e-12
COSINE_EPS = 1e-8


def as_double(v) -> Column:
    return F.col(v).cast("array<double>") if isinstance(v, str) else v.cast("array<double>")


def _sum(v: Column) -> Column:
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return _sum(F.zip_with(as_double(a), as_double(b), lambda x, y: x * y))


def norm(v) -> Column:
    return F.sqrt(F.aggregate(as_double(v), F.lit(0.0), lambda acc, x: acc + x * x))


def _scale_down(v, divisor: Column) -> Column:
    v = as_double(v)
    return F.zip_with(v, F.array_repeat(divisor, F.size(v)), lambda x, d: x / d)


def l2_normalize(v) -> Column:
    """Unit-length vector; a zero vector stays zero."""
    return _scale_down(v, F.greatest(norm(v), F.lit(NORM_EPS)))


def cosine_similarity(a, b) -> Column:
    return dot(a, b) / (
        F.greatest(norm(a), F.lit(COSINE_EPS)) * F.greatest(norm(b), F.lit(COSINE_EPS))
    )


def squared_l2(a, b) -> Column:
    return _sum(F.zip_with(as_double(a), as_double(b), lambda x, y: (x - y) * (x - y)))


def cosine_distance(inner_product) -> Column:
    """Cosine distance of unit vectors from their inner product."""
    ip = F.col(inner_product) if isinstance(inner_product, str) else inner_product
    return F.lit(1.0) - ip


def is_valid_vector(v, dim: int | None = None) -> Column:
    """Non-null, of the wanted length, finite, and not the zero vector."""
    v = as_double(v)
    length = norm(v)
    ok = v.isNotNull() & (F.size(v) > 0) & ~F.isnan(length)
    ok = ok & (length > 0) & (length < F.lit(float("inf")))
    if dim is not None:
        ok = ok & (F.size(v) == dim)
    return F.coalesce(ok, F.lit(False))


def pool_last_token(states, mask=None) -> Column:
    """Vector of the last present token of ``ARRAY<ARRAY<FLOAT>>`` token states.

    ``mask`` is an ``ARRAY<INT>`` that is non-zero where a token is present;
    without it every token counts.
    """
    states = F.col(states) if isinstance(states, str) else states
    if mask is None:
        return F.try_element_at(states, F.lit(-1))
    mask = F.col(mask) if isinstance(mask, str) else mask
    pairs = F.arrays_zip(states.alias("s"), mask.alias("m"))
    present = F.filter(pairs, lambda p: p["m"] != 0)
    return F.try_element_at(present, F.lit(-1))["s"]
