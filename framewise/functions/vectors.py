"""Dense-vector maths on ARRAY<DOUBLE> columns with higher-order functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .common import col


def as_double_array(c) -> Column:
    return col(c).cast("array<double>")


def sum_array(c) -> Column:
    return F.aggregate(col(c), F.lit(0.0), lambda acc, x: acc + x)


def dot(a, b) -> Column:
    return sum_array(F.zip_with(col(a), col(b), lambda x, y: x * y))


def sq_norm(a) -> Column:
    return F.aggregate(col(a), F.lit(0.0), lambda acc, x: acc + x * x)


def l2_normalize(a, eps: float | None = None) -> Column:
    """``v / sqrt(eps + sum v^2)``; with ``eps=None`` plain ``v / ||v||``."""
    a = col(a)
    denom = F.sqrt(sq_norm(a) + F.lit(eps)) if eps is not None else F.sqrt(sq_norm(a))
    return F.transform(a, lambda x: x / denom)


def cosine_distance(a, b, normalized: bool = False) -> Column:
    """``1 - cos(a, b)``; pass ``normalized=True`` if both sides are unit length."""
    if normalized:
        return F.lit(1.0) - dot(a, b)
    return F.lit(1.0) - dot(a, b) / (F.sqrt(sq_norm(a)) * F.sqrt(sq_norm(b)))


def squared_euclidean(a, b) -> Column:
    """Squared Euclidean distance, clamped at 0 (no square root)."""
    return F.greatest(
        F.lit(0.0),
        sum_array(F.zip_with(col(a), col(b), lambda x, y: (x - y) * (x - y))))
