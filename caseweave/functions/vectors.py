"""Vector arithmetic on array columns, in double precision and inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda total, x: total + x)


def dot(a: Column, b: Column) -> Column:
    return _sum(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")))


def norm(a: Column) -> Column:
    squares = F.transform(a, lambda x: x.cast("double") * x.cast("double"))
    return F.sqrt(_sum(squares))


def cosine(a: Column, b: Column, norm_a: Column | None = None, norm_b: Column | None = None):
    """Cosine similarity; NULL if one side is a zero vector.  Pass norms that are stored."""
    norm_a = norm(a) if norm_a is None else norm_a
    norm_b = norm(b) if norm_b is None else norm_b
    return dot(a, b) / F.nullif(norm_a * norm_b, F.lit(0.0))


def euclidean(a: Column, b: Column) -> Column:
    diffs = F.zip_with(a, b, lambda x, y: x.cast("double") - y.cast("double"))
    return F.sqrt(F.aggregate(diffs, F.lit(0.0), lambda total, d: total + d * d))
