"""Vector arithmetic on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)


def cosine_distance(a: Column | str, b: Column | str) -> Column:
    """1 - cosine similarity; null for null, zero-length or unequally long vectors.

    For pairs that already share a row. To search a knowledge base use
    ``operators.nearest``, which works on whole Arrow batches.
    """
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    norm = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.when(F.size(a) == F.size(b), F.lit(1.0) - F.try_divide(_dot(a, b), norm))
