"""Vector expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine in double; 0 for a zero vector, null for unequal lengths."""
    norms = F.sqrt(_dot(a, a)) * F.sqrt(_dot(b, b))
    return F.when(F.size(a) == F.size(b), F.when(norms == 0, F.lit(0.0)).otherwise(_dot(a, b) / norms))
