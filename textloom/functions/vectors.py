"""Dense vectors held as array<float> or array<double>."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine similarity; the product of the norms is kept at 1e-8 or more, so a zero vector gives 0."""
    return dot(a, b) / F.greatest(F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)), F.lit(1e-8))
