"""Vector expressions on array columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numbers import col


def _doubles(c: str | Column) -> Column:
    return col(c).cast("array<double>")


def inner_product(a: str | Column, b: str | Column) -> Column:
    products = F.zip_with(_doubles(a), _doubles(b), lambda x, y: x * y)
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def l2_normalise(c: str | Column) -> Column:
    """The vector at length one; a zero vector stays as it is."""
    v = _doubles(c)
    length = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return F.transform(v, lambda x: F.when(length > 0, x / length).otherwise(x))


def blend(a: str | Column, b: str | Column, weight: float = 0.5) -> Column:
    """Mix of two normalised vectors, normalised again."""
    mixed = F.zip_with(
        l2_normalise(a), l2_normalise(b), lambda x, y: F.lit(weight) * x + F.lit(1.0 - weight) * y
    )
    return l2_normalise(mixed)
