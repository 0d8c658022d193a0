"""Vector arithmetic as Column expressions, for one vector or one pair at a time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let

NEAR_ZERO = 1e-9


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    scale = norm(a) * norm(b)
    return F.when(scale > 0, dot(a, b) / scale).otherwise(F.lit(0.0))


def l2_normalize(a: Column) -> Column:
    """Unit vector as floats; NULL when the norm is too close to zero."""
    unit = let(
        F.struct(a.alias("v"), norm(a).alias("n")),
        lambda s: F.transform(s["v"], lambda x: (x.cast("double") / s["n"]).cast("float")),
    )
    return F.when(norm(a) >= NEAR_ZERO, unit)
