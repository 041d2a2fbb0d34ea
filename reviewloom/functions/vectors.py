"""Expressions over ARRAY<FLOAT> vectors and sparse weights."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(
        F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x
    )


def l2_normalize(v: Column) -> Column:
    """Unit length; the zero vector stays as it is."""
    norm = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    scaled = F.transform(v, lambda x: F.try_divide(x.cast("double"), norm))
    return F.when(norm > 0, scaled).otherwise(F.transform(v, lambda x: x.cast("double")))


def sparse_vector(weights: Column) -> Column:
    """MAP<STRING,STRING> of term weights to (indices, values)."""
    pairs = F.filter(
        F.transform(F.map_entries(weights), lambda e: F.struct(
            e.key.try_cast("int").alias("i"), e.value.try_cast("double").alias("v"))),
        lambda p: p.i.isNotNull() & p.v.isNotNull(),
    )
    return F.struct(
        F.transform(pairs, lambda p: p.i).alias("indices"), F.transform(pairs, lambda p: p.v).alias("values")
    )
