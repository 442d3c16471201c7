"""Cosine of two array columns, inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIMILARITY_PLACES = 6  # hides summation noise, so ranking and ties are stable


def _dot(left: Column, right: Column) -> Column:
    products = F.zip_with(left, right, lambda a, b: a.cast("double") * b.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda total, term: total + term)


def cosine_similarity(left: Column, right: Column) -> Column:
    """NULL when either vector has length zero."""
    lengths = F.sqrt(_dot(left, left)) * F.sqrt(_dot(right, right))
    return F.round(_dot(left, right) / F.nullif(lengths, F.lit(0.0)), SIMILARITY_PLACES)


def cosine_distance(left: Column, right: Column) -> Column:
    return F.round(1 - cosine_similarity(left, right), SIMILARITY_PLACES)
