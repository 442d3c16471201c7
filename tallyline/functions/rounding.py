"""Exact ratios: divide and round in decimal (half up), cast to double last."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EXACT = "decimal(20,0)"


def ratio(numerator: Column, denominator: Column, places: int, scale: int = 1) -> Column:
    """``scale * numerator / denominator`` of two integers; NULL for a zero denominator."""
    top = (numerator.cast("bigint") * F.lit(scale).cast("bigint")).cast(_EXACT)
    bottom = F.nullif(denominator.cast("bigint"), F.lit(0).cast("bigint")).cast(_EXACT)
    return F.round(top / bottom, places).cast("double")


def percentage(part: Column, whole: Column, places: int = 1) -> Column:
    return ratio(part, whole, places, scale=100)


def count_where(condition: Column) -> Column:
    """How many rows satisfy ``condition``; NULL counts as no, an empty group gives 0."""
    return F.count_if(F.coalesce(condition, F.lit(False)))
