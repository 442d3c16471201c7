"""Columns that several later expressions use."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def evaluated_once(frame: DataFrame, **columns: Column) -> DataFrame:
    """``frame`` with new columns that are computed a single time per row.

    Spark copies a projected expression into every filter and projection that uses it. For a
    regular expression or a JSON parse that repeats the work, so it goes through a generator,
    which later operators cannot look into.
    """
    fields = [column.alias(name) for name, column in columns.items()]
    return frame.select("*", F.inline(F.array(F.struct(*fields))))
