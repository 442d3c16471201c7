"""Top-k in one list or per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top(frame: DataFrame, n: int, *order: Column) -> DataFrame:
    """One list: each task keeps its best n, so n rows per task reach the driver side."""
    return frame.orderBy(*order).limit(n)


def top_per_group(frame: DataFrame, groups: Sequence[str], n: int, *order: Column) -> DataFrame:
    """Best n rows of every group.

    Spark limits each group to n rows per task before the shuffle (window group limit), so a
    group that holds most rows still sends only n rows from each task.
    """
    ranked = Window.partitionBy(*groups).orderBy(*order)
    return frame.withColumn("_nth", F.row_number().over(ranked)).filter(F.col("_nth") <= n).drop("_nth")
