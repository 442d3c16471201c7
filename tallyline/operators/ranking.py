"""Ranks and group moments over aggregated rows, without gathering a group's rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match; the keys appear once, from the left."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def kept_whole(frame: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``frame``, whose columns besides ``keys`` are all computed or none is.

    Two uses of an aggregate that read different columns of it would otherwise be pruned to two
    different plans, and the facts below read twice; alike they share one exchange. Filters on
    ``keys`` still pass.
    """
    others = [c for c in frame.columns if c not in keys]
    return frame.select(*keys, F.inline(F.array(F.struct(*others)))).select(*frame.columns)


def rank_within(
    frame: DataFrame, groups: Sequence[str], measures: Sequence[str], name: str = "position"
) -> DataFrame:
    """RANK() by ``measures``, all descending, inside each group.

    Rows with equal measures share a rank, so it is enough to rank the distinct score lines.
    They are counted with partial aggregation first; only that histogram meets the window over a
    group, and its size depends on the spread of the scores, not on how many rows a group has.
    The ranked lines then go before the rows they stand for, so NULL groups need no care, and a
    filter on ``groups`` passes through to the facts on both ways.

    ``frame`` is an aggregate; nothing is run or stored here, both ways share its exchange.
    """
    line = [*groups, *measures]
    whole = kept_whole(frame, groups)
    lines = whole.groupBy(*line).agg(F.count("*").alias("_tied"))
    best_first = Window.partitionBy(*groups).orderBy(*[F.desc(m) for m in measures])
    up_to_here = best_first.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rank = (F.sum("_tied").over(up_to_here) - F.col("_tied") + 1).cast("int")
    empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in frame.schema if f.name not in line]
    ranked = lines.select(*line, *empty, rank.alias("_rank"), F.lit(0).alias("_row"))
    rows = whole.withColumns({"_rank": F.lit(None).cast("int"), "_row": F.lit(1)})
    same_line = Window.partitionBy(*line).orderBy("_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = rows.unionByName(ranked).withColumn(name, F.max("_rank").over(same_line))
    return told.filter(F.col("_row") == 1).select(name, *frame.columns)


def with_group_values(frame: DataFrame, groups: Sequence[str], *values: Column) -> DataFrame:
    """Aggregates of a group beside each of its rows: grouped first, then joined back."""
    totals = frame.groupBy(*groups).agg(*values)
    return join_on(frame, totals, groups)
