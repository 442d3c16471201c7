"""Insert-or-replace by key as one grouped pass."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.operators.ranking import join_on


def latest_by_key(
    rows: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """One row per key, as if the rows had been upserted one by one in ``order``.

    Replaced columns come from the last row, the others from the first. Both are partial
    aggregates, so a key with very many copies is reduced in every task before the shuffle.
    """
    keys = list(keys)
    rest = [c for c in rows.columns if c not in keys]
    replaced = rest if update_cols is None else list(update_cols)
    kept = [c for c in rest if c not in replaced]
    moment = F.struct(*order)
    picks = [F.max_by(F.struct(*replaced), moment).alias("_last")]
    if kept:
        picks.append(F.min_by(F.struct(*kept), moment).alias("_first"))
    one = rows.groupBy(*keys).agg(*picks)
    source = {**{c: "_last" for c in replaced}, **{c: "_first" for c in kept}}
    return one.select(
        *[F.col(c) if c in keys else F.col(f"{source[c]}.{c}").alias(c) for c in rows.columns]
    )


def last_by_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The whole last row of each key. Where no column keeps its first value this is ``latest_by_key``.

    Each task keeps one row of a key (window group limit) before the shuffle. A row is carried once,
    columns of ``order`` included, and columns nobody reads later are not carried at all.
    """
    last_first = Window.partitionBy(*keys).orderBy(*[F.desc(c) for c in order])
    return rows.withColumn("_nth", F.row_number().over(last_first)).filter(F.col("_nth") == 1).drop("_nth")


def merged(
    target: DataFrame, newest: DataFrame, keys: Sequence[str], update_cols: Sequence[str] | None = None
) -> DataFrame:
    """``target`` with the rows of ``newest`` in place of its own; each has a key at most once.

    The target only loses the rows that are replaced. While ``newest`` is small enough for
    Spark to broadcast, the target is not shuffled.
    """
    columns = target.columns
    untouched = join_on(target, newest.select(*keys), keys, "left_anti")
    kept = [] if update_cols is None else [c for c in columns if c not in keys and c not in update_cols]
    if kept:
        before = target.select(*keys, F.struct(*kept).alias("_before"))
        newest = join_on(newest, before, keys, "left").withColumns(
            {c: F.when(F.col("_before").isNotNull(), F.col(f"_before.{c}")).otherwise(F.col(c)) for c in kept}
        )
    return untouched.unionByName(newest.select(*columns))


def upsert(
    target: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    update_cols: Sequence[str] | None = None,
) -> DataFrame:
    """``target`` after ``batch``; of several batch rows with one key the last by ``order`` wins.

    The batch is derived and reduced once: each task keeps one row of a key (window group limit)
    before the shuffle, and the full outer join reuses that shuffle.
    """
    columns, keys = target.columns, list(keys)
    if update_cols is None:
        newest = last_by_key(batch, keys, order).select(*columns)
        replaced = set(columns)
    else:
        rows = batch.select(*columns, F.struct(*order).alias("_arrival"))
        newest = latest_by_key(rows, keys, [F.col("_arrival")], [*update_cols, "_arrival"]).drop("_arrival")
        replaced = set(update_cols)
    old = target.select(F.struct(*columns).alias("_old"), *[F.col(k).alias(f"_old_{k}") for k in keys])
    new = newest.select(F.struct(*columns).alias("_new"), *[F.col(k).alias(f"_new_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(f"_old_{k}").eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    has_old, has_new = F.col("_old").isNotNull(), F.col("_new").isNotNull()

    def pick(name: str) -> Column:
        from_new = has_new if name in replaced or name in keys else ~has_old
        return F.when(from_new, F.col("_new")[name]).otherwise(F.col("_old")[name]).alias(name)

    return old.join(new, same, "full").select(*[pick(c) for c in columns])
