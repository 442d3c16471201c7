"""Rolling form and recency over a team's history, out of summaries that compose.

A history is cut into calendar blocks of one team in one competition. A block is worked off alone
and leaves a summary: how many matches it has, and the points of its last four. Summaries of
neighbouring blocks compose to that of both, so what a block needs from all that came before
is a running composition over a few dozen small rows a decade. One plan serves every size:
a team with a large share of all rows is spread over its blocks, nothing is counted beforehand and no
step runs before the caller's sink does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

FRAME = 5
TEAM_KEYS = ("team_id", "competition_id")
ORDER = ("match_date", "match_id")
GRAIN = "month"

FORM, RECENCY = "form_points_last5", "match_recency_rank"
#: Columns of a block's rows: position in the block, points of the last five inside it.
NTH, OWN = "nth_in_block", "own_points"
#: Columns of a block's summary.
LENGTH, TAIL = "length", "tail"


def block_of(day: Column, grain: str = GRAIN) -> Column:
    """First day of the calendar block a day falls in."""
    return F.trunc(day, grain)


def with_form(sides: DataFrame, keys: Sequence[str] = TEAM_KEYS, grain: str = GRAIN) -> DataFrame:
    """Add the points of the last five matches and the rank counted from the newest match."""
    # Structs compare nulls as equal, and the join below finds the rows dealt out as the window left them.
    block = block_of(F.col("match_date"), grain)
    keyed = sides.withColumns({"_team": F.struct(*keys), "_key": F.struct(*keys, block.alias("block"))})
    local = in_blocks(keyed, ["_key"])
    summary = local.filter("_last").select("_team", "_key", F.col(NTH).alias(LENGTH), F.col("_points").alias(TAIL))
    placed = carried(summary, ["_team"], F.col("_key")).drop("_team")
    return composed(local.drop("_team", "_last", "_points").join(placed, "_key"), sides.columns)


def in_blocks(rows: DataFrame, block: Sequence[str]) -> DataFrame:
    """Each row's place in its block and what the block alone knows; ``_last`` marks the row that holds ``_points``."""
    oldest_first = Window.partitionBy(*block).orderBy(*ORDER)
    return rows.withColumns(
        {
            NTH: F.row_number().over(oldest_first).cast("bigint"),
            OWN: F.sum("points_earned").over(oldest_first.rowsBetween(1 - FRAME, 0)),
            "_points": F.collect_list("points_earned").over(oldest_first.rowsBetween(2 - FRAME, 0)),
            "_last": F.lead(F.lit(True)).over(oldest_first).isNull(),
        }
    )


def carried(summaries: DataFrame, team: Sequence[str], order: Column) -> DataFrame:
    """Beside each summary the composition of all before it: its last points, and matches before and in all.

    No block is empty, so the four points before a block lie in the four blocks before it.
    """
    by_block = Window.partitionBy(*team).orderBy(order)
    earlier = by_block.rowsBetween(Window.unboundedPreceding, -1)
    whole = by_block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return summaries.withColumns(
        {
            "_carry": F.flatten(F.collect_list(TAIL).over(by_block.rowsBetween(1 - FRAME, -1))),
            "_before": F.coalesce(F.sum(LENGTH).over(earlier), F.lit(0)),
            "_total": F.sum(LENGTH).over(whole),
        }
    ).drop(LENGTH, TAIL)


def composed(placed: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Form and recency of rows that stand beside what came before their block."""
    missing = F.greatest(F.lit(0), F.least(F.lit(FRAME) - F.col(NTH), F.size("_carry"))).cast("int")
    borrowed = F.when(
        missing > 0,
        F.aggregate(
            F.slice("_carry", F.size("_carry") - missing + 1, missing), F.lit(0).cast("bigint"), lambda a, b: a + b
        ),
    ).otherwise(0)
    recency = F.col("_total") - F.col("_before") - F.col(NTH) + 1
    return placed.select(*columns, (F.col(OWN) + borrowed).alias(FORM), recency.cast("bigint").alias(RECENCY))
