"""Two sides per contest: one scan of the match table gives one row per team and match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POINTS_WIN = 3
POINTS_DRAW = 1


def _leg(side: str, other: str) -> Column:
    won, lost = F.col("result") == side, F.col("result") == other
    drawn = F.col("result") == "draw"
    return F.struct(
        F.lit(side).alias("venue"),
        F.col(f"{side}_team_id").alias("team_id"),
        F.col(f"{side}_team_name").alias("team_name"),
        F.col(f"{other}_team_id").alias("opponent_id"),
        F.col(f"{other}_team_name").alias("opponent_name"),
        F.col(f"{side}_goals").alias("goals_scored"),
        F.col(f"{other}_goals").alias("goals_conceded"),
        F.when(won, "win").when(drawn, "draw").when(lost, "loss").alias("team_result"),
        F.when(won, POINTS_WIN).when(drawn, POINTS_DRAW).otherwise(0).alias("points_earned"),
    )


def sides_unpivot(matches: DataFrame, keep: tuple[str, ...] = ("match_id", "match_date")) -> DataFrame:
    """A home row and an away row for every match.

    ``keep`` names the match columns to carry over; they stay out of the generator, so that filters
    on them reach the matches. Rows without a result have a NULL
    ``team_result`` and no points on both sides.
    """
    legs = F.array(_leg("home", "away"), _leg("away", "home"))
    return matches.select(*keep, F.inline(legs))
