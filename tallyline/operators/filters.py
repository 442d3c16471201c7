"""Predicates on the match table. Each one returns a Column for ``filter``."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.season import in_season


def everything() -> Column:
    return F.lit(True)


def name_like(name: str, pattern: str) -> Column:
    """Case-insensitive substring; ``%`` and ``_`` in the pattern are wildcards."""
    return F.col(name).ilike(f"%{pattern}%")


def involves(pattern: str) -> Column:
    return name_like("home_team_name", pattern) | name_like("away_team_name", pattern)


def pairing(a: str, b: str) -> Column:
    """The two teams met, in either venue order."""
    return (name_like("home_team_name", a) & name_like("away_team_name", b)) | (
        name_like("home_team_name", b) & name_like("away_team_name", a)
    )


def season_range(season: int | None, day: str = "match_date") -> Column:
    return everything() if season is None else in_season(F.col(day), season)


def equals(name: str, value: object | None) -> Column:
    """``name = value``, or no restriction for None."""
    return everything() if value is None else F.col(name) == value


def one_of(name: str, values: Iterable) -> Column:
    return F.col(name).isin(*values)


def season_ids(matches: DataFrame, competition_code: str, season: int) -> DataFrame:
    """The opaque season ids that a competition used in a season's date range."""
    return (
        matches.filter(equals("competition_code", competition_code) & season_range(season))
        .select("season_id")
        .distinct()
    )


def in_season_ids(frame: DataFrame, matches: DataFrame, competition_code: str, season: int) -> DataFrame:
    return frame.join(season_ids(matches, competition_code, season), "season_id", "left_semi")


def latest_season(frame: DataFrame) -> DataFrame:
    """Rows of the largest season id of their competition."""
    newest = frame.groupBy("competition_code").agg(F.max("season_id").alias("season_id"))
    return frame.join(newest, ["competition_code", "season_id"], "left_semi")
