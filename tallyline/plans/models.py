"""Staging, intermediate and mart models as functions from DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.rounding import count_where, percentage, ratio
from tallyline.operators.form import with_form
from tallyline.operators.ranking import rank_within
from tallyline.operators.sides import sides_unpivot

FINISHED = "FINISHED"
HIGH_SCORING = 4
MIN_LEADS = 3

MATCH_COLUMNS = (
    "match_id", "match_date", "matchday", "season_id", "competition_id", "competition_name",
    "competition_code", "home_team_id", "home_team_name", "away_team_id", "away_team_name",
    "home_goals", "away_goals", "home_goals_ht", "away_goals_ht", "total_goals", "goal_diff",
    "total_goals_ht", "result", "ht_leader", "is_high_scoring", "is_ht_lead_dropped",
)

# -- staging ---------------------------------------------------------------------------


def stg_competitions(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("code").isNotNull()).select(
        F.col("id").alias("competition_id"),
        F.col("name").alias("competition_name"),
        F.col("code").alias("competition_code"),
        F.col("type").alias("competition_type"),
        "area_name", "plan", "ingested_at",
    )


def stg_teams(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("team_id"),
        F.col("name").alias("team_name"),
        F.col("short_name").alias("team_short_name"),
        F.col("tla").alias("team_tla"),
        "competition_id", "area_name", "ingested_at",
    )


def _leader(home: str, away: str):
    return (
        F.when(F.col(home) > F.col(away), "home")
        .when(F.col(home) < F.col(away), "away")
        .when(F.col(home) == F.col(away), "draw")
    )


def stg_matches(raw: DataFrame) -> DataFrame:
    return raw.filter(F.col("status") == FINISHED).select(
        F.col("id").alias("match_id"),
        "competition_id", "season_id",
        F.to_date("utc_date").alias("match_date"),
        F.col("utc_date").alias("match_datetime"),
        "status", "matchday",
        "home_team_id", "home_team_name", "away_team_id", "away_team_name",
        F.col("home_score_full_time").alias("home_goals"),
        F.col("away_score_full_time").alias("away_goals"),
        F.col("home_score_half_time").alias("home_goals_ht"),
        F.col("away_score_half_time").alias("away_goals_ht"),
        _leader("home_score_full_time", "away_score_full_time").alias("result"),
        "winner", "ingested_at",
    )


def stg_standings(raw: DataFrame) -> DataFrame:
    return raw.select(
        "competition_id", "season_id", "team_id", "team_name", "position", "played_games",
        "won", "draw", "lost", "points", "goals_for", "goals_against", "goal_difference",
        ratio(F.col("points"), F.col("played_games"), 2).alias("points_per_game"),
        "ingested_at",
    )


# -- intermediate ----------------------------------------------------------------------


def int_match_results(matches: DataFrame, competitions: DataFrame) -> DataFrame:
    home, away = F.col("home_goals"), F.col("away_goals")
    home_ht, away_ht = F.col("home_goals_ht"), F.col("away_goals_ht")
    dropped = ((home_ht > away_ht) & (F.col("result") != "home")) | (
        (away_ht > home_ht) & (F.col("result") != "away")
    )
    names = competitions.select("competition_id", "competition_name", "competition_code")
    joined = matches.withColumnRenamed("competition_id", "_competition").join(
        names, F.col("_competition") == F.col("competition_id"), "left"
    )
    derived = joined.withColumns(
        {
            "total_goals": home + away,
            "goal_diff": home - away,
            "total_goals_ht": home_ht + away_ht,
            "ht_leader": _leader("home_goals_ht", "away_goals_ht"),
            "is_high_scoring": F.coalesce(home + away >= HIGH_SCORING, F.lit(False)),
            "is_ht_lead_dropped": F.coalesce(dropped, F.lit(False)),
        }
    )
    return derived.select(*MATCH_COLUMNS)


def team_sides(matches: DataFrame) -> DataFrame:
    """Per team and match: result and points."""
    sides = sides_unpivot(matches, keep=("match_id", "match_date", "competition_id", "season_id"))
    return sides.drop("venue", "opponent_id", "opponent_name")


def int_team_form(matches: DataFrame) -> DataFrame:
    """Per team and match: result, points, rolling form and recency."""
    return with_form(team_sides(matches))


# -- marts -----------------------------------------------------------------------------


def mart_match_results(results: DataFrame) -> DataFrame:
    return results.select(*MATCH_COLUMNS)


TALLIES = ("played_games", "won", "draw", "lost", "goals_for", "goals_against", "points")


def tallies(sides: DataFrame, groups: Sequence[str], *extra: Column) -> DataFrame:
    """Games, results, goals and points of every group; ``extra`` aggregates come in between."""
    result = F.col("team_result")
    return sides.groupBy(*groups).agg(
        *extra,
        F.count("*").alias("played_games"),
        count_where(result == "win").alias("won"),
        count_where(result == "draw").alias("draw"),
        count_where(result == "loss").alias("lost"),
        F.sum("goals_scored").alias("goals_for"),
        F.sum("goals_conceded").alias("goals_against"),
        F.sum("points_earned").alias("points"),
    )


def combined(parts: DataFrame, groups: Sequence[str]) -> DataFrame:
    """Tallies of finer groups added up."""
    return parts.groupBy(*groups).agg(*[F.sum(t).alias(t) for t in TALLIES])


def table_lines(tallied: DataFrame) -> DataFrame:
    """Tallies with goal difference and the four ratios, in the order of a league table."""
    played = F.col("played_games")
    leading = [c for c in tallied.columns if c not in TALLIES]
    return tallied.select(
        *leading, "played_games", "won", "draw", "lost", "goals_for", "goals_against",
        (F.col("goals_for") - F.col("goals_against")).alias("goal_difference"),
        "points",
        ratio(F.col("points"), played, 2).alias("points_per_game"),
        percentage(F.col("won"), played).alias("win_percentage"),
        ratio(F.col("goals_for"), played, 2).alias("goals_per_game"),
        ratio(F.col("goals_against"), played, 2).alias("conceded_per_game"),
    )


def standings_lines(sides: DataFrame, groups: Sequence[str], *extra: Column) -> DataFrame:
    return table_lines(tallies(sides, groups, *extra))


BEST_FIRST = ("points", "goal_difference", "goals_for")


def standings_from_matches(matches: DataFrame) -> DataFrame:
    """Raw standings rows, one per competition, season and team, from finished matches."""
    sides = sides_unpivot(matches, keep=("competition_id", "season_id", "ingested_at"))
    keys = ("competition_id", "season_id", "team_id", "team_name")
    lines = standings_lines(sides, keys, F.max("ingested_at").alias("ingested_at"))
    ranked = rank_within(lines, ("competition_id", "season_id"), BEST_FIRST)
    return ranked.select(
        *keys, "position", "played_games", "won", "draw", "lost", "points",
        "goals_for", "goals_against", "goal_difference", "ingested_at",
    )


def mart_league_table(standings: DataFrame, competitions: DataFrame) -> DataFrame:
    names = competitions.select("competition_id", "competition_name", "competition_code")
    played = F.col("played_games")
    return standings.join(names, "competition_id", "left").select(
        "competition_id", "season_id", "competition_name", "competition_code", "position",
        "team_name", "played_games", "won", "draw", "lost", "goals_for", "goals_against",
        "goal_difference", "points", "points_per_game",
        percentage(F.col("won"), played).alias("win_percentage"),
        ratio(F.col("goals_for"), played, 2).alias("goals_per_game"),
        ratio(F.col("goals_against"), played, 2).alias("conceded_per_game"),
    )


def mart_bottler_index(results: DataFrame) -> DataFrame:
    """How often a team drops a half-time lead, for teams that led at least three times."""
    home_led = F.col("ht_leader") == "home"
    leaders = results.filter(F.col("ht_leader").isin("home", "away")).select(
        "competition_id", "competition_code", "competition_name", "season_id",
        F.when(home_led, F.col("home_team_id")).otherwise(F.col("away_team_id")).alias("team_id"),
        F.when(home_led, F.col("home_team_name")).otherwise(F.col("away_team_name")).alias("team_name"),
        "is_ht_lead_dropped",
    )
    keys = [c for c in leaders.columns if c != "is_ht_lead_dropped"]
    counted = leaders.groupBy(*keys).agg(
        F.count("*").alias("matches_leading_ht"),
        count_where(F.col("is_ht_lead_dropped")).alias("leads_dropped"),
    )
    return counted.filter(F.col("matches_leading_ht") >= MIN_LEADS).withColumn(
        "drop_rate_pct", percentage(F.col("leads_dropped"), F.col("matches_leading_ht"))
    )
