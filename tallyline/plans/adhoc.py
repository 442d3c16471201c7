"""Fixed compositions for the questions people ask most."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.rounding import count_where, percentage, ratio
from tallyline.operators.ranking import kept_whole, rank_within
from tallyline.operators.sides import sides_unpivot
from tallyline.operators.topk import top, top_per_group
from tallyline.plans.models import BEST_FIRST, combined, table_lines, tallies
from tallyline.plans.tools import season_lines

SEASON = ("competition_code", "season_id")


def top_scoring_team(table: DataFrame) -> DataFrame:
    best = top_per_group(table, SEASON, 1, F.desc("goals_for"), F.asc("team_name"))
    return best.select(*SEASON, "team_name", "goals_for")


def fewest_conceded(table: DataFrame) -> DataFrame:
    best = top_per_group(table, SEASON, 1, F.asc("goals_against"), F.asc("team_name"))
    return best.select(*SEASON, "team_name", "goals_against")


def best_goal_difference(table: DataFrame) -> DataFrame:
    best = top_per_group(table, SEASON, 1, F.desc("goal_difference"), F.asc("team_name"))
    return best.select(*SEASON, "team_name", "goal_difference")


def draw_count(matches: DataFrame) -> DataFrame:
    return matches.filter(F.col("result") == "draw").groupBy("competition_code").agg(F.count("*").alias("total_draws"))


def high_drop_rate(bottlers: DataFrame, above: float = 50.0) -> DataFrame:
    return (
        bottlers.filter(F.col("drop_rate_pct") > above)
        .select("team_name", *SEASON, "drop_rate_pct")
        .orderBy(F.desc("drop_rate_pct"), *SEASON, "team_name")
    )


def away_record(matches: DataFrame) -> DataFrame:
    away = sides_unpivot(matches, keep=SEASON).filter(F.col("venue") == "away")
    record = tallies(away, (*SEASON, "team_name"))
    return record.select(*SEASON, "team_name", "played_games", "won", "draw", "lost", "points").orderBy(
        F.desc("points"), F.desc("won"), *SEASON, "team_name"
    )


def total_goals(matches: DataFrame) -> DataFrame:
    return matches.agg(F.coalesce(F.sum("total_goals"), F.lit(0)).alias("total_goals"))


def home_win_pct(matches: DataFrame) -> DataFrame:
    won = matches.groupBy("competition_code").agg(
        count_where(F.col("result") == "home").alias("home_wins"), F.count("*").alias("matches")
    )
    return won.withColumn("home_win_pct", percentage(F.col("home_wins"), F.col("matches")))


def dropped_leads_total(matches: DataFrame) -> DataFrame:
    return matches.agg(count_where(F.col("is_ht_lead_dropped")).alias("dropped_leads"))


def avg_goals_dropped(matches: DataFrame) -> DataFrame:
    dropped = matches.filter("is_ht_lead_dropped").agg(
        F.sum("total_goals").alias("goals"), F.count("total_goals").alias("matches")
    )
    return dropped.select(ratio(F.col("goals"), F.col("matches"), 2).alias("avg_goals"))


def goalless_count(matches: DataFrame) -> DataFrame:
    goalless = matches.filter((F.col("home_goals") == 0) & (F.col("away_goals") == 0))
    return goalless.groupBy(*SEASON).agg(F.count("*").alias("goalless_matches"))


def avg_goals_matchday(matches: DataFrame, matchday: int = 1) -> DataFrame:
    first = matches.filter(F.col("matchday") == matchday).agg(
        F.sum("total_goals").alias("goals"), F.count("total_goals").alias("matches")
    )
    return first.select("matches", ratio(F.col("goals"), F.col("matches"), 2).alias("avg_goals"))


def top_scorers_bottlers(table: DataFrame, bottlers: DataFrame, n: int = 5, above: float = 30.0) -> DataFrame:
    """Teams among the n best scorers of their season that drop more than ``above`` percent."""
    scorers = top_per_group(table, SEASON, n, F.desc("goals_for"), F.asc("team_name"))
    dropping = bottlers.filter(F.col("drop_rate_pct") > above).select(*SEASON, "team_name", "drop_rate_pct")
    return scorers.join(dropping, [*SEASON, "team_name"]).select(
        *SEASON, "team_name", "goals_for", "drop_rate_pct"
    )


def competition_count(matches: DataFrame) -> DataFrame:
    return matches.agg(F.countDistinct("competition_code").alias("competitions"))


def top_bottlers(bottlers: DataFrame, n: int = 5) -> DataFrame:
    order = (F.desc("drop_rate_pct"), F.desc("matches_leading_ht"), F.asc("season_id"), F.asc("team_id"))
    return top(bottlers, n, *order).select(
        *SEASON, "team_name", "matches_leading_ht", "leads_dropped", "drop_rate_pct"
    )


def record_vs_top_n(matches: DataFrame, n: int = 6) -> DataFrame:
    """Every team's record against opponents ranked n or better in that season's table.

    The matches are tallied once per pair of teams; the table and the records both follow
    from those tallies, out of one exchange.
    """
    per_pair = (*SEASON, "team_name", "opponent_name")
    per_team = (*SEASON, "team_name")
    known = matches.dropna(subset=list(SEASON))  # others are in no table; said here, it holds for both uses
    pairs = kept_whole(tallies(sides_unpivot(known, keep=SEASON), per_pair), SEASON)
    table = rank_within(table_lines(combined(pairs, per_team)), SEASON, BEST_FIRST)
    best = table.filter(F.col("position") <= n).select(*SEASON, F.col("team_name").alias("opponent_name"))
    against = combined(pairs.join(best, [*SEASON, "opponent_name"], "left_semi"), per_team)
    return against.select(*per_team, "played_games", "won", "draw", "lost", "points")


def league_goals_ranking(matches: DataFrame) -> DataFrame:
    lines = season_lines(matches, ("competition_code",))
    return lines.select("competition_code", "total_matches", "avg_goals_per_game").orderBy(
        F.desc("avg_goals_per_game"), "competition_code"
    )


def dropped_lead_matches(matches: DataFrame) -> DataFrame:
    return (
        matches.filter("is_ht_lead_dropped")
        .select(
            "match_id", "match_date", "competition_code", "home_team_name", "away_team_name",
            "home_goals", "away_goals", "home_goals_ht", "away_goals_ht", "total_goals", "result",
        )
        .orderBy(F.desc("total_goals"), F.desc("match_date"), F.desc("match_id"))
    )


def points_gap(table: DataFrame) -> DataFrame:
    """Points between the first and the second team of every season."""
    two = top_per_group(
        table.select(*SEASON, "team_name", "points", "position"),
        SEASON, 2, F.asc("position"), F.asc("team_name"),
    )
    return two.groupBy(*SEASON).agg((F.max("points") - F.min("points")).alias("points_gap"))
