"""The question-level operators. Each takes mart DataFrames and plain parameters."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.functions.rounding import count_where, percentage, ratio
from tallyline.functions.season import parse_season, season_label
from tallyline.functions.statements import judge_statements
from tallyline.operators import filters as on
from tallyline.operators.form import FORM, FRAME
from tallyline.operators.ranking import rank_within
from tallyline.operators.sides import sides_unpivot
from tallyline.operators.topk import top
from tallyline.plans.models import BEST_FIRST, standings_lines

NEWEST_FIRST = ("match_date", "match_id")


def _newest() -> list[Column]:
    return [F.desc(c) for c in NEWEST_FIRST]


def current_season(today: dt.date | None = None) -> int:
    today = today or dt.date.today()
    return today.year if today.month >= 7 else today.year - 1


def resolve_season(references: DataFrame, column: str, today: dt.date | None = None) -> DataFrame:
    start = parse_season(F.col(column), today)
    return references.withColumn("season_start_year", start).withColumn(
        "season_label", season_label(F.col("season_start_year"))
    )


def league_table(
    matches: DataFrame, competition_code: str, season: int | None = None, today: dt.date | None = None
) -> DataFrame:
    """Standings computed from the matches; without a season, the calendar's current one."""
    season = current_season(today) if season is None else season
    played = matches.filter(on.equals("competition_code", competition_code) & on.season_range(season))
    lines = standings_lines(sides_unpivot(played, keep=("competition_code",)), ("competition_code", "team_name"))
    return rank_within(lines, ("competition_code",), BEST_FIRST).drop("competition_code").orderBy(
        "position", "team_name"
    )


def league_tables(matches: DataFrame) -> DataFrame:
    """Standings of every competition and season in one job."""
    groups = ("competition_code", "season_id")
    lines = standings_lines(sides_unpivot(matches, keep=groups), (*groups, "team_name"))
    return rank_within(lines, groups, BEST_FIRST)


def bottler_index(
    bottlers: DataFrame,
    matches: DataFrame,
    competition_code: str,
    min_matches_leading: int = 3,
    season: int | None = None,
) -> DataFrame:
    """Teams by share of dropped half-time leads; without a season, the latest season id."""
    mine = bottlers.filter(on.equals("competition_code", competition_code))
    if season is None:
        mine = on.latest_season(mine)
    else:
        mine = on.in_season_ids(mine, matches, competition_code, season)
    return (
        mine.filter(F.col("matches_leading_ht") >= min_matches_leading)
        .select("team_name", "competition_name", "matches_leading_ht", "leads_dropped", "drop_rate_pct")
        .orderBy(F.desc("drop_rate_pct"), "team_name")
    )


# -- one team --------------------------------------------------------------------------


def _is_team(side: str, team: str | int) -> Column:
    """A team by name pattern, or exactly by id."""
    if isinstance(team, int):
        return F.col(f"{side}_team_id") == team
    return on.name_like(f"{side}_team_name", team)


def _seen_by(team: str | int) -> tuple[Column, Column]:
    """Whether a match is the team's, and the match from its point of view.

    When a pattern fits both sides, home counts.
    """
    at_home, away = _is_team("home", team), _is_team("away", team)
    result = F.col("result")
    won = (at_home & (result == "home")) | (away & (result == "away"))
    view = F.struct(
        "match_id", "match_date", "competition_code",
        F.when(at_home, F.col("away_team_name")).otherwise(F.col("home_team_name")).alias("opponent"),
        F.when(at_home, "home").otherwise("away").alias("venue"),
        "home_goals", "away_goals",
        F.when(at_home, F.col("home_goals")).otherwise(F.col("away_goals")).alias("goals_scored"),
        F.when(at_home, F.col("away_goals")).otherwise(F.col("home_goals")).alias("goals_conceded"),
        "result",
        F.when(won, "W").when(result == "draw", "D").otherwise("L").alias("team_result"),
    )
    return at_home | away, view


def _wanted(competition_code: str | None, season: int | None) -> Column:
    return on.equals("competition_code", competition_code) & on.season_range(season)


def team_matches(
    matches: DataFrame, team: str | int, competition_code: str | None = None, season: int | None = None
) -> DataFrame:
    """Matches from one team's point of view."""
    involved, view = _seen_by(team)
    mine = matches.filter(involved & _wanted(competition_code, season))
    return mine.select(F.inline(F.array(view)))


class TeamSeason(NamedTuple):
    splits: DataFrame
    matches: DataFrame


SPLITS = ("aggregate", "home", "away")
CELL = ("venue", "team_result")


def split_cells(played: DataFrame, *groups: str) -> DataFrame:
    """Matches and goals per venue and result: at most six rows, from which every split follows."""
    return played.groupBy(*groups, *CELL).agg(
        F.count("*").alias("n"), F.sum("goals_scored").alias("gf"), F.sum("goals_conceded").alias("ga")
    )


def team_splits(played: DataFrame) -> DataFrame:
    """Overall, home and away totals; zeros when there are no matches."""
    totals = []
    for split in SPLITS:
        here = F.lit(True) if split == "aggregate" else F.col("venue") == split

        def added(value: str, only: Column = here) -> Column:
            return F.coalesce(F.sum(F.when(only, F.col(value))), F.lit(0))

        outcome = F.col("team_result")
        totals += [
            added("n").alias(f"{split}_played"),
            added("n", here & (outcome == "W")).alias(f"{split}_won"),
            added("n", here & (outcome == "D")).alias(f"{split}_drawn"),
            added("n", here & (outcome == "L")).alias(f"{split}_lost"),
            added("gf").alias(f"{split}_gf"),
            added("ga").alias(f"{split}_ga"),
        ]

    def line(split: str) -> Column:
        def c(name: str) -> Column:
            return F.col(f"{split}_{name}")

        points = c("won") * 3 + c("drawn")

        def per_game(value: Column) -> Column:
            return F.coalesce(ratio(value, c("played"), 2), F.lit(0.0))

        return F.struct(
            F.lit(split).alias("split"),
            *[c(n).alias(n) for n in ("played", "won", "drawn", "lost")],
            c("gf").alias("goals_for"),
            c("ga").alias("goals_against"),
            (c("gf") - c("ga")).alias("goal_difference"),
            points.alias("points"),
            per_game(points).alias("points_per_game"),
            F.coalesce(percentage(c("won"), c("played")), F.lit(0.0)).alias("win_percentage"),
            per_game(c("gf")).alias("goals_per_game"),
            per_game(c("ga")).alias("conceded_per_game"),
        )

    lines = F.array(*[line(s) for s in SPLITS])
    return split_cells(played).agg(*totals).select(F.inline(lines))


COMPARED = ("played", "won", "drawn", "lost", "goals_for", "goals_against", "goal_difference", "points")


def compare_teams(
    matches: DataFrame, team_a: int | str, team_b: int | str, competition_code: str | None = None,
    season: int | None = None,
) -> DataFrame:
    """One row per measure with both teams' values, from one pass over the matches."""
    (has_a, view_a), (has_b, view_b) = _seen_by(team_a), _seen_by(team_b)
    views = F.array_compact(
        F.array(
            F.when(has_a, F.struct(F.lit("a").alias("team"), view_a.alias("view"))),
            F.when(has_b, F.struct(F.lit("b").alias("team"), view_b.alias("view"))),
        )
    )
    mine = matches.filter((has_a | has_b) & _wanted(competition_code, season))
    cells = split_cells(mine.select(F.inline(views)).select("team", "view.*"), "team")

    def values(team: str) -> list[Column]:
        here, outcome = F.col("team") == team, F.col("team_result")

        def added(value: str, only: Column = here) -> Column:
            return F.coalesce(F.sum(F.when(only, F.col(value))), F.lit(0))

        won, drawn, lost = (added("n", here & (outcome == r)) for r in ("W", "D", "L"))
        gf, ga = added("gf"), added("ga")
        return [added("n"), won, drawn, lost, gf, ga, gf - ga, won * 3 + drawn]

    rows = [
        F.struct(F.lit(m).alias("measure"), a.alias("team_a"), b.alias("team_b"))
        for m, a, b in zip(COMPARED, values("a"), values("b"))
    ]
    return cells.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def team_season_stats(
    matches: DataFrame, team: str | int, competition_code: str, season: int | None = None
) -> TeamSeason:
    played = team_matches(matches, team, competition_code, season)
    shown = played.drop("competition_code").orderBy(*NEWEST_FIRST)
    return TeamSeason(team_splits(played), shown)


def team_form(
    matches: DataFrame,
    team: str | int,
    last_n_games: int = 5,
    competition_code: str | None = None,
    season: int | None = None,
) -> DataFrame:
    """Latest matches with the points of the five matches up to each.

    Only the newest n + 4 rows can matter, so the sort keeps those and the window, which has
    no partition of its own, never sees more.
    """
    played = team_matches(matches, team, competition_code, season)
    points = F.when(F.col("team_result") == "W", 3).when(F.col("team_result") == "D", 1).otherwise(0)
    recent = top(played.withColumn("_points", points), last_n_games + FRAME - 1, *_newest())
    oldest_first = Window.partitionBy(F.lit(0)).orderBy(*NEWEST_FIRST)
    formed = recent.withColumn(FORM, F.sum("_points").over(oldest_first.rowsBetween(1 - FRAME, 0)))
    return top(formed.drop("_points", "team_result"), last_n_games, *_newest())


# -- matches ---------------------------------------------------------------------------


def head_to_head(matches: DataFrame, team_a: str, team_b: str, season: int | None = None) -> DataFrame:
    return (
        matches.filter(on.pairing(team_a, team_b) & on.season_range(season))
        .select(
            "match_id", "match_date", "competition_code", "matchday", "home_team_name",
            "away_team_name", "home_goals", "away_goals", "result", "total_goals",
        )
        .orderBy(*_newest())
    )


def high_scoring_matches(
    matches: DataFrame,
    competition_code: str | None = None,
    min_goals: int = 5,
    limit: int = 10,
    season: int | None = None,
) -> DataFrame:
    wanted = matches.filter(
        (F.col("total_goals") >= min_goals)
        & on.equals("competition_code", competition_code)
        & on.season_range(season)
    )
    shown = wanted.select(
        "match_id", "match_date", "competition_code", "home_team_name", "away_team_name",
        "home_goals", "away_goals", "total_goals", "result",
    )
    return top(shown, limit, F.desc("total_goals"), *_newest())


def recent_matches(matches: DataFrame, competition_code: str, limit: int = 5) -> DataFrame:
    shown = matches.filter(on.equals("competition_code", competition_code)).select(
        "match_id", "match_date", "matchday", "competition_code", "competition_name",
        "home_team_name", "away_team_name", "home_goals", "away_goals", "home_goals_ht",
        "away_goals_ht", "total_goals", "result", "ht_leader", "is_ht_lead_dropped", "is_high_scoring",
    )
    return top(shown, limit, *_newest())


# -- competitions ----------------------------------------------------------------------


def season_lines(matches: DataFrame, groups: Sequence[str], *extra: Column) -> DataFrame:
    """Totals of every group; ``extra`` aggregates come last."""
    result = F.col("result")
    summed = matches.groupBy(*groups).agg(
        F.count("*").alias("total_matches"),
        F.sum("total_goals").alias("total_goals"),
        F.count("total_goals").alias("_scored"),
        count_where(result == "home").alias("home_wins"),
        count_where(result == "draw").alias("draws"),
        count_where(result == "away").alias("away_wins"),
        F.max("total_goals").alias("highest_scoring_match"),
        count_where(F.col("is_high_scoring")).alias("high_scoring_matches"),
        *extra,
    )
    more = summed.columns[len(groups) + 8 :]
    return summed.select(
        *groups, "total_matches", "total_goals",
        ratio(F.col("total_goals"), F.col("_scored"), 2).alias("avg_goals_per_game"),
        "home_wins", "draws", "away_wins", "highest_scoring_match", "high_scoring_matches", *more,
    )


def season_summary(matches: DataFrame, competition_code: str, season: int | None = None) -> DataFrame:
    """One line for the competition, none when it has no matches."""
    mine = matches.filter(on.equals("competition_code", competition_code) & on.season_range(season))
    return season_lines(mine, ("competition_code",))


def season_highlights(matches: DataFrame) -> DataFrame:
    """Most common result and biggest win of every competition and season."""
    groups = ("competition_code", "season_id")
    margin = F.struct(
        F.abs("goal_diff").alias("margin"), F.col("total_goals"), F.col("match_date"), F.col("match_id")
    )
    lines = season_lines(matches, groups, F.max(margin).alias("big"))
    most = F.greatest("home_wins", "draws", "away_wins")
    common = (
        F.when(F.col("home_wins") == most, "home").when(F.col("away_wins") == most, "away").otherwise("draw")
    )
    return lines.select(
        *groups, common.alias("most_common_result"),
        F.col("big.margin").alias("biggest_margin"), F.col("big.match_id").alias("biggest_win_match_id"),
    )


def db_stats(matches: DataFrame) -> DataFrame:
    return (
        matches.groupBy("competition_code")
        .agg(F.count("*").alias("matches"), F.countDistinct("season_id").alias("seasons"))
        .orderBy(F.desc("matches"), "competition_code")
    )


def away_over_home_wins(matches: DataFrame) -> DataFrame:
    """Teams with more wins as the away side than as the home side."""
    sides = sides_unpivot(matches, keep=())
    won = F.col("team_result") == "win"
    wins = sides.groupBy("team_name").agg(
        count_where(won & (F.col("venue") == "home")).alias("home_wins"),
        count_where(won & (F.col("venue") == "away")).alias("away_wins"),
    )
    return wins.filter(F.col("away_wins") > F.col("home_wins")).orderBy(F.desc("away_wins"), "team_name")


# -- statements ------------------------------------------------------------------------

MART_TABLES = ("mart_league_table", "mart_match_results", "mart_bottler_index")


class Answer(NamedTuple):
    ok: bool
    rows: DataFrame | None
    error: str


_RELATION = re.compile(r"'UnresolvedRelation \[([^\]]*)\]")
_NAMED_QUERIES = re.compile(r"^[ :+\-]*CTE \[([^\]]*)\]", re.MULTILINE)
_CALLS_OUT = re.compile(r"\b(?:reflect|try_reflect|java_method)\b`?\s*\(", re.IGNORECASE)
NOT_A_MART, CALLS_OUT = "Query may only read the known marts", "Query may not call methods by name"


def _reaches_out(spark: SparkSession, statement: str, tables: Iterable[str]) -> str | None:
    """Why a statement reads or calls something else than the marts, judged on the parsed plan.

    The plan shows every relation, in joins by comma, in subqueries and named queries alike. What is no
    mart must be a query the statement names itself, and such a name may not stand for a table too, since
    outside its scope it would.
    """
    plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement).treeString()
    named = {n.strip().lower() for names in _NAMED_QUERIES.findall(plan) for n in names.split(",")}
    allowed = {f"marts, {t}".lower() for t in tables}
    read = {r.lower() for r in _RELATION.findall(plan)}
    shadowed = any(spark.catalog.tableExists(n) for n in read & named if n.isidentifier())
    if not read <= allowed | named or shadowed or "UnresolvedTableValuedFunction" in plan:
        return NOT_A_MART
    return CALLS_OUT if _CALLS_OUT.search(statement) else None


def guarded_sql(spark: SparkSession, statement: str, tables: Iterable[str] = MART_TABLES) -> Answer:
    """Run one read-only statement on the published marts; a refusal comes back as a value."""
    tables = tuple(tables)
    asked = spark.range(1).select(F.lit(statement).alias("statement"))
    problem = judge_statements(asked, "statement", tables).first()["problem"]
    try:
        problem = problem or _reaches_out(spark, statement.strip().rstrip(";"), tables)
        if problem is not None:
            return Answer(False, None, problem)
        return Answer(True, spark.sql(statement), "")
    except Exception as refused:
        return Answer(False, None, str(refused))
