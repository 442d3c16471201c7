"""One run over the raw tables: staging views, then the stored models, then the checks."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from tallyline.plans import models, quality
from tallyline.sinks.layers import INTERMEDIATE, MARTS, STAGING, as_table, as_view

BY_SEASON = ("season_id",)
BY_DATE = ("match_date", "match_id")


@dataclass(frozen=True)
class RawTables:
    competitions: DataFrame
    teams: DataFrame
    matches: DataFrame
    standings: DataFrame


def build_models(raw: RawTables, root: str) -> dict[str, DataFrame]:
    """Write the intermediate and mart tables below ``root``; every model by name.

    A stored model is read back before the next one uses it, so each is computed once. Match
    tables are split by season and ordered by date: a run over one season reads one folder,
    and a date range skips the rest of each file. Give every build a root of its own where
    readers may still use the previous one; the files of a reused root are replaced.
    """
    built = {
        "stg_competitions": models.stg_competitions(raw.competitions),
        "stg_teams": models.stg_teams(raw.teams),
        "stg_matches": models.stg_matches(raw.matches),
        "stg_standings": models.stg_standings(raw.standings),
    }
    for name, frame in built.items():
        as_view(frame, STAGING, name)

    def store(layer: str, name: str, frame: DataFrame, *layout: tuple[str, ...]) -> None:
        built[name] = as_table(frame, root, layer, name, *layout)

    competitions, matches = built["stg_competitions"], built["stg_matches"]
    store(
        INTERMEDIATE, "int_match_results", models.int_match_results(matches, competitions), BY_SEASON, BY_DATE
    )
    store(INTERMEDIATE, "int_team_form", models.int_team_form(matches), BY_SEASON, BY_DATE)
    results = built["int_match_results"]
    store(MARTS, "mart_match_results", models.mart_match_results(results), BY_SEASON, BY_DATE)
    store(MARTS, "mart_league_table", models.mart_league_table(built["stg_standings"], competitions))
    store(MARTS, "mart_bottler_index", models.mart_bottler_index(results))
    return built


def check_models(built: dict[str, DataFrame]) -> DataFrame:
    return quality.run_all(built)
