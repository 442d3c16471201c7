"""Inputs of the registered queries: contest models and feeds, all derived from the tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.plans import models, reports
from tallyline.sources.contest import ContestTables
from tallyline.workspace import stored

STAMP = "yyyy-MM-dd'T'HH:mm:ss'Z'"


class Inputs:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.raw = ContestTables(spark, sf_dir)

    def written_once(self, standings: bool = False) -> Inputs:
        """The same inputs with the matches written, for queries that make several feeds out of them."""
        self.raw_matches = stored(self.raw.matches(), "matches")
        self.stg_matches = models.stg_matches(self.raw_matches)
        if standings:
            self.raw_standings = stored(models.standings_from_matches(self.stg_matches), "standings")
        return self

    # -- models --------------------------------------------------------------------

    @cached_property
    def stg_competitions(self) -> DataFrame:
        return models.stg_competitions(self.raw.competitions())

    @cached_property
    def stg_teams(self) -> DataFrame:
        return models.stg_teams(self.raw.teams())

    @cached_property
    def raw_matches(self) -> DataFrame:
        return self.raw.matches()

    @cached_property
    def stg_matches(self) -> DataFrame:
        return models.stg_matches(self.raw.matches(models.FINISHED))

    @cached_property
    def raw_standings(self) -> DataFrame:
        return models.standings_from_matches(self.stg_matches)

    @cached_property
    def stg_standings(self) -> DataFrame:
        return models.stg_standings(self.raw_standings)

    @cached_property
    def results(self) -> DataFrame:
        return models.int_match_results(self.stg_matches, self.stg_competitions)

    @cached_property
    def matches(self) -> DataFrame:
        return models.mart_match_results(self.results)

    def season_matches(self, season: int) -> DataFrame:
        """The matches of one season, chosen before any line of an order is counted."""
        chosen = models.stg_matches(self.raw.matches(models.FINISHED, season))
        return models.mart_match_results(models.int_match_results(chosen, self.stg_competitions))

    @cached_property
    def league_table(self) -> DataFrame:
        return models.mart_league_table(self.stg_standings, self.stg_competitions)

    @cached_property
    def bottlers(self) -> DataFrame:
        return models.mart_bottler_index(self.results)

    @cached_property
    def team_form(self) -> DataFrame:
        return models.int_team_form(self.stg_matches)

    # -- reports -------------------------------------------------------------------

    @cached_property
    def stored(self) -> DataFrame:
        return self.raw.reports()

    @cached_property
    def reports(self) -> DataFrame:
        return reports.match_reports(self.stored, self.matches)

    @cached_property
    def vectors(self) -> DataFrame:
        return self.raw.vectors()

    def query_vectors(self, *ids: int) -> DataFrame:
        """The caller's query vectors: as many rows as ids."""
        asked = self.vectors.filter(F.col("report_id").isin(*ids))
        return asked.select(F.col("report_id").alias("query_id"), "embedding")

    # -- feeds, one small document per source row ------------------------------------

    def competition_docs(self) -> DataFrame:
        entry = F.struct(
            "id", "name", "code", "type", F.struct(F.col("area_name").alias("name")).alias("area"), "plan"
        )
        return self.raw.competitions().select(_document(F.array(entry).alias("competitions")))

    def team_docs(self) -> DataFrame:
        entry = F.struct(
            "id", "name", F.col("short_name").alias("shortName"), "tla",
            F.struct(F.col("area_name").alias("name")).alias("area"),
        )
        return self.raw.teams().select(
            _document(F.struct(F.col("competition_id").alias("id")).alias("competition"), F.array(entry).alias("teams"))
        )

    def match_docs(self, scored: bool = True) -> DataFrame:
        """Match documents; matches that have not begun carry no scores."""
        played = (F.col("status") != "SCHEDULED") & F.lit(scored)
        status = F.col("status") if scored else F.lit("SCHEDULED")

        def score(part: str) -> Column:
            pair = F.struct(F.col(f"home_score_{part}").alias("home"), F.col(f"away_score_{part}").alias("away"))
            return F.when(played, pair)

        def team(side: str) -> Column:
            return F.struct(F.col(f"{side}_team_id").alias("id"), F.col(f"{side}_team_name").alias("name"))

        entry = F.struct(
            "id",
            F.struct(F.col("competition_id").alias("id")).alias("competition"),
            F.struct(F.col("season_id").alias("id")).alias("season"),
            F.date_format("utc_date", STAMP).alias("utcDate"),
            status.alias("status"), "matchday",
            team("home").alias("homeTeam"), team("away").alias("awayTeam"),
            F.struct(
                F.when(played, F.col("winner")).alias("winner"),
                score("full_time").alias("fullTime"), score("half_time").alias("halfTime"),
            ).alias("score"),
        )
        return self.raw_matches.select(_document(F.array(entry).alias("matches")), "status", "id")

    def standing_docs(self) -> DataFrame:
        team = F.struct(F.col("team_id").alias("id"), F.col("team_name").alias("name")).alias("team")
        total = F.struct(
            team, "position", F.col("played_games").alias("playedGames"), "won", "draw", "lost", "points",
            F.col("goals_for").alias("goalsFor"), F.col("goals_against").alias("goalsAgainst"),
            F.col("goal_difference").alias("goalDifference"),
        )
        short = F.struct(team, "position", "points")

        def table(kind: str, entry: Column) -> Column:
            text = F.to_json(entry)
            return F.concat(F.lit(f'{{"stage":"REGULAR_SEASON","type":"{kind}","table":['), text, F.lit("]}"))

        value = F.concat(
            F.lit('{"competition":{"id":'), F.col("competition_id"), F.lit('},"season":{"id":'),
            F.col("season_id"), F.lit('},"standings":['), table("TOTAL", total), F.lit(","),
            table("HOME", short), F.lit("]}"),
        )
        return self.raw_standings.select(value.alias("value"))

    def squad_docs(self) -> DataFrame:
        day = F.date_add(F.lit("1970-01-01").cast("date"), (F.col("c_custkey") % 10000).cast("int"))
        born = F.when(F.col("c_mktsegment") == "BUILDING", "unknown").otherwise(day.cast("string"))
        entry = F.struct(
            F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
            F.element_at(F.split("c_name", "#"), 1).alias("firstName"),
            F.element_at(F.split("c_name", "#"), -1).alias("lastName"),
            born.alias("dateOfBirth"), F.concat(F.lit("N"), "c_nationkey").alias("nationality"),
            F.col("c_mktsegment").alias("position"), (F.col("c_custkey") % 99 + 1).alias("shirtNumber"),
        )
        return self.raw.table("customer").select(
            _document(F.col("c_nationkey").alias("id"), F.array(entry).alias("squad"))
        )

    def feeds(self) -> dict[str, DataFrame]:
        """The documents of every feed."""
        return {
            "competitions": self.competition_docs(), "teams": self.team_docs(), "matches": self.match_docs(),
            "standings": self.standing_docs(), "players": self.squad_docs(),
        }

    def unusable(self, feed: str) -> DataFrame:
        """Documents that hold nothing a table could take, one per supplier: each level of fault in turn."""
        n = F.col("s_suppkey").cast("string")
        array = {"players": "squad"}.get(feed, feed)
        entry = F.concat(F.lit('{"note":"'), n, F.lit('"}'))
        broken = F.concat(F.lit(f"{feed} "), n, F.lit(" {"))
        if feed == "standings":
            table = F.concat(F.lit('{"type":"HOME","table":['), entry, F.lit("]}"))
            tables = F.concat(F.lit('{"standings":['), table, F.lit(","), F.concat(F.lit('{"type":"'), n, F.lit('"}')), F.lit("]}"))
            value = F.when(F.col("s_suppkey") % 2 == 0, broken).otherwise(tables)
        else:
            entries = F.concat(F.lit(f'{{"{array}":['), entry, F.lit("]}"))
            value = F.when(F.col("s_suppkey") % 2 == 0, broken).otherwise(entries)
        return self.raw.table("supplier").select(value.alias("value"))

    # -- texts to judge, one per event -------------------------------------------------

    def statements(self) -> DataFrame:
        kind, user = F.col("event_type"), F.col("user_id").cast("string")
        cheap = F.col("value") < 20
        text = (
            F.when(kind == "click", F.concat(F.lit("select team_name from marts.mart_league_table where points > "), user))
            .when(
                kind == "view",
                F.concat(
                    F.lit("WITH t AS (SELECT * FROM marts.mart_match_results) -- drop nothing\n"
                          "SELECT count(*) FROM t WHERE matchday = "), user, F.lit(";"),
                ),
            )
            .when((kind == "purchase") & cheap, F.concat(F.lit("select * from raw.matches where id = "), user))
            .when(kind == "purchase", F.lit("  \n "))
            .when((kind == "signup") & cheap, F.lit("select 1 from marts.mart_match_results; select 2"))
            .when(kind == "signup", F.lit("select * from marts.mart_match_results where home_team_name = 'Update FC; update'"))
            .when(cheap, F.lit("Drop table marts.mart_bottler_index"))
            .otherwise(F.concat(F.lit("explain "), user))
        )
        return self.raw.table("events").select("event_id", "event_type", text.alias("statement"))

    def golden_cases(self) -> DataFrame:
        """A user turn is a case, the assistant turn after it is the response, if there is one."""
        turns = self.raw.table("conversations")
        asked = turns.filter(F.col("role") == "user").select(
            "conv_id", (F.col("turn") + 1).alias("turn"),
            F.col("text").alias("question"),
            F.slice(F.split("text", " "), 1, 1).alias("expected_contains"),
            F.slice(F.split("text", " "), -1, 1).alias("must_not_contain"),
            F.col("text").contains("?").alias("must_include_number"),
            F.when(F.length("text") < 60, "graceful_refusal").alias("expected_behaviour"),
        )
        return asked.join(self.responses(), ["conv_id", "turn"], "left")

    def responses(self) -> DataFrame:
        turns = self.raw.table("conversations")
        return turns.filter(F.col("role") == "assistant").select("conv_id", "turn", F.col("text").alias("response"))


def _document(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields)).alias("value")
