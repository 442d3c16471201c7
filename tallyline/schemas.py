"""Declared schemas: landing documents, raw tables, and the keys that identify a row.

Spark does not enforce keys; they drive the keyed sinks and the quality job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# -- landing documents -----------------------------------------------------------------
# Entries stay JSON strings inside their envelope: Spark's JSON parser copies the text of
# an object into a string field, so the full entry survives as raw_payload.

COMPETITIONS_ENVELOPE = "struct<competitions: array<string>>"
TEAMS_ENVELOPE = "struct<competition: struct<id: bigint>, teams: array<string>>"
MATCHES_ENVELOPE = "struct<matches: array<string>>"
STANDINGS_ENVELOPE = (
    "struct<competition: struct<id: bigint>, season: struct<id: bigint>,"
    " standings: array<string>>"
)
STANDING_TABLE = "struct<stage: string, type: string, `table`: array<string>>"
SQUAD_ENVELOPE = "struct<id: bigint, squad: array<string>>"

COMPETITION_ENTRY = (
    "struct<id: bigint, name: string, code: string, type: string,"
    " area: struct<name: string>, plan: string>"
)
TEAM_ENTRY = (
    "struct<id: bigint, name: string, shortName: string, tla: string, area: struct<name: string>>"
)
MATCH_ENTRY = (
    "struct<id: bigint, competition: struct<id: bigint>, season: struct<id: bigint>,"
    " utcDate: string, status: string, matchday: int,"
    " homeTeam: struct<id: bigint, name: string>, awayTeam: struct<id: bigint, name: string>,"
    " score: struct<winner: string, fullTime: struct<home: int, away: int>,"
    " halfTime: struct<home: int, away: int>>>"
)
STANDING_ENTRY = (
    "struct<team: struct<id: bigint, name: string>, position: int, playedGames: int, won: int,"
    " draw: int, lost: int, points: int, goalsFor: int, goalsAgainst: int, goalDifference: int>"
)
PLAYER_ENTRY = (
    "struct<id: bigint, name: string, firstName: string, lastName: string,"
    " dateOfBirth: string, nationality: string, position: string, shirtNumber: int>"
)

# -- raw tables ------------------------------------------------------------------------


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "string": T.StringType(),
    "date": T.DateType(),
    "timestamp_ntz": T.TimestampNTZType(),
    "array<float>": T.ArrayType(T.FloatType()),
}


def _struct(spec: str) -> T.StructType:
    """Columns as 'name type' pairs; StructType.fromDDL would need a running session."""
    pairs = [column.split() for column in spec.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


RAW_COMPETITIONS = _struct(
    "id bigint, name string, code string, type string, area_name string, plan string,"
    " raw_payload string, ingested_at timestamp_ntz"
)
RAW_TEAMS = _struct(
    "id bigint, name string, short_name string, tla string, competition_id bigint,"
    " area_name string, raw_payload string, ingested_at timestamp_ntz"
)
RAW_MATCHES = _struct(
    "id bigint, competition_id bigint, season_id bigint, utc_date timestamp_ntz, status string,"
    " matchday int, home_team_id bigint, home_team_name string, away_team_id bigint,"
    " away_team_name string, home_score_full_time int, away_score_full_time int,"
    " home_score_half_time int, away_score_half_time int, winner string,"
    " raw_payload string, ingested_at timestamp_ntz"
)
RAW_STANDINGS = _struct(
    "competition_id bigint, season_id bigint, stage string, type string, team_id bigint,"
    " team_name string, position int, played_games int, won int, draw int, lost int, points int,"
    " goals_for int, goals_against int, goal_difference int,"
    " raw_payload string, ingested_at timestamp_ntz"
)
RAW_PLAYERS = _struct(
    "id bigint, name string, first_name string, last_name string, date_of_birth date,"
    " nationality string, position string, shirt_number int, team_id bigint,"
    " raw_payload string, ingested_at timestamp_ntz"
)
RUN_LOG = _struct(
    "job string, task string, entity_type string, records_ingested bigint, keys_ingested bigint,"
    " records_rejected bigint, status string, error_message string, started_at timestamp_ntz, finished_at timestamp_ntz"
)
MATCH_REPORTS = _struct(
    "id bigint, match_id bigint, competition_code string, home_team string, away_team string,"
    " match_date date, matchday int, narrative string, generated_at timestamp_ntz"
)
REPORT_CHUNKS = _struct(
    "report_id bigint, chunk_index int, chunk_text string, embedding array<float>,"
    " created_at timestamp_ntz"
)


@dataclass(frozen=True)
class TableSpec:
    """A keyed table: its schema, its key, and which columns a later row may change."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]
    update_cols: tuple[str, ...] | None = None  # None: every column outside the key
    partition: str | None = None  # the column by which the stored base is split

    @property
    def replaced(self) -> tuple[str, ...]:
        if self.update_cols is not None:
            return self.update_cols
        return tuple(c for c in self.schema.names if c not in self.keys)


COMPETITIONS = TableSpec("competitions", RAW_COMPETITIONS, ("id",))
TEAMS = TableSpec("teams", RAW_TEAMS, ("id",))
MATCHES = TableSpec("matches", RAW_MATCHES, ("id",), partition="season_id")
STANDINGS = TableSpec("standings", RAW_STANDINGS, ("competition_id", "season_id", "team_id"), partition="season_id")
PLAYERS = TableSpec("players", RAW_PLAYERS, ("id",))
REPORTS = TableSpec("match_reports", MATCH_REPORTS, ("match_id",), ("narrative", "generated_at"))
CHUNKS = TableSpec("report_embeddings", REPORT_CHUNKS, ("report_id", "chunk_index"))
