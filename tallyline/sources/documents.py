"""Nested result feeds: lines of JSON to typed rows, bad records kept apart.

Every function takes a DataFrame with a string column ``value`` (one document per line, as
``spark.read.text`` or ``spark.readStream.text`` gives) and works in batch and on a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import schemas as S
from tallyline.functions.once import evaluated_once

OK, BAD_DOCUMENT, BAD_TABLE, BAD_ENTRY, NO_ENTRY = "ok", "document", "table", "entry", "empty"
REJECTED = (BAD_DOCUMENT, BAD_TABLE, BAD_ENTRY)


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def _parsed(frame: DataFrame, text: str, schema: str, name: str) -> DataFrame:
    """``frame`` with the object in column ``text``; unreadable text only fills ``_corrupt``."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    with_corrupt = schema[:-1] + ", _corrupt: string>"
    return evaluated_once(frame, **{name: F.from_json(F.col(text), with_corrupt, options)})


def classified(
    docs: DataFrame, envelope: str, array: str, entry: str, *parents: Column, key: str = "e.id"
) -> DataFrame:
    """Every entry of every document in one pass, with a ``level`` that says if it is usable.

    A bad document or entry costs only itself; the rest of the feed goes on. ``record`` is the text
    at the level of the fault.
    """
    opened = _parsed(docs, "value", envelope, "doc")
    entries = opened.select("value", "doc", *parents, F.explode_outer(array).alias("raw_payload"))
    read = _parsed(entries, "raw_payload", entry, "e")
    level = (
        F.when(F.col("doc._corrupt").isNotNull(), BAD_DOCUMENT)
        .when(F.col("raw_payload").isNull(), NO_ENTRY)
        .when(F.col(key).isNull(), BAD_ENTRY)
        .otherwise(OK)
    )
    return read.withColumns({"level": level, "record": F.coalesce("raw_payload", "value")}).drop("doc")


def classified_standings(docs: DataFrame, only_type: str | None = None) -> DataFrame:
    """Lines of the tables of every document in one pass; ``table_no`` and ``row_no`` keep the document's order.

    Three levels can be at fault: a document that is no JSON or whose tables are no list, a table
    without a list of lines, a line without a team. Each becomes one row with its own text.
    """
    opened = _parsed(docs, "value", S.STANDINGS_ENVELOPE, "doc")
    tables = opened.select(
        "value", F.col("doc._corrupt").isNotNull().alias("_broken"),
        F.col("doc.competition.id").alias("competition_id"), F.col("doc.season.id").alias("season_id"),
        F.posexplode_outer("doc.standings").alias("table_no", "_table"),
    )
    read = _parsed(tables, "_table", S.STANDING_TABLE, "t")
    if only_type is not None:
        read = read.filter((F.col("t.type") == only_type) | F.col("t.type").isNull())
    lines = read.select(
        "value", "_broken", "competition_id", "season_id", "table_no", "_table",
        F.col("t.stage").alias("stage"), F.col("t.type").alias("type"),
        F.col("t.table").isNull().alias("_no_lines"),
        F.posexplode_outer("t.table").alias("row_no", "raw_payload"),
    )
    entries = _parsed(lines, "raw_payload", S.STANDING_ENTRY, "e")
    level = (
        F.when(F.col("_table").isNull() & F.col("_broken"), BAD_DOCUMENT)
        .when(F.col("_table").isNull(), NO_ENTRY)
        .when(F.col("_no_lines"), BAD_TABLE)
        .when(F.col("raw_payload").isNull(), NO_ENTRY)
        .when(F.col("e.team.id").isNull(), BAD_ENTRY)
        .otherwise(OK)
    )
    record = F.coalesce("raw_payload", "_table", "value")
    return entries.withColumns({"level": level, "record": record}).drop("_table", "_broken", "_no_lines")


#: What each feed consists of: envelope, its list, an entry, and what entries take from the document.
_FEEDS = {
    "competitions": (S.COMPETITIONS_ENVELOPE, "doc.competitions", S.COMPETITION_ENTRY, ()),
    "teams": (S.TEAMS_ENVELOPE, "doc.teams", S.TEAM_ENTRY, (("doc.competition.id", "competition_id"),)),
    "matches": (S.MATCHES_ENVELOPE, "doc.matches", S.MATCH_ENTRY, ()),
    "players": (S.SQUAD_ENVELOPE, "doc.squad", S.PLAYER_ENTRY, (("doc.id", "team_id"),)),
}


def _entry_of(feed: str, columns: Sequence[str]) -> str:
    """The schema of a feed's entry without the fields that none of ``columns`` comes from."""
    entry = T.StructType.fromDDL(_FEEDS[feed][2])
    used = {_COLUMNS[feed][c].split(".")[1] for c in columns} | {"id"}
    return T.StructType([field for field in entry.fields if field.name in used]).simpleString()


def classified_feed(feed: str, docs: DataFrame, *carry: str, columns: Sequence[str] | None = None) -> DataFrame:
    """All records of a feed with ``level`` and ``record``, usable or not.

    Of an entry only what ``columns`` need is read, if they are given; which records are usable does not change.
    """
    if feed == "standings":
        return classified_standings(docs)
    envelope, array, entry, parents = _FEEDS[feed]
    entry = entry if columns is None else _entry_of(feed, columns)
    above = [F.col(place).alias(name) for place, name in parents]
    return classified(docs, envelope, array, entry, *above, *[F.col(c) for c in carry])


def counting_rejects(read: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows; whichever job reads them leaves the count of the unusable ones in the observation."""
    seen = Observation()
    return read.observe(seen, F.count_if(F.col("level").isin(*REJECTED)).alias("rejected")), seen


def rejected_records(read: DataFrame) -> DataFrame:
    """The records at fault and at which level."""
    return read.filter(F.col("level").isin(*REJECTED)).select("level", "record")


def rows_of_feed(feed: str, read: DataFrame, *carry: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Typed rows of the usable records; only ``columns``, the carried ones and the record, if they are given."""
    usable = read.filter(F.col("level") == OK)
    if columns is not None:
        return usable.select(*[F.col(c) for c in carry], *[F.col(_COLUMNS[feed][c]).alias(c) for c in columns], "raw_payload")
    now = F.convert_timezone(None, F.lit("UTC"), F.current_timestamp())
    columns = [F.col(path).alias(name) for name, path in _COLUMNS[feed].items()]
    if feed == "matches":
        columns = [c for name, c in zip(_COLUMNS[feed], columns, strict=True) if name != "utc_date"]
        columns.insert(3, utc_timestamp(F.col("e.utcDate")).alias("utc_date"))
    if feed == "players":
        columns.insert(4, F.try_to_date("e.dateOfBirth", "yyyy-M-d").alias("date_of_birth"))
    return usable.select(*[F.col(c) for c in carry], *columns, "raw_payload", now.alias("ingested_at"))


_COLUMNS = {
    "competitions": {
        "id": "e.id", "name": "e.name", "code": "e.code", "type": "e.type", "area_name": "e.area.name", "plan": "e.plan",
    },
    "teams": {
        "id": "e.id", "name": "e.name", "short_name": "e.shortName", "tla": "e.tla",
        "competition_id": "competition_id", "area_name": "e.area.name",
    },
    "matches": {
        "id": "e.id", "competition_id": "e.competition.id", "season_id": "e.season.id",
        "status": "e.status", "matchday": "e.matchday",
        "home_team_id": "e.homeTeam.id", "home_team_name": "e.homeTeam.name",
        "away_team_id": "e.awayTeam.id", "away_team_name": "e.awayTeam.name",
        "home_score_full_time": "e.score.fullTime.home", "away_score_full_time": "e.score.fullTime.away",
        "home_score_half_time": "e.score.halfTime.home", "away_score_half_time": "e.score.halfTime.away",
        "winner": "e.score.winner",
    },
    "standings": {
        "competition_id": "competition_id", "season_id": "season_id", "stage": "stage", "type": "type",
        "team_id": "e.team.id", "team_name": "e.team.name", "position": "e.position", "played_games": "e.playedGames",
        "won": "e.won", "draw": "e.draw", "lost": "e.lost", "points": "e.points", "goals_for": "e.goalsFor",
        "goals_against": "e.goalsAgainst", "goal_difference": "e.goalDifference",
        "table_no": "table_no", "row_no": "row_no",
    },
    "players": {
        "id": "e.id", "name": "e.name", "first_name": "e.firstName", "last_name": "e.lastName",
        "nationality": "e.nationality", "position": "e.position", "shirt_number": "e.shirtNumber", "team_id": "team_id",
    },
}


def competitions(docs: DataFrame) -> DataFrame:
    return rows_of_feed("competitions", classified_feed("competitions", docs))


def teams(docs: DataFrame) -> DataFrame:
    return rows_of_feed("teams", classified_feed("teams", docs))


def matches(docs: DataFrame, *carry: str, columns: Sequence[str] | None = None) -> DataFrame:
    return rows_of_feed("matches", classified_feed("matches", docs, *carry, columns=columns), *carry, columns=columns)


def whole_matches(rows: DataFrame, *carry: str) -> DataFrame:
    """All columns of rows that ``matches`` has read some ``columns`` of, out of their records."""
    read = _parsed(rows.select(*carry, "raw_payload"), "raw_payload", S.MATCH_ENTRY, "e")
    return rows_of_feed("matches", read.withColumn("level", F.lit(OK)), *carry)


def standings(docs: DataFrame, only_type: str | None = None) -> DataFrame:
    """Lines of all tables, or of those of one type."""
    return rows_of_feed("standings", classified_standings(docs, only_type))


def players(docs: DataFrame) -> DataFrame:
    return rows_of_feed("players", classified_feed("players", docs))


def rejected(feed: str, docs: DataFrame) -> DataFrame:
    """(level, record) of what a feed holds and cannot be used: documents, tables, entries."""
    return rejected_records(classified_feed(feed, docs))


def utc_timestamp(text: Column) -> Column:
    """ISO-8601 text with a zone to UTC wall time; NULL when it cannot be read."""
    return F.convert_timezone(None, F.lit("UTC"), F.try_to_timestamp(text))
