"""Every operator as a query over the test tables: name -> (spark, directory) -> DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from suite.inputs import Inputs
from tallyline import schemas as S
from tallyline.functions.season import parse_season, season_label, season_of_date
from tallyline.functions.statements import judge_statements, strip_fences
from tallyline.functions.text import text_chunks
from tallyline.functions.vectors import cosine_distance, cosine_similarity
from tallyline.operators import filters as on
from tallyline.operators.latest import upsert
from tallyline.operators.sides import sides_unpivot
from tallyline.operators.topk import top, top_per_group
from tallyline.operators.vector_search import similar_chunks, top_chunks
from tallyline.plans import adhoc, anomalies, build, evaluation, ingest, models, quality, reports, tools
from tallyline.plans.build import RawTables
from tallyline.sinks.layers import publish
from tallyline.sources import documents
from tallyline.sources.landing import Window, scan_window
from tallyline.streaming import landing as stream
from tallyline.streaming.form import FormTable
from tallyline.workspace import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]

TODAY = dt.date(1997, 3, 1)
SEASON = 1996
LEAGUE = "R1"
TEAM = "nation_1"
TEAM_ID = 7
LOW_SIMILARITY = 0.1
QUERY_IDS = tuple(range(100))
GUESTS = 100

QUERIES: dict[str, Query] = {}


def query(build: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a function of Inputs under its own name."""
    QUERIES[build.__name__] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))
    return build


def register(name: str, build: Callable[[Inputs], DataFrame]) -> None:
    QUERIES[name] = lambda spark, sf_dir: build(Inputs(spark, sf_dir))


# -- sources ---------------------------------------------------------------------------

VOLATILE = ("raw_payload", "ingested_at")


@query
def src_competitions(i: Inputs) -> DataFrame:
    return documents.competitions(i.competition_docs()).drop(*VOLATILE)


@query
def src_teams(i: Inputs) -> DataFrame:
    return documents.teams(i.team_docs()).drop(*VOLATILE)


@query
def src_matches(i: Inputs) -> DataFrame:
    return documents.matches(i.match_docs()).drop(*VOLATILE)


@query
def src_standings(i: Inputs) -> DataFrame:
    return documents.standings(i.standing_docs()).drop(*VOLATILE)


@query
def src_players(i: Inputs) -> DataFrame:
    return documents.players(i.squad_docs()).drop(*VOLATILE)


register(
    "scan_window",
    lambda i: scan_window(i.raw_matches, Window.full(TODAY)).select("id", "utc_date", "status"),
)


@query
def scan_windows(i: Inputs) -> DataFrame:
    """Matches that each kind of run would read, as of TODAY."""
    windows = {
        "incremental": Window.incremental(TODAY),
        "full": Window.full(TODAY),
        "seasons": Window.of_seasons([1995, 1999]),
        "bounded": Window(date_from=dt.date(1996, 8, 1), date_to=dt.date(1996, 8, 31), status="FINISHED"),
    }
    conditions = F.array(
        *[
            F.struct(
                F.lit(name).alias("run"),
                w.condition(F.col("utc_date"), F.col("status")).alias("keep"),
            )
            for name, w in windows.items()
        ]
    )
    tagged = i.raw_matches.select("id", F.inline(conditions)).filter("keep")
    return tagged.groupBy("run").agg(F.count("*").alias("matches"), F.sum("id").alias("id_sum"))


@query
def src_partial_failure(i: Inputs) -> DataFrame:
    """Truncated documents and unreadable ids are kept apart; the rest is ingested."""
    docs = i.match_docs()
    damaged = (
        F.when(F.col("status") == "IN_PLAY", F.expr("left(value, length(value) - 7)"))
        .when(F.col("status") == "SCHEDULED", F.replace("value", F.lit('[{"id":'), F.lit('[{"id":"x"," id":')))
        .otherwise(F.col("value"))
    )
    feed = docs.select(damaged.alias("value"))
    read = documents.classified(feed, S.MATCHES_ENVELOPE, "doc.matches", S.MATCH_ENTRY)
    return read.groupBy("level").agg(F.count("*").alias("records"))


@query
def src_rejects(i: Inputs) -> DataFrame:
    """What an ingestion run keeps of the records it could not use, for every feed."""
    i = i.written_once(standings=True)
    root = fresh_dir(i.spark, "rejects")
    docs = {feed: frame.select("value").unionByName(i.unusable(feed)) for feed, frame in i.feeds().items()}
    ingest.ingest(docs, root, 3)
    kept = [ingest.rejected(i.spark, root, feed).withColumn("feed", F.lit(feed)) for feed in docs]
    return reduce(DataFrame.unionByName, kept).select("feed", "level", "record", "version")


# -- sinks -----------------------------------------------------------------------------


@query
def upsert_competitions(i: Inputs) -> DataFrame:
    target = i.raw.competitions().select("id", "name", "plan")
    batch = i.raw.table("nation").select(
        F.col("n_regionkey").cast("bigint").alias("id"), F.col("n_name").alias("name"),
        F.lit("TIER_TWO").alias("plan"), "n_nationkey",
    )
    return upsert(target, batch, ["id"], ["n_nationkey"])


@query
def upsert_teams(i: Inputs) -> DataFrame:
    """Many sightings of the same team in one batch: the last one wins."""
    target = i.raw.teams().select("id", "name", "competition_id")
    batch = i.raw.table("customer").select(
        F.col("c_nationkey").cast("bigint").alias("id"), F.col("c_name").alias("name"),
        F.col("c_custkey").alias("competition_id"), "c_custkey",
    )
    return upsert(target, batch, ["id"], ["c_custkey"])


@query
def upsert_matches(i: Inputs) -> DataFrame:
    """Orders are fixtures without scores; the finished matches replace theirs."""
    columns = ("id", "status", "home_score_full_time", "away_score_full_time", "winner")
    target = i.raw.table("orders").select(
        F.col("o_orderkey").alias("id"), F.lit("TIMED").alias("status"),
        F.lit(None).cast("int").alias("home_score_full_time"),
        F.lit(None).cast("int").alias("away_score_full_time"), F.lit(None).cast("string").alias("winner"),
    )
    batch = i.raw_matches.select(*columns, "utc_date")
    return upsert(target, batch, ["id"], ["utc_date"])


@query
def upsert_standings(i: Inputs) -> DataFrame:
    """The table after 26 matchdays, of away sides under their own competitions too, then that of the full seasons.

    The full table has no rows for a team as a guest of another competition, so those keep the early ones.
    """
    keys = ["competition_id", "season_id", "team_id"]
    columns = [*keys, "position", "played_games", "points", "goal_difference"]
    first = i.stg_matches.filter(F.col("matchday") <= 26)
    guests = first.withColumn("competition_id", F.col("competition_id") + GUESTS)
    early = models.standings_from_matches(first.unionByName(guests))
    late = models.standings_from_matches(i.stg_matches)
    return upsert(early.select(*columns), late.select(*columns, "ingested_at"), keys, ["ingested_at"])


@query
def sink_feeds(i: Inputs) -> DataFrame:
    """All five feeds through their keyed tables: two batches, a fold, a third batch; rows and sums of what is stored."""
    i = i.written_once(standings=True)
    root = fresh_dir(i.spark, "feeds")
    feeds = {feed: frame.select("value") for feed, frame in i.feeds().items()}
    early = {feed: frame.filter(F.length("value") % 2 == 0) for feed, frame in feeds.items()}
    early["matches"] = i.match_docs(scored=False).select("value")
    ingest.ingest(early, root, 1)
    ingest.ingest(feeds, root, 4)
    stored = ingest.tables(i.spark, root)
    for table in stored.values():
        table.compact()
    ingest.ingest({feed: frame.filter(F.length("value") % 3 == 0) for feed, frame in feeds.items()}, root, 5)
    counts = []
    for feed, table in stored.items():
        key = F.col(table.spec.keys[-1])
        name = "team_name" if feed == "standings" else "home_team_name" if feed == "matches" else "name"
        played = F.sum("home_score_full_time") if feed == "matches" else F.lit(0).cast("bigint")
        counts.append(
            table.current().agg(
                F.lit(feed).alias("feed"), F.count("*").alias("rows"), F.sum(key).alias("keys"),
                F.sum(F.length(name)).alias("letters"), played.alias("goals"),
            )
        )
    return reduce(DataFrame.unionByName, counts)


@query
def sink_one_season(i: Inputs) -> DataFrame:
    """One season of the stored matches: fixtures folded into the base, then the results from a stream of its own."""
    i = i.written_once()
    root = fresh_dir(i.spark, "season")
    table = stream.matches_table(i.spark, f"{root}/matches")
    for scored in (False, True):
        _land(i.match_docs(scored), f"{root}/landing-{scored}")
        docs = stream.landing_stream(i.spark, f"{root}/landing-{scored}")
        stream.ingest_matches(docs, table, f"{root}/checkpoint-{scored}").awaitTermination()
        table.compact()
    return table.current(1 * 10000 + SEASON).drop(*VOLATILE)


@query
def upsert_players(i: Inputs) -> DataFrame:
    target = i.raw.table("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("position"),
        F.col("c_nationkey").cast("bigint").alias("team_id"),
    )
    batch = i.raw.table("orders").select(
        F.col("o_custkey").alias("id"), F.concat(F.lit("P"), F.col("o_custkey")).alias("name"),
        F.col("o_orderpriority").alias("position"), F.col("o_orderkey").alias("team_id"),
        "o_orderdate", "o_orderkey",
    )
    return upsert(target, batch, ["id"], ["o_orderdate", "o_orderkey"])


@query
def upsert_reports(i: Inputs) -> DataFrame:
    """Only the narrative and its time change on a stored report; the row keeps its id."""
    target = i.raw.table("documents").select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("match_id"), F.col("source").alias("competition_code"),
        F.col("text").alias("narrative"), F.lit(0).cast("bigint").alias("generated_at"),
    )
    batch = i.raw.table("conversations").select(
        F.col("conv_id").alias("id"), F.col("conv_id").alias("match_id"), F.col("role").alias("competition_code"),
        F.col("text").alias("narrative"), F.col("turn").alias("generated_at"),
    )
    return upsert(target, batch, ["match_id"], ["generated_at"], S.REPORTS.update_cols)


@query
def upsert_chunks(i: Inputs) -> DataFrame:
    """Larger chunks replace the first ones; the old tail stays."""
    stored = i.stored
    target = reports.chunk_reports(stored, 300)
    batch = reports.chunk_reports(stored, 600)
    return upsert(target, batch.withColumn("turn", F.lit(1)), ["report_id", "chunk_index"], ["turn"])


@query
def ingestion_log(i: Inputs) -> DataFrame:
    """All five feeds through their keyed tables, with records that no table can take; one log line each."""
    i = i.written_once(standings=True)
    docs = {feed: frame.select("value").unionByName(i.unusable(feed)) for feed, frame in i.feeds().items()}
    log = ingest.ingest(docs, fresh_dir(i.spark, "ingest"), 1)
    return log.entries().select("entity_type", "records_ingested", "keys_ingested", "records_rejected", "status")


# -- models ----------------------------------------------------------------------------

register("stg_competitions", lambda i: i.stg_competitions)
register("stg_teams", lambda i: i.stg_teams)
register("stg_matches", lambda i: i.stg_matches)
register("stg_standings", lambda i: i.stg_standings)
register("int_match_results", lambda i: i.results)
register("mart_match_results", lambda i: i.matches)
register("mart_league_table", lambda i: i.league_table)
register("mart_bottler_index", lambda i: i.bottlers)
register("team_form_all", lambda i: i.team_form)


@query
def build_models(i: Inputs) -> DataFrame:
    """Every layer written and read back: rows and distinct match or team keys per model."""
    raw = RawTables(i.raw.competitions(), i.raw.teams(), i.raw_matches, i.raw_standings)
    built = build.build_models(raw, fresh_dir(i.spark, "layers"))
    counts = [
        built[name].agg(F.lit(name).alias("model"), F.count("*").alias("rows"), F.countDistinct(key).alias("keys"))
        for name, key in (
            ("int_match_results", "match_id"), ("int_team_form", "team_id"), ("mart_match_results", "match_id"),
            ("mart_league_table", "team_name"), ("mart_bottler_index", "team_id"),
        )
    ]
    return reduce(DataFrame.unionByName, counts)


# -- filters ---------------------------------------------------------------------------

LINE = ("match_id", "match_date", "competition_code", "home_team_name", "away_team_name", "total_goals")


def _lines(condition: Callable[[], Column]) -> Callable[[Inputs], DataFrame]:
    return lambda i: i.matches.filter(condition()).select(*LINE)


register("flt_status", lambda i: i.raw.matches("FINISHED").filter(on.equals("status", "FINISHED")).select("id", "status"))
register("flt_name_pattern", _lines(lambda: on.involves(TEAM)))
register("flt_pair_pattern", _lines(lambda: on.pairing("NATION_2", "nation_7")))
register("flt_season_range", _lines(lambda: on.season_range(SEASON)))
register("flt_season_ids", lambda i: on.in_season_ids(i.bottlers, i.matches, LEAGUE, SEASON))
register("flt_latest_season", lambda i: on.latest_season(i.bottlers))
register("flt_optional", _lines(lambda: on.equals("competition_code", None) & on.equals("competition_code", LEAGUE)))
register("flt_in_list", _lines(lambda: on.one_of("competition_code", ["R0", "R3"])))
register("flt_threshold", _lines(lambda: F.col("total_goals") >= 5))
register("flt_having", lambda i: tools.away_over_home_wins(i.matches))

# -- joins -----------------------------------------------------------------------------

register(
    "join_left_dim",
    lambda i: i.results.select("match_id", "competition_id", "competition_name", "competition_code"),
)


@query
def join_inner_report(i: Inputs) -> DataFrame:
    return i.vectors.withColumnRenamed("report_id", "id").join(i.reports, "id").select(
        "id", "chunk_index", "match_id", "competition_code", "home_team", "match_date"
    )


@query
def join_semi_season(i: Inputs) -> DataFrame:
    table = on.in_season_ids(i.league_table, i.matches, LEAGUE, SEASON)
    return table.select("competition_code", "season_id", "team_name", "points")


register("join_anti_notin", lambda i: reports.narrative_backlog(i.matches, i.stored).select("match_id"))
register("join_anti_notexists", lambda i: reports.embedding_backlog(i.stored, i.vectors))


@query
def join_vector_topk(i: Inputs) -> DataFrame:
    known = reports.known_chunks(i.vectors, i.stored)
    found = top_chunks(known, i.query_vectors(*QUERY_IDS), 5, LOW_SIMILARITY)
    matches = i.stored.select(F.col("id").alias("report_id"), "match_id")
    return found.join(matches, "report_id").select("query_id", "report_id", "chunk_index", "match_id", "similarity")


# -- aggregations ----------------------------------------------------------------------



@query
def agg_league_table(i: Inputs) -> DataFrame:
    groups = ("competition_code", "season_id")
    return models.standings_lines(sides_unpivot(i.matches, keep=groups), (*groups, "team_name"))


register("agg_season_summary", lambda i: tools.season_lines(i.matches, ("competition_code", "season_id")))
register("agg_team_splits", lambda i: tools.team_season_stats(i.matches, TEAM_ID, LEAGUE).splits)
register("agg_db_stats", lambda i: tools.db_stats(i.matches))


@query
def agg_count_star(i: Inputs) -> DataFrame:
    counts = {
        "reports": i.stored, "report_embeddings": i.vectors, "mart_match_results": i.matches,
    }
    frames = [f.agg(F.count("*").alias("rows")).select(F.lit(n).alias("table_name"), "rows") for n, f in counts.items()]
    return frames[0].unionByName(frames[1]).unionByName(frames[2])


@query
def agg_conditional_sum(i: Inputs) -> DataFrame:
    sides = sides_unpivot(i.matches, keep=())
    won = F.col("team_result") == "win"
    return sides.groupBy("team_name").agg(
        F.count_if(won & (F.col("venue") == "home")).alias("home_wins"),
        F.count_if(won & (F.col("venue") == "away")).alias("away_wins"),
    )


# -- windows ---------------------------------------------------------------------------

register("win_form_points_last5", lambda i: i.team_form.select("match_id", "team_id", "form_points_last5"))
register("win_recency_rank", lambda i: i.team_form.select("match_id", "team_id", "match_recency_rank"))
register("win_form_query", lambda i: tools.team_form(i.matches, TEAM, 25))


@query
def win_position_rank(i: Inputs) -> DataFrame:
    ranked = tools.league_tables(i.matches)
    return ranked.select("competition_code", "season_id", "team_name", "position")


FEATURE_KEYS = ("competition_code", "season_id", "team_name")
register(
    "win_league_avg",
    lambda i: anomalies.league_features(i.league_table).select(
        *FEATURE_KEYS, "league_avg_ppg", "league_avg_goals", "league_avg_conceded"
    ),
)
register(
    "win_league_stddev",
    lambda i: anomalies.league_features(i.league_table).select(
        *FEATURE_KEYS, "stddev_ppg", "stddev_goals", "stddev_conceded"
    ),
)

# -- sorts, limits, top-k --------------------------------------------------------------

register("topk_high_scoring", lambda i: tools.high_scoring_matches(i.matches, min_goals=4, limit=25))


@query
def topk_recent(i: Inputs) -> DataFrame:
    """The five newest matches of every team."""
    sides = sides_unpivot(i.matches)
    return top_per_group(sides, ["team_id"], 5, F.desc("match_date"), F.desc("match_id")).select(
        "team_id", "match_id", "match_date", "team_result"
    )


register("sort_ranked", lambda i: adhoc.dropped_lead_matches(i.matches).select(*LINE))


@query
def topk_similarity(i: Inputs) -> DataFrame:
    hits = similar_chunks(i.vectors, i.query_vectors(0), LOW_SIMILARITY)
    return top(hits, 10, F.desc("similarity"), F.asc("report_id"), F.asc("chunk_index"))


@query
def fn_cosine(i: Inputs) -> DataFrame:
    """Each stored vector against the one stored after it."""
    left = i.vectors.select("report_id", "embedding")
    right = i.vectors.select((F.col("report_id") - 1).alias("report_id"), F.col("embedding").alias("following"))
    pair = (F.col("embedding"), F.col("following"))
    return left.join(right, "report_id").select(
        "report_id", cosine_similarity(*pair).alias("similarity"), cosine_distance(*pair).alias("distance")
    )


# -- set operations --------------------------------------------------------------------

MATCH_KEYS = ("match_id", "match_date", "competition_id", "season_id")
register("sides_unpivot", lambda i: sides_unpivot(i.matches, keep=MATCH_KEYS))
register(
    "sides_unpivot_names",
    lambda i: sides_unpivot(i.matches, keep=("match_id", "result")).select("match_id", "team_name", "result"),
)
register(
    "distinct_union",
    lambda i: reports.distinct_union(reports.embedding_backlog(i.stored, i.vectors), i.stored),
)

# -- streaming -------------------------------------------------------------------------


#: Lines of a landed file. Compressed files are not split, so their size bounds what a task reads.
LANDED_LINES = 50_000


def _land(docs: DataFrame, path: str) -> None:
    writer = docs.select("value").write.mode("append").option("maxRecordsPerFile", LANDED_LINES)
    writer.option("compression", "lz4").text(path)


@query
def stream_ingest_upsert(i: Inputs) -> DataFrame:
    """Two days of landed files: fixtures first, then the same matches with their results."""
    i = i.written_once()
    root = fresh_dir(i.spark, "stream")
    table = stream.matches_table(i.spark, f"{root}/matches")
    for scored in (False, True):
        _land(i.match_docs(scored), f"{root}/landing")
        docs = stream.landing_stream(i.spark, f"{root}/landing")
        stream.ingest_matches(docs, table, f"{root}/checkpoint").awaitTermination()
    return table.current().drop(*VOLATILE)


@query
def stream_dedup_late(i: Inputs) -> DataFrame:
    """Fixtures, results and the results once more: the repeat is dropped, the correction stays."""
    i = i.written_once()
    root = fresh_dir(i.spark, "dedup")
    for scored in (False, True, True):
        _land(i.match_docs(scored), f"{root}/landing")
    rows = documents.matches(stream.landing_stream(i.spark, f"{root}/landing"), "landed_at")
    unique = stream.drop_repeats(rows, "landed_at", "id", "raw_payload")
    stream.run_to_table(unique.select("id", "status", "payload_hash"), f"{root}/out", f"{root}/checkpoint")
    return i.spark.read.parquet(f"{root}/out").select("id", "status")


@query
def stream_late_corrections(i: Inputs) -> DataFrame:
    """Fixtures, results a month later, then both again as of a day behind the horizon, some of them corrected."""
    i = i.written_once()
    root = fresh_dir(i.spark, "late")
    again = i.match_docs().withColumn(
        "value", F.when(F.col("id") % 5 == 0, F.replace("value", F.lit('"matchday":'), F.lit('"matchday":1'))).otherwise(F.col("value"))
    )
    days = ((i.match_docs(False), "2001-01-01"), (i.match_docs(), "2001-02-01"), (i.match_docs(False).unionByName(again), "2001-01-11"))
    late = []
    for docs, day in days:
        _land(docs.withColumn("value", F.concat(F.lit(day), F.lit(" "), "value")), f"{root}/landing")
        feed = stream.landing_stream(i.spark, f"{root}/landing").select(
            F.expr("substring(value, 12)").alias("value"), F.expr("cast(left(value, 10) as timestamp)").alias("landed_at")
        )
        rows = documents.matches(feed, "landed_at", columns=("id",))
        unique = stream.drop_repeats(rows, "landed_at", "id", "raw_payload")
        stream.run_to_table(unique.select("id", "payload_hash", "landed_at"), f"{root}/out", f"{root}/checkpoint")
        stream.keep_late(
            feed, "landed_at", "id", "raw_payload", f"{root}/out", f"{root}/late", f"{root}/checkpoint-late",
            read=lambda docs: documents.matches(docs, "landed_at", columns=("id",)),
            whole=lambda kept: documents.whole_matches(kept, "landed_at", "payload_hash"),
        ).awaitTermination()
    return i.spark.read.parquet(f"{root}/late").select("id", "status", "matchday")


@query
def stream_form(i: Inputs) -> DataFrame:
    """Form after three batches: even matches, some with swapped scores or a wrong day, then odd ones, then the corrections."""
    i = i.written_once()
    root = fresh_dir(i.spark, "form")
    table, form = stream.matches_table(i.spark, f"{root}/matches"), FormTable(i.spark, f"{root}/form")
    docs, k = i.match_docs(), F.col("id")
    swapped = F.replace(F.replace(F.replace("value", F.lit('"home":'), F.lit('"x":')), F.lit('"away":'), F.lit('"home":')), F.lit('"x":'), F.lit('"away":'))
    moved = F.regexp_replace("value", r'"utcDate":"(\d{4})-\d\d', r'"utcDate":"$1-03')
    wrong = F.when(k % 7 == 0, swapped).when(k % 11 == 0, moved).otherwise(F.col("value"))
    batches = (
        docs.filter(k % 2 == 0).withColumn("value", wrong), docs.filter(k % 2 == 1),
        docs.filter((k % 7 == 0) | (k % 11 == 0)),
    )
    for batch in batches:
        _land(batch, f"{root}/landing")
        feed = stream.landing_stream(i.spark, f"{root}/landing")
        stream.ingest_matches(
            feed, table, f"{root}/checkpoint", after=lambda rows, version: form.update(rows, table.current(), version)
        ).awaitTermination()
    return form.current()


# -- per-row functions -----------------------------------------------------------------


def _phrases(i: Inputs) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    kind = F.col("event_type")
    phrase = (
        F.when(kind == "click", F.concat(F.lit("  This Season"), F.lit(" ")))
        .when(kind == "view", F.concat(k, F.lit(" seasons ago")))
        .when(kind == "purchase", F.concat(F.lit("20"), F.lpad(k, 2, "0"), F.lit("/27")))
        .when(kind == "signup", F.lit("Previous season"))
        .otherwise(F.concat(F.lit("season 20"), F.lpad(k, 2, "0")))
    )
    return i.raw.table("events").select("event_id", phrase.alias("phrase"))


@query
def season_parse(i: Inputs) -> DataFrame:
    return _phrases(i).select("event_id", parse_season(F.col("phrase"), TODAY).alias("season_start"))


@query
def resolve_season(i: Inputs) -> DataFrame:
    return tools.resolve_season(_phrases(i), "phrase", TODAY).drop("phrase")


register(
    "season_label",
    lambda i: i.matches.select("match_id", season_label(season_of_date(F.col("match_date"))).alias("season_label")),
)


register(
    "season_of_date",
    lambda i: i.matches.select(
        "match_id",
        season_of_date(F.col("match_date")).alias("july_season"),
        season_of_date(F.col("match_date"), 8).alias("august_season"),
    ),
)
register(
    "text_chunks",
    lambda i: i.raw.table("conversations").select(
        "conv_id", "turn", F.posexplode(text_chunks(F.col("text"), 120)).alias("chunk_index", "chunk_text")
    ),
)
register(
    "sql_guard",
    lambda i: judge_statements(i.statements(), "statement").select("event_id", "statement_type", "problem"),
)


@query
def fence_strip(i: Inputs) -> DataFrame:
    fenced = F.concat(F.lit("```sql\n"), F.col("statement"), F.lit("\n```"))
    return i.statements().select("event_id", strip_fences(fenced).alias("statement"))


register("prompt_build", lambda i: reports.prompts(i.matches))


@query
def context_block(i: Inputs) -> DataFrame:
    return reports.context_blocks(_search(i))


@query
def judge_parse(i: Inputs) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("int")
    text = F.when(
        F.col("event_type") == "error", F.concat(F.lit("Scores: "), F.col("props"))
    ).otherwise(
        F.concat(
            F.lit('{"grounding": '), (k % 5 + 1).cast("string"), F.lit(', "responsiveness": 4, "accuracy": '),
            (k % 3 + 1).cast("string"), F.lit(', "issues": ["a", "b"], "overall_pass": true}'),
        )
    )
    parsed = evaluation.parse_scores(i.raw.table("events").select("event_id", text.alias("judge")), "judge")
    return parsed.select(
        "event_id", F.col("scores").isNotNull().alias("readable"), "scores.grounding", "scores.responsiveness",
        "scores.accuracy", F.array_join("scores.issues", ",").alias("issues"), "scores.overall_pass",
    )


# -- question-level operators ----------------------------------------------------------

register("league_table", lambda i: tools.league_table(i.season_matches(SEASON), LEAGUE, SEASON))
register("league_table_current", lambda i: tools.league_table(i.matches, LEAGUE, today=TODAY))
register("league_tables", lambda i: tools.league_tables(i.matches))
register("bottler_index", lambda i: tools.bottler_index(i.bottlers, i.matches, LEAGUE, 4, SEASON))
register("bottler_index_latest", lambda i: tools.bottler_index(i.bottlers, i.matches, LEAGUE))
register("team_season_stats", lambda i: tools.team_season_stats(i.season_matches(SEASON), TEAM, LEAGUE, SEASON).splits)
register("team_season_matches", lambda i: tools.team_season_stats(i.season_matches(SEASON), TEAM, LEAGUE, SEASON).matches)
register("team_form", lambda i: tools.team_form(i.matches, TEAM_ID, 7))
register("head_to_head", lambda i: tools.head_to_head(i.matches, "NATION_2", "NATION_7"))
register("high_scoring_matches", lambda i: tools.high_scoring_matches(i.season_matches(SEASON), LEAGUE, 4, 10, SEASON))
register("season_summary", lambda i: tools.season_summary(i.season_matches(SEASON), LEAGUE, SEASON))
register("season_highlights", lambda i: tools.season_highlights(i.matches))


def _search(i: Inputs) -> DataFrame:
    return reports.report_search(
        i.vectors, i.reports, i.query_vectors(*QUERY_IDS), 5, LOW_SIMILARITY
    )


@query
def report_search(i: Inputs) -> DataFrame:
    return reports.report_search(i.vectors, i.reports, i.query_vectors(*QUERY_IDS))


register("report_search_low", _search)


@query
def guarded_sql(i: Inputs) -> DataFrame:
    """A statement on the published marts."""
    marts = {
        "mart_match_results": i.matches, "mart_league_table": i.league_table, "mart_bottler_index": i.bottlers,
    }
    publish(i.spark, marts, fresh_dir(i.spark, "published"))
    answer = tools.guarded_sql(
        i.spark,
        "select competition_code, count(*) as total_draws from marts.mart_match_results"
        " where result = 'draw' group by competition_code",
    )
    if not answer.ok:
        raise RuntimeError(answer.error)
    return answer.rows


MART = "marts.mart_match_results"
ATTEMPTS = {
    "comma join of marts": f"select m.match_id from {MART} m, marts.mart_bottler_index b"
    " where b.team_id = m.home_team_id and b.season_id = m.season_id",
    "named query": f"with t as (select * from {MART}) select t.match_id from t where t.home_goals in (select max(home_goals) from {MART})",
    "comma join": f"select m.match_id from {MART} m, raw.matches r",
    "file": f"select match_id from {MART} where match_id in (select id from parquet.`/data`)",
    "comma file": f"select match_id from {MART}, parquet.`/data`",
    "reflection": f"select match_id from {MART} where java_method('java.lang.System', 'getProperty', 'user.home') = result",
    "function": f"select match_id from {MART}, range(3)",
    "other relation": f"select match_id from {MART} union all select id from staging_secret",
}


@query
def guarded_refusals(i: Inputs) -> DataFrame:
    """Statements that read beyond the marts are refused; rows of those that do not."""
    publish(i.spark, {"mart_match_results": i.matches, "mart_bottler_index": i.bottlers}, fresh_dir(i.spark, "guarded"))
    found = []
    for name, text in ATTEMPTS.items():
        answer = tools.guarded_sql(i.spark, text)
        rows = answer.rows if answer.ok else i.spark.range(0)
        found.append(rows.agg(F.lit(name).alias("attempt"), F.lit(answer.error).alias("refusal"), F.count("*").alias("rows")))
    return reduce(DataFrame.unionByName, found)


register("league_anomaly_features", lambda i: anomalies.league_features(i.league_table))
register("league_anomaly_flags", lambda i: anomalies.league_flags(anomalies.league_features(i.league_table)))
register("anomaly_prompt", lambda i: anomalies.prompts(anomalies.league_features(i.league_table)))
register("narrative_backlog", lambda i: reports.narrative_backlog(i.matches, i.stored, ["R0", "R1", "R2", "R3"]))
register("embedding_backlog", lambda i: reports.embedding_backlog(i.stored, i.vectors))
register("backlog_cost", lambda i: reports.backlog_cost(reports.narrative_backlog(i.matches, i.stored)))
register("chunk_reports", lambda i: reports.chunk_reports(i.stored))
register("recent_matches", lambda i: tools.recent_matches(i.matches, LEAGUE, 12))
register("db_stats", lambda i: tools.db_stats(i.matches))
register("away_over_home_wins", lambda i: tools.away_over_home_wins(i.matches))

# -- ad-hoc shapes ---------------------------------------------------------------------

register("top_scoring_team", lambda i: adhoc.top_scoring_team(i.league_table))
register("draw_count", lambda i: adhoc.draw_count(i.matches))
register("high_drop_rate", lambda i: adhoc.high_drop_rate(i.bottlers))
register("away_record", lambda i: adhoc.away_record(i.matches))
register("total_goals", lambda i: adhoc.total_goals(i.matches))
register("fewest_conceded", lambda i: adhoc.fewest_conceded(i.league_table))
register("home_win_pct", lambda i: adhoc.home_win_pct(i.matches))
register("best_goal_difference", lambda i: adhoc.best_goal_difference(i.league_table))
register("dropped_leads_total", lambda i: adhoc.dropped_leads_total(i.matches))
register("avg_goals_dropped", lambda i: adhoc.avg_goals_dropped(i.matches))
register("goalless_count", lambda i: adhoc.goalless_count(i.matches))
register("avg_goals_matchday", lambda i: adhoc.avg_goals_matchday(i.matches, 1))
register("top_scorers_bottlers", lambda i: adhoc.top_scorers_bottlers(i.league_table, i.bottlers))
register("competition_count", lambda i: adhoc.competition_count(i.matches))
register("top_bottlers", lambda i: adhoc.top_bottlers(i.bottlers, 10))
register("record_vs_top_n", lambda i: adhoc.record_vs_top_n(i.matches, 6))
register("league_goals_ranking", lambda i: adhoc.league_goals_ranking(i.matches))
register("dropped_lead_matches", lambda i: adhoc.dropped_lead_matches(i.matches))
register("compare_teams", lambda i: tools.compare_teams(i.matches, 2, TEAM_ID))
register("points_gap", lambda i: adhoc.points_gap(i.league_table))
register(
    "anomaly_summary",
    lambda i: anomalies.anomaly_summary(anomalies.league_flags(anomalies.league_features(i.league_table))),
)

# -- data quality ----------------------------------------------------------------------


@query
def dq_unique(i: Inputs) -> DataFrame:
    """Order lines have no unique pair key; matches do."""
    lines = i.raw.table("lineitem")
    return (
        quality.check_model("lineitem", lines, unique=("l_orderkey", "l_linenumber"))
        .unionByName(quality.check_model("stg_matches", i.stg_matches, unique=("match_id",)))
    )


@query
def dq_not_null(i: Inputs) -> DataFrame:
    """Facts of reports are missing where the match is unknown."""
    return quality.check_model("match_reports", i.reports, quality.not_null("id", "match_id", "home_team", "match_date"))


@query
def dq_accepted_values(i: Inputs) -> DataFrame:
    return quality.check_model(
        "raw_matches", i.raw_matches, quality.accepted_values("status", ["FINISHED", "SCHEDULED"])
    )


@query
def dq_ranges(i: Inputs) -> DataFrame:
    rates = quality.check_model("mart_bottler_index", i.bottlers, quality.between("drop_rate_pct", 0, 60))
    goals = quality.check_model("mart_match_results", i.matches, quality.at_least("home_goals", 1))
    teams = i.matches.withColumn("season_id", F.col("home_team_id"))
    return (
        rates.unionByName(goals)
        .unionByName(quality.check_one_season("mart_match_results", i.matches))
        .unionByName(quality.check_one_season("matches_by_team", teams))
    )


@query
def dq_report(i: Inputs) -> DataFrame:
    return quality.run_all(
        {
            "stg_competitions": i.stg_competitions, "stg_teams": i.stg_teams, "stg_matches": i.stg_matches,
            "stg_standings": i.stg_standings, "int_match_results": i.results, "int_team_form": i.team_form,
            "mart_match_results": i.matches, "mart_league_table": i.league_table,
            "mart_bottler_index": i.bottlers,
        }
    )


# -- evaluation ------------------------------------------------------------------------


@query
def eval_checks_sql(i: Inputs) -> DataFrame:
    kind = F.col("event_type")
    answer = F.when(kind == "click", "I don't know, sorry").when(kind == "signup", "").otherwise("42 goals")
    outputs = i.statements().select(
        "event_id", F.col("statement").alias("sql"), (kind != "error").alias("success"), answer.alias("answer")
    )
    checked = evaluation.check_sql_answers(outputs)
    return checked.select("event_id", F.array_join("failures", " | ").alias("failures"))


@query
def eval_checks_anomaly(i: Inputs) -> DataFrame:
    kind = F.col("event_type")
    every = ["is_anomalous", "severity", "anomaly_type", "explanation"]
    keys = F.when(kind == "view", F.array(F.lit("severity"), F.lit("is_anomalous"))).otherwise(
        F.array(*[F.lit(k) for k in every])
    )
    severity = F.when(kind == "click", "extreme").when(kind == "signup", "high").otherwise("none")
    outputs = i.raw.table("events").select(
        "event_id", keys.alias("keys"), severity.alias("severity"),
        F.repeat("props", F.length("event_type") - 3).alias("explanation"),
    )
    checked = evaluation.check_verdicts(outputs)
    return checked.select("event_id", F.array_join("failures", " | ").alias("failures"))


@query
def eval_checks_response(i: Inputs) -> DataFrame:
    checked = evaluation.check_responses(i.responses())
    return checked.select("conv_id", "turn", F.array_join("failures", " | ").alias("failures"))


@query
def eval_golden(i: Inputs) -> DataFrame:
    checked = evaluation.check_golden(i.golden_cases())
    return checked.select("conv_id", "turn", F.array_join("reasons", " | ").alias("reasons"))


register("eval_summary", lambda i: evaluation.summarize(evaluation.check_golden(i.golden_cases())))
register("agg_pass_rate", lambda i: evaluation.summarize(evaluation.check_golden(i.golden_cases())))
register("eval_recommend", lambda i: evaluation.recommend(evaluation.check_golden(i.golden_cases())))
