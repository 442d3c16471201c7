"""Stored reports: what is missing, chunking, retrieval and context."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions.text import CHUNK_SIZE, CONTEXT_HEADING, context_entry, match_prompt, text_chunks
from tallyline.operators import filters as on
from tallyline.operators.vector_search import LIMIT, MIN_SIMILARITY, top_chunks

TOKENS_PER_REPORT = 500
USD_PER_MILLION_TOKENS = 0.80 + 4.00

BACKLOG_COLUMNS = (
    "match_id", "match_date", "matchday", "competition_code", "competition_name",
    "home_team_name", "away_team_name", "home_goals", "away_goals", "home_goals_ht",
    "away_goals_ht", "total_goals", "result", "ht_leader", "is_ht_lead_dropped", "is_high_scoring",
)


def match_reports(stored: DataFrame, matches: DataFrame) -> DataFrame:
    """Stored narratives with the facts of their match, where the match is known."""
    facts = matches.select(
        "match_id", "competition_code",
        F.col("home_team_name").alias("home_team"), F.col("away_team_name").alias("away_team"),
        "match_date", "matchday",
    )
    return stored.join(facts, "match_id", "left").select(
        "id", "match_id", "competition_code", "home_team", "away_team", "match_date", "matchday", "narrative"
    )


def narrative_backlog(matches: DataFrame, stored: DataFrame, competitions: Iterable[str] | None = None) -> DataFrame:
    """Finished matches without a report, oldest first."""
    known = stored.filter(F.col("match_id").isNotNull()).select("match_id")
    wanted = on.everything() if competitions is None else on.one_of("competition_code", competitions)
    open_matches = matches.filter(wanted).join(known, "match_id", "left_anti")
    return open_matches.select(*BACKLOG_COLUMNS).orderBy("match_date", "match_id")


def backlog_cost(backlog: DataFrame) -> DataFrame:
    counted = backlog.agg(F.count("*").alias("matches"))
    tokens = F.col("matches") * TOKENS_PER_REPORT
    return counted.withColumn("estimated_usd", tokens * F.lit(USD_PER_MILLION_TOKENS) / 1_000_000)


def embedding_backlog(stored: DataFrame, chunks: DataFrame) -> DataFrame:
    """Reports that have no chunk yet."""
    done = chunks.select(F.col("report_id").alias("id"))
    return stored.select("id").join(done, "id", "left_anti").orderBy("id")


def distinct_union(first: DataFrame, second: DataFrame) -> DataFrame:
    return first.select("id").union(second.select("id")).distinct()


def chunk_reports(stored: DataFrame, size: int = CHUNK_SIZE) -> DataFrame:
    """One row per chunk of every report."""
    return stored.select(
        F.col("id").alias("report_id"),
        F.posexplode(text_chunks(F.col("narrative"), size)).alias("chunk_index", "chunk_text"),
    )


def prompts(matches: DataFrame, preface: str = "") -> DataFrame:
    return matches.select("match_id", match_prompt(preface).alias("prompt"))


def known_chunks(chunks: DataFrame, reports: DataFrame) -> DataFrame:
    """Chunks whose report exists. Only ids are read, and the facts joined to the reports are not."""
    ids = reports.select(F.col("id").alias("report_id")).distinct()
    return chunks.join(ids, "report_id", "left_semi")


def report_search(
    chunks: DataFrame,
    reports: DataFrame,
    queries: DataFrame,
    limit: int = LIMIT,
    min_similarity: float = MIN_SIMILARITY,
) -> DataFrame:
    """Best chunks of existing reports for each query vector, with the facts of their match.

    The search reads only keys and vectors; facts and texts are joined to the hits. The text is
    ``chunk_text`` if the chunks carry it, else it is cut out of the narrative of the hit again,
    NULL where the report has no such chunk.
    """
    found = top_chunks(known_chunks(chunks, reports), queries, limit, min_similarity)
    facts = reports.withColumnRenamed("id", "report_id")
    found = found.join(facts, "report_id")
    if "chunk_text" in chunks.columns:
        found = found.join(chunks.select("report_id", "chunk_index", "chunk_text"), ["report_id", "chunk_index"], "left")
    else:
        found = found.withColumn("chunk_text", F.get(text_chunks(F.col("narrative")), F.col("chunk_index")))
    return found.select(
        "query_id", "report_id", "chunk_index", "chunk_text", "home_team", "away_team",
        "match_date", "competition_code", "matchday", "similarity",
    )


def context_blocks(found: DataFrame) -> DataFrame:
    """The retrieved chunks of each query as one text, best first.

    A query has at most its search limit of chunks, so the collected list is short.
    """
    best_first = Window.partitionBy("query_id").orderBy(
        F.desc("similarity"), F.asc("report_id"), F.asc("chunk_index")
    )
    entries = found.select(
        "query_id", F.row_number().over(best_first).alias("nth"), context_entry().alias("entry")
    )
    ordered = F.array_sort(F.collect_list(F.struct("nth", "entry")))
    blocks = entries.groupBy("query_id").agg(ordered.alias("_entries"))
    return blocks.select(
        "query_id", F.concat(F.lit(CONTEXT_HEADING), F.array_join("_entries.entry", "")).alias("context")
    )
