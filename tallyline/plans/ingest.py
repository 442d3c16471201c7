"""One ingestion run: every feed into its keyed table, one log line each."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from tallyline import schemas as S
from tallyline.sinks.keyed_table import BATCH, KeyedTable
from tallyline.sinks.run_log import Counts, RunLog
from tallyline.sources import documents
from tallyline.sources.landing import Window, scan_window


@dataclass(frozen=True)
class Feed:
    spec: S.TableSpec
    order: tuple[str, ...]  # which row of a key counts as the last one


# In the order of a run.
FEEDS = {
    "competitions": Feed(S.COMPETITIONS, ("id", "raw_payload")),
    "teams": Feed(S.TEAMS, ("competition_id", "raw_payload")),
    "matches": Feed(S.MATCHES, ("utc_date", "raw_payload")),
    "standings": Feed(S.STANDINGS, ("table_no", "row_no", "raw_payload")),
    "players": Feed(S.PLAYERS, ("team_id", "raw_payload")),
}


def landed(spark: SparkSession, landing: str) -> dict[str, DataFrame]:
    """The documents of every feed, one folder per feed."""
    return {entity: documents.read_landing(spark, f"{landing.rstrip('/')}/{entity}") for entity in FEEDS}


def tables(spark: SparkSession, root: str) -> dict[str, KeyedTable]:
    return {entity: KeyedTable(spark, f"{root.rstrip('/')}/{entity}", feed.spec) for entity, feed in FEEDS.items()}


def ingest(docs: dict[str, DataFrame], root: str, batch_id: int, window: Window | None = None) -> RunLog:
    """Upsert the given feeds as one batch. ``window`` limits which matches are taken.

    Every feed is read once: unusable records are counted on the way to the table, and only if there
    are any, they are read again and kept below ``rejected/<feed>``.
    """
    spark = next(iter(docs.values())).sparkSession
    root = root.rstrip("/")
    log = RunLog(spark, f"{root}/ingestion_log")
    stored = tables(spark, root)
    for entity, feed in FEEDS.items():
        if entity not in docs:
            continue

        def step(entity: str = entity, feed: Feed = feed) -> Counts:
            read = documents.classified_feed(entity, docs[entity])
            counted, rejects = documents.counting_rejects(read)
            rows = documents.rows_of_feed(entity, counted)
            if entity == "matches" and window is not None:
                rows = scan_window(rows, window)
            n_rows, n_keys = stored[entity].upsert(rows, batch_id, feed.order)
            n_rejected = rejects.get["rejected"]
            if n_rejected:
                path = f"{root}/rejected/{entity}/{BATCH}={int(batch_id)}"
                documents.rejected_records(read).write.mode("overwrite").parquet(path)
            return Counts(n_rows, n_keys, n_rejected)

        log.run(f"ingest_{entity}", entity, step)
    return log


def rejected(spark: SparkSession, root: str, entity: str) -> DataFrame:
    """The records of a feed that no batch could use: level, record, version."""
    schema = "level string, record string, version long"
    try:
        return spark.read.schema(schema).parquet(f"{root.rstrip('/')}/rejected/{entity}")
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise
