"""The daily feed as a stream of landed files.

Results change after kick-off, and every run reads the last fifteen days again, so the same
match arrives many times. Identical repeats are dropped inside that horizon; anything that
differs goes to the keyed table, where the later version replaces the earlier one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tallyline import schemas as S
from tallyline.operators.latest import last_by_key
from tallyline.sinks.keyed_table import BATCH, KeyedTable
from tallyline.sources import documents

HORIZON = "15 days"
MAX_FILES_PER_TRIGGER = 10_000

LINES = T.StructType([T.StructField("value", T.StringType())])


def landing_stream(spark: SparkSession, path: str, max_files: int = MAX_FILES_PER_TRIGGER) -> DataFrame:
    """New files of the landing folder; rows remember when their file was written."""
    lines = spark.readStream.schema(LINES).option("maxFilesPerTrigger", max_files).text(path)
    return lines.select("value", F.col("_metadata.file_modification_time").alias("landed_at"),
                        F.col("_metadata.file_name").alias("landed_file"))


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id of the stream that owns a checkpoint; a new checkpoint is a new stream."""
    line = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").first()[0]
    return json.loads(line)["id"]


def ingest_matches(
    docs: DataFrame,
    table: KeyedTable,
    checkpoint: str,
    quarantine: str | None = None,
    after: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Start the upsert of a stream of match documents; the caller awaits the query.

    ``foreachBatch`` may replay a batch after a failure; its version names the folders it writes,
    so a replay leaves the table as it was. Records that cannot be read go to the
    ``quarantine`` folder, if one is given; they are counted while the rows are written, and a batch
    without any is not read again. ``after`` is called with each batch as it was written and its version.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        version = table.stream_version(stream_id(batch.sparkSession, checkpoint), batch_id)
        read = documents.classified_feed("matches", batch, "landed_at", "landed_file")
        counted, rejected = documents.counting_rejects(read)
        rows = documents.rows_of_feed("matches", counted, "landed_at", "landed_file")
        table.upsert(rows, version, ("landed_at", "landed_file", "utc_date", "raw_payload"))
        if quarantine is not None and rejected.get["rejected"]:
            bad = documents.rejected_records(read)
            bad.write.mode("overwrite").parquet(f"{quarantine}/{BATCH}={version}")
        if after is not None:
            after(table.batch(version), version)

    return (
        docs.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def drop_repeats(rows: DataFrame, event_time: str, key: str, payload: str) -> DataFrame:
    """Without identical repeats that arrive within the horizon; corrections pass.

    State holds one hash per version for fifteen days, not the payloads themselves. Rows that
    arrive further behind are not in this stream; ``keep_late`` finds what they bring.
    """
    hashed = rows.withColumn("payload_hash", F.sha2(F.col(payload), 256))
    return hashed.withWatermark(event_time, HORIZON).dropDuplicatesWithinWatermark([key, "payload_hash"])


def keep_late(
    rows: DataFrame,
    event_time: str,
    key: str,
    payload: str,
    seen: str,
    late: str,
    checkpoint: str,
    read: Callable[[DataFrame], DataFrame] | None = None,
    whole: Callable[[DataFrame], DataFrame] | None = None,
) -> StreamingQuery:
    """Start the second sink of ``drop_repeats``: versions that came too late for its state.

    ``seen`` is the table that ``drop_repeats`` fills, with the columns ``key`` and ``payload_hash``.
    Rows further back than the horizon are compared by (key, hash) with it and with ``late``, so repeats
    go and corrections are kept, each once. Run it after the stream that fills ``seen``: what that
    one took is found there, so it does not matter where exactly its watermark stood.

    With ``read``, ``rows`` are documents with ``event_time`` and only those behind the horizon are read
    into rows by it; a batch without any costs no more than looking at its times. ``read`` may leave out columns
    that ``whole`` fills in for the rows that are kept, so that repeats are neither read further nor shuffled whole.
    """
    read, whole = read or (lambda documents: documents), whole or (lambda kept: kept)
    schema = T.StructType([read(rows).schema[key], T.StructField("payload_hash", T.StringType())])
    moment = rows.schema[event_time].dataType

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored = spark.read.schema(T.StructType([*schema.fields, rows.schema[event_time]])).parquet(seen)
        newest = stored.agg(F.max(event_time)).first()[0]
        if newest is None:
            return
        bound = F.lit(newest).cast(moment) - F.expr(f"INTERVAL {HORIZON}")
        late_rows = batch.filter(F.col(event_time) < bound)
        behind = read(late_rows).withColumn("payload_hash", F.sha2(F.col(payload), 256))
        known = stored.select(*schema.names)
        for earlier in _batches(spark, late, schema, batch_id):
            known = known.unionByName(earlier)
        version = [key, "payload_hash"]
        if late_rows.isEmpty():  # nothing to compare: what is stored is not read
            fresh = whole(behind).limit(0)
        else:
            fresh = whole(last_by_key(behind, version, [event_time]).join(known, version, "left_anti"))
        fresh = fresh.select(*[c for c in fresh.columns if c != "payload_hash"], "payload_hash")
        fresh.write.mode("overwrite").parquet(f"{late}/{BATCH}={batch_id}")

    return (
        rows.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _batches(spark: SparkSession, path: str, schema: T.StructType, before: int) -> list[DataFrame]:
    """What earlier batches wrote: one frame, or none."""
    with_batch = T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())])
    try:
        return [spark.read.schema(with_batch).parquet(path).filter(F.col(BATCH) < before).drop(BATCH)]
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return []
        raise


def run_to_table(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Write everything that is available to Parquet and stop.

    State is kept in RocksDB, so it need not fit the heap, unless the session names another store; a checkpoint
    that exists keeps the store it was begun with.
    """
    with _state_on_disk(stream.sparkSession):
        query = (
            stream.writeStream.format("parquet")
            .option("path", path)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
    query.awaitTermination()


STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ON_DISK = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _state_on_disk(spark: SparkSession) -> Iterator[None]:
    """Streams started within keep their state in RocksDB. A stream takes its settings when it is started."""
    if spark.conf.get(STATE_STORE, None) is not None:
        yield
        return
    spark.conf.set(STATE_STORE, ON_DISK)
    try:
        yield
    finally:
        spark.conf.unset(STATE_STORE)


def matches_table(spark: SparkSession, path: str) -> KeyedTable:
    return KeyedTable(spark, path, S.MATCHES)
