"""Durable scratch space.

Everything written between two steps goes to the shared folder the cluster names in
``spark.checkpoint.dir``, so it outlives any executor. Only a local session without that
setting gets a folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The checkpoint folder of the session; created only for local sessions that lack one."""
    context = spark.sparkContext
    configured = spark.conf.get(SETTING, None) or context.getConf().get(SETTING, None)
    active = context.getCheckpointDir()
    if configured:
        if active is None:
            context.setCheckpointDir(configured)
        return configured
    if active is None:
        if not context.master.startswith("local"):
            raise RuntimeError(f"set {SETTING} to a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyline-"))
        active = context.getCheckpointDir()
    return active


def fresh_dir(spark: SparkSession, label: str) -> str:
    """A path nobody has written to yet, below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/tallyline/{label}-{uuid.uuid4().hex}"


def pinned(frame: DataFrame) -> DataFrame:
    """Evaluate once and cut the lineage, reliably: later uses all see the same rows."""
    shared_root(frame.sparkSession)
    return frame.checkpoint(eager=True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Whatever is written within leaves no shuffle files behind, instead of keeping them until the driver's next collection."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def stored(frame: DataFrame, label: str, compression: str = "snappy") -> DataFrame:
    """Write ``frame`` below the shared folder and read it back: cut lineage that outlives executors."""
    path = fresh_dir(frame.sparkSession, label)
    frame.write.parquet(path, compression=compression)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
