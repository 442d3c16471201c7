"""Append-only log of ingestion runs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

from tallyline.schemas import RUN_LOG


class Counts(NamedTuple):
    """What a step took in: rows, different keys, and records it could not use."""

    rows: int = 0
    keys: int = 0
    rejected: int = 0


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


class RunLog:
    def __init__(self, spark: SparkSession, path: str, job: str = "manual"):
        self.spark = spark
        self.path = path
        self.job = job

    def run(self, task: str, entity: str, step: Callable[[], Counts]) -> None:
        """Run a step and log how it went, also when it fails."""
        started, counts, error = _now(), Counts(), None
        try:
            counts = step()
        except Exception as problem:
            error = str(problem)
            raise
        finally:
            entry = (
                self.job, task, entity, *counts,
                "success" if error is None else "failure", error, started, _now(),
            )
            line = self.spark.createDataFrame([entry], RUN_LOG)
            line.coalesce(1).write.mode("append").parquet(self.path)

    def entries(self) -> DataFrame:
        return self.spark.read.schema(RUN_LOG).parquet(self.path)
