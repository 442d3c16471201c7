"""Materialisation of the model layers: views for staging, Parquet tables for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

STAGING, INTERMEDIATE, MARTS = "staging", "intermediate", "marts"


def as_view(frame: DataFrame, layer: str, name: str) -> str:
    view = f"{layer}_{name}"
    frame.createOrReplaceTempView(view)
    return view


def as_table(
    frame: DataFrame,
    root: str,
    layer: str,
    name: str,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Overwrite one table of a layer and read it back.

    With ``partition_by`` the rows are first gathered by those columns, so that a partition
    gets few files; rebalancing splits a partition value that is too large for one task.
    ``sort_by`` orders the rows of each file, so that a range filter skips row groups.
    """
    path = f"{root.rstrip('/')}/{layer}/{name}"
    rows = frame.hint("rebalance", *partition_by) if partition_by else frame
    if sort_by:
        rows = rows.sortWithinPartitions(*partition_by, *sort_by)
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path).select(*frame.columns)


def publish(spark: SparkSession, frames: dict[str, DataFrame], root: str, layer: str = MARTS) -> None:
    """Write frames and register them as ``<layer>.<name>`` for SQL statements."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {layer} LOCATION '{root.rstrip('/')}/{layer}'")
    for name, frame in frames.items():
        as_table(frame, root, layer, name)
        columns = ", ".join(f"`{c}`" for c in frame.columns)
        path = f"{root.rstrip('/')}/{layer}/{name}"
        spark.sql(f"CREATE OR REPLACE VIEW {layer}.{name} AS SELECT {columns} FROM parquet.`{path}`")
