"""A session for one machine. On a cluster, use the session the cluster gives."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str, cores: int | None = None, **settings: str) -> SparkSession:
    """``settings`` are Spark settings with ``__`` for the dots."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        # Small tables: keep their few megabytes spread over the cores after a shuffle.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        # Without the Python call site of every column, plans are built much faster.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
