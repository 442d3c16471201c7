"""Table scans: Parquet by default, a partitioned JDBC read where the raw tables are remote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallyline.schemas import TableSpec

ROWS_PER_FETCH = 10_000


def read_table(spark: SparkSession, root: str, spec: TableSpec) -> DataFrame:
    return spark.read.schema(spec.schema).parquet(f"{root.rstrip('/')}/{spec.name}")


def jdbc_options(
    url: str, table: str, key: str, lower: int, upper: int, partitions: int, **extra: str
) -> dict[str, str]:
    """Options of a read that is split on a numeric key; every row falls in some split."""
    if partitions < 1 or lower >= upper:
        raise ValueError("need at least one partition and lower < upper")
    return {
        "url": url,
        "dbtable": table,
        "partitionColumn": key,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(ROWS_PER_FETCH),
        "pushDownPredicate": "true",
        **extra,
    }


def read_database(spark: SparkSession, url: str, table: str, key: str, partitions: int, **extra: str) -> DataFrame:
    """A remote table in ``partitions`` parallel slices; filters are pushed to the database.

    The bounds come from one aggregate the database computes itself.
    """
    bounds_query = f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) AS bounds"
    bounds = spark.read.format("jdbc").options(url=url, dbtable=bounds_query, **extra).load().first()
    if bounds is None or bounds["lo"] is None:
        return spark.read.format("jdbc").options(url=url, dbtable=table, **extra).load()
    options = jdbc_options(url, table, key, int(bounds["lo"]), int(bounds["hi"]) + 1, partitions, **extra)
    return spark.read.format("jdbc").options(**options).load()
