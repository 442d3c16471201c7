"""Rolling form kept up to date by a stream of matches.

Rows and summaries of calendar blocks (one team in one competition and month) are stored as they come
out of ``operators.form``. A batch recomputes only the blocks it touches: those of the matches
it brings, and those where the same matches stood before. Form and recency are composed when the
table is read, out of the small summaries, so a corrected result changes later months without
rewriting them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.operators.form import LENGTH, NTH, OWN, TAIL, block_of, carried, composed, in_blocks
from tallyline.operators.ranking import join_on
from tallyline.plans.models import stg_matches, team_sides
from tallyline.schemas import TableSpec
from tallyline.sinks.keyed_table import BATCH, KeyedTable
from tallyline.workspace import stored

BLOCK, WRITTEN = "block", "rows_version"
TEAM = ["team_id", "competition_id"]
KEYS = [*TEAM, BLOCK]

SIDES = T.StructType(
    [
        T.StructField(name, kind)
        for name, kind in (
            ("match_id", T.LongType()), ("match_date", T.DateType()), ("competition_id", T.LongType()),
            ("season_id", T.LongType()), ("team_id", T.LongType()), ("team_name", T.StringType()),
            ("goals_scored", T.IntegerType()), ("goals_conceded", T.IntegerType()),
            ("team_result", T.StringType()), ("points_earned", T.IntegerType()),
        )
    ]
)
ROWS = T.StructType(
    [
        *SIDES.fields, T.StructField(BLOCK, T.DateType()), T.StructField(NTH, T.LongType()),
        T.StructField(OWN, T.LongType()), T.StructField(TAIL, T.ArrayType(T.IntegerType())), T.StructField(BATCH, T.LongType()),
    ]
)
SUMMARIES = TableSpec(
    "form_blocks",
    T.StructType(
        [
            T.StructField("team_id", T.LongType()), T.StructField("competition_id", T.LongType()),
            T.StructField(BLOCK, T.DateType()), T.StructField(LENGTH, T.LongType()),
            T.StructField(TAIL, T.ArrayType(T.IntegerType())), T.StructField(WRITTEN, T.LongType()),
        ]
    ),
    tuple(KEYS),
)


class FormTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.summaries = KeyedTable(spark, f"{self.path}/blocks", SUMMARIES)

    def _rows(self) -> DataFrame:
        """The rows of every block as its newest version wrote them."""
        if not self.summaries._versions():
            return self.spark.createDataFrame([], ROWS)
        newest = self.summaries.current().filter(F.col(LENGTH) > 0).select(*KEYS, F.col(WRITTEN).alias(BATCH))
        written = self.spark.read.schema(ROWS).parquet(f"{self.path}/rows")
        return join_on(written, newest, [*KEYS, BATCH], "left_semi")

    def update(self, batch: DataFrame, matches: DataFrame, version: int) -> None:
        """Take in a batch of matches (``id``); ``matches`` are all stored ones, the batch included."""
        ids = batch.select(F.col("id").alias("match_id")).distinct()
        now = _sides(matches.join(ids.withColumnRenamed("match_id", "id"), "id", "left_semi")).select(*KEYS)
        before = self._rows().join(ids, "match_id", "left_semi").select(*KEYS)
        touched = stored(now.unionByName(before).distinct(), "form-touched")
        first, last = touched.agg(F.min(BLOCK), F.add_months(F.max(BLOCK), 1)).first()
        if first is None:
            return
        # Two bounds that reach the scan; the join then leaves only the touched blocks.
        moment = F.col("utc_date")
        span = matches.filter((moment >= F.lit(first).cast("timestamp_ntz")) & (moment < F.lit(last).cast("timestamp_ntz")))
        local = in_blocks(join_on(_sides(span), touched, KEYS, "left_semi"), KEYS)
        rows = local.withColumn(TAIL, F.when(F.col("_last"), F.col("_points")))
        folder = f"{self.path}/rows/{BATCH}={int(version)}"
        rows.select(*ROWS.names[:-1]).write.mode("overwrite").parquet(folder)
        ends = self.spark.read.schema(T.StructType(ROWS.fields[:-1])).parquet(folder).filter(F.col(TAIL).isNotNull())
        summary = join_on(touched, ends.select(*KEYS, F.col(NTH).alias(LENGTH), TAIL), KEYS, "left")
        # A block that lost its last match stays as an empty one.
        summary = summary.withColumns({LENGTH: F.coalesce(LENGTH, F.lit(0)), WRITTEN: F.lit(int(version))})
        self.summaries.upsert(summary, version, [WRITTEN])

    def current(self) -> DataFrame:
        """Every side of every match with its form and recency."""
        rows = self._rows()
        placed = carried(self.summaries.current().filter(F.col(LENGTH) > 0).drop(WRITTEN), TEAM, F.col(BLOCK))
        return composed(join_on(rows, placed, KEYS), SIDES.names)


def _sides(raw: DataFrame) -> DataFrame:
    return team_sides(stg_matches(raw)).withColumn(BLOCK, block_of(F.col("match_date")))
