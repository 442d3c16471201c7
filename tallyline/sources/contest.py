"""Contest tables out of an order-shaped star schema.

An order is a match: the customer's nation is at home, the nation of the order's lowest
supplier key is away, returned lines are home goals, accepted lines away goals, and the
first three line numbers are the first half. Joins carry no hints; Spark broadcasts a side
only when its own size estimate or the runtime statistics allow it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyline.functions.rounding import count_where
from tallyline.functions.season import in_season, season_of_date

HALF_TIME_LINE = 3
# Order status codes by match status; every other code stands for a match in play.
STATUS_CODES = {"FINISHED": "F", "SCHEDULED": "O"}
IN_PLAY = "IN_PLAY"
LOADED_AT = "2001-09-01 00:00:00"  # the dimension tables carry no load time of their own

_schemas: dict[str, StructType] = {}


def has_status(status: str) -> Column:
    """Orders of a match status, said in source codes, so that Parquet can test it."""
    code = F.col("o_orderstatus")
    if status == IN_PLAY:
        return code.isNull() | ~code.isin(*STATUS_CODES.values())
    return code == STATUS_CODES[status] if status in STATUS_CODES else F.lit(False)


def match_status() -> Column:
    code = F.col("o_orderstatus")
    return F.coalesce(*[F.when(code == c, status) for status, c in STATUS_CODES.items()], F.lit(IN_PLAY))


class ContestTables:
    """Raw contest tables over one directory of Parquet files."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory.rstrip("/")

    def table(self, name: str) -> DataFrame:
        """A table by name. Its schema is read from the file footers once per process."""
        path = f"{self.directory}/{name}.parquet"
        if path not in _schemas:
            _schemas[path] = self.spark.read.parquet(path).schema
        return self.spark.read.schema(_schemas[path]).parquet(path)

    def competitions(self) -> DataFrame:
        return self.table("region").select(
            F.col("r_regionkey").cast("bigint").alias("id"),
            F.col("r_name").alias("name"),
            F.concat(F.lit("R"), F.col("r_regionkey")).alias("code"),
            F.lit("LEAGUE").alias("type"),
            F.col("r_name").alias("area_name"),
            F.lit("TIER_ONE").alias("plan"),
            F.lit(LOADED_AT).cast("timestamp_ntz").alias("ingested_at"),
        )

    def teams(self) -> DataFrame:
        nations, regions = self.table("nation"), self.table("region")
        return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
            F.col("n_nationkey").cast("bigint").alias("id"),
            F.col("n_name").alias("name"),
            F.concat(F.lit("N"), F.col("n_nationkey")).alias("short_name"),
            F.upper(F.right("n_name", F.lit(3))).alias("tla"),
            F.col("n_regionkey").cast("bigint").alias("competition_id"),
            F.col("r_name").alias("area_name"),
            F.lit(LOADED_AT).cast("timestamp_ntz").alias("ingested_at"),
        )

    def matches(self, status: str | None = None, season: int | None = None) -> DataFrame:
        """All matches, or those of a status or of the season that starts in a year.

        Both are tested on the orders as they are read. A season is a small part of all matches,
        so its order keys also go before the aggregate of the lines: lines of other seasons are
        neither counted nor, where Spark broadcasts the keys, shuffled. For a status alone the
        lines are counted first, since half of them would stay and a task counts most orders whole.
        """
        orders, lines = self.table("orders"), self.table("lineitem")
        if status is not None:
            orders = orders.filter(has_status(status))
        if season is not None:
            orders = orders.filter(in_season(F.col("o_orderdate"), season))
            keys = orders.select(F.col("o_orderkey").alias("l_orderkey"))
            lines = lines.join(keys, "l_orderkey", "left_semi")
        returned, accepted = F.col("l_returnflag") == "R", F.col("l_returnflag") == "A"
        first_half = F.col("l_linenumber") <= HALF_TIME_LINE
        scores = lines.groupBy("l_orderkey").agg(
            F.min("l_suppkey").alias("away_key"),
            count_where(returned).cast("int").alias("home_full"),
            count_where(accepted).cast("int").alias("away_full"),
            count_where(returned & first_half).cast("int").alias("home_half"),
            count_where(accepted & first_half).cast("int").alias("away_half"),
        )
        # The facts stay on the left and every dimension is joined by itself: the size of a plain
        # scan is known, so Spark broadcasts the small ones, where a join of two dimensions
        # would count as their product.
        nations = self.table("nation")
        home = nations.select(
            F.col("n_nationkey").alias("home_key"),
            F.col("n_nationkey").cast("bigint").alias("home_team_id"),
            F.col("n_name").alias("home_team_name"),
            F.col("n_regionkey").cast("bigint").alias("competition_id"),
        )
        away = nations.select(
            F.col("n_nationkey").alias("visitor_key"),
            F.col("n_nationkey").cast("bigint").alias("away_team_id"),
            F.col("n_name").alias("away_team_name"),
        )
        played = (
            orders.join(scores, F.col("o_orderkey") == F.col("l_orderkey"))
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(self.table("supplier"), F.col("away_key") == F.col("s_suppkey"))
            .filter(F.col("c_nationkey") != F.col("s_nationkey"))
            .join(home, F.col("c_nationkey") == F.col("home_key"))
            .join(away, F.col("s_nationkey") == F.col("visitor_key"))
        )
        start = season_of_date(F.to_date("o_orderdate"))
        opening = F.make_date(start, F.lit(7), F.lit(1))
        return played.select(
            F.col("o_orderkey").alias("id"),
            "competition_id",
            (F.col("competition_id") * 10000 + start).alias("season_id"),
            F.col("o_orderdate").alias("utc_date"),
            match_status().alias("status"),
            (F.floor(F.datediff(F.to_date("o_orderdate"), opening) / 7) + 1).cast("int").alias("matchday"),
            "home_team_id", "home_team_name", "away_team_id", "away_team_name",
            F.col("home_full").alias("home_score_full_time"),
            F.col("away_full").alias("away_score_full_time"),
            F.col("home_half").alias("home_score_half_time"),
            F.col("away_half").alias("away_score_half_time"),
            F.when(F.col("home_full") > F.col("away_full"), "HOME_TEAM")
            .when(F.col("away_full") > F.col("home_full"), "AWAY_TEAM")
            .otherwise("DRAW")
            .alias("winner"),
            F.col("o_orderdate").alias("ingested_at"),
        )

    def reports(self) -> DataFrame:
        """Documents as stored reports; the id of a document is also its match id."""
        return self.table("documents").select(
            F.col("doc_id").alias("id"), F.col("doc_id").alias("match_id"), F.col("text").alias("narrative")
        )

    def vectors(self) -> DataFrame:
        return self.table("embeddings").select(
            F.col("vec_id").alias("report_id"), F.lit(0).alias("chunk_index"), "embedding"
        )
