"""League-relative outliers among the teams of a competition season.

Moments are sums of integer hundredths, so they are exact whatever the order of the rows.
The verdict is a rule on z-scores: the largest one names the metric.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.rounding import count_where
from tallyline.operators import filters as on
from tallyline.operators.ranking import with_group_values

GROUPS = ("competition_code", "season_id")

# The words a verdict may use.
SEVERITIES = ("low", "medium", "high", "none")
THRESHOLDS = (("high", 2.5), ("medium", 2.0), ("low", 1.5))

METRICS = {"points_per_game": "ppg", "goals_per_game": "goals", "conceded_per_game": "conceded"}


def _hundredths(name: str) -> Column:
    return F.round(F.col(name) * 100).cast("bigint")


def _moments() -> list[Column]:
    columns = [F.count("*").alias("_n")]
    for metric, short in METRICS.items():
        value = _hundredths(metric)
        columns += [F.sum(value).alias(f"_s_{short}"), F.sum(value * value).alias(f"_q_{short}")]
    return columns


def _mean(short: str) -> Column:
    return F.col(f"_s_{short}").cast("double") / (F.col("_n") * 100).cast("double")


def _stddev(short: str) -> Column:
    n, total, squares = F.col("_n"), F.col(f"_s_{short}"), F.col(f"_q_{short}")
    pairs = F.nullif(n * (n - 1), F.lit(0).cast("bigint"))
    return F.sqrt((n * squares - total * total).cast("double") / pairs.cast("double")) / 100.0


def league_features(table: DataFrame, competition_code: str | None = None) -> DataFrame:
    """League mean and sample deviation beside every team's own ratios."""
    mine = table.filter(on.equals("competition_code", competition_code))
    beside = with_group_values(mine, GROUPS, *_moments())
    return beside.select(
        "team_name", *GROUPS, "competition_name", "played_games", "points", "points_per_game",
        "win_percentage", "goals_per_game", "conceded_per_game", "goal_difference",
        _mean("ppg").alias("league_avg_ppg"),
        _mean("goals").alias("league_avg_goals"),
        _mean("conceded").alias("league_avg_conceded"),
        _stddev("ppg").alias("stddev_ppg"),
        _stddev("goals").alias("stddev_goals"),
        _stddev("conceded").alias("stddev_conceded"),
    )


def league_flags(features: DataFrame) -> DataFrame:
    def z(metric: str) -> Column:
        short = METRICS[metric]
        spread = F.nullif(F.col(f"stddev_{short}"), F.lit(0.0))
        return F.coalesce((F.col(metric) - F.col(f"league_avg_{short}")) / spread, F.lit(0.0))

    scored = features.withColumns({f"z_{short}": z(metric) for metric, short in METRICS.items()})
    size = {short: F.abs(F.col(f"z_{short}")) for short in METRICS.values()}
    largest = F.greatest(*size.values())
    by_metric = [(metric, short, size[short] == largest) for metric, short in METRICS.items()]

    def pick(of) -> Column:
        (m1, s1, c1), (m2, s2, c2), (m3, s3, _) = by_metric
        return F.when(c1, of(m1, s1)).when(c2, of(m2, s2)).otherwise(of(m3, s3))

    severity = F.lit(None)
    for i, (word, least) in enumerate(THRESHOLDS):
        severity = F.when(largest >= least, word) if i == 0 else severity.when(largest >= least, word)
    severity = severity.otherwise("none")
    direction = (
        F.when(F.col("key_metric") == "goals_per_game", "attacking_outlier")
        .when(F.col("key_metric") == "conceded_per_game", "defensive_outlier")
        .when(F.col("z_ppg") > 0, "overperforming")
        .otherwise("underperforming")
    )

    def two_places(value: Column) -> Column:
        return F.round(value.cast("decimal(18,6)"), 2).cast("string")

    judged = scored.withColumns(
        {
            "key_metric": pick(lambda m, s: F.lit(m)),
            "severity": severity,
            "_value": pick(lambda m, s: F.col(m)),
            "_mean": pick(lambda m, s: F.col(f"league_avg_{s}")),
        }
    )
    anomalous = F.col("severity") != "none"
    return judged.select(
        "team_name", *GROUPS, "points", "points_per_game", "z_ppg", "z_goals", "z_conceded",
        anomalous.alias("is_anomalous"),
        F.when(anomalous, direction).otherwise("none").alias("anomaly_type"),
        "severity", "key_metric",
        F.concat(
            F.col("team_name"), F.lit(": "), F.replace(F.col("key_metric"), F.lit("_"), F.lit(" ")),
            F.lit(" of "), two_places(F.col("_value")), F.lit(" against a league average of "),
            two_places(F.col("_mean")), F.lit(" (severity "), F.col("severity"), F.lit(")."),
        ).alias("explanation"),
    )


# The labels of the prompt, which its reader expects.


def prompts(features: DataFrame, preface: str = "") -> DataFrame:
    """A team's ratios beside its league's as text, for a reviewer outside this job."""

    def line(label: str, name: str, places: int | None = None) -> list[Column]:
        value = F.col(name) if places is None else F.round(F.col(name).cast("decimal(18,6)"), places)
        return [F.lit(label), F.coalesce(value.cast("string"), F.lit("None"))]

    text = F.concat(
        *line(f"{preface}Team: ", "team_name"),
        *line("\nCompetition: ", "competition_name"),
        *line("\nGames played: ", "played_games"),
        *line("\n\nTeam stats:\n- Points per game: ", "points_per_game", 2),
        *line("\n- Win percentage: ", "win_percentage", 1),
        *line("%\n- Goals per game: ", "goals_per_game", 2),
        *line("\n- Conceded per game: ", "conceded_per_game", 2),
        *line("\n- Goal difference: ", "goal_difference"),
        *line("\n\nLeague averages:\n- Avg points per game: ", "league_avg_ppg", 2),
        *line("\n- Avg goals per game: ", "league_avg_goals", 2),
        *line("\n- Avg conceded per game: ", "league_avg_conceded", 2),
        *line("\n- Std deviation PPG: ", "stddev_ppg", 2),
    )
    return features.select("team_name", *GROUPS, text.alias("prompt"))


def anomaly_summary(flags: DataFrame) -> DataFrame:
    return flags.groupBy("competition_code").agg(
        F.count("*").alias("teams_analysed"), count_where(F.col("is_anomalous")).alias("teams_flagged")
    )
