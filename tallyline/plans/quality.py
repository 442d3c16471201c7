"""Data-quality rules and the job that runs them: (rule, model, column, n_bad, ok)."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.rounding import count_where
from tallyline.functions.season import season_of_date


@dataclass(frozen=True)
class RowRule:
    """A rule that one row can break."""

    rule: str
    column: str
    broken: Column


def not_null(*columns: str) -> list[RowRule]:
    return [RowRule("not_null", c, F.col(c).isNull()) for c in columns]


def accepted_values(column: str, values: Sequence) -> list[RowRule]:
    return [RowRule("accepted_values", column, ~F.col(column).isin(*values))]


def at_least(column: str, low: float) -> list[RowRule]:
    return [RowRule("range", column, F.col(column) < low)]


def between(column: str, low: float, high: float) -> list[RowRule]:
    return [RowRule("range", column, ~F.col(column).between(low, high))]


def check_model(model: str, frame: DataFrame, rules: Sequence[RowRule] = (), unique: Sequence[str] = ()) -> DataFrame:
    """Every rule of a model in one pass over it.

    With a ``unique`` key the rows are first counted per key, rule breaks included, so the
    uniqueness check and the row rules share the scan and its one shuffle. Rows without a
    complete key do not count as repeated; that is not_null's business.
    """
    breaks = [count_where(r.broken).alias(f"_{n}") for n, r in enumerate(rules)]
    lines = [_line(r.rule, model, r.column, F.col(f"_{n}")) for n, r in enumerate(rules)]
    if not unique:
        counts = frame.agg(*breaks)
    else:
        complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in unique])
        per_key = frame.groupBy(*unique).agg(F.count("*").alias("_rows"), *breaks)
        sums = [F.coalesce(F.sum(f"_{n}"), F.lit(0)).alias(f"_{n}") for n in range(len(rules))]
        counts = per_key.agg(count_where(complete & (F.col("_rows") > 1)).alias("_repeated"), *sums)
        lines.insert(0, _line("unique", model, ",".join(unique), F.col("_repeated")))
    found = counts.select(F.inline(F.array(*lines)))
    return found.withColumn("ok", F.col("n_bad") == 0)


def check_one_season(model: str, frame: DataFrame, day: str = "match_date", season: str = "season_id") -> DataFrame:
    """Season ids, which are opaque, whose dates fall in more than one season."""
    start = season_of_date(F.col(day))
    spans = frame.groupBy(season).agg(F.min(start).alias("_first"), F.max(start).alias("_last"))
    counts = spans.agg(count_where(F.col("_first") < F.col("_last")).alias("_bad"))
    found = counts.select(F.inline(F.array(_line("one_season", model, day, F.col("_bad")))))
    return found.withColumn("ok", F.col("n_bad") == 0)


def _line(rule: str, model: str, column: str, n_bad: Column) -> Column:
    return F.struct(
        F.lit(rule).alias("rule"), F.lit(model).alias("model"), F.lit(column).alias("column_name"),
        n_bad.alias("n_bad"),
    )


# The declared checks: per model its unique key and its row rules.
CHECKS: dict[str, tuple[tuple[str, ...], Callable[[], list[RowRule]]]] = {
    "stg_competitions": (("competition_id",), lambda: not_null("competition_id", "competition_code")),
    "stg_teams": (("team_id",), lambda: not_null("team_id")),
    "stg_matches": (("match_id",), lambda: not_null("match_id") + accepted_values("status", ["FINISHED"])),
    "stg_standings": ((), lambda: not_null("team_id", "points")),
    "int_match_results": (("match_id",), lambda: not_null("match_id")),
    "int_team_form": ((), lambda: not_null("team_id")),
    "mart_match_results": (
        ("match_id",),
        lambda: not_null("match_id") + at_least("home_goals", 0) + at_least("away_goals", 0),
    ),
    "mart_league_table": (("competition_id", "season_id", "team_name"), lambda: not_null("team_name", "points")),
    "mart_bottler_index": ((), lambda: not_null("team_name", "drop_rate_pct") + between("drop_rate_pct", 0, 100)),
}


def run_all(models: dict[str, DataFrame]) -> DataFrame:
    """The declared checks of every model that is given, as one result."""
    reports = [check_model(m, models[m], rules(), key) for m, (key, rules) in CHECKS.items() if m in models]
    if "mart_match_results" in models:
        reports.append(check_one_season("mart_match_results", models["mart_match_results"]))
    return reduce(DataFrame.unionByName, reports)
