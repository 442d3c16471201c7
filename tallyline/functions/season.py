"""Season arithmetic. Season Y runs from the first of the cut month in Y, half open."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.text import strip

CUT_MONTH = 7

# The phrases a caller may use instead of a year.
CURRENT_PHRASES = ("this season", "current season", "current", "this year")
PREVIOUS_PHRASES = ("last season", "previous season")
NEXT_PHRASES = ("next season",)

Day = Column | dt.date | None


def as_day(day: Day) -> Column:
    if day is None:
        return F.current_date()
    return F.lit(day) if isinstance(day, dt.date) else day


def season_of_date(day: Day, cut_month: int = CUT_MONTH) -> Column:
    day = as_day(day)
    return F.year(day) - (F.month(day) < cut_month).cast("int")


def season_label(start: Column) -> Column:
    """2024 -> '2024/25'."""
    return F.concat(start.cast("string"), F.lit("/"), F.right((start + 1).cast("string"), F.lit(2)))


def season_bounds(start: int, cut_month: int = CUT_MONTH) -> tuple[dt.date, dt.date]:
    return dt.date(start, cut_month, 1), dt.date(start + 1, cut_month, 1)


def in_season(day: Column, start: int, cut_month: int = CUT_MONTH) -> Column:
    first, after = season_bounds(start, cut_month)
    return (day >= F.lit(first)) & (day < F.lit(after))


def parse_season(phrase: Column, today: Day = None) -> Column:
    """Start year named by a phrase; anything not understood means the current season."""
    current = season_of_date(today)
    ref = F.lower(strip(phrase))
    ago = _leading_number(ref, r"^(\d+)\s+seasons?\s+ago")
    span = _leading_number(ref, r"^(\d{4})[/-]\d{2,4}")
    year = _leading_number(ref, r"^(\d{4})")
    return (
        F.when(ref.isin(*CURRENT_PHRASES), current)
        .when(ref.isin(*PREVIOUS_PHRASES), current - 1)
        .when(ref.isin(*NEXT_PHRASES), current + 1)
        .when(ago.isNotNull(), current - ago)
        .otherwise(F.coalesce(span, year, current))
    )


def _leading_number(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).try_cast("int")
