"""Which part of the feed a run reads."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.season import in_season

OVERLAP_DAYS = 15
LOADER_CUT_MONTH = 8  # the loader's season begins in August, the queries' in July


def loader_season(today: dt.date) -> int:
    return today.year if today.month >= LOADER_CUT_MONTH else today.year - 1


@dataclass(frozen=True)
class Window:
    """Bounds of one run; None leaves a bound open."""

    date_from: dt.date | None = None
    date_to: dt.date | None = None
    seasons: tuple[int, ...] | None = None
    status: str | None = None

    @classmethod
    def incremental(cls, today: dt.date) -> "Window":
        return cls(date_from=today - dt.timedelta(days=OVERLAP_DAYS))

    @classmethod
    def full(cls, today: dt.date) -> "Window":
        current = loader_season(today)
        return cls(seasons=(current - 1, current))

    @classmethod
    def of_seasons(cls, seasons: Sequence[int]) -> "Window":
        return cls(seasons=tuple(seasons))

    def condition(self, moment: Column, status: Column) -> Column:
        """Bounds as comparisons with the timestamp itself, so they reach the scan."""
        keep = F.lit(True)
        if self.date_from is not None:
            keep = keep & (moment >= _midnight(self.date_from))
        if self.date_to is not None:
            keep = keep & (moment < _midnight(self.date_to + dt.timedelta(days=1)))
        if self.seasons is not None:
            in_any = F.lit(False)
            for start in self.seasons:
                in_any = in_any | in_season(moment, start)
            keep = keep & in_any
        if self.status is not None:
            keep = keep & (status == self.status)
        return keep


def _midnight(day: dt.date) -> Column:
    return F.lit(day).cast("timestamp_ntz")


def scan_window(raw_matches: DataFrame, window: Window) -> DataFrame:
    return raw_matches.filter(window.condition(F.col("utc_date"), F.col("status")))
