"""Dense grids of days, offices and lines of business."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatlens.functions.days import date_key, days_between
from seatlens.session import task_slots


# Grid rows one task should at least and at most produce.
_FEW_ROWS = 20_000
_MANY_ROWS = 2_000_000


@dataclass(frozen=True)
class Window:
    """The days a grid covers; without any, its bounds are None.

    The numbers of offices and businesses are estimates that only decide how
    many tasks make the grid.
    """

    coverage_end: dt.date | None
    first: dt.date | None
    last: dt.date | None
    offices: int = 1
    businesses: int = 1

    @property
    def end(self) -> Column:
        return F.lit(self.coverage_end).cast("date")

    @property
    def grid_start(self) -> Column:
        return F.lit(self.first).cast("date")

    @property
    def grid_end(self) -> Column:
        return F.lit(self.last).cast("date")

    def holds(self, day: Column) -> Column:
        return day.between(self.grid_start, self.grid_end)

    def tasks(self, spark: SparkSession) -> int:
        """Tasks for the grid by day, office and business.

        Adaptive execution cannot choose the number, because it sees the few
        rows before they unfold into the grid.
        """
        days = (self.last - self.first).days + 1 if self.first and self.last else 0
        rows = max(0, days) * self.offices * self.businesses
        return max(1, min(task_slots(spark), rows // _FEW_ROWS), rows // _MANY_ROWS)


def calendar_days(spark: SparkSession, window: Window) -> DataFrame:
    """One row per day of the window."""
    span = days_between(window.grid_start, window.grid_end)
    return spark.range(1).select(F.explode(span).alias("date"))


def office_grid(locations: DataFrame, window: Window) -> DataFrame:
    """Every office on every day of the window.

    Each office row generates its own calendar, so the product needs no join.
    The office days are then dealt out evenly, before the far more numerous rows
    per business unfold from them: few offices don't keep tasks idle.
    """
    span = days_between(window.grid_start, window.grid_end)
    grid = locations.select("location_key", "office_location", F.explode(span).alias("date"))
    spread = grid.repartition(window.tasks(locations.sparkSession), "location_key", "date")
    return spread.withColumn("date_key", date_key(F.col("date")))


def with_lobs(grid: DataFrame, lobs: DataFrame) -> DataFrame:
    """Every grid row for every line of business.

    Keys are dense, so they are generated; names come by an equi-join on the
    key, whose side the optimizer broadcasts only when it is small.
    """
    last_key = F.coalesce(lobs.agg(F.max("lob_key")).scalar(), F.lit(0))
    keys = F.when(last_key > 0, F.sequence(F.lit(1), last_key))
    return grid.withColumn("lob_key", F.explode(keys)).join(lobs, "lob_key")


def fill_counts(grid: DataFrame, counts: DataFrame, keys: Sequence[str], count: str) -> DataFrame:
    """Left join sparse counts onto a dense grid; where there is none, zero."""
    joined = grid.join(counts.select(*keys, count), list(keys), "left")
    return joined.withColumn(count, F.coalesce(count, F.lit(0)))
