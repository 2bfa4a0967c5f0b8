"""Hybrid days: the busiest eligible days of every office and ISO week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seatlens.functions.days import is_weekday, week_start

TOP_DAYS = 3
MIN_WEEKDAYS = 3


def eligible_dates(dates: DataFrame, min_weekdays: int = MIN_WEEKDAYS) -> DataFrame:
    """Flag weekdays whose month owns enough weekdays of their ISO week.

    Only the given dates count, so a week cut off by the data's first or last
    day may have none. Input: any rows with a ``date``; output: one per date.
    """
    days = dates.select("date").distinct().select("date", week_start(F.col("date")).alias("week_start"))
    share = W.partitionBy("week_start", F.month("date"))
    weekdays = F.count_if(is_weekday(F.col("date"))).over(share)
    return days.withColumn("weekdays", weekdays).withColumn(
        "eligible", is_weekday(F.col("date")) & (F.col("weekdays") >= min_weekdays)
    )


def daily_totals(fact: DataFrame) -> DataFrame:
    """Attendance per office and day over whatever finer grain ``fact`` has."""
    return fact.groupBy("office_location", week_start(F.col("date")).alias("week_start"), "date").agg(
        F.sum("attendance_count").alias("daily_total_attendance")
    )


def in_top_days(total: Column, k: int = TOP_DAYS) -> Column:
    """Whether a row's day is among the ``k`` busiest eligible days of its week.

    Needs columns office_location, week_start, date and eligible. Equal totals
    go to the earlier day. All rows of a day share a dense rank, so the rows
    may be finer than a day; one window holds a single office's week.
    """
    week = W.partitionBy("office_location", "week_start")
    ranked = week.orderBy(F.col("eligible").desc(), total.desc(), F.col("date"))
    return F.col("eligible") & (F.dense_rank().over(ranked) <= k)


def top_days(totals: DataFrame, eligible: DataFrame, k: int = TOP_DAYS) -> DataFrame:
    """The ``k`` busiest eligible days of each office and week with their rank."""
    week = W.partitionBy("office_location", "week_start").orderBy(
        F.col("daily_total_attendance").desc(), "date"
    )
    # At most one row per calendar day is broadcast.
    days = F.broadcast(eligible.where("eligible").select("date"))
    return (
        totals.join(days, "date")
        .withColumn("day_rank", F.row_number().over(week))
        .where(F.col("day_rank") <= k)
    )


def hybrid_flags(
    fact: DataFrame,
    k: int = TOP_DAYS,
    min_weekdays: int = MIN_WEEKDAYS,
    dates: DataFrame | None = None,
) -> DataFrame:
    """Add ``is_hybrid_day`` to a fact of any grain below office and day.

    Totals and ranks are windows over one shuffle by office and week; no top-k
    set is joined back. ``dates`` may name the fact's days where they are known
    without a pass over it. Every row of the fact stays: one whose date is null
    or not among ``dates`` is no hybrid day.
    """
    days = fact if dates is None else dates
    # At most one row per calendar day is broadcast.
    eligible = F.broadcast(eligible_dates(days, min_weekdays).select("date", "eligible"))
    day = W.partitionBy("office_location", "week_start", "date")
    return (
        fact.withColumn("week_start", week_start(F.col("date")))
        .join(eligible, "date", "left")
        .withColumn("eligible", F.coalesce("eligible", F.lit(False)))
        .repartition("office_location", "week_start")
        .withColumn("_day_total", F.sum("attendance_count").over(day))
        .withColumn("is_hybrid_day", in_top_days(F.col("_day_total"), k))
        .select(*fact.columns, "is_hybrid_day")
    )
