"""Occupancy facts on the dense date × office (× line of business) grid.

Only :func:`daily_attendance` touches visits one by one. All else works on its
result, whose size is bounded by days × offices × lines of business, whatever
the number of visits.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seatlens.functions import days
from seatlens.operators.asof import asof_join, newest_per_day
from seatlens.operators.grid import Window, calendar_days, fill_counts, office_grid, with_lobs
from seatlens.operators.hybrid import eligible_dates, in_top_days
from seatlens.plans.dims import Calendar
from seatlens.schemas import TABLES, conform

_BEFORE_ALL = "0001-01-01"


def daily_attendance(visits: DataFrame) -> DataFrame:
    """Visits per day, office and line of business; nulls are kept as groups."""
    return visits.groupBy(F.col("logon_date").alias("date"), "office_location", "line_of_business").agg(
        F.count("*").alias("attendance_count")
    )


def coverage_window(daily: DataFrame, snapshots: DataFrame, calendar: Calendar = Calendar()) -> DataFrame:
    """One row: first and last visit, newest snapshot, coverage end, grid bounds.

    The grid runs over the days that lie in the calendar and between the first
    visit and the coverage end; outside visits do not count.
    """
    return _coverage(daily, snapshots, calendar).drop("offices", "businesses")


def resolve_window(daily: DataFrame, snapshots: DataFrame, calendar: Calendar = Calendar()) -> Window:
    """The bounds of :func:`coverage_window` as values.

    One row comes to the driver. As literals the bounds reach the file scans as
    pushed filters.
    """
    row = _coverage(daily, snapshots, calendar).first()
    return Window(row.coverage_end, row.grid_start, row.grid_end, row.offices, row.businesses)


def _coverage(daily: DataFrame, snapshots: DataFrame, calendar: Calendar) -> DataFrame:
    seen = daily.agg(
        F.min("date").alias("first_visit"),
        F.max("date").alias("last_visit"),
        F.approx_count_distinct("office_location").alias("offices"),
        F.approx_count_distinct("line_of_business").alias("businesses"),
    )
    newest = snapshots.agg(F.max("date").alias("date")).scalar()
    end = days.coverage_end(F.col("last_visit"), F.col("latest_snapshot"))
    any_visit = F.col("first_visit").isNotNull()
    return seen.withColumn("latest_snapshot", newest).select(
        "*",
        end.alias("coverage_end"),
        F.when(any_visit, F.greatest("first_visit", F.lit(calendar.first))).alias("grid_start"),
        F.when(any_visit, F.least(end, F.lit(calendar.last))).alias("grid_end"),
    )


def lost_visits(daily: DataFrame, window: Window, locations: DataFrame) -> DataFrame:
    """One row: the visits that no fact row counts, by the first reason that holds.

    Their day is outside the grid, they name no office, or an office that the
    dimension spells differently. With the facts' attendance they add up to all.
    """
    known = locations.select("office_location", F.lit(True).alias("known"))
    n = F.col("attendance_count")
    outside = ~F.coalesce(window.holds(F.col("date")), F.lit(False))
    without = F.col("office_location").isNull()
    total = lambda condition: F.coalesce(F.sum(F.when(condition, n)), F.lit(0))
    return daily.join(known, "office_location", "left").agg(
        total(outside).alias("outside"),
        total(~outside & without).alias("without_office"),
        total(~outside & ~without & F.col("known").isNull()).alias("unknown_office"),
    )


def attendance_by(daily: DataFrame, window: Window, by_lob: bool) -> DataFrame:
    """Attendance up to the coverage end per day and office (and business)."""
    keys = ["date_key", "office_location"] + (["line_of_business"] if by_lob else [])
    counted = daily.where(F.col("date") <= window.end).withColumn(
        "date_key", days.date_key(F.col("date"))
    )
    for key in keys:
        counted = counted.where(F.col(key).isNotNull())
    return counted.groupBy(*keys).agg(F.sum("attendance_count").alias("attendance_count"))


def dense_attendance(
    daily: DataFrame, window: Window, locations: DataFrame, lobs: DataFrame | None = None
) -> DataFrame:
    """The grid with attendance, zeros included; per business if ``lobs`` is given."""
    grid = office_grid(locations, window)
    keys = ["date_key", "office_location"]
    if lobs is not None:
        grid = with_lobs(grid, lobs)
        keys.append("line_of_business")
    counts = attendance_by(daily, window, by_lob=lobs is not None)
    return fill_counts(grid, counts, keys, "attendance_count")


def with_capacity(fact: DataFrame, snapshots: DataFrame, order: Sequence[str]) -> DataFrame:
    """The capacity in force on each row's day (as-of join by office)."""
    return asof_join(fact, snapshots, "date", ["office_location"], ["deskcount"], order)


def capacity_spans(
    locations: DataFrame, snapshots: DataFrame, window: Window, order: Sequence[str]
) -> DataFrame:
    """Days of the window split, per office, by the capacity snapshot in force.

    An imaginary snapshot without capacity opens each office's history, so the
    spans cover every day of the window exactly once.
    """
    newest = newest_per_day(snapshots, "date", ["office_location"], ["deskcount"], order)
    known = newest.join(locations, "office_location").select(
        "location_key", "office_location", "date", "payload.deskcount"
    )
    opening = locations.select(
        "location_key",
        "office_location",
        F.lit(_BEFORE_ALL).cast("date").alias("date"),
        F.lit(None).cast("int").alias("deskcount"),
    )
    history = W.partitionBy("location_key", "office_location").orderBy("date")
    until = F.date_sub(F.lead("date").over(history), 1)
    first, last = window.grid_start, window.grid_end
    return (
        opening.unionByName(known)
        .withColumn("to_day", F.least(until, last))
        .withColumn("from_day", F.greatest(F.col("date"), first))
        .where((F.col("from_day") <= F.col("to_day")) & (first <= last))
        .drop("date")
    )


def _weekly_counts(daily: DataFrame, window: Window, lobs: DataFrame | None) -> DataFrame:
    """Attendance per office and ISO week as a map from day to counts.

    A map has seven entries at most. With ``lobs`` each entry also lists the
    counts per business, one entry per business at most.
    """
    rows = daily.where(window.holds(F.col("date")) & F.col("office_location").isNotNull())
    total = F.sum("attendance_count").alias("total")
    entry = ["total"]
    measures = [total]
    if lobs is not None:
        rows = rows.join(lobs, "line_of_business")
        listed = F.collect_list(F.struct("lob_key", "attendance_count"))
        measures.append(listed.alias("by_lob"))
        entry.append("by_lob")
    keys = ["office_location", "week_start"]
    # One shuffle by office and week serves both groupings and the join after.
    weekly = rows.withColumn("week_start", days.week_start(F.col("date"))).repartition(
        window.tasks(daily.sparkSession), *keys
    )
    per_day = weekly.groupBy(*keys, "date").agg(*measures)
    as_entries = F.collect_list(F.struct("date", F.struct(*entry)))
    return per_day.groupBy(*keys).agg(F.map_from_entries(as_entries).alias("counts"))


def office_days(
    daily: DataFrame,
    snapshots: DataFrame,
    locations: DataFrame,
    window: Window,
    order: Sequence[str],
    lobs: DataFrame | None = None,
    weeks_of: Sequence[dt.date] | None = None,
) -> DataFrame:
    """Every office day with attendance, capacity and hybrid flag; of the weeks with these Mondays, or of all.

    The unit of work is one office's ISO week: capacity spans are cut at
    Mondays and joined to weekly counts before they are unfolded into days, so
    what is shuffled is weeks, and ranking the days of a week needs no further
    shuffle.
    """
    spans = capacity_spans(locations, snapshots, window, order)
    mondays = F.sequence(days.week_start(F.col("from_day")), F.col("to_day"), F.expr("interval 7 days"))
    weeks = spans.withColumn("week_start", F.explode(mondays))
    if weeks_of is not None:
        weeks = weeks.where(F.col("week_start").isin(list(weeks_of)))
        daily = daily.where(days.week_start(F.col("date")).isin(list(weeks_of)))
    weeks = weeks.repartition(window.tasks(daily.sparkSession), "office_location", "week_start")
    counted = weeks.join(_weekly_counts(daily, window, lobs), ["office_location", "week_start"], "left")
    # At most one row per calendar day is broadcast.
    eligible = F.broadcast(eligible_dates(calendar_days(daily.sparkSession, window)).select("date", "eligible"))
    span_days = F.sequence(
        F.greatest("from_day", "week_start"), F.least("to_day", F.date_add("week_start", 6))
    )
    d = F.col("date")
    return (
        counted.withColumn("date", F.explode(span_days))
        .join(eligible, "date")
        .withColumn("day", F.try_element_at("counts", d))
        .withColumn("attendance_count", F.coalesce("day.total", F.lit(0)))
        .withColumn("is_hybrid_day", in_top_days(F.col("attendance_count")))
        .select(
            days.date_key(d).alias("date_key"),
            "location_key",
            "date",
            "office_location",
            F.year(d).alias("year"),
            F.month(d).alias("month"),
            days.is_weekend(d).alias("is_weekend"),
            "attendance_count",
            "deskcount",
            "is_hybrid_day",
            *([] if lobs is None else [F.col("day.by_lob").alias("by_lob")]),
        )
    )


def fact_occupancy_aggregated(office_days: DataFrame) -> DataFrame:
    """Attendance, capacity, rate and hybrid flag per day and office."""
    return conform(_rated(office_days), TABLES["fact_occupancy_aggregated"])


def fact_occupancy(office_days: DataFrame, lobs: DataFrame) -> DataFrame:
    """Attendance, capacity, rate and hybrid flag per day, office and business.

    ``office_days`` must list its counts by business. The rate of a business is
    over the whole office's desks, and the flag is the office's: businesses only
    split the attendance.
    """
    return conform(_rated(_unpack_lobs(office_days, lobs)), TABLES["fact_occupancy"])


def _rated(fact: DataFrame) -> DataFrame:
    rate = days.occupancy_rate(F.col("attendance_count"), F.col("deskcount"))
    return fact.withColumn("occupancy_rate", rate)


def _unpack_lobs(packed: DataFrame, lobs: DataFrame) -> DataFrame:
    """One row per business from office days that list their counts.

    The rows are generated where the office day already is. Names are looked up
    by an equi-join on the dense key, whose side the optimizer broadcasts only
    when it is small; then the largest frame of the build is never shuffled.
    """
    last_key = F.coalesce(lobs.agg(F.max("lob_key")).scalar(), F.lit(0))
    nothing = F.array().cast("array<struct<lob_key:int,attendance_count:bigint>>")
    every_key = F.when(last_key > 0, F.sequence(F.lit(1), last_key)).otherwise(F.array().cast("array<int>"))
    listed = F.coalesce("by_lob", nothing)
    absent = F.array_except(every_key, listed["lob_key"])
    none = F.array_repeat(F.lit(0).cast("bigint"), F.size(absent))
    zeros = F.arrays_zip(absent.alias("lob_key"), none.alias("attendance_count"))
    rows = packed.drop("attendance_count").withColumn("lob", F.explode(F.concat(listed, zeros)))
    return rows.select("*", "lob.*").join(lobs.select("lob_key", "line_of_business"), "lob_key")
