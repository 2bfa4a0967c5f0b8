"""Rebuild of what late files touch, equal to a full build.

A monthly drop is a file named by its month. Files are known by size and time of
change; those that are new, changed or gone name the touched drops. Their visits may
lie in other months than the drop's, so a table of (drop, month of visits) is kept:
the visits to be counted again are those of all months that a touched drop has or had
visits in, and the drops to be read are those with visits in these months. No other
visit is read. All further steps start from the counts per day, office and business.

A day of the facts depends on its own counts, the capacity in force and the counts of
its week. So the touched days are those of the recounted months, those whose office
has another capacity than before (the days of changed spans, up to the next
snapshot), and those that enter or leave the window or the dates that can be hybrid
days; with them, their whole ISO weeks. The months of these weeks are written again;
all others stay where earlier versions have them. Where a key of a dimension means
something else than before, all months are written again, without reading visits.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import astuple
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatlens.functions import days, parse
from seatlens.operators.grid import Window, calendar_days
from seatlens.operators.hybrid import eligible_dates
from seatlens.plans import clean, dims, facts
from seatlens.plans.dims import Calendar
from seatlens.schemas import DESKCOUNT, OCCUPANCY, ROW_ORDER
from seatlens.session import stage, temporary_stages
from seatlens.sources import versions
from seatlens.sources.csv_feeds import Combined, combine_feed, fingerprints
from seatlens.sources.workbooks import raise_rejected

_MONTH = ("year", "month")
_WINDOW = "coverage_end date, first date, last date, offices long, businesses long"


class Refreshed(NamedTuple):
    """The version in force, the drops that were read and the months that were written again (None: all)."""

    version: versions.Version
    drops: list[str] | None
    months: list[str] | None


def touched_drops(before: DataFrame, now: DataFrame, feed: str) -> list[str] | None:
    """The months of files that are new, changed or gone; None if one of them names no month."""
    rows = [d.where(F.col("feed") == feed).select("path", "month", "size", "modified") for d in (before, now)]
    changed = rows[0].exceptAll(rows[1]).union(rows[1].exceptAll(rows[0])).select("month").distinct()
    months = [r.month for r in changed.collect()]  # as many as there are months
    return None if None in months else sorted(months)


def _month_of(day: Column) -> Column:
    """``yyyy-MM``; a visit without a date has the month ''."""
    return F.coalesce(F.date_format(day, "yyyy-MM"), F.lit(""))


def _in_months(months: Sequence[str]) -> Column:
    """A condition on a table's partitions."""
    month = F.when(F.col("year").isNull(), "").otherwise(F.format_string("%d-%02d", *_MONTH))
    return month.isin(list(months)) if months else F.lit(False)


def _drop_months(visits: DataFrame) -> DataFrame:
    """(drop, month): which drop has visits of which months."""
    day = parse.as_date(F.col("LogonDate"), visits.schema["LogonDate"].dataType)
    return visits.select("drop", _month_of(day).alias("month")).distinct()


def refresh_marts(
    spark: SparkSession,
    root: str,
    read_visits: Callable[[Sequence[str] | None], DataFrame],
    desk_raw: DataFrame,
    drops: Sequence[str] | None,
    calendar: Calendar = Calendar(),
    order: Sequence[str] = ROW_ORDER,
    inputs: DataFrame | None = None,
) -> Refreshed:
    """A new version of the tables below ``root``, of which only what ``drops`` touch is worked out.

    ``read_visits`` gives the raw visits of some drops, or of all for None, with a column ``drop``.
    ``desk_raw`` are all snapshots. ``drops`` are the touched drops of visits; without an earlier
    version, or for None, all is built. ``inputs`` is kept with the version (``read(..., "input_files")``).
    """
    with temporary_stages(spark):
        return _Refresh(spark, root, read_visits, desk_raw, calendar, order).run(drops, inputs)


class _Refresh:
    def __init__(self, spark, root, read_visits, desk_raw, calendar, order) -> None:
        self.spark, self.root, self.read_visits, self.desk_raw = spark, root, read_visits, desk_raw
        self.calendar, self.order = calendar, order
        self.folder = versions.new_version(root)
        self.before = versions.current(spark, root)
        self.rows: dict[str, int] = {}
        self.parts: dict[str, dict[str, str]] = {}

    def old(self, table: str) -> DataFrame:
        return versions.read(self.spark, self.root, table, self.before)

    def write(self, name: str, df: DataFrame) -> DataFrame:
        """A table that is written whole."""
        df.write.parquet(f"{self.folder}/{name}")
        written = self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")
        self.rows[name] = written.count()  # from file footers
        return written

    def write_months(self, name: str, df: DataFrame, gone: Sequence[str] | None) -> None:
        """The given months anew (all for None), the others where they were."""
        df.write.partitionBy(*_MONTH).parquet(f"{self.folder}/{name}")
        own = versions.Version(0, self.folder.rpartition("/")[2], {name: 0})
        parts = versions.partitions(self.spark, self.root, own, name)
        if gone is not None:
            kept = versions.partitions(self.spark, self.root, self.before, name)
            parts |= {p: v for p, v in kept.items() if p not in set(map(_folder, gone))}
        self.parts[name] = parts
        whole = versions.Version(0, own.name, {name: 0}, {name: parts})
        self.rows[name] = versions.read(self.spark, self.root, name, whole).count()

    def run(self, drops: Sequence[str] | None, inputs: DataFrame | None) -> Refreshed:
        spark, order = self.spark, self.order
        full = drops is None or self.before is None or "drop_months" not in self.before.rows
        recounted = None if full else self._recounted(drops)
        read = None if full else self._to_read(drops, recounted)
        if full or read:
            raw = self.read_visits(read)
            visits = clean.clean_occupancy(raw, order)
        if full:
            self.write("drop_months", _drop_months(raw))
            self.write_months("occupancy_clean", visits.hint("rebalance", *_MONTH), None)
            daily = self.write("daily_attendance", facts.daily_attendance(self._written("occupancy_clean")))
        else:
            kept = self.old("drop_months").where(~F.col("drop").isin(list(drops)))
            self.write("drop_months", kept.unionByName(self.links))
            visits = visits.where(_in_months(recounted)) if read else self.old("occupancy_clean").limit(0)
            self.write_months("occupancy_clean", visits.hint("rebalance", *_MONTH), recounted)
            others = self.old("daily_attendance").where(~_month_of(F.col("date")).isin(recounted))
            again = facts.daily_attendance(self._written("occupancy_clean").where(_in_months(recounted)))
            daily = self.write("daily_attendance", others.unionByName(again))
        snapshots = self.write("snapshots", clean.clean_deskcount(self.desk_raw, order))
        self.write("deskcount_clean", snapshots.drop(*order))
        locations = self.write("dim_location", dims.dim_location(daily, self.desk_raw, order))
        lobs = self.write("dim_line_of_business", dims.dim_line_of_business(daily))
        self.write("dim_date", dims.dim_date(spark, self.calendar))
        window = facts.resolve_window(daily, snapshots, self.calendar)
        self.write("fact_window", spark.createDataFrame([astuple(window)], _WINDOW))
        months = None if full else self._months(recounted, window, locations, lobs, snapshots)
        self._facts(months, daily, snapshots, locations, lobs, window)
        if inputs is not None:
            self.write("input_files", inputs)
        version = versions.commit(spark, self.folder, self.rows, self.parts)
        return Refreshed(version, read, months)

    def _written(self, name: str) -> DataFrame:
        version = versions.Version(0, self.folder.rpartition("/")[2], {name: 0}, {name: self.parts[name]})
        return versions.read(self.spark, self.root, name, version)

    def _recounted(self, drops: Sequence[str]) -> list[str]:
        """The months that the touched drops have or had visits in."""
        # A drop that is gone has no file to read; the links of the others come from their content.
        self.links = stage(_drop_months(self.read_visits(drops)), "links") if drops else self.old("drop_months").limit(0)
        had = self.old("drop_months").where(F.col("drop").isin(list(drops)))
        months = had.unionByName(self.links).select("month").distinct().collect()  # as many as there are months
        return sorted(r.month for r in months)

    def _to_read(self, drops: Sequence[str], recounted: list[str]) -> list[str]:
        others = self.old("drop_months").where(~F.col("drop").isin(list(drops)) & F.col("month").isin(recounted))
        return sorted({*(r.drop for r in others.select("drop").distinct().collect()), *drops})

    def _months(self, recounted: list[str], window: Window, locations: DataFrame, lobs: DataFrame, snapshots: DataFrame) -> list[str] | None:
        """The months whose facts may differ from before; None where all may."""
        old_offices, old_lobs = self.old("dim_location"), self.old("dim_line_of_business")
        keys = ["location_key", "office_location"]
        if _differ(locations.select(*keys), old_offices.select(*keys)) or _differ(lobs, old_lobs):
            return None
        was = Window(*self.old("fact_window").first())
        spans = facts.capacity_spans(locations, snapshots, window, self.order)
        old_spans = facts.capacity_spans(old_offices, self.old("snapshots"), was, self.order)
        columns = ["office_location", "deskcount", "from_day", "to_day"]
        spans, old_spans = stage(spans.select(*columns), "spans"), stage(old_spans.select(*columns), "spans")
        # Only spans that are not the same on both sides are unfolded; of them, the days that differ.
        each = [
            a.exceptAll(b).select(*columns[:2], F.explode(F.sequence("from_day", "to_day")).alias("date"))
            for a, b in ((spans, old_spans), (old_spans, spans))
        ]
        touched = each[0].exceptAll(each[1]).union(each[1].exceptAll(each[0]))
        grids = [calendar_days(self.spark, w) for w in (window, was)]
        eligible = [eligible_dates(g).select("date", "eligible") for g in grids]
        flags = eligible[0].exceptAll(eligible[1]).union(eligible[1].exceptAll(eligible[0])).select("date")
        counted = grids[0].union(grids[1]).select("date").where(_month_of(F.col("date")).isin(recounted))
        touched = touched.select("date").union(flags).union(counted).select(days.week_start(F.col("date")).alias("monday")).distinct()
        week = touched.select(F.explode(F.sequence("monday", F.date_add("monday", 6))).alias("date"))
        return sorted(r.m for r in week.select(_month_of(F.col("date")).alias("m")).distinct().collect())

    def _facts(self, months: list[str] | None, daily: DataFrame, snapshots: DataFrame, locations: DataFrame, lobs: DataFrame, window: Window) -> None:
        mondays = None if months is None else _mondays(months)
        office_days = facts.office_days(daily, snapshots, locations, window, self.order, lobs, mondays)
        if months is not None:
            office_days = office_days.where(_month_of(F.col("date")).isin(months))
        office_days = stage(office_days, "office_days")
        tasks = window.tasks(self.spark)
        spread = lambda n: office_days.repartitionByRange(n, "date_key", "location_key")
        fact = facts.fact_occupancy(spread(tasks), lobs)
        self.write_months("fact_occupancy", fact.sortWithinPartitions(*_MONTH, "date_key", "office_location", "lob_key"), months)
        aggregated = facts.fact_occupancy_aggregated(spread(max(1, tasks // 4)))
        self.write_months("fact_occupancy_aggregated", aggregated.sortWithinPartitions(*_MONTH, "date_key", "office_location"), months)


def _differ(a: DataFrame, b: DataFrame) -> bool:
    return not (a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty())


def _folder(month: str) -> str:
    if not month:
        return "/".join(f"{c}=__HIVE_DEFAULT_PARTITION__" for c in _MONTH)
    return f"year={int(month[:4])}/month={int(month[5:])}"


def _mondays(months: Sequence[str]) -> list[dt.date]:
    """The Mondays of all weeks with a day in one of the months."""
    out = set()
    for month in filter(None, months):
        first = dt.date(int(month[:4]), int(month[5:]), 1)
        after = (first + dt.timedelta(days=31)).replace(day=1)
        monday = first - dt.timedelta(days=first.weekday())
        while monday < after:
            out.add(monday)
            monday += dt.timedelta(days=7)
    return sorted(out)


def refresh_csv(spark: SparkSession, inputs: str, root: str, calendar: Calendar = Calendar()) -> Refreshed:
    """Bring the tables below ``root`` up to date with the CSV drops in ``inputs``.

    Drops are files named ``YYYY-MM_Occupancy.csv``. Changed snapshots need no months: all of them are read.
    A file that cannot be used fails the job, and the version in force stays.
    """

    def usable(combined: Combined) -> DataFrame:
        raise_rejected(combined.rejected, inputs)
        return combined.rows

    with temporary_stages(spark):
        now = stage(
            fingerprints(spark, f"{inputs}/{OCCUPANCY.name}", OCCUPANCY).unionByName(
                fingerprints(spark, f"{inputs}/{DESKCOUNT.name}", DESKCOUNT)
            ),
            "fingerprints",
        )
        before = versions.current(spark, root)
        drops = touched_drops(versions.read(spark, root, "input_files"), now, OCCUPANCY.name) if before else None
        there = {r.month for r in now.where(F.col("feed") == OCCUPANCY.name).select("month").distinct().collect()}

        def visits(months: Sequence[str] | None) -> DataFrame:
            own = sorted(there & set(months)) if months is not None else None
            if own == []:
                texts = ", ".join(f"{c} string" for c in [*OCCUPANCY.columns, "drop", "source_file"])
                return spark.createDataFrame([], f"{texts}, source_block long, row_pos long")
            rows = usable(combine_feed(spark, f"{inputs}/{OCCUPANCY.name}", OCCUPANCY, months=own))
            return rows.withColumn("drop", F.regexp_extract("source_file", r"/(\d{4}-\d{2})_[^/]*$", 1))

        desks = usable(combine_feed(spark, f"{inputs}/{DESKCOUNT.name}", DESKCOUNT))
        return refresh_marts(spark, root, visits, desks, drops, calendar, ROW_ORDER, now)
