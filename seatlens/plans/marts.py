"""The whole build in one Spark application."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from seatlens.plans import clean, dims, facts, profile, quality
from seatlens.plans.dims import Calendar
from seatlens.schemas import DESKCOUNT, FEEDS, OCCUPANCY, ROW_ORDER, TABLES, Feed, conform
from seatlens.session import new_folder, temporary_stages
from seatlens.sources import tables as sinks
from seatlens.sources import versions
from seatlens.sources.csv_feeds import combine_feed
from seatlens.sources.workbooks import ingest_workbooks, raise_rejected

_MONTH = ("year", "month")


@dataclass(frozen=True)
class Marts:
    """Finished tables and reports by name, and the rows seen at each step."""

    tables: dict[str, DataFrame]
    reports: dict[str, DataFrame]
    steps: DataFrame


def build_marts(
    visits_raw: DataFrame,
    desk_raw: DataFrame,
    calendar: Calendar = Calendar(),
    order: Sequence[str] = ROW_ORDER,
    folder: str | None = None,
) -> Marts:
    """Write every table of the star schema as a new version under ``folder`` and report on it.

    Each table is written once and read back by its consumers, so the visits
    are read and de-duplicated a single time, and a lost executor costs no more
    than its unfinished tasks. Without a folder the shared one is used. What was
    staged on the way is deleted at the end. When all tables are written, one
    manifest puts them in force together (``sources.versions``); a build that
    fails leaves the earlier version as it was.

    Rows are counted while tables are written, the loaded ones by a count of
    their own: a task that Spark has to run again counts once.
    """
    spark = visits_raw.sparkSession
    version = versions.new_version(folder or new_folder(spark, "marts"))
    with temporary_stages(spark):
        marts, rows = _build(visits_raw, desk_raw, calendar, order, version)
    versions.commit(spark, version, rows)
    return marts


def _build(
    visits_raw: DataFrame, desk_raw: DataFrame, calendar: Calendar, order: Sequence[str], root: str
) -> tuple[Marts, dict[str, int]]:
    spark = visits_raw.sparkSession
    seen: dict[str, Observation] = {}

    def watched(name: str, df: DataFrame, **measures: Column) -> DataFrame:
        seen[name] = Observation()
        rows = F.count(F.lit(1)).alias("rows")
        return df.observe(seen[name], rows, *[m.alias(k) for k, m in measures.items()])

    def write(name: str, df: DataFrame, by: Sequence[str] = (), **measures: Column) -> DataFrame:
        watched(name, df, **measures).write.partitionBy(*by).parquet(f"{root}/{name}")
        return spark.read.schema(df.schema).parquet(f"{root}/{name}").select(*df.columns)

    flag = clean.include_flag(desk_raw)
    unflagged = F.count_if(F.lit(False) if flag is None else flag.isNull())
    loaded = visits_raw.agg(F.count(F.lit(1)).alias("rows")).first()
    desks = desk_raw.agg(F.count(F.lit(1)).alias("rows"), unflagged.alias("unflagged")).first()
    cleaned = clean.clean_occupancy(visits_raw, order)
    visits = write("occupancy_clean", cleaned.hint("rebalance", *_MONTH), by=_MONTH)
    snapshots = write("deskcount_clean", clean.clean_deskcount(desk_raw, order))
    daily = write("daily_attendance", facts.daily_attendance(visits))
    locations = write("dim_location", dims.dim_location(daily, desk_raw, order))
    lobs = write("dim_line_of_business", dims.dim_line_of_business(daily))
    window = facts.resolve_window(daily, snapshots, calendar)
    days = write("office_days", facts.office_days(daily, snapshots, locations, window, order, lobs))

    # Tasks get ranges of days, so a file holds few months; inside a month rows are
    # in report order, so a reader skips the row groups of other days.
    capacity = F.count("deskcount")
    spread = days.repartitionByRange(window.tasks(spark), "date_key", "location_key")
    fact = facts.fact_occupancy(spread, lobs)
    fact = fact.sortWithinPartitions(*_MONTH, "date_key", "office_location", "lob_key")
    fact = write("fact_occupancy", fact, by=_MONTH, capacity=capacity)
    aggregated = facts.fact_occupancy_aggregated(
        days.repartitionByRange(max(1, window.tasks(spark) // 4), "date_key", "location_key")
    )
    aggregated = aggregated.sortWithinPartitions(*_MONTH, "date_key", "office_location")
    attendance = F.sum("attendance_count")
    aggregated = write("fact_occupancy_aggregated", aggregated, by=_MONTH, capacity=capacity, attendance=attendance)

    tables = {
        "occupancy_clean": visits,
        "deskcount_clean": conform(snapshots, TABLES["deskcount_clean"]),
        "dim_date": write("dim_date", dims.dim_date(spark, calendar)),
        "dim_location": locations,
        "dim_line_of_business": lobs,
        "fact_occupancy": fact,
        "fact_occupancy_aggregated": aggregated,
    }
    lost = facts.lost_visits(daily, window, locations).first()
    rows = {name: observed.get for name, observed in seen.items()}
    steps = profile.step_counts(
        {
            "visits loaded": loaded.rows,
            "visits de-duplicated": rows["occupancy_clean"]["rows"],
            "visits outside the window": lost.outside,
            "visits without an office": lost.without_office,
            "visits of unknown offices": lost.unknown_office,
            "visits in the fact": rows["fact_occupancy_aggregated"]["attendance"] or 0,
            "snapshots loaded": desks.rows,
            "snapshots without a flag": desks.unflagged,
            "snapshots included": rows["deskcount_clean"]["rows"],
            "fact rows": rows["fact_occupancy"]["rows"],
            "fact rows with capacity": rows["fact_occupancy"]["capacity"],
            "aggregated rows": rows["fact_occupancy_aggregated"]["rows"],
            "aggregated rows with capacity": rows["fact_occupancy_aggregated"]["capacity"],
        },
        spark,
    )
    reports = quality.quality_report(fact, aggregated, locations, daily, snapshots)
    return Marts(tables, reports, steps), {name: rows[name]["rows"] for name in tables}


def run_all(
    spark: SparkSession,
    inputs: str,
    folder: str,
    calendar: Calendar = Calendar(),
    files: str = "xlsx",
    table: str | None = None,
    mode: str = "overwrite",
    fmt: str = "parquet",
    multiline: bool | None = None,
    fail_on_rejected: bool = True,
) -> Marts:
    """From raw files to tables, reports and, if ``table`` is named, a published fact.

    ``inputs`` holds one folder per feed, with workbooks (``files="xlsx"``) or
    CSV files (``files="csv"``; ``multiline`` as in ``combine_feed``). Raw tables
    go to ``folder``/raw, the star schema to a new version in ``folder``/marts
    (``versions.read``), the reports to ``folder``/reports. Files that could not be used don't stop the others: they
    are listed in ``folder``/raw/rejected_files and counted in the steps, and at
    the end, when all else is done, they fail the job unless ``fail_on_rejected``
    is false. Other errors of any step, publishing included, are raised at once.
    """

    def ingest(feed: Feed) -> tuple[DataFrame, DataFrame]:
        source = f"{inputs}/{feed.name}"
        if files == "csv":
            return combine_feed(spark, source, feed, multiline=multiline)
        return ingest_workbooks(spark, source, feed, f"{folder}/raw/{feed.name}", fail=False)

    place = f"{folder}/raw/rejected_files"
    with temporary_stages(spark):
        raw = {name: ingest(feed) for name, feed in FEEDS.items()}
        bad = [left.select(F.lit(name).alias("feed"), "source_file", "error") for name, (_, left) in raw.items()]
        bad[0].union(bad[1]).write.mode("overwrite").parquet(place)
        rejected = spark.read.parquet(place)
        visits, desks = raw[OCCUPANCY.name][0], raw[DESKCOUNT.name][0]
        marts = build_marts(visits, desks, calendar, ROW_ORDER, f"{folder}/marts")
    sinks.write_reports(marts.reports, f"{folder}/reports")
    steps = marts.steps.union(profile.step_counts({"files rejected": rejected.count()}, spark))
    marts = Marts(marts.tables, {**marts.reports, "rejected_files": rejected}, steps)
    if table:
        sinks.publish(marts.tables["fact_occupancy_aggregated"], table, mode, fmt)
    if fail_on_rejected:
        raise_rejected(rejected, place)
    return marts
