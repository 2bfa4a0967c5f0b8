from __future__ import annotations

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seatlens.functions.days import occupancy_rate
from seatlens.operators.hybrid import hybrid_flags
from seatlens.plans import clean, dims, facts, marts, quality
from seatlens.plans.dims import Calendar
from seatlens.session import stage
from seatlens.sources import versions
from fixtures.tables import ORDER, Build
from tests.helpers import day, rows

VISITS = (
    "Username string, OfficeLocation string, LineOfBusiness string, OfficeLocationCityState string,"
    " LogonDate string, DayofWeek string, JobFamily string, seq int"
)
DESKS = "OfficeLocation string, Deskcount string, RSF string, Date string, seq int"


def visits(spark, *entries):
    full = [(u, o, lob, "C", d, "D", f"job{i}", i) for i, (u, o, lob, d) in enumerate(entries)]
    return spark.createDataFrame(full, VISITS)


def desks(spark, *entries):
    return spark.createDataFrame([(*e, i) for i, e in enumerate(entries)], DESKS)


def measures(fact):
    rate = F.when(~F.col("is_weekend"), F.col("occupancy_rate"))
    return tuple(
        fact.agg(
            F.count("*"),
            F.sum("attendance_count"),
            F.count("deskcount"),
            F.count_if(F.col("occupancy_rate") > 1),
            F.count_if("is_hybrid_day"),
            F.round(F.avg(rate), 6),
        ).first()
    )


@pytest.fixture(scope="module")
def events(spark, sf_dir):
    return Build(spark, sf_dir, "events")


@pytest.fixture(scope="module")
def orders(spark, sf_dir):
    return Build(spark, sf_dir, "orders")


@pytest.fixture(scope="module")
def order_facts(orders):
    return stage(orders.fact, "fact"), stage(orders.aggregated, "aggregated")


def test_events_anchors(events):
    assert measures(events.aggregated) == (300, 397, 92, 0, 120, 0.159926)
    assert measures(events.fact) == (1200, 397, 368, 0, 480, 0.039982)
    assert events.locations.agg(F.sum("RSF")).first()[0] == 2500
    assert (events.window.first, events.window.last) == (day("2024-01-01"), day("2024-01-30"))


def test_orders_anchors(orders, order_facts):
    fact, aggregated = order_facts
    assert measures(aggregated) == (8350, 208, 976, 1, 3600, 0.025714)
    assert measures(fact) == (41750, 208, 4880, 0, 18000, 0.005143)
    assert orders.locations.agg(F.sum("RSF")).first()[0] == 3800
    assert (orders.window.first, orders.window.last) == (day("1995-01-01"), day("1995-11-30"))


def test_facts_equal_the_operators_one_by_one(orders, order_facts):
    """The week-wise build gives what grid, as-of join, rate and flags give in turn."""
    _, aggregated = order_facts
    known = facts.with_capacity(orders.grid(by_lob=False), orders.snapshots, ORDER)
    rated = known.withColumn("occupancy_rate", occupancy_rate(F.col("attendance_count"), F.col("deskcount")))
    step_by_step = hybrid_flags(rated)
    columns = ["date_key", "location_key", "office_location", "attendance_count", "deskcount", "occupancy_rate"]
    columns.append("is_hybrid_day")
    assert rows(aggregated, *columns) == rows(step_by_step, *columns)


def test_fact_invariants(orders, order_facts):
    fact, aggregated = order_facts
    days = (orders.window.last - orders.window.first).days + 1
    assert fact.count() == days * orders.locations.count() * orders.lobs.count()
    summed = fact.groupBy("date_key", "office_location").agg(
        F.sum("attendance_count").alias("n"), F.count_distinct("is_hybrid_day").alias("flags")
    )
    assert rows(summed, "date_key", "office_location", "n") == rows(
        aggregated, "date_key", "office_location", "attendance_count"
    )
    assert summed.where("flags <> 1").isEmpty()
    weekly = aggregated.where("is_hybrid_day").groupBy("office_location", F.trunc("date", "week")).count()
    assert weekly.where("count > 3").isEmpty()
    assert fact.where("is_weekend AND is_hybrid_day").isEmpty()
    assert fact.where("(occupancy_rate IS NULL) <> (deskcount IS NULL)").isEmpty()
    assert orders.locations.groupBy("location_key").count().where("count > 1").isEmpty()


def test_result_does_not_depend_on_input_partitions(spark, sf_dir, events):
    again = Build(spark, sf_dir, "events")
    again.raw = type(again.raw)(
        again.raw.visits.orderBy(F.rand(3)).repartition(7), again.raw.desks.orderBy(F.rand(4)), again.raw.calendar
    )
    assert rows(again.visits) == rows(events.visits)
    assert rows(again.aggregated) == rows(events.aggregated)


def test_result_does_not_depend_on_the_time_zone(spark, sf_dir, order_facts):
    """Several switches to summer time lie in the window."""
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        there = rows(Build(spark, sf_dir, "orders").aggregated)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert there == rows(order_facts[1])


def test_a_third_of_all_visits_on_one_key(spark):
    """Visits without a user name collapse to one per day and office."""
    n = F.col("id")
    hot = n % 3 == 0
    raw = spark.range(30_000).select(
        F.when(~hot, n.cast("string")).alias("Username"),
        F.when(hot, "Oslo").otherwise(F.concat(F.lit("Office "), (n % 10).cast("string"))).alias("OfficeLocation"),
        F.when(n == 0, "first").otherwise("later").alias("LineOfBusiness"),
        F.lit("C").alias("OfficeLocationCityState"),
        F.lit(dt.date(2024, 1, 2)).alias("LogonDate"),
        F.lit("Tuesday").alias("DayofWeek"),
        F.lit("J").alias("JobFamily"),
        n.alias("seq"),
    )
    daily = facts.daily_attendance(clean.clean_occupancy(raw.orderBy(F.rand(5)), ORDER))
    assert rows(daily.where("office_location = 'Oslo'"), "line_of_business", "attendance_count") == [("first", 1)]
    assert daily.agg(F.sum("attendance_count")).first()[0] == 20_001


def test_first_visit_wins_and_names_are_dropped(spark):
    raw = visits(
        spark,
        ("u1", " Oslo. ", "Sales", "2024-01-02"),
        ("u1", "Oslo", "Pending", "2024-01-02 09:00:00"),
        ("u1", "Oslo", None, "2024-01-03"),
        (None, "Oslo", "Sales", "2024-01-03"),
        (None, "Oslo", "Sales", "2024-01-03"),
        ("u2", "...", "Development & Construction", "2024-01-10"),
    )
    got = clean.clean_occupancy(raw, ORDER)
    assert got.columns[0] == "username" and {r.username for r in got.collect()} == {1}
    assert rows(got, "office_location", "line_of_business", "logon_date", "job_family", "week_in_month") == [
        (None, "Development and Construction", day("2024-01-10"), "job5", 2),
        ("Oslo", "Corporate", day("2024-01-03"), "job2", 1),
        ("Oslo", "Sales", day("2024-01-02"), "job0", 1),
        ("Oslo", "Sales", day("2024-01-03"), "job3", 1),
    ]
    assert rows(clean.lob_frequency(raw, ORDER), "stage", "line_of_business", "visits") == [
        ("after", "Corporate", 1),
        ("after", "Development and Construction", 1),
        ("after", "Sales", 2),
        ("before", None, 1),
        ("before", "Development & Construction", 1),
        ("before", "Sales", 2),
    ]


def test_required_columns(spark):
    with pytest.raises(ValueError, match="JobFamily"):
        clean.clean_occupancy(visits(spark, ("u", "o", "l", "2024-01-01")).drop("JobFamily"), ORDER)
    with pytest.raises(ValueError, match="Date"):
        clean.clean_deskcount(desks(spark, ("o", "1", "1", "2024-01-01")).drop("Date"))


def test_bad_visit_date_fails(spark):
    with pytest.raises(PySparkException, match="not a date"):
        clean.clean_occupancy(visits(spark, ("u", "o", "l", "someday")), ORDER).collect()


def test_include_flag(spark):
    snaps = desks(spark, ("A", "1", None, "2024-01-01"), ("B", "2", None, "2024-01-01"), ("C", "3", None, "2024-01-01"))
    assert clean.clean_deskcount(snaps).count() == 3
    flag = F.when(F.col("OfficeLocation") == "A", " YES ").when(F.col("OfficeLocation") == "B", "No")
    flagged = snaps.withColumn(" include in OCCUPANCY calculation ", flag)
    assert rows(clean.clean_deskcount(flagged)) == [("A", 1, day("2024-01-01"))]


def test_excluded_snapshot_is_not_checked(spark):
    snaps = desks(spark, ("A", "1", None, "2024-01-01"), ("B", "2.5", None, None))
    flag = F.when(F.col("OfficeLocation") == "A", "yes").otherwise("no")
    flagged = snaps.withColumn(clean.INCLUDE_FLAG, flag)
    assert clean.clean_deskcount(flagged).count() == 1
    with pytest.raises(PySparkException, match="without a date"):
        clean.clean_deskcount(desks(spark, ("B", "2", None, None))).collect()


def test_location_dimension_merges_spellings_and_takes_latest_area(spark):
    raw = visits(spark, ("u", "Oslo", "x", "2024-01-01"), ("u", "Bonn", "x", "2024-01-01"), ("v", "Rome", "x", "2024-01-01"))
    snaps = desks(
        spark,
        ("Oslo.", "1", "500", "2024-03-01"),
        ("Oslo", "1", "400", "2024-01-01"),
        ("  Oslo", "1", None, "2024-04-01"),
        ("Rome", "1", "x", "2024-01-01"),
        ("Eugene", "1", "9", "2024-01-01"),
    )
    got = dims.dim_location(clean.clean_occupancy(raw, ORDER), snaps, ORDER)
    assert rows(got) == [(1, "Bonn", 0), (2, "Oslo", 500), (3, "Rome", 0)]


def test_default_calendar(spark):
    calendar = dims.dim_date(spark)
    assert calendar.count() == 1461
    row = calendar.where("date_key = 20241230").first()
    assert row.week_of_year == 1 and row.day_name == "Monday" and row.quarter == 4 and row.day_of_year == 365
    assert row.date_string == "2024-12-30" and row.month_name == "December" and not row.is_weekend


def build_small(spark, raw, snaps, calendar=Calendar()):
    daily = stage(facts.daily_attendance(clean.clean_occupancy(raw, ORDER)), "daily")
    snapshots = clean.clean_deskcount(snaps, ORDER)
    locations = dims.dim_location(daily, snaps, ORDER)
    lobs = dims.dim_line_of_business(daily)
    window = facts.resolve_window(daily, snapshots, calendar)
    days = facts.office_days(daily, snapshots, locations, window, ORDER, lobs)
    return window, facts.fact_occupancy_aggregated(days), facts.fact_occupancy(days, lobs)


def test_no_snapshots(spark):
    raw = visits(spark, ("u", "A", "x", "2024-01-01"), ("u", "A", "y", "2024-01-04"))
    window, aggregated, fact = build_small(spark, raw, desks(spark).limit(0))
    assert window.last == day("2024-01-04")
    assert rows(aggregated, "date", "attendance_count", "deskcount", "occupancy_rate") == [
        (day(f"2024-01-0{i}"), n, None, None) for i, n in ((1, 1), (2, 0), (3, 0), (4, 1))
    ]
    assert fact.count() == 8


def test_no_visits(spark):
    window, aggregated, fact = build_small(spark, visits(spark).limit(0), desks(spark, ("A", "3", "1", "2024-01-01")))
    assert window.first is None and aggregated.count() == 0 and fact.count() == 0
    assert quality.by_location_summary(fact).count() == 0


def test_capacity_ends_before_first_visit(spark):
    raw = visits(spark, ("u", "A", "x", "2024-05-01"))
    _, aggregated, _ = build_small(spark, raw, desks(spark, ("A", "3", "1", "2024-01-01")))
    assert aggregated.count() == 0


def test_calendar_limits_the_grid(spark):
    raw = visits(spark, ("u", "A", "x", "2023-12-30"), ("u", "A", "x", "2024-01-02"), ("u", "A", "x", "2024-01-09"))
    snaps = desks(spark, ("A", "2", "1", "2023-11-01"), ("A", "4", "1", "2024-01-02"))
    window, aggregated, _ = build_small(spark, raw, snaps, Calendar(dt.date(2024, 1, 1), dt.date(2024, 1, 3)))
    assert rows(aggregated, "date", "attendance_count", "deskcount") == [
        (day("2024-01-01"), 0, 2),
        (day("2024-01-02"), 1, 4),
        (day("2024-01-03"), 0, 4),
    ]


def test_office_spelt_with_inner_dot_is_renamed_in_the_dimension_only(spark):
    """Normalising twice takes one more step: visits of 'A .' do not meet office 'A'."""
    raw = visits(spark, ("u", "A .", "x", "2024-01-01"), ("v", "A", "x", "2024-01-01"))
    _, aggregated, _ = build_small(spark, raw, desks(spark, ("A", "2", "1", "2024-01-01")))
    assert rows(aggregated, "office_location", "attendance_count") == [("A", 1)]


def test_steps_account_for_every_visit(spark, tmp_path):
    raw = visits(
        spark,
        ("u", "A .", "x", "2024-01-01"), ("v", "A", "x", "2024-01-01"), ("v", "A", "x", "2024-01-01"),
        ("w", None, "x", "2024-01-01"), ("x", "A", "x", "2023-01-01"), ("y", "A", "x", "2024-01-02"),
    )
    built = marts.build_marts(raw, desks(spark, ("A", "2", "1", "2024-01-01")), Calendar(), ["seq"], str(tmp_path))
    steps = dict(rows(built.steps))
    assert steps["visits loaded"] == 6 and steps["visits de-duplicated"] == 5
    parts = ["visits in the fact", "visits outside the window", "visits without an office", "visits of unknown offices"]
    assert [steps[p] for p in parts] == [2, 1, 1, 1]


def test_a_failed_build_leaves_the_earlier_version(spark, tmp_path):
    raw = visits(spark, ("u", "A", "x", "2024-01-01"), ("v", "A", "x", "2024-01-02"))
    snaps, root = desks(spark, ("A", "2", "1", "2024-01-01")), str(tmp_path / "m")
    marts.build_marts(raw, snaps, Calendar(), ["seq"], root)
    more = raw.union(visits(spark, ("w", "B", "x", "2024-01-03")))
    broken = snaps.withColumn("RSF", F.raise_error(F.lit("no area")).cast("string"))
    with pytest.raises(Exception, match="no area"):
        marts.build_marts(more, broken, Calendar(), ["seq"], root)
    assert versions.current(spark, root).number == 1
    assert rows(versions.read(spark, root, "dim_location"), "office_location") == [("A",)]
    assert versions.read(spark, root, "occupancy_clean").count() == 2
    built = marts.build_marts(more, snaps, Calendar(), ["seq"], root)
    assert versions.current(spark, root).number == 2
    for name, table in built.tables.items():
        assert rows(versions.read(spark, root, name)) == rows(table)


def test_a_month_of_the_fact_is_read_alone(spark, tmp_path):
    entries = [(f"u{i}", "A", "x", f"2024-{m:02d}-15") for i, m in enumerate(range(1, 7))]
    built = marts.build_marts(visits(spark, *entries), desks(spark, ("A", "2", "1", "2024-06-01")), Calendar(), ["seq"], str(tmp_path))
    march = built.tables["fact_occupancy"].where("year = 2024 AND month = 3")
    scanned = march.select(F.input_file_name().alias("f")).distinct().collect()
    assert scanned and all("month=3" in r.f for r in scanned)
    assert "PartitionFilters: [isnotnull(year" in march._jdf.queryExecution().executedPlan().toString()
    keys = [r.date_key for r in spark.read.parquet(scanned[0].f).select("date_key").collect()]
    assert keys == sorted(keys)


def test_marts(spark, sf_dir, orders, order_facts, tmp_path):
    raw = orders.raw
    built = marts.build_marts(raw.visits, raw.desks, raw.calendar, ORDER, str(tmp_path / "marts"))
    fact, aggregated = order_facts
    assert rows(built.tables["fact_occupancy"]) == rows(fact)
    assert rows(built.tables["fact_occupancy_aggregated"]) == rows(aggregated)
    assert built.tables["deskcount_clean"].columns == ["office_location", "deskcount", "date"]
    steps = dict(rows(built.steps))
    assert steps["visits loaded"] == 1500 and steps["visits de-duplicated"] == 1499
    assert steps["snapshots loaded"] == 10 and steps["snapshots included"] == 9
    lines = [r.line for r in built.reports["validation_summary"].orderBy("ord").collect()]
    assert lines[0] == "== Summary ==" and lines[1] == "Fact rows: 41,750; Agg rows: 8,350"
    assert lines[4] == "Locations: 25 (dim: 25)"
