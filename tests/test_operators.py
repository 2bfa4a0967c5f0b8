from __future__ import annotations

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from seatlens.operators.asof import asof_join
from seatlens.operators.dedup import keep_first
from seatlens.operators.grid import Window, fill_counts, office_grid, with_lobs
from seatlens.operators.hybrid import daily_totals, eligible_dates, hybrid_flags, top_days
from seatlens.operators.keys import dense_keys
from tests.helpers import day, rows


def test_keep_first_follows_order_and_groups_nulls(spark):
    data = [("a", 1, "late", 9), ("a", 1, "first", 2), (None, 1, "x", 5), (None, 1, "y", 4), ("b", None, "z", 1)]
    df = spark.createDataFrame(data, "u string, d int, v string, seq int").repartition(3)
    kept = keep_first(df, ["u", "d"], ["seq"])
    assert rows(kept, "u", "d", "v") == [(None, 1, "y"), ("a", 1, "first"), ("b", None, "z")]


def test_keep_first_cuts_hot_keys_before_the_shuffle(spark):
    kept = keep_first(spark.range(10).withColumn("k", F.col("id") % 2), ["k"], ["id"])
    above, below = kept._jdf.queryExecution().executedPlan().toString().split("Exchange", 1)
    assert "WindowGroupLimit" in below and "Partial" in below and "Final" in above


def test_dense_keys(spark):
    names = [f"N{i:02d}" for i in range(40)] + ["a", "Z", "é", "ß"]
    random.Random(1).shuffle(names)
    df = spark.createDataFrame([(n,) for n in names * 2 + [None]], "name string")
    keyed = dense_keys(df, "name", "k")
    expected = sorted(set(names), key=lambda n: n.encode())
    assert rows(keyed, "k", "name") == list(enumerate(expected, 1))


def test_asof_cases(spark):
    left = spark.createDataFrame(
        [("A", day(d)) for d in ("2023-12-01", "2024-01-15", "2024-02-15", "2024-03-15")] + [("B", day("2024-03-01"))],
        "o string, date date",
    )
    right = spark.createDataFrame(
        [
            ("A", day("2024-01-01"), 10, 1),
            ("A", day("2024-02-01"), None, 2),
            ("A", day("2024-03-01"), 7, 3),
            ("A", day("2024-03-01"), 9, 4),
            ("C", day("2024-03-01"), 5, 5),
        ],
        "o string, date date, desks int, seq int",
    )
    got = asof_join(left, right, "date", ["o"], ["desks"], ["seq"])
    assert [r[2] for r in rows(got)] == [None, 10, None, 9, None]


def test_asof_equals_merge_asof_on_random_rows(spark):
    rng = random.Random(7)
    start = dt.date(2024, 1, 1)

    def some(n):
        return [(rng.choice("ABCD"), start + dt.timedelta(days=rng.randrange(60))) for _ in range(n)]

    left = [(o, d, i) for i, (o, d) in enumerate(some(300))]
    right = [(o, d, rng.choice([None, rng.randrange(50)]), i) for i, (o, d) in enumerate(some(60))]
    lf = spark.createDataFrame(left, "o string, date date, id int").repartition(3)
    rf = spark.createDataFrame(right, "o string, date date, v int, seq int").repartition(2)
    got = {r.id: r.v for r in asof_join(lf, rf, "date", ["o"], ["v"], ["seq"]).collect()}

    lp = pd.DataFrame(left, columns=["o", "date", "id"])
    rp = pd.DataFrame(right, columns=["o", "date", "v", "seq"])
    lp["date"], rp["date"] = pd.to_datetime(lp["date"]), pd.to_datetime(rp["date"])
    rp["v"] = rp["v"].astype("Int64")
    merged = pd.merge_asof(
        lp.sort_values("date", kind="mergesort"), rp.sort_values("date", kind="mergesort"), on="date", by="o"
    )
    assert got == {i: None if v is pd.NA else v for i, v in zip(merged["id"], merged["v"], strict=True)}


def test_asof_needs_days(spark):
    stamps = spark.createDataFrame([("A", dt.datetime(2024, 1, 1))], "o string, date timestamp")
    with pytest.raises(TypeError):
        asof_join(stamps, stamps, "date", ["o"], [], [])


def dates(spark, first, last):
    span = [(first + dt.timedelta(days=i),) for i in range((last - first).days + 1)]
    return spark.createDataFrame(span, "date date")


def test_month_edge_week(spark):
    """One June weekday, four July weekdays."""
    got = eligible_dates(dates(spark, day("2025-06-30"), day("2025-07-06")))
    assert [(r.date.day, r.eligible) for r in got.orderBy("date").collect()] == [
        (30, False), (1, True), (2, True), (3, True), (4, True), (5, False), (6, False),
    ]


def test_partial_week_has_no_eligible_day(spark):
    got = eligible_dates(dates(spark, day("2025-07-07"), day("2025-07-08")))
    assert {r.eligible for r in got.collect()} == {False}


def test_top_three_prefer_busier_then_earlier_days(spark):
    monday = day("2025-07-07")
    totals = [5, 5, 5, 9, 5, 50, 60]
    fact = spark.createDataFrame(
        [("A", monday + dt.timedelta(days=i), lob, n) for i, n in enumerate(totals) for lob in ("x", "y")]
        + [("Z", monday + dt.timedelta(days=i), "x", 0) for i in range(7)],
        "office_location string, date date, line_of_business string, attendance_count int",
    ).repartition(4)
    flagged = rows(hybrid_flags(fact).where("is_hybrid_day"), "office_location", "date", "line_of_business")
    in_a = {(d - monday).days for o, d, _ in flagged if o == "A"}
    in_z = {(d - monday).days for o, d, _ in flagged if o == "Z"}
    assert in_a == {0, 1, 3} and in_z == {0, 1, 2}
    assert len(flagged) == 2 * 3 + 3
    ranked = top_days(daily_totals(fact), eligible_dates(fact))
    a = rows(ranked.where("office_location = 'A'"), "day_rank", "date", "daily_total_attendance")
    assert a == [
        (1, monday + dt.timedelta(days=3), 18),
        (2, monday, 10),
        (3, monday + dt.timedelta(days=1), 10),
    ]


def test_flags_keep_rows_without_a_known_day(spark):
    monday = day("2025-07-07")
    fact = spark.createDataFrame(
        [("A", monday, 3), ("A", None, 9), ("A", monday + dt.timedelta(days=1), 5), (None, monday, 1)],
        "office_location string, date date, attendance_count int",
    )
    known = dates(spark, monday, monday + dt.timedelta(days=6)).where("date <> DATE '2025-07-08'")
    got = rows(hybrid_flags(fact, dates=known), "attendance_count", "is_hybrid_day")
    assert got == [(1, True), (3, True), (5, False), (9, False)]


def test_few_offices_fill_all_tasks(spark):
    locations = spark.createDataFrame([(1, "A"), (2, "B")], "location_key int, office_location string")
    window = Window(day("2049-12-31"), day("2000-01-01"), day("2049-12-31"), offices=2, businesses=20)
    grid = office_grid(locations, window)
    sizes = [r.n for r in grid.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(sizes) == window.tasks(spark) > 2 and max(sizes) < 1.5 * min(sizes)


def test_grid_is_dense_and_counts_fill_with_zero(spark):
    locations = spark.createDataFrame([(1, "A"), (2, "B")], "location_key int, office_location string")
    lobs = spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "lob_key int, line_of_business string")
    window = Window(day("2024-01-05"), day("2024-01-01"), day("2024-01-05"))
    grid = with_lobs(office_grid(locations, window), lobs)
    assert grid.count() == 5 * 2 * 3 == grid.distinct().count()
    counts = spark.createDataFrame(
        [(20240102, "B", "y", 7), (20231231, "B", "y", 1)],
        "date_key int, office_location string, line_of_business string, n bigint",
    )
    filled = fill_counts(grid, counts, ["date_key", "office_location", "line_of_business"], "n")
    assert filled.count() == 30
    assert [tuple(r) for r in filled.where("n > 0").select("date_key", "lob_key", "n").collect()] == [(20240102, 2, 7)]


def test_empty_window_gives_empty_grid(spark):
    locations = spark.createDataFrame([(1, "A")], "location_key int, office_location string")
    for window in (Window(None, None, None), Window(day("2024-01-01"), day("2024-01-05"), day("2024-01-01"))):
        assert office_grid(locations, window).count() == 0
