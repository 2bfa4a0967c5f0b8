from __future__ import annotations

import datetime as dt
import random
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seatlens.functions import days, parse, text
from seatlens.sources import periods
from tests.helpers import day, values


def plain_normal(s):
    """The rule in plain Python."""
    return re.sub(r"\s+", " ", s.strip()).rstrip(".,;:")


def test_normalize_location(spark):
    cases = {
        " A  B ": "A B",
        "\xa0A\xa0 B\xa0": "A B",
        "\tA\n B": "A B",
        "\x1cA\x1f": "A",
        "A .,": "A ",
        "A.:;": "A",
        "A.;x": "A.;x",
        "A.\n": "A",
        "...": "",
        "": "",
        None: None,
    }
    assert values(spark, cases, text.normalize_location) == list(cases.values())
    assert values(spark, ["...", " x"], text.location_or_null) == [None, "x"]


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB .,;:\t\n\r\x0b\x1c\x1f\x85\xa0  　​", max_size=12), min_size=50))
def test_normalize_location_equals_plain_rule(spark, texts):
    assert values(spark, texts, text.normalize_location) == [plain_normal(t) for t in texts]


def test_null_tokens(spark):
    kept = ["none", "-", " NA", "0"]
    assert values(spark, text.NULL_TOKENS, text.blank_null_tokens) == [None] * len(text.NULL_TOKENS)
    assert values(spark, kept, text.blank_null_tokens) == kept


def test_standardize_lob(spark):
    cases = {
        None: "Corporate",
        "Pending": "Corporate",
        "Development & Construction": "Development and Construction",
        "pending": "pending",
        "Sales": "Sales",
    }
    assert values(spark, cases, text.standardize_lob) == list(cases.values())


def test_numbers(spark):
    cases = {"10": 10, " 5 ": 5, "1e2": 100, "x": None, "1,000": None, "0": None, "-3": None, "": None}
    cases |= {"nan": None, "NaN": None, "5d": None, "0x10": None, None: None, "7.0": 7, ".5e1": 5}

    def desks(c):
        return parse.whole_or_error(parse.positive_or_null(parse.number_or_null(c)))

    assert values(spark, cases, desks) == list(cases.values())
    with pytest.raises(PySparkException, match="not a whole number"):
        values(spark, ["2.5"], desks)
    # A negative fraction is missing before it could be a fraction.
    assert values(spark, ["-2.5"], desks) == [None]


def test_dates(spark):
    cases = {
        "2024-01-05": day("2024-01-05"),
        "2024-01-05 08:30:00": day("2024-01-05"),
        "2024-01-05T23:59:59": day("2024-01-05"),
        "1/5/2024": day("2024-01-05"),
        "12/31/2024 7:05": day("2024-12-31"),
        " 2024-01-05 ": day("2024-01-05"),
        **dict.fromkeys(
            ["1/5/2024 8:30 AM", "1/5/2024 8:30:00 am", "2024/01/05", "20240105", "5-Jan-2024", "Jan 5, 2024", "January 5, 2024"]
            + ["01-05-2024", "01/05/24", "5 JANUARY 2024 08:30", "jan. 5, 2024 8:30 AM", "05-jan-24"],
            day("2024-01-05"),
        ),
        None: None,
    }
    assert values(spark, cases, parse.date_or_error) == list(cases.values())
    assert values(spark, ["x", "2024-13-01", "13/1/2024", "Janus 5, 2024", "31-Feb-2024"], parse.date_or_null) == [None] * 5
    with pytest.raises(PySparkException, match="not a date"):
        values(spark, ["2024-13-01"], parse.date_or_error)


def test_parsing_does_not_depend_on_ansi(spark):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(PySparkException, match="not a date"):
            values(spark, ["soon"], parse.date_or_error)
        assert values(spark, ["x", "3"], parse.number_or_null) == [None, 3.0]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_day_arithmetic(spark):
    dates = [dt.date(2024, 1, 1) + dt.timedelta(days=17 * i) for i in range(90)]
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    d = F.col("d")
    got = df.select(
        "d",
        days.date_key(d).alias("key"),
        days.week_start(d).alias("monday"),
        days.week_in_month(d).alias("wim"),
        days.day_of_week(d).alias("dow"),
        days.is_weekend(d).alias("weekend"),
        F.weekofyear(d).alias("week"),
    ).collect()
    for r in got:
        assert r.key == int(r.d.strftime("%Y%m%d"))
        assert r.monday == r.d - dt.timedelta(days=r.d.weekday())
        assert r.wim == (r.d.day - 1) // 7 + 1
        assert r.dow == r.d.isoweekday()
        assert r.weekend == (r.d.isoweekday() > 5)
        assert r.week == r.d.isocalendar().week


def test_coverage_end(spark):
    df = spark.createDataFrame(
        [
            (day("2025-03-10"), day("2025-02-01")),
            (day("2025-03-10"), None),
            (day("2025-02-10"), day("2025-02-28")),
        ],
        "v date, s date",
    )
    ends = df.select(days.coverage_end(F.col("v"), F.col("s")).alias("e")).collect()
    assert [r.e for r in ends] == [day("2025-02-28"), day("2025-03-10"), day("2025-02-10")]


def test_occupancy_rate(spark):
    df = spark.createDataFrame([(3, 4), (3, None), (0, 4), (3, 0)], "a bigint, d int")
    rates = df.select(days.occupancy_rate(F.col("a"), F.col("d")).alias("r")).collect()
    assert [r.r for r in rates] == [0.75, None, 0.0, None]


def test_report_formats(spark):
    df = spark.createDataFrame([(1, 8, 1234567, 0.12345), (1, 0, 0, None)], "n long, d long, big long, m double")
    got = df.select(
        text.percent_text(F.col("n"), F.col("d")), text.thousands(F.col("big")), text.mean_text(F.col("m"))
    ).collect()
    assert [tuple(r) for r in got] == [("12.5%", "1,234,567", "0.123"), ("n/a", "0", "nan")]


def test_file_period(spark):
    cases = {
        ("/in/2025_01_deskcount.xlsx", None): "2025-01",
        ("/in/2025-12_x.xlsx", "2024-03-03"): "2025-12",
        ("/in/x.xlsx", "2024-03-03"): "2024-03",
        ("/in/2024/March Deskcount.xlsx", None): "2024-03",
        ("/in/2024/March Deskcount.xlsx", "2023-07-01"): "2023-07",
        ("/in/2024/june july.xlsx", None): "2024-06",
        ("/in/March Deskcount.xlsx", None): None,
        ("/in/2024/x.xlsx", None): None,
        ("/in/2025_13.xlsx", None): None,
    }
    df = spark.createDataFrame([(i, *k) for i, k in enumerate(cases)], "i int, p string, d string")
    got = df.select("i", periods.file_period(F.col("p"), F.col("d").cast("date")).alias("v")).orderBy("i")
    assert [r.v for r in got.collect()] == list(cases.values())


def test_dates_by_shape_equal_all_attempts(spark):
    """Trying only the layouts of a text's shape gives what trying every layout does."""
    rng = random.Random(4)
    day = lambda: dt.datetime(rng.choice([1999, 2024]), rng.randrange(1, 13), rng.randrange(1, 29), rng.randrange(24), rng.randrange(60))
    layouts = ["%m/%d/%Y", "%m/%d/%Y %H:%M", "%m/%d/%Y %H:%M:%S", "%m/%d/%Y %I:%M %p", "%m/%d/%Y %I:%M:%S %p", "%m/%d/%y"]
    layouts += ["%m-%d-%Y", "%Y/%m/%d", "%Y%m%d", "%d-%b-%Y", "%B %d, %Y", "%Y-%m-%d", "%Y-%m-%dT%H:%M"]
    texts = [day().strftime(rng.choice(layouts)) for _ in range(400)]
    texts += ["".join(rng.choice(t) if rng.random() < 0.2 else x for x in t) for t in texts]
    texts += ["".join(rng.choice("0123456789/-: ,aApPmMJjnN+.") for _ in range(rng.randrange(12))) for _ in range(1500)]
    texts += [re.sub(r"\b0", "", t) for t in texts] + [t.lower() for t in texts] + ["1/2/2024 3:04 a.m.", "+20240102", "0003/1/2024"]
    text = F.trim("t")
    every = [text.try_cast("date")]
    every += [F.try_to_timestamp(F.upper(text), F.lit(layout)).cast("date") for layout, _, _ in parse._DATE_LAYOUTS]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    both = frame.select(
        "t",
        parse.date_or_null(F.col("t")).cast("string").alias("ours"),
        F.coalesce(*every, parse._named_month(text)).cast("string").alias("all"),
    )
    found = both.collect()
    assert [r for r in found if r.ours != r.all] == []
    assert sum(r.ours is not None for r in found) > 600
