"""A rebuild of what late files touch equals a full build, and reads no other drop."""

from __future__ import annotations

import csv
import datetime as dt
import os
import random

import pytest

from seatlens.plans.dims import Calendar
from seatlens.plans.refresh import _mondays, refresh_csv
from seatlens.sources import versions
from seatlens.sources.workbooks import BadFiles
from tests.helpers import rows

HEADER = ["Username", "OfficeLocation", "LineOfBusiness", "OfficeLocationCityState", "LogonDate", "DayofWeek", "JobFamily"]
CALENDAR = Calendar(dt.date(2024, 1, 1), dt.date(2024, 12, 31))
TABLES = ["occupancy_clean", "deskcount_clean", "dim_date", "dim_location", "dim_line_of_business", "daily_attendance"]
TABLES += ["fact_occupancy", "fact_occupancy_aggregated", "drop_months"]


def drop(folder, month: str, visits: list[tuple]) -> None:
    path = folder / "Occupancy" / f"{month}_Occupancy.csv"
    path.parent.mkdir(parents=True, exist_ok=True)
    with path.open("w", newline="") as out:
        csv.writer(out).writerows([HEADER, *[[u, o, lob, "C", d, "D", "J"] for u, o, lob, d in visits]])
    changed.append(path)
    os.utime(path, (1_700_000_000 + 10 * len(changed),) * 2)


changed: list = []


def desks(folder, snapshots: list[tuple]) -> None:
    path = folder / "Deskcount" / "desks.csv"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("OfficeLocation,Deskcount,RSF,Date\n" + "".join(f"{o},{n},{r},{d}\n" for o, n, r, d in snapshots))


def month_of_visits(seed: int, month: int, offices="AB", many=40) -> list[tuple]:
    rng = random.Random(seed)
    day = lambda: f"2024-{month:02d}-{rng.randrange(1, 29):02d}"
    return [(f"u{rng.randrange(9)}", rng.choice(offices), rng.choice("xyz"), day()) for _ in range(many)]


def same_as_full(spark, folder, root, fresh) -> None:
    refresh_csv(spark, str(folder), fresh, CALENDAR)
    for name in TABLES:
        ours, full = versions.read(spark, root, name), versions.read(spark, fresh, name)
        assert ours.columns == full.columns, name
        assert rows(ours) == rows(full), name


@pytest.fixture
def built(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "marts")
    for month in range(1, 7):
        drop(folder, f"2024-{month:02d}", month_of_visits(month, month))
    desks(folder, [("A", 5, 100, "2024-01-01"), ("B", 7, 200, "2024-01-01"), ("A", 6, 100, "2024-04-10"), ("B", 8, 200, "2024-06-15")])
    first = refresh_csv(spark, str(folder), root, CALENDAR)
    assert first.drops is None and first.months is None and first.version.number == 1
    return folder, root, str(tmp_path / "full")


def test_nothing_changed(spark, built):
    folder, root, _ = built
    before = rows(versions.read(spark, root, "fact_occupancy"))
    again = refresh_csv(spark, str(folder), root, CALENDAR)
    assert again.drops == [] and again.months == [] and again.version.number == 2
    assert rows(versions.read(spark, root, "fact_occupancy")) == before


def test_late_file_touches_its_weeks_only(spark, built):
    folder, root, full = built
    drop(folder, "2024-03", month_of_visits(33, 3, many=55))
    late = refresh_csv(spark, str(folder), root, CALENDAR)
    assert late.drops == ["2024-03"]
    # the week of 26 February reaches March; March ends on a Sunday
    assert late.months == ["2024-02", "2024-03"]
    parts = late.version.parts["fact_occupancy"]
    assert {p for p, v in parts.items() if v == late.version.name} == {"year=2024/month=2", "year=2024/month=3"}
    scanned = versions.read(spark, root, "fact_occupancy").where("month = 3").inputFiles()
    assert len(parts) == 6 and scanned
    same_as_full(spark, folder, root, full)


def test_visits_of_other_months_and_a_file_that_is_gone(spark, built):
    folder, root, full = built
    stray = [("u1", "A", "x", "2024-05-02"), ("u1", "A", "y", "2024-02-07"), ("u2", "B", "x", "")]
    drop(folder, "2024-02", month_of_visits(22, 2) + stray)
    one = refresh_csv(spark, str(folder), root, CALENDAR)
    assert one.drops == ["2024-02", "2024-05"]  # a person's day in May may be in either file
    same_as_full(spark, folder, root, f"{full}1")
    (folder / "Occupancy" / "2024-02_Occupancy.csv").unlink()
    two = refresh_csv(spark, str(folder), root, CALENDAR)
    assert "2024-05" in two.drops and "2024-03" not in two.drops
    same_as_full(spark, folder, root, f"{full}2")
    assert len(versions.vacuum(spark, root, keep=1)) <= 1  # what the manifest still needs stays
    same_as_full(spark, folder, root, f"{full}3")


def test_changed_snapshot_reaches_up_to_the_next(spark, built):
    folder, root, full = built
    desks(folder, [("A", 50, 100, "2024-01-01"), ("B", 7, 200, "2024-01-01"), ("A", 6, 100, "2024-04-10"), ("B", 8, 200, "2024-06-15")])
    late = refresh_csv(spark, str(folder), root, CALENDAR)
    assert late.drops == [] and late.months == ["2024-01", "2024-02", "2024-03", "2024-04"]
    same_as_full(spark, folder, root, full)


def test_new_month_and_new_office(spark, built):
    folder, root, full = built
    drop(folder, "2024-07", month_of_visits(7, 7))
    desks(folder, [("A", 5, 100, "2024-01-01"), ("B", 7, 200, "2024-01-01"), ("A", 6, 100, "2024-04-10"), ("B", 8, 200, "2024-07-15")])
    longer = refresh_csv(spark, str(folder), root, CALENDAR)
    assert longer.drops == ["2024-07"] and "2024-07" in longer.months and "2024-03" not in longer.months
    same_as_full(spark, folder, root, f"{full}1")
    drop(folder, "2024-05", month_of_visits(5, 5, offices="ABC"))
    office = refresh_csv(spark, str(folder), root, CALENDAR)
    assert office.drops == ["2024-05"] and office.months == ["2024-04", "2024-05", "2024-06"] or office.months is None
    same_as_full(spark, folder, root, f"{full}2")


def test_an_unusable_file_leaves_the_version(spark, built):
    folder, root, _ = built
    (folder / "Occupancy" / "2024-04_Occupancy.csv").write_text("Username\nx,y,z\n")
    with pytest.raises(BadFiles):
        refresh_csv(spark, str(folder), root, CALENDAR)
    assert versions.current(spark, root).number == 1


def test_mondays_of_months():
    assert _mondays(["2024-03", ""])[0] == dt.date(2024, 2, 26) and _mondays(["2024-03"])[-1] == dt.date(2024, 3, 25)
