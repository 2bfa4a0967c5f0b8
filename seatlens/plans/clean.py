"""Raw feeds to clean visits and clean capacity snapshots."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatlens.functions import days, parse, text
from seatlens.operators.dedup import keep_first
from seatlens.schemas import DESKCOUNT, OCCUPANCY, ROW_ORDER, Feed, quoted

INCLUDE_FLAG = "Include in Occupancy Calculation"


def _require(df: DataFrame, feed: Feed) -> None:
    missing = [c for c in feed.required if c not in df.columns]
    if missing:
        raise ValueError(f"{feed.name} feed lacks columns {missing}")


def first_visits(raw: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """One row per person, day and office, with the line of business as recorded."""
    _require(raw, OCCUPANCY)
    renamed = raw.select(
        F.col("Username").alias("username"),
        text.location_or_null(F.col("OfficeLocation")).alias("office_location"),
        F.col("LineOfBusiness").alias("line_of_business"),
        F.col("OfficeLocationCityState").alias("city_state_country_region"),
        parse.as_date(F.col("LogonDate"), raw.schema["LogonDate"].dataType).alias("logon_date"),
        F.col("DayofWeek").alias("day_of_week"),
        F.col("JobFamily").alias("job_family"),
        *order,
    )
    return keep_first(renamed, ["username", "logon_date", "office_location"], order).drop(*order)


def clean_occupancy(raw: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """Clean visits: normalised, de-duplicated, then anonymised."""
    day = F.col("logon_date")
    return first_visits(raw, order).select(
        F.lit(1).alias("username"),
        "office_location",
        text.standardize_lob(F.col("line_of_business")).alias("line_of_business"),
        "city_state_country_region",
        "logon_date",
        "day_of_week",
        "job_family",
        F.year(day).alias("year"),
        F.month(day).alias("month"),
        days.week_in_month(day).alias("week_in_month"),
    )


def include_flag(raw: DataFrame) -> Column | None:
    """The include flag from all columns that are named so but for case and blanks; None without one."""
    named = [quoted(c) for c in raw.columns if c.strip().lower() == INCLUDE_FLAG.lower()]
    return F.coalesce(*named) if named else None


def included(raw: DataFrame) -> DataFrame:
    """Rows whose include flag says yes; all rows when there is no such column."""
    flag = include_flag(raw)
    return raw if flag is None else raw.where(text.same_text(flag, "yes"))


def clean_deskcount(raw: DataFrame, order: Sequence[str] = ()) -> DataFrame:
    """Clean capacity snapshots; ``order`` columns are kept for tie-breaking.

    A desk count that is no positive number is missing, not zero. A snapshot
    without a date cannot be placed in time and fails the job.
    """
    _require(raw, DESKCOUNT)
    desks = parse.positive_or_null(parse.number_or_null(F.col("Deskcount")))
    day = parse.as_date(F.col("Date"), raw.schema["Date"].dataType)
    undated = F.raise_error("capacity snapshot without a date").cast("date")
    return included(raw).select(
        text.location_or_null(F.col("OfficeLocation")).alias("office_location"),
        parse.whole_or_error(desks).alias("deskcount"),
        F.coalesce(day, undated).alias("date"),
        *order,
    )


def lob_frequency(raw: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """How often each line of business occurs before and after standardising.

    Missing is a bucket of its own. One pass over the visits: the counts per
    recorded value are added up again under the standard name.
    """
    recorded = (
        first_visits(raw, order).groupBy("line_of_business").agg(F.count("*").alias("visits"))
    )
    both = F.array(
        F.struct(F.lit("before").alias("stage"), F.col("line_of_business")),
        F.struct(
            F.lit("after").alias("stage"),
            text.standardize_lob(F.col("line_of_business")).alias("line_of_business"),
        ),
    )
    return (
        recorded.select(F.explode(both).alias("v"), "visits")
        .groupBy("v.stage", "v.line_of_business")
        .agg(F.sum("visits").alias("visits"))
    )
