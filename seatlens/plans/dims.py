"""Date, location and line-of-business dimensions."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatlens.functions import days, parse, text
from seatlens.operators.keys import dense_keys
from seatlens.schemas import ROW_ORDER, TABLES, conform


@dataclass(frozen=True)
class Calendar:
    """First and last day the date dimension covers."""

    first: dt.date = dt.date(2024, 1, 1)
    last: dt.date = dt.date(2027, 12, 31)


def dim_date(spark: SparkSession, calendar: Calendar = Calendar()) -> DataFrame:
    """The date dimension between two fixed days."""
    bounds = spark.range(1).select(
        F.lit(calendar.first).alias("first_date"), F.lit(calendar.last).alias("last_date")
    )
    return dim_date_between(bounds)


def dim_date_between(bounds: DataFrame) -> DataFrame:
    """The date dimension between first_date and last_date of a one-row frame."""
    span = days.days_between(F.col("first_date"), F.col("last_date"))
    d = F.col("date")
    described = bounds.select(F.explode(span).alias("date")).select(
        days.date_key(d).alias("date_key"),
        d,
        F.date_format(d, "yyyy-MM-dd").alias("date_string"),
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.date_format(d, "MMMM").alias("month_name"),
        F.weekofyear(d).alias("week_of_year"),
        days.week_in_month(d).alias("week_in_month"),
        F.day(d).alias("day"),
        days.day_of_week(d).alias("day_of_week"),
        F.date_format(d, "EEEE").alias("day_name"),
        F.dayofyear(d).alias("day_of_year"),
        days.is_weekend(d).alias("is_weekend"),
    )
    return conform(described, TABLES["dim_date"])


def latest_area(desk_raw: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """The newest known floor area of each office, by snapshot date.

    Spellings of one office are merged first, and snapshots count whether or
    not they are included in the occupancy calculation. Without a column of
    areas none is known.
    """
    area = F.col("RSF") if "RSF" in desk_raw.columns else F.lit(None).cast("string")
    day = parse.as_date(F.col("Date"), desk_raw.schema["Date"].dataType)
    rows = desk_raw.select(
        text.location_or_null(F.col("OfficeLocation")).alias("office_location"),
        parse.number_or_null(area).cast("int").alias("RSF"),
        day.alias("date"),
        *order,
    ).where(F.col("office_location").isNotNull())
    known = F.when(F.col("RSF").isNotNull(), F.struct("date", *order))
    return rows.groupBy("office_location").agg(
        F.max_by("RSF", known).alias("RSF"), F.max("date").alias("latest_date")
    )


def dim_location(visits: DataFrame, desk_raw: DataFrame, order: Sequence[str] = ROW_ORDER) -> DataFrame:
    """Visited offices, numbered in name order, with their floor area or 0.

    ``visits`` is anything with an office_location per visit or group of them.
    """
    offices = visits.select("office_location").distinct()
    offices = offices.select(text.location_or_null(F.col("office_location")).alias("office_location"))
    keyed = dense_keys(offices, "office_location", "location_key")
    areas = latest_area(desk_raw, order).select("office_location", "RSF")
    joined = keyed.join(areas, "office_location", "left")
    filled = joined.withColumn("RSF", F.coalesce("RSF", F.lit(0)))
    return conform(filled, TABLES["dim_location"])


def dim_line_of_business(visits: DataFrame) -> DataFrame:
    """Lines of business, numbered in name order."""
    keyed = dense_keys(visits, "line_of_business", "lob_key")
    return conform(keyed, TABLES["dim_line_of_business"])
