"""Profiles of tables: counts, ranges, nulls, flag shares, samples."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seatlens.schemas import quoted


def flag_distribution(fact: DataFrame) -> DataFrame:
    """Rows per hybrid flag and their share in percent."""
    counts = fact.groupBy("is_hybrid_day").agg(F.count("*").alias("rows"))
    # Three rows at most, so the window over all of them is no bottleneck.
    whole = F.sum("rows").over(W.partitionBy())
    return counts.withColumn("share_pct", F.round(F.col("rows") * 100.0 / whole, 1))


def fact_profile(fact: DataFrame) -> DataFrame:
    """One row: extent, attendance range, days with and without attendance.

    Grouped by office first, so that the distinct count sees offices, not rows.
    """
    attendance = F.col("attendance_count")
    per_office = fact.groupBy("office_location").agg(
        F.count("*").alias("n"),
        F.min("date_key").alias("lo"),
        F.max("date_key").alias("hi"),
        F.min(attendance).alias("least"),
        F.max(attendance).alias("most"),
        F.sum(attendance).alias("total"),
        F.count_if(attendance == 0).alias("zero"),
        F.count("deskcount").alias("capacity"),
    )
    return per_office.agg(
        F.sum("n").alias("rows"),
        F.count_distinct("office_location").alias("offices"),
        F.min("lo").alias("first_date_key"),
        F.max("hi").alias("last_date_key"),
        F.min("least").alias("min_attendance"),
        F.max("most").alias("max_attendance"),
        F.sum("total").alias("total_attendance"),
        F.sum("zero").alias("rows_without_attendance"),
        (F.sum("n") - F.sum("zero")).alias("rows_with_attendance"),
        F.sum("capacity").alias("rows_with_capacity"),
    )


def dim_profile(locations: DataFrame) -> DataFrame:
    """One row: key range and floor area of the location dimension."""
    return locations.agg(
        F.count("*").alias("offices"),
        F.min("location_key").alias("first_key"),
        F.max("location_key").alias("last_key"),
        F.min("RSF").alias("min_rsf"),
        F.max("RSF").alias("max_rsf"),
        F.sum("RSF").alias("total_rsf"),
    )


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column, in one pass."""
    counted = df.agg(*[F.count_if(quoted(c).isNull()).alias(c) for c in df.columns])
    pairs = [F.struct(F.lit(c).alias("column"), quoted(c).alias("nulls")) for c in df.columns]
    return counted.select(F.inline(F.array(*pairs)))


def calendar_profile(dim_date: DataFrame) -> DataFrame:
    """One row: extent of the calendar in days, years and keys."""
    return dim_date.agg(
        F.count("*").alias("days"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.min("date_key").alias("first_key"),
        F.max("date_key").alias("last_key"),
        F.count_distinct("year").alias("years"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
    )


def business_profile(lobs: DataFrame) -> DataFrame:
    """One row: number of lines of business and their key range."""
    return lobs.agg(
        F.count("*").alias("businesses"), F.min("lob_key").alias("first_key"), F.max("lob_key").alias("last_key")
    )


def step_counts(steps: dict[str, int], spark: SparkSession) -> DataFrame:
    """Rows per build step, from numbers observed."""
    return spark.createDataFrame(list(steps.items()), "step string, rows bigint")


def sample(fact: DataFrame, n: int, *order: str) -> DataFrame:
    """The first ``n`` rows in the given order (a top-n, not a full sort)."""
    return fact.orderBy(*order).limit(n)


def office_slice(fact: DataFrame, office: str) -> DataFrame:
    return fact.where(F.col("office_location") == office)
