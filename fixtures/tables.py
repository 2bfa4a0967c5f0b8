"""Raw feeds derived from the TPC-H-like test tables.

Two variants: ``events`` gives a month of badge events with messy texts,
``orders`` gives six years of visits. Both keep every row of their tables.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seatlens.operators.grid import Window
from seatlens.plans import clean, dims, facts
from seatlens.plans.dims import Calendar
from seatlens.session import stage

# The test tables' primary key stands for the position in the input.
ORDER = ("seq",)

# The tables' columns, stated so that reading them costs no inference job.
_COLUMNS = {
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
}


@dataclass(frozen=True)
class Raw:
    visits: DataFrame
    desks: DataFrame
    calendar: Calendar


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _office() -> F.Column:
    return F.replace("n_name", F.lit("_"), F.lit(" "))


def _visitors(spark: SparkSession, sf_dir: str, facts: DataFrame, user: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    people = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return facts.join(people, F.col(user) == F.col("c_custkey"))


def events_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _visitors(spark, sf_dir, table(spark, sf_dir, "events"), "user_id")
    spelling = F.col("event_id") % 3
    wide = F.concat(F.lit("  "), F.replace("n_name", F.lit("_"), F.lit("   ")), F.lit(" "))
    office = (
        F.when(spelling == 0, _office())
        .when(spelling == 1, wide)
        .otherwise(F.concat(_office(), F.lit(".,")))
    )
    kind = F.col("event_type")
    lob = (
        F.when(kind == "signup", F.lit(None))
        .when(kind == "error", "Pending")
        .when(kind == "view", "Development & Construction")
        .otherwise(kind)
    )
    return joined.select(
        F.col("user_id").alias("Username"),
        office.alias("OfficeLocation"),
        lob.alias("LineOfBusiness"),
        F.col("n_name").alias("OfficeLocationCityState"),
        F.to_date("ts").alias("LogonDate"),
        F.date_format("ts", "EEEE").alias("DayofWeek"),
        F.col("c_mktsegment").alias("JobFamily"),
        F.col("event_id").alias("seq"),
    )


def orders_visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = _visitors(spark, sf_dir, table(spark, sf_dir, "orders"), "o_custkey")
    return joined.select(
        F.col("o_custkey").alias("Username"),
        _office().alias("OfficeLocation"),
        F.col("c_mktsegment").alias("LineOfBusiness"),
        F.col("n_name").alias("OfficeLocationCityState"),
        F.to_date("o_orderdate").alias("LogonDate"),
        F.date_format("o_orderdate", "EEEE").alias("DayofWeek"),
        F.col("o_orderpriority").alias("JobFamily"),
        F.col("o_orderkey").alias("seq"),
    )


def _desks(spark: SparkSession, sf_dir: str, date: F.Column, per_desk: int) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    key = F.col("s_suppkey")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        _office().alias("OfficeLocation"),
        F.col("s_name").alias("Address"),
        F.floor(F.col("s_acctbal") / per_desk).alias("Deskcount"),
        F.when(key % 7 != 0, key * 100).alias("RSF"),
        date.alias("Date"),
        F.when(key % 10 == 9, "No")
        .when(key % 10 == 4, " yes ")
        .otherwise("Yes")
        .alias("Include in Occupancy Calculation"),
        key.alias("seq"),
    )


def events_desks(spark: SparkSession, sf_dir: str) -> DataFrame:
    week = (F.col("s_suppkey") % 4).cast("int")
    return _desks(spark, sf_dir, F.date_add(F.lit(dt.date(2024, 1, 1)), week * 7), 500)


def orders_desks(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = (F.col("s_suppkey") % 60).cast("int")
    return _desks(spark, sf_dir, F.add_months(F.lit(dt.date(1995, 3, 1)), month), 2500)


def raw_feeds(spark: SparkSession, sf_dir: str, variant: str = "events") -> Raw:
    if variant == "events":
        return Raw(events_visits(spark, sf_dir), events_desks(spark, sf_dir), Calendar())
    longer = Calendar(dt.date(1995, 1, 1), dt.date(2001, 12, 31))
    return Raw(orders_visits(spark, sf_dir), orders_desks(spark, sf_dir), longer)


class Build:
    """The steps of a build over the test tables, each made when first used.

    The count per day, office and business and the snapshots are staged, as
    the whole build does it, so every later step starts from them.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, variant: str = "events") -> None:
        self.spark = spark
        self.raw = raw_feeds(spark, sf_dir, variant)

    @cached_property
    def visits(self) -> DataFrame:
        return clean.clean_occupancy(self.raw.visits, ORDER)

    @cached_property
    def daily(self) -> DataFrame:
        return stage(facts.daily_attendance(self.visits), "daily")

    @cached_property
    def snapshots(self) -> DataFrame:
        return stage(clean.clean_deskcount(self.raw.desks, ORDER), "snapshots")

    @cached_property
    def locations(self) -> DataFrame:
        return dims.dim_location(self.daily, self.raw.desks, ORDER)

    @cached_property
    def lobs(self) -> DataFrame:
        return dims.dim_line_of_business(self.daily)

    @cached_property
    def coverage(self) -> DataFrame:
        return facts.coverage_window(self.daily, self.snapshots, self.raw.calendar)

    @cached_property
    def window(self) -> Window:
        return facts.resolve_window(self.daily, self.snapshots, self.raw.calendar)

    def grid(self, by_lob: bool) -> DataFrame:
        lobs = self.lobs if by_lob else None
        return facts.dense_attendance(self.daily, self.window, self.locations, lobs)

    def office_days(self, by_lob: bool) -> DataFrame:
        lobs = self.lobs if by_lob else None
        return facts.office_days(self.daily, self.snapshots, self.locations, self.window, ORDER, lobs)

    @cached_property
    def aggregated(self) -> DataFrame:
        return facts.fact_occupancy_aggregated(self.office_days(by_lob=False))

    @cached_property
    def fact(self) -> DataFrame:
        return facts.fact_occupancy(self.office_days(by_lob=True), self.lobs)
