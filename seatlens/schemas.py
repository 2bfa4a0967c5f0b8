"""Column contracts of the raw feeds and of the published tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Every raw row carries its place in the input, because keep-first, latest and
# tie-breaking rules are defined on input order and a DataFrame has none.
ROW_ORDER = ("source_file", "source_block", "row_pos")


@dataclass(frozen=True)
class Feed:
    """A raw feed: its folder name, its date column and required columns."""

    name: str
    date_column: str
    required: tuple[str, ...]
    optional: tuple[str, ...] = ()

    @property
    def columns(self) -> list[str]:
        return [*self.required, *self.optional]


OCCUPANCY = Feed(
    "Occupancy",
    "LogonDate",
    (
        "Username",
        "OfficeLocation",
        "LineOfBusiness",
        "OfficeLocationCityState",
        "LogonDate",
        "DayofWeek",
        "JobFamily",
    ),
)
DESKCOUNT = Feed(
    "Deskcount",
    "Date",
    ("OfficeLocation", "Deskcount", "Date"),
    ("Address", "RSF", "Include in Occupancy Calculation"),
)
FEEDS = {feed.name: feed for feed in (OCCUPANCY, DESKCOUNT)}


_TYPES = {
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "string": T.StringType(),
}


def _struct(columns: str) -> T.StructType:
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TABLES: dict[str, T.StructType] = {
    "occupancy_clean": _struct(
        "username int, office_location string, line_of_business string,"
        " city_state_country_region string, logon_date date, day_of_week string,"
        " job_family string, year int, month int, week_in_month int"
    ),
    "deskcount_clean": _struct("office_location string, deskcount int, date date"),
    "dim_date": _struct(
        "date_key int, date date, date_string string, year int, quarter int, month int,"
        " month_name string, week_of_year int, week_in_month int, day int, day_of_week int,"
        " day_name string, day_of_year int, is_weekend boolean"
    ),
    "dim_location": _struct("location_key int, office_location string, RSF int"),
    "dim_line_of_business": _struct("lob_key int, line_of_business string"),
    "fact_occupancy": _struct(
        "date_key int, location_key int, lob_key int, date date, office_location string,"
        " line_of_business string, year int, month int, is_weekend boolean,"
        " attendance_count bigint, deskcount int, occupancy_rate double, is_hybrid_day boolean"
    ),
    "fact_occupancy_aggregated": _struct(
        "date_key int, location_key int, date date, office_location string, year int,"
        " month int, is_weekend boolean, attendance_count bigint, deskcount int,"
        " occupancy_rate double, is_hybrid_day boolean"
    ),
}

# The published form narrows the count to the type its consumers were given.
PUBLISHED_AGGREGATED = _struct(
    "date_key int, location_key int, date date, office_location string, year int,"
    " month int, is_weekend boolean, attendance_count int, deskcount int,"
    " occupancy_rate double, is_hybrid_day boolean"
)


def conform(df: DataFrame, contract: T.StructType) -> DataFrame:
    """Select the contract's columns in order, cast to the contract's types."""
    return df.select(*[quoted(f.name).cast(f.dataType).alias(f.name) for f in contract])


def quoted(name: str) -> Column:
    """A column by its literal name, dots and blanks included."""
    return F.col("`" + name.replace("`", "``") + "`")
