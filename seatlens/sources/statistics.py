"""Counts and ranges of written tables from the statistics of their Parquet files.

Spark's file reader of the newer kind answers counts, minima and maxima from file
footers, without reading rows, where every aggregate is one that footers have:
counts of any column, ranges of numbers and dates. It is used through a session of
its own, so that the caller's settings stay as they are. What footers can't tell
(sums, distinct values, ranges of texts) is left to a scan of just those columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatlens.schemas import quoted

# Fractions are left out: a file that holds a NaN has no range of them.
_RANGED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.DateType, T.BooleanType)


def footers(spark: SparkSession, path: str) -> DataFrame:
    """A table that answers pushed aggregates from its files' footers."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path)


def is_pushed(aggregated: DataFrame) -> bool:
    """Whether a query over ``footers`` gets its aggregates from the files and reads no rows."""
    return "PushedAggregation: [" in _explained(aggregated) and "PushedAggregation: []" not in _explained(aggregated)


def _explained(df: DataFrame) -> str:
    utils = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils
    return utils.explainString(df._jdf.queryExecution(), "formatted")


def null_counts(spark: SparkSession, path: str) -> DataFrame:
    """(column, nulls) of a written table: its rows less the values that footers count."""
    table = footers(spark, path)
    counted = table.agg(F.count("*").alias("rows"), *[F.count(quoted(c)).alias(f"n{i}") for i, c in enumerate(table.columns)])
    # A table of empty files only has no footer to count in.
    nulls = lambda i: F.greatest(F.col("rows") - F.col(f"n{i}"), F.lit(0)).cast("long").alias("nulls")
    pairs = [F.struct(F.lit(c).alias("column"), nulls(i)) for i, c in enumerate(table.columns)]
    return counted.select(F.inline(F.array(*pairs)))


def extremes(table: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, least, most) as texts: one row of aggregates, unfolded."""
    found = table.agg(*[f(quoted(c)).alias(f"{n}{i}") for i, c in enumerate(columns) for n, f in (("lo", F.min), ("hi", F.max))])
    text = lambda name: F.col(name).cast("string")
    pairs = [
        F.struct(F.lit(c).alias("column"), text(f"lo{i}").alias("least"), text(f"hi{i}").alias("most")) for i, c in enumerate(columns)
    ]
    return found.select(F.inline(F.array(*pairs)))


def ranges(spark: SparkSession, path: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """(column, least, most) as texts, of whole numbers, dates and flags.

    Columns without a null have a range in every file's footer and are answered from
    there; of the others, where a file may have no value, just the columns are scanned.
    Columns that the table is partitioned by are in folder names, not in files; they are
    left out. Small jobs run: one row comes to the driver from each.
    """
    table = footers(spark, path)
    kept = [f.name for f in table.schema if isinstance(f.dataType, _RANGED) and f.name not in partition_by]
    nulls = {r.column: r.nulls for r in null_counts(spark, path).collect()}
    full, others = [c for c in kept if not nulls[c]], [c for c in kept if nulls[c]]
    parts = [(table, full), (spark.read.parquet(path), others)]
    rows = [tuple(r) for source, columns in parts if columns for r in extremes(source, columns).collect()]
    return spark.createDataFrame(rows, "column string, least string, most string")
