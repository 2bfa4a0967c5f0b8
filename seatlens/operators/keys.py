"""Dense integer keys over sorted distinct values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from seatlens.session import stage, task_slots


def dense_keys(df: DataFrame, column: str, key: str) -> DataFrame:
    """Number the distinct non-null values 1, 2, 3, … in code-point order.

    The values are cut into ranges and numbered range by range, so no task sees
    them all; one offset per range comes before the number within it. The ranges
    are written once, so that every consumer of the key sees the same numbering
    and none repeats the distinct over its input. The null is dropped from the
    written values: a filter before would be pushed down to the input and compute
    the column's expression once more per row.
    """
    ranges = task_slots(df.sparkSession)
    values = df.select(column).distinct().repartitionByRange(ranges, column)
    sliced = stage(values.withColumn("_slice", F.spark_partition_id()), key).where(F.col(column).isNotNull())
    before = W.orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.count("*").alias("_size"))
        .select("_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    place = F.row_number().over(W.partitionBy("_slice").orderBy(column))
    # One offset per slice: at most as many rows as there are task slots.
    return sliced.join(F.broadcast(offsets), "_slice").select(
        (F.col("_offset") + place).cast("int").alias(key), column
    )
