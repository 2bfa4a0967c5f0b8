"""Backward as-of join on a day column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T


def newest_per_day(
    right: DataFrame, on: str, by: Sequence[str], values: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """One row per key and day; of several, the last in ``order`` counts.

    The values travel in a struct ``payload`` so that a null value of the
    newest row is kept rather than skipped.
    """
    payload = F.max_by(F.struct(*values), F.struct(*order))
    return right.groupBy(*by, on).agg(payload.alias("payload"))


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    by: Sequence[str],
    values: Sequence[str],
    order: Sequence[str],
) -> DataFrame:
    """Attach to each left row the newest right row not after it, per ``by`` key.

    Rows without an earlier match get nulls. The lookup is done once per
    distinct (key, day): both sides together shrink to one row per key and day,
    beginning inside each map task, before any ordering. The ordered window
    over a key is so never longer than the calendar, however many rows it has.
    """
    for side in (left, right):
        if not isinstance(side.schema[on].dataType, T.DateType):
            raise TypeError(f"as-of column {on} must be a DATE")
    known = right.select(
        *by, on, F.struct(*values).alias("_values"), F.struct(*order).alias("_order"), F.lit(False).alias("_asked")
    )
    asked = left.select(*by, on, F.lit(True).alias("_asked"))
    # A question has no order, and max_by passes over rows without one.
    days = (
        known.unionByName(asked, allowMissingColumns=True)
        .groupBy(*by, on)
        .agg(F.max_by("_values", "_order").alias("payload"), F.max("_asked").alias("_asked"))
    )
    so_far = W.partitionBy(*by).orderBy(on).rowsBetween(W.unboundedPreceding, 0)
    answers = (
        days.withColumn("payload", F.last("payload", ignorenulls=True).over(so_far))
        .where("_asked")
        .select(*by, on, "payload")
    )
    return left.join(answers, [*by, on], "left").select(
        *[left[c] for c in left.columns], *[F.col(f"payload.{v}").alias(v) for v in values]
    )
