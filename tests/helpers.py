from __future__ import annotations

import datetime as dt


def day(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def rows(df, *columns):
    """All rows as a sorted list of tuples, nulls first."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(v is not None, v) for v in t])


def values(spark, texts, expression):
    """The expression's value for each text, in order."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(list(enumerate(texts)), "i int, c string")
    return [r.v for r in df.select("i", expression(F.col("c")).alias("v")).orderBy("i").collect()]
