"""Data-quality report on the finished facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seatlens.functions import text

_ISSUE_COLUMNS = ["date", "office_location", "line_of_business", "attendance_count", "deskcount"]


def _visited() -> Column:
    return F.col("attendance_count") > 0


def _merge_issue() -> Column:
    return _visited() & (F.col("deskcount") == 0)


def _over_capacity() -> Column:
    return F.col("occupancy_rate") > 1.0


def merge_issues(fact: DataFrame) -> DataFrame:
    """Rows with attendance against zero desks.

    Cleaning turns zero into missing, so a fact of this library has none; see
    :func:`missing_capacity` for what that leaves behind.
    """
    return fact.where(_merge_issue()).select(_ISSUE_COLUMNS)


def missing_capacity(fact: DataFrame) -> DataFrame:
    """Rows with attendance where no desk count is known."""
    return fact.where(_visited() & F.col("deskcount").isNull()).select(_ISSUE_COLUMNS)


def over_capacity_days(fact: DataFrame) -> DataFrame:
    return fact.where(_over_capacity()).select(*_ISSUE_COLUMNS, "occupancy_rate")


def weekday_weekend_mean(fact: DataFrame) -> DataFrame:
    """Mean rate of weekdays and of weekends, unknown rates left out."""
    rate, weekend = F.col("occupancy_rate"), F.col("is_weekend")
    return fact.agg(
        F.avg(F.when(~weekend, rate)).alias("weekday_mean"),
        F.avg(F.when(weekend, rate)).alias("weekend_mean"),
    )


def recency_gap(daily: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Days between the newest capacity snapshot and the newest visit."""
    newest = daily.agg(F.max("date").alias("latest_occupancy"))
    desk = snapshots.agg(F.max("date").alias("date")).scalar()
    return newest.withColumn("latest_deskcount", desk).withColumn(
        "gap_days", F.datediff("latest_occupancy", "latest_deskcount")
    )


def by_location_summary(fact: DataFrame) -> DataFrame:
    """Per office, weekdays only: rows, mean rate, merge issues, over-capacity rows."""
    weekdays = fact.where(~F.col("is_weekend")) if "is_weekend" in fact.columns else fact
    return weekdays.groupBy("office_location").agg(
        F.count("*").alias("rows"),
        F.round(F.avg("occupancy_rate"), 4).alias("mean_occupancy_rate"),
        F.count_if(_merge_issue()).alias("merge_issues"),
        F.count_if(_over_capacity()).alias("over_capacity_days"),
    )


def worst_first(summary: DataFrame) -> DataFrame:
    """The by-office summary in report order."""
    return summary.orderBy(
        F.desc("merge_issues"),
        F.desc("over_capacity_days"),
        F.asc_nulls_last("mean_occupancy_rate"),
        F.asc("office_location"),
    )


def _fact_measures(fact: DataFrame) -> DataFrame:
    """One row of totals. Grouping by office and business first keeps the
    distinct counts off the fact itself."""
    rate, weekend = F.col("occupancy_rate"), F.col("is_weekend")
    weekday_rate, weekend_rate = F.when(~weekend, rate), F.when(weekend, rate)
    groups = fact.groupBy("office_location", "line_of_business").agg(
        F.count("*").alias("n"),
        F.min("date").alias("first"),
        F.max("date").alias("last"),
        F.sum(weekday_rate).alias("weekday_sum"),
        F.count(weekday_rate).alias("weekday_n"),
        F.sum(weekend_rate).alias("weekend_sum"),
        F.count(weekend_rate).alias("weekend_n"),
        F.count_if(_merge_issue()).alias("issues"),
        F.count_if(_over_capacity()).alias("over"),
    )

    def mean(kind: str) -> Column:
        known = F.sum(f"{kind}_n")
        return F.when(known > 0, F.sum(f"{kind}_sum") / known)

    return groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("fact_rows"),
        F.min("first").alias("fact_first"),
        F.max("last").alias("fact_last"),
        F.count_distinct("office_location").alias("offices"),
        F.count_distinct("line_of_business").alias("businesses"),
        mean("weekday").alias("weekday_mean"),
        mean("weekend").alias("weekend_mean"),
        F.coalesce(F.sum("issues"), F.lit(0)).alias("issues"),
        F.coalesce(F.sum("over"), F.lit(0)).alias("over"),
    )


def validation_summary(
    fact: DataFrame, aggregated: DataFrame, locations: DataFrame, daily: DataFrame, snapshots: DataFrame
) -> DataFrame:
    """The report's text, one numbered line per row.

    Every input is scanned once: each gives one row of measures, and the rows
    are folded into one.
    """
    measures = [
        _fact_measures(fact),
        aggregated.agg(
            F.count("*").alias("agg_rows"), F.min("date").alias("agg_first"), F.max("date").alias("agg_last")
        ),
        locations.agg(F.count("*").alias("dim_offices")),
        daily.agg(F.max("date").alias("last_visit")),
        snapshots.agg(F.max("date").alias("last_snapshot")),
    ]
    rows = measures[0]
    for other in measures[1:]:
        rows = rows.unionByName(other, allowMissingColumns=True)
    folded = rows.agg(*[F.max(c).alias(c) for c in rows.columns])

    def say(pattern: str, *parts: Column) -> Column:
        pieces = pattern.split("{}")
        line = [F.lit(pieces[0])]
        for part, after in zip(parts, pieces[1:], strict=True):
            line += [F.coalesce(part.cast("string"), F.lit("n/a")), F.lit(after)]
        return F.concat(*line)

    c = F.col
    # The report's texts.
    lines = [
        F.lit("== Summary =="),
        say("Fact rows: {}; Agg rows: {}", text.thousands(c("fact_rows")), text.thousands(c("agg_rows"))),
        say("Fact date range: {} to {}", c("fact_first"), c("fact_last")),
        say("Agg date range: {} to {}", c("agg_first"), c("agg_last")),
        say("Locations: {} (dim: {})", c("offices"), c("dim_offices")),
        say("LOBs: {} (in fact)", c("businesses")),
        say(
            "Mean occupancy (weekday): {}; (weekend): {}",
            text.mean_text(c("weekday_mean")),
            text.mean_text(c("weekend_mean")),
        ),
        say(
            "Rows with attendance>0 and deskcount==0: {} ({})",
            text.thousands(c("issues")),
            text.percent_text(c("issues"), c("fact_rows")),
        ),
        say(
            "Rows with occupancy_rate > 1.0: {} ({})",
            text.thousands(c("over")),
            text.percent_text(c("over"), c("fact_rows")),
        ),
        say(
            "Latest occupancy: {}, latest deskcount: {}, gap: {} days",
            c("last_visit"),
            c("last_snapshot"),
            F.datediff("last_visit", "last_snapshot"),
        ),
    ]
    return folded.select(F.posexplode(F.array(*lines)).alias("ord", "line"))


def quality_report(
    fact: DataFrame, aggregated: DataFrame, locations: DataFrame, daily: DataFrame, snapshots: DataFrame
) -> dict[str, DataFrame]:
    """All reports by name."""
    return {
        "validation_summary": validation_summary(fact, aggregated, locations, daily, snapshots),
        "deskcount_merge_issues": merge_issues(fact),
        "missing_capacity": missing_capacity(fact),
        "over_capacity_days": over_capacity_days(fact),
        "by_location_summary": by_location_summary(fact),
    }
