
from __future__ import annotations

import importlib
import os
import sys
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

import oracle_queries  # noqa: E402
from fixtures.files import write_csv_texts, write_workbooks  # noqa: E402
from fixtures.tables import ORDER, Build, orders_desks, table  # noqa: E402
from seatlens.functions import parse, text  # noqa: E402
from seatlens.functions.days import occupancy_rate as rate  # noqa: E402
from seatlens.operators import hybrid  # noqa: E402
from seatlens.operators.grid import calendar_days  # noqa: E402
from seatlens.plans import clean, dims, facts, marts, profile, quality, refresh  # noqa: E402
from seatlens.schemas import DESKCOUNT, OCCUPANCY, conform  # noqa: E402
from seatlens.session import new_folder, stage  # noqa: E402
from seatlens.sources import csv_feeds, files, periods, statistics, tables, versions, workbooks  # noqa: E402

Query = Callable[[SparkSession, str], DataFrame]

# The training-text operators are a part of their own: without it, or what it needs, the rest works.
_OPTIONAL = ("seatlens.llm", "corpus_pipeline", "public_tokenizers", "regex", "tokenizers", "sentencepiece")


def _optional(name: str):
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as missing:
        if not (missing.name or "").startswith(_OPTIONAL):
            raise
        return None


llm_queries, llm_sql, corpus_pipeline = map(_optional, ("seatlens.llm.queries", "seatlens.llm.sql", "corpus_pipeline"))
if llm_queries is None:
    llm_sql = corpus_pipeline = None


def entry(spark: SparkSession) -> DataFrame:
    """Attendance, capacity, rate and hybrid flag per day and office."""
    return Build(spark, "/root/testdata/sf0.001").aggregated


def normalize_location(b: Build) -> DataFrame:
    spelled = F.col("OfficeLocation")
    normal = b.raw.visits.groupBy(spelled.alias("spelled")).agg(F.count("*").alias("visits"))
    return normal.withColumn("office_location", text.location_or_null(F.col("spelled")))


def clean_deskcount(b: Build) -> DataFrame:
    return clean.clean_deskcount(b.raw.desks)


def dim_location(b: Build) -> DataFrame:
    return dims.dim_location(b.visits, b.raw.desks, ORDER)


def eligible_dates(b: Build) -> DataFrame:
    return hybrid.eligible_dates(calendar_days(b.spark, b.window))


def asof_capacity(b: Build) -> DataFrame:
    return facts.with_capacity(b.grid(by_lob=False), b.snapshots, ORDER)


def occupancy_rate(b: Build) -> DataFrame:
    known = asof_capacity(b).select("office_location", "date", "attendance_count", "deskcount")
    return known.withColumn("occupancy_rate", rate(F.col("attendance_count"), F.col("deskcount")))


def top3_days(b: Build) -> DataFrame:
    totals = hybrid.daily_totals(b.grid(by_lob=False))
    return hybrid.top_days(totals, eligible_dates(b))


def hybrid_flags(b: Build) -> DataFrame:
    grid = b.grid(by_lob=True).select("date", "office_location", "line_of_business", "attendance_count")
    return hybrid.hybrid_flags(grid, dates=calendar_days(b.spark, b.window))


def hybrid_flags_partial(b: Build) -> DataFrame:
    """Flags where every seventh date is missing and only the first half of the days is known."""
    grid = b.grid(by_lob=True).select("date", "date_key", "office_location", "line_of_business", "attendance_count")
    gone = F.when(F.col("date_key") % 7 != 0, F.col("date")).alias("date")
    fact = grid.select(gone, "office_location", "line_of_business", "attendance_count", "date_key")
    known = calendar_days(b.spark, b.window).where(F.day("date") <= 15)
    return hybrid.hybrid_flags(fact, dates=known)


def fact_sorted_export(b: Build) -> DataFrame:
    """Write the fact and the by-office report as sorted CSV; read them back with their row numbers."""
    folder = new_folder(b.spark, "export")
    tables.write_csv(b.fact, f"{folder}/fact", ["date_key", "office_location", "line_of_business"])
    tables.write_csv(quality.worst_first(quality.by_location_summary(b.fact)), f"{folder}/offices")

    def numbered(name: str, first: str, second: str) -> DataFrame:
        lines = b.spark.read.option("header", True).csv(f"{folder}/{name}")
        place = F.struct(F.col("_metadata.file_path").alias("f"), F.monotonically_increasing_id().alias("n"))
        rows = lines.select(F.lit(name).alias("export"), place.alias("place"), F.concat_ws("|", first, second).alias("row"))
        return rows.withColumn("number", F.row_number().over(Window.partitionBy("export").orderBy("place"))).drop("place")

    return numbered("fact", "date_key", "attendance_count").unionByName(numbered("offices", "office_location", "rows"))


def reports_roundtrip(b: Build) -> DataFrame:
    """Write the reports twice over the same folder, the second time for this build, and read them back."""
    folder = new_folder(b.spark, "reports")
    fact = stage(b.fact, "fact")
    written = quality.quality_report(fact, b.aggregated, b.locations, b.daily, b.snapshots)
    earlier = {**written, "deskcount_merge_issues": quality.missing_capacity(fact)}
    tables.write_reports(earlier, folder)
    names = tables.write_reports(written, folder)
    read = lambda n: b.spark.read.option("header", True).csv(f"{folder}/{n}")
    counts = [
        read(n).agg(F.lit(n).alias("report"), F.count("*").alias("rows")) for n in names if n != "validation_summary"
    ]
    lines = b.spark.read.text(f"{folder}/validation_summary").agg(F.lit("validation_summary").alias("report"), F.count("*").alias("rows"))
    return reduce(DataFrame.union, counts, lines)


def weekday_weekend_mean(b: Build) -> DataFrame:
    means = quality.weekday_weekend_mean(b.fact)
    return means.select(*[F.round(c, 6).alias(c) for c in means.columns])


def validation_summary(b: Build) -> DataFrame:
    """Both facts come from the same office days, which are worked out once."""
    days = stage(b.office_days(by_lob=True), "office_days")
    fact = facts.fact_occupancy(days, b.lobs)
    aggregated = facts.fact_occupancy_aggregated(days)
    return quality.validation_summary(fact, aggregated, b.locations, b.daily, b.snapshots)


def merge_issues_zero_filled(b: Build) -> DataFrame:
    """The merge check on a fact whose unknown capacity was read as zero."""
    return quality.merge_issues(b.fact.fillna(0, ["deskcount"]))


def fact_sample(b: Build) -> DataFrame:
    return profile.sample(b.fact, 10, "date_key", "office_location", "line_of_business")


def build(b: Build) -> marts.Marts:
    return marts.build_marts(b.raw.visits, b.raw.desks, b.raw.calendar, ORDER)


def publish_roundtrip(b: Build) -> DataFrame:
    """Publish the aggregated fact and read the table back."""
    name = "fact_occupancy_aggregated"
    b.spark.sql(f"CREATE DATABASE IF NOT EXISTS seatlens_check LOCATION '{new_folder(b.spark, 'db')}'")
    table_name = f"seatlens_check.{name}"
    tables.publish(b.aggregated, table_name, path=new_folder(b.spark, name))
    return conform(tables.require_table(b.spark, table_name), tables.PUBLISHED_AGGREGATED)


def null_profile_files(b: Build) -> DataFrame:
    """Nulls per column of the written fact, from its files' footers."""
    folder = new_folder(b.spark, "fact")
    b.fact.write.partitionBy("year", "month").parquet(folder)
    nulls = statistics.null_counts(b.spark, folder)
    if not statistics.is_pushed(nulls):
        raise AssertionError("the counts were not answered from file footers")
    return nulls


def range_profile_files(b: Build) -> DataFrame:
    """Ranges of the written fact's whole numbers, dates and flags, from its files' footers."""
    folder = new_folder(b.spark, "fact")
    b.fact.write.partitionBy("year", "month").parquet(folder)
    return statistics.ranges(b.spark, folder, ("year", "month"))


def publish_batches(b: Build) -> DataFrame:
    """The fact published in parts: years appended, each delivered twice, and one replaced by itself."""
    name = "seatlens_check.fact_by_batches"
    b.spark.sql(f"CREATE DATABASE IF NOT EXISTS seatlens_check LOCATION '{new_folder(b.spark, 'db')}'")
    fact = stage(b.aggregated, "aggregated")
    part = lambda condition: fact.where(condition)
    tables.publish(part("year < 1997"), name, path=new_folder(b.spark, "batches"))
    for again in (False, True):
        for condition in ("year = 1997", "year > 1997"):
            batch = part(condition)
            tables.publish(batch.orderBy("office_location") if again else batch, name, "append")
    tables.publish(part("year = 1998"), name, "replace")
    return conform(tables.require_table(b.spark, name), tables.PUBLISHED_AGGREGATED)


#: A number to add up per table, to compare whole tables by.
_TOTALS = {
    "occupancy_clean": "year * 100 + month",
    "deskcount_clean": "deskcount",
    "dim_date": "date_key",
    "dim_location": "location_key * 10 + RSF",
    "dim_line_of_business": "lob_key * length(line_of_business)",
    "fact_occupancy": "attendance_count * lob_key + coalesce(deskcount, 0)",
    "fact_occupancy_aggregated": "attendance_count * location_key + int(is_hybrid_day)",
}


def build_switch(b: Build) -> DataFrame:
    """A build, then one of other rows that breaks off half way: all tables are still the first one's."""
    root = new_folder(b.spark, "switched")
    marts.build_marts(b.raw.visits, b.raw.desks, b.raw.calendar, ORDER, root)
    no_area = b.raw.desks.withColumn("RSF", F.raise_error(F.lit("no area")).cast("bigint"))
    try:
        marts.build_marts(b.raw.visits.where("seq % 2 = 0"), no_area, b.raw.calendar, ORDER, root)
    except Exception as broken:  # noqa: BLE001
        if "no area" not in str(broken):
            raise
    parts = [
        versions.read(b.spark, root, name).agg(
            F.lit(name).alias("table"), F.count("*").alias("rows"), F.sum(F.expr(total)).cast("bigint").alias("total")
        )
        for name, total in _TOTALS.items()
    ]
    return reduce(DataFrame.union, parts)


def refresh_late(b: Build) -> DataFrame:
    """Tables built from monthly files of which one is incomplete, then refreshed when its whole content comes."""
    folder, root, late = new_folder(b.spark, "drops"), new_folder(b.spark, "refreshed"), "1996-05"
    month, seq = F.date_format("LogonDate", "yyyy-MM"), F.col("seq")
    columns = OCCUPANCY.columns
    line = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    name = F.concat(month, F.lit("_Occupancy.csv")).alias("file")
    drops = stage(b.raw.visits.select(name, F.lit(",".join(columns)).alias("header"), line.alias("line"), seq, month.alias("month")), "drops")
    write_csv_texts(drops.where((F.col("month") != late) | (seq % 2 == 0)).drop("month"), f"{folder}/Occupancy")
    b.raw.desks.repartitionByRange(2, "seq").sortWithinPartitions("seq").drop("seq").write.option("header", True).csv(f"{folder}/Deskcount")
    refresh.refresh_csv(b.spark, folder, root, b.raw.calendar)
    files.remove(b.spark, f"{folder}/Occupancy/{late}_Occupancy.csv")
    write_csv_texts(drops.where(F.col("month") == late).drop("month"), f"{folder}/Occupancy")
    done = refresh.refresh_csv(b.spark, folder, root, b.raw.calendar)
    if done.drops != [late] or done.months is None or len(done.months) > 3:
        raise AssertionError(f"more than the late drop was worked out: {done}")
    return versions.read(b.spark, root, "fact_occupancy_aggregated")


def run_all_csv(b: Build) -> DataFrame:
    """The whole job, from CSV files to tables, reports and a published table."""
    folder, out = new_folder(b.spark, "inputs"), new_folder(b.spark, "out")
    for name, rows in (("Occupancy", b.raw.visits), ("Deskcount", b.raw.desks)):
        ordered = rows.repartitionByRange(4, "seq").sortWithinPartitions("seq").drop("seq")
        ordered.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
            "ignoreTrailingWhiteSpace", False
        ).csv(f"{folder}/{name}")
    b.spark.sql(f"CREATE DATABASE IF NOT EXISTS seatlens_check LOCATION '{new_folder(b.spark, 'db')}'")
    marts.run_all(b.spark, folder, out, b.raw.calendar, files="csv", table="seatlens_check.fact_of_run")
    return conform(tables.require_table(b.spark, "seatlens_check.fact_of_run"), tables.PUBLISHED_AGGREGATED)


def csv_quoted(b: Build) -> DataFrame:
    """Visits in a few CSV files of many blocks, with line breaks in quotes; some texts are longer than a block."""
    folder = new_folder(b.spark, "csv-quoted")
    seq = F.col("seq")
    lines = F.when(seq % 2500 == 0, 20_000).otherwise((seq % 7).cast("int"))
    office = F.concat(F.lit('Gate "'), (seq % 10).cast("string"), F.lit('",\n'), F.repeat(F.lit("floor\n"), lines), F.trim("OfficeLocation"))
    visits = stage(b.raw.visits.select("Username", office.alias("OfficeLocation"), "LogonDate", "seq"), "visits")
    many = visits.count()
    visits.repartition(max(3, many // 2_000_000), "seq").drop("seq").write.option("header", True).option("escape", '"').csv(folder)
    block = "spark.sql.files.maxPartitionBytes"
    before = b.spark.conf.get(block)
    b.spark.conf.set(block, str(65536 * max(1, many // 50_000)))
    try:
        return csv_feeds.combine_feed(b.spark, folder, OCCUPANCY).rows.select("Username", "OfficeLocation", "LogonDate")
    finally:
        b.spark.conf.set(block, before)


def csv_monthly_names(b: Build) -> DataFrame:
    """Files named by month and feed count, others beside them don't."""
    folder = new_folder(b.spark, "csv-named")
    month, odd = F.date_format("LogonDate", "yyyy-MM"), F.col("seq") % 3 == 0
    name = F.when(odd, F.concat(month, F.lit("_Occupancy.csv"))).otherwise(F.concat(month, F.lit("_other.csv")))
    line = F.concat_ws(",", "Username", "LogonDate")
    few = b.raw.visits.where(F.col("Username").isNotNull())
    write_csv_texts(few.select(name.alias("file"), F.lit("Username,LogonDate").alias("header"), line.alias("line"), "seq"), folder)
    rows = csv_feeds.combine_feed(b.spark, folder, OCCUPANCY).rows
    return rows.select(F.regexp_extract("source_file", "[^/]+$", 0).alias("file"), "Username", "LogonDate")


def combine_union(b: Build) -> DataFrame:
    """Write the visits as CSV files with three different headers and combine them."""
    folder = new_folder(b.spark, "csv")
    layouts = [
        ["Username", "OfficeLocation", "LineOfBusiness", "LogonDate", "JobFamily"],
        ["JobFamily", "DayofWeek", "LogonDate", "LineOfBusiness", "OfficeLocation", "Username"],
        ["LogonDate", "Username", "OfficeLocation", "LineOfBusiness"],
    ]
    visits = stage(b.raw.visits, "visits")
    for part, layout in enumerate(layouts):
        rows = visits.where(F.col("seq") % len(layouts) == part).select(layout)
        rows.write.mode("append").option("header", True).option(
            "ignoreLeadingWhiteSpace", False
        ).option("ignoreTrailingWhiteSpace", False).csv(folder)
    combined = csv_feeds.combine_feed(b.spark, folder, OCCUPANCY)
    return combined.rows.select(*layouts[1])


def csv_rejected(b: Build) -> DataFrame:
    """Visits in CSV files of one day each, or parts of it, some unusable; what is kept and what is left out."""
    folder = new_folder(b.spark, "csv-bad")
    day, part = F.dayofmonth("LogonDate"), F.floor(F.col("seq") / 100_000).cast("string")
    header = F.when(day % 5 == 1, "OFFICELOCATION ,LogonDate,Username").otherwise("Username,OfficeLocation,LogonDate")
    cells = (
        F.when(day % 5 == 1, F.concat(F.lit('"'), F.trim("OfficeLocation"), F.lit('",'), F.concat_ws(",", "LogonDate", "Username")))
        .when((day % 5 == 2) & (F.col("seq") % 2 == 0), F.concat_ws(",", "Username", F.lit("x"), "LogonDate", F.lit("too much")))
        .when(day % 5 == 3, F.concat(F.col("Username").cast("string"), F.lit(',"two\nlines",'), F.col("LogonDate").cast("string")))
        .otherwise(F.concat_ws(",", "Username", F.lit("x"), "LogonDate"))
    )
    name = F.concat(F.when(day % 5 == 4, "_").otherwise(""), F.lit("day"), day.cast("string"), F.lit("-"), part, F.lit(".csv"))
    write_csv_texts(b.raw.visits.select(name.alias("file"), header.alias("header"), cells.alias("line"), "seq"), folder)
    combined = csv_feeds.combine_feed(b.spark, folder, OCCUPANCY)
    file = F.regexp_extract("source_file", "[^/]+$", 0).alias("file")
    kept = combined.rows.groupBy(file).agg(F.count("*").alias("rows"), F.max("OfficeLocation").alias("office"))
    left = combined.rejected.select(file, F.lit(0).cast("bigint").alias("rows"), F.col("error").alias("office"))
    return kept.unionByName(left)


def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.to_date("o_orderdate")
    span = table(spark, sf_dir, "orders").agg(F.min(day).alias("first_date"), F.max(day).alias("last_date"))
    return dims.dim_date_between(span)


def period_inference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The month of one made-up file name per order."""
    key, d = F.col("o_orderkey"), F.col("o_orderdate")
    root, ext = F.lit("/in/Deskcount/"), F.lit(".xlsx")
    word, year = F.date_format(d, "MMMM"), F.year(d).cast("string")
    path = (
        F.when(key % 6 == 0, F.concat(root, F.date_format(d, "yyyy_MM"), F.lit("_deskcount"), ext))
        .when(key % 6 == 1, F.concat(root, F.date_format(d, "yyyy-MM"), F.lit(".v2"), ext))
        .when(key % 6 == 2, F.concat(root, year, F.lit("/"), word, F.lit(" Deskcount"), ext))
        .when(key % 6 == 3, F.concat(root, year, F.lit("/"), F.upper(F.left(word, F.lit(3))), ext))
        .when(key % 6 == 4, F.concat(root, word, F.lit(" Deskcount"), ext))
        .otherwise(F.concat(root, F.lit("desks "), key.cast("string"), ext))
    )
    newest = F.when((key % 6 == 5) & (F.col("o_custkey") % 2 == 0), F.to_date(d))
    files = table(spark, sf_dir, "orders").select(key.alias("file_id"), path.alias("path"), newest.alias("newest"))
    month = periods.file_period(F.col("path"), F.col("newest"))
    return files.select("file_id", "path", month.alias("year_month"))


_DESK_COLUMNS = ["OfficeLocation", "Deskcount", "RSF", "Date", "Include in Occupancy Calculation"]


def _desk_workbooks(spark: SparkSession, sf_dir: str, typed: bool = False) -> str:
    """The capacity snapshots as workbooks: two or more per month, of bounded size."""
    folder = new_folder(spark, "Deskcount")
    seq = F.col("seq")
    chunk = F.concat(F.floor(seq / 100_000).cast("string"), F.lit("-"), (F.floor(seq / 60) % 2).cast("string"))
    name = F.concat(F.date_format("Date", "yyyy-MM"), F.lit("/desks "), chunk, F.lit(".xlsx"))
    write_workbooks(orders_desks(spark, sf_dir).withColumn("file", name), folder, "file", _DESK_COLUMNS, "seq", typed)
    return folder


def workbook_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode every workbook of a folder tree."""
    rows = workbooks.read_workbooks(spark, _desk_workbooks(spark, sf_dir)).where(F.col("row_pos") > 0)
    return rows.select(*[F.try_element_at("cells", F.lit(c)).alias(c) for c in _DESK_COLUMNS])


def workbook_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decode workbooks as an office suite writes them: shared texts, numbers and styled days."""
    rows = workbooks.read_workbooks(spark, _desk_workbooks(spark, sf_dir, typed=True)).where(F.col("row_pos") > 0)
    return rows.select(*[F.try_element_at("cells", F.lit(c)).alias(c) for c in _DESK_COLUMNS])


def workbook_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the workbooks as a table by month; of several per month the last counts."""
    folder = _desk_workbooks(spark, sf_dir)
    landed = workbooks.ingest_workbooks(spark, folder, DESKCOUNT, new_folder(spark, "landed"))
    return landed.rows.select("year_month", *_DESK_COLUMNS)


def workbook_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks per snapshot, of which most name no month: all of them are listed, the others land."""
    folder, out = new_folder(spark, "Deskcount"), new_folder(spark, "landed")
    seq = F.col("seq")
    name = F.concat(F.when(seq % 10 == 0, F.date_format("Date", "2024-MM ")).otherwise(""), F.lit("desks "), seq.cast("string"), F.lit(".xlsx"))
    desks = orders_desks(spark, sf_dir).withColumn("file", name).withColumn("When", F.col("Date"))
    write_workbooks(desks, folder, "file", ["OfficeLocation", "Deskcount", "When"], "seq")
    try:
        workbooks.ingest_workbooks(spark, folder, DESKCOUNT, out)
    except workbooks.BadFiles:
        pass
    bad = spark.read.parquet(f"{out}_rejected")
    file = F.regexp_extract("source_file", "[^/]+$", 0).alias("file")
    landed = spark.read.parquet(out).groupBy().agg(F.lit("landed").alias("file"), F.count("*").cast("string").alias("error"))
    return bad.select(file, "error").union(landed)


def workbook_relanded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks of all months, and then of every second month, land in one place: only the latter stay."""
    folder, out = new_folder(spark, "Deskcount"), new_folder(spark, "landed")
    workbooks.ingest_workbooks(spark, _desk_workbooks(spark, sf_dir), DESKCOUNT, out)
    seq, month = F.col("seq"), F.month("Date")
    name = F.concat(F.date_format("Date", "yyyy-MM"), F.lit(" "), F.floor(seq / 100_000).cast("string"), F.lit(".xlsx"))
    again = orders_desks(spark, sf_dir).where(month % 2 == 0).withColumn("file", name)
    write_workbooks(again, folder, "file", _DESK_COLUMNS, "seq")
    return workbooks.ingest_workbooks(spark, folder, DESKCOUNT, out).rows.select("year_month", *_DESK_COLUMNS)


def workbook_header_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Workbooks whose headers differ in case and blanks land as one set of columns."""
    folder = new_folder(spark, "Deskcount")
    desks = orders_desks(spark, sf_dir)
    spellings = [_DESK_COLUMNS, ["officelocation", "DESKCOUNT ", "rsf", " date", "Include In Occupancy Calculation "]]
    for part, names in enumerate(spellings):
        chunk = F.floor(F.col("seq") / 100_000).cast("string")
        file = F.concat(F.date_format("Date", "yyyy-MM"), F.lit(" "), chunk, F.lit(".xlsx"))
        renamed = [F.col(c).alias(n) for c, n in zip(_DESK_COLUMNS, names, strict=True)]
        own = desks.where(F.month("Date") % 2 == part).select("seq", file.alias("file"), *renamed)
        write_workbooks(own, folder, "file", names, "seq")
    landed = workbooks.ingest_workbooks(spark, folder, DESKCOUNT, new_folder(spark, "landed")).rows
    return clean.clean_deskcount(landed)


def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates written in sixteen layouts, and some that are no dates."""
    key, d = F.col("o_orderkey"), F.to_date("o_orderdate")
    layouts = [
        "yyyy-MM-dd", "yyyy-MM-dd HH:mm:ss", "M/d/yyyy", "MM/dd/yyyy", "M/d/yyyy h:mm a", "M/d/yyyy h:mm:ss a", "M/d/yyyy H:mm",
        "yyyy/MM/dd", "yyyyMMdd", "d-MMM-yyyy", "MMM d, yyyy", "MMMM d, yyyy", "MM-dd-yyyy", "d MMMM yyyy", "'13/'d/yyyy", "'week 'd",
    ]
    written = F.coalesce(*[F.when(key % len(layouts) == i, F.date_format(d, f)) for i, f in enumerate(layouts)])
    orders = table(spark, sf_dir, "orders").select(key, F.when(key % 3 == 0, F.upper(written)).otherwise(written).alias("text"))
    return orders.select("o_orderkey", parse.date_or_null(F.col("text")).alias("day"))


def parse_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances written in several ways, and some that are no plain numbers."""
    key, value = F.col("s_suppkey"), F.round("s_acctbal", 2).cast("decimal(18,2)").cast("string")
    written = (
        F.when(key % 5 == 0, F.concat(F.lit("  "), value, F.lit(" ")))
        .when(key % 5 == 1, F.concat(value, F.lit("e1")))
        .when(key % 5 == 2, F.concat(value, F.lit(" desks")))
        .when(key % 5 == 3, F.concat(F.lit("1,"), value))
        .otherwise(value)
    )
    return table(spark, sf_dir, "supplier").select("s_suppkey", F.round(parse.number_or_null(written), 3).alias("number"))


def _on(variant: str, query: Callable[[Build], DataFrame]) -> Query:
    return lambda spark, sf_dir: query(Build(spark, sf_dir, variant))


_BOTH_VARIANTS: dict[str, Callable[[Build], DataFrame]] = {
    "clean_occupancy": lambda b: b.visits,
    "clean_deskcount": clean_deskcount,
    "dim_location": dim_location,
    "coverage_window": lambda b: b.coverage,
    "eligible_dates": eligible_dates,
    "top3_days": top3_days,
    "asof_capacity": asof_capacity,
    "fact_occupancy": lambda b: b.fact,
    "fact_occupancy_aggregated": lambda b: b.aggregated,
    "by_location_summary": lambda b: quality.by_location_summary(b.fact),
    "validation_summary": validation_summary,
}

_EVENTS_ONLY: dict[str, Callable[[Build], DataFrame]] = {
    "normalize_location": normalize_location,
    "lob_frequency": lambda b: clean.lob_frequency(b.raw.visits, ORDER),
    "dim_line_of_business": lambda b: dims.dim_line_of_business(b.visits),
    "attendance_by_lob": lambda b: facts.attendance_by(b.daily, b.window, by_lob=True),
    "attendance_by_office": lambda b: facts.attendance_by(b.daily, b.window, by_lob=False),
    "grid_by_lob": lambda b: b.grid(by_lob=True),
    "grid_by_office": lambda b: b.grid(by_lob=False),
    "occupancy_rate": occupancy_rate,
    "daily_totals": lambda b: hybrid.daily_totals(b.grid(by_lob=False)),
    "hybrid_flags": hybrid_flags,
    "flag_distribution": lambda b: profile.flag_distribution(b.fact),
    "fact_profile": lambda b: profile.fact_profile(b.aggregated),
    "dim_profile": lambda b: profile.dim_profile(b.locations),
    "null_profile": lambda b: profile.null_profile(b.fact),
    "step_counts": lambda b: build(b).steps,
    "merge_issues": lambda b: quality.merge_issues(b.fact),
    "merge_issues_zero_filled": merge_issues_zero_filled,
    "missing_capacity": lambda b: quality.missing_capacity(b.fact),
    "over_capacity": lambda b: quality.over_capacity_days(b.fact),
    "weekday_weekend_mean": weekday_weekend_mean,
    "recency_gap": lambda b: quality.recency_gap(b.daily, b.snapshots),
    "office_slice": lambda b: profile.office_slice(b.fact, "NATION 7"),
    "fact_sample": fact_sample,
    "combine_union": combine_union,
    "publish_roundtrip": publish_roundtrip,
    "hybrid_flags_partial": hybrid_flags_partial,
    "business_profile": lambda b: profile.business_profile(b.lobs),
    "fact_sorted_export": fact_sorted_export,
    "reports_roundtrip": reports_roundtrip,
    "csv_rejected": csv_rejected,
    "csv_quoted": csv_quoted,
    "csv_monthly_names": csv_monthly_names,
    "run_all_csv": run_all_csv,
    "null_profile_files": null_profile_files,
    "range_profile_files": range_profile_files,
}


def _with_workers(query: Query) -> Query:
    """The query, with Python workers that find this folder's modules as the driver does."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", HERE)
        return query(spark, sf_dir)

    return run


def queries() -> dict[str, Query]:
    """One entry per operator or job; each takes (spark, sf_dir)."""
    entries = {n: _on("events", q) for n, q in {**_BOTH_VARIANTS, **_EVENTS_ONLY}.items()}
    entries |= {f"{n}_orders": _on("orders", q) for n, q in _BOTH_VARIANTS.items()}
    entries |= {
        "dim_date": dim_date,
        "calendar_profile": lambda spark, sf_dir: profile.calendar_profile(dim_date(spark, sf_dir)),
        "parse_dates": parse_dates,
        "parse_numbers": parse_numbers,
        "period_inference": period_inference,
        "workbook_ingest": workbook_ingest,
        "workbook_cells": workbook_cells,
        "workbook_landing": workbook_landing,
        "workbook_rejected": workbook_rejected,
        "workbook_header_drift": workbook_header_drift,
        "workbook_relanded": workbook_relanded,
        "publish_batches": _on("orders", publish_batches),
        "build_switch": _on("orders", build_switch),
        "refresh_late": _on("orders", refresh_late),
        "marts_build": _on("orders", lambda b: build(b).tables["fact_occupancy"]),
        **(llm_queries.queries() if llm_queries else {}),
        **({"pipeline": corpus_pipeline.run} if corpus_pipeline else {}),
    }
    return {name: _with_workers(query) for name, query in entries.items()}


def oracle_sql() -> dict[str, str]:
    """The expected result of each query, as SQL for DuckDB on the same tables."""
    expected = oracle_queries.oracle_sql() | (llm_sql.oracle_sql() if llm_sql else {})
    if corpus_pipeline and corpus_pipeline.ORACLE_SQL:
        expected["pipeline"] = corpus_pipeline.ORACLE_SQL
    return expected
