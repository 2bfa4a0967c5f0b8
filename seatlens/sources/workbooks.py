"""Ingest of monthly workbooks: decode, date, keep the last of each month."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seatlens.functions import parse, text
from seatlens.schemas import Feed
from seatlens.session import broadcast_if_small, stage, task_slots
from seatlens.sources.files import exists
from seatlens.sources.listing import REJECTED, hidden_files, literal, matching_folders, path_depth
from seatlens.sources.periods import file_period
from seatlens.sources.records import to_batches
from seatlens.sources.xlsx import first_sheet

_DECODED = "source_file string, row_pos bigint, cells map<string,string>, error string"
_DECODED_ARROW = pa.schema(
    [
        ("source_file", pa.string()),
        ("row_pos", pa.int64()),
        ("cells", pa.map_(pa.string(), pa.string())),
        ("error", pa.string()),
    ]
)
_NO_MONTH = "no month in name, content or folder"


class BadFiles(RuntimeError):
    """Some input files could not be used; the usable ones were processed."""


class Landed(NamedTuple):
    """The rows of a feed by month, and the files left out with the reason."""

    rows: DataFrame
    rejected: DataFrame


def unique_names(header: list[str | None]) -> list[str]:
    """Column names as a reader needs them: blanks numbered, repeats suffixed."""
    names: list[str] = []
    for place, given in enumerate(header):
        base = given if given else f"Unnamed: {place}"
        name, repeat = base, 0
        while name in names:
            repeat += 1
            name = f"{base}.{repeat}"
        names.append(name)
    return names


def _records(path: str, content: bytes) -> Iterator[tuple]:
    """The header as record 0 and the data rows from 1, or one error record."""
    place = 0
    try:
        rows = first_sheet(content)
        names = unique_names(next(rows, []))
        yield path, 0, [(n, n) for n in names], None
        for place, row in enumerate(rows, 1):
            width = max(len(names), len(row))
            padded = itertools.zip_longest(names[:width], row)
            yield path, place, [(n, v) for n, v in padded if n is not None], None
    except Exception as problem:  # noqa: BLE001 - any defect of one file is that file's error
        yield path, place + 1, None, f"{type(problem).__name__}: {problem}"


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch["path"], batch["content"], strict=True):
            yield from to_batches(_records(path.as_py(), content.as_py()), _DECODED_ARROW)


def _patterns(folder: str, name: str) -> list[str]:
    """Files of a kind in a folder and one level below it."""
    return [f"{literal(folder)}/{name}", f"{literal(folder)}/*/{name}"]


def read_workbooks(spark: SparkSession, folder: str) -> DataFrame:
    """Decode the first sheet of every workbook in ``folder`` and one level below.

    Files are spread over tasks by size and decoded where they are read; deeper
    ones are not read at all. One row per sheet row, the header being row 0; a
    file that cannot be decoded gives a row with ``error``.

    Folders are listed by Spark's scan, never file by file on the driver. Spark
    puts few small files into a task; these are put together into a few tasks
    per core, so that neither tasks nor staged files grow with their number.
    """
    if not exists(spark, folder):
        return spark.createDataFrame([], _DECODED)
    # A scan leaves hidden folders out unless they are named.
    folders = [literal(folder), *map(literal, matching_folders(spark, f"{literal(folder)}/[_.]*"))]
    scan = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.xlsx").load(folders)
    depth = path_depth(spark, folder)
    near = F.col("_metadata.file_path").rlike(rf"^([^/:]+:)?(//[^/]*)?(/[^/]+){{{depth + 1},{depth + 2}}}$")
    files = scan.where(near).select("path", "content").coalesce(4 * task_slots(spark))
    return files.mapInArrow(_decode, _DECODED)


def cell(name: str) -> Column:
    """A landed row's cell by column name: the exact name first, then names that differ in case or blanks."""
    fold = name.strip().lower()
    entries = F.filter(F.map_entries("cells"), lambda e: text.folded(e["key"]) == fold)
    alike = F.transform(entries, lambda e: e["value"])
    return text.first_known(F.concat(F.array(F.try_element_at("cells", F.lit(name))), alike))


def land_workbooks(spark: SparkSession, folder: str, feed: Feed) -> Landed:
    """Decode a feed's workbooks and keep one file per month.

    Of several files of a month the last one by path counts. Workbooks are
    decoded once, into a staged table that all further steps read; the choice
    of files is broadcast to its rows, so these are not shuffled by file.
    """
    decoded = stage(read_workbooks(spark, folder), f"{feed.name}-workbooks")
    newest = parse.date_or_null(cell(feed.date_column))
    dated = (
        decoded.groupBy("source_file")
        .agg(
            F.max("error").alias("error"),
            F.max(F.when(F.col("row_pos") > 0, newest)).alias("newest"),
        )
        .withColumn("year_month", file_period(F.col("source_file"), F.col("newest")))
        .withColumn(
            "error",
            F.coalesce("error", F.when(F.col("year_month").isNull(), F.lit(_NO_MONTH))),
        )
    )
    files = stage(dated.select("source_file", "year_month", "error"), f"{feed.name}-files")
    # Path parts compare like file paths sort: folder by folder.
    parts = F.split("source_file", "/")
    chosen = (
        files.where(F.col("error").isNull())
        .groupBy("year_month")
        .agg(F.max_by("source_file", parts).alias("source_file"))
    )
    rows = (
        decoded.where(F.col("error").isNull())
        .join(broadcast_if_small(chosen, files.count()), "source_file")
        .select(
            F.concat("year_month", F.lit(f"_{feed.name}.csv")).alias("source_file"),
            F.lit(0).cast("bigint").alias("source_block"),
            "row_pos",
            "year_month",
            "cells",
        )
    )
    rejected = files.where(F.col("error").isNotNull()).select("source_file", "error")
    rejected = rejected.unionByName(hidden_files(spark, _patterns(folder, "[_.]*.xlsx")))
    if decoded.isEmpty():
        rejected = rejected.unionByName(spark.createDataFrame([(folder, "no .xlsx files found")], REJECTED))
    return Landed(rows, rejected)


def feed_columns(rows: DataFrame, feed: Feed) -> DataFrame:
    """Unfold landed cells into the feed's columns.

    Header names that differ in case or outer blanks are one column, whose cells
    are coalesced. A column that no file has is left out, so that what needs it
    can say so; only whether it was seen comes to the driver.
    """
    names = F.transform(F.map_keys("cells"), text.folded)
    seen = rows.where(F.col("row_pos") == 0).agg(
        *[F.max(F.array_contains(names, c.lower())).alias(c) for c in feed.columns]
    )
    present = [c for c, there in seen.first().asDict().items() if there]
    data = rows.where(F.col("row_pos") > 0)
    return data.select("source_file", "source_block", "row_pos", "year_month", *[cell(c).alias(c) for c in present])


def ingest_workbooks(spark: SparkSession, folder: str, feed: Feed, out: str, fail: bool = True) -> Landed:
    """Land a feed as a table partitioned by month, replacing an earlier one.

    Unusable files do not stop the others. All of them are listed, with the
    reason, in the table ``<out>_rejected``; if there are any the job fails at
    the end, unless ``fail`` is false and the caller sees to them.
    """
    landed = land_workbooks(spark, folder, feed)
    rows = feed_columns(landed.rows, feed)
    rows.hint("rebalance", "year_month").write.mode("overwrite").partitionBy("year_month").parquet(out)
    bad = f"{out}_rejected"
    landed.rejected.write.mode("overwrite").parquet(bad)
    rejected = spark.read.schema(REJECTED).parquet(bad)
    if fail:
        raise_rejected(rejected, bad)
    return Landed(spark.read.schema(rows.schema).parquet(out), rejected)


def raise_rejected(rejected: DataFrame, place: str) -> None:
    """Fail if there are rejected files, saying how many and where they are listed."""
    many = rejected.count()
    if many:
        raise BadFiles(f"{many} input files could not be used; {place} lists them with the reasons")
