"""Union of a feed's CSV files, whose headers may differ from file to file."""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatlens.functions import text
from seatlens.schemas import Feed, quoted
from seatlens.session import broadcast_if_small, stage, task_slots
from seatlens.sources import quoted_csv
from seatlens.sources.listing import hidden_files, literal
from seatlens.sources.records import to_batches
from seatlens.sources.workbooks import unique_names

_HEADERS = "uri string, header array<string>, error string"
_HEADERS_ARROW = pa.schema(
    [("uri", pa.string()), ("header", pa.list_(pa.string())), ("error", pa.string())]
)
# Takes what a line has beyond its file's header; such a file is not usable.
_SURPLUS = "_surplus"
# Blocks are read together up to so many bytes, if there are enough of them.
_TASK_BYTES = 128 << 20
_TOO_LONG = "a line has more fields than the header"


class Combined(NamedTuple):
    """The rows of all usable files, and the files left out with the reason."""

    rows: DataFrame
    rejected: DataFrame


def _plain(uri: Column) -> Column:
    """A file URI as a plain path, percent escapes undone."""
    return F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))


def list_csv(spark: SparkSession, folder: str, names: str = "*.csv") -> DataFrame:
    """The CSV files directly in ``folder``; contents are not read."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", names).load(folder)
    return listing.select(
        F.col("_metadata.file_path").alias("uri"), _plain(F.col("_metadata.file_path")).alias("path")
    )


def preferred_names(files: DataFrame, feed: Feed) -> str:
    """The glob of files named ``YYYY-MM_<feed>.csv`` if there are any, else of all."""
    by_month = F.col("path").rlike(rf"/\d{{4}}-\d{{2}}_{re.escape(feed.name)}\.csv$")
    any_by_month = files.agg(F.coalesce(F.max(by_month), F.lit(False)).alias("any")).first()["any"]
    digit = "[0-9]"
    return f"{digit * 4}-{digit * 2}_{feed.name}.csv" if any_by_month else "*.csv"


def fingerprints(spark: SparkSession, folder: str, feed: Feed) -> DataFrame:
    """(feed, path, month, size, modified) of a feed's files; no content is read. The month is the one that a name gives."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", "*.csv").load(folder)
    path = _plain(F.col("_metadata.file_path"))
    month = F.nullif(F.regexp_extract(path, rf"/(\d{{4}}-\d{{2}})_{re.escape(feed.name)}\.csv$", 1), F.lit(""))
    return listing.select(
        F.lit(feed.name).alias("feed"),
        path.alias("path"),
        month.alias("month"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )


def _header(uri: str) -> tuple[str, list[str] | None, str | None]:
    """The first record of a file, reading no more than its first block."""
    try:
        system, path = FileSystem.from_uri(uri)
        with system.open_input_stream(path) as stream:
            lines = io.TextIOWrapper(stream, encoding="utf-8-sig", newline="")
            header = next((r for r in csv.reader(lines) if r), None)
        if header is None:
            raise ValueError("no columns")
        return uri, unique_names(header), None
    except Exception as problem:  # noqa: BLE001 - any defect of one file is that file's error
        return uri, None, f"{type(problem).__name__}: {problem}"


def _read_headers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield from to_batches(map(_header, batch["uri"].to_pylist()), _HEADERS_ARROW)


def _broken_files(spark: SparkSession, folder: str, names: str) -> DataFrame:
    """The files with a line of an odd number of quotes, which is one that a quoted text goes on from.

    One splittable pass over the lines; the list is a table.
    """
    lines = spark.read.option("pathGlobFilter", names).text(folder)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    some = F.contains("value", F.lit('"'))  # most lines: one search
    odd = lines.where(some).where(quotes % 2 == 1).select(F.col("_metadata.file_path").alias("uri")).distinct()
    return stage(odd, "broken-files")


# Up to so many files are left out of a scan by name, before they are read; more by a join.
_NAMED_FILES = 1000


def _named(uri: Column, files: list[str] | None, inside: bool) -> Column:
    """Whether a row is of the files, or of all others; the scan does not read files that are left out."""
    if files is None:
        return F.lit(True)
    return uri.isin(files) if inside else ~uri.isin(files)


def _scan(reader: DataFrameReader, folder: str, width: int, without: list[str] | None) -> DataFrame:
    """Rows as arrays of texts by position, with their place in the input."""
    fields = [f"_{i}" for i in range(width)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*fields, _SURPLUS]])
    scan = (
        reader.schema(schema)
        .option("header", True)
        .option("enforceSchema", True)
        .option("escape", '"')
        .csv(folder)
        .where(_named(F.col("_metadata.file_path"), without, inside=False))
    )
    return scan.select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("row_pos"),
        F.array(*fields).alias("cells"),
        quoted(_SURPLUS),
    )


def _scan_quoted(
    reader: DataFrameReader, folder: str, width: int, broken: DataFrame | None, named: list[str] | None
) -> tuple[DataFrame, DataFrame]:
    """The same of files with line breaks inside quotes, and the files whose quotes don't end."""
    size = reader.format("binaryFile").load(folder).agg(F.sum("_metadata.file_size")).first()[0]
    scan = reader.format("text").option("lineSep", "\n").load(folder)
    lines = scan.where(_named(F.col("_metadata.file_path"), named, inside=True)).select(
        F.col("_metadata.file_path").alias("uri"),
        F.col("_metadata.file_block_start").alias("source_block"),
        F.monotonically_increasing_id().alias("row_pos"),
        "value",
    )
    if broken is not None and named is None:
        # The join may shuffle; then a block's lines are put together again.
        lines = lines.join(broken, "uri", "left_semi")
        lines = lines.repartition("uri", "source_block").sortWithinPartitions("uri", "source_block", "row_pos")
    # Small blocks share tasks, and so staged files; large inputs keep tasks of about a block.
    records = quoted_csv.read_records(lines.coalesce(max(4 * task_slots(lines.sparkSession), size // _TASK_BYTES)))
    rows = quoted_csv.without_headers(records.rows)
    parsed = rows.withColumn("record", quoted_csv.fields(F.col("record"), width, _SURPLUS))
    cells = F.array(*[F.col("record")[f"_{i}"] for i in range(width)])
    kept = parsed.select("uri", "source_block", "row_pos", cells.alias("cells"), F.col("record")[_SURPLUS].alias(_SURPLUS))
    return kept.join(broadcast_if_small(records.unended), "uri", "left_anti"), records.unended


def combine_feed(
    spark: SparkSession,
    folder: str,
    feed: Feed,
    columns: list[str] | None = None,
    multiline: bool | None = None,
    months: Sequence[str] | None = None,
) -> Combined:
    """Union the feed's files by column name; what a file lacks is null.

    All files are scanned together, by position, whatever their headers; where a
    file has a column comes from its header, by a join on the file. Header names
    that differ in case or outer blanks are one column, the exact name first.
    ``columns`` are kept, the feed's own unless others are named; a column that
    no file has is left out. A file's rows are in the order (block, row_pos).

    Files are read in blocks by several tasks, those with line breaks inside
    quotes by the states of their lines (``quoted_csv``). ``multiline`` says
    whether all or none have such; without it one pass over the lines finds out.
    A file in which a quoted text does not end is left out. With ``months`` only
    the files that are named by these months are read.

    The union is staged as Parquet: the text is parsed once, and leaving out
    files with malformed lines costs a read of two columns. ``rejected`` names
    every file left out, also those whose names Spark's listing skips.
    """
    files = list_csv(spark, folder)
    names = preferred_names(files, feed) if months is None else f"{{{','.join(months)}}}_{feed.name}.csv"
    chosen = list_csv(spark, folder, names).select("uri").repartition(task_slots(spark), "uri")
    headers = stage(chosen.mapInArrow(_read_headers, _HEADERS), f"{feed.name}-headers")
    wanted = feed.columns if columns is None else columns
    place = lambda c: F.filter(  # noqa: E731 - the positions of a column, the exact name's first
        F.concat(
            F.transform("header", lambda h, i: F.when(h == c, i)),
            F.transform("header", lambda h, i: F.when((h != c) & (text.folded(h) == c.strip().lower()), i)),
        ),
        lambda i: i.isNotNull(),
    )
    usable = headers.where(F.col("error").isNull()).select(
        "uri", F.size("header").alias("width"), *[place(c).alias(f"at_{n}") for n, c in enumerate(wanted)]
    )
    facts = usable.agg(
        F.max("width").alias("width"), *[F.max(F.size(f"at_{n}")).alias(f"at_{n}") for n in range(len(wanted))]
    ).first()
    rejected = headers.where(F.col("error").isNotNull()).select(_plain(F.col("uri")).alias("source_file"), "error")
    rejected = rejected.unionByName(hidden_files(spark, [f"{literal(folder)}/[_.]*.csv"]))
    if facts.width is None:
        raise FileNotFoundError(f"no usable CSV files for {feed.name} in {folder}")

    reader = lambda: spark.read.option("pathGlobFilter", names)
    broken = _broken_files(spark, folder, names) if multiline is None else None
    some = bool(multiline) if broken is None else not broken.isEmpty()
    named = None
    if some and broken is not None and broken.count() <= _NAMED_FILES:
        named = [r.uri for r in broken.collect()]
    if some:
        scan, unended = _scan_quoted(reader(), folder, facts.width, broken, named)
        unended = unended.select(_plain(F.col("uri")).alias("source_file"), F.lit(quoted_csv.UNENDED).alias("error"))
        rejected = rejected.unionByName(unended)
    if broken is not None or not some:
        plain = _scan(reader(), folder, facts.width, named)
        if some and named is None:
            plain = plain.join(broadcast_if_small(broken), "uri", "left_anti")
        scan = scan.unionByName(plain) if some else plain

    rows = scan.join(broadcast_if_small(usable), "uri")
    beyond = F.exists(F.slice("cells", F.col("width") + 1, facts.width), lambda v: v.isNotNull())
    value = lambda n: text.first_known(F.transform(f"at_{n}", lambda i: F.get("cells", i)))
    kept = [(n, c) for n, c in enumerate(wanted) if facts[f"at_{n}"]]
    rows = rows.select(
        _plain(F.col("uri")).alias("source_file"),
        "source_block",
        "row_pos",
        (quoted(_SURPLUS).isNotNull() | beyond).alias(_SURPLUS),
        *[value(n).alias(c) for n, c in kept],
    )
    rows = stage(rows, f"{feed.name}-combined")
    malformed = stage(rows.where(quoted(_SURPLUS)).select("source_file").distinct(), f"{feed.name}-malformed")
    rejected = rejected.unionByName(malformed.withColumn("error", F.lit(_TOO_LONG)))
    files_malformed = malformed.count()
    good = rows.drop(_SURPLUS)
    if files_malformed:
        good = good.join(broadcast_if_small(malformed, files_malformed), "source_file", "left_anti")
    return Combined(good, rejected)
