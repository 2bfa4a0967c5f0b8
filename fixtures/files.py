"""Raw files written from the test tables, to run the file sources on them."""

from __future__ import annotations

import datetime as dt
import io
import itertools
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from urllib.parse import unquote
from xml.sax.saxutils import escape

import pyarrow as pa
from pyarrow.fs import FileSystem
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seatlens.session import new_folder, task_slots
from seatlens.sources import files

_XML = '<?xml version="1.0" encoding="UTF-8"?>'
_MAIN = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
_REL = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
_PACKAGE = "http://schemas.openxmlformats.org/package/2006/relationships"


def _package(parts: dict[str, str]) -> bytes:
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{_MAIN}" xmlns:r="{_REL}">'
        '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": f'<Relationships xmlns="{_PACKAGE}">'
        f'<Relationship Id="rId1" Type="{_REL}/worksheet" Target="worksheets/sheet1.xml"/></Relationships>',
        **parts,
    }
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w", zipfile.ZIP_DEFLATED) as book:
        for name, xml in parts.items():
            book.writestr(name, _XML + xml)
    return buffer.getvalue()


def workbook(rows: Iterable[Sequence[str | None]]) -> bytes:
    """A workbook with one sheet of text cells."""

    def cell(value: str | None) -> str:
        if value is None:
            return "<c/>"
        return f'<c t="inlineStr"><is><t xml:space="preserve">{escape(value)}</t></is></c>'

    lines = "".join(f"<row>{''.join(map(cell, row))}</row>" for row in rows)
    return _package({"xl/worksheets/sheet1.xml": f'<worksheet xmlns="{_MAIN}"><sheetData>{lines}</sheetData></worksheet>'})


def typed_workbook(rows: Iterable[Sequence[object]]) -> bytes:
    """A workbook as an office suite writes it: texts shared by number, numbers, days as styled numbers."""
    strings: dict[str, int] = {}

    def cell(value: object) -> str:
        if value is None:
            return "<c/>"
        if isinstance(value, dt.date):
            return f'<c s="1"><v>{(value - dt.date(1899, 12, 30)).days}</v></c>'
        if isinstance(value, (int, float)):
            return f"<c><v>{value}</v></c>"
        return f'<c t="s"><v>{strings.setdefault(str(value), len(strings))}</v></c>'

    lines = "".join(f"<row>{''.join(map(cell, row))}</row>" for row in rows)
    shared = "".join(f'<si><t xml:space="preserve">{escape(s)}</t></si>' for s in strings)
    return _package(
        {
            "xl/sharedStrings.xml": f'<sst xmlns="{_MAIN}">{shared}</sst>',
            "xl/styles.xml": f'<styleSheet xmlns="{_MAIN}"><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/></cellXfs></styleSheet>',
            "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{_MAIN}"><sheetData>{lines}</sheetData></worksheet>',
        }
    )


def _path_in(folder: str) -> tuple[FileSystem, str]:
    uri = folder if ":" in folder else f"file://{folder}"
    return FileSystem.from_uri(uri)


def write_workbooks(df: DataFrame, folder: str, name: str, columns: Sequence[str], order: str, typed: bool = False) -> int:
    """Write one workbook per distinct value of column ``name``; return their number.

    Cells are texts, or with ``typed`` numbers, days and shared texts. The rows of many
    files are few bytes, of which the optimizer would make one task: the tasks are as
    many as the cluster keeps busy, and each writes its files one after the other.
    """
    make = typed_workbook if typed else workbook

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _path_in(folder)
        rows = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns), strict=True))
        made = set()
        for file_name, own in itertools.groupby(rows, lambda row: row[0]):
            path = f"{root}/{file_name}"
            parent = path.rsplit("/", 1)[0]
            if parent not in made:
                system.create_dir(parent, recursive=True)
                made.add(parent)
            cells = ([None if v != v else v for v in row[1:]] for row in own)
            with system.open_output_stream(path) as out:
                out.write(make(itertools.chain([list(columns)], cells)))
            yield pa.RecordBatch.from_pydict({"file": [file_name]})

    spread = df.select(
        F.col(name).alias("_file"),
        F.col(order).alias("_order"),
        *[F.col(c) if typed else F.col(c).cast("string") for c in columns],
    ).repartition(4 * task_slots(df.sparkSession), "_file")
    return spread.sortWithinPartitions("_file", F.col("_order").asc_nulls_last()).drop("_order").mapInArrow(write, "file string").count()


def write_csv_texts(df: DataFrame, folder: str) -> int:
    """Write rows of (file, header, line, seq) as one text file per name, just as the lines are; return their number.

    Lines are sorted and written by Spark, a file's by one task, line by line; then the files get their names.
    """
    spark, parts = df.sparkSession, new_folder(df.sparkSession, "texts")
    headers = df.groupBy("file").agg(F.first("header").alias("line"), F.lit(None).cast("bigint").alias("seq"))
    lines = headers.unionByName(df.select("file", "line", F.col("seq").cast("bigint").alias("seq")))
    dealt = lines.repartition("file").sortWithinPartitions("file", F.col("seq").asc_nulls_first())
    dealt.select("file", "line").write.partitionBy("file").option("lineSep", "\n").text(parts)
    written = [f for f in files.files_below(spark, parts) if "/part-" in f]
    for part in written:
        files.rename(spark, f"{parts}/{part}", f"{folder}/{unquote(part.partition('/')[0].removeprefix('file='))}")
    return len(written)
