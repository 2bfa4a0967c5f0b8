from __future__ import annotations

import csv
import io
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from seatlens.functions.text import NULL_TOKENS
from seatlens.plans import clean, marts, quality
from seatlens.schemas import DESKCOUNT, OCCUPANCY, PUBLISHED_AGGREGATED, TABLES
from seatlens.sources import csv_feeds, ledger, quoted_csv, statistics, tables, versions, workbooks
from seatlens.sources.xlsx import first_sheet
from fixtures.files import workbook, write_workbooks
from tests.helpers import day, rows

HEADER = ["OfficeLocation", "Deskcount", "Date"]


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content if isinstance(content, bytes) else content.encode())


def styled_workbook(sheet_rows: str, date1904: bool = False) -> bytes:
    """A workbook with shared strings, styles and a second sheet, as an office suite writes it."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    parts = {
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><workbookPr date1904="{int(date1904)}"/>'
        '<sheets><sheet name="Data" sheetId="7" r:id="rId9"/><sheet name="Notes" sheetId="1" r:id="rId1"/></sheets>'
        "</workbook>",
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="x">'
        '<Relationship Id="rId1" Target="worksheets/sheet1.xml"/>'
        '<Relationship Id="rId9" Target="/xl/worksheets/sheet2.xml"/></Relationships>',
        "xl/sharedStrings.xml": f'<sst xmlns="{main}"><si><t>Date</t></si>'
        "<si><r><t>Off</t></r><r><t>ice</t></r><rPh><t>reading</t></rPh></si></sst>",
        "xl/styles.xml": f'<styleSheet xmlns="{main}"><numFmts>'
        '<numFmt numFmtId="164" formatCode="yyyy\\-mm\\-dd"/><numFmt numFmtId="165" formatCode="0.0&quot;d&quot;"/>'
        '</numFmts><cellXfs><xf numFmtId="0"/><xf numFmtId="14"/><xf numFmtId="164"/><xf numFmtId="165"/></cellXfs>'
        "</styleSheet>",
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData/></worksheet>',
        "xl/worksheets/sheet2.xml": f'<worksheet xmlns="{main}"><sheetData>{sheet_rows}</sheetData></worksheet>',
    }
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as book:
        for name, xml in parts.items():
            book.writestr(name, xml)
    return buffer.getvalue()


def test_cell_values():
    sheet = (
        '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="C1" t="s"><v>1</v></c></row>'
        '<row r="3"><c r="A3" s="1"><v>45292</v></c><c r="B3" s="2"><v>45292.5</v></c><c r="C3" s="3"><v>2.5</v></c>'
        '<c r="D3"><v>1E2</v></c><c r="E3" t="b"><v>1</v></c><c r="F3" t="e"><v>#N/A</v></c>'
        '<c r="G3" t="str"><f>A1</f><v>text</v></c></row><row r="4"><c r="A4"/></row>'
    )
    assert list(first_sheet(styled_workbook(sheet))) == [
        ["Date", None, "Office"],
        [],
        ["2024-01-01", "2024-01-01 12:00:00", "2.5", "100", "True", None, "text"],
    ]
    in_1904 = list(first_sheet(styled_workbook('<row><c s="1"><v>43830</v></c></row>', date1904=True)))
    assert in_1904 == [["2024-01-01"]]


def test_unique_names():
    assert workbooks.unique_names(["A", None, "A", "A", ""]) == ["A", "Unnamed: 1", "A.1", "A.2", "Unnamed: 4"]


def test_workbook_landing(spark, tmp_path):
    """Name before content before folder; the last file of a month counts; bad files do not stop the rest."""
    root = tmp_path / "Deskcount"
    put(root / "2024_01_deskcount.xlsx", workbook([HEADER, ["A", "1", "2020-05-05"]]))
    put(root / "2024" / "anything.xlsx", workbook([HEADER, ["B", "2", "2024-02-01"], ["B2", "NA", "2024-02-01"]]))
    put(root / "2024" / "March desks.xlsx", workbook([["OfficeLocation", "Extra"], ["C", "e"]]))
    put(root / "2024 b" / "other.xlsx", workbook([HEADER, ["D", "4", "2024-02-20"]]))
    put(root / "2024" / "deep" / "2030_01.xlsx", workbook([HEADER, ["E", "5", "2024-02-20"]]))
    put(root / "April.xlsx", workbook([["OfficeLocation"], ["F"]]))
    put(root / "2024_06.xlsx", b"not a workbook")
    put(root / "_2024_07.xlsx", workbook([HEADER, ["G", "1", "2024-07-01"]]))
    landed = workbooks.land_workbooks(spark, str(root), DESKCOUNT)
    got = workbooks.feed_columns(landed.rows, DESKCOUNT)
    assert got.columns == ["source_file", "source_block", "row_pos", "year_month", "OfficeLocation", "Deskcount", "Date"]
    assert rows(got, "year_month", "OfficeLocation", "Deskcount", "row_pos") == [
        ("2024-01", "A", "1", 1),
        ("2024-02", "D", "4", 1),
        ("2024-03", "C", None, 1),
    ]
    assert {(r.source_file.rsplit("/", 1)[1], r.error.split(":")[0]) for r in landed.rejected.collect()} == {
        ("April.xlsx", "no month in name, content or folder"),
        ("2024_06.xlsx", "BadZipFile"),
        ("_2024_07.xlsx", "name begins with _ or . and is not listed"),
    }
    out = str(tmp_path / "landed")
    with pytest.raises(workbooks.BadFiles, match="^3 input files .*landed_rejected"):
        workbooks.ingest_workbooks(spark, str(root), DESKCOUNT, out)
    assert spark.read.parquet(out).count() == 3 and spark.read.parquet(f"{out}_rejected").count() == 3


def test_every_unusable_workbook_is_listed(spark, tmp_path):
    for i in range(25):
        put(tmp_path / "in" / f"2024_01 {i}.xlsx", b"no workbook")
    landed = workbooks.ingest_workbooks(spark, str(tmp_path / "in"), DESKCOUNT, str(tmp_path / "out"), fail=False)
    assert landed.rejected.count() == 25 and landed.rows.isEmpty()


def _task_counts(spark, work):
    """How many tasks each stage of ``work`` had."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        work()
        tracker = spark.sparkContext.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup("counted") for s in tracker.getJobInfo(j).stageIds}
        return [info.numTasks for s in stages if (info := tracker.getStageInfo(s))]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_many_small_workbooks_are_spread_over_a_bounded_number_of_tasks(spark, tmp_path):
    """One task wrote them all, and to read them took a task for each to be listed."""
    many, most = 1200, 4 * spark.sparkContext.defaultParallelism
    desks = spark.range(many).select(F.concat(F.lit("d"), "id", F.lit(".xlsx")).alias("file"), "id", (F.col("id") % 7).alias("n"))
    written = _task_counts(spark, lambda: write_workbooks(desks, str(tmp_path / "in"), "file", ["n"], "id"))
    assert max(written) == most
    decoded = []
    read = _task_counts(spark, lambda: decoded.extend(workbooks.read_workbooks(spark, str(tmp_path / "in")).collect()))
    assert max(read) <= most
    assert sorted((r.row_pos, r.cells["n"]) for r in decoded if r.row_pos) == sorted((1, str(i % 7)) for i in range(many))


def test_workbooks_of_a_folder_and_one_level_below(spark, tmp_path):
    """Also in folders with hidden names or those of partitions; deeper ones are left alone."""
    folder = tmp_path / "in %41[x]"
    near = ["a.xlsx", "m=1/b.xlsx", "_h/c.xlsx", ".h[1]/c {x}%20.xlsx"]
    for name in [*near, "x/y/d.xlsx", "x/_y/d.xlsx", "_h/y/d.xlsx", "x/.d.xlsx", "e.txt"]:
        put(folder / name, workbook([["A"], [name]]))
    got = workbooks.read_workbooks(spark, str(folder)).where("row_pos > 0").collect()
    assert sorted(r.cells["A"] for r in got) == sorted(near)
    assert workbooks.read_workbooks(spark, str(tmp_path / "none")).isEmpty()


def test_header_case_and_blanks_make_no_new_column(spark, tmp_path):
    put(tmp_path / "in" / "2024_01.xlsx", workbook([HEADER, ["A", "1", "2024-01-01"]]))
    put(tmp_path / "in" / "2024_02.xlsx", workbook([["officelocation ", "DeskCount", "DESKCOUNT", " date"], ["B", "NA", "2", "2/1/2024"]]))
    landed = workbooks.ingest_workbooks(spark, str(tmp_path / "in"), DESKCOUNT, str(tmp_path / "out")).rows
    assert rows(landed, "OfficeLocation", "Deskcount", "Date") == [("A", "1", "2024-01-01"), ("B", "2", "2/1/2024")]


def test_an_earlier_landing_is_replaced(spark, tmp_path):
    out = str(tmp_path / "out")
    put(tmp_path / "a" / "2024_01.xlsx", workbook([HEADER, ["A", "1", "2024-01-01"]]))
    put(tmp_path / "b" / "2024_02.xlsx", workbook([HEADER, ["B", "1", "2024-02-01"]]))
    for folder in ("a", "b"):
        landed = workbooks.ingest_workbooks(spark, str(tmp_path / folder), DESKCOUNT, out).rows
    assert rows(landed, "year_month", "OfficeLocation") == [("2024-02", "B")]


def test_empty_workbook_folder_is_an_error(spark, tmp_path):
    (tmp_path / "Occupancy").mkdir()
    with pytest.raises(workbooks.BadFiles, match="^1 input files"):
        workbooks.ingest_workbooks(spark, str(tmp_path / "Occupancy"), OCCUPANCY, str(tmp_path / "out"))
    assert [r.error for r in spark.read.parquet(str(tmp_path / "out_rejected")).collect()] == ["no .xlsx files found"]


def test_header_only_workbook_replaces_its_month(spark, tmp_path):
    put(tmp_path / "in" / "2024_01_a.xlsx", workbook([HEADER, ["A", "1", "2024-01-01"]]))
    put(tmp_path / "in" / "2024_01_b.xlsx", workbook([HEADER]))
    landed = workbooks.land_workbooks(spark, str(tmp_path / "in"), DESKCOUNT)
    assert workbooks.feed_columns(landed.rows, DESKCOUNT).count() == 0 and landed.rejected.isEmpty()


def test_landed_visits_clean_in_month_order(spark, tmp_path):
    """Of two visits on one day the earlier month's file comes first, whatever the file names."""
    header = list(OCCUPANCY.required)
    row = ["u", "Oslo", "Sales", "C", "2024-01-31", "Wednesday", "J"]
    put(tmp_path / "in" / "z_2024-01.xlsx", workbook([header, row]))
    put(tmp_path / "in" / "a_2024-02.xlsx", workbook([header, [*row[:2], "Other", *row[3:]], ["v", *row[1:]]]))
    landed = workbooks.ingest_workbooks(spark, str(tmp_path / "in"), OCCUPANCY, str(tmp_path / "out")).rows
    cleaned = clean.clean_occupancy(landed)
    assert rows(cleaned, "office_location", "line_of_business") == [("Oslo", "Sales")] * 2


VISIT = ["u1", " Oslo. ", "Pending", "C", "2024-01-02", "Tuesday", "J"]


def check_whole_run(spark, built, table):
    fact = built.tables["fact_occupancy_aggregated"]
    assert rows(fact.where("attendance_count > 0"), "date_key", "office_location", "attendance_count", "deskcount") == [
        (20240102, "Oslo", 1, 4),
        (20240104, "Oslo", 2, 4),
    ]
    assert fact.count() == 3 and spark.table(table).count() == 3
    assert rows(built.tables["dim_location"]) == [(1, "Oslo", 900)]


def test_whole_run_from_workbooks(spark, tmp_path):
    put(tmp_path / "Inputs/Deskcount/2024_01_deskcount.xlsx", workbook([[*HEADER, "RSF"], ["Oslo", "4", "2024-01-01", "900"]]))
    header = list(OCCUPANCY.required)
    later = [[u, *VISIT[1:4], "2024-01-04", *VISIT[5:]] for u in ("u1", "u2", "u1")]
    put(tmp_path / "Inputs/Occupancy/2024/January.xlsx", workbook([header, VISIT, VISIT, *later]))
    built = marts.run_all(spark, str(tmp_path / "Inputs"), str(tmp_path / "out"), table="run_db.occupancy")
    check_whole_run(spark, built, "run_db.occupancy")
    assert (tmp_path / "out/reports/validation_summary").exists()


def test_whole_run_from_csv(spark, tmp_path):
    put(tmp_path / "Deskcount/desks.csv", "Date,RSF,OfficeLocation,Deskcount\n2024-01-01,900,Oslo,4\n")
    lines = [OCCUPANCY.required, VISIT, VISIT]
    put(tmp_path / "Occupancy/a.csv", "".join(",".join(line) + "\n" for line in lines))
    later = [[u, *VISIT[1:4], "1/4/2024", *VISIT[5:]] for u in ("u1", "u2", "u1")]
    lines = [reversed(line) for line in [OCCUPANCY.required, *later]]
    put(tmp_path / "Occupancy/b.csv", "".join(",".join(line) + "\n" for line in lines))
    built = marts.run_all(spark, str(tmp_path), str(tmp_path / "out"), files="csv", table="csv_db.occupancy")
    check_whole_run(spark, built, "csv_db.occupancy")


def test_whole_run_names_what_it_could_not_use(spark, tmp_path):
    put(tmp_path / "in/Deskcount/desks.csv", "Date,officelocation ,Deskcount\n2024-01-01,Oslo,4\n")
    header = ",".join(OCCUPANCY.required)
    put(tmp_path / "in/Occupancy/a.csv", f"{header}\n{','.join(VISIT)}\n")
    put(tmp_path / "in/Occupancy/b.csv", f"{header}\n{','.join(VISIT)},more\n")
    put(tmp_path / "in/Occupancy/_c.csv", f"{header}\n{','.join(VISIT)}\n")
    out = tmp_path / "out"
    with pytest.raises(workbooks.BadFiles, match="^2 input files .*rejected_files"):
        marts.run_all(spark, str(tmp_path / "in"), str(out), files="csv")
    built = marts.run_all(spark, str(tmp_path / "in"), str(out), files="csv", fail_on_rejected=False)
    left = [(r.feed, r.source_file.rsplit("/", 1)[1]) for r in built.reports["rejected_files"].collect()]
    assert sorted(left) == [("Occupancy", "_c.csv"), ("Occupancy", "b.csv")]
    steps = dict(rows(built.steps))
    assert steps["files rejected"] == 2 and steps["visits loaded"] == steps["visits in the fact"] == 1


def test_csv_union_by_name(spark, tmp_path):
    put(tmp_path / "January Desk.csv", 'OfficeLocation,Address,Deskcount\nA,"1 Road, ""x""\nTown",10\n\nB,,NA\n')
    put(tmp_path / "b+%20.csv", "Deskcount,OfficeLocation,Extra.col\n20,C,x\n30\n")
    put(tmp_path / "c.csv", "Deskcount,OfficeLocation,Extra.col\n40,D,\n")
    put(tmp_path / "empty.csv", "\n\n")
    put(tmp_path / "latin.csv", b"Offic\xe9\nx\n")
    put(tmp_path / "ragged.csv", "OfficeLocation,Deskcount\nE,1\nF,2,3\n")
    put(tmp_path / "sub" / "nested.csv", "OfficeLocation\nG\n")
    put(tmp_path / ".hidden.csv", "OfficeLocation\nH\n")
    kept = [*DESKCOUNT.columns, "Extra.col"]
    combined = csv_feeds.combine_feed(spark, str(tmp_path), DESKCOUNT, columns=kept)
    assert combined.rows.columns == ["source_file", "source_block", "row_pos", "OfficeLocation", "Deskcount", "Address", "Extra.col"]
    got = combined.rows.orderBy("source_file", "source_block", "row_pos").collect()
    assert [(r.OfficeLocation, r.Address, r.Deskcount, r["Extra.col"]) for r in got] == [
        ("A", '1 Road, "x"\nTown', "10", None),
        ("B", None, None, None),
        ("C", None, "20", "x"),
        (None, None, "30", None),
        ("D", None, "40", None),
    ]
    names = {r.source_file.rsplit("/", 1)[1]: r.error.split(":")[0] for r in combined.rejected.collect()}
    assert names == {
        "empty.csv": "ValueError",
        "latin.csv": "UnicodeDecodeError",
        "ragged.csv": "a line has more fields than the header",
        ".hidden.csv": "name begins with _ or . and is not listed",
    }
    assert [r.source_file.rsplit("/", 1)[1] for r in got][2] == "b+%20.csv"


def test_monthly_names_take_precedence(spark, tmp_path):
    put(tmp_path / "old.csv", "OfficeLocation\nold\n")
    put(tmp_path / "2024-02_Deskcount.csv", "OfficeLocation\nnew\n")
    put(tmp_path / "2024-02_Occupancy.csv", "OfficeLocation\nother feed\n")
    assert rows(csv_feeds.combine_feed(spark, str(tmp_path), DESKCOUNT).rows, "OfficeLocation") == [("new",)]


def test_no_csv_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        csv_feeds.combine_feed(spark, str(tmp_path), DESKCOUNT)


def test_ten_headers_are_one_scan(spark, tmp_path):
    for i in range(10):
        put(tmp_path / f"f{i}.csv", ",".join([f"x{j}" for j in range(i)] + ["Deskcount"]) + "\n" + ",".join(["y"] * i + [str(i)]) + "\n")
    combined = csv_feeds.combine_feed(spark, str(tmp_path), DESKCOUNT).rows
    assert sorted(int(r.Deskcount) for r in combined.collect()) == list(range(10))


def test_large_csv_is_read_in_blocks_in_file_order(spark, tmp_path):
    put(tmp_path / "big.csv", "OfficeLocation,n\n" + "".join(f"office {i % 7},{i}\n" for i in range(20_000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        combined = csv_feeds.combine_feed(spark, str(tmp_path), DESKCOUNT, columns=["n"]).rows
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert combined.select("source_block").distinct().count() > 3
    ordered = combined.orderBy("source_file", "source_block", "row_pos").select("n").collect()
    assert [int(r.n) for r in ordered] == list(range(20_000))


def aggregated(spark, *entries):
    """Aggregated fact rows from (date, office, attendance, desks)."""
    data = []
    for text, office, n, desks in entries:
        d = day(text)
        rate = None if desks is None else n / desks
        weekend = d.weekday() > 4
        data.append((int(d.strftime("%Y%m%d")), 1, d, office, d.year, d.month, weekend, n, desks, rate, False))
    return spark.createDataFrame(data, TABLES["fact_occupancy_aggregated"])


def test_publish(spark):
    first = aggregated(spark, ("2024-01-01", "A", 1, 2), ("2024-02-01", "A", 3, None))
    assert tables.publish(first, "plans_db.occupancy") == 2
    assert tables.publish(first, "plans_db.occupancy") == 2
    assert spark.table("plans_db.occupancy").count() == 2
    assert tables.publish(first.where("month = 1"), "plans_db.occupancy", mode="append") == 1
    published = tables.conform(tables.require_table(spark, "plans_db.occupancy"), PUBLISHED_AGGREGATED)
    assert published.count() == 3 and published.schema["attendance_count"].dataType.simpleString() == "int"
    with pytest.raises(ValueError):
        tables.publish(first, "plans_db.occupancy", mode="ignore")


def test_a_batch_is_appended_once(spark, tmp_path, monkeypatch):
    first = aggregated(spark, ("2024-01-01", "A", 1, 2), ("2024-02-01", "A", 3, None))
    batch = aggregated(spark, ("2024-02-02", "B", 5, None), ("2024-03-01", "B", 6, 1), ("2024-03-01", "B", 6, 1))
    name = "once_db.occupancy"
    assert tables.publish(first, name, "append", path=str(tmp_path / "t")) == 2  # makes the table
    assert tables.publish(first.orderBy(F.desc("date")), name, "append") == 0
    moves = []

    def breaks(spark, old, new):
        if len(moves) == 1:
            raise OSError("the driver is lost")
        moves.append(new)
        rename(spark, old, new)

    rename = ledger.files.rename
    monkeypatch.setattr(ledger.files, "rename", breaks)
    with pytest.raises(OSError, match="lost"):
        tables.publish(batch, name, "append")
    monkeypatch.setattr(ledger.files, "rename", rename)
    assert tables.publish(batch.repartition(3), name, "append") == 3
    assert tables.publish(batch, name, "append") == 0
    assert rows(spark.table(name), "date", "attendance_count") == rows(first.union(batch), "date", "attendance_count")
    assert sorted(ledger.entries(spark, tables._location(spark, name)).values()) == [2, 3]
    # the same numbers in other columns, or a null in another place, are another batch
    swapped = batch.withColumn("deskcount", F.col("location_key")).withColumn("location_key", F.lit(None).cast("int"))
    assert ledger.digest(swapped) != ledger.digest(batch) == ledger.digest(batch.repartition(2))
    late = aggregated(spark, ("2024-03-05", "C", 7, 1))
    assert tables.publish(late, name, "replace") == tables.publish(late, name, "replace") == 1
    assert rows(spark.table(name), "date") == rows(first.union(batch).union(late).where("month < 3 OR office_location = 'C'"), "date")


def test_a_failed_publish_leaves_the_table(spark):
    first = aggregated(spark, ("2024-01-01", "A", 1, 2), ("2024-02-01", "A", 3, None))
    tables.publish(first, "kept_db.occupancy")
    broken = first.withColumn("deskcount", F.when(F.col("month") == 2, F.raise_error(F.lit("no desks")).cast("int")))
    with pytest.raises(Exception, match="no desks"):
        tables.publish(broken, "kept_db.occupancy")
    assert spark.table("kept_db.occupancy").count() == 2
    assert tables.publish(first.limit(1), "kept_db.occupancy") == 1 == spark.table("kept_db.occupancy").count()


def test_versions_switch_together(spark, tmp_path):
    root = str(tmp_path / "v")
    assert versions.current(spark, root) is None
    with pytest.raises(FileNotFoundError):
        versions.read(spark, root, "a")
    for n in (1, 2, 3):
        folder = versions.new_version(root)
        spark.range(n).write.parquet(f"{folder}/a")
        if n == 1:
            with pytest.raises(FileNotFoundError, match="lacks b"):
                versions.commit(spark, folder, {"a": 1, "b": 1})
        spark.range(10 * n).write.parquet(f"{folder}/b")
        assert versions.read(spark, root, "a").count() == n - 1 if n > 1 else True
        assert versions.commit(spark, folder, {"a": n, "b": 10 * n}).number == n
        assert versions.read(spark, root, "b").count() == 10 * n
    unfinished = versions.new_version(root)
    spark.range(5).write.parquet(f"{unfinished}/a")
    assert versions.current(spark, root).rows == {"a": 3, "b": 30}
    assert len(versions.vacuum(spark, root, keep=2)) == 2  # the first and the unfinished one
    assert versions.read(spark, root, "a").count() == 3 and versions.current(spark, root).number == 3
    assert not versions.files.create_text(spark, f"{root}/_manifests/00000003.json", "{}")


def test_publish_without_database_creates_none(spark):
    before = {d.name for d in spark.catalog.listDatabases()}
    tables.publish(aggregated(spark, ("2024-01-01", "A", 1, 2)), "plain_occupancy", partition_by=())
    assert {d.name for d in spark.catalog.listDatabases()} == before
    assert spark.table("plain_occupancy").count() == 1


def test_publish_errors_are_raised(spark):
    with pytest.raises(Exception, match="(?i)no_such_format"):
        tables.publish(aggregated(spark, ("2024-01-01", "A", 1, 2)), "plain_failed", fmt="no_such_format")


def test_required_inputs(spark):
    with pytest.raises(FileNotFoundError, match="no_table"):
        tables.require_table(spark, "no_table")
    with pytest.raises(FileNotFoundError, match="dim_date"):
        tables.require_inputs({"dim_date": None}, ["dim_date"], "facts")


def test_csv_round_trip(spark, tmp_path):
    fact = aggregated(spark, ("2024-02-01", 'B "x", y', 3, None), ("2024-01-01", "A", 1, 2))
    path = str(tmp_path / "fact.csv")
    tables.write_csv(fact, path, ["date_key", "office_location"])
    assert rows(tables.read_csv(spark, path, TABLES["fact_occupancy_aggregated"])) == rows(fact)


def test_reports(spark, tmp_path):
    fact = aggregated(
        spark,
        ("2024-01-01", "B", 4, 2),
        ("2024-01-02", "B", 4, None),
        ("2024-01-01", "A", 1, 2),
        ("2024-01-06", "A", 9, 2),
        ("2024-01-01", "C", 0, None),
    ).withColumn("line_of_business", F.lit("x"))
    daily = fact.select("date", "attendance_count")
    snapshots = spark.createDataFrame([(day("2024-01-02"),)], "date date")
    locations = fact.select("office_location").distinct()
    reports = quality.quality_report(fact, fact, locations, daily, snapshots)
    written = tables.write_reports(reports, str(tmp_path))
    assert "deskcount_merge_issues" not in written and "over_capacity_days" in written
    summary = spark.read.text(str(tmp_path / "validation_summary"))
    assert [r.value for r in summary.collect()] == [
        "== Summary ==",
        "Fact rows: 5; Agg rows: 5",
        "Fact date range: 2024-01-01 to 2024-01-06",
        "Agg date range: 2024-01-01 to 2024-01-06",
        "Locations: 3 (dim: 3)",
        "LOBs: 1 (in fact)",
        "Mean occupancy (weekday): 1.250; (weekend): 4.500",
        "Rows with attendance>0 and deskcount==0: 0 (0.0%)",
        "Rows with occupancy_rate > 1.0: 2 (40.0%)",
        "Latest occupancy: 2024-01-06, latest deskcount: 2024-01-02, gap: 4 days",
    ]
    by_office = spark.read.option("header", True).csv(str(tmp_path / "by_location_summary")).collect()
    assert [tuple(r) for r in by_office] == [
        ("B", "2", "2.0", "0", "1"),
        ("A", "1", "0.5", "0", "0"),
        ("C", "1", None, "0", "0"),
    ]


def test_merge_issue_needs_zero_desks(spark):
    fact = spark.createDataFrame(
        [(day("2024-01-01"), "A", "x", 2, 0), (day("2024-01-01"), "B", "x", 2, None), (day("2024-01-01"), "C", "x", 0, 0)],
        "date date, office_location string, line_of_business string, attendance_count bigint, deskcount int",
    )
    assert rows(quality.merge_issues(fact), "office_location") == [("A",)]
    assert rows(quality.missing_capacity(fact), "office_location") == [("B",)]


def _read_quoted(spark, path, block):
    """Rows of a feed read in blocks of this many bytes, in order."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(block))
    try:
        combined = csv_feeds.combine_feed(spark, str(path), DESKCOUNT, columns=["OfficeLocation", "Address", "n"])
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    ordered = combined.rows.orderBy("source_file", "source_block", "row_pos").collect()
    return ordered, {r.source_file.rsplit("/", 1)[1]: r.error for r in combined.rejected.collect()}


@pytest.mark.parametrize("block", [60, 700, 10_000_000])
def test_quoted_line_breaks_in_any_blocks(spark, tmp_path, block):
    """Texts that go on over lines and whole blocks, against Python's own reader."""
    rng = random.Random(block)
    pieces = ["x", "a,b", "\n", '"', '""', "\r\n", "\n\n", ",", '","', ' "', "1", "long text " * 20, ",\n", '\n"', '"\n']
    cell = lambda: "".join(rng.choice(pieces) for _ in range(rng.randrange(4)))
    want = [[cell() or "o", cell() or "y", str(i)] for i in range(300)]
    want[150][1] = "\n".join(f'line {i}, "said" so' for i in range(200))
    buffer = io.StringIO()
    csv.writer(buffer).writerows([["OfficeLocation", "Address", "n"], *want])
    put(tmp_path / "a.csv", buffer.getvalue())
    put(tmp_path / "b.csv", 'n,OfficeLocation\n1,5" pipe\n2,B\n')  # a quote that opens nothing
    put(tmp_path / "c.csv", 'OfficeLocation,n\nA,1\n"no end,2\nB,3\n')
    got, left = _read_quoted(spark, tmp_path, block)
    own = [[r.OfficeLocation, r.Address, r.n] for r in got if r.source_file.endswith("a.csv")]
    texts = [[v if v not in NULL_TOKENS else None for v in row] for row in want]
    assert own == texts
    assert [(r.OfficeLocation, r.n) for r in got if r.source_file.endswith("b.csv")] == [('5" pipe', "1"), ("B", "2")]
    assert left == {"c.csv": "a quoted text does not end"}
    if block < 1000:
        assert len({r.source_block for r in got if r.source_file.endswith("a.csv")}) > 5


def test_lines_of_quoted_records_are_not_staged(spark, tmp_path, monkeypatch):
    """Records are staged and a few lines at the blocks' ends; all lines were, twice."""
    staged, stage = [], quoted_csv.stage

    def counted(df, label):
        done = stage(df, label)
        staged.append(done.count())
        return done

    monkeypatch.setattr(quoted_csv, "stage", counted)
    records = [f'{i},"o{i}\n' + "floor\n" * 40 + 'end"\n' for i in range(500)]
    put(tmp_path / "a.csv", "n,OfficeLocation\n" + "".join(records))
    got, _ = _read_quoted(spark, tmp_path, 20_000)
    assert [(r.n, r.OfficeLocation) for r in got] == [(str(i), f"o{i}\n" + "floor\n" * 40 + "end") for i in range(500)]
    assert sum(staged) < 500 * 42 / 4


@pytest.mark.parametrize("by_name", [1000, -1])
def test_files_with_and_without_broken_quotes(spark, tmp_path, monkeypatch, by_name):
    """Each file is read one way, whether the broken ones are named or joined."""
    monkeypatch.setattr(csv_feeds, "_NAMED_FILES", by_name)
    put(tmp_path / "a %41.csv", "n,OfficeLocation\n" + "".join(f'{i},"o\n{i}"\n' for i in range(200)))
    put(tmp_path / "b.csv", "OfficeLocation,n\n" + "".join(f'"p, {i}",{i}\n' for i in range(200)))
    got, left = _read_quoted(spark, tmp_path, 500)
    want = [(str(i), office.format(i)) for office in ("o\n{}", "p, {}") for i in range(200)]
    assert [(r.n, r.OfficeLocation) for r in got] == want
    assert left == {}


def test_statistics_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    n = F.col("id")
    frame = spark.range(1000).select(
        n, F.when(n % 3 != 0, n.cast("int")).alias("a b"), F.concat(F.lit("x"), n).alias("t"), F.lit(None).cast("date").alias("d"),
        (n % 2 == 0).alias("f"), (n % 2).alias("part"), F.when(n != 7, n / 7).alias("r"),
    )
    frame.write.partitionBy("part").parquet(path)
    nulls, ranges = statistics.null_counts(spark, path), statistics.ranges(spark, path, ["part"])
    assert statistics.is_pushed(nulls)
    assert statistics.is_pushed(statistics.extremes(statistics.footers(spark, path), ["id", "f"]))
    assert {r.column: r.nulls for r in nulls.collect()} == {"id": 0, "a b": 334, "t": 0, "d": 1000, "f": 0, "part": 0, "r": 1}
    assert {r.column: (r.least, r.most) for r in ranges.collect()} == {
        "id": ("0", "999"), "a b": ("1", "998"), "d": (None, None), "f": ("false", "true")
    }
    assert not statistics.is_pushed(statistics.footers(spark, path).agg(F.sum("id")))
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"  # the caller's session is as it was
    empty = str(tmp_path / "empty")
    frame.limit(0).drop("part").write.parquet(empty)
    assert {r.nulls for r in statistics.null_counts(spark, empty).collect()} == {0}
    assert {(r.least, r.most) for r in statistics.ranges(spark, empty).collect()} == {(None, None)}
