import datetime as dt
import io
import os
import zipfile

from vellum.session import local_path
from vellum.plans.workbook_files import workbook_bytes, write_workbooks
from vellum.sources.workbooks import iter_sheet_rows, read_workbooks


def _shared_strings_book() -> bytes:
    """A workbook the way spreadsheet programs write it: shared strings, a
    second sheet that must be ignored, a sparse row."""
    main = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    rel = "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    pkg = "http://schemas.openxmlformats.org/package/2006/relationships"
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr(
            "xl/workbook.xml",
            f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>'
            '<sheet name="Data" sheetId="1" r:id="rId7"/><sheet name="Other" sheetId="2" r:id="rId8"/>'
            "</sheets></workbook>",
        )
        z.writestr(
            "xl/_rels/workbook.xml.rels",
            f'<Relationships xmlns="{pkg}">'
            '<Relationship Id="rId8" Type="x" Target="worksheets/sheet2.xml"/>'
            '<Relationship Id="rId7" Type="x" Target="worksheets/sheet1.xml"/></Relationships>',
        )
        z.writestr(
            "xl/sharedStrings.xml",
            f'<sst xmlns="{main}"><si><t>name</t></si><si><t>qty</t></si>'
            "<si><r><t>Ju</t></r><r><t>an</t></r><rPh sb=\"0\" eb=\"2\"><t>KANA</t></rPh></si></sst>",
        )
        z.writestr(
            "xl/worksheets/sheet1.xml",
            f'<worksheet xmlns="{main}"><sheetData>'
            '<row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>1</v></c></row>'
            '<row r="2"><c r="A2" t="s"><v>2</v></c><c r="B2"><v>1.5</v></c></row>'
            '<row r="4"><c r="B4"><v>7</v></c></row>'
            "</sheetData></worksheet>",
        )
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet xmlns="{main}"><sheetData/></worksheet>')
    return buf.getvalue()


def test_parse_shared_strings_first_sheet():
    rows = list(iter_sheet_rows(_shared_strings_book()))
    assert rows == [["name", "qty"], ["Juan", "1.5"], [None, "7"]]
    assert list(iter_sheet_rows(_shared_strings_book(), "Data")) == rows
    assert list(iter_sheet_rows(_shared_strings_book(), 2)) == []
    assert list(iter_sheet_rows(_shared_strings_book(), "Other")) == []


def test_folder_of_three_workbooks(spark, workdir):
    folder = workdir("books")
    p = local_path(folder)
    os.makedirs(p)
    header = ["code", "amount", "issued"]
    for i in range(3):
        rows = [(f"c{i}{j}", float(j) + 0.25, dt.date(2025, 1 + i, 1 + j)) for j in range(4)]
        with open(os.path.join(p, f"book{i}.xlsx"), "wb") as f:
            f.write(workbook_bytes(header, rows))
    with open(os.path.join(p, "shared.xlsx"), "wb") as f:
        f.write(_shared_strings_book())
    contract = {"code": "String", "amount": "Float64", "issued": "Date"}
    df = read_workbooks(spark, folder, contract=contract, glob="book*.xlsx")
    got = sorted(tuple(r) for r in df.collect())
    assert len(got) == 12
    assert got[0] == ("c00", 0.25, dt.date(2025, 1, 1))
    # Header discovery across files when no columns are given.
    text = read_workbooks(spark, folder)
    assert text.columns == ["code", "amount", "issued", "name", "qty"]
    assert dict(text.dtypes) == {"code": "string", "amount": "double", "issued": "date", "name": "string", "qty": "double"}
    assert text.count() == 14 and text.where("issued = '2025-01-01'").count() == 1


def test_repeated_or_empty_header_names_are_refused(spark, workdir):
    import pytest

    for i, header in enumerate((["a", "b", "a"], ["a", None, "c"])):
        folder = workdir(f"books-bad{i}")
        os.makedirs(local_path(folder))
        with open(os.path.join(local_path(folder), "b.xlsx"), "wb") as f:
            f.write(workbook_bytes(header, [(1, 2, 3)]))
        for kw in ({}, {"contract": {"a": "UInt32"}}):
            with pytest.raises(Exception, match="repeated or empty names"):
                read_workbooks(spark, folder, **kw).collect()


def test_types_and_times_without_a_contract(spark, workdir):
    folder = workdir("books-types")
    os.makedirs(local_path(folder))
    rows = [(1, 0.5, True, dt.datetime(2024, 2, 29, 13, 30, 5), "x", None), (2, 3, False, dt.datetime(1999, 12, 31), "7", None)]
    with open(os.path.join(local_path(folder), "b.xlsx"), "wb") as f:
        f.write(workbook_bytes(["i", "d", "b", "t", "s", "n"], rows))
    df = read_workbooks(spark, folder)
    assert dict(df.dtypes) == {"i": "bigint", "d": "double", "b": "boolean", "t": "timestamp_ntz", "s": "string", "n": "string"}
    assert sorted(tuple(r) for r in df.collect()) == rows


def test_write_then_read_round_trip(spark, workdir):
    df = spark.createDataFrame(
        [(1, "a", 2.5, dt.date(2024, 2, 29)), (2, None, None, None)], "id bigint, s string, x double, d date"
    )
    folder = workdir("books-rt")
    assert write_workbooks(df, folder).groupBy().sum("rows").first()[0] == 2
    back = read_workbooks(spark, folder, contract={"id": "UInt32", "s": "String", "x": "Float64", "d": "Date"})
    assert sorted(tuple(r) for r in back.collect()) == [(1, "a", 2.5, dt.date(2024, 2, 29)), (2, None, None, None)]


def _in_1904(book: bytes) -> bytes:
    buf = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(book)) as old, zipfile.ZipFile(buf, "w") as z:
        for name in old.namelist():
            part = old.read(name)
            z.writestr(name, part.replace(b"<sheets>", b'<workbookPr date1904="1"/><sheets>') if name == "xl/workbook.xml" else part)
    return buf.getvalue()


def test_dates_of_the_1904_system(spark, workdir):
    folder = workdir("books-1904")
    os.makedirs(local_path(folder))
    book = workbook_bytes(["d", "t"], [(dt.date(2020, 2, 27), dt.datetime(2020, 2, 27, 6, 30)), (None, None)])
    # The same serials lie 1,462 days later there.
    for name, content in (("a.xlsx", book), ("b.xlsx", _in_1904(book))):
        with open(os.path.join(local_path(folder), name), "wb") as f:
            f.write(content)
    got = [tuple(r) for r in read_workbooks(spark, folder).where("d IS NOT NULL").orderBy("d").collect()]
    later = dt.timedelta(days=1462)
    first = (dt.date(2020, 2, 27), dt.datetime(2020, 2, 27, 6, 30))
    assert got == [first, (first[0] + later, first[1] + later)]
