"""Workbooks for the registered query and the tests: a table written as .xlsx files.

The library reads workbooks; nothing of it writes them. The given tables have
no workbooks, so the registered query makes some from a whole table first.
"""

from __future__ import annotations

import datetime as _dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.sax.saxutils import escape

import pandas as pd
from pyspark.sql import DataFrame

from vellum.session import ship_package

_EXCEL_EPOCH = _dt.date(1899, 12, 30)


def _cell_ref(col: int, row: int) -> str:
    letters = ""
    col += 1
    while col:
        col, rem = divmod(col - 1, 26)
        letters = chr(65 + rem) + letters
    return f"{letters}{row}"


_CONTENT_TYPES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types">'
    '<Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
    '<Default Extension="xml" ContentType="application/xml"/>'
    '<Override PartName="/xl/workbook.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>'
    '<Override PartName="/xl/worksheets/sheet1.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>'
    '<Override PartName="/xl/styles.xml" '
    'ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/>'
    "</Types>"
)
_ROOT_RELS = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" '
    'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" '
    'Target="xl/workbook.xml"/></Relationships>'
)
_WORKBOOK = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" '
    'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships">'
    '<sheets><sheet name="Sheet1" sheetId="1" r:id="rId1"/></sheets></workbook>'
)
_WORKBOOK_RELS = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
    '<Relationship Id="rId1" '
    'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" '
    'Target="worksheets/sheet1.xml"/>'
    '<Relationship Id="rId2" '
    'Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/styles" '
    'Target="styles.xml"/></Relationships>'
)
# Style 1 = built-in number format 14 (a short date), style 2 = format 22 (date and time).
_STYLES = (
    '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
    '<styleSheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main">'
    '<fonts count="1"><font/></fonts><fills count="1"><fill/></fills>'
    '<borders count="1"><border/></borders>'
    '<cellStyleXfs count="1"><xf/></cellStyleXfs>'
    '<cellXfs count="3"><xf/><xf numFmtId="14" applyNumberFormat="1"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs>'
    "</styleSheet>"
)
_BAD_XML = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f]")


def _cell(ref: str, v) -> str:
    if v is None or (isinstance(v, float) and v != v):
        return ""
    if isinstance(v, bool):
        return f'<c r="{ref}" t="b"><v>{int(v)}</v></c>'
    if isinstance(v, (int, float)):
        return f'<c r="{ref}"><v>{repr(v) if isinstance(v, float) else v}</v></c>'
    if isinstance(v, _dt.datetime):
        days = (v - _dt.datetime.combine(_EXCEL_EPOCH, _dt.time())) / _dt.timedelta(days=1)
        return f'<c r="{ref}" s="2"><v>{days!r}</v></c>'
    if isinstance(v, _dt.date):
        return f'<c r="{ref}" s="1"><v>{(v - _EXCEL_EPOCH).days}</v></c>'
    if _BAD_XML.search(str(v)):
        raise ValueError(f"a workbook cannot hold the control characters of {str(v)!r}")
    text = escape(str(v))
    return f'<c r="{ref}" t="inlineStr"><is><t xml:space="preserve">{text}</t></is></c>'


def workbook_bytes(header: list[str], rows: list[tuple]) -> bytes:
    """A one-sheet .xlsx (inline strings; dates as day serials with a date style)."""
    lines = ['<row r="1">' + "".join(_cell(_cell_ref(i, 1), h) for i, h in enumerate(header)) + "</row>"]
    for r, row in enumerate(rows, start=2):
        lines.append(f'<row r="{r}">' + "".join(_cell(_cell_ref(i, r), v) for i, v in enumerate(row)) + "</row>")
    sheet = (
        '<?xml version="1.0" encoding="UTF-8" standalone="yes"?>'
        '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>'
        + "".join(lines)
        + "</sheetData></worksheet>"
    )
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("[Content_Types].xml", _CONTENT_TYPES)
        z.writestr("_rels/.rels", _ROOT_RELS)
        z.writestr("xl/workbook.xml", _WORKBOOK)
        z.writestr("xl/_rels/workbook.xml.rels", _WORKBOOK_RELS)
        z.writestr("xl/styles.xml", _STYLES)
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    return buf.getvalue()


def _arrow_uri(folder: str) -> str:
    if folder.startswith("file:") and not folder.startswith("file://"):
        return "file://" + folder[len("file:"):]
    return folder


def write_workbooks(df: DataFrame, folder: str, books: int | None = None) -> DataFrame:
    """Lazily write ``df`` as workbooks under ``folder``; returns (path, rows)
    per written file -- trigger it with an action.

    One workbook per Arrow batch of each partition; ``books`` spreads the
    rows round-robin over that many partitions first (for inputs that arrive
    in few, large partitions).
    """
    ship_package(df.sparkSession)
    if books:
        df = df.repartition(books)
    header = df.columns
    uri = _arrow_uri(folder)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.fs as pafs
        from pyspark import TaskContext

        fs, base = pafs.FileSystem.from_uri(uri)
        fs.create_dir(base, recursive=True)
        part = TaskContext.get().partitionId()
        for b, pdf in enumerate(batches):
            cols = []
            for c in pdf.columns:
                values = pdf[c].tolist()
                cols.append([None if (not isinstance(v, str) and pd.isna(v)) else v for v in values])
            rows = [tuple(v.to_pydatetime() if isinstance(v, pd.Timestamp) else v for v in rec) for rec in zip(*cols)]
            name = f"{base}/part-{part:05d}-{b:05d}.xlsx"
            with fs.open_output_stream(name) as fh:
                fh.write(workbook_bytes(header, rows))
            yield pd.DataFrame({"path": [name], "rows": [len(rows)]})

    return df.mapInPandas(write, "path string, rows bigint")
