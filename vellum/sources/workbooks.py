"""Folders of workbooks (.xlsx): first sheet, first row as header.

A single workbook is not Spark-sized, a folder of them is: the folder is
listed with the ``binaryFile`` source (one row per file, split into tasks by
file size), each task parses its files with the standard library (zip + XML,
streaming rows), and the cells come out as text keyed by header name. Types
are then applied with column expressions (``try_cast``; Excel day serials for
date columns), so the typing step stays in the JVM.

A workbook holds at most 1,048,576 rows by the format's own limit, so one
file is a bounded unit of work for one task; its rows are streamed from the
sheet XML and handed back in chunks of 100,000, so a task holds one chunk.
"""

from __future__ import annotations

import datetime as _dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree as ET

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.contracts import spark_type
from vellum.functions.casts import guarded_try_cast
from vellum.session import ship_package

_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_PR = "{http://schemas.openxmlformats.org/package/2006/relationships}"
_EXCEL_EPOCH = _dt.date(1899, 12, 30)


def _col_number(ref: str) -> int:
    n = 0
    for ch in ref:
        if ch.isalpha():
            n = n * 26 + (ord(ch.upper()) - 64)
        else:
            break
    return n - 1


def _text_of(elem) -> str:
    """The text of a string item: its own or its runs', without phonetic hints (``rPh``)."""
    return "".join(t.text or "" for t in [*elem.findall(f"{_M}t"), *elem.findall(f"{_M}r/{_M}t")])


# Built-in number formats that show dates or times (fixed values of the file format).
_DATE_FORMATS = {*range(14, 23), *range(27, 37), *range(45, 48), *range(50, 59)}


def _date_styles(z: zipfile.ZipFile) -> set[str]:
    """Numbers of the cell styles that show dates."""
    if "xl/styles.xml" not in z.namelist():
        return set()
    root = ET.fromstring(z.read("xl/styles.xml"))
    plain = re.compile(r'"[^"]*"|\\.|\[[^\]]*\]')
    custom = {f.get("numFmtId") for f in root.iter(f"{_M}numFmt") if re.search("[ymdhYMDH]", plain.sub("", f.get("formatCode", "")))}
    styles = root.findall(f"{_M}cellXfs/{_M}xf")
    return {str(i) for i, x in enumerate(styles) if x.get("numFmtId") in custom or int(x.get("numFmtId", 0)) in _DATE_FORMATS}


def _first_day(z: zipfile.ZipFile) -> _dt.datetime:
    """Day 0 of the workbook's serials: of the 1904 date system where the workbook says so."""
    props = ET.fromstring(z.read("xl/workbook.xml")).find(f"{_M}workbookPr")
    if props is not None and props.get("date1904", "0").lower() in ("1", "true", "on"):
        return _dt.datetime(1904, 1, 1)
    return _dt.datetime.combine(_EXCEL_EPOCH, _dt.time())


def _date_text(serial: str, first_day: _dt.datetime) -> str:
    """A day serial as ISO text, with the time where there is one."""
    t = first_day + _dt.timedelta(seconds=round(float(serial) * 86400))
    return t.date().isoformat() if t.time() == _dt.time() else t.isoformat(sep=" ")


def _sheet_path(z: zipfile.ZipFile, sheet: str | int | None = None) -> str:
    """Zip path of a sheet: the first (None), by 1-based position, or by name."""
    wb = ET.fromstring(z.read("xl/workbook.xml"))
    sheets = wb.findall(f"{_M}sheets/{_M}sheet")
    if sheet is None:
        chosen = sheets[0] if sheets else None
    elif isinstance(sheet, int):
        chosen = sheets[sheet - 1] if 0 < sheet <= len(sheets) else None
    else:
        chosen = next((sh for sh in sheets if sh.get("name") == sheet), None)
    if chosen is None:
        raise ValueError(f"workbook has no sheet {sheet!r}")
    rid = chosen.get(f"{_R}id")
    rels = ET.fromstring(z.read("xl/_rels/workbook.xml.rels"))
    for rel in rels.iter(f"{_PR}Relationship"):
        if rel.get("Id") == rid:
            target = rel.get("Target")
            return target.lstrip("/") if target.startswith("/") else "xl/" + target
    raise ValueError(f"workbook sheet {sheet!r} has no part")


def iter_sheet_rows(content: bytes, sheet: str | int | None = None) -> Iterator[list[str | None]]:
    """Rows of a sheet (default: the first) as lists of cell text (None for
    empty cells)."""
    z = zipfile.ZipFile(io.BytesIO(content))
    dates, first_day = _date_styles(z), _first_day(z)
    shared: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        for si in ET.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_M}si"):
            shared.append(_text_of(si))
    with z.open(_sheet_path(z, sheet)) as fh:
        for _, elem in ET.iterparse(fh):
            if elem.tag != f"{_M}row":
                continue
            cells: dict[int, str | None] = {}
            for i, c in enumerate(elem.iter(f"{_M}c")):
                ref = c.get("r")
                idx = _col_number(ref) if ref else i
                kind = c.get("t", "n")
                v = c.find(f"{_M}v")
                if kind == "s":
                    val = shared[int(v.text)] if v is not None else None
                elif kind == "inlineStr":
                    is_ = c.find(f"{_M}is")
                    val = _text_of(is_) if is_ is not None else None
                elif kind == "b":
                    val = None if v is None else ("true" if v.text == "1" else "false")
                elif kind == "e":
                    val = None
                else:
                    val = v.text if v is not None else None
                    if val is not None and kind == "n" and c.get("s") in dates:
                        val = _date_text(val, first_day)
                cells[idx] = val
            width = max(cells) + 1 if cells else 0
            yield [cells.get(i) for i in range(width)]
            elem.clear()


_CHUNK_ROWS = 100_000


def _header(path: str, rows: Iterator[list[str | None]]) -> list[str] | None:
    """The header row; repeated or missing names are refused, as their columns could not be told apart."""
    header = next(rows, None)
    if header is not None and (None in header or "" in header or len(set(header)) < len(header)):
        raise ValueError(f"{path}: the header row has repeated or empty names: {header}")
    return header


def _parse_batches(columns: list[str], sheet: str | int | None = None):
    """Rows of each file, yielded in chunks of at most ``_CHUNK_ROWS`` so a
    task never holds more than one chunk of parsed cells."""
    names = ["_file", "_row", *columns]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                rows = iter_sheet_rows(bytes(content), sheet)
                header = _header(path, rows)
                if header is None:
                    continue
                pos = {name: i for i, name in enumerate(header)}
                out = {n: [] for n in names}
                for n, row in enumerate(rows, start=1):
                    if not any(v not in (None, "") for v in row):
                        continue
                    out["_file"].append(path)
                    out["_row"].append(n)
                    for c in columns:
                        i = pos.get(c)
                        out[c].append(row[i] if i is not None and i < len(row) else None)
                    if len(out["_row"]) >= _CHUNK_ROWS:
                        yield pd.DataFrame(out, columns=names)
                        out = {n: [] for n in names}
                if out["_row"]:
                    yield pd.DataFrame(out, columns=names)

    return parse


def _headers(sheet: str | int | None = None):
    def heads_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                names = _header(path, iter_sheet_rows(bytes(content), sheet)) or []
                yield pd.DataFrame({"path": path, "position": range(len(names)), "name": names})

    return heads_of


def _inferred(text: DataFrame, columns: list[str]) -> list:
    """Typed columns: bigint, double, boolean, date or timestamp where every value of a column has that form, else text."""
    forms = {
        "bigint": r"^-?\d{1,18}$",
        "double": r"^-?\d+(\.\d+)?([eE][-+]?\d+)?$",
        "boolean": r"^(true|false)$",
        "date": r"^\d{4}-\d\d-\d\d$",
        "timestamp_ntz": r"^\d{4}-\d\d-\d\d( \d\d:\d\d:\d\d)?$",
    }
    probes = []
    for i, name in enumerate(columns):
        c = F.col(f"`{name}`")
        probes.append(F.count(c).alias(f"n{i}"))
        probes += [F.count_if(c.rlike(form)).alias(f"{kind}{i}") for kind, form in forms.items()]
    seen = text.agg(*probes).first().asDict() if columns else {}
    out = []
    for i, name in enumerate(columns):
        kind = next((k for k in forms if seen[f"n{i}"] and seen[f"{k}{i}"] == seen[f"n{i}"]), "string")
        out.append(F.col(f"`{name}`").try_cast(kind).alias(name))
    return out


def _typed(c, dt: T.DataType):
    if isinstance(dt, T.StringType):
        return c
    if isinstance(dt, T.DateType):
        serial = guarded_try_cast(c, "double")
        return F.when(serial.isNotNull(), F.date_add(F.lit(_EXCEL_EPOCH), serial.cast("int"))).otherwise(
            c.try_cast("date")
        )
    if isinstance(dt, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
        return F.when(c.rlike(r"^\s*-?\d+(\.0+)?\s*$"), c.try_cast("double").cast(dt))
    return guarded_try_cast(c, dt)


def read_workbooks(
    spark: SparkSession,
    path: str,
    *,
    columns: list[str] | None = None,
    contract: dict[str, str] | None = None,
    glob: str = "*.xlsx",
    with_source: bool = False,
    sheet: str | int | None = None,
) -> DataFrame:
    """All workbooks under ``path`` as one DataFrame.

    ``sheet``: the sheet to read in every workbook -- None for the first, a
    1-based position, or a name. Columns: ``contract`` (typed), else
    ``columns`` (text), else the union of the headers found (a pass over the
    files' header rows), with types inferred from all values (one aggregation).
    Dates come as dates by their cells' number format, counted from 1904 in
    workbooks of that date system; plain numbers in a contract's date column
    are taken as serials of the 1900 system. A header row with
    repeated or empty names is an error.
    """
    ship_package(spark)
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "content")
    )
    infer = False
    if contract is not None:
        columns = list(contract)
    if columns is None:
        # One row per column name, in the order of the files' paths and of the columns in them.
        heads = files.mapInPandas(_headers(sheet), "path string, position int, name string")
        first = heads.groupBy("name").agg(F.min(F.struct("path", "position")).alias("at")).orderBy("at")
        columns = [r.name for r in first.select("name").collect()]
        infer = True
    schema = "_file string, _row bigint" + "".join(f", `{c}` string" for c in columns)
    text = files.mapInPandas(_parse_batches(columns, sheet), schema)
    if contract is not None:
        typed = [_typed(F.col(f"`{c}`"), spark_type(t)).alias(c) for c, t in contract.items()]
    else:
        typed = _inferred(text, columns) if infer else [F.col(f"`{c}`") for c in columns]
    extra = [F.col("_file"), F.col("_row")] if with_source else []
    return text.select(*extra, *typed)
