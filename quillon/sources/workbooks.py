"""Spreadsheets in the Office Open XML form, without a spreadsheet library.

A workbook is a ZIP of XML parts. Spark reads the files, wherever they lie, a task takes one workbook at a time and
streams the wanted sheets' rows out of their XML: shared and inline strings, numbers, booleans, dates by their number
format, gaps by cell reference. Columns asked for as strings stay as they are written, so codes keep leading zeros.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree.ElementTree import iterparse
from xml.sax.saxutils import escape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_LETTERS = re.compile(r"([A-Z]+)")
#: Built-in number formats that are dates or times.
_DATES = frozenset((*range(14, 23), *range(45, 48)))
_EPOCH = dt.datetime(1899, 12, 30)


def _local(tag: str) -> str:
    return tag.rpartition("}")[2]


def _column(reference: str) -> int:
    n = 0
    for c in _LETTERS.match(reference)[1]:
        n = n * 26 + ord(c) - 64
    return n - 1


def _parts(book: zipfile.ZipFile, name: str, *wanted: str) -> Iterator[tuple[str, dict[str, str], str]]:
    """(tag, attributes, all text inside) of the wanted elements of a part; nothing if it is missing. Phonetic readings are left out."""
    if name not in book.namelist():
        return
    with book.open(name) as part:
        for _, e in iterparse(part):
            tag = _local(e.tag)
            if tag == "rPh":
                e.clear()
            elif tag in wanted:
                yield tag, {_local(k): v for k, v in e.attrib.items()}, "".join(t.text or "" for t in e.iter() if _local(t.tag) == "t")
                e.clear()


def sheets(book: zipfile.ZipFile) -> list[tuple[str, str]]:
    """(name, part) of the sheets, in the workbook's order."""
    targets = {a["Id"]: a["Target"] for _, a, _ in _parts(book, "xl/_rels/workbook.xml.rels", "Relationship")}
    full = lambda t: t.lstrip("/") if t.startswith("/") else f"xl/{t}"
    return [(a["name"], full(targets[a["id"]])) for _, a, _ in _parts(book, "xl/workbook.xml", "sheet")]


def _date_styles(book: zipfile.ZipFile) -> set[int]:
    """Numbers of the cell styles whose format is a date."""
    custom: dict[int, str] = {}
    styles: list[int] = []
    inside = False
    if "xl/styles.xml" in book.namelist():
        with book.open("xl/styles.xml") as part:
            for event, e in iterparse(part, ("start", "end")):
                tag = _local(e.tag)
                if tag == "cellXfs":
                    inside = event == "start"
                elif event == "start" and tag == "numFmt":
                    custom[int(e.get("numFmtId"))] = re.sub(r'"[^"]*"|\[[^\]]*\]|\\.', "", e.get("formatCode") or "")
                elif event == "start" and tag == "xf" and inside:
                    styles.append(int(e.get("numFmtId") or 0))
    return {i for i, f in enumerate(styles) if f in _DATES or (f in custom and re.search("[ymdhs]", custom[f], re.IGNORECASE))}


def rows_of(data: bytes, sheet: str | int = 0) -> Iterator[tuple[int, dict[int, str]]]:
    """(row number from 1, text by column) of a sheet, by name or place; rows without a value are left out. An unknown sheet is a ValueError."""
    with zipfile.ZipFile(io.BytesIO(data)) as book:
        known = sheets(book)
        part = next((p for i, (n, p) in enumerate(known) if sheet in (n, i)), None)
        if part is None:
            raise ValueError(f"no sheet {sheet!r} among {[n for n, _ in known]}")
        shared = [text for _, _, text in _parts(book, "xl/sharedStrings.xml", "si")]
        dates = _date_styles(book)
        with book.open(part) as xml:
            number, cells, at = 0, {}, -1
            for event, e in iterparse(xml, ("start", "end")):
                tag = _local(e.tag)
                if event == "start":
                    if tag == "row":
                        number, cells, at = int(e.get("r") or number + 1), {}, -1
                    elif tag == "c":
                        at = _column(e.get("r")) if e.get("r") else at + 1
                elif tag == "c":
                    value = next((x.text for x in e if _local(x.tag) == "v"), None)
                    kind = e.get("t") or "n"
                    if kind == "inlineStr":
                        value = "".join(t.text or "" for t in e.iter() if _local(t.tag) == "t")
                    elif value is not None and kind == "s":
                        value = shared[int(value)]
                    elif value is not None and kind == "b":
                        value = "true" if value == "1" else "false"
                    elif value is not None and kind == "n":
                        value = _number(value, int(e.get("s") or 0) in dates)
                    if value not in (None, "") and kind != "e":
                        cells[at] = value
                elif tag == "row":
                    if cells:
                        yield number, cells
                    e.clear()


def _number(value: str, date: bool) -> str:
    x = float(value)
    if date:
        at = _EPOCH + dt.timedelta(days=x)
        at = (at + dt.timedelta(microseconds=500_000)).replace(microsecond=0)
        return at.date().isoformat() if x == int(x) else at.isoformat(sep=" ")
    return str(int(x)) if x == int(x) and abs(x) < 1e15 else repr(x)


def read(spark: SparkSession, path: str, schema: str, sheet: str | int = 0, skip: int = 0, header: bool = True, with_path: bool = False) -> DataFrame:
    """The rows of a sheet of each workbook below path: after `skip` rows a header (by whose names columns are found), then data.

    Without a header columns go by place. A column that the header lacks is null, a value that is none of its type too;
    rows are in no order; with_path adds `path` and `row`, the row's number in its sheet.
    """
    wanted = T.StructType.fromDDL(schema)
    names = [f.name for f in wanted]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").option("recursiveFileLookup", True).load(path).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                places = None if header else list(range(len(names)))
                out: list[tuple] = []
                for number, cells in rows_of(data.as_py(), sheet):
                    if number <= skip:
                        continue
                    if places is None:
                        by_name = {v.strip(): k for k, v in reversed(list(cells.items()))}
                        places = [by_name.get(n, -1) for n in names]
                        continue
                    out.append((at, number, [cells.get(p) for p in places]))
                    if len(out) == 4096:
                        yield _batch(out)
                        out = []
                yield _batch(out)

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.int64()), pa.array([x[2] for x in out], pa.list_(pa.string()))], ["path", "row", "cells"])

    found = files.mapInArrow(run, "path string, row long, cells array<string>")
    columns = [F.col("cells")[i].try_cast(f.dataType).alias(f.name) for i, f in enumerate(wanted)]
    return found.select(*[F.col(c) for c in ("path", "row") if with_path], *columns)


def workbook(rows: list[list[str | float | None]], sheet: str = "Sheet1") -> bytes:
    """A workbook of one sheet: strings as shared strings, numbers as numbers, null cells left out."""
    letters = lambda i: (letters(i // 26 - 1) if i >= 26 else "") + chr(65 + i % 26)
    shared: dict[str, int] = {}
    body = []
    for r, row in enumerate(rows, 1):
        cells = []
        for c, v in enumerate(row):
            if isinstance(v, str):
                cells.append(f'<c r="{letters(c)}{r}" t="s"><v>{shared.setdefault(v, len(shared))}</v></c>')
            elif v is not None:
                cells.append(f'<c r="{letters(c)}{r}"><v>{v!r}</v></c>')
        body.append(f'<row r="{r}">{"".join(cells)}</row>')
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    kinds = "application/vnd.openxmlformats-officedocument.spreadsheetml"
    parts = {
        "[Content_Types].xml": '<Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/>'
        f'<Override PartName="/xl/workbook.xml" ContentType="{kinds}.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="{kinds}.worksheet+xml"/>'
        f'<Override PartName="/xl/sharedStrings.xml" ContentType="{kinds}.sharedStrings+xml"/></Types>',
        "_rels/.rels": f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Type="{rel}/officeDocument" Target="xl/workbook.xml"/></Relationships>',
        "xl/workbook.xml": f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets><sheet name="{escape(sheet, {chr(34): "&quot;"})}" sheetId="1" r:id="r1"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">'
        f'<Relationship Id="r1" Type="{rel}/worksheet" Target="worksheets/sheet1.xml"/><Relationship Id="r2" Type="{rel}/sharedStrings" Target="sharedStrings.xml"/></Relationships>',
        "xl/worksheets/sheet1.xml": f'<worksheet xmlns="{main}"><sheetData>{"".join(body)}</sheetData></worksheet>',
        "xl/sharedStrings.xml": f'<sst xmlns="{main}">{"".join(f"<si><t xml:space={chr(34)}preserve{chr(34)}>{escape(s)}</t></si>" for s in shared)}</sst>',
    }
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as book:
        for name, text in parts.items():
            book.writestr(name, f'<?xml version="1.0" encoding="UTF-8" standalone="yes"?>{text}')
    return out.getvalue()
