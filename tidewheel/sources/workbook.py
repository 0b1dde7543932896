"""Spreadsheet workbooks (Office Open XML) as a source and a sink.

Workbooks are read as binary files, so any store that Spark can list will do, a file for each task;
within it a sheet's rows are streamed. A workbook must fit into an executor's memory, which the
format itself bounds (1,048,576 rows a sheet); a sink therefore writes as many workbooks as it needs.
"""

from __future__ import annotations

import datetime as dt
import io
import re
import zipfile
from collections.abc import Iterator
from decimal import Decimal, InvalidOperation
from posixpath import dirname, join, normpath
from typing import Any
from xml.etree import ElementTree
from xml.sax.saxutils import escape, quoteattr

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

#: Rows of a sheet, its header included.
SHEET_ROWS = 1_048_576
BATCH = 10_000
_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_LINK = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
_ESCAPED = re.compile("_x([0-9A-Fa-f]{4})_")
_TO_ESCAPE = re.compile("[\x00-\x08\x0b-\x1f￾￿]|_(?=x[0-9A-Fa-f]{4}_)")


def serial_date(days: float, since_1904: bool = False) -> dt.datetime:
    """The moment of a serial number, to the millisecond. Day 60 of the usual system never was; days before it count from
    a day later."""
    base = dt.datetime(1904, 1, 1) if since_1904 else dt.datetime(1899, 12, 30 if days >= 60 else 31)
    return base + dt.timedelta(milliseconds=round(days * 86_400_000))


def _serial(d: dt.date) -> float:
    moment = d if isinstance(d, dt.datetime) else dt.datetime(d.year, d.month, d.day)
    days = (moment - dt.datetime(1899, 12, 30)) / dt.timedelta(days=1)
    return days if days >= 61 else days - 1


def _links(book: zipfile.ZipFile, part: str) -> dict[str, str]:
    """The parts that a part refers to, by id."""
    name = f"{dirname(part)}/_rels/{part.rpartition('/')[2]}.rels"
    if name not in book.namelist():
        return {}
    return {e.get("Id"): normpath(join(dirname(part), e.get("Target"))).lstrip("/") if not e.get("Target").startswith("/") else e.get("Target")[1:] for e in ElementTree.fromstring(book.read(name))}


def _text(e: ElementTree.Element) -> str:
    """A rich or plain text without its phonetic runs."""
    runs = [t for child in e for t in ([child] if child.tag == f"{_MAIN}t" else child.findall(f"{_MAIN}t") if child.tag == f"{_MAIN}r" else [])]
    return _ESCAPED.sub(lambda m: chr(int(m[1], 16)), "".join(t.text or "" for t in runs))


def _column(ref: str) -> int:
    n = 0
    for c in ref.rstrip("0123456789"):
        n = 26 * n + ord(c) - 64
    return n - 1


class Workbook:
    """One workbook's parts: its sheets by name, its tables by name, and how it counts days."""

    def __init__(self, content: bytes):
        self.book = zipfile.ZipFile(io.BytesIO(content))
        links = _links(self.book, "xl/workbook.xml")
        root = ElementTree.fromstring(self.book.read("xl/workbook.xml"))
        self.sheets = {e.get("name"): links[e.get(_LINK)] for e in root.iter(f"{_MAIN}sheet")}
        self.since_1904 = any(e.get("date1904") in ("1", "true") for e in root.iter(f"{_MAIN}workbookPr"))
        self.texts = [_text(e) for e in ElementTree.fromstring(self.book.read("xl/sharedStrings.xml"))] if "xl/sharedStrings.xml" in self.book.namelist() else []

    def table(self, name: str) -> tuple[str, str]:
        """The sheet's part and the range of a table."""
        for part in self.sheets.values():
            for at in _links(self.book, part).values():
                if "/tables/" in at:
                    e = ElementTree.fromstring(self.book.read(at))
                    if name in (e.get("displayName"), e.get("name")):
                        return part, e.get("ref")
        raise ValueError(f"the workbook has no table {name}")

    def rows(self, sheet: str | None = None, table: str | None = None) -> Iterator[list[Any]]:
        """Cells of the rows that there are, of a table or a sheet (the first), header first: None, texts, bools, Excel
        errors (None) and numbers as they are written (a _Number)."""
        first, last, top, bottom = 0, None, 1, None
        if table:
            part, ref = self.table(table)
            start, _, end = ref.partition(":")
            first, last = _column(start), _column(end or start)
            top, bottom = (int(re.sub(r"\D", "", x)) for x in (start, end or start))
        else:
            if sheet is not None and sheet not in self.sheets:
                raise ValueError(f"the workbook has no sheet {sheet}")
            part = self.sheets[sheet] if sheet is not None else next(iter(self.sheets.values()))
        with self.book.open(part) as stream:
            at = 0
            data = None
            for event, e in ElementTree.iterparse(stream, events=("start", "end")):
                if event == "start":
                    data = e if e.tag == f"{_MAIN}sheetData" else data
                elif e.tag == f"{_MAIN}row":
                    at = int(e.get("r", at + 1))
                    if at >= top and (bottom is None or at <= bottom):
                        cells: list[Any] = []
                        for c in e:
                            k = _column(c.get("r")) - first if c.get("r") else len(cells)
                            if k < 0 or last is not None and k > last - first:
                                continue
                            cells += [None] * (k + 1 - len(cells))
                            cells[k] = self._cell(c)
                        yield cells
                    data.clear()  # what has been read

    def _cell(self, c: ElementTree.Element) -> Any:
        kind, v = c.get("t", "n"), c.find(f"{_MAIN}v")
        if kind == "inlineStr":
            return _text(c.find(f"{_MAIN}is"))
        if v is None or v.text is None or kind == "e":
            return None
        if kind == "s":
            return self.texts[int(v.text)]
        if kind == "b":
            return v.text == "1"
        return _Number(v.text) if kind == "n" else v.text


class _Number(str):
    """A number as it stands in the file."""


def converted(value: Any, kind: T.DataType, since_1904: bool = False) -> Any:
    """A cell as a value of a column's type; ValueError if it isn't one. Numbers are serial dates for date columns."""
    if value is None or value == "" and not isinstance(kind, T.StringType):
        return None
    if isinstance(kind, T.StringType):
        return str(value).upper() if isinstance(value, bool) else str(value)
    if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        if isinstance(value, _Number):
            moment = serial_date(float(value), since_1904)
        elif isinstance(value, str):
            moment = dt.datetime.fromisoformat(value.strip())
        else:
            raise ValueError(value)
        return moment.date() if isinstance(kind, T.DateType) else moment
    if isinstance(kind, T.BooleanType):
        if isinstance(value, bool):
            return value
        return {"true": True, "false": False, "1": True, "0": False}[str(value).strip().lower()]
    number = Decimal(int(value)) if isinstance(value, bool) else Decimal(str(value).strip())
    if isinstance(kind, T.DecimalType):
        out = round(number, kind.scale)
        if abs(out) >= Decimal(10) ** (kind.precision - kind.scale):
            raise ValueError(value)
        return out
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return float(number)
    if number != int(number):
        raise ValueError(value)
    bits = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}[type(kind)]
    if not -(1 << bits) <= number < 1 << bits:
        raise ValueError(value)
    return int(number)


def workbook_table(spark: SparkSession, path: str, schema: T.StructType | str, sheet: str | None = None, table: str | None = None, errors: str | None = None) -> DataFrame:
    """A sheet (by default the first) or a table of each workbook at a path, a folder or a pattern.

    The first row names columns; those of the schema are found by these names, whatever their order, and are null where a
    workbook hasn't got them. Cells that aren't of the declared type become null; errors: a column of the schema
    that takes such cells as `column: cell`, with "; " between them. Rows without a filled cell are left out.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    target = to_arrow_schema(wanted)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content in b.column(0):
                book = Workbook(content.as_py())
                rows = book.rows(sheet, table)
                names = {str(n): k for k, n in enumerate(next(rows, [])) if n is not None}
                held: list[dict[str, Any]] = []
                for cells in rows:
                    if all(c is None or c == "" for c in cells):
                        continue
                    row, bad = {}, []
                    for f in wanted:
                        k = names.get(f.name, len(cells))
                        try:
                            row[f.name] = converted(cells[k], f.dataType, book.since_1904) if k < len(cells) else None
                        except (ValueError, KeyError, ArithmeticError, InvalidOperation):
                            bad.append(f"{f.name}: {cells[k]}")
                            row[f.name] = None
                    if errors:
                        row[errors] = "; ".join(bad) or None
                    held.append(row)
                    if len(held) == BATCH:
                        yield pa.RecordBatch.from_pylist(held, target)
                        held = []
                yield pa.RecordBatch.from_pylist(held, target)

    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content").mapInArrow(read, wanted)


_TYPES = '<?xml version="1.0" encoding="UTF-8"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/><Override PartName="/xl/worksheets/sheet1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/><Override PartName="/xl/styles.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.styles+xml"/><Override PartName="/xl/sharedStrings.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sharedStrings+xml"/><Override PartName="/xl/tables/table1.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.table+xml"/></Types>'
_KIND = "http://schemas.openxmlformats.org/officeDocument/2006/relationships/"
_NS = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
#: Cell styles: 0 general, 1 a date, 2 a date with time.
_STYLES = f'<styleSheet {_NS}><fonts count="1"><font/></fonts><fills count="1"><fill/></fills><borders count="1"><border/></borders><cellStyleXfs count="1"><xf/></cellStyleXfs><cellXfs count="3"><xf/><xf numFmtId="14" applyNumberFormat="1"/><xf numFmtId="22" applyNumberFormat="1"/></cellXfs></styleSheet>'


def _letters(k: int) -> str:
    out = ""
    k += 1
    while k:
        k, r = divmod(k - 1, 26)
        out = chr(65 + r) + out
    return out


class _Writer:
    """A workbook of one sheet, which is one table, row by row."""

    def __init__(self, names: list[str], sheet: str):
        self.names, self.sheet = names, sheet
        self.texts: dict[str, int] = {}
        self.rows, self.lines = 0, io.StringIO()
        self.add(names)

    def add(self, values: list[Any]) -> None:
        self.rows += 1
        cells = []
        for k, v in enumerate(values):
            if v is None:
                continue
            ref = f'r="{_letters(k)}{self.rows}"'
            if isinstance(v, bool):
                cells.append(f'<c {ref} t="b"><v>{int(v)}</v></c>')
            elif isinstance(v, (dt.date, dt.datetime)):
                cells.append(f'<c {ref} s="{2 if isinstance(v, dt.datetime) else 1}"><v>{_serial(v)!r}</v></c>')
            elif isinstance(v, (int, float, Decimal)):
                cells.append(f"<c {ref}><v>{v}</v></c>")
            else:
                cells.append(f'<c {ref} t="s"><v>{self.texts.setdefault(str(v), len(self.texts))}</v></c>')
        self.lines.write(f'<row r="{self.rows}">{"".join(cells)}</row>')

    def content(self) -> bytes:
        """The file but for its last byte, a line feed, which is the archive's comment: Spark's text writer adds it."""
        ref = f"A1:{_letters(max(len(self.names) - 1, 0))}{max(self.rows, 2)}"
        said = lambda t: escape(_TO_ESCAPE.sub(lambda m: f"_x{ord(m[0]):04X}_", t))
        link = lambda k, kind, to: f'<Relationship Id="rId{k}" Type="{_KIND}{kind}" Target="{to}"/>'
        links = lambda *x: f'<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">{"".join(x)}</Relationships>'
        parts = {
            "[Content_Types].xml": _TYPES, "_rels/.rels": links(link(1, "officeDocument", "xl/workbook.xml")), "xl/styles.xml": _STYLES,
            "xl/workbook.xml": f'<workbook {_NS} xmlns:r="{_KIND[:-1]}"><sheets><sheet name={quoteattr(self.sheet)} sheetId="1" r:id="rId1"/></sheets></workbook>',
            "xl/_rels/workbook.xml.rels": links(link(1, "worksheet", "worksheets/sheet1.xml"), link(2, "styles", "styles.xml"), link(3, "sharedStrings", "sharedStrings.xml")),
            "xl/worksheets/sheet1.xml": f'<worksheet {_NS} xmlns:r="{_KIND[:-1]}"><sheetData>{self.lines.getvalue()}</sheetData><tableParts count="1"><tablePart r:id="rId1"/></tableParts></worksheet>',
            "xl/worksheets/_rels/sheet1.xml.rels": links(link(1, "table", "../tables/table1.xml")),
            "xl/tables/table1.xml": f'<table {_NS} id="1" name={quoteattr(self.sheet)} displayName={quoteattr(self.sheet)} ref="{ref}"><autoFilter ref="{ref}"/><tableColumns count="{len(self.names)}">{"".join(f"<tableColumn id=\"{k}\" name={quoteattr(n)}/>" for k, n in enumerate(self.names, 1))}</tableColumns></table>',
            "xl/sharedStrings.xml": f'<sst {_NS}>{"".join(f"<si><t xml:space=\"preserve\">{said(t)}</t></si>" for t in self.texts)}</sst>',
        }
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
            for name, text in parts.items():
                z.writestr(name, text)
            z.comment = b"\n"
        return out.getvalue()[:-1]


def write_workbooks(df: DataFrame, path: str, sheet: str = "Data", rows: int = SHEET_ROWS - 1) -> None:
    """df as workbooks of at most `rows` rows, each of one sheet that is also a table of that name, in folders
    workbook=N below path: at least one for each partition with rows. Texts, numbers, booleans, dates and timestamps only."""
    names = df.columns

    def books(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, now = TaskContext.get().partitionId() << 24, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([k], pa.int64()), pa.array([now.content()], pa.binary())], ["workbook", "content"])

        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns)):
                if now is None:
                    now = _Writer(names, sheet)
                now.add([v.replace(tzinfo=None) if isinstance(v, dt.datetime) else v for v in row])
                if now.rows > rows:
                    yield done()
                    k, now = k + 1, None
        if now is not None:
            yield done()

    made = df.mapInArrow(books, "workbook bigint, content binary")
    made.select("workbook", F.col("content").cast("string").alias("value")).write.partitionBy("workbook").text(path)
