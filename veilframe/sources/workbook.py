"""Excel workbooks without an Excel library: cells as text, one table per sheet."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from datetime import datetime, timedelta
from xml.etree import ElementTree
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader

from veilframe.sources import files

_M = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_R = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}id"
# Built-in number formats that show dates.
DATE_FORMATS = {14, 15, 16, 17, 18, 19, 20, 21, 22, 45, 46, 47}


def _content(path: str) -> bytes:
    return files.read_here(path)


def _column(ref: str) -> int:
    n = 0
    for c in re.match(r"[A-Z]+", ref)[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheet_names(content: bytes) -> dict[str, str]:
    """Sheet name -> part name, in book order."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        rels = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        sheets = ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_M}sheet")
        return {s.get("name"): "xl/" + rels[s.get(_R)].lstrip("/").removeprefix("xl/") for s in sheets}


def cells(content: bytes, part: str) -> Iterator[list[str | None]]:
    """Rows of a sheet as text."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            for item in ElementTree.fromstring(book.read("xl/sharedStrings.xml")).iter(f"{_M}si"):
                shared.append("".join(t.text or "" for t in item.iter(f"{_M}t")))
        dated: set[int] = set()
        if "xl/styles.xml" in book.namelist():
            styles = ElementTree.fromstring(book.read("xl/styles.xml"))
            own = {int(f.get("numFmtId")): f.get("formatCode", "") for f in styles.iter(f"{_M}numFmt")}
            for group in styles.iter(f"{_M}cellXfs"):
                for i, xf in enumerate(group):
                    k = int(xf.get("numFmtId", 0))
                    if k in DATE_FORMATS or re.search(r"[ymdh]", re.sub(r'"[^"]*"|\[[^\]]*\]', "", own.get(k, "")), re.I):
                        dated.add(i)
        for row in ElementTree.fromstring(book.read(part)).iter(f"{_M}row"):
            out: list[str | None] = []
            for cell in row.iter(f"{_M}c"):
                at = _column(cell.get("r")) if cell.get("r") else len(out)
                out += [None] * (at + 1 - len(out))
                value, kind = cell.find(f"{_M}v"), cell.get("t")
                if kind == "inlineStr":
                    out[at] = "".join(t.text or "" for t in cell.iter(f"{_M}t"))
                elif value is None or value.text is None:
                    continue
                elif kind == "s":
                    out[at] = shared[int(value.text)]
                elif kind == "b":
                    out[at] = "True" if value.text == "1" else "False"
                elif kind is None and int(cell.get("s", 0)) in dated:
                    out[at] = str(datetime(1899, 12, 30) + timedelta(seconds=round(float(value.text) * 86400)))
                else:
                    out[at] = value.text
            yield out


class _Reader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.width, self.options = len(schema), options

    def read(self, partition):
        content = _content(self.options["path"])
        names = sheet_names(content)
        part = names[self.options.get("sheet") or next(iter(names))]
        for i, row in enumerate(cells(content, part)):
            if i:
                yield tuple((row + [None] * self.width)[: self.width])


class WorkbookSource(DataSource):
    """``spark.read.format("workbook").option("sheet", name).load(path)``."""

    @classmethod
    def name(cls) -> str:
        return "workbook"

    def schema(self):
        content = _content(self.options["path"])
        names = sheet_names(content)
        header = next(cells(content, names[self.options.get("sheet") or next(iter(names))]), [])
        return T.StructType([T.StructField(h or f"_c{i}", T.StringType()) for i, h in enumerate(header)])

    def reader(self, schema):
        return _Reader(schema, dict(self.options))


def sheets(spark: SparkSession, path: str) -> list[str]:
    return list(sheet_names(_content(path)))


def read(spark: SparkSession, path: str, sheet: str | None = None) -> DataFrame:
    spark.dataSource.register(WorkbookSource)
    source = spark.read.format("workbook")
    return (source.option("sheet", sheet) if sheet else source).load(path)


def midnight_fix(df: DataFrame) -> DataFrame:
    """`` 00:00:00`` is stripped from columns where every value is a midnight."""
    if not df.columns:
        return df
    at_midnight = r"^[0-9]{4}-[0-9]{2}-[0-9]{2} 00:00:00$"
    row = df.agg(*[F.bool_and(F.col(f"`{c}`").rlike(at_midnight)).alias(c) for c in df.columns]).first()
    return df.select(*[F.substring(F.col(f"`{c}`"), 1, 10).alias(c) if row[c] else F.col(f"`{c}`") for c in df.columns])


def write(tables: dict[str, DataFrame], path: str) -> None:
    """A small workbook, every cell text; rows stream through the driver."""
    names, used = {}, set()
    for name in tables:
        short = re.sub(r"[\[\]:*?/\\]", "_", name)[:31]
        while short.upper() in used:
            short = short[:28] + f"_{len(used)}"
        used.add(short.upper())
        names[name] = short
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as book:
        types = "".join(f'<Override PartName="/xl/worksheets/s{i}.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.worksheet+xml"/>' for i in range(len(names)))
        book.writestr("[Content_Types].xml", '<?xml version="1.0"?><Types xmlns="http://schemas.openxmlformats.org/package/2006/content-types"><Default Extension="rels" ContentType="application/vnd.openxmlformats-package.relationships+xml"/><Default Extension="xml" ContentType="application/xml"/><Override PartName="/xl/workbook.xml" ContentType="application/vnd.openxmlformats-officedocument.spreadsheetml.sheet.main+xml"/>' + types + "</Types>")
        book.writestr("_rels/.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r0" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/officeDocument" Target="xl/workbook.xml"/></Relationships>')
        book.writestr("xl/_rels/workbook.xml.rels", '<?xml version="1.0"?><Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="s{i}" Type="http://schemas.openxmlformats.org/officeDocument/2006/relationships/worksheet" Target="worksheets/s{i}.xml"/>' for i in range(len(names))) + "</Relationships>")
        book.writestr("xl/workbook.xml", '<?xml version="1.0"?><workbook xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main" xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"><sheets>' + "".join(f'<sheet name="{escape(n)}" sheetId="{i + 1}" r:id="s{i}"/>' for i, n in enumerate(names.values())) + "</sheets></workbook>")
        for i, df in enumerate(tables.values()):
            with book.open(f"xl/worksheets/s{i}.xml", "w") as part:
                part.write(b'<?xml version="1.0"?><worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>')
                rows = df.select(*[F.col(f"`{c}`").cast("string") for c in df.columns]).toLocalIterator()
                for row in _with_header(df.columns, rows):
                    line = "".join("<c/>" if v is None else f'<c t="inlineStr"><is><t xml:space="preserve">{escape(v)}</t></is></c>' for v in row)
                    part.write(f"<row>{line}</row>".encode())
                part.write(b"</sheetData></worksheet>")


def _with_header(header: list[str], rows) -> Iterator:
    yield header
    yield from rows
