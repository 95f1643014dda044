"""SAS transport files (version 5), read by the published layout.

Records are 80 bytes; numbers are IBM hexadecimal floats; text is padded with
blanks.  ``spark.read.format("xport").option("member", name).load(path)``.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader

from veilframe.sources import files

LINE = 80
_HEAD = b"HEADER RECORD*******"


def number(raw: bytes) -> float | None:
    """IBM float of up to 8 bytes; a lone '.', '_' or capital means missing."""
    raw = raw.ljust(8, b"\0")
    if raw[1:] == b"\0" * 7:
        if raw[0] == 0:
            return 0.0
        if raw[0] in b"._" or 65 <= raw[0] <= 90:
            return None
    sign = -1.0 if raw[0] & 0x80 else 1.0
    return sign * int.from_bytes(raw[1:], "big") / 2.0**56 * 16.0 ** ((raw[0] & 0x7F) - 64)


def members(content: bytes) -> dict[str, tuple[list[tuple[str, bool, int, int]], int, int]]:
    """Member -> ([(name, is_number, position, length)], first byte of rows, end)."""
    marks = [m.start() for m in re.finditer(re.escape(_HEAD) + rb"(MEMBER |MEMBV8)", content) if m.start() % LINE == 0]
    found = {}
    for start, end in zip(marks, [*marks[1:], len(content)]):
        size = int(content[start + 74 : start + 78])
        at = start + 2 * LINE
        name = content[at + 8 : at + 16].decode("latin-1").strip()
        at += 2 * LINE
        count = int(content[at + 54 : at + 58])
        at += LINE
        fields = []
        for i in range(count):
            one = content[at + i * size : at + (i + 1) * size]
            kind, _, length, _ = struct.unpack(">hhhh", one[:8])
            fields.append((one[8:16].decode("latin-1").strip(), kind == 1, struct.unpack(">l", one[84:88])[0], length))
        at += -(-count * size // LINE) * LINE
        found[name] = (fields, at + LINE, end)
    return found


def rows(content: bytes, member: str | None = None) -> Iterator[tuple]:
    found = members(content)
    fields, at, end = found[member or next(iter(found))]
    width = sum(f[3] for f in fields)
    while at + width <= end:
        line = content[at : at + width]
        # Padding of the last record is all blank and shorter than a record.
        if end - at < LINE and not line.strip(b" "):
            return
        yield tuple(
            number(line[p : p + n]) if is_number else (line[p : p + n].decode("latin-1").rstrip() or None) for _, is_number, p, n in fields
        )
        at += width


def _content(path: str) -> bytes:
    return files.read_here(path)


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options

    def read(self, partition):
        yield from rows(_content(self.options["path"]), self.options.get("member"))


class XportSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "xport"

    def schema(self):
        found = members(_content(self.options["path"]))
        fields = found[self.options.get("member") or next(iter(found))][0]
        return T.StructType([T.StructField(n, T.DoubleType() if is_number else T.StringType()) for n, is_number, _, _ in fields])

    def reader(self, schema):
        return _Reader(dict(self.options))


def read(spark: SparkSession, path: str, member: str | None = None) -> DataFrame:
    spark.dataSource.register(XportSource)
    source = spark.read.format("xport")
    return (source.option("member", member) if member else source).load(path)
