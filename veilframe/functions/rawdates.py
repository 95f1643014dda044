"""Dates in their own written form: read, shift and write back in place.

A value is matched once; the shifted year, month and day are written into the
very spans they were read from, in the same width, case and language length, so
separators, unknown parts and a time of day after them stay as written.

Reading is per value and regular, but writing back is not expressible with
built-in functions, so it runs as an Arrow UDF on distinct values where the
offset allows.  Order inference and format counts are plain expressions.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import date, timedelta
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.dates import RAW_BLANKS

# English month names.
MONTHS = [
    "January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December",
]
_MON = r"(?P<mon>jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
_UN = r"(?:UNK|UN|UK|NK|XX|--|00)"
_CLOCK = r"\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?"
#: What may follow a clock: half of the day or a zone, and nothing else.
_AFTER = r"(?:\s*[AaPp]\.?[Mm]\.?)?(?:\s*(?:Z|UTC|GMT|[+-]\d{2}:?\d{2}))?"
_TIME = rf"[T\s]\s*{_CLOCK}{_AFTER}"
_SLOT = rf"(?:\d{{1,2}}|{_UN})"
#: First match wins.  ``a``/``b`` are day and month in the declared order.
_PATTERNS = [
    re.compile(p, re.I)
    for p in (
        rf"(?P<y>\d{{4}})-(?P<m>\d{{2}})-(?P<d>\d{{2}})(?P<tail>{_TIME})?",
        rf"(?P<a>\d{{1,2}})([/.\-])(?P<b>\d{{1,2}})\2(?P<y>\d{{4}})(?P<tail>{_TIME})?",
        r"(?P<y>\d{4})-(?P<m>\d{2})",
        r"(?P<y>(?:19|20)\d{2})",
        r"(?P<y>(?:19|20)\d{2})(?P<m>0[1-9]|1[0-2])(?P<d>0[1-9]|[12]\d|3[01])",
        rf"(?P<y>\d{{4}})/(?P<m>\d{{1,2}})/(?P<d>\d{{1,2}})(?P<tail>{_TIME})?",
        rf"(?P<d>\d{{1,2}})[-\s]?{_MON}[-\s,]?\s?(?P<y>\d{{4}})(?P<tail>[:T\s]\s*{_CLOCK}{_AFTER})?",
        rf"{_MON}[-\s]?(?P<y>\d{{4}})",
        rf"{_UN}[-/ .]?{_MON}[-/ .]?(?P<y>\d{{4}})",
        rf"{_UN}([-/ .]?){_UN}\1(?P<y>\d{{4}})",
        rf"(?P<y>\d{{4}})[-/](?P<m>\d{{2}})[-/]{_UN}",
        rf"(?P<y>\d{{4}})[-/]{_UN}(?:[-/]{_UN})?",
        rf"(?P<a>{_SLOT})([-/.])(?P<b>{_SLOT})\2(?P<y>\d{{4}})",
    )
]
_UNKNOWN = re.compile(_UN, re.I)
WRITTEN = "struct<value:string,status:string>"


@lru_cache(maxsize=100_000)
def read(value: str, order: str | None) -> tuple[dict[str, tuple[int, int, str]], int, int | None, int | None] | None:
    """(spans by part, year, month, day) of a written date, or None."""
    text = value.strip()
    for pattern in _PATTERNS:
        m = pattern.fullmatch(text)
        if not m:
            continue
        part = {k: (m.start(k), m.end(k), v) for k, v in m.groupdict().items() if v is not None}
        if "a" in part:
            if order not in ("dmy", "mdy"):
                return None
            part["d"], part["m"] = (part.pop("a"), part.pop("b")) if order == "dmy" else (part.pop("b"), part.pop("a"))
            day_unknown, month_unknown = (_UNKNOWN.fullmatch(part[k][2]) is not None for k in ("d", "m"))
            if month_unknown and not day_unknown:
                return None  # a day cannot be moved without its month
            for key, unknown in (("d", day_unknown), ("m", month_unknown)):
                if unknown:
                    del part[key]
        year = int(part["y"][2])
        if "mon" in part:
            month = next(i + 1 for i, n in enumerate(MONTHS) if n.lower().startswith(part["mon"][2].lower()[:3]))
        else:
            month = int(part["m"][2]) if "m" in part else None
        day = int(part["d"][2]) if "d" in part else None
        if year < 1800 or month == 0 or day == 0:
            continue
        try:
            date(year, month or 1, day or 1)
        except ValueError:
            return None
        return part, year, month, day
    return None


def template_of(value: str, order: str = "dmy") -> str:
    """The written form with its parts named, for counting forms."""
    found = read(value, order)
    if not found:
        return "UNPARSED"
    text, part = value.strip(), found[0]
    names = {"y": "{y}", "tail": "{tail}"}
    for key in ("d", "m"):
        if key in part:
            names[key] = "{%s%s}" % (key, "1" if len(part[key][2]) == 1 else "")
    if "mon" in part:
        word = part["mon"][2]
        names["mon"] = "{MON}" if word.isupper() else "{mon}" if len(word) == 3 else "{monl}"
    for key, (start, end, _) in sorted(part.items(), key=lambda x: -x[1][0]):
        text = text[:start] + names[key] + text[end:]
    return text


def move(value: str, days: int, order: str | None) -> str | None:
    """The value shifted by days in its own written form; None if unreadable."""
    found = read(value, order)
    if not found:
        return None
    part, year, month, day = found
    try:
        at = date(year, month or 7, day or (15 if month else 1)) + timedelta(days=days)
    except OverflowError:
        return None
    bare = any(len(part[k][2]) == 1 for k in ("d", "m") if k in part)
    text = value.strip()
    for key, (start, end, old) in sorted(part.items(), key=lambda x: -x[1][0]):
        if key == "y":
            new = f"{at.year:04d}"
        elif key == "mon":
            name = MONTHS[at.month - 1]
            name = name if len(old) > 3 else name[:3]
            new = name.upper() if old.isupper() else name.lower() if old.islower() else name
        elif key in ("m", "d"):
            number = at.month if key == "m" else at.day
            new = str(number) if bare else f"{number:02d}"
        else:
            continue
        text = text[:start] + new + text[end:]
    lead = len(value) - len(value.lstrip())
    return value[:lead] + text + value[len(value.rstrip()) :]


def _shifted(values: pd.Series, days: pd.Series, order: str | None) -> pd.DataFrame:
    out, status = [], []
    for value, day in zip(values, days):
        if value is None or value.strip().upper() in RAW_BLANKS:
            out.append(value)
            status.append("blank")
        elif day is None or pd.isna(day):
            out.append(None)
            status.append("no_offset")
        else:
            moved = move(value, int(day), order)
            out.append(moved)
            partial = moved is not None and read(value, order)[3] is None
            status.append("unparsed" if moved is None else "partial_shifted" if partial else "shifted")
    return pd.DataFrame({"value": out, "status": status})


def shift_written(value: Column, days: Column, order: str | None) -> Column:
    """struct<value,status>: shifted | partial_shifted | unparsed | no_offset | blank."""

    def udf(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for values, offsets in batches:
            yield _shifted(values, offsets, order)

    # Marked so that a filter on the status is not pushed below and the dates read twice.
    return F.pandas_udf(udf, WRITTEN).asNondeterministic()(value, days)


def parts_of(value: Column, order: str | None) -> Column:
    """struct<year,month,day> that a written date reads as; nulls for unknown parts and unreadable values."""

    def parts(values: pd.Series) -> pd.DataFrame:
        found = [read(v, order) if isinstance(v, str) else None for v in values]
        return pd.DataFrame([f[1:] if f else (None, None, None) for f in found], columns=["year", "month", "day"], dtype="Int64")

    return F.pandas_udf(parts, "struct<year:int,month:int,day:int>")(value)


def finish(value: Column, shifted: Column, on_unparsed: str) -> Column:
    """Cell to publish: unreadable cells are redacted, passed or raise."""
    unread = shifted["status"].isin("unparsed", "no_offset")
    if on_unparsed == "pass":
        return F.when(shifted["status"] == "unparsed", value).otherwise(shifted["value"])
    if on_unparsed == "redact":
        return F.when(unread, F.lit(None)).otherwise(shifted["value"])
    shape = F.regexp_replace(F.regexp_replace(value, r"\p{Nd}", "9"), r"\p{L}", "A")
    return F.when(shifted["status"] == "unparsed", F.raise_error(F.concat(F.lit("unreadable date of shape "), shape))).otherwise(
        shifted["value"]
    )


NUMERIC = r"^\s*([0-9]{1,2})([/.\-])([0-9]{1,2})\2([0-9]{4})(?:\s.*)?$"


def infer_order(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, day_order): dmy, mdy, unknown or unambiguous; one aggregate."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns]))
    flat = df.select(pairs.alias("_p")).select("_p.*")
    a, b = (F.regexp_extract("value", NUMERIC, g).try_cast("int") for g in (1, 3))
    seen = flat.groupBy("column_name").agg(
        F.bool_or(a > 12).alias("a"), F.bool_or(b > 12).alias("b"), F.count(a).alias("n")
    )
    a, b = F.coalesce("a", F.lit(False)), F.coalesce("b", F.lit(False))
    order = F.when(F.col("n") == 0, "unambiguous").when(a & ~b, "dmy").when(b & ~a, "mdy").otherwise("unknown")
    return seen.select("column_name", order.alias("day_order"))


def format_counts(df: DataFrame, column: str) -> DataFrame:
    """(template, n) of the written forms of a column; forms are read per distinct value."""
    distinct = df.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    named = distinct.select(F.pandas_udf(lambda v: v.map(template_of), "string")("value").alias("template"), "n")
    return named.groupBy("template").agg(F.sum("n").alias("n"))


def date_rate(df: DataFrame, column: str) -> DataFrame:
    """One row: share of non-blank values that read as dates, and as precise ones."""

    def grade(values: pd.Series) -> pd.Series:
        found = [read(v, "dmy") for v in values]
        return pd.Series([0 if f is None else 1 if f[2] is None else 2 for f in found])

    filled = df.where(F.col(column).isNotNull() & ~F.upper(F.trim(column)).isin(*RAW_BLANKS))
    distinct = filled.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    graded = distinct.select("n", F.pandas_udf(grade, "int")("value").alias("g"))
    total = F.sum("n")
    share = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0)) / total
    return graded.agg(share(F.col("g") > 0).alias("date_rate"), share(F.col("g") == 2).alias("precise_rate"))
