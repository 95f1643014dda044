"""Partial ISO dates as expressions: parsing, study days, ages and shifts.

A parsed value is ``struct<year,month,day,granularity>``; text is never cast to
a date directly, because a bare year would become a whole date.  Blank tokens,
null and unreadable text give granularity ``none``.  An impossible day keeps
granularity ``day`` but has no date.  Nothing here raises on bad input.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cells read as missing (compared trimmed and in upper case).
BLANKS = ("NA", "NAN", "NONE", "UNK", "UNKNOWN", ".", "<NA>", "NAT", "N/A")
RAW_BLANKS = (*BLANKS, "", "NULL", "NULL - MISSING", "MISSING")
ISO = r"^\s*([0-9]{4})(?:-([0-9]{2})(?:-([0-9]{2})(?:[T ].*)?)?)?\s*$"


#: The date part alone: a year, a month or a whole day before any time.
CORE = r"^\s*([0-9]{4}(?:-[0-9]{2}(?:-[0-9]{2})?)?)(?:(?<=-[0-9]{2}-[0-9]{2})[T ].*)?\s*$"
DAY = r"^\s*([0-9]{4}-[0-9]{2}-[0-9]{2})(?:[T ].*)?\s*$"


def _part(value: Column, group: int) -> Column:
    return F.nullif(F.regexp_extract(value, ISO, group), F.lit("")).cast("int")


def parse_iso(value: Column) -> Column:
    """struct<year,month,day,granularity> of a partial ISO date (blank tokens match nothing)."""
    year, month, day = (_part(value, g) for g in (1, 2, 3))
    kind = (
        F.when(day.isNotNull(), "day").when(month.isNotNull(), "month").when(year.isNotNull(), "year").otherwise("none")
    )
    return F.struct(year.alias("year"), month.alias("month"), day.alias("day"), kind.alias("granularity"))


def _date(text: Column) -> Column:
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")


def whole_date(value: Column) -> Column:
    """Date of a full, existing ISO day, else null (time of day ignored)."""
    return _date(F.nullif(F.regexp_extract(value, DAY, 1), F.lit("")))


def granularity(value: Column) -> Column:
    return F.coalesce(parse_iso(value)["granularity"], F.lit("none"))


def study_day(event: Column, anchor: Column, day_zero: bool = False) -> Column:
    """Days from anchor; without ``day_zero`` there is no day 0."""
    diff = F.datediff(whole_date(event), whole_date(anchor))
    return diff if day_zero else F.when(diff >= 0, diff + 1).otherwise(diff)


def year_offset(event: Column, anchor: Column) -> Column:
    return parse_iso(event)["year"] - parse_iso(anchor)["year"]


def age_years(birth: Column, at: Column) -> Column:
    """Completed years; partial dates use their months where both have one."""
    b, a = parse_iso(birth), parse_iso(at)
    bd, ad = whole_date(birth), whole_date(at)
    early_day = (a["month"] < b["month"]) | ((a["month"] == b["month"]) & (a["day"] < b["day"]))
    early = F.when(bd.isNotNull() & ad.isNotNull(), early_day).otherwise(F.coalesce(a["month"] < b["month"], F.lit(False)))
    return a["year"] - b["year"] - F.when(early, 1).otherwise(0)


def capped_age(birth: Column, at: Column, cap: int = 90) -> Column:
    years = age_years(birth, at)
    return F.when(years >= cap, F.lit(f"{cap}+")).otherwise(years.cast("string"))


def shift_iso(value: Column, days: Column) -> Column:
    """Shifted ISO text; a partial date moves from its middle and stays partial.

    Months move from the 15th, years from 1 July.  An impossible day falls back
    to its month; an impossible month gives null instead of failing.
    """
    core = F.nullif(F.regexp_extract(value, CORE, 1), F.lit(""))
    length = F.length(core)
    middle = F.when(length == 4, "-07-01").when(length == 7, "-15").otherwise("")
    at = _date(F.concat(core, middle))
    fallback = _date(F.concat(F.substring(core, 1, 7), F.lit("-15")))
    moved = F.date_format(F.date_add(F.coalesce(at, fallback), days), "yyyy-MM-dd")
    return F.when(at.isNull(), F.substring(moved, 1, 7)).otherwise(F.substring(moved, F.lit(1), length))
