"""Mixed timestamp formats and time zones (problem 4).

Every value is read under all written forms it fits; the valid interpretations
are kept as an array.  One of them is chosen by Viterbi over the records of a
source in record order: an interpretation against the source's declared day and
month order costs ``OFF_ORDER``, a change of order between records costs
``SWITCH`` and a step back in time costs ``BACKWARD``.  ``OFF_ORDER`` outweighs
all transitions a single choice can save, so a declared order always holds
where it gives a date, and the path decides only where none is declared; an
interpretation that this rules out is left out of the array at once.

The path is found in parts.  Records are cut into blocks of ``BLOCK`` record
numbers, so no task ever holds more than that many rows of a source; each block
yields the cost of its best path for every pair of first and last
interpretation, a scan over these few numbers fixes the ends of all blocks, and
each block is decoded between its ends.

Forms: ISO dates and times, compact and slashed dates, day-month-year and
month-day-year with ``/``, ``.`` or ``-``, month names in English, German,
French and Spanish, 12-hour clocks, counts of seconds or milliseconds since
1970 UTC, and partial dates with unknown parts.  A zone in the value wins over
the zone of the source.  A local time that a clock change skips or repeats
takes the offset in force before the change.  Fractions are cut.

Null, blank and not-known values (NA, UNK, UNKNOWN, ".") take no part.  A value
without any existing date is ``INVALID``.  Without a zone of its own or of its
source a time is taken as UTC.  Records without a source form one source.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from datetime import UTC, date, datetime, timedelta
from functools import lru_cache, reduce
from zoneinfo import ZoneInfo

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.session import cut

OFF_ORDER, SWITCH, BACKWARD = 100.0, 1.0, 1.0
#: Record numbers in a block; also the most rows of a source in one task.
BLOCK = 65_536
NOT_KNOWN = ("", "NA", "UNK", "UNKNOWN", ".")

# Month names (first letters, folded), zone abbreviations in minutes.
MONTHS = {
    "jan": 1, "ene": 1, "januar": 1, "janv": 1, "feb": 2, "fev": 2, "fevr": 2, "mar": 3, "mrz": 3, "marz": 3, "mars": 3,
    "apr": 4, "avr": 4, "abr": 4, "may": 5, "mai": 5, "jun": 6, "juin": 6, "jul": 7, "juil": 7, "aug": 8, "aou": 8, "ago": 8,
    "sep": 9, "sept": 9, "oct": 10, "okt": 10, "nov": 11, "dec": 12, "dez": 12, "dic": 12,
}
ZONES = {
    "Z": 0, "UTC": 0, "GMT": 0, "WET": 0, "WEST": 60, "BST": 60, "CET": 60, "CEST": 120, "MEZ": 60, "MESZ": 120, "EET": 120,
    "EEST": 180, "MSK": 180, "IST": 330, "JST": 540, "KST": 540, "AWST": 480, "ACST": 570, "ACDT": 630, "AEST": 600, "AEDT": 660,
    "NZST": 720, "NZDT": 780, "NST": -210, "NDT": -150, "AST": -240, "ADT": -180, "EST": -300, "EDT": -240, "CST": -360,
    "CDT": -300, "MST": -420, "MDT": -360, "PST": -480, "PDT": -420,
}

_UNKNOWN = r"(?:UNK|UN|UK|NK|ND|XX|--|00|\?\?)"
_CLOCK = (
    r"(?:[T :]\s*(?P<h>\d{1,2}):(?P<mi>\d{2})(?::(?P<s>\d{2})(?:[.,]\d+)?)?\s*(?P<ap>[AaPp]\.?[Mm]\.?)?"
    r"\s*(?P<z>[A-Za-z]{1,5}|[+-]\d{2}:?\d{2}|[+-]\d{1,2})?)?"
)
_NAME = r"(?P<mon>[^\W\d_]{3,})\.?"
_YEAR = r"(?P<y>\d{4})"
#: Form name, pattern.  ``a`` and ``b`` are day and month in an order of their own.
FORMS = [
    ("iso", rf"{_YEAR}([-/.])(?P<m>\d{{1,2}})\2(?P<d>\d{{1,2}}){_CLOCK}"),
    ("compact", r"(?P<y>\d{4})(?P<m>\d{2})(?P<d>\d{2})(?:T(?P<h>\d{2})(?P<mi>\d{2})(?P<s>\d{2})(?P<ap>(?!))?(?P<z>Z|[+-]\d{2}:?\d{2})?)?"),
    ("named", rf"(?P<d>\d{{1,2}})(?:\.?\s+|[-/.]|)(?:de\s+)?{_NAME}(?:\s+de)?(?:,?\s+|[-/.]|)(?P<y>\d{{4}}|\d{{2}}){_CLOCK}"),
    ("named", rf"{_NAME}\s*(?P<d>\d{{1,2}})(?:st|nd|rd|th)?,?\s+{_YEAR}{_CLOCK}"),
    ("numeric", rf"(?P<a>\d{{1,2}})([-/.])(?P<b>\d{{1,2}})\2(?P<y>\d{{4}}|\d{{2}}){_CLOCK}"),
    ("month", rf"(?:{_UNKNOWN}[-/. ]*)?{_NAME}[-/. ]*{_YEAR}"),
    ("month", rf"{_YEAR}[-/.](?P<m>\d{{1,2}})(?:[-/.]{_UNKNOWN})?"),
    ("month", rf"(?:{_UNKNOWN}[-/.])?(?P<m>\d{{1,2}})[-/.]{_YEAR}"),
    ("year", rf"(?:{_UNKNOWN}[-/. ]*){{0,2}}{_YEAR}(?:[-/. ]*{_UNKNOWN}){{0,2}}"),
]
_FORMS = [(name, re.compile(pattern, re.I)) for name, pattern in FORMS]
_COUNT = re.compile(r"-?\d{9,10}|\d{13}")

#: One interpretation: (order "dmy"/"mdy"/"", time in seconds, normal form).
Reading = tuple[str, float, str]


@lru_cache(maxsize=10_000)
def month_number(name: str) -> int | None:
    folded = "".join(c for c in unicodedata.normalize("NFKD", name.lower()) if not unicodedata.combining(c))
    for length in (len(folded), 4, 3):
        if folded[:length] in MONTHS:
            return MONTHS[folded[:length]]
    return None


@lru_cache(maxsize=512)
def _zone(name: str) -> ZoneInfo | None:
    try:
        return ZoneInfo(name)
    except (KeyError, ValueError, OSError):
        return None


def _instant(moment: datetime, zone: str | None, site_zone: str | None) -> datetime | None:
    """UTC moment of a local time; None for a zone nobody knows."""
    if zone:
        if zone.upper() in ZONES:
            return moment - timedelta(minutes=ZONES[zone.upper()])
        digits = zone[1:].replace(":", "")
        if zone[0] not in "+-" or not digits.isdigit():
            return None
        hours, minutes = int(digits[:2]), int(digits[2:] or 0)
        if hours > 15 or minutes > 59:
            return None
        away = timedelta(hours=hours, minutes=minutes)
        return moment - away if zone[0] == "+" else moment + away
    known = _zone(site_zone) if site_zone else None
    if known is None:
        return moment
    # fold=0 is the offset in force before a change, for skipped and repeated times.
    return (moment - moment.replace(tzinfo=known, fold=0).utcoffset()).replace(tzinfo=None)


def _reading(order: str, year: int, month: int | None, day: int | None, part: dict[str, str | None], site_zone: str | None) -> Reading | None:
    try:
        if month is None:
            return order, (date(year, 1, 1) - date(1970, 1, 1)).days * 86400.0, f"{year:04d}"
        if day is None:
            return order, (date(year, month, 1) - date(1970, 1, 1)).days * 86400.0, f"{year:04d}-{month:02d}"
        on = date(year, month, day)
        if part.get("h") is None:
            return order, (on - date(1970, 1, 1)).days * 86400.0, on.isoformat()
        hour = int(part["h"])
        if part.get("ap") and hour <= 12:
            hour = hour % 12 + (12 if part["ap"][0] in "pP" else 0)
        moment = datetime(year, month, day, hour, int(part["mi"]), int(part.get("s") or 0))
        utc = _instant(moment, part.get("z"), site_zone)
        if utc is None:
            return None
        return order, (utc - datetime(1970, 1, 1)).total_seconds(), utc.strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")
    except (ValueError, OverflowError):
        return None


@lru_cache(maxsize=200_000)
def readings(value: str, site_zone: str | None) -> tuple[Reading, ...]:
    """All valid interpretations of one written value."""
    text = value.strip()
    if _COUNT.fullmatch(text):
        seconds = int(text) // (1000 if len(text) == 13 else 1)
        moment = datetime.fromtimestamp(seconds, UTC)
        return (("", float(seconds), moment.strftime("%Y-%m-%dT%H:%M:%SZ").rjust(20, "0")),)
    found: dict[str, Reading] = {}
    for name, pattern in _FORMS:
        m = pattern.fullmatch(text)
        if not m:
            continue
        part = m.groupdict()
        year = int(part["y"]) + (2000 if len(part["y"]) == 2 else 0)
        if year == 0:
            continue
        if name == "numeric":
            a, b = int(part["a"]), int(part["b"])
            tries = [("dmy", b, a), ("mdy", a, b)] if a != b else [("", a, b)]
        else:
            month = month_number(part["mon"]) if part.get("mon") else int(part["m"]) if part.get("m") else None
            if name in ("named", "month") and month is None:
                continue
            tries = [("", month, int(part["d"]) if part.get("d") else None)]
        for order, month, day in tries:
            reading = _reading(order, year, month, day, part, site_zone)
            if reading and reading[2] not in found:
                found[reading[2]] = reading
        if found:
            break
    return tuple(found.values())


def emission(reading: Reading, declared: str | None) -> float:
    return OFF_ORDER if reading[0] and declared in ("dmy", "mdy") and reading[0] != declared else 0.0


def transition(before: Reading, after: Reading) -> float:
    cost = SWITCH if before[0] and after[0] and before[0] != after[0] else 0.0
    return cost + (BACKWARD if after[1] < before[1] else 0.0)


def block_costs(rows: list[tuple[tuple[Reading, ...], str | None]]) -> tuple[list[list[float]], list[Reading], list[Reading]]:
    """(cost of the best path by first and last reading, first readings, last readings)."""
    first = rows[0][0]
    costs = [[emission(r, rows[0][1]) if i == j else float("inf") for j, r in enumerate(first)] for i in range(len(first))]
    before = first
    for options, declared in rows[1:]:
        costs = [
            [
                min(line[k] + transition(before[k], r) for k in range(len(before))) + emission(r, declared)
                for r in options
            ]
            for line in costs
        ]
        before = options
    return costs, list(first), list(before)


def decode(rows: list[tuple[tuple[Reading, ...], str | None]], first: int, last: int) -> list[int]:
    """Best readings of a block between fixed first and last readings (ties: the earlier)."""
    score = [0.0 if i == first else float("inf") for i in range(len(rows[0][0]))]
    back: list[list[int]] = []
    for (before, _), (options, declared) in zip(rows, rows[1:]):
        step = []
        new = []
        for r in options:
            costs = [score[k] + transition(before[k], r) for k in range(len(before))]
            k = min(range(len(before)), key=costs.__getitem__)
            step.append(k)
            new.append(costs[k] + emission(r, declared))
        back.append(step)
        score = new
    path = [last]
    for step in reversed(back):
        path.append(step[path[-1]])
    return path[::-1]


def link(blocks: list[tuple[list[list[float]], list[Reading], list[Reading]]]) -> list[tuple[int, int]]:
    """First and last reading of every block of a source on the best whole path."""
    score: list[float] = []
    back: list[list[tuple[int, int]]] = []
    ends: list[Reading] = []
    for costs, first, last in blocks:
        if not score:
            entry = [(0.0, -1)] * len(first)
        else:
            entry = [min((score[k] + transition(ends[k], r), k) for k in range(len(ends))) for r in first]
        step = [min((entry[i][0] + costs[i][j], i) for i in range(len(first))) for j in range(len(last))]
        back.append([(i, entry[i][1]) for _, i in step])
        score, ends = [c for c, _ in step], last
    out: list[tuple[int, int]] = []
    j = min(range(len(score)), key=score.__getitem__)
    for step in reversed(back):
        i, before = step[j]
        out.append((i, j))
        j = before
    return out[::-1]


READING = "array<struct<ord:string,at:double,norm:string>>"
#: More than the transitions around one record can cost: two switches and two steps back.
MOST_SAVED = 2 * (SWITCH + BACKWARD)


def possible(found: tuple[Reading, ...], declared: str | None) -> list[Reading]:
    """The interpretations some path could still choose.

    One that costs more than the best of its record by more than all transitions
    around it could save is on no cheapest path.
    """
    if len(found) < 2:
        return list(found)
    costs = [emission(r, declared) for r in found]
    least = min(costs)
    return [r for r, c in zip(found, costs) if c - least <= MOST_SAVED]


def interpretations(rows: DataFrame) -> DataFrame:
    """Adds the possible interpretations to (…, value, zone_name, date_order).

    The first one stands in plain columns (``ord``, ``at``, ``norm``; null where
    there is none), further ones in the array ``more`` (null where there are none).
    """
    names = [c for c in rows.columns if c not in ("value", "zone_name")]

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            zones = [z if isinstance(z, str) else None for z in batch["zone_name"]]
            orders = [o if isinstance(o, str) else None for o in batch["date_order"]]
            found = [possible(readings(v, z), o) for v, z, o in zip(batch["value"], zones, orders)]
            out = batch[names].copy()
            for k, c in enumerate(("ord", "at", "norm")):
                out[c] = [f[0][k] if f else None for f in found]
            out["more"] = [[{"ord": o, "at": t, "norm": n} for o, t, n in f[1:]] if len(f) > 1 else None for f in found]
            yield out

    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in names)
    return rows.mapInPandas(parse, f"{schema}, ord string, at double, norm string, more {READING}")


def _rows_of(frame: pd.DataFrame) -> list[tuple[tuple[Reading, ...], str | None]]:
    return [
        (((o, t, n), *((x["ord"], x["at"], x["norm"]) for x in more)) if more is not None else ((o, t, n),), declared if isinstance(declared, str) else None)
        for o, t, n, more, declared in zip(frame["ord"], frame["at"], frame["norm"], frame["more"], frame["date_order"])
    ]


def _decided(frame: pd.DataFrame) -> bool:
    """Does every record of a block have one interpretation?"""
    return bool(frame["more"].isna().all())


def one_path_cost(frame: pd.DataFrame) -> float:
    """Cost of the only path through a block whose records have one interpretation each."""
    at, order, declared = frame["at"].to_numpy(), frame["ord"].to_numpy(str), frame["date_order"].fillna("").to_numpy(str)
    off = (order != "") & np.isin(declared, ("dmy", "mdy")) & (order != declared)
    switch = (order[1:] != "") & (order[:-1] != "") & (order[1:] != order[:-1])
    return float(OFF_ORDER * off.sum() + SWITCH * switch.sum() + BACKWARD * (at[1:] < at[:-1]).sum())


def _summary(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("rec_id")
    if _decided(frame):
        costs = [[one_path_cost(frame)]]
        first, last = (_rows_of(frame.iloc[[k]])[0][0] for k in (0, -1))
    else:
        costs, first, last = block_costs(_rows_of(frame))

    def pack(options) -> list[dict]:
        return [{"ord": o, "at": t, "norm": n} for o, t, n in options]

    key = frame.iloc[0]
    return pd.DataFrame(
        {
            "track": [key["track"]],
            "source": [key["source"]],
            "block": [key["block"]],
            "costs": [costs],
            "first": [pack(first)],
            "last": [pack(last)],
        }
    )


def _linked(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("block")

    def unpack(options) -> list[Reading]:
        return [(o["ord"], o["at"], o["norm"]) for o in options]

    blocks = [
        ([list(line) for line in c], unpack(a), unpack(b)) for c, a, b in zip(frame["costs"], frame["first"], frame["last"])
    ]
    ends = link(blocks)
    return pd.DataFrame(
        {
            "track": frame["track"],
            "source": frame["source"],
            "block": frame["block"],
            "enter": [a for a, _ in ends],
            "leave": [b for _, b in ends],
        }
    )


def _decoded(frame: pd.DataFrame, ends: pd.DataFrame) -> pd.DataFrame:
    if not len(frame):
        return pd.DataFrame({"track": [], "rec_id": [], "norm_value": []})
    if _decided(frame):
        return frame[["track", "rec_id"]].assign(norm_value=frame["norm"])
    frame = frame.sort_values("rec_id")
    rows = _rows_of(frame)
    path = decode(rows, int(ends["enter"].iloc[0]), int(ends["leave"].iloc[0]))
    return pd.DataFrame(
        {
            "track": frame["track"],
            "rec_id": frame["rec_id"],
            "norm_value": [options[k][2] for (options, _), k in zip(rows, path)],
        }
    )


def columns_as_tracks(tables: dict[str, tuple[DataFrame, str, list[str]]]) -> DataFrame:
    """(track, rec_id, source key, value) of date columns: ``table.column`` is the track."""
    parts = []
    for name, (df, key, columns) in tables.items():
        for column in columns:
            parts.append(
                df.select(
                    F.lit(f"{name}.{column}").alias("track"),
                    F.col("rec_id").cast("long").alias("rec_id"),
                    F.substring_index(F.trim(F.col(key)), "-", 1).alias("source"),
                    F.col(column).alias("value"),
                )
            )
    every = reduce(DataFrame.unionByName, parts)
    return every.where(F.col("value").isNotNull() & ~F.upper(F.trim("value")).isin(*NOT_KNOWN))


def normalise(tracks: DataFrame, sources: DataFrame, block: int = BLOCK) -> DataFrame:
    """(track, rec_id, norm_value): one unambiguous form per known value."""
    # A list of sites; joined by broadcast only while it is small.
    small = sources.limit(100_001).count() <= 100_000
    placed = tracks.join(F.broadcast(sources) if small else sources, "source", "left").withColumn(
        "source", F.coalesce("source", F.lit(""))
    )
    # Parsed once: the summaries, the decoding and the invalid values all read it.
    options = cut(interpretations(placed.withColumn("block", F.expr(f"rec_id div {block}"))))
    invalid = options.where(F.col("norm").isNull()).select("track", "rec_id", F.lit("INVALID").alias("norm_value"))
    valid = options.where(F.col("norm").isNotNull()).select("track", "source", "block", "rec_id", "date_order", "ord", "at", "norm", "more")
    summary = valid.groupBy("track", "source", "block").applyInPandas(
        _summary, f"track string, source string, block long, costs array<array<double>>, first {READING}, last {READING}"
    )
    ends = summary.groupBy("track", "source").applyInPandas(_linked, "track string, source string, block long, enter int, leave int")
    decoded = (
        valid.groupBy("track", "source", "block")
        .cogroup(ends.groupBy("track", "source", "block"))
        .applyInPandas(_decoded, "track string, rec_id long, norm_value string")
    )
    return decoded.unionByName(invalid)
