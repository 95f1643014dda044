"""What file and column names of study exports say (driver-side)."""

from __future__ import annotations

import re

# Table codes, the words some builds use for them, and movable tables.
CODES = frozenset("DM AE MH CM EX EC LB VS EG PE DS DV CE FA SU PR IE QS SC TU TR RS MB MS PC PP".split())
WORDS = {"DEMOG": "DM", "DEMOGRAPHICS": "DM", "DEMOGRAPHY": "DM"}
MOVABLE = frozenset("AE MH CM LB VS EG PE QS".split())
RENDERINGS = frozenset("RAW INT STD DEC FUL".split())


def domain_code(name: str) -> str | None:
    """The one table code a file name holds, or None where it is none or several."""
    parts = re.split(r"[^A-Z0-9]+", name.upper())
    if name.upper() in CODES:
        return name.upper()
    found = {WORDS.get(p, p) for p in parts if p in CODES or p in WORDS}
    return next(iter(found)) if len(found) == 1 else None


def move_group(name: str) -> str | None:
    """The group whose records change owner together; supplements follow their table."""
    code = domain_code(name)
    if code is None and name.upper().startswith("SUPP"):
        code = name.upper()[4:]
    return code if code in MOVABLE else None


def name_tokens(column: str) -> list[str]:
    """Words of a column name, by separators and camel case, without rendering tags."""
    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1 \2", column)
    words = (w.upper() for w in re.split(r"[\s_\-.]+", spaced))
    return [w for w in words if w and w not in RENDERINGS and not w.isdigit()]
