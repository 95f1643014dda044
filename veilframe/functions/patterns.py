"""Patterns shared by profile, date and text operators (Java regex syntax)."""

#: Decimal number as written in a cell.
DECIMAL_NUMBER = r"^\s*[+-]?(?:[0-9]+(?:\.[0-9]*)?|\.[0-9]+)(?:[eE][+-]?[0-9]{1,3})?\s*$"

_MON = r"(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
_D = r"(?:0?[1-9]|[12][0-9]|3[01])"
_M = r"(?:0?[1-9]|1[0-2])"
_Y = r"(?:1[89][0-9]{2}|2[0-9]{3})"
_TIME = r"(?:[T :][0-9]{1,2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]+)?)?.*)?"

#: A day (year, month and day all written), with or without a time after it.
WRITTEN_DAY = (
    r"(?i)^\s*(?:"
    + "|".join(
        [
            rf"{_Y}-{_M}-{_D}{_TIME}",
            rf"{_Y}/{_M}/{_D}{_TIME}",
            rf"{_Y}(?:0[1-9]|1[0-2])(?:0[1-9]|[12][0-9]|3[01])",
            rf"{_D}[-/ ]?{_MON}[-/ ]?{_Y}{_TIME}",
            rf"{_MON}[ ]+{_D},?[ ]+{_Y}",
            rf"{_D}([-/.]){_M}\1{_Y}{_TIME}",
            rf"{_M}([-/.]){_D}\2{_Y}{_TIME}",
        ]
    )
    + r")\s*$"
)

#: Whole ISO day at the start of a value.
ISO_DAY_PREFIX = r"^([0-9]{4}-[0-9]{2}-[0-9]{2})(?![0-9])"
