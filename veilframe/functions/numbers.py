"""Numeric text: coercion, caps and bands without failing casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^\s*[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?|inf|Infinity)\s*$"


def coerce(value: Column) -> Column:
    """Number of a cell, null where it is none (suffixes like ``12d`` are none)."""
    text = F.trim(value.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def general(value: Column) -> Column:
    """Six significant digits without trailing zeros: 45 -> 45, 1e7 -> 1e+07."""
    size = F.abs(value)
    exponent = F.when(size == 0, F.lit(0)).otherwise(F.floor(F.log10(size)).cast("int"))
    # Rounding to six digits may carry into the next power of ten.
    scaled = F.round(value / F.pow(F.lit(10.0), exponent - 5), 0)
    carried = F.abs(scaled) >= 1_000_000
    power = F.when(carried, exponent + 1).otherwise(exponent)
    digits = F.when(carried, F.round(scaled / 10, 0)).otherwise(scaled)
    plain = F.format_string("%.5f", digits / F.pow(F.lit(10.0), F.lit(5) - power))
    plain = F.when(power >= 0, plain).otherwise(F.format_string("%.10f", digits / F.pow(F.lit(10.0), F.lit(5) - power)))
    plain = F.regexp_replace(F.regexp_replace(plain, r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    mantissa = F.regexp_replace(F.regexp_replace(F.format_string("%.5f", digits / 100_000), r"(\.[0-9]*?)0+$", "$1"), r"\.$", "")
    sign = F.when(power < 0, "-").otherwise("+")
    scientific = F.concat(mantissa, F.lit("e"), sign, F.lpad(F.abs(power).cast("string"), 2, "0"))
    whole = (value == F.floor(value)) & (size < 1_000_000)
    return (
        F.when(value.isNull(), None)
        .when(F.isnan(value), "nan")
        .when(size == float("inf"), F.when(value > 0, "inf").otherwise("-inf"))
        .when(whole, value.cast("bigint").cast("string"))
        .when((power < -4) | (power >= 6), scientific)
        .otherwise(plain)
    )


def cap_numeric(value: Column, cap: float) -> Column:
    """``cap+`` from the cap on, else the number in its shortest form."""
    number = coerce(value)
    return F.when(number >= cap, F.lit(f"{cap:g}+")).otherwise(general(number))


def bands(value: Column, edges: list[float], cap: float | None = None) -> Column:
    """Half-open bands [lo, hi) named by their whole ends; null where no number."""
    number = coerce(value)
    edges = sorted(set(edges))
    out = F.when(number.isNull(), None)
    if cap is not None:
        out = out.when(number >= cap, F.lit(f"{cap:g}+"))
    out = out.when(number < edges[0], F.lit(f"<{edges[0]:g}"))
    for low, high in zip(edges, edges[1:]):
        last = high - 1 if float(high).is_integer() else high
        out = out.when(number < high, F.lit(f"{low:g}-{last:g}"))
    return out.otherwise(F.lit(f"{edges[-1]:g}+"))
