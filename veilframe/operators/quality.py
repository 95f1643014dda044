"""Column-level data quality profile and load-to-load breaks (problem 5).

One pass turns the profiled columns into (group, load, column, value) and
counts each distinct value with map-side combine; a hot feed is thereby spread
over its values before anything is gathered.  A second, much smaller
aggregation folds the distinct values into the profile.  All figures are
mergeable: counts, ranges, violation counts and *exact* power sums.  A number of
up to 12 whole and 6 decimal digits enters them as a whole number of millionths,
so nothing is ever rounded; other numbers (longer ones, powers of ten) are left
out of the sums and counted as ``n_outside``.  A sum beyond 38 digits becomes
null instead of failing.  ``merge_profiles`` adds profiles of parts.  Loads are compared by a join on
``load_no - 1`` and never by an unbounded window.

Rates are shares of the non-null values and null where a load has none (a null
rate is no break).  An absent previous load is no break.  Values are profiled
as text; empty text is a value.  Empty input gives an empty profile.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.functions.patterns import DECIMAL_NUMBER, WRITTEN_DAY

#: Difference of a rate, and factor of distinct counts, that count as a break.
RATE_STEP = 0.2
UNIQUE_FACTOR = 3
#: Numbers whose millionths are whole and fit 18 digits.
EXACT = r"^\s*[+-]?0*[0-9]{0,12}(\.[0-9]{0,6}0*)?\s*$"
MILLIONTHS = 1e6


def is_number(value: Column) -> Column:
    return F.coalesce(value.rlike(DECIMAL_NUMBER), F.lit(False))


def is_written_day(value: Column) -> Column:
    return F.coalesce(value.rlike(WRITTEN_DAY), F.lit(False))


def moments(m: str, sum1: str, sum2: str) -> tuple[Column, Column]:
    """Mean and variance of m numbers from their power sums in millionths.

    The sums are moved to a whole number near the mean while they are exact, so
    a small spread around a large mean is not lost to the rounding of doubles.
    """
    near = f"cast(round(cast({sum1} AS double) / {m}) AS decimal(38,0))"
    first = f"try_subtract({sum1}, try_multiply({near}, cast({m} AS decimal(20,0))))"
    cross = f"try_multiply(try_multiply({near}, 2BD), {sum1})"
    square = f"try_multiply(try_multiply({near}, {near}), cast({m} AS decimal(20,0)))"
    second = f"try_add(try_subtract({sum2}, {cross}), {square})"
    rest = F.expr(f"cast({first} AS double) / {m}")
    spread = F.expr(f"cast({second} AS double) / {m}") - rest * rest
    mean = F.expr(f"cast({sum1} AS double) / {m}") / MILLIONTHS
    return mean, F.when(spread.isNotNull(), F.greatest(spread, F.lit(0.0)) / (MILLIONTHS * MILLIONTHS))


def profile(df: DataFrame, by: list[str], columns: list[str], patterns: dict[str, str] | None = None) -> DataFrame:
    """One row per (by, column_name): counts, ranges, rates and power sums."""
    patterns = patterns or {}
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    )
    values = (
        df.select(*by, pairs.alias("_p"))
        .select(*by, "_p.column_name", "_p.value")
        .groupBy(*by, "column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    value, n, present = F.col("value"), F.col("n"), F.col("value").isNotNull()
    exact = is_number(value) & value.rlike(EXACT)
    number = F.when(exact, F.expr("cast(try_cast(trim(value) AS decimal(18,6)) * 1000000BD AS decimal(18,0))"))
    read = F.when(is_number(value), F.expr("try_cast(trim(value) AS double)"))
    wrong = F.lit(False)
    for column, pattern in patterns.items():
        wrong = wrong | ((F.col("column_name") == column) & present & ~value.rlike(pattern))

    def total(cond: Column) -> Column:
        return F.coalesce(F.sum(F.when(cond, n)), F.lit(0).cast("long"))

    weight = n.cast("decimal(13,0)")
    folded = values.groupBy(*by, "column_name").agg(
        F.sum("n").alias("n_rows"),
        total(~present).alias("n_null"),
        F.count("value").alias("n_unique"),
        total(is_number(value)).alias("n_number"),
        total(is_written_day(value)).alias("n_day"),
        total(wrong).alias("n_violation"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.min(read).alias("min_number"),
        F.max(read).alias("max_number"),
        F.min(F.length("value")).alias("min_length"),
        F.max(F.length("value")).alias("max_length"),
        F.sum(F.when(number.isNotNull(), n)).alias("_m"),
        total(is_number(value) & number.isNull()).alias("n_outside"),
        F.try_sum(F.try_multiply(number, weight)).alias("sum1"),
        F.try_sum(F.try_multiply(F.try_multiply(number, number), weight)).alias("sum2"),
    )
    filled = F.col("n_rows") - F.col("n_null")
    mean, variance = moments("_m", "sum1", "sum2")
    return folded.select(
        *by,
        "column_name",
        "n_rows",
        "n_null",
        "n_unique",
        (F.col("n_null") / F.col("n_rows")).alias("null_rate"),
        F.when(filled > 0, F.col("n_number") / filled).alias("numeric_rate"),
        F.when(filled > 0, F.col("n_day") / filled).alias("raw_date_rate"),
        "n_violation",
        "min_value",
        "max_value",
        "min_number",
        "max_number",
        "min_length",
        "max_length",
        F.col("_m").alias("n_numeric"),
        "n_outside",
        "sum1",
        "sum2",
        mean.alias("mean"),
        variance.alias("variance"),
    )


def shifts(profiles: DataFrame, group: str, load: str) -> DataFrame:
    """Each load beside the one before it, with the standardised difference."""
    keys = [group, load, "column_name"]
    measures = [c for c in profiles.columns if c not in keys]
    before = profiles.select(
        group,
        (F.col(load) + 1).alias(load),
        "column_name",
        *[F.col(c).alias(f"prev_{c}") for c in measures],
    )
    joined = profiles.join(before, keys)
    spread = F.sqrt((F.col("variance") + F.col("prev_variance")) / 2)
    return joined.withColumn(
        "std_difference", F.when(spread > 0, (F.col("mean") - F.col("prev_mean")) / spread)
    )


def breaks(compared: DataFrame, group: str, load: str, rate_step: float = RATE_STEP, factor: int = UNIQUE_FACTOR) -> DataFrame:
    """(group, load, column_name, metric) for every broken metric.

    Rates are compared as exact fractions of counts, so a difference of just
    the step is no break whatever the binary rounding.
    """
    now, before = F.col("n_unique"), F.col("prev_n_unique")
    apart = [
        F.when(F.round(F.abs(F.col(m) - F.col(f"prev_{m}")), 12) > rate_step, F.lit(m))
        for m in ("null_rate", "numeric_rate", "raw_date_rate")
    ]
    unique = F.when((now != before) & ((now >= before * factor) | (now * factor <= before)), F.lit("n_unique"))
    return compared.select(
        group, load, "column_name", F.explode(F.array_compact(F.array(*apart, unique))).alias("metric")
    )


def merge_profiles(profiles: DataFrame, by: list[str]) -> DataFrame:
    """Profiles of parts added up to those of ``by``; all that can be added is exact.

    Distinct values of parts may be the same, so their number is left out.
    """
    n_rows, n_null, m = F.sum("n_rows"), F.sum("n_null"), F.sum("n_numeric")
    added = profiles.groupBy(*by, "column_name").agg(
        n_rows.alias("n_rows"), n_null.alias("n_null"), F.sum("n_violation").alias("n_violation"), m.alias("n_numeric"),
        F.sum("n_outside").alias("n_outside"), F.try_sum("sum1").alias("sum1"), F.try_sum("sum2").alias("sum2"),
        F.min("min_value").alias("min_value"), F.max("max_value").alias("max_value"), F.min("min_number").alias("min_number"),
        F.max("max_number").alias("max_number"), F.min("min_length").alias("min_length"), F.max("max_length").alias("max_length"),
    )
    mean, variance = moments("n_numeric", "sum1", "sum2")
    return added.withColumns({"null_rate": F.col("n_null") / F.col("n_rows"), "mean": mean, "variance": variance})
