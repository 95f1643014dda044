"""Is a text column free text or a pick-list?  Signals and verdict."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.functions.text import normal
from veilframe.operators.detect import PatternDetector, findings_of

# Thresholds of the signals.
MATCH, TERMS_PER_CODE, PROSE, WORDS = 0.95, 1.15, 0.15, 3.5


def signals(df: DataFrame, column: str, coded: str | None = None) -> DataFrame:
    """One row: values, distinct values, words, prose rate, match rate, terms per code."""
    text = F.col(column).cast("string")
    rows = df.where(text.isNotNull())
    base = rows.agg(
        F.count(F.lit(1)).alias("n_values"),
        F.count_distinct(text).alias("n_distinct"),
        F.avg(F.when(F.trim(text) == "", 0).otherwise(F.size(F.split(F.trim(text), r"\s+")))).alias("mean_words"),
        F.avg(text.rlike(r"[.;,]|[0-9]{2,}").cast("int")).alias("sentence_rate"),
    )
    if coded is None:
        none = F.lit(None).cast("double")
        return base.select("*", none.alias("match_rate"), none.alias("terms_per_code"))
    pairs = rows.where(F.col(coded).isNotNull()).select(
        text.alias("t"), normal(text).alias("a"), normal(F.col(coded).cast("string")).alias("b")
    )
    match = pairs.agg(F.avg((F.col("a") == F.col("b")).cast("int")).alias("match_rate"))
    # Distinct pairs first: a code with many rows costs its distinct terms only.
    per_code = pairs.select("b", "t").distinct().groupBy("b").agg(F.count(F.lit(1)).alias("n"))
    terms = per_code.agg(F.avg("n").alias("terms_per_code"))
    one = F.lit(1).alias("_one")  # three single rows side by side
    return base.select("*", one).join(match.select("*", one), "_one").join(terms.select("*", one), "_one").drop("_one")


def characterise(df: DataFrame, column: str, coded: str | None = None, factory: Callable = PatternDetector) -> dict[str, object]:
    """Signals with the share of distinct texts a detector flags, and the verdict."""
    row = signals(df, column, coded).first().asDict()
    flagged = findings_of(df, column, factory).count()
    row["hit_rate"] = flagged / row["n_distinct"] if row["n_distinct"] else 0.0
    row["verdict"] = verdict(row)
    return row


def verdict(s: dict) -> str:
    """verbatim, mixed, controlled or unknown."""
    if not s["n_values"]:
        return "unknown"
    raised = [
        s["match_rate"] is not None and s["match_rate"] < MATCH,
        s["terms_per_code"] is not None and s["terms_per_code"] >= TERMS_PER_CODE,
        s["sentence_rate"] >= PROSE or s["mean_words"] >= WORDS,
        s["hit_rate"] > 0,
    ]
    if raised[3] or sum(raised) >= 2:
        return "verbatim"
    if sum(raised) == 1:
        return "mixed"
    return "unknown" if s["match_rate"] is None else "controlled"
