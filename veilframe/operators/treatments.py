"""Column treatments that need neither vault nor detector."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.operators.ordering import dense_index

#: Values of a column that may be broadcast as a lookup.
SMALL_VALUES = 100_000


def lookup(values: DataFrame, limit: int = SMALL_VALUES) -> DataFrame:
    """Broadcast hint for a lookup only when its measured size allows it."""
    return F.broadcast(values) if values.limit(limit + 1).count() <= limit else values


def rare_values(df: DataFrame, column: str, min_count: int) -> DataFrame:
    """(value, n) of the categories under ``min_count``; nulls are no category."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") < min_count)
    )


def pool_rare(df: DataFrame, column: str, min_count: int, pooled: str = "OTHER") -> DataFrame:
    """Rare categories replaced by one pooled value."""
    rare = lookup(rare_values(df, column, min_count).select(F.col("value").alias("_rare")))
    joined = df.join(rare, F.col(column).cast("string") == F.col("_rare"), "left")
    return joined.withColumn(column, F.when(F.col("_rare").isNotNull(), pooled).otherwise(F.col(column).cast("string"))).drop("_rare")


def numbered_stand_ins(df: DataFrame, column: str, row_id: str, prefix: str) -> DataFrame:
    """Distinct values numbered in order of first appearance: ``PREFIX-000001``."""
    first = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.min(row_id).alias("_first"))
    ranked = dense_index(first, "_first").select(
        F.col(column).alias("_value"), F.format_string(f"{prefix}-%06d", F.col("_i") + 1).alias("_stand_in")
    )
    return df.join(lookup(ranked), F.col(column) == F.col("_value"), "left").withColumn(column, F.col("_stand_in")).drop("_value", "_stand_in")


def template(text: str, columns: dict[str, Column]) -> Column:
    """``{name}`` parts replaced by columns; null if any part is null."""
    parts = []
    for piece in re.split(r"(\{[^{}]+\})", text):
        if piece.startswith("{"):
            name = piece[1:-1]
            if name not in columns:
                raise KeyError(f"template names unknown column {name}")
            parts.append(columns[name].cast("string"))
        elif piece:
            parts.append(F.lit(piece))
    return F.concat(*parts) if parts else F.lit("")


def anchors(df: DataFrame, subject: str, date: str, row_id: str) -> DataFrame:
    """(subject, anchor): the last row of a subject wins, null dates included."""
    last = F.max_by(F.struct(F.col(date).alias("d")), F.col(row_id))
    return df.where(F.col(subject).isNotNull()).groupBy(F.col(subject).alias("subject")).agg(last["d"].alias("anchor"))


def with_anchor(df: DataFrame, subject: str, anchor: DataFrame) -> DataFrame:
    return df.join(lookup(anchor), F.col(subject) == F.col("subject"), "left").drop("subject")
