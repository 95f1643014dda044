"""Dense row numbers and random orders without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.session import cut


def dense_index(df: DataFrame, *order, name: str = "_i") -> DataFrame:
    """Adds 0..n-1 in the given order: range sort, then offsets per partition."""
    placed = cut(df.orderBy(*order).withColumn("_m", F.monotonically_increasing_id()))
    part = F.shiftright("_m", 33)
    counts = {r[0]: r[1] for r in placed.groupBy(part.alias("p")).count().collect()}  # one row per partition
    start, offsets = 0, []
    for p in sorted(counts):
        offsets.append((p, start))
        start += counts[p]
    spark = df.sparkSession
    table = spark.createDataFrame(offsets, "_p bigint, _start bigint")
    return (
        placed.withColumn("_p", part)
        .join(F.broadcast(table), "_p")  # one row per partition
        .withColumn(name, F.col("_start") + F.col("_m").bitwiseAND(F.lit((1 << 33) - 1)))
        .drop("_p", "_m", "_start")
    )


def shuffled(df: DataFrame, name: str = "_i", seed: int | None = None) -> DataFrame:
    """Adds 0..n-1 in a random order, pinned before it is used."""
    return dense_index(cut(df.withColumn("_r", F.rand(seed) if seed is not None else F.rand())), "_r", name=name).drop("_r")
