"""Increments as streams: the same contract on every new batch of rows.

Treatments that need no vault run as one stateless streaming plan; the full
contract runs per micro-batch, where new identifiers are issued to the vault
before they are joined, so an identifier keeps its stand-in across batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from veilframe.plans.pipeline import Pipeline
from veilframe.sources.study_io import ROW


def stateless(spark: SparkSession, source: str, columns: dict[str, Column], out: str, checkpoint: str) -> StreamingQuery:
    """Project new files of a Parquet folder into another, exactly once."""
    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).parquet(source)
    treated = stream.select(*[c.alias(n) for n, c in columns.items()])
    return (
        treated.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )


def contracted(
    spark: SparkSession, source: str, domain: str, pipeline: Pipeline, anchor: DataFrame | None, sink: Callable[[DataFrame, int], None],
    checkpoint: str,
) -> StreamingQuery:
    """The contract of one domain applied to every micro-batch.

    ``sink`` must be idempotent per batch number (overwrite ``batch=<n>``),
    because a batch may be written again after a failure.
    """
    from pyspark.sql import functions as F

    from veilframe.session import cut

    rules = pipeline.contract.domain(domain)

    def apply(batch: DataFrame, number: int) -> None:
        rows = cut(batch.withColumn(ROW, F.monotonically_increasing_id()))
        sink(pipeline.treat(rules, rows, anchor, []).drop(ROW), number)

    schema = spark.read.parquet(source).schema
    stream = spark.readStream.schema(schema).parquet(source)
    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
