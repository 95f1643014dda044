"""Session construction and lineage control.

The master and the driver's memory are set only where nothing else names them:
under ``spark-submit`` (or with ``MASTER`` or ``SPARK_REMOTE`` in the
environment) the cluster's own settings hold.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession


#: Environment variables that show a session somebody else has configured.
SUBMITTED = {"PYSPARK_GATEWAY_PORT", "MASTER", "SPARK_REMOTE"}


def build_session(app: str = "veilframe", cpus: int | None = None, **conf: str) -> SparkSession:
    """Session with UTC, AQE and Arrow on; a local one unless it was submitted to a cluster."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # Checkpoints hold rows of the source: they go with the plans that read them.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if not SUBMITTED & set(os.environ):
        builder = (
            builder.master(f"local[{cpus}]")
            .config("spark.sql.shuffle.partitions", str(cpus))
            .config("spark.driver.memory", "8g")
            .config("spark.ui.enabled", "false")
        )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, else that of the context.

    A folder of this machine is made only for a local session (tests, bench); a
    cluster that names none is refused.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="veilframe-checkpoint-")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and drop its lineage."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One parquet table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
