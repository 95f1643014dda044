"""Reading and writing studies: one DataFrame per table, cells as text.

CSV, TXT and TSV cells are text with the usual missing spellings as null;
Parquet and SAS keep their types; a workbook gives one table per sheet.
"""

from __future__ import annotations

import json
import re
from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilframe.functions.text import na_to_null
from veilframe.session import cut
from veilframe.sources import files, workbook, xport

# Readable suffixes and stems that are no tables.
SUFFIXES = (".csv", ".txt", ".tsv", ".parquet", ".pq", ".xlsx", ".xlsm", ".xpt", ".sas7bdat")
RESERVED = frozenset("REVIEW_QUEUE MANIFEST CONTRACT README DECISIONS RISK_DETAIL".split())
REMOTE = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]+://")
ROW = "_row_id"


def is_remote(path: str) -> bool:
    return bool(REMOTE.match(path)) and not path.startswith("file://")


def discover(spark: SparkSession, folder: str) -> dict[str, str]:
    """Table name -> path; sheets of a workbook with several are ``book::sheet``."""
    found: dict[str, str] = {}
    for name, is_dir in files.listing(spark, folder):
        stem, suffix = PurePosixPath(name).stem, PurePosixPath(name).suffix.lower()
        if suffix not in SUFFIXES or name.startswith((".", "~$")) or is_dir and suffix not in (".parquet", ".csv"):
            continue
        if stem.upper() in RESERVED:
            continue
        path = f"{folder.rstrip('/')}/{name}"
        if suffix in (".xlsx", ".xlsm"):
            sheets = workbook.sheets(spark, path)
            if len(sheets) > 1:
                found |= {s.upper(): f"{path}::{s}" for s in sheets}
                continue
        if stem.upper() in found:
            raise ValueError(f"two tables are called {stem.upper()}")
        found[stem.upper()] = path
    return found


def explain_empty(spark: SparkSession, folder: str) -> str:
    """Why a folder gave no tables."""
    names = [n for n, _ in files.listing(spark, folder)]
    if not names:
        return f"{folder} is empty or does not exist"
    old = [n for n in names if n.lower().endswith(".xls")]
    if old:
        return f"{', '.join(old)}: save as .xlsx first"
    return "no readable tables among " + ", ".join(names[:10]) + f"; readable are {', '.join(SUFFIXES)}"


def read_table(spark: SparkSession, path: str) -> DataFrame:
    base, _, sheet = path.partition("::")
    suffix = PurePosixPath(base).suffix.lower()
    if suffix in (".parquet", ".pq"):
        return spark.read.parquet(base)
    if suffix in (".xlsx", ".xlsm"):
        return workbook.midnight_fix(workbook.read(spark, files.qualified(spark, base), sheet or None))
    if suffix == ".xpt":
        return xport.read(spark, files.qualified(spark, base))
    if suffix == ".sas7bdat":
        return _sas(spark, base)
    sep = "\t" if suffix == ".tsv" else ","
    df = spark.read.csv(base, header=True, sep=sep, inferSchema=False, multiLine=True, quote='"', escape='"', nullValue="", mode="FAILFAST")
    return df.select(*[na_to_null(F.col(f"`{c}`")).alias(c) for c in df.columns])


def _sas(spark: SparkSession, path: str) -> DataFrame:
    try:
        import pyreadstat
    except ImportError as missing:
        raise NotImplementedError("sas7bdat files need pyreadstat") from missing
    return spark.createDataFrame(pyreadstat.read_sas7bdat(path)[0])


def checksums(spark: SparkSession, folder: str) -> DataFrame:
    """(path, sha256) of every file of a folder and those below it."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder).select("path", F.sha2("content", 256).alias("sha256"))


def load_study(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """All tables with a row id that stays the same however often they are read."""
    found = discover(spark, folder)
    if not found:
        raise FileNotFoundError(explain_empty(spark, folder))
    return {n: cut(read_table(spark, p).withColumn(ROW, F.monotonically_increasing_id())) for n, p in found.items()}


def write_table(df: DataFrame, path: str) -> None:
    out = df.drop(ROW)
    if path.endswith((".parquet", ".pq")):
        out.write.mode("overwrite").parquet(path)
    elif path.endswith((".csv", ".tsv")):
        out.write.mode("overwrite").csv(path, header=True, sep="\t" if path.endswith(".tsv") else ",", escape='"')
    elif path.endswith(".xlsx"):
        workbook.write({PurePosixPath(path).stem.upper(): out}, path)  # a sheet for people to read; rows pass the driver one by one
    else:
        raise ValueError(f"cannot write {path}")


def write_study(tables: dict[str, DataFrame], folder: str, fmt: str = "parquet") -> dict[str, str]:
    paths = {n: f"{folder.rstrip('/')}/{n.lower()}.{fmt}" for n in tables}
    for name, df in tables.items():
        write_table(df, paths[name])
    return paths


def write_release(spark: SparkSession, published, folder: str, fmt: str = "parquet") -> dict[str, str]:
    """Tables and manifest, and beside them a folder of what must not be published."""
    paths = write_study(published.tables, folder, fmt)
    files.write_text(spark, f"{folder.rstrip('/')}/manifest.json", json.dumps(published.manifest, indent=1, default=str))
    review = f"{folder.rstrip('/')}_review"
    for name, df in published.tables.items():
        # The review copy keeps the row ids that the queue names.
        df.write.mode("overwrite").parquet(f"{review}/rows/{name}.parquet")
    if published.queue is not None:
        write_table(published.queue, f"{review}/review_queue.parquet")
    files.write_text(spark, f"{review}/risk_detail.json", json.dumps(published.risk, indent=1, default=str))
    return paths
