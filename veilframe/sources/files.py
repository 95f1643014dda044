"""Small-file access through Hadoop's file systems, so any scheme works."""

from __future__ import annotations

import uuid
from urllib.parse import unquote

from pyspark.sql import SparkSession

from veilframe.session import shared_folder


def _fs(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def exists(spark: SparkSession, path: str) -> bool:
    fs, at = _fs(spark, path)
    return fs.exists(at)


def delete(spark: SparkSession, path: str) -> None:
    fs, at = _fs(spark, path)
    fs.delete(at, True)


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, at = _fs(spark, old)
    to = spark._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(to.getParent())
    if not fs.rename(at, to):
        raise OSError(f"could not move {old} to {new}")


def listing(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """(name, is_directory) of a folder's entries, sorted by name."""
    fs, at = _fs(spark, path)
    return sorted((s.getPath().getName(), s.isDirectory()) for s in fs.listStatus(at)) if fs.exists(at) else []


def write_bytes(spark: SparkSession, path: str, content: bytes) -> None:
    fs, at = _fs(spark, path)
    out = fs.create(at, True)
    try:
        out.write(bytearray(content))
    finally:
        out.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    write_bytes(spark, path, text.encode())


def read_text(spark: SparkSession, path: str) -> str:
    fs, at = _fs(spark, path)
    stream = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint folder."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def qualified(spark: SparkSession, path: str) -> str:
    """The path with the scheme of its file system, as any executor reads it."""
    fs, at = _fs(spark, path)
    return fs.makeQualified(at).toString()


def _arrow(uri: str):
    """File system and path of a URI where there is no JVM (executors)."""
    from pyarrow import fs as arrow_fs

    if uri.startswith("file:"):
        return arrow_fs.LocalFileSystem(), "/" + unquote(uri[5:]).lstrip("/")
    if "://" not in uri:
        return arrow_fs.LocalFileSystem(), uri
    return arrow_fs.FileSystem.from_uri(uri)


def write_here(uri: str, content: bytes) -> None:
    """Writes a file from an executor; the same content again changes nothing."""
    system, at = _arrow(uri)
    system.create_dir(at.rsplit("/", 1)[0], recursive=True)
    with system.open_output_stream(at) as out:
        out.write(content)


def read_here(uri: str) -> bytes:
    """Content of a file of any scheme, read where the caller runs."""
    system, at = _arrow(uri)
    with system.open_input_stream(at) as content:
        return content.read()
