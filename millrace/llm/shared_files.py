"""Files that tasks write themselves, in the folder all executors share.

A task writes under a name of its own and reports the file in a row; that table of rows is
stored before anybody reads, so files of lost or repeated attempts are never read.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from millrace.session import scratch_path


def open_for_write(folder: str, suffix: str):
    """A new file's path below ``folder`` (a path or URI) and an open stream to it."""
    path = f"{folder}/{uuid.uuid4().hex}{suffix}"
    system, inner = fs.FileSystem.from_uri(_uri(path))
    if isinstance(system, fs.LocalFileSystem):
        system.create_dir(inner.rpartition("/")[0], recursive=True)
    return path, system.open_output_stream(inner)


def open_for_read(path: str):
    system, inner = fs.FileSystem.from_uri(_uri(path))
    return system.open_input_stream(inner)


def _uri(path: str) -> str:
    if path.startswith("file:/") and not path.startswith("file://"):
        return "file://" + path[5:]
    return path if "://" in path else f"file://{path}"


def stored(df: DataFrame, label: str = "", path: str | None = None) -> DataFrame:
    """``df`` written to the shared folder and read again; its lineage ends there."""
    path = path or scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Deletes a stored table that nothing reads any more: all made from it is stored itself."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
