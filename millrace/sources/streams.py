"""Incremental sources: each run or micro-batch sees only files not seen before."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.sources.files import staged_fields
from millrace.sources.rescue import parse_json_lines


def stream_json(
    spark: SparkSession,
    path: str,
    hints: Mapping[str, str] | str | None = None,
    fields: Sequence[str] | None = None,
    provenance: bool = True,
    max_files: int | None = None,
    archive: str | None = None,
) -> DataFrame:
    """JSON-lines files of a folder tree with hints, rescue and provenance columns.

    The field names are taken from the files already there when none are given; a field
    that shows up later goes to the rescued column. With ``archive``, a folder beside the
    tree, files of committed batches move there when the next batch is planned, so the
    listing of the tree does not grow with all that ever landed.
    """
    reader = spark.readStream.format("text").option("recursiveFileLookup", True)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    lines = reader.load(path)
    if provenance:
        lines = lines.select(
            "value",
            F.col("_metadata.file_path").alias("file_path"),
            F.current_timestamp().alias("inserted_at"),
        )
    return parse_json_lines(lines, fields or staged_fields(spark, path), hints)


def stream_parquet(
    spark: SparkSession, path: str, schema: StructType | str, max_files: int | None = None
) -> DataFrame:
    """Parquet files of a folder, or another stream's output folder."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)
