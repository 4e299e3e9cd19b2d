"""Batch file sources."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_csv(
    spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = ","
) -> DataFrame:
    """CSV with a header and quoted fields; types are inferred when no schema is given.

    Inferring reads the data once more, so give a schema for anything large.
    """
    reader = spark.read.options(header=True, sep=sep, quote='"')
    reader = reader.option("inferSchema", True) if schema is None else reader.schema(schema)
    return reader.csv(path)


def read_json(
    spark: SparkSession, path: str, schema: StructType | str | None = None
) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.json(path)


def read_parquet(spark: SparkSession, path: str, merge_schema: bool = False) -> DataFrame:
    """Parquet folder or glob; ``merge_schema`` when files gained columns over time."""
    return spark.read.option("mergeSchema", merge_schema).parquet(path)


def read_if_present(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame | None:
    """A Parquet folder, or None when nothing was written there yet."""
    reader = spark.read.option("mergeSchema", True) if schema is None else spark.read.schema(schema)
    try:
        return reader.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def query_path(spark: SparkSession, fmt: str, path: str) -> DataFrame:
    """A file path as a table in SQL."""
    return spark.sql(f"SELECT * FROM {fmt}.`{path}`")


def file_inventory(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """Path, name, size and modification time of the files under a folder.

    The file contents are not selected, hence not read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("size"),
        F.col("modificationTime"),
    )


def staged_schema(spark: SparkSession, path: str) -> StructType:
    """Schema of all Parquet files under a folder, for a stream over it.

    Spark reads the footers on the executors and merges them, so a column that only the
    newest file has is part of it.
    """
    try:
        return spark.read.option("mergeSchema", True).parquet(path).schema
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        raise FileNotFoundError(f"no Parquet file under {path}") from error


def staged_fields(spark: SparkSession, path: str) -> list[str]:
    """Top-level field names of all JSON-lines files under a folder."""
    reader = spark.read.option("primitivesAsString", True).option("recursiveFileLookup", True)
    fields = reader.json(path).schema.names
    if not fields:
        raise FileNotFoundError(f"no file with fields under {path}")
    return [f for f in fields if f != "_corrupt_record"]


def with_provenance(df: DataFrame) -> DataFrame:
    """Add the source file and the time of ingest; call it right after the read."""
    return df.select(
        "*",
        F.col("_metadata.file_path").alias("file_path"),
        F.current_timestamp().alias("inserted_at"),
    )
