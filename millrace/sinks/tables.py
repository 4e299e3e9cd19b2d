"""Writing tables, files and views."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from millrace.session import scratch_path


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def save_table(
    df: DataFrame,
    name: str,
    path: str | None = None,
    sort_by: Sequence[str] = (),
    partition_by: Sequence[str] = (),
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
    bucket_by: tuple[Sequence[str], int] | None = None,
) -> DataFrame:
    """Create or replace a Parquet table, at ``path`` if given.

    ``bucket_by`` (columns and a number) lays the rows out in sorted hash buckets that the
    catalogue knows: joins and groupings by those columns of tables with the same number of
    buckets need no shuffle. It is for tables that are written seldom and joined often.

    ``path`` is the table's root. Every save writes a fresh folder below it and only
    then points the table there, so the data may come from the table itself, and a save
    that fails leaves the table as it was.
    """
    spark = df.sparkSession
    if bucket_by:
        _save_bucketed(df, name, path, *bucket_by)
        describe_as(spark, name, comment, properties)
        return spark.table(name)
    if sort_by:
        df = df.orderBy(*sort_by)
    writer = df.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path is None:
        writer.mode("overwrite").saveAsTable(name)
    else:
        folder = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
        writer.mode("errorifexists").save(folder)
        _point_table(spark, name, folder, bool(partition_by))
    describe_as(spark, name, comment, properties)
    return spark.table(name)


def _save_bucketed(df: DataFrame, name: str, path: str | None, columns: Sequence[str], buckets: int) -> None:
    """One file a bucket, as the rows are dealt by it first; the old table goes when the new one is whole."""
    spark = df.sparkSession
    fresh = f"{name}_{uuid.uuid4().hex}"
    writer = df.repartition(buckets, *columns).write.format("parquet").bucketBy(buckets, *columns).sortBy(*columns)
    if path is not None:
        writer = writer.option("path", f"{path.rstrip('/')}/{uuid.uuid4().hex}")
    writer.saveAsTable(fresh)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"ALTER TABLE {fresh} RENAME TO {name}")


def _point_table(spark: SparkSession, name: str, folder: str, partitioned: bool) -> None:
    same = (
        not partitioned
        and spark.catalog.tableExists(name)
        and spark.table(name).schema == spark.read.parquet(folder).schema
    )
    if same:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(folder)}")
        spark.catalog.refreshTable(name)
        return
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    register_table(spark, name, folder)
    if partitioned:
        spark.catalog.recoverPartitions(name)


def register_table(spark: SparkSession, name: str, location: str) -> DataFrame:
    """Make files at a location a table unless the table exists."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION {_quoted(location)}")
    return spark.table(name)


def create_table_as(spark: SparkSession, name: str, query: str) -> DataFrame:
    """Drop and recreate a managed table from a SQL query."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(f"CREATE TABLE {name} USING parquet AS {query}")
    return spark.table(name)


def describe_as(
    spark: SparkSession,
    name: str,
    comment: str | None = None,
    properties: Mapping[str, str] | None = None,
) -> None:
    """Set a table's comment and properties."""
    if comment:
        spark.sql(f"COMMENT ON TABLE {name} IS {_quoted(comment)}")
    if properties:
        pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({pairs})")


def add_column(spark: SparkSession, name: str, column: str, kind: str) -> DataFrame:
    """Add a column to a table; rows already there have NULL."""
    spark.sql(f"ALTER TABLE {name} ADD COLUMN {column} {kind}")
    return spark.table(name)


def describe_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.sql(f"DESCRIBE EXTENDED {name}")


def use_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")
    spark.sql(f"USE {name}")


def drop_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def create_view(df: DataFrame, name: str) -> DataFrame:
    """A session view; recomputed whenever it is read."""
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def create_stored_view(
    spark: SparkSession, name: str, query: str, properties: Mapping[str, str] | None = None
) -> DataFrame:
    """A view kept in the catalogue."""
    pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in (properties or {}).items())
    spark.sql(f"CREATE OR REPLACE VIEW {name} {f'TBLPROPERTIES ({pairs})' if pairs else ''} AS {query}")
    return spark.table(name)


def stored(df: DataFrame, label: str = "stored") -> DataFrame:
    """The rows written to the scratch folder: derived once, and of a size Spark knows."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_json(df: DataFrame, path: str, files: int | None = None) -> None:
    """JSON lines; a fixed number of files is meant for small increments only."""
    (df if files is None else df.coalesce(files)).write.mode("overwrite").json(path)


def append_evolving(df: DataFrame, path: str) -> DataFrame:
    """Append rows that may lack or add columns; read back under the merged schema."""
    df.write.mode("append").parquet(path)
    return df.sparkSession.read.option("mergeSchema", True).parquet(path)
