"""File layout jobs: compaction, clustering, and the files that hold a lookup's rows."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, TimestampNTZType, TimestampType

from millrace.sources.files import file_inventory

# Fixed value: default file size of a compaction, 50 MB.
TARGET_FILE_BYTES = 52_428_800


def partition_columns(spark: SparkSession, path: str) -> list[str]:
    """The columns a Parquet folder is partitioned by, from the folders of one of its files."""
    file = file_inventory(spark, path, "*.parquet").select("path").first()
    folders = file["path"].split("/")[:-1] if file else []
    names: list[str] = []
    for folder in reversed(folders):
        if "=" not in folder:
            break
        names.insert(0, folder.partition("=")[0])
    return names


def _writer(df: DataFrame, partitioned: Sequence[str]) -> DataFrameWriter:
    writer = df.write.mode("errorifexists")
    return writer.partitionBy(*partitioned) if partitioned else writer


def compact(
    spark: SparkSession, path: str, out: str, target_bytes: int = TARGET_FILE_BYTES
) -> None:
    """Rewrite a Parquet folder as files of about ``target_bytes``, without a shuffle.

    Spark's file scan already packs small files into one task up to a given size; one
    task then writes one file (of each partition it read). The size is set on a session
    of its own. Columns that only some files have are kept, and so is the partitioning.
    """
    job = spark.newSession()
    job.conf.set("spark.sql.files.maxPartitionBytes", str(target_bytes))
    job.conf.set("spark.sql.files.openCostInBytes", "0")
    job.conf.set("spark.sql.files.minPartitionNum", "1")
    df = job.read.option("mergeSchema", True).parquet(path)
    _writer(df, partition_columns(spark, path)).parquet(out)


def files_for(spark: SparkSession, path: str, target_bytes: int = TARGET_FILE_BYTES) -> int:
    """How many files of the target size the folder's bytes fill."""
    total = file_inventory(spark, path).agg(F.sum("size").alias("b")).first()["b"] or 0
    return max(1, -(-total // target_bytes))


def _bounds(df: DataFrame, columns: Sequence[str], buckets: int) -> dict[str, list[str]]:
    """Cut points of each column, as text, that part its rows into about equal ranges.

    Numbers and times: their percentiles, all in one aggregate. Other types: the least
    values of as many range partitions. Only the cut points reach the driver.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in columns if isinstance(kinds[c], (NumericType, DateType, TimestampType, TimestampNTZType))]
    shares = [i / buckets for i in range(1, buckets)]
    cuts: dict[str, list[str]] = {}
    if numeric:
        found = [F.percentile_approx(c, shares, 100 * buckets).cast("array<string>").alias(c) for c in numeric]
        row = df.select(*numeric).agg(*found).first()
        cuts |= {c: list(dict.fromkeys(row[c] or [])) for c in numeric}
    for c in columns:
        if c not in cuts:
            parts = df.select(c).where(F.col(c).isNotNull()).repartitionByRange(buckets, c)
            least = parts.groupBy(F.spark_partition_id().alias("part")).agg(F.min(c).alias("v")).orderBy("v")
            cuts[c] = [r["t"] for r in least.select(F.col("v").cast("string").alias("t")).collect()][1:]
    return cuts


def _spread_bits(bucket: int, column: int, width: int) -> int:
    """The bits of a bucket number, ``width`` places apart."""
    return sum(
        1 << (bit * width + width - 1 - column)
        for bit in range(bucket.bit_length())
        if bucket >> bit & 1
    )


def _by_range(column: str, kind: str, cuts: list[str], values: list[int]) -> str:
    """SQL for ``values[n]``, n being the number of cut points <= the column.

    The range is found by halving. NULL is in range 0. As text it is one expression to
    hand to Spark instead of hundreds.
    """
    if not cuts:
        return f"{values[0]}L"
    mid = len(cuts) // 2
    above = _by_range(column, kind, cuts[mid + 1 :], values[mid + 1 :])
    below = _by_range(column, kind, cuts[:mid], values[: mid + 1])
    cut = cuts[mid].replace("\\", "\\\\").replace("'", "\\'")
    return f"CASE WHEN `{column}` >= CAST('{cut}' AS {kind}) THEN {above} ELSE {below} END"


def z_value(df: DataFrame, columns: Sequence[str], bits: int = 6) -> Column:
    """Bits of the columns' range numbers interleaved, the first column highest.

    Every range already stands for its spread bits, so a row costs a few comparisons per
    column and no bit work beyond joining the columns.
    """
    cuts, kinds = _bounds(df, columns, 1 << bits), dict(df.dtypes)
    spread = []
    for i, c in enumerate(columns):
        values = [_spread_bits(n, i, len(columns)) for n in range(len(cuts[c]) + 1)]
        spread.append(F.expr(_by_range(c, kinds[c], cuts[c], values)))
    return reduce(lambda x, y: x.bitwiseOR(y), spread)


def zorder(df: DataFrame, columns: Sequence[str], files: int, bits: int | None = None) -> DataFrame:
    """Rows clustered by several columns in ``files`` range partitions.

    One column is a plain range sort. The ranges of a column follow the number of files:
    twice as many as an equal share of the files for each column, or 2**``bits``. Within
    one z cell the columns themselves cut further, and a hash of the whole row last, so
    that neither a crowded cell nor one value held by a third of the rows ends up in a
    single file.
    """
    if bits is None:
        bits = math.ceil(math.log2(max(files, 2)) / len(columns)) + 1
    z = [] if len(columns) == 1 else ["__z"]
    shaped = df.withColumn("__z", z_value(df, columns, bits)) if z else df
    return (
        shaped.withColumn("__spread", F.xxhash64(*df.columns))
        .repartitionByRange(files, *z, *columns, "__spread")
        .sortWithinPartitions(*z, *columns)
        .drop("__z", "__spread")
    )


def optimize(
    spark: SparkSession,
    path: str,
    out: str,
    zorder_by: Sequence[str] = (),
    target_bytes: int = TARGET_FILE_BYTES,
) -> None:
    """Compact a folder, clustered by the given columns if there are any.

    Columns that only some files have are kept, and so is the partitioning.
    """
    if not zorder_by:
        compact(spark, path, out, target_bytes)
        return
    files = files_for(spark, path, target_bytes)
    df = spark.read.option("mergeSchema", True).parquet(path)
    _writer(zorder(df, zorder_by, files), partition_columns(spark, path)).parquet(out)


def files_holding(df: DataFrame, condition: Column | str) -> DataFrame:
    """The files in which rows of a lookup lie, with their number of rows."""
    hit = F.expr(condition) if isinstance(condition, str) else condition
    return (
        df.select("*", F.col("_metadata.file_path").alias("file_path"))
        .where(hit)
        .groupBy("file_path")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
