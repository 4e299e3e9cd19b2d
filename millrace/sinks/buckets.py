"""Tables in hash buckets of their key, where a change rewrites the buckets it hits and no other.

A bucket is a partition folder. Replacing buckets is a dynamic partition overwrite: Spark writes
the new files beside the old and swaps only the folders that got rows. A bucket is thus
either old or new, but a reader that comes while several are swapped may see some of both.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.operators.changes import merge_upsert, unique_by
from millrace.session import scratch_path

BUCKET = "__bucket"


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    """The bucket of a key. Taken from the key's text, so a key of int that grows to long stays."""
    return F.pmod(F.xxhash64(*[F.col(f"`{k}`").cast("string") for k in keys]), F.lit(buckets)).cast("int")


def numbers(rows: DataFrame) -> list[int]:
    """The buckets that ``rows`` name; there are never more than the table has."""
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())


@dataclass(frozen=True)
class BucketedTable:
    """A Parquet table at ``path``, its rows in ``buckets`` buckets by ``keys``.

    Choose the number for good: some 1 GB a bucket is fit for large tables.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]
    buckets: int = 64

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, bucket_of(self.keys, self.buckets))

    def exists(self) -> bool:
        try:
            self.spark.read.schema(f"{BUCKET} int").parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return False
        return True

    def read(self, only: Sequence[int] | None = None, schema: StructType | None = None) -> DataFrame:
        """The rows, or those of some buckets: the scan prunes the folders of all others.

        Give the schema where columns grew in type since the first write.
        """
        reader = self.spark.read.option("mergeSchema", True) if schema is None else self.spark.read.schema(schema)
        rows = reader.parquet(self.path)
        if only is not None:
            rows = rows.where(F.col(BUCKET).isin(list(only))) if only else rows.where(F.lit(False))
        return rows.drop(BUCKET)

    def hit_by(self, rows: DataFrame) -> list[int]:
        return numbers(self._bucketed(rows))

    def _files(self, hit: Sequence[int]) -> dict[int, set[str]]:
        """The files of some buckets; no column is read."""
        rows = self.spark.read.schema(f"{BUCKET} int").parquet(self.path).where(F.col(BUCKET).isin(list(hit)))
        found = rows.groupBy(BUCKET).agg(F.collect_set("_metadata.file_path")).collect()
        return {bucket: set(files) for bucket, files in found}

    def replace(self, rows: DataFrame, hit: Sequence[int] | None = None, emptied: bool = False) -> None:
        """Put ``rows`` in place of the buckets ``hit``, or of the whole table.

        ``rows`` must lie in those buckets and may be derived from the table itself. Say
        ``emptied`` if a bucket may be left without rows: a dynamic overwrite does not
        touch those, so their folders are removed afterwards.
        """
        rows = self._bucketed(rows).hint("rebalance", BUCKET)
        writer = rows.write.mode("overwrite").partitionBy(BUCKET)
        if hit is None:
            writer.option("partitionOverwriteMode", "static").parquet(self.path)
            return
        before = self._files(hit) if emptied else {}
        writer.option("partitionOverwriteMode", "dynamic").parquet(self.path)
        if emptied:
            after = self._files(hit)
            for bucket in (b for b in before if after.get(b) == before[b]):
                _remove(self.spark, f"{self.path}/{BUCKET}={bucket}")

    def merge(self, source: DataFrame, hash_col: str | None = "row_hash") -> list[int]:
        """Merge ``source`` by key as ``merge_upsert`` does; the buckets that were rewritten.

        The source is stored first: it is derived once, and Spark then knows its size.
        """
        path = scratch_path(self.spark, "merge-source")
        self._bucketed(source).write.parquet(path)
        source = self.spark.read.parquet(path)
        hit = numbers(source)
        if hit:
            source = unique_by(source.drop(BUCKET), self.keys, "merge source holds a key more than once")
            self.replace(merge_upsert(self.read(hit), source, self.keys, hash_col, check_source=False), hit)
        return hit


def _remove(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
