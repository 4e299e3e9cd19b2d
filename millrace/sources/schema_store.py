"""A kept schema of a folder that files are added to, with columns that come late and types that grow.

The store remembers which files it has taken in and the schema they had. A refresh lists the
folder, reads only the footers of files not seen before (on the executors) and widens the kept schema
by them. Files whose types disagree cannot be merged by Spark, and trying costs a failed job. So a few
new writes, known by the id that Spark gives the files of one, are merged each by itself; of many,
or of files without an id, a batch is halved until each part agrees.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    MapType,
    ShortType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

from millrace.sources.files import file_inventory

_WHOLE = (ByteType, ShortType, IntegerType, LongType)
# Decimal digits of the whole-number types.
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}
# Writes that are merged each by itself; more are tried together first.
_FEW = 8
_WRITE = re.compile(r"part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})[^/]*$")


def widen(a: DataType, b: DataType) -> DataType:
    """The smallest type that holds the values of both; text where there is none."""
    if a == b:
        return a
    kinds = (type(a), type(b))
    if kinds == (StructType, StructType):
        return merge_fields([a, b])
    if kinds == (ArrayType, ArrayType):
        return ArrayType(widen(a.elementType, b.elementType), a.containsNull or b.containsNull)
    if kinds == (MapType, MapType):
        return MapType(widen(a.keyType, b.keyType), widen(a.valueType, b.valueType), a.valueContainsNull or b.valueContainsNull)
    if all(k in _WHOLE for k in kinds):
        return max(a, b, key=lambda t: _WHOLE.index(type(t)))
    if set(kinds) <= {FloatType, DoubleType, ByteType, ShortType, IntegerType}:
        return DoubleType()
    if set(kinds) <= {DecimalType, *_WHOLE}:
        sizes = [(t.precision - t.scale, t.scale) if isinstance(t, DecimalType) else (_DIGITS[type(t)], 0) for t in (a, b)]
        whole, scale = (max(s) for s in zip(*sizes))
        return DecimalType(whole + scale, scale) if whole + scale <= 38 else StringType()
    if set(kinds) == {DateType, TimestampNTZType}:
        return TimestampNTZType()
    return StringType()


def merge_fields(schemas: Iterable[StructType]) -> StructType:
    """All fields in order of first appearance, each of a type wide enough for all schemas; names ignore case."""
    found: dict[str, StructField] = {}
    for schema in schemas:
        for f in schema.fields:
            old = found.get(f.name.lower())
            kind = f.dataType if old is None else widen(old.dataType, f.dataType)
            found[f.name.lower()] = StructField(f.name if old is None else old.name, kind, True)
    return StructType(list(found.values()))


def _schemas(spark: SparkSession, writes: list[list[str]]) -> list[tuple[list[str], StructType]]:
    """Groups of files and the schema each group merges to; files of one write stay together."""
    if 1 < len(writes) <= _FEW:
        return [found for write in writes for found in _schemas(spark, [write])]
    paths = [path for write in writes for path in write]
    try:
        return [(paths, spark.read.option("mergeSchema", True).parquet(*paths).schema)]
    except Py4JJavaError as error:  # Spark has no Python error for it
        if len(paths) == 1 or "[CANNOT_MERGE_SCHEMAS]" not in str(error.java_exception):
            raise
    if len(writes) > 1:
        half = len(writes) // 2
        return _schemas(spark, writes[:half]) + _schemas(spark, writes[half:])
    half = len(paths) // 2
    return _schemas(spark, [paths[:half]]) + _schemas(spark, [paths[half:]])


def _writes(paths: list[str]) -> list[list[str]]:
    """Files by the write that made them, in order; those whose names do not tell are one group."""
    found: dict[str, list[str]] = {}
    for path in paths:
        known = _WRITE.search(path)
        found.setdefault(known[1] if known else "", []).append(path)
    return list(found.values())


class SchemaStore:
    """The schema of the Parquet files below ``folder``, kept at ``path``."""

    def __init__(self, spark: SparkSession, folder: str, path: str):
        self.spark, self.folder, self.path = spark, folder, path
        self._schema: StructType | None = None

    def _kept(self) -> DataFrame:
        """(file, schema): every file taken in, with the schema of its group as JSON."""
        empty = self.spark.createDataFrame([], "file string, schema string")
        try:
            return self.spark.read.schema(empty.schema).parquet(self.path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return empty

    def refresh(self) -> StructType:
        """Take in the footers of new files; the schema of all files so far."""
        try:
            files = file_inventory(self.spark, self.folder, "*.parquet").select(F.col("path").alias("file"))
            new = [r["file"] for r in files.join(self._kept(), "file", "left_anti").orderBy("file").collect()]
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            raise FileNotFoundError(f"no Parquet file under {self.folder}") from error
        if new:
            rows = [(file, schema.json()) for group, schema in _schemas(self.spark, _writes(new)) for file in group]
            self.spark.createDataFrame(rows, "file string, schema string").coalesce(1).write.mode("append").parquet(self.path)
            self._schema = None
        return self.known()

    def known(self) -> StructType:
        """The schema of the files taken in so far, without looking at the folder."""
        if self._schema is not None:
            return self._schema
        texts = self._kept().groupBy("schema").agg(F.min("file").alias("file")).orderBy("file").collect()
        if not texts:
            raise FileNotFoundError(f"no Parquet file under {self.folder}")
        self._schema = merge_fields(StructType.fromJson(json.loads(r["schema"])) for r in texts)
        return self._schema

    def read(self) -> DataFrame:
        """The files taken in so far under the kept schema.

        Files of one schema are one scan; where that is narrower its columns are cast, so any
        widening is read, text included. Streams read by the kept schema itself, which
        Spark's reader widens whole numbers, floats and decimals to.
        """
        schema, parts = self.known(), []
        for row in self._kept().groupBy("schema").agg(F.collect_list("file").alias("files")).collect():
            own = StructType.fromJson(json.loads(row["schema"]))
            names = {n.lower() for n in own.names}
            part = self.spark.read.schema(own).parquet(*row["files"])
            parts.append(part.select(*[(F.col(f"`{f.name}`") if f.name.lower() in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out
