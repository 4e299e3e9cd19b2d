"""From staged capture files to history, SCD type 1 and SCD type 2 tables, per table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pyspark.sql.types import StructField, StructType

from millrace.operators.cdc import (
    DECODED_COLUMNS,
    GLOBAL_ORDER,
    decode_changes,
    live_rows,
    scd1_state,
    scd2,
    scd2_refresh,
)
from millrace.sinks.buckets import BUCKET, BucketedTable, bucket_of, numbers
from millrace.sources.files import read_if_present
from millrace.sources.schema_store import SchemaStore
from millrace.sources.streams import stream_parquet
from millrace.streaming.runs import run_once
from millrace.streaming.scd import LOAD, append_history, fold_scd1


@dataclass(frozen=True)
class TableSpec:
    """A captured table and the columns that identify its rows."""

    name: str
    keys: tuple[str, ...]


def specs_from_conf(spark: SparkSession, prefix: str = "millrace.cdc.table") -> list[TableSpec]:
    """Specs from ``<prefix>.<n>.name`` and ``<prefix>.<n>.keys`` (a comma list), n = 0, 1, …"""
    specs = []
    while name := spark.conf.get(f"{prefix}.{len(specs)}.name", None):
        keys = spark.conf.get(f"{prefix}.{len(specs)}.keys", None)
        if not keys:
            raise ValueError(f"{prefix}.{len(specs)}.keys is not set for table {name}")
        specs.append(TableSpec(name, tuple(k.strip() for k in keys.split(","))))
    return specs


class CdcTables:
    """The tables derived from one captured table.

    ``load`` takes in staged files not seen before; the properties are lazy DataFrames
    over what has been loaded. Each table of a config has folders of its own, so several
    may be loaded side by side. History and both SCD tables lie in hash buckets of the key:
    a load reads and writes the buckets its changes fall into. ``buckets`` is for good.
    """

    def __init__(self, spark: SparkSession, spec: TableSpec, staged_root: str, out_root: str, buckets: int = 16):
        self.spark, self.spec, self.buckets = spark, spec, buckets
        self.staged = f"{staged_root.rstrip('/')}/{spec.name}"
        self.root = f"{out_root.rstrip('/')}/{spec.name}"
        self._schemas = SchemaStore(spark, self.staged, f"{self.root}/_schema")
        self._state = BucketedTable(spark, f"{self.root}/scd1_state", spec.keys, buckets)
        self._second = BucketedTable(spark, f"{self.root}/scd2", spec.keys, buckets)

    @property
    def schema(self) -> StructType:
        """Of all staged files taken in, late columns and grown types included."""
        return self._schemas.known()

    def load(self, load_id: int | None = None) -> int:
        """Staged files to bronze, bronze to decoded history, then both SCD tables.

        ``load_id`` has to be above that of every load in the history; by default it is the
        next one. Returns it. A column first seen in a new file is NULL in the rows before
        it, and a type that grew is the wider one throughout.

        A load that died is finished by the next one: the streams go on from their
        checkpoints, and the buckets of all loads after the last that ended are built anew
        from the history, whatever the broken load left in them.
        """
        begun, ended = self._noted()
        last = max((n for n in (begun, self._newest_in_history()) if n is not None), default=None)
        if load_id is None:
            load_id = 0 if last is None else last + 1
        if last is not None and load_id <= last:
            raise ValueError(f"load {load_id} of {self.spec.name} is not after the last one, {last}")
        schema = self._schemas.refresh()
        staged = stream_parquet(self.spark, self.staged, schema)
        run_once(staged, f"{self.root}/bronze", f"{self.root}/_checkpoints/bronze")
        bronze = decode_changes(stream_parquet(self.spark, f"{self.root}/bronze", schema))
        bronze = bronze.withColumn(BUCKET, bucket_of(self.spec.keys, self.buckets))
        append_history(bronze, f"{self.root}/history", f"{self.root}/_checkpoints/history", load_id, [BUCKET])
        self._note(load_id, False)
        self._fold(ended, begun == ended)
        self._note(load_id, True)
        return load_id

    def _fold(self, ended: int | None, whole: bool) -> None:
        """Bring the buckets hit since load ``ended`` up to date; from history alone unless the tables are ``whole``."""
        keys, history = self.spec.keys, self._history()
        arrived = history if ended is None else history.where(F.col(LOAD) > F.lit(ended))
        hit = numbers(arrived)
        if not hit:
            return
        known = history.where(F.col(BUCKET).isin(hit)).drop(LOAD, BUCKET)
        arrived = arrived.drop(LOAD, BUCKET)
        if ended is None or not whole:
            state, second = scd1_state(known, keys), scd2(known, keys)
        else:
            state = fold_scd1(self._state.read(hit, self._table_schema()), arrived, keys)
            second = scd2_refresh(self._second.read(hit, self._second_schema()), known, arrived, keys)
        self._state.replace(state, hit)
        self._second.replace(second, hit)

    def _newest_in_history(self) -> int | None:
        """The highest load number, found from partition folders alone."""
        found = read_if_present(self.spark, f"{self.root}/history", "load_id int")
        return None if found is None else found.agg(F.max(LOAD)).first()[0]

    def _note(self, load_id: int, ended: bool) -> None:
        note = self.spark.createDataFrame([(load_id, ended)], "load_id long, ended boolean")
        note.write.mode("append").parquet(f"{self.root}/_loads")

    def _noted(self) -> tuple[int | None, int | None]:
        """The last load that began to change tables, and the last that ended."""
        notes = read_if_present(self.spark, f"{self.root}/_loads")
        if notes is None:
            return None, None
        return tuple(notes.agg(F.max("load_id"), F.max(F.when(F.col("ended"), F.col("load_id")))).first())

    @property
    def bronze(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(f"{self.root}/bronze")

    @property
    def changes(self) -> DataFrame:
        """The decoded view over bronze; stored nowhere."""
        return decode_changes(self.bronze)

    def _table_schema(self) -> StructType:
        """Of the history and the SCD type 1 state."""
        return decode_changes(self.spark.createDataFrame([], self.schema)).schema

    def _second_schema(self) -> StructType:
        known = self._table_schema()
        bounds = [StructField(name, known[GLOBAL_ORDER].dataType) for name in ("valid_from", "valid_to")]
        return StructType([f for f in known if f.name not in (*DECODED_COLUMNS, GLOBAL_ORDER)] + bounds)

    def _history(self) -> DataFrame:
        schema = StructType([*self._table_schema()]).add(LOAD, "integer").add(BUCKET, "integer")
        return self.spark.read.schema(schema).parquet(f"{self.root}/history")

    @property
    def history(self) -> DataFrame:
        return self._history().drop(LOAD, BUCKET)

    @property
    def scd1(self) -> DataFrame:
        """SCD type 1 as of the last load."""
        return live_rows(self._state.read(schema=self._table_schema()))

    @property
    def scd2(self) -> DataFrame:
        """SCD type 2 as of the last load."""
        return self._second.read(schema=self._second_schema())


def build_cdc(
    spark: SparkSession, specs: list[TableSpec], staged_root: str, out_root: str
) -> dict[str, CdcTables]:
    """One set of tables per configured table, by name."""
    return {s.name: CdcTables(spark, s, staged_root, out_root) for s in specs}
