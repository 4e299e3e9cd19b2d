"""Slowly changing dimensions fed by a stream of changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.cdc import GLOBAL_ORDER, scd1_state
from millrace.streaming.runs import run_once

LOAD = "load_id"


def scd1_stream(changes: DataFrame, keys: Sequence[str], order: str = GLOBAL_ORDER) -> DataFrame:
    """Last change per key of a streaming DataFrame, kept in Spark's state store.

    Write it in update or complete mode. Late changes lose by their sequence key, not by
    a watermark.
    """
    return scd1_state(changes, keys, order)


def append_history(
    changes: DataFrame, path: str, checkpoint: str, load_id: int, partition_by: Sequence[str] = ()
) -> None:
    """Append the changes that are new to the history, marked with the load's number.

    The history is partitioned by load, and by other columns before it if given, so that a
    load is read without the ones before.
    """
    run_once(changes.withColumn(LOAD, F.lit(load_id)), path, checkpoint, [*partition_by, LOAD])


def read_history(spark: SparkSession, path: str, after_load: int | None = None) -> DataFrame:
    """All changes, or those of the loads after a given one."""
    history = spark.read.option("mergeSchema", True).parquet(path)
    if after_load is not None:
        history = history.where(F.col(LOAD) > F.lit(after_load))
    return history.drop(LOAD)


def fold_scd1(
    state: DataFrame | None, arrived: DataFrame, keys: Sequence[str], order: str = GLOBAL_ORDER
) -> DataFrame:
    """New SCD1 state from the old one and the changes that arrived.

    Costs the size of the state plus the arrivals, never the whole history.
    """
    rows = arrived if state is None else state.unionByName(arrived, allowMissingColumns=True)
    return scd1_state(rows, keys, order)

