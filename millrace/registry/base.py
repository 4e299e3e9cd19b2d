"""Registering queries over the driver's tables, each with the SQL it must agree with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import apply_settings

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name; ``sql`` is DuckDB's version of it."""

    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(apply_settings(spark), sf_dir)

        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def money(column: str) -> Column:
    """Exact sums, whatever the order of the rows."""
    return F.col(column).cast("decimal(18,2)")


def seconds(column: str) -> Column:
    return F.unix_timestamp(F.col(column).cast("timestamp"))


def as_text(column: str) -> Column:
    return F.date_format(F.col(column), "yyyy-MM-dd HH:mm:ss")
