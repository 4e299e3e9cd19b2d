"""One row per key: latest, first, and top-N per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from millrace.functions.columns import as_column


def _orderable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _orderable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    return not isinstance(kind, (MapType, VariantType))


def _extreme(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    greatest: bool,
    tie_breakers: Sequence[str] | None,
) -> DataFrame:
    named = [o for o in order if isinstance(o, str)]
    if tie_breakers is None:
        rest = [f for f in df.schema.fields if f.name not in keys and f.name not in named]
        tie_breakers = [f.name for f in rest if _orderable(f.dataType)]
    if df.isStreaming:
        return _extreme_state(df, keys, order, greatest, tie_breakers)
    by = [as_column(o) for o in [*order, *tie_breakers]]
    by = [c.desc_nulls_last() if greatest else c.asc_nulls_first() for c in by]
    nth = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return df.withColumn("__nth", nth).where("__nth = 1").drop("__nth")


def _extreme_state(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    greatest: bool,
    tie_breakers: Sequence[str],
) -> DataFrame:
    """The same as an aggregate, which Spark can keep as the state of a stream."""
    lead = [as_column(o).alias(f"__o{i}") for i, o in enumerate([*order, *tie_breakers])]
    row = F.struct(*[F.col(c) for c in df.columns if c not in keys])
    picked = (F.max_by if greatest else F.min_by)(row, F.struct(*lead))
    found = df.groupBy(*keys).agg(picked.alias("__row"))
    return found.select(
        *[F.col(c) if c in keys else F.col("__row").getField(c).alias(c) for c in df.columns]
    )


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the greatest ``order`` of every key; NULL orders first.

    By row number, which Spark cuts to one row per task and key before the shuffle, so a
    key with a third of the table costs its reducer one row per task. Rows that share
    the greatest order are settled by ``tie_breakers``: by default all other columns that
    have an order, so that any run gives the same row; with ``[]``, for an order that is
    unique in each key, the scan reads no more columns than the caller uses. On a stream
    it is an aggregate kept in Spark's state.
    """
    return _extreme(df, keys, order, True, tie_breakers)


def first_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column | str],
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """Drop duplicates on ``keys`` and keep the row with the least ``order``."""
    return _extreme(df, keys, order, False, tie_breakers)


def top_n_per_group(
    df: DataFrame,
    groups: Sequence[str],
    by: Column | str,
    n: int,
    name: str = "rank",
    spread_ties: bool = False,
) -> DataFrame:
    """Rows ranked 1..n by ``by`` descending in each group; rows that tie all stay.

    The filter on the rank lets Spark cut every task's share of a group to its own top
    n before the shuffle, so a group never travels whole. Rows that tie within the top n
    do meet in one task; set ``spread_ties`` if they may be a large part of a table, as
    with few different values. Then values are counted and ranked instead of rows, at
    most n per group, and joined back, for a second read of ``df``.
    """
    order = Window.partitionBy(*groups).orderBy(as_column(by).desc())
    if not spread_ties:
        return df.withColumn(name, F.rank().over(order)).where(F.col(name) <= n)

    keys = [F.col(g).alias(f"__g_{i}") for i, g in enumerate(groups)]
    counts = df.groupBy(*keys, as_column(by).alias("__by")).agg(F.count(F.lit(1)).alias("__rows"))
    top = Window.partitionBy(*[f"__g_{i}" for i in range(len(keys))]).orderBy(F.desc("__by"))
    ahead = F.sum("__rows").over(top.rowsBetween(Window.unboundedPreceding, -1))
    ranked = (
        counts.withColumn("__nth", F.row_number().over(top))
        .where(F.col("__nth") <= n)
        .withColumn("__ahead", F.coalesce(ahead, F.lit(0)))
        .where(F.col("__ahead") < n)
        .withColumn(name, F.col("__ahead").cast("int") + 1)
    )
    same = [df[g].eqNullSafe(ranked[f"__g_{i}"]) for i, g in enumerate(groups)]
    same.append(as_column(by).eqNullSafe(ranked["__by"]))
    return df.join(ranked, same).select(*[df[c] for c in df.columns], ranked[name])
