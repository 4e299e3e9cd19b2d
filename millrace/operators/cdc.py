"""Database change logs into slowly changing dimensions.

Every result here is derived from the set of changes and their sequence key alone, so
any arrival order of the same changes ends in the same tables.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.dedup import _orderable, latest_per_key
from millrace.operators.skew import HOT_ROWS, next_in_key

# Columns the source database adds to a captured row.
CAPTURE_COLUMNS = (
    "__$start_lsn",
    "__$end_lsn",
    "__$seqval",
    "__$operation",
    "__$update_mask",
    "__$command_id",
)
# Columns that order changes globally, most significant first.
ORDER_COLUMNS = ("__$start_lsn", "__$command_id", "__$seqval", "__$operation")
# Capture operation codes; 3 is the row before an update.
OPERATIONS = {1: "DELETE", 2: "INSERT", 4: "UPDATE"}
BEFORE_UPDATE = 3

DECODED_COLUMNS = tuple(c.replace("__$", "__") for c in CAPTURE_COLUMNS)
GLOBAL_ORDER = "__global_order"
IS_DELETE = "__operation = 'DELETE'"


def with_global_order(
    df: DataFrame, columns: Sequence[str] = ORDER_COLUMNS, name: str = GLOBAL_ORDER
) -> DataFrame:
    """Add the sequence key as a struct.

    A struct compares field by field in the fields' own types: binary parts as unsigned
    bytes, command 2 before command 10. A NULL part sorts first and keeps the key.
    """
    return df.withColumn(name, F.struct(*[F.col(c) for c in columns]))


def global_sort(df: DataFrame, columns: Sequence[str] = ORDER_COLUMNS) -> DataFrame:
    return df.orderBy(*columns)


def decode_changes(captured: DataFrame) -> DataFrame:
    """Readable changes: plain column names, named operations, no before-images.

    Runs on tables and streams, as one filter that reaches the scan and one projection.
    An unknown operation code becomes NULL.
    """
    code = F.col("__$operation")
    words = F.create_map(*[F.lit(x) for pair in OPERATIONS.items() for x in pair])
    decoded = {c: F.col(c) for c in CAPTURE_COLUMNS} | {"__$operation": F.element_at(words, code)}
    payload = [c for c in captured.columns if c not in CAPTURE_COLUMNS]
    return captured.where(code != BEFORE_UPDATE).select(
        *payload,
        F.struct(*ORDER_COLUMNS).alias(GLOBAL_ORDER),
        *[column.alias(name) for name, column in zip(DECODED_COLUMNS, decoded.values())],
    )


def _deleted(condition: Column | str) -> Column:
    return F.coalesce(F.expr(condition) if isinstance(condition, str) else condition, F.lit(False))


def scd1_state(changes: DataFrame, keys: Sequence[str], order: str = GLOBAL_ORDER) -> DataFrame:
    """Last change of every key, deletes included.

    The deletes are tombstones: a change that arrives late cannot bring a key back.
    Works on streams (update or complete mode), and on (earlier state union new changes).
    """
    return latest_per_key(changes, keys, [order])


def live_rows(
    state: DataFrame,
    deletes: Column | str = IS_DELETE,
    exclude: Sequence[str] = (*DECODED_COLUMNS, GLOBAL_ORDER),
) -> DataFrame:
    """SCD type 1 table of a state: tombstones and change columns removed."""
    return state.where(~_deleted(deletes)).drop(*exclude)


def scd1(
    changes: DataFrame,
    keys: Sequence[str],
    order: str = GLOBAL_ORDER,
    deletes: Column | str = IS_DELETE,
    exclude: Sequence[str] = (*DECODED_COLUMNS, GLOBAL_ORDER),
) -> DataFrame:
    """Current row of each key by the last change; deleted keys are absent."""
    return live_rows(scd1_state(changes, keys, order), deletes, exclude)


def scd2(
    changes: DataFrame,
    keys: Sequence[str],
    order: str = GLOBAL_ORDER,
    deletes: Column | str = IS_DELETE,
    exclude: Sequence[str] = (*DECODED_COLUMNS, GLOBAL_ORDER),
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Every version of each key with the interval [valid_from, valid_to) it held.

    The next change of the key closes a version; a delete closes it without opening a
    new one. Changes that share their sequence key follow one another in the order of
    their other columns, as they do for SCD type 1, so all but the last hold an empty
    interval. A change delivered twice is equal in every column and counts once. Keys
    with more than ``hot_rows`` changes are worked on in pieces (see ``skew``).
    """
    rest = [f.name for f in changes.schema.fields if f.name not in (*keys, order) and _orderable(f.dataType)]
    placed = changes.withColumn("__place", F.struct(order, *rest))
    timed = next_in_key(placed, keys, "__place", "__next", hot_rows)
    held = timed.where(F.col("__next").isNull() | (F.col("__next") != F.col("__place")))
    bounds = [F.col(order).alias("valid_from"), F.col("__next").getField(order).alias("valid_to")]
    kept = [c for c in changes.columns if c not in exclude]
    return held.where(~_deleted(deletes)).select(*kept, *bounds)


def scd2_refresh(
    current: DataFrame,
    history: DataFrame,
    arrived: DataFrame,
    keys: Sequence[str],
    **options,
) -> DataFrame:
    """SCD type 2 table after new changes: only keys among ``arrived`` are rebuilt.

    ``history`` holds all changes, the arrived ones included. If Spark finds the keys that
    arrived to be few, it sends them to both tables, which are then not shuffled.
    """
    touched = arrived.select(*[F.col(k).alias(f"__t_{k}") for k in keys]).distinct()

    def on(df: DataFrame) -> list[Column]:
        return [df[k].eqNullSafe(touched[f"__t_{k}"]) for k in keys]

    untouched = current.join(touched, on(current), "left_anti")
    rebuilt = scd2(history.join(touched, on(history), "left_semi"), keys, **options)
    return untouched.unionByName(rebuilt, allowMissingColumns=True)


def range_split(df: DataFrame, columns: Sequence[str], parts: int) -> DataFrame:
    """The rows in ``parts`` partitions in sequence order, each sorted.

    Every row of one partition comes before all rows of the next. Writing the result
    gives that many ordered files.
    """
    return df.repartitionByRange(parts, *columns).sortWithinPartitions(*columns)
