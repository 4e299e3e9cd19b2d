"""Column builders: keys, hashes, lookups, epoch and JSON helpers."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def composite_key(*parts: Column | str, sep: str = "-") -> Column:
    """Join key parts as text; NULL as soon as one part is NULL, so it never matches."""
    pieces: list[Column] = []
    for part in parts:
        if pieces:
            pieces.append(F.lit(sep))
        pieces.append(as_column(part).cast("string"))
    return F.concat(*pieces)


def row_hash(columns: Iterable[str]) -> Column:
    """SHA-256 over the named columns, for change detection.

    The columns are hashed as one JSON object that keeps NULL fields and quotes text,
    so a value moving from one column to the next, or a separator inside a value, never
    yields the same hash, and a NULL key does not make the hash NULL.
    """
    row = F.struct(*[F.col(c) for c in columns])
    return F.sha2(F.to_json(row, {"ignoreNullFields": "false"}), 256)


def with_row_hash(
    df: DataFrame, columns: Iterable[str] | None = None, name: str = "row_hash"
) -> DataFrame:
    chosen = [c for c in (columns or df.columns) if c != name]
    return df.withColumn(name, row_hash(chosen))


def classify(value: Column | str, groups: Mapping[str, Iterable[str]]) -> Column:
    """Label a value by the list it is in; NULL when it is in none."""
    source = as_column(value)
    label: Column | None = None
    for name, members in groups.items():
        test = source.isin(*members)
        label = F.when(test, name) if label is None else label.when(test, name)
    return F.lit(None).cast("string") if label is None else label


def epoch_to_text(seconds: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Epoch seconds as text in the session time zone (pin it to UTC)."""
    return F.from_unixtime(as_column(seconds), fmt)


def text_to_epoch(text: Column | str) -> Column:
    """Timestamp text as epoch seconds; NULL, not an error, for text that is no time."""
    return F.unix_timestamp(F.try_to_timestamp(as_column(text)))


def month_of(ts: Column | str) -> Column:
    """``yyyy-MM`` of a timestamp, or of a text column holding one."""
    return F.date_format(as_column(ts).cast("timestamp"), "yyyy-MM")


def json_path(column: Column | str, path: str) -> Column:
    """Value under a dotted path of a JSON text column; NULL if absent or malformed."""
    return F.get_json_object(as_column(column), "$." + path)
