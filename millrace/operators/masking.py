"""Views whose columns and rows depend on the reader's groups."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def is_member(groups: Iterable[str], group: str) -> Column:
    """Constant TRUE or FALSE; Spark folds it, so the hidden column is not even read."""
    return F.lit(group in set(groups))


def mask_columns(
    df: DataFrame,
    columns: Iterable[str],
    groups: Iterable[str],
    allowed: str = "admins",
    mask: str = "REDACTED",
) -> DataFrame:
    """``columns`` as they are for members of ``allowed``, else the mask, or NULL where a column
    is not text."""
    member = is_member(groups, allowed)
    kinds = dict(df.dtypes)
    hidden = {c: F.lit(mask if kinds[c] == "string" else None).cast(kinds[c]) for c in columns}
    return df.withColumns({c: F.when(member, F.col(c)).otherwise(h) for c, h in hidden.items()})


def restrict_rows(
    df: DataFrame, visible: Column | str, groups: Iterable[str], allowed: str = "admins"
) -> DataFrame:
    """All rows for members of ``allowed``; for others only those where ``visible`` holds."""
    shown = F.expr(visible) if isinstance(visible, str) else visible
    return df.where(is_member(groups, allowed) | shown)
