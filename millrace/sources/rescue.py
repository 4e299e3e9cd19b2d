"""JSON lines with type hints; values that do not fit are rescued, not lost."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESCUED = "_rescued_data"


def parse_hints(text: str) -> dict[str, str]:
    """``"ts long, SaleID string"`` as a mapping."""
    pairs = (part.split(None, 1) for part in text.split(","))
    return {name: kind.strip() for name, kind in pairs}


def parse_json_lines(
    df: DataFrame,
    fields: Sequence[str],
    hints: Mapping[str, str] | str | None = None,
    value: str = "value",
    rescued: str = RESCUED,
) -> DataFrame:
    """Replace a JSON text column by typed columns and ``_rescued_data``.

    Each line is parsed once, to text values. Fields with a hint are cast to it, all
    others stay text (nested values as JSON text). What does not cast, and what is not
    among ``fields``, is kept as a JSON object in the rescued column; a line that is no
    JSON object is kept there whole. The column is NULL when a line fits. Runs on tables
    and streams.
    """
    if isinstance(hints, str):
        hints = parse_hints(hints)
    hints = dict(hints or {})
    kept = [c for c in df.columns if c != value]
    names = [*fields, *[h for h in hints if h not in fields]]
    raw = F.col("__raw")
    text = {n: F.element_at(raw, F.lit(n)) for n in names}
    cast = {n: k for n, k in hints.items() if k.lower() != "string"}
    # one step per stage, so that a line is parsed and a field is cast only once
    parsed = df.withColumn(
        "__raw", F.from_json(F.col(value), "map<string,string>", {"mode": "PERMISSIVE"})
    )
    typed = parsed.withColumns({f"__typed_{n}": text[n].try_cast(k) for n, k in cast.items()})

    def misfit(key: Column, _: Column) -> Column:
        bad = ~key.isin(*names)
        for n in cast:
            bad = bad | ((key == n) & text[n].isNotNull() & F.col(f"__typed_{n}").isNull())
        return bad

    left_over = F.map_filter(raw, misfit)
    rescue = (
        F.when(raw.isNull(), F.col(value))
        .when(F.size(left_over) > 0, F.to_json(left_over))
        .alias(rescued)
    )
    values = [(F.col(f"__typed_{n}") if n in cast else text[n]).alias(n) for n in names]
    return typed.select(*values, rescue, *kept)
