"""Window work over keys of any size.

A window function needs all rows of its partition in one task. That is fine for
millions of ordinary keys and fatal for one key with a third of the table. The
functions here keep the plain window for ordinary keys and cut the heavy ones into
ordered pieces, with the same result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.sinks.tables import stored

# A key is hot if it has more rows than this: what one task sorts for a window without harm.
HOT_ROWS = 1_000_000


def hot_keys(df: DataFrame, keys: Sequence[str], rows: int = HOT_ROWS) -> DataFrame:
    """Keys with more than ``rows`` rows, from one count by key; never more than all rows / ``rows``."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    return counts.where(F.col("__rows") > F.lit(rows)).select(*keys)


def split_by(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of other keys, rows of the keys in ``hot``); together they are ``df``.

    Give ``hot`` stored: Spark then knows its size and broadcasts it where it is small.
    """
    hot = hot.select(*[F.col(k).alias(f"__hot_{i}") for i, k in enumerate(keys)])
    same = [df[k].eqNullSafe(hot[f"__hot_{i}"]) for i, k in enumerate(keys)]
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def next_in_key(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    name: str,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``name``: the ``order`` of the following row of the same key, NULL at the end.

    ``order`` should be unique in a key; among rows that tie in it, which follows which is open.

    Rows are counted by key first, in a job of its own that reads the keys alone. Where no key
    is hot, that is all: one scan, one shuffle and ``lead``. Hot keys are range-partitioned by
    (key, order), so that one key spreads over many tasks; ``lead`` runs inside each piece, and
    a second ``lead`` over only the first and last row of every piece closes the seams. The
    answer does not depend on where the pieces were cut.
    """
    plain = Window.partitionBy(*keys).orderBy(order)
    large = stored(hot_keys(df, keys, hot_rows), "hot-keys")
    if large.isEmpty():
        return df.withColumn(name, F.lead(order).over(plain))
    cold, hot = split_by(df, keys, large)
    cold = cold.withColumn(name, F.lead(order).over(plain))

    piece = Window.partitionBy("__piece", *keys).orderBy(order)
    hot = (
        hot.repartitionByRange(*keys, order)
        .withColumn("__piece", F.spark_partition_id())
        .withColumn(name, F.lead(order).over(piece))
        .withColumn("__nth", F.row_number().over(piece))
    )
    edge: Column = (F.col("__nth") == 1) | F.col(name).isNull()
    hot = hot.withColumn("__seam", F.when(edge, -1).otherwise(F.col("__piece")))
    seam = Window.partitionBy("__seam", *keys).orderBy(order)
    hot = hot.withColumn(name, F.coalesce(F.col(name), F.lead(order).over(seam)))
    return cold.unionByName(hot.select(*cold.columns))
