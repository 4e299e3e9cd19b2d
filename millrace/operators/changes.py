"""Row changes on plain tables: update, delete, merge, change feed, versions.

A table's changes are kept as an ordinary DataFrame, the change log: the table's own
columns plus ``change_type`` (insert, update_preimage, update_postimage, delete),
``version`` and, if wanted, ``commit_timestamp`` and ``operation``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import json_path, text_to_epoch
from millrace.operators.dedup import latest_per_key

LOG_COLUMNS = ("change_type", "version", "commit_timestamp", "operation")


def _expr(value: Column | str) -> Column:
    return F.expr(value) if isinstance(value, str) else value


def _holds(condition: Column | str) -> Column:
    return F.coalesce(_expr(condition), F.lit(False))


def update_rows(
    df: DataFrame, assignments: Mapping[str, Column | str], where: Column | str | None = None
) -> DataFrame:
    """Set columns on the rows where the condition is true; NULL leaves a row as it is.

    Strings are SQL expressions. All of them see the row as it was before the update.
    """
    hit = F.lit(True) if where is None else _holds(where)
    types = {f.name: f.dataType for f in df.schema.fields}
    changed = {
        name: F.when(hit, _expr(value).cast(types[name])).otherwise(F.col(name))
        for name, value in assignments.items()
    }
    return df.withColumns(changed)


def delete_rows(df: DataFrame, where: Column | str) -> DataFrame:
    """Remove the rows where the condition is true; NULL keeps a row."""
    return df.where(~_holds(where))


def unique_by(df: DataFrame, keys: Sequence[str], message: str) -> DataFrame:
    """The same rows, or an error when run if a complete key occurs twice.

    Repeated keys are counted in a subquery, which Spark runs before the rows move on,
    so no join ever sees them.
    """
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    counts = df.where(present).groupBy(*keys).agg(F.count(F.lit(1)).alias("__rows"))
    repeated = counts.where("__rows > 1").agg(F.count(F.lit(1)).alias("__n")).scalar()
    stop = F.raise_error(F.lit(message)).cast("boolean")
    return df.where(F.when(repeated > 0, stop).otherwise(True))


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    hash_col: str | None = "row_hash",
    check_source: bool = True,
) -> DataFrame:
    """The target after a merge from ``source``.

    A target row whose key is in the source takes the source's values if the hashes
    differ (a NULL hash means no update); a source row whose key is not in the target
    is inserted; all other target rows stay. NULL keys match nothing. A key given twice
    by the source is an error, checked unless ``check_source`` is off.

    The target is the probe side of a left join. So a small source is broadcast and the
    target is not shuffled at all, and with a large one Spark can split target keys
    that hold many rows, which a full outer join would not allow. Spark must know that
    the source is small, so a derived one is best stored first.
    """
    if check_source:
        source = unique_by(source, keys, "merge source holds a key more than once")
    columns = target.columns
    values = [c for c in columns if c not in keys]
    new = source.select(
        *keys, F.lit(True).alias("__hit"), *[F.col(c).alias(f"__new_{c}") for c in values]
    )
    if hash_col:
        update = F.col(hash_col) != F.col(f"__new_{hash_col}")
    else:
        update = F.col("__hit")
    update = F.coalesce(update, F.lit(False))
    kept = target.join(new, list(keys), "left").select(
        *[
            F.col(c) if c in keys else F.when(update, F.col(f"__new_{c}")).otherwise(F.col(c)).alias(c)
            for c in columns
        ]
    )
    # only the target's keys that the source has, made distinct
    hits = target.select(*keys).join(source.select(*keys), list(keys), "left_semi").distinct()
    inserted = source.select(*columns).join(hits, list(keys), "left_anti")
    return kept.unionByName(inserted)


def snapshot_diff(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row change feed between two states of a table whose rows are unique by ``keys``.

    Both states are grouped by all columns in one shuffle, where equal rows cancel out;
    only changed rows go on to be paired by key. NULL keys are keys. Unlike a full outer
    join this cannot blow up: a key that has several changed rows in one state collapses
    in each task and ends as an error.
    """
    columns = old.columns
    sides = old.withColumn("__side", F.lit(-1)).unionByName(new.withColumn("__side", F.lit(1)))
    changed = sides.groupBy(*columns).agg(F.sum("__side").alias("__net")).where("__net <> 0")
    gone, came = F.col("__net") < 0, F.col("__net") > 0
    paired = changed.groupBy(*[F.col(k).alias(f"__key_{i}") for i, k in enumerate(keys)]).agg(
        F.max(F.when(gone, F.struct(*columns))).alias("__old"),
        F.max(F.when(came, F.struct(*columns))).alias("__new"),
        F.greatest(F.sum(F.when(gone, -F.col("__net"))), F.sum(F.when(came, F.col("__net")))).alias(
            "__copies"
        ),
    )

    def image(kind: str, side: str) -> Column:
        return F.struct(F.col(side).alias("row"), F.lit(kind).alias("change_type"))

    twice = F.raise_error(F.lit("a state of the table holds a key more than once"))
    images = (
        F.when(F.col("__copies") > 1, twice)
        .when(F.col("__new").isNull(), F.array(image("delete", "__old")))
        .when(F.col("__old").isNull(), F.array(image("insert", "__new")))
        .otherwise(
            F.array(image("update_preimage", "__old"), image("update_postimage", "__new"))
        )
    )
    return paired.select(F.inline(images)).select("row.*", "change_type")


def log_version(
    old: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str],
    version: int,
    commit_timestamp: datetime | None = None,
    operation: str = "WRITE",
) -> DataFrame:
    """Change-log rows that turn ``old`` into ``new`` (all inserts when there is no old)."""
    if old is None:
        feed = new.withColumn("change_type", F.lit("insert"))
    else:
        missing = [f for f in new.schema.fields if f.name not in old.columns]
        old = old.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
        feed = snapshot_diff(old.select(*new.columns), new, keys)
    return feed.withColumns(
        {
            "version": F.lit(version).cast("long"),
            "commit_timestamp": F.lit(commit_timestamp).cast("timestamp"),
            "operation": F.lit(operation),
        }
    )


def append_log(feed: DataFrame, path: str) -> None:
    """Add the changes of new versions to a stored log, one partition a version."""
    feed.write.mode("append").partitionBy("version").parquet(path)


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A stored log; a range of versions or a read as of a version scans only their partitions."""
    log = spark.read.option("mergeSchema", True).parquet(path)
    return log.withColumn("version", F.col("version").cast("long"))


def changes_between(
    log: DataFrame,
    start: int | datetime,
    end: int | datetime | None = None,
    by: str = "version",
) -> DataFrame:
    """Changes from ``start`` to ``end``, both included; no end means the latest."""
    out = log.where(F.col(by) >= F.lit(start))
    return out if end is None else out.where(F.col(by) <= F.lit(end))


def as_of(
    log: DataFrame,
    keys: Sequence[str],
    version: int | None = None,
    timestamp: datetime | None = None,
    order: Sequence[str] = ("version",),
) -> DataFrame:
    """The table as it was at a version or time (the latest when neither is given)."""
    if version is not None:
        log = log.where(F.col("version") <= F.lit(version))
    if timestamp is not None:
        log = log.where(F.col("commit_timestamp") <= F.lit(timestamp))
    images = log.where(F.col("change_type") != "update_preimage")
    last = latest_per_key(images, keys, list(order))
    return last.where(F.col("change_type") != "delete").drop(*LOG_COLUMNS)


def snapshot_to(
    log: DataFrame, keys: Sequence[str], path: str, version: int | None = None, **kwargs
) -> None:
    """Write a stand-alone copy of the table at a version."""
    as_of(log, keys, version=version, **kwargs).write.mode("errorifexists").parquet(path)


def history(log: DataFrame) -> DataFrame:
    """One row per version: operation, time (if logged) and counts by kind of change."""
    by = [c for c in ("version", "commit_timestamp", "operation") if c in log.columns]

    def count(kind: str) -> Column:
        return F.count_if(F.col("change_type") == kind)

    return log.groupBy(*by).agg(
        count("insert").alias("inserted_rows"),
        count("update_postimage").alias("updated_rows"),
        count("delete").alias("deleted_rows"),
    )


def table_mismatch(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows found in one table only, with ``side`` telling which.

    Equal to (left EXCEPT right) UNION (right EXCEPT left). One grouping of both tables
    instead of two anti joins: copies of a row collapse before the shuffle, and each
    table is read and shuffled once.
    """
    tagged = left.withColumn("__left", F.lit(1)).unionByName(right.withColumn("__left", F.lit(0)))
    seen = tagged.groupBy(*left.columns).agg(
        F.max("__left").alias("__max"), F.min("__left").alias("__min")
    )
    side = F.when(F.col("__max") == 1, "left").otherwise("right").alias("side")
    return seen.where(F.col("__max") == F.col("__min")).select(*left.columns, side)


def except_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` has not (EXCEPT), by the same grouping."""
    return table_mismatch(left, right).where("side = 'left'").drop("side")


def repair_from_rescued(
    df: DataFrame, column: str = "ts", rescued: str = "_rescued_data"
) -> DataFrame:
    """Fill a NULL epoch column from the time text kept in the rescued JSON."""
    return update_rows(
        df,
        {column: text_to_epoch(json_path(rescued, column))},
        F.col(rescued).isNotNull() & F.col(column).isNull(),
    )
