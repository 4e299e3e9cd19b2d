"""Row changes: update, delete, merge, change feed, versions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import with_row_hash
from millrace.operators import changes
from millrace.registry.base import query, table
from millrace.session import scratch_path
from millrace.sinks.buckets import BucketedTable


def _orders(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"
    )


@query(
    """
SELECT o_orderkey,
       CASE WHEN o_orderstatus = 'P' AND NULLIF(o_orderpriority, '5-LOW') <> '1-URGENT'
            THEN 'CANCELED' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderstatus = 'P' AND NULLIF(o_orderpriority, '5-LOW') <> '1-URGENT'
            THEN o_totalprice / 2 ELSE o_totalprice END AS o_totalprice,
       o_orderpriority
FROM orders
"""
)
def update_rows(spark: SparkSession, sf: str) -> DataFrame:
    return changes.update_rows(
        _orders(spark, sf),
        {"o_orderstatus": F.lit("CANCELED"), "o_totalprice": "o_totalprice / 2"},
        "o_orderstatus = 'P' AND nullif(o_orderpriority, '5-LOW') <> '1-URGENT'",
    )


@query(
    """
SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
WHERE NOT coalesce(o_orderstatus = 'F' AND NULLIF(o_orderpriority, '5-LOW') <> '1-URGENT', false)
"""
)
def delete_rows(spark: SparkSession, sf: str) -> DataFrame:
    return changes.delete_rows(
        _orders(spark, sf),
        "o_orderstatus = 'F' AND nullif(o_orderpriority, '5-LOW') <> '1-URGENT'",
    )


MERGED = """
WITH source AS (
  SELECT c_custkey, c_name, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal,
         c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')
  UNION ALL
  SELECT -1 - c_custkey, 'new ' || c_name, c_acctbal, c_mktsegment FROM customer
  WHERE c_mktsegment = 'HOUSEHOLD')
SELECT coalesce(t.c_custkey, s.c_custkey) AS c_custkey, coalesce(s.c_name, t.c_name) AS c_name,
       coalesce(s.c_acctbal, t.c_acctbal) AS c_acctbal,
       coalesce(s.c_mktsegment, t.c_mktsegment) AS c_mktsegment,
       t.c_custkey IS NULL OR (t.c_acctbal < 0 AND s.c_custkey IS NOT NULL) AS changed
FROM (SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer) t
FULL JOIN source s ON t.c_custkey = s.c_custkey
"""


def _accounts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """All customers, and what is merged into them.

    Overdrawn accounts of two segments are reset, and some customers are new. ``changed`` is
    copied along without being hashed, so it shows which rows the merge took from the source.
    """
    customer = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_acctbal", "c_mktsegment"
    )
    reset = changes.update_rows(
        customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")),
        {"c_acctbal": F.lit(0.0)},
        "c_acctbal < 0",
    )
    new = customer.where("c_mktsegment = 'HOUSEHOLD'").select(
        (F.lit(-1) - F.col("c_custkey")).alias("c_custkey"),
        F.concat(F.lit("new "), "c_name").alias("c_name"),
        "c_acctbal",
        "c_mktsegment",
    )
    target = with_row_hash(customer).withColumn("changed", F.lit(False))
    return target, with_row_hash(reset.unionByName(new)).withColumn("changed", F.lit(True))


@query(MERGED)
def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    target, source = _accounts(spark, sf)
    return changes.merge_upsert(target, source, ["c_custkey"]).drop("row_hash")


@query(MERGED)
def merge_buckets(spark: SparkSession, sf: str) -> DataFrame:
    """The same merge into a stored table, segment by segment, each rewriting the buckets it hits."""
    target, source = _accounts(spark, sf)
    stored = BucketedTable(spark, scratch_path(spark, "merge_buckets"), ("c_custkey",), 8)
    stored.replace(target)
    for segment in ("BUILDING", "MACHINERY", "HOUSEHOLD"):
        stored.merge(source.where(F.col("c_mktsegment") == segment))
    return stored.read().drop("row_hash")


NEW_ORDERS = """
SELECT o_orderkey, o_orderstatus,
       CASE WHEN o_orderstatus = 'P' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderpriority
FROM orders WHERE NOT (o_orderstatus = 'F' AND o_orderpriority = '1-URGENT')
UNION ALL
SELECT -1 - o_orderkey, o_orderstatus, o_totalprice, o_orderpriority
FROM orders WHERE o_orderpriority = '5-LOW'
"""


@query(
    f"""
WITH new_orders AS ({NEW_ORDERS}),
old_orders AS (SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders)
SELECT o.*, 'delete' AS change_type FROM old_orders o
WHERE NOT EXISTS (SELECT 1 FROM new_orders n WHERE n.o_orderkey = o.o_orderkey)
UNION ALL
SELECT n.*, 'insert' FROM new_orders n
WHERE NOT EXISTS (SELECT 1 FROM old_orders o WHERE n.o_orderkey = o.o_orderkey)
UNION ALL
SELECT o.*, 'update_preimage' FROM old_orders o JOIN new_orders n USING (o_orderkey)
WHERE o.o_totalprice <> n.o_totalprice
UNION ALL
SELECT n.*, 'update_postimage' FROM old_orders o JOIN new_orders n USING (o_orderkey)
WHERE o.o_totalprice <> n.o_totalprice
"""
)
def snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    old = _orders(spark, sf)
    kept = changes.delete_rows(old, "o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
    raised = changes.update_rows(kept, {"o_totalprice": "o_totalprice + 1"}, "o_orderstatus = 'P'")
    added = old.where("o_orderpriority = '5-LOW'").withColumn(
        "o_orderkey", F.lit(-1) - F.col("o_orderkey")
    )
    return changes.snapshot_diff(old, raised.unionByName(added), ["o_orderkey"])


def event_log(spark: SparkSession, sf: str, *extra: Column) -> DataFrame:
    """Events as a change log of users: the day is the version, the type the change."""
    kind = F.col("event_type")
    return table(spark, sf, "events").select(
        "user_id",
        "value",
        "props",
        "event_id",
        F.dayofmonth("ts").cast("long").alias("version"),
        F.when(kind == "signup", "insert")
        .when(kind == "error", "delete")
        .when(kind == "view", "update_preimage")
        .otherwise("update_postimage")
        .alias("change_type"),
        *extra,
    )


LOG = """
SELECT user_id, value, props, event_id, CAST(day(ts) AS BIGINT) AS version,
       CASE event_type WHEN 'signup' THEN 'insert' WHEN 'error' THEN 'delete'
            WHEN 'view' THEN 'update_preimage' ELSE 'update_postimage' END AS change_type
FROM events
"""


@query(f"SELECT * FROM ({LOG}) WHERE version BETWEEN 8 AND 9")
def changes_between(spark: SparkSession, sf: str) -> DataFrame:
    return changes.changes_between(event_log(spark, sf), 8, 9)


@query(f"SELECT * FROM ({LOG}) WHERE version >= 25")
def changes_since(spark: SparkSession, sf: str) -> DataFrame:
    return changes.changes_between(event_log(spark, sf), 25)


@query(
    f"""
SELECT user_id, value, props, event_id, 'changes' AS read FROM ({LOG}) WHERE version BETWEEN 8 AND 9
UNION ALL
SELECT user_id, value, props, event_id, 'as of'
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY version DESC, event_id DESC) AS rn
      FROM ({LOG}) WHERE version <= 10 AND change_type <> 'update_preimage')
WHERE rn = 1 AND change_type <> 'delete'
"""
)
def stored_log(spark: SparkSession, sf: str) -> DataFrame:
    """A log stored by version: its changes of two versions, and the table as it was at another."""
    path = scratch_path(spark, "stored_log")
    log = event_log(spark, sf)
    for early in (True, False):
        changes.append_log(log.where((F.col("version") < 9) == early), path)
    log = changes.read_log(spark, path)
    columns = ["user_id", "value", "props", "event_id"]
    between = changes.changes_between(log, 8, 9).select(*columns, F.lit("changes").alias("read"))
    then = changes.as_of(log, ["user_id"], version=10, order=("version", "event_id"))
    return between.unionByName(then.select(*columns, F.lit("as of").alias("read")))


@query(
    f"""
SELECT user_id, value, props, event_id
FROM (SELECT *, row_number() OVER (PARTITION BY user_id
                                   ORDER BY version DESC, event_id DESC) AS rn
      FROM ({LOG}) WHERE version <= 10 AND change_type <> 'update_preimage')
WHERE rn = 1 AND change_type <> 'delete'
"""
)
def as_of_version(spark: SparkSession, sf: str) -> DataFrame:
    log = event_log(spark, sf)
    return changes.as_of(log, ["user_id"], version=10, order=("version", "event_id"))


@query(
    f"""
SELECT user_id, value, props, event_id
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn
      FROM (SELECT *, CASE event_type WHEN 'error' THEN 'delete' ELSE 'x' END AS change_type
            FROM events WHERE ts < TIMESTAMP '2024-01-15 12:00:00' AND event_type <> 'view'))
WHERE rn = 1 AND change_type <> 'delete'
"""
)
def snapshot_at_time(spark: SparkSession, sf: str) -> DataFrame:
    """The users' table as it was at a time, written as a copy of its own."""
    path = scratch_path(spark, "snapshot_at_time")
    log = event_log(spark, sf, F.col("ts").cast("timestamp").alias("commit_timestamp"))
    moment = datetime(2024, 1, 15, 11, 59, 59, 999999)
    changes.snapshot_to(
        log, ["user_id"], path, timestamp=moment, order=("commit_timestamp", "event_id")
    )
    return spark.read.parquet(path)


@query(
    f"""
SELECT version, count(*) FILTER (change_type = 'insert') AS inserted_rows,
       count(*) FILTER (change_type = 'update_postimage') AS updated_rows,
       count(*) FILTER (change_type = 'delete') AS deleted_rows
FROM ({LOG}) GROUP BY version
"""
)
def history(spark: SparkSession, sf: str) -> DataFrame:
    return changes.history(event_log(spark, sf))
