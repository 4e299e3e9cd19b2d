"""Per-row functions, dedup, itemising, rescue and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import columns as fc
from millrace.operators import changes, dedup, items, masking
from millrace.registry.base import as_text, money, query, seconds, table
from millrace.sources.rescue import parse_json_lines


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag
FROM (SELECT *, row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY coalesce(CASE WHEN l_returnflag <> 'N' THEN epoch(l_shipdate)::BIGINT END, 0) DESC,
                 l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
      FROM lineitem)
WHERE rn = 1
"""
)
def latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "lineitem").withColumn(
        "exported_ts", F.when(F.col("l_returnflag") != "N", seconds("l_shipdate"))
    )
    order = [F.coalesce(F.col("exported_ts"), F.lit(0))]
    order += ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    latest = dedup.latest_per_key(lines, ["l_orderkey", "l_linenumber"], order, tie_breakers=[])
    return latest.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"
    )


@query(
    """
SELECT event_id, user_id, event_type
FROM (SELECT *, row_number() OVER (
        PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM events)
WHERE rn = 1
"""
)
def first_per_key(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return dedup.first_per_key(events, ["user_id", "event_type"], ["ts", "event_id"]).drop("ts")


@query(
    """
SELECT o_orderkey,
       sha256('{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey
              || ',"o_orderstatus":"' || o_orderstatus || '","price":"'
              || CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR)
              || '","urgent":' || CASE WHEN o_orderpriority = '1-URGENT' THEN '"yes"'
                                       ELSE 'null' END || '}') AS row_hash
FROM orders
"""
)
def row_hash(spark: SparkSession, sf: str) -> DataFrame:
    shaped = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        money("o_totalprice").cast("string").alias("price"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "yes").alias("urgent"),
    )
    return fc.with_row_hash(shaped).select("o_orderkey", "row_hash")


@query(
    """
WITH sales AS (
  SELECT *, CASE WHEN o_orderstatus = 'P' THEN 0
                 ELSE CAST(substr(o_orderpriority, 1, 1) AS INT) END AS n
  FROM orders)
SELECT o_orderkey || '-' || pos AS id, CAST(o_orderkey AS VARCHAR) AS sale_id,
       'S' || o_orderstatus AS store_id, pos AS item_number,
       o_orderpriority || '/' || pos AS product_id, 'L' AS product_size,
       CASE WHEN o_orderstatus = 'F' THEN 'no "ice"' END AS product_notes,
       o_custkey + pos * 0.25 AS product_cost,
       CASE WHEN o_orderstatus = 'F' THEN 'Apple,' || o_custkey ELSE '' END AS ingredients
FROM (SELECT *, unnest(range(n)) AS pos FROM sales)
"""
)
def explode_items(spark: SparkSession, sf: str) -> DataFrame:
    """Each order becomes a sale with as many items as its priority number.

    Pending orders have no item list, an empty one or an unreadable one.
    """
    paid = F.col("o_orderstatus") == "F"
    number = F.substring("o_orderpriority", 1, 1).cast("int")
    listed = F.transform(
        F.sequence(F.lit(0), number - 1),
        lambda i: F.struct(
            F.concat("o_orderpriority", F.lit("/"), i.cast("string")).alias("id"),
            F.lit("L").alias("size"),
            F.when(paid, 'no "ice"').alias("notes"),
            (F.col("o_custkey") + i * 0.25).alias("cost"),
            F.when(paid, F.array(F.lit("Apple"), F.col("o_custkey").cast("string")))
            .otherwise(F.array().cast("array<string>"))
            .alias("ingredients"),
        ),
    )
    pending = F.when(number == 1, "[]").when(number == 2, "not json")
    sales = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("id"),
        F.concat(F.lit("S"), "o_orderstatus").alias("store_id"),
        F.when(F.col("o_orderstatus") == "P", pending).otherwise(F.to_json(listed)).alias("sale_items"),
    )
    exploded = items.explode_items(sales, hashed=False)
    return exploded.withColumn("item_number", F.col("item_number").cast("long")).withColumn(
        "ingredients", F.array_join("product_ingredients", ",")
    ).drop("product_ingredients")


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_path_props(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", fc.json_path("props", "k").alias("k"))


@query(
    """
SELECT event_id, event_type, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
FROM (SELECT *, unnest([1, 2]) AS copy FROM events)
"""
)
def json_schema_of(spark: SparkSession, sf: str) -> DataFrame:
    listed = F.concat(F.lit("["), "props", F.lit(","), "props", F.lit("]"))
    parsed = F.from_json(listed, F.schema_of_json(F.lit("[{'k':42}]")))
    events = table(spark, sf, "events").select("event_id", "event_type", F.explode(parsed).alias("p"))
    return events.select("event_id", "event_type", "p.k")


@query(
    """
SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS secs,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, strftime(ts, '%Y-%m-%d') AS ts_date,
       strftime(ts, '%Y-%m') AS sales_month, CAST(floor(epoch(ts)) AS BIGINT) AS back,
       CAST(NULL AS BIGINT) AS from_junk,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS from_millis
FROM events
"""
)
def epoch_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select(
        "event_id",
        "event_type",
        seconds("ts").alias("secs"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("millis"),
    )
    return events.withColumn("ts_text", fc.epoch_to_text("secs")).select(
        "event_id",
        "secs",
        "ts_text",
        fc.epoch_to_text("secs", "yyyy-MM-dd").alias("ts_date"),
        fc.month_of("ts_text").alias("sales_month"),
        fc.text_to_epoch("ts_text").alias("back"),
        fc.text_to_epoch("event_type").alias("from_junk"),
        F.date_format((F.col("millis") / 1000).cast("timestamp"), "yyyy-MM-dd HH:mm:ss").alias(
            "from_millis"
        ),
    )


@query(
    """
SELECT c_custkey, c_nationkey || '-' || c_custkey AS unique_id,
       (CASE WHEN c_mktsegment <> 'BUILDING' THEN c_nationkey END) || '-' || c_custkey AS maybe_id
FROM customer
"""
)
def composite_key(spark: SparkSession, sf: str) -> DataFrame:
    store = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_nationkey"))
    return table(spark, sf, "customer").select(
        "c_custkey",
        fc.composite_key("c_nationkey", "c_custkey").alias("unique_id"),
        fc.composite_key(store, "c_custkey").alias("maybe_id"),
    )


@query(
    """
SELECT n_name, CASE WHEN n_name IN ('NATION_1', 'NATION_5', 'NATION_9') THEN 'AUS'
                    WHEN n_name IN ('NATION_2', 'NATION_3') THEN 'NZL' END AS country_code
FROM nation
"""
)
def classify_country(spark: SparkSession, sf: str) -> DataFrame:
    groups = {"AUS": ("NATION_1", "NATION_5", "NATION_9"), "NZL": ("NATION_2", "NATION_3")}
    return table(spark, sf, "nation").select(
        "n_name", fc.classify("n_name", groups).alias("country_code")
    )


@query(
    """
SELECT CAST(event_id AS VARCHAR) AS event_id, user_id, event_type AS kind,
       CASE WHEN event_type <> 'view' THEN CAST(floor(epoch(ts)) AS BIGINT) END AS ts,
       CASE event_type
            WHEN 'error' THEN '{"ts":"' || strftime(ts, '%Y-%m-%d %H:%M:%S') || '"}'
            WHEN 'view' THEN '{"ts":"unknown"}'
            WHEN 'signup' THEN '{"extra":"' || replace(props, '"', '\\"') || '"}' END AS rescued
FROM events
"""
)
def hints_and_rescue(spark: SparkSession, sf: str) -> DataFrame:
    """Errors carry their time as text, views an unreadable one, signups one more field."""
    kind = F.col("event_type")
    time = F.when(kind == "error", as_text("ts")).when(kind == "view", "unknown")
    lines = table(spark, sf, "events").select(
        F.to_json(
            F.struct(
                "event_id",
                "user_id",
                kind.alias("kind"),
                F.coalesce(time, seconds("ts").cast("string")).alias("ts"),
                F.when(kind == "signup", F.col("props")).alias("extra"),
            )
        ).alias("value")
    )
    parsed = parse_json_lines(lines, ["event_id", "user_id", "kind", "ts"], "ts long, user_id long")
    repaired = changes.repair_from_rescued(parsed)
    return repaired.withColumnRenamed("_rescued_data", "rescued")


@query(
    """
SELECT c_custkey, 'REDACTED' AS c_name, c_nationkey, c_mktsegment FROM customer
"""
)
def mask_columns(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer").select(
        "c_custkey", "c_name", "c_nationkey", "c_mktsegment"
    )
    return masking.mask_columns(customer, ["c_name"], groups=["analysts"])


@query(
    "SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_mktsegment = 'BUILDING'"
)
def restrict_rows(spark: SparkSession, sf: str) -> DataFrame:
    customer = table(spark, sf, "customer")
    shown = masking.restrict_rows(customer, F.col("c_mktsegment") == "BUILDING", groups=[])
    return shown.select("c_custkey", "c_name", "c_nationkey")


LEFT_PARTS = "SELECT p_brand, p_type, p_size FROM part"
RIGHT_PARTS = (
    "SELECT p_brand, p_type, CAST(p_size + (p_partkey % 7 = 0)::INT AS INT) AS p_size FROM part"
)


def _two_parts(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    part = table(spark, sf, "part")
    columns = ["p_brand", "p_type", "p_size"]
    return (
        part.select(*columns),
        part.withColumn("p_size", F.expr("p_size + int(p_partkey % 7 = 0)")).select(*columns),
    )


@query(
    f"""
SELECT *, 'left' AS side FROM ({LEFT_PARTS} EXCEPT {RIGHT_PARTS})
UNION SELECT *, 'right' AS side FROM ({RIGHT_PARTS} EXCEPT {LEFT_PARTS})
"""
)
def table_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    return changes.table_mismatch(*_two_parts(spark, sf))


@query(f"{LEFT_PARTS} EXCEPT {RIGHT_PARTS}")
def except_distinct(spark: SparkSession, sf: str) -> DataFrame:
    return changes.except_rows(*_two_parts(spark, sf))


@query(f"{LEFT_PARTS} UNION {RIGHT_PARTS}")
def union_distinct(spark: SparkSession, sf: str) -> DataFrame:
    left, right = _two_parts(spark, sf)
    return left.union(right).distinct()


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def ordered_limit(spark: SparkSession, sf: str) -> DataFrame:
    """The report of the ten dearest orders."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(10)
