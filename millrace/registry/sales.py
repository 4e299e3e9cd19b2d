"""Gold queries. A sale is an order, an item a line item, a store a supplier."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import classify, composite_key
from millrace.operators import gold
from millrace.operators.items import clean_sales, explode_items
from millrace.operators.layout import files_for
from millrace.registry.base import money, query, table
from millrace.session import scratch_path
from millrace.sinks.tables import save_table, stored

# Fixed value: bytes of the line items' files for one task of a layout by sale, some 300,000 rows.
TASK_BYTES = 4_194_304


def _parts(spark: SparkSession, sf: str, least: int | None = None) -> int:
    """Tasks for a layout by sale, in proportion to the line items' files."""
    found = files_for(spark, f"{sf.rstrip('/')}/lineitem.parquet", TASK_BYTES)
    return max(found, spark.sparkContext.defaultParallelism if least is None else least)


def items(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("sale_id"),
        F.col("l_suppkey").alias("store_id"),
        money("l_extendedprice").alias("product_cost"),
    )


def sales(spark: SparkSession, sf: str) -> DataFrame:
    """Orders without a stated priority stand for sales to unknown customers."""
    known = F.col("o_orderpriority") != "4-NOT SPECIFIED"
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("ts"),
        composite_key(F.lit("C"), F.when(known, F.col("o_custkey"))).alias("unique_customer_id"),
    )


def locations(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers with their nation's key as country; a plain scan, so its size is known."""
    return table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("country_code")
    )


def _named(report: DataFrame, spark: SparkSession, sf: str) -> DataFrame:
    """Country keys of a finished report as names, and its total as a double."""
    nation = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("country_code"), F.col("n_name").alias("__name")
    )
    named = report.join(nation, "country_code").withColumn("country_code", F.col("__name"))
    return _double(named.drop("__name"), "total_sales")


def customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select(
        composite_key(F.lit("C"), "c_custkey").alias("unique_id"), F.col("c_name").alias("name")
    )


def _double(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.col(column).cast("double"))


ITEM_PLACES = """
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
"""


@query(
    f"""
SELECT n_name AS country_code, strftime(o_orderdate, '%Y-%m') AS sales_month,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales,
       count(DISTINCT l_orderkey) AS number_of_sales
{ITEM_PLACES} JOIN orders ON l_orderkey = o_orderkey
GROUP BY 1, 2
"""
)
def country_monthly_sales(spark: SparkSession, sf: str) -> DataFrame:
    monthly = gold.country_monthly_sales(items(spark, sf), sales(spark, sf), locations(spark, sf), _parts(spark, sf))
    return _named(monthly, spark, sf)


@query(
    f"""
SELECT n_name AS country_code,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_sales,
       count(DISTINCT l_orderkey) AS number_of_sales
{ITEM_PLACES}
GROUP BY 1
"""
)
def country_sales(spark: SparkSession, sf: str) -> DataFrame:
    return _named(gold.country_sales(items(spark, sf), locations(spark, sf)), spark, sf)


SPEND = """
SELECT l_suppkey AS store_id, 'C-' || c_custkey AS unique_customer_id, c_name AS name,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS total_spend
FROM lineitem JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON 'C-' || (CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END)
               = 'C-' || c_custkey
GROUP BY 1, 2, 3
"""


@query(SPEND)
def customer_spend(spark: SparkSession, sf: str) -> DataFrame:
    spend = gold.customer_spend(items(spark, sf), sales(spark, sf), customers(spark, sf), parts=_parts(spark, sf))
    return _double(spend, "total_spend")


@query(SPEND)
def bucketed_spend(spark: SparkSession, sf: str) -> DataFrame:
    """The same from items and sales saved in buckets of the sale, neither of which is shuffled.

    The buckets follow the bytes of the items, since a bucket is a task.
    """
    root = scratch_path(spark, "bucketed_spend")
    name = f"spend_{root.rsplit('-', 1)[1]}"
    buckets = _parts(spark, sf, 8)
    saved = [
        save_table(df, f"{name}_{kind}", f"{root}/{kind}", bucket_by=([key], buckets))
        for df, kind, key in ((items(spark, sf), "items", "sale_id"), (sales(spark, sf), "sales", "id"))
    ]
    return _double(gold.customer_spend(*saved, customers(spark, sf), laid_out=True), "total_spend")


@query(
    f"""
SELECT store_id, name AS customer_name, total_spend AS customer_spend, customer_rank
FROM (SELECT *, rank() OVER (PARTITION BY store_id ORDER BY total_spend DESC) AS customer_rank
      FROM ({SPEND}))
WHERE customer_rank <= 3
ORDER BY store_id, customer_rank
"""
)
def top3_customers_per_store(spark: SparkSession, sf: str) -> DataFrame:
    spend = gold.customer_spend(items(spark, sf), sales(spark, sf), customers(spark, sf), parts=_parts(spark, sf))
    top = gold.top_customers(stored(_double(spend, "total_spend"), "spend"))
    return top.withColumn("customer_rank", F.col("customer_rank").cast("long"))


@query(
    """
SELECT CASE WHEN s_nationkey IN (0, 1, 2, 3, 4, 5) THEN 'AUS'
            WHEN s_nationkey IN (6, 7, 8) THEN 'NZL' END AS country_code,
       count(s_suppkey) AS number_of_stores
FROM supplier GROUP BY 1
"""
)
def suppliers_per_country(spark: SparkSession, sf: str) -> DataFrame:
    groups = {"AUS": range(6), "NZL": range(6, 9)}
    placed = table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), classify("s_nationkey", groups).alias("country_code")
    )
    return gold.stores_per_country(placed)


@query("SELECT source, count(*) AS number_of_records FROM documents GROUP BY source")
def records_per_source(spark: SparkSession, sf: str) -> DataFrame:
    return gold.records_per_file(table(spark, sf, "documents"), "source")


def raw_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as two exports of raw sales: all as pending, then the closed ones again."""
    closed = F.col("o_orderstatus") != "P"
    number = F.substring("o_orderpriority", 1, 1).cast("int")
    items = F.transform(
        F.sequence(F.lit(1), number),
        lambda i: F.struct(
            F.lit("Green").alias("id"), (F.col("o_custkey") + i * 0.5).alias("cost")
        ),
    )
    first = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("SaleID"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("ts"),
        F.lit(None).cast("long").alias("exported_ts"),
        F.concat(F.lit("S"), F.col("o_custkey") % 5).alias("Location"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_custkey")).alias("CustomerID"),
        F.lit("web").alias("OrderSource"),
        F.lit("PENDING").alias("STATE"),
        F.to_json(items).alias("SaleItems"),
        F.when(closed, F.col("o_orderstatus")).alias("closed"),
    )
    second = first.where("closed IS NOT NULL").withColumns(
        {"exported_ts": F.col("ts") + 1, "STATE": F.concat(F.lit("CLOSED "), "closed")}
    )
    return first.unionByName(second).drop("closed")


SILVER = """
SELECT CAST(o_orderkey AS VARCHAR) AS id, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS ts,
       'S' || (o_custkey % 5) AS store_id,
       CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS customer_id,
       'S' || (o_custkey % 5) || '-' ||
           CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS unique_customer_id,
       'web' AS order_source,
       CASE WHEN o_orderstatus = 'P' THEN 'PENDING' ELSE 'CLOSED ' || o_orderstatus END AS order_state
FROM orders
"""


@query(SILVER)
def silver_sales(spark: SparkSession, sf: str) -> DataFrame:
    """Raw sales exported twice, cleaned to the last export of each."""
    return clean_sales(raw_sales(spark, sf)).drop("sale_items", "row_hash")


@query(
    """
SELECT CASE WHEN o_custkey % 5 IN (0, 1) THEN 'AUS' WHEN o_custkey % 5 = 2 THEN 'NZL' END AS country_code,
       strftime(o_orderdate, '%Y-%m') AS sales_month,
       CAST(sum(CAST(o_custkey + 0.5 * (i + 1) AS DECIMAL(18,2))) AS DOUBLE) AS total_sales,
       count(DISTINCT o_orderkey) AS number_of_sales
FROM (SELECT *, unnest(range(CAST(substr(o_orderpriority, 1, 1) AS INT))) AS i FROM orders)
GROUP BY 1, 2
"""
)
def raw_to_gold(spark: SparkSession, sf: str) -> DataFrame:
    """The whole way: raw exports, silver sales, items from JSON, months by country."""
    silver = clean_sales(raw_sales(spark, sf))
    itemised = explode_items(silver, hashed=False).withColumn("product_cost", money("product_cost"))
    codes = table(spark, sf, "supplier").select(F.concat(F.lit("S"), F.col("s_suppkey") % 5).alias("id"))
    places = codes.distinct().withColumn(
        "country_code", classify("id", {"AUS": ("S0", "S1"), "NZL": ("S2",)})
    )
    return _double(gold.country_monthly_sales(itemised, silver, places), "total_sales")
