"""Gold queries over silver sales, sale items and dimensions.

No join here carries a broadcast hint: Spark broadcasts a dimension when its size is
under ``spark.sql.autoBroadcastJoinThreshold`` and sort-merges it otherwise, splitting
skewed partitions. Facts are summed before they are joined wherever that is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import composite_key, month_of
from millrace.operators.dedup import top_n_per_group


def dim_customers(users: DataFrame) -> DataFrame:
    return users.select(
        composite_key("store_id", "id").alias("unique_id"), "id", "store_id", "name", "email"
    )


def country_sales(items: DataFrame, locations: DataFrame) -> DataFrame:
    """Total and number of sales per country."""
    place = locations.select(F.col("id").alias("store_id"), "country_code")
    return (
        items.join(place, "store_id")
        .groupBy("country_code")
        .agg(
            F.sum("product_cost").alias("total_sales"),
            F.count_distinct("sale_id").alias("number_of_sales"),
        )
    )


def _by_sale(rows: DataFrame, parts: int | None) -> DataFrame:
    return rows.repartition("sale_id") if parts is None else rows.repartition(parts, "sale_id")


def country_monthly_sales(
    items: DataFrame, sales: DataFrame, locations: DataFrame, parts: int | None = None
) -> DataFrame:
    """Total and number of sales per country and month.

    Items are laid out by sale once; the sum per sale and country, the join with the sales
    and the distinct count of sales all use that layout. Items shrink to one row per sale
    and country before they meet the sales. Give ``parts``, the number of tasks of that
    layout, in proportion to the items, so that a task's memory stays the same; without it
    Spark fills its partitions up to ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    """
    place = locations.select(F.col("id").alias("store_id"), "country_code")
    placed = items.join(place, "store_id").select("sale_id", "country_code", "product_cost")
    per_sale = (
        _by_sale(placed, parts)
        .groupBy("sale_id", "country_code")
        .agg(F.sum("product_cost").alias("cost"))
    )
    months = sales.select(F.col("id").alias("sale_id"), month_of("ts").alias("sales_month"))
    if parts is not None:
        months = _by_sale(months, parts)
    return (
        per_sale.join(months, "sale_id")
        .groupBy("sale_id", "country_code", "sales_month")
        .agg(F.sum("cost").alias("cost"))
        .groupBy("country_code", "sales_month")
        .agg(
            F.sum("cost").alias("total_sales"),
            F.count("sale_id").alias("number_of_sales"),
        )
    )


def customer_spend(
    items: DataFrame, sales: DataFrame, customers: DataFrame, laid_out: bool = False, parts: int | None = None
) -> DataFrame:
    """Spend per store and known customer.

    Items are laid out by sale once, for the sum per sale and the join with the sales, in
    ``parts`` tasks as in ``country_monthly_sales``; say ``laid_out`` if both are tables in
    buckets of the sale, which are not shuffled at all. Spend is summed to (store, customer)
    before the customer dimension is joined, so a customer with a third of the sales reaches
    that join as a few rows. A customer listed n times under a name counts n times; the
    dimension is counted, so that the spend is not grouped once more.
    """
    placed = items.select("sale_id", "store_id", "product_cost")
    placed = placed if laid_out else _by_sale(placed, parts)
    per_sale = placed.groupBy("sale_id", "store_id").agg(F.sum("product_cost").alias("cost"))
    buyers = sales.where(F.col("unique_customer_id").isNotNull()).select(
        F.col("id").alias("sale_id"), "unique_customer_id"
    )
    if parts is not None and not laid_out:
        buyers = _by_sale(buyers, parts)
    spend = (
        per_sale.join(buyers, "sale_id")
        .groupBy("store_id", "unique_customer_id")
        .agg(F.sum("cost").alias("cost"))
    )
    names = (
        customers.select(F.col("unique_id").alias("unique_customer_id"), "name")
        .groupBy("unique_customer_id", "name")
        .agg(F.count(F.lit(1)).alias("listed"))
    )
    return spend.join(names, "unique_customer_id").select(
        "store_id", "unique_customer_id", "name", (F.col("cost") * F.col("listed")).alias("total_spend")
    )


def top_customers(spend: DataFrame, n: int = 3) -> DataFrame:
    """The n best customers of each store, ties kept, in store and rank order.

    Reads ``spend`` twice (see ``spread_ties``), so give it stored.
    """
    ranked = top_n_per_group(
        spend.select(
            "store_id",
            F.col("name").alias("customer_name"),
            F.col("total_spend").alias("customer_spend"),
        ),
        ["store_id"],
        "customer_spend",
        n,
        "customer_rank",
        spread_ties=True,
    )
    return ranked.orderBy("store_id", "customer_rank")


def stores_per_country(locations: DataFrame) -> DataFrame:
    """Stores counted per country; stores of no known country form a NULL group."""
    return locations.groupBy("country_code").agg(F.count("id").alias("number_of_stores"))


def records_per_file(bronze: DataFrame, file_column: str = "file_path") -> DataFrame:
    return bronze.groupBy(file_column).agg(F.count(F.lit(1)).alias("number_of_records"))
