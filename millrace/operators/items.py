"""Sales cleaning and itemising."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import composite_key, epoch_to_text, with_row_hash
from millrace.operators.dedup import latest_per_key

# Fixed value: the wire type of a sale's items.
ITEMS_TYPE = "array<struct<id:string,size:string,notes:string,cost:double,ingredients:array<string>>>"


def rename_sales(raw: DataFrame) -> DataFrame:
    """Raw sale columns under their business names; works on tables and streams."""
    return raw.select(
        F.col("SaleID").alias("id"),
        epoch_to_text("ts").alias("ts"),
        F.col("Location").alias("store_id"),
        F.col("CustomerID").alias("customer_id"),
        composite_key("Location", "CustomerID").alias("unique_customer_id"),
        F.col("OrderSource").alias("order_source"),
        F.col("STATE").alias("order_state"),
        F.col("SaleItems").alias("sale_items"),
    )


def clean_sales(
    raw: DataFrame, dedup: bool = True, tie_breakers: tuple[str, ...] = ()
) -> DataFrame:
    """Silver sales: the latest export of each sale, renamed, with a row hash.

    A sale without ``exported_ts`` was on the first load and counts as oldest. Pass
    ``dedup=False`` for a stream that keeps every copy.
    """
    if dedup:
        exported = F.coalesce(F.col("exported_ts"), F.lit(0))
        raw = latest_per_key(raw, ["SaleID"], [exported, *tie_breakers])
    return with_row_hash(rename_sales(raw))


def explode_items(sales: DataFrame, hashed: bool = True) -> DataFrame:
    """One row per item of a sale; sales with no, NULL or unreadable items give none."""
    kept = [c for c in ("id", "store_id", "sale_items") if c in sales.columns]
    items = sales.select(*kept).select(
        "id",
        "store_id",
        F.posexplode(F.from_json("sale_items", ITEMS_TYPE)).alias("pos", "item"),
    )
    out = items.select(
        composite_key("id", "pos").alias("id"),
        F.col("id").alias("sale_id"),
        "store_id",
        F.col("pos").alias("item_number"),
        F.col("item.id").alias("product_id"),
        F.col("item.size").alias("product_size"),
        F.col("item.notes").alias("product_notes"),
        F.col("item.cost").alias("product_cost"),
        F.col("item.ingredients").alias("product_ingredients"),
    )
    return with_row_hash(out) if hashed else out
