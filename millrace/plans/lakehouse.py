"""Sales lakehouse: files to bronze, silver and gold tables."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions.columns import classify
from millrace.operators.changes import merge_upsert, repair_from_rescued
from millrace.operators.gold import (
    country_monthly_sales,
    customer_spend,
    dim_customers,
    top_customers,
)
from millrace.operators.items import clean_sales, explode_items
from millrace.sinks.buckets import BucketedTable
from millrace.sinks.tables import create_stored_view, save_table
from millrace.sources.files import read_csv, read_if_present, read_json
from millrace.sources.streams import stream_json
from millrace.streaming.runs import run_continuous, run_once

# Store codes by country.
STORE_COUNTRIES = {
    "AUS": ("SYD01", "MEL01", "BNE02", "MEL02", "PER01", "CBR01"),
    "NZL": ("AKL01", "AKL02", "WLG01"),
}
# Types of the sale fields that are not text, and the sale's fields.
SALES_HINTS = "ts long, exported_ts long, SaleID string"
SALES_FIELDS = (
    "CustomerID",
    "Location",
    "OrderSource",
    "PaymentMethod",
    "STATE",
    "SaleID",
    "SaleItems",
    "ts",
    "exported_ts",
)


def with_country(stores: DataFrame) -> DataFrame:
    return stores.withColumn("country_code", classify("id", STORE_COUNTRIES))


@dataclass
class Lakehouse:
    """Tables of one lakehouse under ``root``, named in the current database.

    ``max_files`` bounds how many files a micro-batch takes, so that a large backlog is
    worked off in batches that each fit the cluster. Silver sales and items lie in
    ``buckets`` hash buckets of the sale, chosen for good: a refresh reads and rewrites those
    its sales fall into. They are read by name through views.
    """

    spark: SparkSession
    root: str
    max_files: int | None = None
    buckets: int = 16

    def _save(self, df: DataFrame, tier: str, name: str) -> DataFrame:
        return save_table(
            df, name, f"{self.root}/{tier}/{name}", properties={"quality": tier}
        )

    def land_stores(self, csv: str) -> DataFrame:
        bronze = self._save(read_csv(self.spark, csv), "bronze", "bronze_store_locations")
        return self._save(with_country(bronze), "silver", "dim_locations")

    def land_customers(self, csv: str) -> DataFrame:
        bronze = self._save(read_csv(self.spark, csv), "bronze", "bronze_customers")
        return self._save(dim_customers(bronze), "silver", "dim_customers")

    def land_products(self, json: str) -> DataFrame:
        bronze = self._save(read_json(self.spark, json), "bronze", "bronze_products")
        return self._save(bronze, "silver", "dim_products")

    @property
    def bronze_path(self) -> str:
        return f"{self.root}/bronze/bronze_sales"

    def _sales_stream(self, landing: str) -> DataFrame:
        return stream_json(
            self.spark, landing, SALES_HINTS, SALES_FIELDS, max_files=self.max_files
        )

    def ingest_sales(self, landing: str) -> StreamingQuery:
        """Take in the sales files that are new since the last call."""
        checkpoint = f"{self.root}/_checkpoints/bronze_sales"
        return run_once(self._sales_stream(landing), self.bronze_path, checkpoint)

    def follow_sales(self, landing: str, interval: str = "10 seconds") -> StreamingQuery:
        """Take in sales files as they arrive, until the query is stopped."""
        checkpoint = f"{self.root}/_checkpoints/bronze_sales"
        return run_continuous(self._sales_stream(landing), self.bronze_path, checkpoint, interval)

    @property
    def bronze_sales(self) -> DataFrame:
        """All sales that arrived, with drifted times repaired from the rescued data."""
        return repair_from_rescued(self._bronze())

    def _bronze(self) -> DataFrame:
        return self.spark.read.option("mergeSchema", True).parquet(self.bronze_path)

    def _silver(self, name: str, key: str) -> BucketedTable:
        return BucketedTable(self.spark, f"{self.root}/silver/{name}", (key,), self.buckets)

    def _named(self, table: BucketedTable, name: str) -> DataFrame:
        columns = ", ".join(f"`{c}`" for c in table.read().columns)
        return create_stored_view(self.spark, name, f"SELECT {columns} FROM parquet.`{table.path}`", {"quality": "silver"})

    def refresh_sales(self) -> DataFrame:
        """Bring silver sales and their items up to date with bronze.

        Only sales in bronze files that no refresh has seen are derived anew, from all
        their exports, and merged into silver; the items of those sales are replaced. No
        clock is asked: a file counts once, whenever it was written. Files that arrive
        meanwhile are left to the next refresh, as the list of files is taken once. A refresh
        that died is repeated by the next one, as its files are noted last.
        """
        spark = self.spark
        sales, items = self._silver("silver_sales", "id"), self._silver("silver_sale_items", "sale_id")
        raw = self._bronze()
        bronze = repair_from_rescued(raw.withColumn("__file", F.col("_metadata.file_path")))
        done = read_if_present(spark, f"{self.root}/silver/_refreshed_files")
        if done is None:
            arrived = bronze
            sales.replace(self._latest(bronze))
            items.replace(explode_items(sales.read()))
        else:
            arrived = bronze.join(done, "__file", "left_anti")
            touched = arrived.select(F.col("SaleID").alias("__sale")).distinct()
            latest = self._latest(bronze.join(touched, F.col("SaleID").eqNullSafe(F.col("__sale")), "left_semi"))
            # written once: used several times below, and of a size Spark then knows
            fresh = f"{self.root}/silver/_arrived/{uuid.uuid4().hex}"
            latest.write.mode("errorifexists").parquet(fresh)
            latest = spark.read.parquet(fresh)
            hit = sales.hit_by(latest)  # items lie in the buckets of their sales
            if hit:
                new = latest.select(F.col("id").alias("__sale"))
                # sales without an id are one row, as on the first load
                nameless = F.col("id").isNull() & F.col("__sale").isNull()
                silver = sales.read(hit).join(new.where("__sale IS NULL"), nameless, "left_anti")
                kept = items.read(hit).join(new, F.col("sale_id").eqNullSafe(F.col("__sale")), "left_anti")
                # one row per sale by construction, so no check
                merged = merge_upsert(silver, latest, ["id"], check_source=False)
                items.replace(kept.unionByName(explode_items(latest)), hit, emptied=True)
                sales.replace(merged, hit)
        arrived.select("__file").distinct().write.mode("append").parquet(f"{self.root}/silver/_refreshed_files")
        self._named(items, "silver_sale_items")
        return self._named(sales, "silver_sales")

    def _latest(self, bronze: DataFrame) -> DataFrame:
        return clean_sales(bronze.drop("__file"), tie_breakers=("inserted_at", "file_path"))

    def build_gold(self) -> dict[str, DataFrame]:
        table = self.spark.table
        items, sales = table("silver_sale_items"), table("silver_sales")
        monthly = country_monthly_sales(items, sales, table("dim_locations"))
        spend = customer_spend(items, sales, table("dim_customers"))
        gold = {
            "gold_country_sales": self._save(monthly, "gold", "gold_country_sales"),
            "gold_top_customers": self._save(spend, "gold", "gold_top_customers"),
        }
        gold["top3"] = top_customers(gold["gold_top_customers"])
        return gold
