"""Sales pipeline with expectations: streams to silver, recomputed gold, quality events."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession

from millrace.operators.gold import (
    country_monthly_sales,
    country_sales,
    customer_spend,
    dim_customers,
)
from millrace.operators.items import explode_items, rename_sales
from millrace.operators.quality import (
    REPORT,
    Rule,
    expect,
    parse_quality_events,
    quality_events,
    quality_report,
)
from millrace.plans.lakehouse import SALES_FIELDS, SALES_HINTS, with_country
from millrace.sinks.tables import save_table
from millrace.sources.files import query_path
from millrace.sources.streams import stream_json, stream_parquet
from millrace.streaming.runs import observed, observed_failure, run_once

# Names and conditions of the rules.
SALES_RULES = (
    Rule("Location has to be 5 characters long", "length(store_id) = 5", "fail"),
    Rule(
        "Only CANCELED and COMPLETED transactions are allowed",
        "order_state IN ('CANCELED', 'COMPLETED')",
        "drop",
    ),
)
COMMENTS = {
    "products": "Products on sale",
    "country_sales": "Sales and number of sales per country",
    "country_monthly_sales": "Sales and number of sales per country and month",
    "user_profile": "Spend per store and customer",
}
QUALITY = {"products": "silver", "country_sales": "gold", "country_monthly_sales": "gold", "user_profile": "gold"}
ITEM_RULES = (
    Rule(
        "All custom juice must have ingredients",
        "NOT (product_id = 'Custom' AND size(product_ingredients) = 0)",
    ),
)


@dataclass
class CheckedSales:
    """One update takes in new files and renews the tables derived from them.

    Silver sales and items both come from bronze and keep every copy of a sale.
    """

    spark: SparkSession
    landing: str
    data: str
    root: str

    def _append(self, stream: DataFrame, name: str, rules: tuple[Rule, ...] = ()) -> DataFrame:
        path = f"{self.root}/{name}"
        checkpoint = f"{self.root}/_checkpoints/{name}"
        checked = expect(stream, rules, observation=name) if rules else stream
        try:
            query = run_once(checked, path, checkpoint)
        except StreamingQueryException:
            if rules:
                self._report(observed_failure(stream, checkpoint, name, rules), "failed-")
            raise
        if rules:
            self._report(observed(query, name, rules))
        return self.spark.read.option("mergeSchema", True).parquet(path)

    def _report(self, counts: list[tuple], prefix: str = "") -> None:
        events = quality_events(self.spark.createDataFrame(counts, REPORT), prefix + uuid.uuid4().hex)
        events.write.mode("append").parquet(f"{self.root}/_quality_events")

    def _bronze_stream(self, bronze: DataFrame) -> DataFrame:
        return rename_sales(stream_parquet(self.spark, f"{self.root}/bronze_sales", bronze.schema))

    def update(self) -> dict[str, DataFrame]:
        spark = self.spark
        raw = stream_json(spark, self.landing, SALES_HINTS, SALES_FIELDS)
        bronze = self._append(raw, "bronze_sales")
        cleaned = self._bronze_stream(bronze)
        sales = self._append(cleaned, "silver_sales", SALES_RULES)
        itemised = explode_items(cleaned, hashed=False)
        items = self._append(itemised, "silver_sale_items", ITEM_RULES)

        users = dim_customers(query_path(spark, "json", f"{self.data}/users.json"))
        locations = with_country(query_path(spark, "json", f"{self.data}/stores.json"))
        gold = {
            "products": query_path(spark, "json", f"{self.data}/products.json"),
            "country_sales": country_sales(items, locations),
            "country_monthly_sales": country_monthly_sales(items, sales, locations),
            "user_profile": customer_spend(items, sales, users),
        }
        tables = {
            n: save_table(df, n, f"{self.root}/{n}", comment=COMMENTS[n], properties={"quality": QUALITY[n]})
            for n, df in gold.items()
        }
        return {**tables, "bronze_sales": bronze, "silver_sales": sales, "silver_sale_items": items}

    def updates(self) -> DataFrame:
        """Pass and fail counts of every update, as the streams themselves counted them.

        An update that a rule stopped has its counts too, under an id that starts with ``failed-``.
        """
        return parse_quality_events(self.spark.read.parquet(f"{self.root}/_quality_events"))

    def quality(self, event_id: str = "update") -> DataFrame:
        """Pass and fail counts over everything taken in so far, as event lines."""
        sales = rename_sales(self.spark.read.parquet(f"{self.root}/bronze_sales"))
        report = quality_report(sales, SALES_RULES, "silver_sales").unionByName(
            quality_report(explode_items(sales, hashed=False), ITEM_RULES, "silver_sale_items")
        )
        return parse_quality_events(quality_events(report, event_id))
