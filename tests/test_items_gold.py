import json
import re
from pathlib import Path

import duckdb
import pytest
from fixtures import ITEMS
from oracle import compare
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from millrace.operators import gold
from millrace.operators.items import clean_sales, explode_items
from millrace.registry import sales as registered

RAW = (
    "SaleID string, ts long, exported_ts long, Location string, CustomerID int, "
    "OrderSource string, STATE string, SaleItems string"
)


def raw(spark, rows):
    return spark.createDataFrame(rows, RAW)


def test_clean_sales_takes_the_latest_export(spark):
    df = raw(
        spark,
        [
            ("s1", 1640995200, None, "SYD01", 1, "web", "PENDING", "[]"),
            ("s1", 1640995200, 50, "SYD01", 1, "web", "CANCELED", "[]"),
            ("s1", 1640995200, 40, "SYD01", 1, "web", "COMPLETED", "[]"),
            ("s2", None, None, "MEL01", None, "web", "COMPLETED", None),
        ],
    )
    rows = {r["id"]: r for r in clean_sales(df).collect()}
    assert rows["s1"]["order_state"] == "CANCELED"
    assert rows["s1"]["ts"] == "2022-01-01 00:00:00"
    assert rows["s1"]["unique_customer_id"] == "SYD01-1"
    assert rows["s2"]["unique_customer_id"] is None and rows["s2"]["row_hash"] is not None
    assert list(rows["s1"].asDict()) == [
        "id", "ts", "store_id", "customer_id", "unique_customer_id", "order_source",
        "order_state", "sale_items", "row_hash",
    ]
    assert clean_sales(df, dedup=False).count() == 4


def test_explode_items(spark):
    sales = spark.createDataFrame(
        [
            ("s1", "SYD01", json.dumps(ITEMS)),
            ("s2", "SYD01", "[]"),
            ("s3", "SYD01", None),
            ("s4", "SYD01", "junk"),
            ("s5", "SYD01", '[{"id":"A","cost":"1.5"}]'),
        ],
        "id string, store_id string, sale_items string",
    )
    rows = {r["id"]: r for r in explode_items(sales).collect()}
    assert set(rows) == {"s1-0", "s1-1", "s5-0"}
    assert rows["s1-1"]["product_id"] == "Custom" and rows["s1-1"]["item_number"] == 1
    assert rows["s1-0"]["product_ingredients"] == ["Apple", "Kale"]
    assert rows["s1-0"]["product_cost"] == 4.5
    assert rows["s5-0"]["product_id"] == "A" and rows["s5-0"]["product_cost"] is None


def small_world(spark):
    items = spark.createDataFrame(
        [("s1", "SYD01", 1.0), ("s1", "SYD01", 2.0), ("s2", "AKL01", 4.0), ("s3", "SYD01", 8.0), ("s9", "XXX01", 1.0)],
        "sale_id string, store_id string, product_cost double",
    )
    sales = spark.createDataFrame(
        [
            ("s1", "2022-01-01 00:00:00", "SYD01-1"),
            ("s2", "2022-02-01 00:00:00", None),
            ("s3", "2022-01-31 23:59:59", "SYD01-1"),
        ],
        "id string, ts string, unique_customer_id string",
    )
    places = spark.createDataFrame([("SYD01", "AUS"), ("AKL01", "NZL")], "id string, country_code string")
    people = spark.createDataFrame([("SYD01-1", "Ann")], "unique_id string, name string")
    return items, sales, places, people


def naive_monthly(items, sales, places):
    return (
        items.join(places.withColumnRenamed("id", "store_id"), "store_id")
        .join(sales.withColumnRenamed("id", "sale_id"), "sale_id")
        .groupBy("country_code", F.date_format("ts", "yyyy-MM").alias("sales_month"))
        .agg(F.sum("product_cost").alias("total_sales"), F.count_distinct("sale_id").alias("number_of_sales"))
    )


def test_gold(spark):
    items, sales, places, people = small_world(spark)
    assert {tuple(r) for r in gold.country_sales(items, places).collect()} == {("AUS", 11.0, 2), ("NZL", 4.0, 1)}
    monthly = gold.country_monthly_sales(items, sales, places)
    assert {tuple(r) for r in monthly.collect()} == {("AUS", "2022-01", 11.0, 2), ("NZL", "2022-02", 4.0, 1)}
    spend = gold.customer_spend(items, sales, people)
    assert {tuple(r) for r in spend.collect()} == {("SYD01", "SYD01-1", "Ann", 11.0)}
    top = gold.top_customers(spend).first()
    assert (top["customer_name"], top["customer_rank"]) == ("Ann", 1)


def test_a_sale_sent_twice_counts_as_in_a_plain_join(spark):
    items, sales, places, people = small_world(spark)
    twice = sales.unionByName(sales.where("id = 's1'").withColumn("ts", F.lit("2022-03-05 00:00:00")))
    twice = twice.unionByName(sales.where("id = 's3'"))
    got = gold.country_monthly_sales(items, twice, places)
    want = naive_monthly(items, twice, places)
    assert {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
    doubled = gold.customer_spend(items, twice, people.unionByName(people))
    assert doubled.first()["total_spend"] == 2 * (3.0 * 2 + 8.0 * 2)


def test_stores_per_country_keeps_the_null_group(spark):
    df = spark.createDataFrame([("a", "AUS"), ("b", None), ("c", "AUS")], "id string, country_code string")
    assert {tuple(r) for r in gold.stores_per_country(df).collect()} == {("AUS", 2), (None, 1)}


@pytest.fixture(scope="module")
def orders_world(spark, tmp_path_factory):
    """Tables of the registered queries: orders and line items of hashed keys, customers listed twice, null keys."""
    root = tmp_path_factory.mktemp("orders_world")
    tables = {
        "nation": spark.range(5).selectExpr("CAST(id AS INT) AS n_nationkey", "concat('nation', id) AS n_name"),
        "supplier": spark.range(40).selectExpr("id AS s_suppkey", "CAST(id % 5 AS INT) AS s_nationkey"),
        "customer": spark.range(90).selectExpr("id % 60 AS c_custkey", "IF(id = 7, NULL, concat('name', id % 45)) AS c_name"),
        "orders": spark.range(2000).selectExpr(
            "IF(id % 97 = 0, NULL, id % 1900) AS o_orderkey",
            "IF(id % 3 = 0, 1, id % 70) AS o_custkey",
            "timestamp_ntz'1995-01-01 00:00:00' + make_dt_interval(CAST(id % 300 AS INT)) AS o_orderdate",
            "IF(id % 5 = 0, '4-NOT SPECIFIED', '5-LOW') AS o_orderpriority",
        ),
        "lineitem": spark.range(9000).selectExpr(
            "IF(id % 89 = 0, NULL, abs(xxhash64(id)) % 2000) AS l_orderkey",
            "IF(id % 83 = 0, NULL, id % 43) AS l_suppkey",
            "CAST(id % 1000 AS DOUBLE) / 4 AS l_extendedprice",
        ),
    }
    con = duckdb.connect()
    for name, rows in tables.items():
        rows.coalesce(1).write.parquet(str(root / f"{name}.parquet"))
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{root}/{name}.parquet/*.parquet'")
    return str(root), con


def check_tasks_by_sale(spark, orders_world, monkeypatch, name, pattern):
    """The query's rows, and its tasks by sale as the line items' files fill them."""
    sf, con = orders_world
    total = sum(p.stat().st_size for p in Path(sf, "lineitem.parquet").glob("*.parquet"))
    monkeypatch.setattr(registered, "TASK_BYTES", total // 20, raising=False)
    want = -(-total // (total // 20))
    assert compare(spark, con, sf, name, queries(), oracle_sql()) is None
    plan = queries()[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    found = re.findall(pattern, plan)
    assert len(found) == 2 and {int(n) for n in found} == {want}


def test_buckets_of_spend_follow_the_items(spark, orders_world, monkeypatch):
    check_tasks_by_sale(spark, orders_world, monkeypatch, "bucketed_spend", r"SelectedBucketsCount: \d+ out of (\d+)")


BY_SALE = r"hashpartitioning\(sale_id#\d+L?, (\d+)\), REPARTITION_BY_NUM"


def test_months_by_country_are_dealt_by_the_items(spark, orders_world, monkeypatch):
    check_tasks_by_sale(spark, orders_world, monkeypatch, "country_monthly_sales", BY_SALE)


def test_spend_is_dealt_by_the_items(spark, orders_world, monkeypatch):
    check_tasks_by_sale(spark, orders_world, monkeypatch, "customer_spend", BY_SALE)


def test_best_customers_are_dealt_by_the_items(spark, orders_world, monkeypatch):
    plans = []
    monkeypatch.setattr(registered, "stored", lambda df, label: plans.append(df) or df)
    sf, con = orders_world
    total = sum(p.stat().st_size for p in Path(sf, "lineitem.parquet").glob("*.parquet"))
    monkeypatch.setattr(registered, "TASK_BYTES", total // 20, raising=False)
    assert compare(spark, con, sf, "top3_customers_per_store", queries(), oracle_sql()) is None
    found = re.findall(BY_SALE, plans[0]._jdf.queryExecution().executedPlan().toString())
    assert len(found) == 2 and int(found[0]) >= 20
