import pytest
from fixtures import ITEMS, sale
from pyspark.sql import Observation
from pyspark.sql import functions as F

from millrace.operators import quality as q
from millrace.operators.items import ITEMS_TYPE, explode_items
from millrace.plans.checked_sales import ITEM_RULES, SALES_RULES

RULES = [q.Rule("positive", "v > 0"), q.Rule("small", "v < 10", "drop")]


def numbers(spark):
    return spark.createDataFrame([(1,), (-1,), (None,), (20,)], "v int")


def test_keep_counts_and_drop_removes(spark):
    seen = Observation("seen")
    kept = q.expect(numbers(spark), RULES, seen)
    assert sorted(r["v"] for r in kept.collect()) == [-1, 1]
    assert seen.get == {"rows": 4, "passed_0": 2, "failed_0": 2, "passed_1": 2, "failed_1": 2}


def test_fail_raises_and_names_the_rule(spark, tmp_path):
    rules = [q.Rule("never null", "v IS NOT NULL", "fail")]
    with pytest.raises(Exception, match="never null"):
        q.expect(numbers(spark), rules).write.parquet(str(tmp_path / "out"))
    assert not (tmp_path / "out" / "_SUCCESS").exists()
    fine = q.expect(numbers(spark).na.drop(), rules)
    assert fine.count() == 3


def test_null_fails_a_rule(spark):
    rules = [q.Rule("null is a violation", "v > 0", "fail")]
    with pytest.raises(Exception, match="violation"):
        q.expect(spark.createDataFrame([(None,)], "v int"), rules).collect()


def test_unknown_action():
    with pytest.raises(ValueError):
        q.Rule("x", "true", "explode")


def test_report_adds_up(spark):
    report = q.quality_report(numbers(spark), RULES, "numbers").collect()
    assert [(r["name"], r["passed_records"], r["failed_records"], r["dropped_records"]) for r in report] == [
        ("positive", 2, 2, 0),
        ("small", 2, 2, 2),
    ]
    empty = q.quality_report(numbers(spark).limit(0), RULES, "numbers").collect()
    assert [(r["passed_records"], r["failed_records"]) for r in empty] == [(0, 0), (0, 0)]


def test_quarantine(spark):
    bad = {r["v"]: r["broken_rules"] for r in q.quarantine(numbers(spark), RULES).collect()}
    assert bad == {-1: ["positive"], None: ["positive", "small"], 20: ["small"]}


def test_events_round_trip_and_skip_events_without_progress(spark):
    report = q.quality_report(numbers(spark), RULES, "numbers")
    events = q.quality_events(report, "u1")
    other = spark.sql("SELECT 'u2' AS id, current_timestamp() AS timestamp, '{\"user_action\":{}}' AS details")
    got = q.parse_quality_events(events.unionByName(other)).collect()
    assert {(r["id"], r["dataset"], r["name"], r["failed_records"], r["passed_records"]) for r in got} == {
        ("u1-numbers", "numbers", "positive", 2, 2),
        ("u1-numbers", "numbers", "small", 2, 2),
    }
    dropped = events.select(F.get_json_object("details", "$.flow_progress.data_quality.dropped_records"))
    assert dropped.first()[0] == "2"


def test_custom_item_needs_ingredients(spark):
    custom = [
        {"id": "Custom", "ingredients": []},
        {"id": "Custom"},
        {"id": "Custom", "ingredients": ["Kale"]},
        {"id": "Green", "ingredients": []},
    ]
    import json

    df = spark.createDataFrame([("1", "SYD01", json.dumps(custom))], "id string, store_id string, sale_items string")
    report = q.quality_report(explode_items(df), ITEM_RULES, "items").first()
    assert (report["passed_records"], report["failed_records"]) == (2, 2)


def test_location_length_rule(spark):
    df = spark.createDataFrame([("SYD001", "COMPLETED")], "store_id string, order_state string")
    with pytest.raises(Exception, match="5 characters"):
        q.expect(df, SALES_RULES).collect()
