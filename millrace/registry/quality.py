"""Expectations over orders and line items."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import quality
from millrace.operators.quality import Rule
from millrace.registry.base import query, table
from millrace.session import scratch_path
from millrace.sources.streams import stream_parquet
from millrace.streaming.runs import observed, observed_failure, run_once

ORDER_RULES = (
    Rule("priority is named", "length(o_orderpriority) > 4", "fail"),
    Rule("no pending orders", "o_orderstatus IN ('F', 'O')", "drop"),
    Rule("urgent or cheap", "nullif(o_orderpriority, '5-LOW') = '1-URGENT' OR o_totalprice < 100000"),
)
LINE_RULES = (
    Rule("small discount", "l_discount <= 0.05"),
    Rule("returned lines are finished", "NOT (l_returnflag = 'R' AND l_linestatus = 'O')", "drop"),
)

URGENT = "coalesce(NULLIF(o_orderpriority, '5-LOW') = '1-URGENT' OR o_totalprice < 100000, false)"


@query(
    "SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'O')"
)
def expect_drop(spark: SparkSession, sf: str) -> DataFrame:
    kept = quality.expect(table(spark, sf, "orders"), ORDER_RULES)
    return kept.select("o_orderkey", "o_orderstatus", "o_totalprice")


def _line(dataset: str, name: str, action: str, condition: str, source: str) -> str:
    dropped = f"count(*) FILTER (NOT ({condition}))" if action == "drop" else "0"
    return f"""
SELECT '{dataset}' AS dataset, '{name}' AS name, '{action}' AS on_violation,
       count(*) FILTER ({condition}) AS passed_records,
       count(*) FILTER (NOT ({condition})) AS failed_records, {dropped} AS dropped_records
FROM {source}"""


REPORT = " UNION ALL ".join(
    [
        _line("orders", "priority is named", "fail", "length(o_orderpriority) > 4", "orders"),
        _line("orders", "no pending orders", "drop", "o_orderstatus IN ('F', 'O')", "orders"),
        _line("orders", "urgent or cheap", "keep", URGENT, "orders"),
        _line("lineitem", "small discount", "keep", "l_discount <= 0.05", "lineitem"),
        _line(
            "lineitem",
            "returned lines are finished",
            "drop",
            "NOT (l_returnflag = 'R' AND l_linestatus = 'O')",
            "lineitem",
        ),
    ]
)


def _report(spark: SparkSession, sf: str) -> DataFrame:
    orders = quality.quality_report(table(spark, sf, "orders"), ORDER_RULES, "orders")
    lines = quality.quality_report(table(spark, sf, "lineitem"), LINE_RULES, "lineitem")
    return orders.unionByName(lines)


@query(REPORT)
def expect_report(spark: SparkSession, sf: str) -> DataFrame:
    return _report(spark, sf)


@query(
    f"""
SELECT 'run-' || dataset AS id, dataset, name, failed_records, passed_records FROM ({REPORT})
"""
)
def quality_events(spark: SparkSession, sf: str) -> DataFrame:
    return quality.parse_quality_events(quality.quality_events(_report(spark, sf), "run"))


@query(
    f"""
SELECT o_orderkey,
       concat_ws(',', CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN 'no pending orders' END,
                 CASE WHEN NOT {URGENT} THEN 'urgent or cheap' END) AS broken
FROM orders WHERE o_orderstatus NOT IN ('F', 'O') OR NOT {URGENT}
"""
)
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    bad = quality.quarantine(table(spark, sf, "orders"), ORDER_RULES)
    return bad.select("o_orderkey", F.array_join("broken_rules", ",").alias("broken"))


@query(
    """
SELECT event_id, user_id, user_id || '-' || event_type AS user_action,
       strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text,
       (SELECT count(*) FROM events WHERE event_type <> 'error') AS passed,
       (SELECT count(*) FROM events WHERE event_type = 'error') AS failed
FROM events WHERE event_type <> 'error'
"""
)
def stream_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Events as a stream, cleaned and checked on the way to a table."""
    from millrace.functions.columns import composite_key
    from millrace.registry.base import as_text

    schema = table(spark, sf, "events").schema
    events = stream_parquet(spark, f"{sf.rstrip('/')}/events*.parquet", schema)
    rules = [
        Rule("known user", "user_id IS NOT NULL", "fail"),
        Rule("no errors", "event_type <> 'error'", "drop"),
    ]
    checked = quality.expect(events, rules, observation="events_checked")
    cleaned = checked.select(
        "event_id",
        "user_id",
        composite_key("user_id", "event_type").alias("user_action"),
        as_text("ts").alias("ts_text"),
    )
    root = scratch_path(spark, "stream_clean")
    done = run_once(cleaned, f"{root}/events", f"{root}/_checkpoint")
    counts = {name: (passed, failed) for _, name, _, passed, failed, _ in observed(done, "events_checked", rules)}
    clean = spark.read.parquet(f"{root}/events")
    return clean.withColumns({"passed": F.lit(counts["no errors"][0]).cast("long"), "failed": F.lit(counts["no errors"][1]).cast("long")})


@query(
    _line("events", "errors stop the run", "fail", "event_type <> 'error'", "events WHERE day(ts) > 15")
    + " UNION ALL "
    + _line("events", "no early users", "drop", "user_id > 100", "events WHERE day(ts) > 15")
)
def failed_update_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The counts of a run that a rule stops, after one that went well; only its own rows are counted."""
    root = scratch_path(spark, "failed_update_counts")
    events = table(spark, sf, "events")
    late = F.dayofmonth("ts") > 15
    rules = [Rule("errors stop the run", "event_type <> 'error'", "fail"), Rule("no early users", "user_id > 100", "drop")]

    def land(rows: DataFrame) -> DataFrame:
        rows.write.mode("append").parquet(f"{root}/landing")
        return stream_parquet(spark, f"{root}/landing", events.schema)

    first = land(events.where(~late & F.expr("event_type <> 'error'")))
    run_once(quality.expect(first, rules, observation="events"), f"{root}/out", f"{root}/_checkpoint")
    second = land(events.where(late))
    try:
        run_once(quality.expect(second, rules, observation="events"), f"{root}/out", f"{root}/_checkpoint")
    except StreamingQueryException:
        lines = observed_failure(second, f"{root}/_checkpoint", "events", rules)
        return spark.createDataFrame(lines, quality.REPORT)
    raise AssertionError("the rule did not stop the run")
