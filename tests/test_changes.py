from datetime import datetime

import pytest
from fixtures import stores
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions.columns import classify, with_row_hash
from millrace.operators import changes as ch

quick = settings(
    max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
tables = st.dictionaries(st.integers(0, 8), st.sampled_from(["a", "b", None]), max_size=8)


def frame(spark, rows: dict):
    return spark.createDataFrame(list(rows.items()), "k int, v string")


def content(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_update_and_delete_leave_null_conditions_alone(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "b")], "k int, v string")
    assert content(ch.update_rows(df, {"v": F.lit("z")}, "v = 'a'")) == [(1, "z"), (2, None), (3, "b")]
    assert content(ch.update_rows(df, {"v": "'all'"})) == [(1, "all"), (2, "all"), (3, "all")]
    assert content(ch.delete_rows(df, "v = 'a'")) == [(2, None), (3, "b")]
    swapped = ch.update_rows(df, {"k": "k + 10", "v": "cast(k AS string)"}, "k = 1")
    assert content(swapped)[0] == (11, "1")


def test_merge(spark):
    target = spark.createDataFrame(
        [(1, "old", "h1"), (2, "same", "h2"), (3, "left", "h3"), (4, "nohash", None), (None, "nk", "h")],
        "k int, v string, row_hash string",
    )
    source = spark.createDataFrame(
        [(1, "new", "h9"), (2, "ignored", "h2"), (4, "x", "h4"), (5, "ins", "h5"), (None, "nk2", "h"), (None, "nk2", "h")],
        "k int, v string, row_hash string",
    )
    got = content(ch.merge_upsert(target, source, ["k"]).select("k", "v"))
    assert got == sorted(
        [(1, "new"), (2, "same"), (3, "left"), (4, "nohash"), (5, "ins"), (None, "nk"), (None, "nk2"), (None, "nk2")],
        key=repr,
    )
    every = content(ch.merge_upsert(target, source, ["k"], hash_col=None).select("k", "v"))
    assert (2, "ignored") in every and (4, "x") in every


def test_merge_updates_every_copy_in_the_target(spark):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    source = spark.createDataFrame([(1, "z")], "k int, v string")
    merged = ch.merge_upsert(target, source, ["k"], hash_col=None)
    assert content(merged) == [(1, "z"), (1, "z"), (2, "c")]


def test_merge_rejects_a_key_given_twice(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    source = spark.createDataFrame([(2, "a"), (2, "b")], "k int, v string")
    with pytest.raises(Exception, match="more than once"):
        ch.merge_upsert(target, source, ["k"], hash_col=None).count()


def test_small_merge_source_does_not_shuffle_the_target(spark, tmp_path):
    target, source = str(tmp_path / "t"), str(tmp_path / "s")
    spark.range(100).select("id", F.col("id").cast("string").alias("v")).write.parquet(target)
    spark.range(5).select("id", F.lit("x").alias("v")).write.parquet(source)
    merged = ch.merge_upsert(
        spark.read.parquet(target), spark.read.parquet(source), ["id"], hash_col=None
    )
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "LeftOuter, BuildRight" in plan and "SortMergeJoin" not in plan


@quick
@given(tables, tables)
def test_merge_twice_is_merge_once(spark, old, new):
    target, source = (with_row_hash(frame(spark, t)) for t in (old, new))
    once = ch.merge_upsert(target, source, ["k"])
    assert content(once.drop("row_hash")) == sorted({**old, **new}.items(), key=repr)
    assert content(ch.merge_upsert(once, source, ["k"])) == content(once)


@quick
@given(tables, tables)
def test_applying_a_diff_gives_the_new_state(spark, old, new):
    diff = ch.snapshot_diff(frame(spark, old), frame(spark, new), ["k"]).collect()
    state = dict(old)
    for r in diff:
        if r["change_type"] == "delete":
            assert state.pop(r["k"]) == r["v"]
    for r in diff:
        if r["change_type"] == "update_preimage":
            assert old[r["k"]] == r["v"] and new[r["k"]] != r["v"]
        if r["change_type"] in ("insert", "update_postimage"):
            state[r["k"]] = r["v"]
    assert state == new


@quick
@given(tables, tables)
def test_latest_version_is_the_current_state(spark, first, second):
    a, b = frame(spark, first), frame(spark, second)
    log = ch.log_version(None, a, ["k"], 0).unionByName(ch.log_version(a, b, ["k"], 1))
    assert content(ch.as_of(log, ["k"])) == content(b)
    assert content(ch.as_of(log, ["k"], version=0)) == content(a)


def test_diff_treats_null_keys_as_keys_and_never_multiplies(spark):
    old = spark.createDataFrame([(None, "a")] + [(7, "x")] * 50, "k int, v string")
    new = spark.createDataFrame([(None, "b")] + [(7, "x")] * 50, "k int, v string")
    assert content(ch.snapshot_diff(old, new, ["k"])) == [
        (None, "a", "update_preimage"),
        (None, "b", "update_postimage"),
    ]


def test_diff_rejects_a_key_given_twice(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(2, "a"), (2, "b")], "k int, v string")
    with pytest.raises(Exception, match="more than once"):
        ch.snapshot_diff(old, new, ["k"]).collect()
    copies = spark.createDataFrame([(1, "a"), (3, "c"), (3, "c")], "k int, v string")
    with pytest.raises(Exception, match="more than once"):
        ch.snapshot_diff(old, copies, ["k"]).collect()


AUS = ("SYD01", "MEL01", "BNE02", "CBR01", "PER01")
NZL = ("AKL01", "AKL02", "WLG01")


@pytest.fixture(scope="module")
def store_log(spark):
    """The versions of a store table: create, add column, updates and a delete."""
    v0 = stores(spark)
    v1 = v0.withColumn("store_country", F.lit(None).cast("string"))
    v2 = ch.update_rows(v1, {"store_country": classify("id", {"AUS": AUS, "NZL": NZL})})
    v3 = ch.update_rows(v2, {"store_country": F.lit("AUS")}, "id = 'MEL02'")
    v8 = ch.update_rows(v3, {"hq_address": F.lit("Domestic Terminal, AKL")}, "id = 'AKL01'")
    v9 = ch.delete_rows(v8, "id = 'BNE02'")
    steps = [(0, None, v1, "CREATE"), (2, v1, v2, "UPDATE"), (3, v2, v3, "UPDATE"),
             (8, v3, v8, "UPDATE"), (9, v8, v9, "DELETE")]
    log = None
    for version, old, new, operation in steps:
        part = ch.log_version(old, new, ["id"], version, datetime(2022, 1, 1 + version), operation)
        log = part if log is None else log.unionByName(part)
    path = f"{spark.conf.get('spark.checkpoint.dir')}/store_log"
    log.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def test_time_travel(spark, store_log):
    at2 = ch.as_of(store_log, ["id"], version=2).where("id = 'MEL02'").first()
    assert at2["store_country"] is None
    by_time = ch.as_of(store_log, ["id"], timestamp=datetime(2022, 1, 4, 12))
    assert by_time.where("id = 'MEL02'").first()["store_country"] == "AUS"
    assert by_time.count() == 9
    now = ch.as_of(store_log, ["id"])
    assert now.count() == 8 and now.where("id = 'BNE02'").count() == 0


def test_change_feed_of_an_update_and_a_delete(spark, store_log):
    feed = ch.changes_between(store_log, 8, 9).collect()
    assert {(r["id"], r["change_type"], r["version"]) for r in feed} == {
        ("AKL01", "update_preimage", 8),
        ("AKL01", "update_postimage", 8),
        ("BNE02", "delete", 9),
    }
    assert len(feed) == 3
    assert ch.changes_between(store_log, 8).count() == 3
    by_time = ch.changes_between(store_log, datetime(2022, 1, 9), by="commit_timestamp")
    assert by_time.count() == 3


def test_history(spark, store_log):
    lines = ch.history(store_log).orderBy("version").collect()
    assert [(r["version"], r["operation"], r["inserted_rows"], r["updated_rows"], r["deleted_rows"]) for r in lines] == [
        (0, "CREATE", 9, 0, 0),
        (2, "UPDATE", 0, 8, 0),
        (3, "UPDATE", 0, 1, 0),
        (8, "UPDATE", 0, 1, 0),
        (9, "DELETE", 0, 0, 1),
    ]


def test_snapshot_is_a_copy_at_a_version(spark, store_log, tmp_path):
    ch.snapshot_to(store_log, ["id"], str(tmp_path / "clone"), version=3)
    clone = spark.read.parquet(str(tmp_path / "clone"))
    assert clone.count() == 9
    assert clone.where("id = 'AKL01' AND hq_address LIKE 'Domestic%'").count() == 0


def test_mismatch_looks_both_ways(spark):
    u = spark.createDataFrame([(1,), (2,), (2,)], "v int")
    o = spark.createDataFrame([(2,), (3,), (None,)], "v int")
    assert {tuple(r) for r in ch.table_mismatch(u, o).collect()} == {
        (1, "left"), (3, "right"), (None, "right"),
    }
    assert content(ch.except_rows(u, o)) == [(1,)]
    assert ch.table_mismatch(u, u).count() == 0


def test_repair_from_rescued(spark):
    df = spark.createDataFrame(
        [
            (None, '{"ts":"2022-01-01 00:00:00"}'),
            (None, '{"ts":"junk"}'),
            (5, '{"other":"1"}'),
            (None, None),
        ],
        "ts long, _rescued_data string",
    )
    assert [r["ts"] for r in ch.repair_from_rescued(df).collect()] == [1640995200, None, 5, None]


def test_a_hot_key_of_the_merge_target_is_split(spark, tmp_path):
    """Spark cuts a target key with many rows into several tasks of the join."""
    target = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    target.write.parquet(str(tmp_path / "t"))
    source = spark.range(20_000).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    source.write.parquet(str(tmp_path / "s"))
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k, v in zip(keys, ("-1", "-1", "500KB", "500KB", "2")):
            spark.conf.set(k, v)
        merged = ch.merge_upsert(
            spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s")), ["k"], None
        )
        rows = merged.collect()
        plan = merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in plan
    assert sum(r["k"] == 7 and r["v"] == "x" for r in rows) == 66_667 + 1
    assert len(rows) == 200_000 + sum(1 for i in range(20_000) if i % 3 == 0)
