import random

import pytest
from fixtures import CAPTURE, SCD1, SCD2, capture, scd1_set, scd2_set
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.operators.changes import table_mismatch
from millrace.plans.cdc_tables import TableSpec, build_cdc, specs_from_conf
from millrace.streaming.scd import fold_scd1, scd1_stream

KEYS = ["Id"]


def test_decode(spark):
    decoded = cdc.decode_changes(capture(spark))
    assert decoded.count() == 14
    assert not [c for c in decoded.columns if "$" in c]
    ops = {r[0]: r[1] for r in decoded.groupBy("__operation").count().collect()}
    assert ops == {"INSERT": 8, "UPDATE": 4, "DELETE": 2}
    odd = cdc.decode_changes(capture(spark, [(1, 1, 1, 9, 1, "x", "0")]))
    assert odd.first()["__operation"] is None


def test_order_is_typed(spark):
    rows = [(seq, 1, cmd, 4, 1, f"c{cmd}", "0") for seq, cmd in zip(range(12, 0, -1), range(1, 13))]
    decoded = cdc.decode_changes(capture(spark, rows))
    assert cdc.scd1(decoded, KEYS).first()["Plan"] == "c12"
    ordered = cdc.global_sort(capture(spark, rows)).collect()
    assert [r["Plan"] for r in ordered] == [f"c{n}" for n in range(1, 13)]


@pytest.mark.parametrize("seed", [0, 1])
def test_golden(spark, seed):
    rows = CAPTURE[:]
    random.Random(seed).shuffle(rows)
    decoded = cdc.decode_changes(capture(spark, rows))
    first = cdc.scd1(decoded, KEYS)
    assert scd1_set(first) == SCD1 and first.count() == 6
    assert first.columns == ["Id", "Plan", "Score"]
    for limit in (1000, 0):
        second = cdc.scd2(decoded, KEYS, hot_rows=limit)
        assert scd2_set(second) == SCD2 and second.count() == 12


def test_redelivered_changes_change_nothing(spark):
    decoded = cdc.decode_changes(capture(spark, CAPTURE + CAPTURE[5:15]))
    assert scd1_set(cdc.scd1(decoded, KEYS)) == SCD1
    second = cdc.scd2(decoded, KEYS)
    assert scd2_set(second) == SCD2 and second.count() == 12


def test_tombstones_keep_late_changes_out(spark):
    delete = cdc.decode_changes(capture(spark, [(9, 4, 1, 1, 2, "solo", "6.50")]))
    late = cdc.decode_changes(capture(spark, [(8, 2, 5, 4, 2, "solo", "6.50")]))
    state = fold_scd1(fold_scd1(None, delete, KEYS), late, KEYS)
    assert cdc.live_rows(state).count() == 0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.permutations(range(4)))
def test_any_order_of_loads_converges(spark, order):
    parts = [CAPTURE[i * 5 : i * 5 + 5] for i in order]
    state = None
    for part in parts:
        state = fold_scd1(state, cdc.decode_changes(capture(spark, part)), KEYS)
    assert scd1_set(cdc.live_rows(state)) == SCD1


def test_scd2_refresh_rebuilds_only_touched_keys(spark):
    before = cdc.decode_changes(capture(spark, CAPTURE[:13]))
    arrived = cdc.decode_changes(capture(spark, CAPTURE[13:]))
    current = cdc.scd2(before, KEYS)
    refreshed = cdc.scd2_refresh(current, before.unionByName(arrived), arrived, KEYS)
    assert scd2_set(refreshed) == SCD2


def test_range_split(spark, tmp_path):
    path = str(tmp_path / "split")
    cdc.range_split(capture(spark), cdc.ORDER_COLUMNS, 4).write.parquet(path)
    files = (
        spark.read.parquet(path)
        .groupBy(F.col("_metadata.file_name").alias("f"))
        .agg(F.min(F.struct(*cdc.ORDER_COLUMNS)).alias("lo"), F.max(F.struct(*cdc.ORDER_COLUMNS)).alias("hi"))
        .orderBy("f")
        .collect()
    )
    assert len(files) == 4
    assert all(a["hi"] < b["lo"] for a, b in zip(files, files[1:]))


def test_scd1_as_streaming_state(spark, tmp_path):
    staged = str(tmp_path / "staged")
    shuffled = CAPTURE[:]
    random.Random(5).shuffle(shuffled)
    for i in range(4):
        capture(spark, shuffled[i * 5 : i * 5 + 5]).coalesce(1).write.mode("append").parquet(staged)
    stream = (
        spark.readStream.schema(capture(spark).schema).option("maxFilesPerTrigger", 1).parquet(staged)
    )
    state = scd1_stream(cdc.decode_changes(stream), KEYS)
    query = (
        state.writeStream.format("memory").queryName("scd1_state").outputMode("complete")
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert scd1_set(cdc.live_rows(spark.table("scd1_state"))) == SCD1


def test_ordered_and_reversed_tables_agree_when_all_loads_are_in(spark, tmp_path):
    """Two configured tables, fed first to last and last to first."""
    spark.conf.set("demo.cdc.0.name", "ordered")
    spark.conf.set("demo.cdc.0.keys", "Id")
    spark.conf.set("demo.cdc.1.name", "reversed")
    spark.conf.set("demo.cdc.1.keys", " Id ")
    specs = specs_from_conf(spark, "demo.cdc")
    assert specs == [TableSpec("ordered", ("Id",)), TableSpec("reversed", ("Id",))]
    parts = [CAPTURE[i * 5 : i * 5 + 5] for i in range(4)]
    staged = str(tmp_path / "staged")
    tables = build_cdc(spark, specs, staged, str(tmp_path / "out"))
    for load in range(4):
        for name, part in (("ordered", parts[load]), ("reversed", parts[3 - load])):
            capture(spark, part).coalesce(1).write.mode("append").parquet(f"{staged}/{name}")
            tables[name].load(load)
        a, b = tables["ordered"], tables["reversed"]
        odd1, odd2 = table_mismatch(a.scd1, b.scd1).count(), table_mismatch(a.scd2, b.scd2).count()
        assert (odd1 == 0 and odd2 == 0) == (load == 3)
    for t in tables.values():
        assert t.bronze.count() == 18 and t.history.count() == 14 and t.changes.count() == 14
        assert scd1_set(t.scd1) == SCD1 and scd2_set(t.scd2) == SCD2


def test_missing_keys_in_the_config_are_an_error(spark):
    spark.conf.set("bad.cdc.0.name", "t")
    with pytest.raises(ValueError, match="bad.cdc.0.keys"):
        specs_from_conf(spark, "bad.cdc")


def test_tied_changes_are_versions_in_any_arrival_order(spark):
    rows = [(1, 1, 1, 2, 7, "a", "1.00"), (2, 2, 1, 4, 7, "y", "2.00"), (2, 2, 1, 4, 7, "b", "3.00"), (2, 2, 1, 4, 7, "b", "3.00")]
    want = {(7, "a", "1.00", 1, 2), (7, "b", "3.00", 2, 2), (7, "y", "2.00", 2, None)}
    for order in (rows, rows[::-1]):
        decoded = cdc.decode_changes(capture(spark, order).repartition(3))
        second = cdc.scd2(decoded, KEYS)
        assert scd2_set(second) == want and second.count() == 3
        assert scd1_set(cdc.scd1(decoded, KEYS)) == {(7, "y", "2.00")}


def test_a_repeated_load_is_refused_and_loses_nothing(spark, tmp_path):
    staged = str(tmp_path / "staged")
    table = build_cdc(spark, [TableSpec("t", ("Id",))], staged, str(tmp_path / "out"))["t"]
    capture(spark, CAPTURE[:9]).write.parquet(f"{staged}/t")
    assert table.load(1) == 1
    capture(spark, CAPTURE[9:]).withColumn("Late", F.lit("new")).write.mode("append").parquet(f"{staged}/t")
    for again in (1, 0):
        with pytest.raises(ValueError, match="not after"):
            table.load(again)
    assert table.load() == 2
    assert scd1_set(table.scd1) == SCD1 and scd2_set(table.scd2) == SCD2
    assert {r["Id"]: r["Late"] for r in table.scd1.collect()} == {11: "new", 12: "new", 13: "new", 14: "new", 21: None, 31: "new"}
