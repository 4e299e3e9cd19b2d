import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.operators.dedup import first_per_key, latest_per_key, top_n_per_group
from millrace.operators.skew import hot_keys, next_in_key, split_by


def test_latest_and_first(spark):
    df = spark.createDataFrame(
        [("a", None, 1), ("a", 5, 2), ("a", 3, 3), ("b", None, 4), (None, 1, 5), (None, 2, 6)],
        "k string, exported int, v int",
    )
    order = [F.coalesce("exported", F.lit(0))]
    latest = latest_per_key(df, ["k"], order)
    assert latest.columns == df.columns
    assert {(r["k"], r["v"]) for r in latest.collect()} == {("a", 2), ("b", 4), (None, 6)}
    assert {(r["k"], r["v"]) for r in first_per_key(df, ["k"], order).collect()} == {
        ("a", 1),
        ("b", 4),
        (None, 5),
    }


def test_latest_sends_one_row_per_task_and_key(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    plan = latest_per_key(df, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_ties_are_settled_and_maps_are_carried(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 1, "z"), ("a", 1, "y")], "k string, o int, v string")
    assert latest_per_key(df, ["k"], ["o"]).collect() == df.where("v = 'z'").collect()
    assert first_per_key(df, ["k"], ["o"]).collect() == df.where("v = 'x'").collect()
    maps = spark.createDataFrame([("a", 1, {"n": 1}), ("a", 2, {"n": 2})], "k string, o int, m map<string,int>")
    assert latest_per_key(maps, ["k"], ["o"]).first()["m"] == {"n": 2}


def test_top_n_keeps_ties(spark):
    df = spark.createDataFrame(
        [("s", "a", 9), ("s", "b", 8), ("s", "c", 8), ("s", "d", 8), ("s", "e", 1), ("t", "f", 0)],
        "g string, n string, v int",
    )
    top = top_n_per_group(df, ["g"], "v", 3)
    assert {(r["n"], r["rank"]) for r in top.collect()} == {
        ("a", 1), ("b", 2), ("c", 2), ("d", 2), ("f", 1),
    }
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("n", [1, 2, 3, 10])
def test_spread_ties_ranks_alike(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice(["s", "t", None]), rng.choice([None, 1, 2, 3, 4, 5]), i) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, v int, i int")
    plain = top_n_per_group(df, ["g"], "v", n)
    spread = top_n_per_group(df, ["g"], "v", n, spread_ties=True)
    assert spread.schema.names == plain.schema.names
    assert sorted(map(tuple, spread.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def skewed(spark, rows=3000):
    rng = random.Random(3)
    keys = [None if n % 10 == 0 else (1 if n % 3 == 0 else rng.randrange(2, 400)) for n in range(rows)]
    data = list(zip(keys, rng.sample(range(10 * rows), rows)))
    return spark.createDataFrame(data, "k int, o int").repartition(5), data


def expected_next(data):
    out = {}
    by_key = {}
    for k, o in data:
        by_key.setdefault(k, []).append(o)
    for k, orders in by_key.items():
        orders.sort()
        out.update({(k, a): b for a, b in zip(orders, [*orders[1:], None])})
    return out


def test_hot_split_is_a_partition(spark):
    df, data = skewed(spark)
    hot = hot_keys(df, ["k"], len(data) // 30)
    assert {r["k"] for r in hot.collect()} == {1, None}
    cold_rows, hot_rows = split_by(df, ["k"], hot)
    assert cold_rows.count() + hot_rows.count() == len(data)
    assert {r["k"] for r in hot_rows.distinct().collect()} >= {1, None}


def test_hot_keys_are_bounded(spark):
    df, data = skewed(spark)
    assert hot_keys(df, ["k"], len(data) // 4).count() < 4


@pytest.mark.parametrize("parts", [1, 30, 10**9])
def test_next_in_key(spark, parts):
    df, data = skewed(spark)
    got = next_in_key(df, ["k"], "o", "n", len(data) // parts).collect()
    assert {(r["k"], r["o"]): r["n"] for r in got} == expected_next(data)
    assert len(got) == len(data)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from([1, 1, 1, 2, 3]), st.integers(0, 50)), min_size=1, unique=True))
def test_next_in_key_in_pieces_is_exact(spark, data):
    df = spark.createDataFrame(data, "k int, o int")
    got = next_in_key(df, ["k"], "o", "n", 0).collect()
    assert {(r["k"], r["o"]): r["n"] for r in got} == expected_next(data)


def test_without_hot_keys_the_rows_are_read_and_shuffled_once(spark, tmp_path):
    skewed(spark)[0].write.parquet(str(tmp_path / "rows"))
    found = next_in_key(spark.read.parquet(str(tmp_path / "rows")), ["k"], "o", "n")
    plan = found._jdf.queryExecution().sparkPlan().toString() + found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert found._jdf.queryExecution().sparkPlan().toString().count("FileScan") == 1
    assert plan.count("Exchange hashpartitioning") == 1
