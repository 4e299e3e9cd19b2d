from types import SimpleNamespace

import duckdb
import pytest
from fixtures import stores, write_lines
from oracle import compare
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from millrace import scratch_path
from millrace.operators import layout
from millrace.sinks import tables as t
from millrace.sources import files, rescue, streams
from millrace.streaming.runs import run_continuous, run_once


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_csv_with_quoted_commas(spark, tmp_path):
    stores(spark).write.option("header", True).csv(str(tmp_path / "csv"))
    back = files.read_csv(spark, str(tmp_path / "csv"))
    assert back.count() == 9
    assert back.where("id = 'SYD01'").first()["hq_address"] == "0 High St, Town, SYD01"
    assert dict(back.dtypes)["name"] == "string"


def test_json_and_path_query(spark, tmp_path):
    rows = [{"id": "A", "name": "A", "ingredients": ["x", "x"]}, {"id": "B", "name": "B", "ingredients": []}]
    write_lines(tmp_path / "p.json", rows)
    df = files.read_json(spark, str(tmp_path / "p.json"))
    assert dict(df.dtypes)["ingredients"] == "array<string>"
    assert same(df, files.query_path(spark, "json", str(tmp_path / "p.json")))


def column_ranges(df: DataFrame, column: str) -> DataFrame:
    """Least and greatest value of a column in every file: what min/max skipping sees."""
    return (
        df.select(F.col("_metadata.file_path").alias("file_path"), F.col(column).alias("v"))
        .groupBy("file_path")
        .agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("rows"))
    )


def files_to_read(df: DataFrame, column: str, value) -> int:
    """Files a point lookup cannot skip by min/max."""
    ranges = column_ranges(df, column)
    return ranges.where((F.col("low") <= F.lit(value)) & (F.col("high") >= F.lit(value))).count()


def test_inventory_and_samples(spark, tmp_path):
    spark.range(10).repartition(3).write.parquet(str(tmp_path / "d"))
    listed = files.file_inventory(spark, str(tmp_path / "d"))
    assert listed.columns == ["path", "name", "size", "modificationTime"]
    found = {r["name"]: r["size"] for r in listed.collect()}
    on_disk = {p.name: p.stat().st_size for p in (tmp_path / "d").glob("*.parquet")}
    assert found == on_disk
    spark.range(3).withColumn("late", F.lit(1)).write.mode("append").parquet(str(tmp_path / "d"))
    assert files.staged_schema(spark, str(tmp_path / "d")).names == ["id", "late"]
    (tmp_path / "nothing").mkdir()
    with pytest.raises(FileNotFoundError):
        files.staged_schema(spark, str(tmp_path / "nothing"))


def test_provenance(spark, tmp_path):
    t.write_parquet(spark.range(4).coalesce(1), str(tmp_path / "d"))
    df = files.with_provenance(files.read_parquet(spark, str(tmp_path / "d")))
    assert df.columns == ["id", "file_path", "inserted_at"]
    assert df.select("file_path").distinct().count() == 1
    assert df.where("inserted_at IS NULL").count() == 0


def test_parse_json_lines(spark):
    lines = [
        '{"ts":1,"a":"x","n":{"q":[1,2]}}',
        '{"ts":"2022-01-01 00:00:00","a":null}',
        '{"ts":"7"}',
        "junk",
        "[1]",
        None,
    ]
    df = spark.createDataFrame([(v,) for v in lines], "value string")
    got = [tuple(r) for r in rescue.parse_json_lines(df, ["ts", "a"], "ts long").collect()]
    assert got == [
        (1, "x", '{"n":"{\\"q\\":[1,2]}"}'),
        (None, None, '{"ts":"2022-01-01 00:00:00"}'),
        (7, None, None),
        (None, None, "junk"),
        (None, None, "[1]"),
        (None, None, None),
    ]
    kept = rescue.parse_json_lines(df, ["n"], None).first()
    assert kept["n"] == '{"q":[1,2]}'


def test_incremental_json_reads_new_nested_files_only(spark, tmp_path):
    landing, bronze, ckpt = tmp_path / "in", str(tmp_path / "bronze"), str(tmp_path / "ckpt")
    for n in range(4):
        write_lines(landing / f"load_{n}.json", [{"SaleID": f"s{n}", "ts": n}])

    def ingest():
        stream = streams.stream_json(spark, str(landing), "ts long, exported_ts long")
        return run_once(stream, bronze, ckpt)

    ingest()
    first = spark.read.parquet(bronze)
    assert first.count() == 4
    assert set(first.columns) == {"SaleID", "ts", "exported_ts", "_rescued_data", "file_path", "inserted_at"}
    write_lines(landing / "SYD01" / "2022-01-01" / "daily.json", [{"SaleID": "s9", "ts": "late", "x": 1}])
    query = ingest()
    assert sum(p["numInputRows"] for p in query.recentProgress) == 1
    rows = {r["SaleID"]: r for r in spark.read.option("mergeSchema", True).parquet(bronze).collect()}
    assert len(rows) == 5 and rows["s9"]["ts"] is None
    assert rows["s9"]["_rescued_data"] == '{"ts":"late"}'
    assert rows["s9"]["x"] == "1" and rows["s0"]["x"] is None
    assert rows["s9"]["file_path"].endswith("SYD01/2022-01-01/daily.json")
    ingest()
    assert spark.read.parquet(bronze).count() == 5


def test_continuous_run_and_table(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "in"))
    stream = streams.stream_parquet(spark, str(tmp_path / "in"), "id long", max_files=1)
    query = run_continuous(
        stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), "100 milliseconds", table="followed"
    )
    try:
        assert query.isActive
        query.processAllAvailable()
        assert spark.read.parquet(str(tmp_path / "out")).count() == 5
        spark.range(5, 7).write.mode("append").parquet(str(tmp_path / "in"))
        query.processAllAvailable()
    finally:
        query.stop()
    assert not query.isActive
    assert spark.read.parquet(str(tmp_path / "out")).count() == 7
    assert spark.table("followed").columns == ["id"]


def test_save_table_replaces_from_itself(spark, tmp_path):
    root = str(tmp_path / "tab")
    t.save_table(spark.range(3), "replaced", root, comment="it's three", properties={"quality": "gold"})
    t.save_table(spark.table("replaced").where("id > 0"), "replaced", root)
    assert [r["id"] for r in spark.table("replaced").orderBy("id").collect()] == [1, 2]
    wider = t.save_table(spark.table("replaced").withColumn("x", F.lit("a")), "replaced", root)
    assert wider.columns == ["id", "x"]
    described = {r["col_name"]: r["data_type"] for r in t.describe_table(spark, "replaced").collect()}
    assert str(tmp_path) in described["Location"]


def test_table_properties_and_partitions(spark, tmp_path):
    df = spark.range(10).select("id", (F.col("id") % 2).alias("p"))
    saved = t.save_table(
        df, "parted", str(tmp_path / "p"), partition_by=["p"], comment="halves", properties={"quality": "silver"}
    )
    assert saved.where("p = 1").count() == 5
    described = {r["col_name"]: r["data_type"] for r in t.describe_table(spark, "parted").collect()}
    assert described["Comment"] == "halves" and "quality=silver" in described["Table Properties"]


def test_ddl(spark, tmp_path):
    stores(spark).createOrReplaceTempView("some_stores")
    made = t.create_table_as(spark, "made", "SELECT id, name FROM some_stores")
    assert made.count() == 9
    assert t.create_table_as(spark, "made", "SELECT id, name FROM some_stores").count() == 9
    added = t.add_column(spark, "made", "store_country", "string")
    assert added.where("store_country IS NULL").count() == 9
    view = t.create_stored_view(spark, "v_made", "SELECT id FROM made")
    assert view.columns == ["id"]
    assert t.create_view(added.limit(1), "v_one").count() == 1
    spark.range(4).write.parquet(str(tmp_path / "loc"))
    assert t.register_table(spark, "registered", str(tmp_path / "loc")).count() == 4
    assert t.register_table(spark, "registered", str(tmp_path / "elsewhere")).count() == 4
    t.use_database(spark, "aside")
    assert spark.catalog.currentDatabase() == "aside"
    t.use_database(spark, "default")
    t.drop_database(spark, "aside")
    assert not spark.catalog.databaseExists("aside")


def test_sorted_save_and_json_file(spark, tmp_path):
    saved = t.save_table(spark.range(100).withColumn("d", -F.col("id")), "sorted_t", str(tmp_path / "s"), ["d"])
    bounds = column_ranges(saved, "d").orderBy("low").collect()
    assert all(a["high"] < b["low"] for a, b in zip(bounds, bounds[1:]))
    t.write_json(spark.range(10).repartition(4), str(tmp_path / "one.json"), files=1)
    assert len(list((tmp_path / "one.json").glob("part-*"))) == 1


def test_append_evolving(spark, tmp_path):
    path = str(tmp_path / "e")
    t.append_evolving(spark.range(2), path)
    both = t.append_evolving(spark.range(2, 4).withColumn("x", F.lit("new")), path)
    assert {(r["id"], r["x"]) for r in both.collect()} == {(0, None), (1, None), (2, "new"), (3, "new")}


def points(spark, n=20_000):
    return spark.range(n).select(
        F.sha2(F.col("id").cast("string"), 256).alias("sale_id"),
        (F.col("id") * 7919 % 1000).alias("a"),
        (F.col("id") * 104729 % 997).alias("b"),
    )


def test_clustering_lets_a_lookup_skip_files(spark, tmp_path):
    df = points(spark)
    df.repartition(8).write.parquet(str(tmp_path / "plain"))
    plain = spark.read.parquet(str(tmp_path / "plain"))
    key = df.first()["sale_id"]
    assert files_to_read(plain, "sale_id", key) == 8
    layout.optimize(spark, str(tmp_path / "plain"), str(tmp_path / "sorted"), ["sale_id"], 300_000)
    clustered = spark.read.parquet(str(tmp_path / "sorted"))
    assert files_to_read(clustered, "sale_id", key) == 1
    assert layout.files_holding(clustered, F.col("sale_id") == key).collect()[0]["rows"] == 1
    assert same(plain, clustered)


def test_zorder_serves_both_columns(spark, tmp_path):
    df = points(spark).withColumn("b", F.when(F.col("b") > 0, F.col("b")))
    layout.zorder(df, ["a", "b"], 16).write.parquet(str(tmp_path / "z"))
    z = spark.read.parquet(str(tmp_path / "z"))
    assert same(df, z)
    assert files_to_read(z, "a", 500) <= 8
    assert files_to_read(z, "b", 500) <= 8


def test_z_value_of_any_type(spark):
    df = spark.range(500).select(
        F.concat(F.lit("it's \\ "), F.lpad(F.col("id").cast("string"), 3, "0")).alias("s"),
        F.timestamp_seconds(F.col("id") * 3600).alias("t"),
        (F.col("id") / 7).cast("decimal(9,3)").alias("d"),
    )
    for column in df.columns:
        z = df.select(column, layout.z_value(df, [column]).alias("z")).orderBy(column).collect()
        ranges = [r["z"] for r in z]
        assert ranges == sorted(ranges) and ranges[0] == 0 and ranges[-1] == 63
    both = df.select(layout.z_value(df, ["s", "t"]).alias("z")).distinct().count()
    assert 64 <= both < 128  # the cut points of texts and times differ by a row


def test_zorder_splits_a_value_held_by_most_rows(spark):
    df = points(spark).withColumns({"a": F.when(F.col("a") > 300, 1).otherwise(F.col("a")), "b": F.lit(1)})
    sizes = layout.zorder(df, ["a", "b"], 8).groupBy(F.spark_partition_id().alias("p")).count()
    assert sizes.agg(F.max("count")).first()[0] < 2 * 20_000 / 8


def test_compact(spark, tmp_path):
    df = points(spark)
    df.repartition(40).write.parquet(str(tmp_path / "small"))
    layout.optimize(spark, str(tmp_path / "small"), str(tmp_path / "large"))
    assert len(list((tmp_path / "large").glob("*.parquet"))) == 1
    assert same(df, spark.read.parquet(str(tmp_path / "large")))
    layout.compact(spark, str(tmp_path / "small"), str(tmp_path / "mid"), 400_000)
    assert 2 <= len(list((tmp_path / "mid").glob("*.parquet"))) < 10


def test_scratch_is_in_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(shared) and a != b


def test_filter_and_columns_reach_the_scan(spark, tmp_path):
    points(spark).write.parquet(str(tmp_path / "p"))
    df = files.read_parquet(spark, str(tmp_path / "p")).where("a = 5").select("b")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(a,5)" in plan and "sale_id" not in plan


def test_layout_jobs_keep_columns_and_partitioning(spark, tmp_path):
    path = str(tmp_path / "evolved")
    for n in range(3):
        part = spark.range(100 * n, 100 * n + 100).withColumn("d", (F.col("id") % 3).cast("int"))
        part = part if n < 2 else part.withColumn("late", F.col("id") * 2)
        part.write.mode("append").partitionBy("d").parquet(path)
    want = spark.read.option("mergeSchema", True).parquet(path)
    assert layout.partition_columns(spark, path) == ["d"]
    for name, by in (("plain", []), ("one", ["id"]), ("two", ["id", "late"])):
        layout.optimize(spark, path, str(tmp_path / name), by)
        got = spark.read.parquet(str(tmp_path / name))
        assert set(got.columns) == {"id", "late", "d"} and same(want, got.select(*want.columns))
        assert sorted(p.name for p in (tmp_path / name).iterdir() if p.is_dir()) == ["d=0", "d=1", "d=2"]


@pytest.mark.parametrize(
    ("settings", "place"),
    [
        ({"spark.checkpoint.dir": "/shared/c", "spark.master": "yarn"}, "/shared/c/millrace/x-"),
        ({"spark.sql.warehouse.dir": "file:/w", "spark.master": "local[4]"}, "file:/w/_scratch/millrace/x-"),
        ({"spark.sql.warehouse.dir": "hdfs://n/w", "spark.master": "yarn"}, "hdfs://n/w/_scratch/millrace/x-"),
        ({"spark.sql.warehouse.dir": "file:/w", "spark.master": "spark://n:7077"}, None),
        ({"spark.sql.warehouse.dir": "/w", "spark.master": "local-cluster[2,1,1024]"}, None),
    ],
)
def test_scratch_is_where_all_executors_see_it(settings, place):
    session = SimpleNamespace(conf=settings)
    if place is None:
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            scratch_path(session, "x")
    else:
        assert scratch_path(session, "x").startswith(place)


@pytest.mark.parametrize("name", ["widened_column", "widened_stream"])
def test_keys_and_values_beyond_the_narrow_types_land_as_well(spark, tmp_path, name):
    rows = [
        (n, f"2024-01-{day:02d} 10:00:00", user, f"kind{n}", value)
        for n, (day, user, value) in enumerate(
            (day, user, value)
            for day in (5, 15, 25)
            for user, value in ((7, 1.5), (32768, -2.25), (-32769, 3.0), (2**31, 4.75), (8, 2.0**31), (9, 2.0**62), (None, 5.5), (10, None))
        )
    ]
    events = spark.createDataFrame([*rows, (2**40, "2024-01-06 10:00:00", 11, "last", 6.5)], "event_id long, ts string, user_id long, event_type string, value double")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert compare(spark, con, str(tmp_path), name, queries(), oracle_sql()) is None
