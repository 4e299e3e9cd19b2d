"""Tables in buckets, the loads that use them, and the kept schema."""

from pathlib import Path

import pytest
from fixtures import ITEMS, sale, write_lines
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from test_cdc import CAPTURE, KEYS, SCD1, SCD2, capture, scd1_set, scd2_set

from millrace.functions.columns import with_row_hash
from millrace.operators.changes import merge_upsert
from millrace.plans.cdc_tables import TableSpec, build_cdc
from millrace.plans.lakehouse import Lakehouse
from millrace.sinks.buckets import BUCKET, BucketedTable
from millrace.sources.schema_store import SchemaStore, merge_fields, widen


def files(path) -> dict[int, set[str]]:
    """The data files of every bucket."""
    found = {}
    for folder in Path(path).rglob(f"{BUCKET}=*"):
        found[int(folder.name.partition("=")[2])] = {p.name for p in folder.rglob("*.parquet")}
    return found


@pytest.fixture
def accounts(spark, tmp_path):
    rows = spark.range(500).selectExpr("id", "concat('n', id) AS name", "id % 7 AS score")
    table = BucketedTable(spark, str(tmp_path / "accounts"), ("id",), 16)
    assert not table.exists()
    table.replace(with_row_hash(rows))
    assert table.exists()
    return table


def test_a_merge_rewrites_the_buckets_it_hits_and_no_other(spark, accounts):
    before, target = files(accounts.path), spark.createDataFrame(accounts.read().collect(), accounts.read().schema)
    source = with_row_hash(spark.createDataFrame([(7, "changed", 1), (7000, "new", 2), (None, "no key", 3)], "id long, name string, score long"))
    hit = accounts.merge(source)
    after = files(accounts.path)
    assert len(hit) <= 3 and {b for b in before if before[b] != after[b]} == set(hit)
    want = {tuple(r) for r in merge_upsert(target, source, ["id"]).collect()}
    assert {tuple(r) for r in accounts.read().collect()} == want and len(want) == 502
    assert accounts.merge(source.limit(0)) == [] and files(accounts.path) == after


def test_a_merge_with_a_key_twice_changes_nothing(spark, accounts):
    before = files(accounts.path)
    source = with_row_hash(spark.createDataFrame([(7, "a", 1), (7, "b", 2)], "id long, name string, score long"))
    with pytest.raises(Exception, match="more than once"):
        accounts.merge(source)
    assert files(accounts.path) == before


def test_reading_some_buckets_prunes_the_others(accounts):
    plan = accounts.read([3, 5])._jdf.queryExecution().explainString(accounts.spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    assert f"PartitionFilters: [{BUCKET}" in plan
    assert {accounts.hit_by(accounts.read([b]))[0] for b in (3, 5)} == {3, 5} and accounts.read([]).isEmpty()


def test_emptied_buckets_are_removed(accounts):
    rows = accounts.read()
    accounts.replace(rows.where(~F.col("id").isin([r["id"] for r in accounts.read([2]).collect()])), list(range(16)), emptied=True)
    assert 2 not in files(accounts.path) and accounts.read([2]).isEmpty() and not accounts.read([3]).isEmpty()


def test_keys_that_grow_in_type_stay_in_their_bucket(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "t"), ("id",), 8)
    table.replace(spark.range(100).selectExpr("CAST(id AS INT) AS id"))
    wide = StructType.fromDDL("id long")
    hit = table.hit_by(spark.createDataFrame([(5,)], wide))
    assert table.read(hit, wide).where("id = 5").count() == 1


def loaded(spark, tmp_path):
    staged = str(tmp_path / "staged")
    table = build_cdc(spark, [TableSpec("t", tuple(KEYS))], staged, str(tmp_path / "out"))["t"]
    capture(spark, CAPTURE[:12]).coalesce(1).write.parquet(f"{staged}/t")
    table.load()
    return table, f"{staged}/t", tmp_path / "out" / "t"


def test_a_load_writes_the_buckets_of_its_changes_only(spark, tmp_path):
    table, staged, out = loaded(spark, tmp_path)
    before = {name: files(out / name) for name in ("scd1_state", "scd2")}
    rest = [r for r in CAPTURE[12:]]
    last = capture(spark, rest[:1])
    last.write.mode("append").parquet(staged)
    table.load()
    hit = set(BucketedTable(spark, "", tuple(KEYS), table.buckets).hit_by(last))
    for name in before:
        after = files(out / name)
        assert {b for b in after if after[b] != before[name].get(b)} <= hit
    capture(spark, rest[1:]).write.mode("append").parquet(staged)
    table.load()
    assert scd1_set(table.scd1) == SCD1 and scd2_set(table.scd2) == SCD2


def test_a_load_that_died_is_finished_by_the_next_one(spark, tmp_path, monkeypatch):
    table, staged, out = loaded(spark, tmp_path)
    capture(spark, CAPTURE[12:]).write.mode("append").parquet(staged)

    def die(rows, hit):  # after the state lost its buckets and before they came back
        for b in hit:
            for file in (out / "scd1_state" / f"{BUCKET}={b}").glob("*"):
                file.unlink()
        raise RuntimeError("executor lost")

    with monkeypatch.context() as broken:
        broken.setattr(BucketedTable, "replace", lambda self, rows, hit=None: die(rows, hit))
        with pytest.raises(RuntimeError):
            table.load()
    again = build_cdc(spark, [table.spec], str(tmp_path / "staged"), str(tmp_path / "out"))["t"]
    again.load()
    assert scd1_set(again.scd1) == SCD1 and scd2_set(again.scd2) == SCD2


def test_loads_whose_columns_grow(spark, tmp_path):
    table, staged, _ = loaded(spark, tmp_path)
    rows = capture(spark, CAPTURE[12:])
    key = KEYS[0]
    rows.withColumn(key, F.col(key).cast("long")).withColumn("late", F.lit(1)).write.mode("append").parquet(staged)
    table.load()
    rows.limit(1).withColumn(key, F.lit(2**40)).withColumn("late", F.lit(2**41)).write.mode("append").parquet(staged)
    table.load()
    kinds = dict(table.scd1.dtypes)
    assert kinds[key] == kinds["late"] == dict(table.scd2.dtypes)["late"] == "bigint"
    assert {r["late"] for r in table.history.collect()} == {None, 1, 2**41}
    assert scd1_set(table.scd1.where(F.col(key) < 2**31)) == SCD1


def test_refreshing_silver_rewrites_the_buckets_of_its_sales(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    spark.sql("USE bucketed")
    try:
        lake = Lakehouse(spark, str(tmp_path / "lake"))
        write_lines(tmp_path / "landing" / "a.json", [sale(f"s{k}") for k in range(60)])
        lake.ingest_sales(str(tmp_path / "landing"))
        lake.refresh_sales()
        names = ("silver_sales", "silver_sale_items")
        before = {n: files(tmp_path / "lake" / "silver" / n) for n in names}
        write_lines(tmp_path / "landing" / "b.json", [sale("s7", items=[], exported_ts=1741000000), sale("new", items=ITEMS[:1])])
        lake.ingest_sales(str(tmp_path / "landing"))
        lake.refresh_sales()
        for n in names:
            after = files(tmp_path / "lake" / "silver" / n)
            assert 1 <= len({b for b in before[n] | after if before[n].get(b) != after.get(b)}) <= 2
        items = spark.table("silver_sale_items")
        assert spark.table("silver_sales").count() == 61 and BUCKET not in items.columns
        assert items.where("sale_id = 's7'").count() == 0 and items.where("sale_id = 'new'").count() == 1
        assert items.count() == 59 * len(ITEMS) + 1
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE bucketed CASCADE")


def test_a_refresh_reads_new_footers_only(spark, tmp_path):
    store = SchemaStore(spark, str(tmp_path / "d"), str(tmp_path / "kept"))
    with pytest.raises(FileNotFoundError):
        store.refresh()
    spark.range(3).selectExpr("CAST(id AS INT) AS id").coalesce(1).write.parquet(str(tmp_path / "d"))
    assert store.refresh().simpleString() == "struct<id:int>"
    for file in (tmp_path / "d").glob("*.parquet"):
        file.write_bytes(b"no footer")
    spark.range(3).selectExpr("id", "CAST(id AS FLOAT) AS late").coalesce(1).write.mode("append").parquet(str(tmp_path / "d"))
    assert store.refresh().simpleString() == "struct<id:bigint,late:float>"
    assert SchemaStore(spark, store.folder, store.path).known() == store.refresh()


def test_files_that_disagree_among_themselves(spark, tmp_path):
    for k in range(7):
        spark.range(2).selectExpr(("CAST(id AS SHORT)", "id", "CAST(id AS STRING)")[k % 3] + " AS v", f"id AS c{k}").coalesce(1).write.mode("append").parquet(str(tmp_path / "d"))
    store = SchemaStore(spark, str(tmp_path / "d"), str(tmp_path / "kept"))
    assert {f.name: f.dataType.simpleString() for f in store.refresh()} == {"v": "string", **{f"c{k}": "bigint" for k in range(7)}}
    assert sorted(r["v"] for r in store.read().collect()) == ["0"] * 7 + ["1"] * 7


def test_a_write_of_wide_files_beside_narrow_ones_fails_no_job(spark, tmp_path):
    for kind in ("int", "long"):
        spark.range(0, 40, 1, 20).select(F.col("id").cast(kind)).write.mode("append").parquet(str(tmp_path / "d"))
    store, context = SchemaStore(spark, str(tmp_path / "d"), str(tmp_path / "kept")), spark.sparkContext
    context.setJobGroup("beside", "refresh")
    try:
        assert store.refresh().simpleString() == "struct<id:bigint>"
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
    states = [context.statusTracker().getJobInfo(job).status for job in context.statusTracker().getJobIdsForGroup("beside")]
    assert 0 < len(states) < 20 and set(states) == {"SUCCEEDED"}
    assert store.read().count() == 80


def test_many_writes_and_files_of_unknown_writes_that_disagree(spark, tmp_path):
    kinds = ["int"] * 5 + ["long", "int", "string", "long", "int", "int"]
    for k, kind in enumerate(kinds):
        spark.range(2).select(F.col("id").cast(kind).alias("v")).coalesce(1).write.mode("append").parquet(str(tmp_path / "d"))
        for n in range(2):
            spark.range(2).select(F.col("id").cast(kind).alias("v")).coalesce(1).write.parquet(str(tmp_path / f"w{k}{n}"))
            next((tmp_path / f"w{k}{n}").glob("*.parquet")).rename(tmp_path / "d" / f"LOAD{k:02}{n}.parquet")
    store = SchemaStore(spark, str(tmp_path / "d"), str(tmp_path / "kept"))
    assert store.refresh().simpleString() == "struct<v:string>"
    assert sorted(r["v"] for r in store.read().collect()) == ["0"] * 33 + ["1"] * 33


@pytest.mark.parametrize(
    "a,b,want",
    [
        ("tinyint", "int", "int"), ("int", "bigint", "bigint"), ("float", "double", "double"), ("int", "float", "double"),
        ("bigint", "double", "string"), ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"), ("int", "decimal(5,2)", "decimal(12,2)"),
        ("decimal(38,2)", "decimal(38,10)", "string"), ("date", "timestamp_ntz", "timestamp_ntz"), ("boolean", "int", "string"),
        ("struct<x:int>", "struct<X:bigint,y:date>", "struct<x:bigint,y:date>"), ("array<int>", "array<bigint>", "array<bigint>"),
        ("map<string,int>", "map<string,double>", "map<string,double>"), ("array<int>", "int", "string"),
    ],
)
def test_widening(a, b, want):
    a, b, want = (StructType.fromDDL(f"c {t}")["c"].dataType for t in (a, b, want))
    assert widen(a, b).simpleString() == widen(b, a).simpleString().replace("X", "x") == want.simpleString()
    assert merge_fields([StructType([])]) == StructType([])
