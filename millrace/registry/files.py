"""Files in and out: formats, incremental ingest, evolving schemas, layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import layout
from millrace.registry.base import as_text, query, seconds, table
from millrace.session import scratch_path
from millrace.sinks import tables
from millrace.sinks.tables import append_evolving, create_table_as, save_table, write_json
from millrace.sources import files
from millrace.sources.schema_store import SchemaStore
from millrace.sources.streams import stream_json, stream_parquet
from millrace.streaming.runs import run_continuous, run_once


@query(
    """
SELECT event_id, user_id, event_type, CAST(floor(epoch(ts)) AS BIGINT) AS ts, value
FROM events
"""
)
def incremental_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Events land as JSON in two drops, two folders deep; each run takes the new drop."""
    root = scratch_path(spark, "incremental_ingest")
    events = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", seconds("ts").alias("ts"), "value", F.dayofmonth("ts").alias("day")
    )
    for name, condition in (("first", "day <= 20"), ("second", "day > 20")):
        drop = events.where(condition).drop("day")
        write_json(drop, f"{root}/landing/{name}/daily.json")
        stream = stream_json(
            spark,
            f"{root}/landing",
            "event_id long, user_id long, ts long, value double",
            ["event_id", "user_id", "event_type", "ts", "value"],
        )
        run_once(stream, f"{root}/bronze", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/bronze").select("event_id", "user_id", "event_type", "ts", "value")


PART = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"


@query(f"SELECT *, 'csv' AS format FROM ({PART}) UNION ALL SELECT *, 'json' FROM ({PART}) "
       f"UNION ALL SELECT *, 'path' FROM ({PART})")
def csv_json_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "csv_json_roundtrip")
    part = table(spark, sf, "part").select(
        "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"
    )
    part.write.options(header=True, quote='"').csv(f"{root}/csv")
    write_json(part, f"{root}/json")
    schema = part.schema
    back = {
        "csv": files.read_csv(spark, f"{root}/csv", schema),
        "json": files.read_json(spark, f"{root}/json", schema),
        "path": files.query_path(spark, "json", f"{root}/json").select(
            *[F.col(f.name).cast(f.dataType) for f in schema.fields]
        ),
    }
    csv, json, path = (df.withColumn("format", F.lit(name)) for name, df in back.items())
    return csv.unionByName(json).unionByName(path)


@query(
    """
SELECT o_orderkey, o_totalprice,
       CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
FROM orders
"""
)
def schema_evolution(spark: SparkSession, sf: str) -> DataFrame:
    """Finished orders are written before the table had a priority, the others after."""
    path = scratch_path(spark, "schema_evolution")
    orders = table(spark, sf, "orders")
    append_evolving(orders.where("o_orderstatus = 'F'").select("o_orderkey", "o_totalprice"), path)
    later = orders.where("o_orderstatus <> 'F'")
    return append_evolving(later.select("o_orderkey", "o_totalprice", "o_orderpriority"), path)


LINES = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity,
       strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS l_shipdate
FROM lineitem
"""


def _path(sf: str) -> str:
    return f"{sf.rstrip('/')}/lineitem.parquet"


def _lines(df: DataFrame) -> DataFrame:
    return df.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", as_text("l_shipdate").alias("l_shipdate")
    )


@query(LINES)
def zorder(spark: SparkSession, sf: str) -> DataFrame:
    """Line items rewritten in clustered files; the rows are the same."""
    path = scratch_path(spark, "zorder")
    lines = table(spark, sf, "lineitem")
    count = max(8, layout.files_for(spark, _path(sf)))
    layout.zorder(lines, ["l_partkey", "l_shipdate"], count).write.parquet(path)
    return _lines(spark.read.parquet(path))


@query(LINES)
def compact(spark: SparkSession, sf: str) -> DataFrame:
    """The files of the line items, compacted."""
    out = scratch_path(spark, "compact")
    layout.compact(spark, _path(sf), out)
    return _lines(spark.read.parquet(out))


@query(
    """
SELECT l_orderkey, l_linenumber, l_returnflag,
       CASE WHEN l_linestatus = 'O' THEN l_quantity END AS l_quantity
FROM lineitem
"""
)
def compact_evolved(spark: SparkSession, sf: str) -> DataFrame:
    """A partitioned folder whose first files lack a column, compacted and then clustered."""
    root = scratch_path(spark, "compact_evolved")
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_linestatus", "l_quantity")
    closed = lines.where("l_linestatus <> 'O'").drop("l_linestatus", "l_quantity")
    opened = lines.where("l_linestatus = 'O'").drop("l_linestatus")
    for part in (closed, opened):
        part.write.mode("append").partitionBy("l_returnflag").parquet(f"{root}/grown")
    layout.optimize(spark, f"{root}/grown", f"{root}/compact")
    layout.optimize(spark, f"{root}/compact", f"{root}/clustered", ["l_orderkey", "l_linenumber"])
    return spark.read.parquet(f"{root}/clustered")


SAVED = """
SELECT p_partkey, p_brand, length(p_name) > 5 AS long_name, 'part' AS source_name, TRUE AS timed FROM part
"""


@query(SAVED)
def sorted_table(spark: SparkSession, sf: str) -> DataFrame:
    """A table made by CREATE TABLE AS from a sorted save with provenance columns."""
    root = scratch_path(spark, "sorted_table")
    name = f"parts_{root.rsplit('-', 1)[1]}"
    part = files.with_provenance(spark.read.parquet(f"{sf.rstrip('/')}/part.parquet"))
    found = part.select(
        "p_partkey",
        "p_brand",
        (F.length("p_name") > 5).alias("long_name"),
        F.regexp_extract("file_path", r"/([a-z]+)\.parquet", 1).alias("source_name"),
        F.col("inserted_at").isNotNull().alias("timed"),
    )
    save_table(found, name, f"{root}/saved", sort_by=["p_brand"], comment="parts by brand")
    create_table_as(spark, f"{name}_copy", f"SELECT * FROM {name}")
    return spark.table(f"{name}_copy")


@query("SELECT p_partkey, p_size, p_retailprice, p_name FROM part")
def csv_inferred(spark: SparkSession, sf: str) -> DataFrame:
    """CSV with inferred types; the key is inferred as an int and widened."""
    path = scratch_path(spark, "csv_inferred")
    part = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice", "p_name")
    part.write.options(header=True, quote='"').csv(path)
    back = files.read_csv(spark, path)
    return back.select(*[F.col(f.name).cast(f.dataType) for f in part.schema.fields])


GROWN = """
SELECT event_id, user_id, CASE WHEN day(ts) > 10 THEN event_type END AS event_type,
       CASE WHEN day(ts) > 20 THEN value ELSE floor(value) END AS value,
       CASE WHEN day(ts) > 20 THEN event_type ELSE CAST(user_id AS VARCHAR) END AS mixed
FROM events
"""


def _grow(spark: SparkSession, sf: str, root: str) -> SchemaStore:
    """Events land in three drops: keys of int, then long; values of int, then double; a late column.

    Rows with a key or value beyond a drop's narrow types land in files of wide ones beside the others.
    """
    store = SchemaStore(spark, f"{root}/landing", f"{root}/_schema")
    events = table(spark, sf, "events").withColumn("day", F.dayofmonth("ts"))
    # from 2**53 on a double is whole, and floor() would cut it to a long
    whole = F.when(F.abs("value") < 2.0**53, F.floor("value").cast("double")).otherwise(F.col("value")).alias("value")
    key = F.col("user_id").alias("mixed")
    drops = (
        ("day <= 10", ["event_id", "user_id", whole, key], {"event_id": "int", "user_id": "short", "value": "int", "mixed": "int"}),
        ("day BETWEEN 11 AND 20", ["event_id", "user_id", "event_type", whole, key], {"user_id": "int", "value": "int", "mixed": "int"}),
        ("day > 20", ["event_type", "event_id", "user_id", "value", F.col("event_type").alias("mixed")], {}),
    )
    for condition, columns, kinds in drops:
        rows, fits = events.where(condition).select(*columns), F.lit(True)
        for c, kind in kinds.items():
            fits = fits & (F.col(c).isNull() | F.col(c).try_cast(kind).isNotNull())
        narrow = {c: F.col(c).try_cast(kind) for c, kind in kinds.items()}
        rows.where(fits).select(*[narrow.get(c, F.col(c)).alias(c) for c in rows.columns]).write.mode("append").parquet(f"{root}/landing")
        wide = rows.where(~fits)
        if kinds and not wide.isEmpty():
            wide.write.mode("append").parquet(f"{root}/landing")
        store.refresh()
    return store


@query(GROWN)
def widened_column(spark: SparkSession, sf: str) -> DataFrame:
    """All drops under the schema that was kept while their types grew, up to text."""
    return _grow(spark, sf, scratch_path(spark, "widened_column")).read().select("event_id", "user_id", "event_type", "value", "mixed")


@query(f"SELECT event_id, user_id, event_type, value FROM ({GROWN})")
def widened_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The same drops as a stream that reads every file by the kept schema."""
    root = scratch_path(spark, "widened_stream")
    schema = _grow(spark, sf, root).known()
    schema = type(schema)([f for f in schema if f.name != "mixed"])
    run_once(stream_parquet(spark, f"{root}/landing", schema), f"{root}/bronze", f"{root}/_checkpoint")
    return spark.read.schema(schema).parquet(f"{root}/bronze").select("event_id", "user_id", "event_type", "value")


@query("SELECT event_id, user_id, event_type, value, 'RUNNING' AS before, 'STOPPED' AS after FROM events")
def continuous_run(spark: SparkSession, sf: str) -> DataFrame:
    """Events land while a query runs on; what it wrote until it was stopped, and its states."""
    root = scratch_path(spark, "continuous_run")
    name = f"continuous_{root.rsplit('-', 1)[1]}"
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    half = F.col("event_id") % 2
    events.where(half == 0).write.parquet(f"{root}/landing")
    stream = stream_parquet(spark, f"{root}/landing", events.schema)
    running = run_continuous(stream, f"{root}/out", f"{root}/_checkpoint", "200 milliseconds", name)
    state = lambda: "RUNNING" if running.isActive else "STOPPED"
    try:
        running.processAllAvailable()
        events.where(half == 1).write.mode("append").parquet(f"{root}/landing")
        running.processAllAvailable()
        before = state()
    finally:
        running.stop()
    return spark.table(name).withColumns({"before": F.lit(before), "after": F.lit(state())})


@query("SELECT event_id, user_id, event_type, value FROM events")
def archived_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Three drops of JSON; what a run took in moves out of the landing folder at the next one."""
    root = scratch_path(spark, "archived_ingest")
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    for drop in range(3):
        write_json(events.where(F.col("event_id") % 3 == drop), f"{root}/landing/drop{drop}")
        stream = stream_json(
            spark, f"{root}/landing", "event_id long, user_id long, value double", events.columns, archive=f"{root}/archive"
        )
        run_once(stream, f"{root}/bronze", f"{root}/_checkpoint")
    return spark.read.parquet(f"{root}/bronze").select(*events.columns)


@query(
    """
SELECT p_partkey, p_brand, CAST(NULL AS INTEGER) AS stock, 'registered' AS step FROM part WHERE p_size > 25
UNION ALL SELECT p_partkey, upper(p_brand), NULL, 'replaced' FROM part WHERE p_size <= 25
UNION ALL SELECT p_partkey, p_brand, p_size, 'view' FROM part WHERE p_size > 40
UNION ALL SELECT NULL, 'p_partkey p_brand stock', NULL, 'described'
"""
)
def ddl_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Files registered as a table that then gains a column, a replaced table, views, and a description."""
    root = scratch_path(spark, "ddl_tables")
    name = f"ddl_{root.rsplit('-', 1)[1]}"
    database = spark.catalog.currentDatabase()
    part = table(spark, sf, "part").select("p_partkey", "p_brand", "p_size")
    tables.write_parquet(part.where("p_size > 25").drop("p_size"), f"{root}/files")
    tables.use_database(spark, name)
    try:
        tables.register_table(spark, f"{name}.parts", f"{root}/files")
        registered = tables.add_column(spark, f"{name}.parts", "stock", "int")
        for rows in (part, part.where("p_size <= 25").withColumn("p_brand", F.upper("p_brand"))):
            replaced = save_table(rows.drop("p_size"), f"{name}.small", f"{root}/small")
        tables.create_view(part.withColumnRenamed("p_size", "stock"), f"{name}_all")
        save_table(spark.table(f"{name}_all"), f"{name}.stocked")
        view = tables.create_stored_view(spark, f"{name}.large", f"SELECT * FROM {name}.stocked WHERE stock > 40")
        lines = tables.describe_table(spark, f"{name}.parts").select("col_name").collect()
        columns = " ".join(r[0] for r in lines[:3])
        steps = {"registered": registered, "replaced": replaced.withColumn("stock", F.lit(None).cast("int")), "view": view}
        found = spark.createDataFrame([(None, columns, None, "described")], "p_partkey long, p_brand string, stock int, step string")
        for step, rows in steps.items():
            found = found.unionByName(rows.withColumn("step", F.lit(step)))
        return tables.stored(found, "ddl")
    finally:
        spark.catalog.dropTempView(f"{name}_all")
        spark.sql(f"USE {database}")
        tables.drop_database(spark, name)
