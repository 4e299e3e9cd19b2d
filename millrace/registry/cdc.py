"""Change capture: events as the capture rows of a table of users.

The transaction is the hour, the command the event's place in a day cycle, and the
operation follows from the event type; so a text order and a typed order differ.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.operators import cdc
from millrace.operators.dedup import latest_per_key
from millrace.operators.skew import next_in_key
from millrace.plans.cdc_tables import TableSpec, build_cdc, specs_from_conf
from millrace.registry.base import query, table
from millrace.session import scratch_path
from millrace.sources.streams import stream_parquet
from millrace.streaming.scd import fold_scd1
from millrace.streaming.scd import scd1_stream as scd1_state_stream


def _bytes(number: Column) -> Column:
    """A number as a 10-byte big-endian sequence value."""
    return F.unhex(F.lpad(F.hex(number), 20, "0"))


def as_capture(events: DataFrame, *extra: Column) -> DataFrame:
    kind = F.col("event_type")
    hour = F.unix_timestamp(F.date_trunc("hour", "ts").cast("timestamp"))
    return events.select(
        _bytes(hour).alias("__$start_lsn"),
        F.lit(None).cast("binary").alias("__$end_lsn"),
        _bytes(F.col("event_id")).alias("__$seqval"),
        F.when(kind == "error", 1)
        .when(kind == "signup", 2)
        .when(kind == "view", 3)
        .when(kind == "click", 4)
        .otherwise(9)
        .alias("__$operation"),
        F.lit(None).cast("binary").alias("__$update_mask"),
        F.minute("ts").alias("__$command_id"),
        "user_id",
        "event_id",
        "value",
        *extra,
    )


def captured(spark: SparkSession, sf: str) -> DataFrame:
    return as_capture(table(spark, sf, "events"))


CHANGES = """
SELECT user_id, event_id, value,
       lpad(hex(CAST(epoch(date_trunc('hour', ts)) AS BIGINT)), 20, '0') AS lsn,
       CAST(minute(ts) AS INT) AS cmd, lpad(hex(event_id), 20, '0') AS seq,
       CASE event_type WHEN 'error' THEN 'DELETE' WHEN 'signup' THEN 'INSERT'
            WHEN 'click' THEN 'UPDATE' END AS op,
       CASE event_type WHEN 'error' THEN 1 WHEN 'signup' THEN 2 WHEN 'click' THEN 4
            ELSE 9 END AS code
FROM events WHERE event_type <> 'view'
"""
ORDER = "lsn, cmd, seq, code"


@query(f"SELECT user_id, event_id, value, lsn, cmd, seq, op FROM ({CHANGES})")
def cdc_decode(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.decode_changes(captured(spark, sf)).select(
        "user_id",
        "event_id",
        "value",
        F.hex("__start_lsn").alias("lsn"),
        F.col("__command_id").alias("cmd"),
        F.hex("__seqval").alias("seq"),
        F.col("__operation").alias("op"),
    )


@query(
    f"""
SELECT user_id, event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY {ORDER}) AS next_event
FROM ({CHANGES})
"""
)
def cdc_global_order(spark: SparkSession, sf: str) -> DataFrame:
    """The change that follows each change of the same row in the global order."""
    decoded = cdc.decode_changes(captured(spark, sf)).select(
        "user_id", "event_id", cdc.GLOBAL_ORDER
    )
    ordered = decoded.withColumn(
        "position", F.struct(f"{cdc.GLOBAL_ORDER}.*", "event_id")
    )
    return next_in_key(ordered, ["user_id"], "position", "following").select(
        "user_id", "event_id", F.col("following.event_id").alias("next_event")
    )


SCD1 = f"""
SELECT user_id, event_id, value
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY lsn DESC, cmd DESC, seq DESC,
                                   code DESC) AS rn FROM ({CHANGES}))
WHERE rn = 1 AND op IS DISTINCT FROM 'DELETE'
"""
SCD2 = f"""
SELECT user_id, event_id, value, valid_from, valid_to
FROM (SELECT *, seq AS valid_from,
             lead(seq) OVER (PARTITION BY user_id ORDER BY {ORDER}) AS valid_to
      FROM ({CHANGES}))
WHERE op IS DISTINCT FROM 'DELETE'
"""


@query(SCD1)
def scd1(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.scd1(cdc.decode_changes(captured(spark, sf)), ["user_id"])


def _seq_bounds(df: DataFrame) -> DataFrame:
    """Validity bounds by their sequence value, as text."""
    return df.withColumns(
        {c: F.hex(F.col(c)["__$seqval"]) for c in ("valid_from", "valid_to")}
    )


@query(SCD2)
def scd2(spark: SparkSession, sf: str) -> DataFrame:
    return _seq_bounds(cdc.scd2(cdc.decode_changes(captured(spark, sf)), ["user_id"]))


def _tagged(tables: dict[str, DataFrame]) -> DataFrame:
    """The rows of several tables of users' changes, each under its name."""
    parts = []
    for name, df in tables.items():
        bounds = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ("valid_from", "valid_to")]
        parts.append(df.select(F.lit(name).alias("target"), "user_id", "event_id", "value", *bounds))
    return reduce(DataFrame.unionByName, parts)


def _tagged_sql(names: dict[str, str]) -> str:
    plain = "user_id, event_id, value, NULL::VARCHAR AS valid_from, NULL::VARCHAR AS valid_to"
    own = {"scd1": (plain, SCD1), "scd2": ("*", SCD2), "history": (plain, CHANGES)}
    return " UNION ALL ".join(f"SELECT '{n}' AS target, {own[k][0]} FROM ({own[k][1]})" for n, k in names.items())


@query(_tagged_sql({"first scd1": "scd1", "first scd2": "scd2", "last scd1": "scd1", "last scd2": "scd2"}))
def scd_convergence(spark: SparkSession, sf: str) -> DataFrame:
    """Four loads applied first to last and last to first end in the same tables."""
    events = table(spark, sf, "events")
    load = F.least(F.floor(F.dayofmonth("ts") / 8), F.lit(3)).alias("load")
    decoded = cdc.decode_changes(as_capture(events, load))
    loads = [decoded.where(F.col("load") == i).drop("load") for i in range(4)]
    tables = {}
    for name, arrivals in (("first", loads), ("last", loads[::-1])):
        state = reduce(lambda s, a: fold_scd1(s, a, ["user_id"]), arrivals, None)
        whole = reduce(DataFrame.unionByName, arrivals)
        tables[f"{name} scd1"] = cdc.live_rows(state)
        tables[f"{name} scd2"] = _seq_bounds(cdc.scd2(whole, ["user_id"]))
    return _tagged(tables)


TIES = f"""
SELECT user_id, event_id, value, lsn AS valid_from,
       lead(lsn) OVER (PARTITION BY user_id ORDER BY lsn, code, event_id) AS valid_to, op
FROM ({CHANGES})
"""


@query(f"SELECT user_id, event_id, value, valid_from, valid_to FROM ({TIES}) WHERE op IS DISTINCT FROM 'DELETE'")
def scd2_ties(spark: SparkSession, sf: str) -> DataFrame:
    """Changes known only by their hour, every one of them delivered twice."""
    rows = captured(spark, sf).withColumns({"__$command_id": F.lit(0), "__$seqval": F.lit(None).cast("binary")})
    changes = cdc.decode_changes(rows)
    second = cdc.scd2(changes.unionByName(changes), ["user_id"])
    return second.withColumns({c: F.hex(F.col(c)["__$start_lsn"]) for c in ("valid_from", "valid_to")})


@query(
    "SELECT count(*) AS total_rows, min(event_id) AS first_event, max(event_id) AS last_event,"
    " 0 AS out_of_order FROM events"
)
def range_split(spark: SparkSession, sf: str) -> DataFrame:
    """Events written as ordered files; no file may begin before the one ahead of it ends."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "range_split")
    events = table(spark, sf, "events").select("event_id", "ts", "user_id")
    split = cdc.range_split(events, ["ts", "event_id"], parts)
    split.withColumn("part", F.spark_partition_id()).write.parquet(path)
    key = F.struct("ts", "event_id")
    # one line per file from here on
    bounds = (
        spark.read.parquet(path)
        .groupBy("part")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min(key).alias("low"),
            F.max(key).alias("high"),
            F.min("event_id").alias("first_event"),
            F.max("event_id").alias("last_event"),
        )
    )
    ahead = F.lag("high").over(Window.orderBy("part"))
    return bounds.withColumn("ahead", ahead).agg(
        F.sum("n").alias("total_rows"),
        F.min("first_event").alias("first_event"),
        F.max("last_event").alias("last_event"),
        F.count_if(F.col("ahead") >= F.col("low")).alias("out_of_order"),
    )


@query(SCD1)
def scd1_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Changes streamed into Spark's state; each batch hands on the keys that changed."""
    root = scratch_path(spark, "scd1_stream")
    rows = captured(spark, sf)
    landed = as_capture(table(spark, sf, "events"), F.hour("ts").alias("hour"))
    for condition in ("hour >= 12", "hour < 12"):
        landed.where(condition).drop("hour").write.mode("append").parquet(f"{root}/staged")
    stream = stream_parquet(spark, f"{root}/staged", rows.schema, max_files=4)
    state = scd1_state_stream(cdc.decode_changes(stream), ["user_id"])

    def keep(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{root}/updates/batch={batch}")

    writer = state.writeStream.outputMode("update").option("checkpointLocation", f"{root}/_checkpoint")
    writer.foreachBatch(keep).trigger(availableNow=True).start().awaitTermination()
    updates = spark.read.parquet(f"{root}/updates")
    return cdc.live_rows(latest_per_key(updates, ["user_id"], ["batch"], []).drop("batch"))


@query(SCD2)
def scd2_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """SCD type 2 of all but the last days, then renewed for the users who changed since."""
    changes = cdc.decode_changes(
        as_capture(table(spark, sf, "events"), F.dayofmonth("ts").alias("day"))
    )
    before, arrived = changes.where("day < 28").drop("day"), changes.where("day >= 28").drop("day")
    current = cdc.scd2(before, ["user_id"])
    return _seq_bounds(cdc.scd2_refresh(current, changes.drop("day"), arrived, ["user_id"]))


def _staged(spark: SparkSession, sf: str) -> DataFrame:
    return as_capture(table(spark, sf, "events"), (F.dayofmonth("ts") < 16).alias("early"))


KINDS = ("scd1", "scd2", "history")


@query(_tagged_sql({f"{n} {k}": k for n in ("ordered", "reversed") for k in KINDS}))
def cdc_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Two configured tables built from staged files that arrive in opposite orders."""
    root = scratch_path(spark, "cdc_tables")
    prefix = f"millrace.{root.rsplit('-', 1)[1]}"
    for n, name in enumerate(("ordered", "reversed")):
        spark.conf.set(f"{prefix}.{n}.name", name)
        spark.conf.set(f"{prefix}.{n}.keys", "user_id")
    tables = build_cdc(spark, specs_from_conf(spark, prefix), f"{root}/staged", f"{root}/out")
    staged = _staged(spark, sf)
    for load in range(2):
        for name, early in (("ordered", load == 0), ("reversed", load == 1)):
            part = staged.where(F.col("early") == F.lit(early)).drop("early")
            part.write.mode("append").parquet(f"{root}/staged/{name}")
            tables[name].load()
    found = {}
    for name, t in tables.items():
        found |= {f"{name} scd1": t.scd1, f"{name} scd2": _seq_bounds(t.scd2), f"{name} history": t.history}
    return _tagged(found)


@query(SCD2)
def cdc_reload(spark: SparkSession, sf: str) -> DataFrame:
    """A load whose number was used before is refused; the next one takes in all files."""
    root = scratch_path(spark, "cdc_reload")
    built = build_cdc(spark, [TableSpec("users", ("user_id",))], f"{root}/staged", f"{root}/out")["users"]
    staged = _staged(spark, sf)
    staged.where("early").drop("early").write.parquet(f"{root}/staged/users")
    built.load(1)
    staged.where("NOT early").drop("early").write.mode("append").parquet(f"{root}/staged/users")
    try:
        built.load(1)
    except ValueError:
        built.load(2)
    return _seq_bounds(built.scd2)


@query(
    f"""
SELECT s.user_id, s.event_id, s.value, CASE WHEN day(e.ts) >= 16 THEN 2 * s.event_id END AS late
FROM ({SCD1}) s JOIN events e ON e.event_id = s.event_id
"""
)
def late_column(spark: SparkSession, sf: str) -> DataFrame:
    """Current rows of a table whose captures had no column ``late`` in the first five files."""
    root = scratch_path(spark, "late_column")
    built = build_cdc(spark, [TableSpec("users", ("user_id",))], f"{root}/staged", f"{root}/out")["users"]
    staged = _staged(spark, sf)
    first = staged.where("early").drop("early")
    first.repartition(5, "event_id").write.parquet(f"{root}/staged/users")
    built.load()
    later = staged.where("NOT early").drop("early").withColumn("late", F.col("event_id") * 2)
    later.write.mode("append").parquet(f"{root}/staged/users")
    built.load()
    return built.scd1
