"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``nodes`` points on a ring of 60-bit numbers, and a row belongs to the first
point clockwise of its own, which is a hash of its key and text. A shard may hold only its
share of the rows: of all rows, at most one more than any other. Rows that a full shard cannot
take, the last of each of its arcs, continue clockwise to the next point whose shard has room.

Only the counts of the arcs leave the cluster: shards times nodes numbers, whatever the volume of
data. The walk over them gives, for each arc, which ranks go to which shard and slot.

Defined results: a null text has no bytes and checksum 0; a null key is a key like any other;
equal rows are placed one after another; of no rows there is no shard. Rows are counted, not keys,
so repeated rows keep the balance. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

RING_BITS = 60
CELL_BITS = 14


def ring_point(value: Column) -> Column:
    """The first 60 bits of the MD5 of a text."""
    return F.conv(F.substring(F.md5(value.cast("binary")), 1, RING_BITS // 4), 16, 10).cast("long")


def ring(spark: SparkSession, shards: int, nodes: int) -> DataFrame:
    """arc, shard and point of every virtual node, numbered clockwise from 0."""
    points = spark.range(shards * nodes).select(
        (F.col("id") % shards).cast("int").alias("shard"),
        ring_point(F.concat(F.lit("shard "), F.col("id") % shards, F.lit(" node "), F.floor(F.col("id") / shards))).alias("point"),
    )
    clockwise = Window.orderBy("point", "shard")
    return points.select((F.row_number().over(clockwise) - 1).alias("arc"), "shard", "point")


def _cells(spark: SparkSession, points: DataFrame) -> DataFrame:
    """Of each of 2**CELL_BITS equal pieces of the ring: its points, and the first one after it."""
    inside = points.groupBy(F.shiftright("point", RING_BITS - CELL_BITS).cast("long").alias("cell")).agg(
        F.array_sort(F.collect_list(F.struct("point", "arc"))).alias("points")
    )
    every = spark.range(1 << CELL_BITS).withColumnRenamed("id", "cell").join(inside, "cell", "left")
    later = Window.orderBy("cell").rowsBetween(1, Window.unboundedFollowing)
    first = F.first(F.col("points")[0]["arc"], ignorenulls=True)
    return every.select("cell", "points", F.coalesce(first.over(later), F.lit(0)).alias("next"))


def walk(arcs: list[tuple[int, int]], room: list[int]) -> dict[int, list[tuple[int, int, int, int]]]:
    """Pieces (first rank, end rank, shard, first slot) of each arc.

    ``arcs``: shard and number of rows of every arc, clockwise; ``room``: what each shard takes.
    """
    room, used = list(room), [0] * len(room)
    pieces: dict[int, list[tuple[int, int, int, int]]] = {k: [] for k in range(len(arcs))}

    def place(arc: int, rank: int, rows: int, shard: int) -> int:
        took = min(rows, room[shard])
        if took:
            pieces[arc].append((rank, rank + took, shard, used[shard]))
            room[shard] -= took
            used[shard] += took
        return took

    waiting = []
    for arc, (shard, rows) in enumerate(arcs):
        took = place(arc, 0, rows, shard)
        if took < rows:
            waiting.append((arc, took, rows))
    for arc, rank, rows in waiting:
        at = arc
        while rank < rows:
            at = (at + 1) % len(arcs)
            rank += place(arc, rank, rows - rank, arcs[at][0])
    return pieces


def shard_rows(
    docs: DataFrame, shards: int = 24, nodes: int = 256, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ()
) -> DataFrame:
    """``key``, size, text_crc32, shard and slot (gapless from 0 in each shard) of every row.

    Columns named in ``carry`` travel along as a struct ``row``, apart from the operator's own.
    """
    spark = docs.sparkSession
    body = F.col(text).cast("string")
    rows = docs.select(
        F.col(key).alias("key"),
        (F.coalesce(F.octet_length(body), F.lit(0)).cast("long") + 8).alias("size"),
        F.coalesce(F.crc32(body.cast("binary")), F.lit(0)).cast("long").alias("crc"),
        *([F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []),
    ).withColumn("point", ring_point(F.concat_ws(":", F.coalesce(F.col("key").cast("string"), F.lit("-")), F.col("crc"))))
    points = ring(spark, shards, nodes)
    cells = F.broadcast(_cells(spark, points))  # 2**CELL_BITS rows whatever the input
    ahead = F.filter("points", lambda p: p["point"] >= F.col("point"))
    placed = rows.withColumn("cell", F.shiftright("point", RING_BITS - CELL_BITS).cast("long")).join(cells, "cell")
    extra = ["row"] if carry else []
    placed = placed.select("key", "size", "crc", "point", *extra, F.coalesce(F.get(ahead, F.lit(0))["arc"], "next").alias("arc"))

    counts = {r["arc"]: r["count"] for r in placed.groupBy("arc").count().collect()}  # an arc each
    owner = [r["shard"] for r in points.orderBy("arc").collect()]
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    pieces = walk([(s, counts.get(a, 0)) for a, s in enumerate(owner)], room)
    plan = spark.createDataFrame(
        [(a, p) for a, p in pieces.items() if p],
        "arc int, pieces array<struct<lo: long, hi: long, shard: int, slot: long>>",
    )
    order = Window.partitionBy("arc").orderBy("point", "key", "crc", "size")
    ranked = placed.withColumn("rank", F.row_number().over(order).cast("long") - 1).join(F.broadcast(plan), "arc")
    own = F.filter("pieces", lambda p: (p["lo"] <= F.col("rank")) & (F.col("rank") < p["hi"]))[0]
    return ranked.withColumn("own", own).select(
        F.col("key").alias(key), "size", F.col("crc").alias("text_crc32"), F.col("own.shard").alias("shard"),
        (F.col("own.slot") + F.col("rank") - F.col("own.lo")).alias("slot"), *extra,
    )
