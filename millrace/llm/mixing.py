"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order, gone through up to twice. A
document's virtual finish time is the words of its source up to and with it, divided by the
source's target. All queues merged in order of virtual time serve each source in proportion to
its target; the merged queue is cut where its words reach the budget.

Running totals are never taken in one task: a source's order is cut into slices of equal hash
ranges, the merged queue into slices of equal virtual time, each slice is summed up by itself
and the sums of the slices before it are added. A source with a third of all rows has as many
slices as any other.

Defined results: a null or empty text has size 0 and takes nothing; a null source is one source,
the last; a source without words has target 0; no rows give no rows. Repeated rows are rows of
their own. Reruns agree, as the shuffle is a hash of key and text. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.ring import RING_BITS, ring_point

WEIGHTS = (3, 1, 2)
BUDGET = 1.5
EPOCHS = 2
SLICES = 4096

BEFORE = (Window.unboundedPreceding, Window.currentRow)


def word_count(text: Column) -> Column:
    """The number of runs of characters other than space and \\x09 to \\x0D, 0 for null."""
    marked = F.regexp_replace(text, r"[^\x20\x09-\x0D]++", "w")
    return F.coalesce(F.length(F.regexp_replace(marked, r"[\x20\x09-\x0D]++", "")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], budget: float, epochs: int) -> DataFrame:
    """source, rank, source_size, target: shares by weight, none above ``epochs`` times its source.

    ``sizes`` has a row for each source. The share of a weight of one, the level, is what the
    budget leaves to the sources that are not full, over their weights; sources fill in the order
    of their size over weight.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.array(*[F.lit(float(w)) for w in weights])
    rows = sizes.withColumn("rank", F.row_number().over(ordered) - 1)
    rows = rows.withColumn("weight", F.get(weight, F.col("rank") % len(weights)))
    rows = rows.withColumn("most", (F.col("source_size") * epochs).cast("double"))
    fill = Window.orderBy(F.col("most") / F.col("weight"), "rank")
    everything = Window.partitionBy()
    rows = rows.select(
        "*",
        F.row_number().over(fill).alias("place"),
        (F.sum("source_size").over(everything) * F.lit(budget)).alias("total"),
        F.coalesce(F.sum("most").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)).alias("full"),
        F.sum("weight").over(fill.rowsBetween(Window.currentRow, Window.unboundedFollowing)).alias("open"),
    )
    # the level if this and all later sources were open; the first not full at its level is right
    level = (F.col("total") - F.col("full")) / F.col("open")
    holds = level * F.col("weight") <= F.col("most")
    first = F.min(F.when(holds, F.struct("place", level.alias("level"))))
    rows = rows.withColumn("level", first.over(everything)["level"])
    target = F.when(F.col("level").isNull(), F.col("most")).otherwise(F.least("most", F.col("weight") * F.col("level")))
    return rows.select("source", "rank", "source_size", target.alias("target"))


def fair_queue(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    budget: float = BUDGET,
    epochs: int = EPOCHS,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    slices: int = SLICES,
    carry: Column | None = None,
) -> DataFrame:
    """``key``, size, source, source_size, target, finish (the virtual time of its first turn),
    turns (how often the mix takes it) and taken (words), a row for each row of ``docs``; and
    ``carry``, if given, as column carried."""
    body = F.col(text).cast("string")
    mixed = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("-")), F.md5(F.coalesce(body, F.lit("")).cast("binary")))
    extra = [] if carry is None else ["carried"]
    rows = docs.select(
        F.col(key).alias("key"), F.col(source).alias("source"), word_count(body).alias("size"), ring_point(mixed).alias("point"),
        *([] if carry is None else [carry.alias("carried")]),
    )
    rows = rows.withColumn("slice", F.floor(F.col("point") / F.lit((1 << RING_BITS) // slices)).cast("int"))

    # words of a source up to each document: within its slice, and of the slices before
    within = Window.partitionBy("source", "slice").orderBy("point", "key", "size").rowsBetween(*BEFORE)
    sums = rows.groupBy("source", "slice").agg(F.sum("size").alias("words"))
    goals = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, budget, epochs)
    earlier = Window.partitionBy("source").orderBy("slice").rowsBetween(*BEFORE)
    sums = sums.select("source", "slice", (F.sum("words").over(earlier) - F.col("words")).alias("base"))
    sums = sums.alias("s").join(goals.alias("g"), F.col("s.source").eqNullSafe(F.col("g.source")))
    sums = sums.select("s.*", "g.rank", "g.source_size", "g.target")
    run = rows.withColumn("run", F.sum("size").over(within)).alias("r")
    same = F.col("r.source").eqNullSafe(F.col("s.source")) & (F.col("r.slice") == F.col("s.slice"))
    queued = run.join(sums.alias("s"), same).select(
        "key", "r.source", "size", "rank", "source_size", "target", (F.col("base") + F.col("run")).alias("upto"), *extra
    )

    turn = lambda n: (F.col("upto") + F.col("source_size") * n) / F.col("target")
    entries = queued.where("size > 0 AND target > 0").select(
        "rank", "size", F.explode(F.array(*[turn(n) for n in range(epochs)])).alias("finish")
    )
    entries = entries.withColumn("slice", F.floor(F.col("finish") * slices))
    served = Window.partitionBy("slice").orderBy("finish", "rank").rowsBetween(*BEFORE)
    before = Window.orderBy("slice").rowsBetween(*BEFORE)
    time = entries.groupBy("slice").agg(F.sum("size").alias("words"))
    time = time.select("slice", (F.sum("words").over(before) - F.col("words")).alias("base"))
    cap = goals.agg((F.sum("source_size") * F.lit(budget)).alias("cap"))
    merged = entries.withColumn("run", F.sum("size").over(served)).join(time, "slice").crossJoin(F.broadcast(cap))
    last = merged.where("base + run <= cap").agg(F.max(F.struct("finish", "rank")).alias("last"))

    taken = [F.when(F.struct(turn(n).alias("finish"), "rank") <= F.col("last"), 1).otherwise(0) for n in range(epochs)]
    turns = sum(taken[1:], taken[0])
    out = queued.crossJoin(F.broadcast(last)).withColumn("turns", F.when(F.col("target") > 0, turns).otherwise(0))
    return out.select(
        F.col("key").alias(key), "size", F.col("source").alias(source), "source_size", "target",
        F.when(F.col("target") > 0, turn(0)).alias("finish"), "turns", (F.col("size") * F.col("turns")).alias("taken"), *extra,
    )
