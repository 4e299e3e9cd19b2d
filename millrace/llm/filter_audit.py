"""What each filter removes under every order of the filters, counted by a stream with retraction.

Five filters fail a text: A has few words, B few distinct ones, C many capitals, D a reserved
symbol, E is identical to the text of a smaller key. A to D are bits of the text alone. E depends
on the rest of the table, so it is decided by a stream: all files are processed as available-now
micro-batches, and the state of a text (by its SHA-256; a few texts share one state key) is the
smallest key so far with the parts and labels of its rows. Those rows count as unique. When a smaller key arrives, their masks are
retracted from the part counters, counted again with E, and the new rows take their place; a
larger key counts with E at once. A micro-batch's counters are one small table named by the
batch, so a batch that is repeated replaces its own; part counters are the sums over all batches.

The 32 masks of a part give every order: a filter removes the rows whose mask holds it and none of
those before it, and it is the first of the k filters in a mask in 120 / k orders.

Before the shuffle to the state, a batch of rows keeps only the rows of its smallest key of each
text; the others are counts by part and mask, so a text that a third of all rows share costs a
few rows per batch. Labels are joined after the texts are gone, by rows of some 60 bytes; rows
without a key are spread over the tasks. State is checkpointed in the shared folder, so it survives
lost executors; where a state partition would hold more than ``TEXTS_IN_MEMORY`` texts it is kept
in RocksDB, else in memory (an open RocksDB reserves 4 MB of disk per partition). Labels are read once per
micro-batch; ``bytes_per_core`` keeps batches large against them.

Defined results: a null text is the empty text, a null part the empty string. A row with a null
key is never a copy and makes none. Equal keys with one text are all unique, or all copies. A key
with several labels is good (toxic) if one label says so; one without is neither; labels without a
key count for nothing. No rows give no rows. Texts of any length are taken whole. Only the columns
named are read.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from millrace.llm.arrays import mix, per_doc, slices, span_hash, utf8, words
from millrace.llm.shared_files import discard, stored
from millrace.session import scratch_path

FILTERS = "ABCDE"
COPY, GOOD, TOXIC = 16, 32, 64  # bits of a mark beside those of A to D
HAS_KEY, LATER, NO_KEY = 0, 1, 2
BYTES_PER_CORE = 64 << 20
TEXTS_PER_KEY = 8  # on average: what a state key costs is shared by so many texts
TEXTS_IN_MEMORY = 50_000  # of a state partition; beyond, RocksDB holds the state
_RESERVED = np.isin(np.arange(256), list(b"#$%&*|"))
_CAPITAL = np.isin(np.arange(256), np.arange(65, 91))
_ON_DISK = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def text_masks(column: pa.Array) -> np.ndarray:
    """The bits 1, 2, 4, 8 of filters A, B, C, D for every text."""
    data, offsets = utf8(column)
    n = len(offsets) - 1
    word = words(data, offsets)
    count = np.bincount(word.doc, minlength=n)
    own = np.unique(mix(span_hash(data, word.start, word.end) ^ mix(word.doc.astype(np.uint64) + np.uint64(1))), return_index=True)[1]
    distinct = np.bincount(word.doc[own], minlength=n)
    points = per_doc((data & 0xC0) != 0x80, offsets)
    fails = (
        count < 50,
        100 * distinct < 65 * count,
        100 * per_doc(_CAPITAL[data], offsets) > 5 * points,
        per_doc(_RESERVED[data], offsets) > 0,
    )
    return sum(f.astype(np.int32) << k for k, f in enumerate(fails))


def _marked(docs: DataFrame) -> DataFrame:
    """(digest, key, part, mark) of (key, part, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(3)
            for a, b in slices(utf8(column)[1]):
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*own.columns[:3], pa.array(text_masks(own.column(3)), pa.int32())], ["digest", "key", "part", "mark"])

    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), "key", "part", text.alias("text"))
    return rows.mapInArrow(run, "digest binary, key long, part string, mark int")


def _combined(rows: DataFrame) -> DataFrame:
    """(digest, key, kind, part, mark, n): of each batch and text the rows of the smallest key, and counts of the others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            text = batch.column(0).dictionary_encode().indices.to_numpy()
            none = batch.column(1).is_null().to_numpy(zero_copy_only=False)
            key = batch.column(1).fill_null(0).to_numpy()
            least = np.full(text.max() + 1, np.iinfo(np.int64).max)
            np.minimum.at(least, text[~none], key[~none])
            kind = np.where(none, NO_KEY, np.where(key > least[text], LATER, HAS_KEY))
            names = ["digest", "key", "kind", "part", "mark"]
            own = [batch.column(0), pa.array(np.where(kind == HAS_KEY, key, 0)), pa.array(kind, pa.int32()), batch.column(2), batch.column(3)]
            out = pa.Table.from_arrays(own, names).group_by(names).aggregate([([], "count_all")])
            yield from out.select([*names, "count_all"]).rename_columns([*names, "n"]).to_batches()

    return rows.mapInArrow(run, "digest binary, key long, kind int, part string, mark int, n long")


def follow(least: int | None, held: dict, rows: Iterator[tuple]) -> tuple[int | None, dict, Counter]:
    """The state of one text after ``rows`` (key, kind, part, mark, n), and the change of the counters."""
    change: Counter = Counter()
    for key, kind, part, mark, n in rows:
        if kind == LATER or kind == HAS_KEY and least is not None and key > least:
            change[part, mark | COPY] += n
            continue
        change[part, mark] += n
        if kind == NO_KEY:
            continue
        if least is None or key < least:
            for (p, m), k in held.items():
                change[p, m] -= k
                change[p, m | COPY] += k
            least, held = key, {}
        held[part, mark] = held.get((part, mark), 0) + n
    return least, held, change


def _unpacked(row: str) -> tuple[str, tuple]:
    text, *numbers, part = row.split(" ", 5)
    key, kind, mark, n = map(int, numbers)
    return text, (key, kind, part, mark, n)


def _follow_group(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The texts of one state key. Rows and state are packed: a column given to pandas costs more than all else."""
    least, held, arrived = {}, defaultdict(dict), defaultdict(list)
    for text, (key, _, part, mark, n) in map(_unpacked, state.get[0] if state.exists else ()):
        least[text] = key
        held[text][part, mark] = n
    for text, row in (_unpacked(row) for f in frames for row in f["row"].tolist()):
        arrived[text].append(row)
    total: Counter = Counter()
    for text, rows in arrived.items():
        least[text], held[text], change = follow(least.get(text), held[text], iter(rows))
        total.update(change)
    state.update(([f"{text} {least[text]} {HAS_KEY} {m} {n} {p}" for text, own in held.items() for (p, m), n in own.items()],))
    changes = [f"{m} {n} {p}" for (p, m), n in total.items() if n]
    if changes:
        yield pd.DataFrame({"change": changes})


def part_counters(docs: DataFrame, labels: DataFrame, rows_expected: int, key: str, part: str, text: str) -> DataFrame:
    """(part, mark, n): how many rows of a part have a mark, after all files of the stream ``docs``."""
    spark = docs.sparkSession
    if not docs.isStreaming:
        raise ValueError("the documents are a stream: the audit works on files as they arrive")
    source = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"), F.col(f"`{text}`").cast("string").alias("text"))
    one = lambda c, bit: F.max(F.when(F.col(c) == 1, bit).otherwise(0))
    known = labels.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").cast("long").alias("id")).agg((one("quality", GOOD) + one("toxic", TOXIC)).alias("label"))
    # rows without a key find no label, so they may be dealt by anything
    spread = F.when(F.col("key").isNull(), F.pmod(F.hash("digest"), F.lit(1 << 16))).otherwise(0)
    rows = _marked(source).withColumn("spread", spread)
    rows = rows.join(known.withColumn("none", F.lit(0)), (F.col("key") == F.col("id")) & (F.col("spread") == F.col("none")), "left")
    rows = rows.select("digest", "key", "part", (F.col("mark") + F.coalesce("label", F.lit(0))).alias("mark"))
    packed = F.concat_ws(" ", F.base64("digest"), "key", "kind", "mark", "n", "part").alias("row")
    own = F.pmod(F.xxhash64("digest"), F.lit(max(1, rows_expected // TEXTS_PER_KEY))).alias("own")
    changes = _combined(rows).select(own, packed).groupBy("own").applyInPandasWithState(
        _follow_group, "change string", "texts array<string>", "update", GroupStateTimeout.NoTimeout
    )
    place = scratch_path(spark, "filter-audit")

    def keep(batch: DataFrame, number: int) -> None:
        word = F.split("change", " ", 3)
        rows = batch.select(word[2].alias("part"), word[0].cast("int").alias("mark"), word[1].cast("long").alias("n"))
        rows.groupBy("part", "mark").agg(F.sum("n").alias("n")).write.mode("overwrite").parquet(f"{place}/counters/batch={number}")

    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    settings = _ON_DISK if rows_expected > TEXTS_IN_MEMORY * partitions else {}
    before = {k: spark.conf.get(k, None) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        writer = changes.writeStream.outputMode("update").option("checkpointLocation", f"{place}/checkpoint").trigger(availableNow=True)
        writer.foreachBatch(keep).start().awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    found = spark.createDataFrame([], "part string, mark int, n long")
    if _exists(spark, f"{place}/counters"):
        found = spark.read.schema("part string, mark int, n long").parquet(f"{place}/counters")
    out = stored(found.groupBy("part", "mark").agg(F.sum("n").alias("n")).where("n <> 0"), "filter-counters")
    discard(spark, place)
    return out


def _exists(spark, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def orders() -> list[tuple[str, int, int, int]]:
    """(order, step, the step's bit, the bits before it) of all steps of all orders."""
    out = []
    for letters in permutations(FILTERS):
        bits = [1 << FILTERS.index(x) for x in letters]
        out += [("".join(letters), k + 1, bits[k], sum(bits[:k])) for k in range(len(bits))]
    return out


def audit(counters: DataFrame) -> DataFrame:
    """One row per part, filter_order and step, from (part, mark, n).

    What a step does depends on its filter and the set of those before it alone: 80 cases a part,
    which are then given to the 600 steps.
    """
    every = (1 << len(FILTERS)) - 1
    steps = counters.sparkSession.createDataFrame(orders(), "filter_order string, step int, bit int, before int")
    cases = sorted({(bit, before) for _, _, bit, before in orders()})
    cases = F.array(*[F.struct(F.lit(bit).alias("bit"), F.lit(before).alias("before")) for bit, before in cases])
    mask, n = F.col("mark").bitwiseAND(every), F.col("n")
    when = lambda condition, value: F.sum(F.when(condition, value).otherwise(0)).cast("long")
    has = lambda column, bits: column.bitwiseAND(bits) != 0
    fails, earlier = has(F.col("mask"), F.col("bit")), has(F.col("mask"), F.col("before"))
    masks = counters.groupBy("part", mask.alias("mask")).agg(
        F.sum(n).alias("n"), when(has(F.col("mark"), F.lit(GOOD)), n).alias("good"), when(has(F.col("mark"), F.lit(TOXIC)), n).alias("toxic")
    )
    rows = masks.withColumn("case", F.explode(cases)).select("part", "mask", "n", "good", "toxic", "case.*")
    rows = rows.groupBy("part", "bit", "before").agg(
        when(~fails & ~earlier, n).alias("kept"),
        when(fails & ~earlier, n).alias("removed"),
        when(fails & earlier, n).alias("redundant"),
        when(F.col("mask") == F.col("bit"), n).alias("unique_fails"),
        when(fails & ~earlier, F.col("good")).alias("good_lost"),
        when(fails & ~earlier, F.col("toxic")).alias("toxic_lost"),
        when(fails, n * (F.lit(120) / F.bit_count("mask")).cast("long")).alias("shapley"),
    )
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return rows.join(F.broadcast(steps), ["bit", "before"]).select("part", "filter_order", "step", *names)


def audit_filters(
    docs: DataFrame, labels: DataFrame, rows_expected: int, key: str = "doc_id", part: str = "source", text: str = "text"
) -> DataFrame:
    """kept, removed, redundant, unique_fails, good_lost, toxic_lost and shapley of every part, order and step.

    ``docs`` is a stream over the files of documents, ``labels`` a table of ``key``, quality and
    toxic. ``rows_expected`` sizes the state alone; results do not depend on it.
    """
    return audit(part_counters(docs, labels, rows_expected, key, part, text))


def stream_documents(spark, path: str, bytes_per_core: int = BYTES_PER_CORE) -> DataFrame:
    """The Parquet file or folder at ``path`` as a stream whose micro-batches give every core ``bytes_per_core``."""
    size = bytes_per_core * spark.sparkContext.defaultParallelism
    reader = spark.readStream.schema(spark.read.parquet(path).schema).option("maxBytesPerTrigger", str(size))
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")  # only a pattern may name a file alone
