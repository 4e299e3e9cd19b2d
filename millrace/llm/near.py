"""Near-duplicate documents by HyperMinHash.

A document is the set of its distinct word shingles. Each shingle's hash falls into one of
``REGISTERS`` buckets, and a bucket keeps of its smallest hash the count of leading zeros and the
``MANTISSA`` bits after them: 16 bits in all. Documents with equal sets form a class. A sketch
has the registers of ``SEEDS``, independent hashes, which all count for the estimate. For the
bands the first one's registers are folded in twos, which is what half as many buckets would hold, and an empty
one takes the value of another, chosen by a fixed sequence of its own, so that registers of small
sets agree as often as those of large ones. Classes that agree in one of ``BANDS`` bands are
candidates. Two sets of similarity 0.8 share no band of 32 with a probability of 5e-8.

1. Stars: the class that shares bands with most others is the centre of a band, and every class is
   measured on the full sets against the best centre of its bands; links join classes into
   components. Copies of one text hang together by that text, so a family is one component after
   some comparisons for each member. What is left open has a second star.
2. Bands: only classes of different components are compared further, each pair in the first band
   it shares. Ruled out are, in this order, sizes that differ too much, distances to a common
   centre that differ by more than two linked classes' may (Jaccard distance is a metric), and
   registers whose estimate, less the agreement expected by chance, is ``SIGMAS`` standard
   deviations too low. Bands of more than ``BLOCK`` classes are dealt out as pairs of blocks. Pairs
   are looked at inside a task; only those that pass leave it, and are measured on the full sets.

So no pair is measured twice but those of a class and its centre, and nothing is capped.

Defined results: a null or empty text, or one without words, has an empty set and is linked with
nothing; a text of fewer words than a shingle is one shingle; texts of any length are taken whole;
repeated rows are copies; a null key is nobody's representative unless all keys of its component
are null. Sets are of 64-bit hashes of shingles. No rows give no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.arrays import LOWER, mix, slices, span_hash, utf8, windows, words
from millrace.llm.graph import components
from millrace.llm.shared_files import discard, stored
from millrace.session import scratch_path

REGISTERS = 256
SEEDS = (0x1F3D5B79, 0x6C8E9CF5)
MANTISSA = 10
FOLD = 2
BAND = 4
BANDS = REGISTERS // FOLD // BAND
SIGMAS = 6
STARS = 2
BLOCK = 1024
_BUCKET_BITS = 8
_VALUE_BITS = 64 - _BUCKET_BITS
_PAIRS = 1 << 16  # looked at together


def shingle_sets(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct shingles of every text, and the text each is of, ascending."""
    data, offsets = utf8(column)
    data = LOWER[data]
    word = words(data, offsets)
    hashes = span_hash(data, word.start, word.end)
    shingle, first = windows(hashes, word.doc, size)
    doc = word.doc[first]
    counts = np.bincount(word.doc, minlength=len(column))
    for n in range(1, size):
        few, start = windows(hashes, word.doc, n)
        own = counts[word.doc[start]] == n
        shingle, doc = np.concatenate([shingle, few[own]]), np.concatenate([doc, word.doc[start][own]])
    _, at = np.unique(mix(shingle ^ mix(doc.astype(np.uint64) + np.uint64(1))), return_index=True)
    order = at[np.argsort(doc[at], kind="stable")]
    return shingle[order], doc[order]


def _sums(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, np.uint64)
    if len(doc):
        first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
        out[doc[first]] = np.add.reduceat(values, first)
    return out


def registers(shingle: np.ndarray, doc: np.ndarray, n: int, seed: int = SEEDS[0]) -> np.ndarray:
    """The registers of n sets: 0 if empty, else leading zeros and mantissa of the least hash."""
    value = mix(shingle + np.uint64(seed))
    empty = np.uint64(2**64 - 1)
    least = np.full(n * REGISTERS, empty, np.uint64)
    np.minimum.at(least, doc * REGISTERS + (value >> np.uint64(_VALUE_BITS)).astype(np.int64), value & np.uint64(2**_VALUE_BITS - 1))
    length = np.zeros(len(least), np.int64)  # bits of the value
    rest = least.copy()
    for step in (32, 16, 8, 4, 2, 1):
        big = rest >= np.uint64(1 << step)
        length[big] += step
        rest[big] >>= np.uint64(step)
    length += rest > 0
    zeros = _VALUE_BITS - np.minimum(length, _VALUE_BITS)
    below = np.maximum(length - 1, 0)  # bits after the first one
    aligned = least << (np.uint64(63) - np.minimum(below, 63).astype(np.uint64)) << np.uint64(1)
    out = (zeros << MANTISSA) + (aligned >> np.uint64(64 - MANTISSA)).astype(np.int64) + 1
    out[least == empty] = 0
    return out.astype(np.uint16).reshape(n, REGISTERS)


def folded(values: np.ndarray) -> np.ndarray:
    """The registers of ``FOLD`` times fewer buckets: of each few the first in use, and which it is."""
    few = values.reshape(len(values), -1, FOLD).astype(np.uint32)
    first = (few > 0).argmax(axis=2)
    found = np.take_along_axis(few, first[:, :, None], axis=2)[:, :, 0]
    return np.where(found > 0, found + (first.astype(np.uint32) << np.uint32(16)), 0).astype(np.uint32)


def filled(values: np.ndarray) -> np.ndarray:
    """Rows of registers with each empty one replaced: bucket by bucket of a fixed random sequence
    is looked at until one is in use. Rows without any register in use stay empty."""
    out, size = values.copy(), values.shape[1]
    row, bucket = np.nonzero((values == 0) & values.any(axis=1)[:, None])
    attempt = 0
    while len(row):
        attempt += 1
        other = mix(np.uint64(attempt) * np.uint64(size) + np.arange(size, dtype=np.uint64)) % np.uint64(size)
        found = values[row, other[bucket].astype(np.int64)]
        out[row, bucket] = found
        row, bucket = row[found == 0], bucket[found == 0]
    return out


def band_keys(values: np.ndarray) -> np.ndarray:
    """A hash of each band of every row of registers, with the band's number in it."""
    part = filled(folded(values[:, :REGISTERS])).astype(np.uint64).reshape(len(values), BANDS, BAND)
    key = np.tile(np.arange(1, BANDS + 1, dtype=np.uint64), (len(values), 1))
    for c in range(BAND):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + part[:, :, c])
    return key


def chance_agreement() -> float:
    """The probability that the registers of two different random hashes agree."""
    zeros = np.arange(1, _VALUE_BITS)
    return float(np.sum((0.5**zeros) ** 2) / 2**MANTISSA)


def similarity(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Collision-corrected estimate of Jaccard for rows of registers, and registers in use."""
    used = ((a > 0) | (b > 0)).sum(axis=1)
    share = ((a == b) & (a > 0)).sum(axis=1) / np.maximum(used, 1)
    chance = chance_agreement()
    return np.clip((share - chance) / (1 - chance), 0, 1), used


def _sketch(docs: DataFrame, size: int) -> DataFrame:
    """key, n, cid (16 bytes that name the set) and registers of every text; none if empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            for a, b in slices(utf8(column)[1]):
                n = b - a
                shingle, doc = shingle_sets(column.slice(a, n), size)
                count = np.bincount(doc, minlength=n).astype(np.int64)
                name = np.stack([_sums(mix(shingle + np.uint64(k)), doc, n) for k in (11, 12)], axis=1)
                values = np.concatenate([registers(shingle, doc, n, seed) for seed in SEEDS], axis=1)
                fixed = lambda x: pa.FixedSizeBinaryArray.from_buffers(pa.binary(x.shape[1] * x.itemsize), n, [None, pa.py_buffer(x.tobytes())]).cast(pa.binary())
                rows = [batch.column(0).slice(a, n), pa.array(count), fixed(name), fixed(values)]
                yield pa.RecordBatch.from_arrays(rows, ["key", "n", "cid", "registers"])

    kind = docs.schema["key"].dataType.simpleString()
    return docs.mapInArrow(run, f"key {kind}, n long, cid binary, registers binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, len(SEEDS) * REGISTERS)


def _bands(classes: DataFrame) -> DataFrame:
    """(band, place, cid, n): a row for each band of a class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_matrix(batch.column(2))).view(np.int64)
            for place in range(BANDS):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[:, place]), pa.array(np.full(len(keys), place, np.int32)), batch.column(0), batch.column(1)], ["band", "place", "cid", "n"]
                )

    return classes.select("cid", "n", "registers").mapInArrow(run, "band long, place int, cid binary, n long")


def _sets(docs: DataFrame, size: int) -> DataFrame:
    """(cid, members): the hashes of each set, ascending, 8 bytes each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            for a, b in slices(utf8(column)[1]):
                n = b - a
                shingle, doc = shingle_sets(column.slice(a, n), size)
                name = np.stack([_sums(mix(shingle + np.uint64(k)), doc, n) for k in (11, 12)], axis=1)
                edge = np.searchsorted(doc, np.arange(n + 1))
                members = [np.sort(shingle[edge[i] : edge[i + 1]]).tobytes() for i in range(n)]
                yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in name], pa.binary()), pa.array(members, pa.binary())], ["cid", "members"])

    return docs.mapInArrow(run, "cid binary, members binary").dropDuplicates(["cid"])


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, both, either): the sizes of the intersection and the union of the full sets of pairs (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both, either = [], []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both.append(len(np.intersect1d(x, y, assume_unique=True)))
                either.append(len(x) + len(y) - both[-1])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(both, pa.int64()), pa.array(either, pa.int64())], ["a", "b", "both", "either"])

    one = lambda c: sets.select(F.col("cid").alias(c), F.col("members").alias(f"m{c}"))
    rows = pairs.select("a", "b").join(one("a"), "a").join(one("b"), "b").select("a", "b", "ma", "mb")
    return rows.mapInArrow(run, "a binary, b binary, both long, either long")


def _fit(a: Column, b: Column, percent: int) -> Column:
    """Sets of these sizes can be that similar."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


class _Tables:
    """The tables of one run, in one folder each."""

    def __init__(self, spark: SparkSession):
        self.spark, self.home, self.count = spark, scratch_path(spark, "near"), 0

    def store(self, df: DataFrame, label: str) -> DataFrame:
        self.count += 1
        return stored(df, path=f"{self.home}/work/{label}-{self.count}")

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Of tables that the result is read from."""
        return stored(df, path=f"{self.home}/{label}")

    def discard(self) -> None:
        discard(self.spark, f"{self.home}/work")


def _merged(labels: DataFrame | None, links: DataFrame, tables: _Tables) -> DataFrame:
    """(node, label) after new ``links`` (a, b): only the labels they join are worked on."""
    if labels is None:
        return components(links)
    ends = links
    for side in ("a", "b"):
        own = labels.select(F.col("node").alias(side), F.col("label").alias(f"{side}_label"))
        ends = ends.join(own, side, "left").withColumn(f"{side}_label", F.coalesce(f"{side}_label", side))
    joined = components(ends.select(F.col("a_label").alias("a"), F.col("b_label").alias("b")))
    renamed = joined.select(F.col("node").alias("label"), F.col("label").alias("least"))
    old = labels.join(renamed, "label", "left").select("node", F.coalesce("least", "label").alias("label"))
    return tables.store(old.unionByName(joined.join(labels, "node", "left_anti")), "labels")


def _labelled(rows: DataFrame, labels: DataFrame | None, node: str, name: str) -> DataFrame:
    if labels is None:
        return rows.withColumn(name, F.col(node))
    own = labels.select(F.col("node").alias("__node"), F.col("label").alias(name))
    return rows.join(own, F.col(node) == F.col("__node"), "left").withColumn(name, F.coalesce(name, node)).drop("__node")


def _stars(members: DataFrame, sets: DataFrame, percent: int, tables: _Tables) -> tuple[DataFrame | None, DataFrame]:
    """The labels after the stars, and (cid, pivot, distance) of the first one."""
    labels, pivots, open_ = None, None, members
    for _ in range(STARS):
        heads = open_.groupBy("band").agg(F.max(F.struct("score", F.col("cid").alias("head"), F.col("n").alias("length"))).alias("at")).select("band", "at.head", "at.length", F.col("at.score").alias("rank"))
        rows = tables.store(open_.join(tables.store(heads, "heads"), "band"), "open")
        pairs = rows.where((F.col("cid") != F.col("head")) & _fit(F.col("n"), F.col("length"), percent))
        pairs = pairs.groupBy(F.col("cid").alias("a")).agg(F.max(F.struct("rank", "head")).alias("best")).select("a", F.col("best.head").alias("b"))
        measured = tables.store(_measured(pairs, sets), "measured")
        if pivots is None:
            pivots = measured.select(F.col("a").alias("cid"), F.col("b").alias("pivot"), (1 - F.col("both") / F.col("either")).alias("distance"))
        links = measured.where(F.col("both") * 100 >= F.col("either") * percent).select("a", "b")
        if not links.isEmpty():
            labels = _merged(labels, links, tables)
        open_ = _labelled(_labelled(rows, labels, "cid", "own"), labels, "head", "other").where("own <> other").select(*members.columns)
        open_ = tables.store(open_, "open")
        if open_.isEmpty():
            break
    return labels, pivots


def _candidates(rows: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) of classes that may be linked, from the rows of each (band, i, j); every pair once."""
    share = percent / 100

    def whole(table: pa.Table) -> Iterator[pa.RecordBatch]:
        group = np.stack([table.column(c).to_numpy() for c in ("band", "i", "j")])
        place, own, n = (table.column(c).to_numpy() for c in ("place", "own", "n"))
        inner = table.column("i").to_numpy() == table.column("j").to_numpy()
        code = lambda c: table.column(c).combine_chunks().dictionary_encode().indices
        label, pivot = code("label").to_numpy(), code("pivot").fill_null(-1).to_numpy()
        distance = table.column("distance").fill_null(0.0).to_numpy()
        cid = table.column("cid").combine_chunks()
        values = _matrix(table.column("registers").combine_chunks())
        keys = band_keys(values)
        new = np.flatnonzero(np.append(True, (group[:, 1:] != group[:, :-1]).any(axis=0)))
        end = np.repeat(np.append(new[1:], len(n)), np.diff(np.append(new, len(n))))
        partners = end - 1 - np.arange(len(n))
        upto = np.concatenate([[0], np.cumsum(partners)])
        for lo in range(0, int(upto[-1]), _PAIRS):  # pair number p is of row x and its partner p - upto[x]
            p = np.arange(lo, min(lo + _PAIRS, int(upto[-1])))
            x = np.searchsorted(upto, p, "right") - 1
            y = x + 1 + p - upto[x]
            ok = (label[x] != label[y]) & (inner[x] | (own[x] != own[y]))
            ok &= np.minimum(n[x], n[y]) * 100 >= np.maximum(n[x], n[y]) * percent
            ok &= (pivot[x] < 0) | (pivot[x] != pivot[y]) | (np.abs(distance[x] - distance[y]) <= 1 - share + 1e-9)
            x, y = x[ok], y[ok]
            first = (keys[x] == keys[y]).argmax(axis=1) == place[x]
            x, y = x[first], y[first]
            guess, used = similarity(values[x], values[y])
            either = (n[x] + n[y]) / (1 + share)  # of two sets that are just similar enough
            left = np.clip(1 - used / len(SEEDS) / either, 0, 1)  # registers are drawn without replacement
            margin = SIGMAS * np.sqrt(share * (1 - share) * left / np.maximum(used, 1)) + 2 / np.maximum(used, 1)
            keep = guess >= share - margin
            if keep.any():
                yield pa.RecordBatch.from_arrays([cid.take(pa.array(x[keep])), cid.take(pa.array(y[keep]))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < 4 * BLOCK:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            last = np.flatnonzero(np.any([table.column(c).to_numpy() != table.column(c)[-1].as_py() for c in ("band", "i", "j")], axis=0))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield from whole(table.slice(0, cut).combine_chunks())
            held, size = table.slice(cut).to_batches(), table.num_rows - cut
        if held:
            yield from whole(pa.Table.from_batches(held).combine_chunks())

    rows = rows.repartition("band", "i", "j").sortWithinPartitions("band", "i", "j")
    return rows.mapInArrow(run, "a binary, b binary")


def _links(members: DataFrame, classes: DataFrame, sets: DataFrame, percent: int, tables: _Tables) -> DataFrame | None:
    """(node, label) of all classes that are linked with others, or None."""
    labels, pivots = _stars(members, sets, percent, tables)
    rows = tables.store(_labelled(members.drop("score", "n"), labels, "cid", "label"), "members")
    split = rows.groupBy("band").agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low <> high").select("band")
    rows = rows.join(tables.store(split, "split"), "band")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    own, other = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int"), F.col("other")
    rows = rows.withColumn("blocks", blocks).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("band", F.least("own", other).alias("i"), F.greatest("own", other).alias("j"), "place", "own", "cid", "label")
    rows = rows.join(classes.select("cid", "n", "registers"), "cid").join(pivots, "cid", "left")
    pairs = tables.store(_candidates(rows, percent), "pairs")
    links = tables.store(_measured(pairs, sets), "measured").where(F.col("both") * 100 >= F.col("either") * percent).select("a", "b")
    return labels if links.isEmpty() else _merged(labels, links, tables)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """``key``, n_shingles, component_id (the smallest key reachable) and kept of every row."""
    tables = _Tables(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    sketch = tables.keep(_sketch(rows, size), "sketch")
    classes = sketch.where("n > 0").groupBy("cid").agg(F.min("key").alias("rep"), F.first("n").alias("n"), F.first("registers").alias("registers"))
    classes = tables.store(classes, "classes")
    bands = tables.store(_bands(classes), "bands")
    shared = tables.store(bands.groupBy("band").agg(F.count("*").alias("size")).where("size > 1"), "shared")
    members = tables.store(bands.join(shared, "band"), "members")
    score = tables.store(members.groupBy("cid").agg(F.sum("size").alias("score")), "score")
    members = tables.store(members.join(score, "cid"), "members")
    wanted = classes.join(score, "cid", "left_semi").select(F.col("rep").alias("key"))
    sets = tables.store(_sets(rows.join(wanted, rows["key"].eqNullSafe(wanted["key"]), "left_semi"), size), "sets")
    labels = _links(members, classes, sets, percent, tables)
    named = classes.select("cid", "rep")
    if labels is not None:
        joined = named.join(labels.withColumnRenamed("node", "cid"), "cid")
        least = joined.groupBy("label").agg(F.min("rep").alias("least"))
        joined = joined.join(tables.store(least, "least"), "label").select("cid", "least")
        named = named.join(joined, "cid", "left").select("cid", F.coalesce("least", "rep").alias("rep"))
    named = tables.keep(named, "named")
    tables.discard()
    out = sketch.select("key", "n", "cid").join(named, "cid", "left")
    component = F.when(F.col("n") > 0, F.col("rep")).otherwise(F.col("key"))
    return out.select(
        F.col("key").alias(key), F.col("n").alias("n_shingles"), component.alias("component_id"), component.eqNullSafe(F.col("key")).alias("kept")
    )
