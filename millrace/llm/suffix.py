"""Exact substring deduplication over suffixes sampled by a difference cover.

The symbols are not bytes but phrases: a text is cut where a 16-byte gram has the least hash of
``WINDOW`` grams in a row. Such cuts depend on the bytes around them alone, so equal strings are
cut alike wherever they stand, and a string of ``LEAST`` bytes holds five whole phrases in a row.

1. Sampled triples: of the phrase suffixes of a text those whose index is 1 or 2 modulo 3 are
   sampled. {1, 2} is a difference cover: any two suffixes meet a sampled pair after at most two
   steps, and so two equal strings share the triple of a sampled pair. Triples are sorted by
   name and those that occur once are discarded; what is left is about the repeated part of
   the corpus.
2. Remaining suffixes: a byte suffix is merged with the phrase suffix at its anchor, the cut
   with the least gram of its first window, which stands alike in every copy of the string.
   The suffixes of one anchor are a range of distances from it.
3. Recursion on names: a range has two names. Its core is what all its prefixes share; if
   no other range at that distance has that core, none of them repeats, and the range is
   discarded. Its hull is what they cover together; if another range has that hull, all of them
   repeat. Otherwise the range is cut into eighths, whose names are longer in the core and shorter
   in the hull, down to single suffixes, where core and hull are the prefix itself.
4. Adjacent prefixes: names are 128 bits of two independent hashes, compared by grouping equal
   ones, so a prefix that a third of all documents share is counted in each task first. Ranges
   already known to repeat stay as one representative for each hull while others need them.

Names stand for ranks: only the equality of prefixes is asked for, not their order.

Defined results: a null text is an empty one; texts below ``least`` bytes lose nothing; rows that
are equal in key and text are documents of their own and so remove each other; other columns
are not read. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import OTHER, mix, powers, span_hash, utf8, windows
from millrace.llm.shared_files import discard, stored
from millrace.session import scratch_path

LEAST = 400
GRAM = 16
WINDOW = 64
PARTS = 8  # that a range is cut into, a power of two as the window
_CHUNK = 1 << 20
_LOW = np.uint64(0xFFFFFFFF)


def window_for(least: int) -> int:
    """The longest window with five whole phrases in any string of ``least`` bytes."""
    window = WINDOW
    while window > 8 and least - (2 * window + GRAM - 2) < 4 * window + 1:
        window //= 2
    if least - (2 * window + GRAM - 2) < 4 * window + 1:
        raise ValueError(f"strings of {least} bytes are too short for phrases")
    return window


def parse(data: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The anchor of the window that starts at each byte; ascending."""
    starts = len(data) - window - GRAM + 2
    out = [np.zeros(0, np.int64)]
    up, down = powers(_CHUNK + window + GRAM)
    for lo in range(0, max(starts, 0), _CHUNK):
        part = data[lo : lo + _CHUNK + window + GRAM - 2]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[: len(part)], out=sums[1:])
        grams = mix((sums[GRAM:] - sums[:-GRAM]) * down[: len(part) - GRAM + 1])
        least = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64)  # of equal grams the first
        size = 1
        while size < window:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        out.append((least & _LOW).astype(np.int64) + lo)
    return np.concatenate(out)


def triples(data: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of the phrase triples at sampled indexes, and the indexes."""
    phrases = span_hash(data, cuts[:-1], cuts[1:])
    names, index = windows(phrases, np.zeros(len(phrases), np.int64), 3)
    sampled = index % 3 != 0
    return names[sampled], index[sampled]


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    data, offsets = utf8(batch.column(batch.schema.get_field_index("text")))
    for k in range(len(batch)):
        yield k, data[offsets[k] : offsets[k + 1]]


def _rows(batch: pa.RecordBatch, who: list[int], lengths: list[int], names: list[str], columns: list[np.ndarray]) -> pa.RecordBatch:
    """A batch of key and h of the texts ``who``, each repeated, and ``columns``."""
    take = pa.array(np.repeat(np.array(who, np.int64), lengths))
    ids = [batch.column(batch.schema.get_field_index(c)).take(take) for c in ("key", "h")]
    return pa.RecordBatch.from_arrays([*ids, *map(pa.array, columns)], ["key", "h", *names])


def _join(parts: list[np.ndarray], kind=np.int64) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *parts])


def _sampled(docs: DataFrame, kind: str, least: int, window: int) -> DataFrame:
    """(key, h, name, place) of every sampled phrase triple."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, lengths, names, places = [], [], [], []
            for k, data in _texts(batch):
                if len(data) >= least:
                    name, place = triples(data, np.unique(parse(data, window)))
                    who.append(k)
                    lengths.append(len(name))
                    names.append(name)
                    places.append(place)
            yield _rows(batch, who, lengths, ["name", "place"], [_join(names, np.uint64).view(np.int64), _join(places)])

    return docs.mapInArrow(run, f"key {kind}, h long, name long, place long")


def _ranges(data: np.ndarray, places: np.ndarray, least: int, window: int) -> tuple[np.ndarray, ...]:
    """anchor, first and last start of the ranges that may repeat.

    A copy of a string shares all phrases from its anchor to the first cut at or after ``span``
    bytes. So for one of the two sampled classes, the one that meets sampled suffixes of the
    copy, every triple among those phrases is a repeated one.
    """
    anchor = parse(data, window)
    cuts, low = np.unique(anchor, return_index=True)
    high = np.minimum(np.append(low[1:], len(anchor)) - 1, len(data) - least)
    span = least - (window + GRAM - 1) - (window - 1)
    index = np.arange(len(cuts))
    after = np.searchsorted(cuts, cuts + span) - 2  # beyond the last triple
    good = np.zeros(len(cuts), bool)
    for residue in (1, 2):
        sampled, found = (np.zeros(len(cuts) + 1, np.int64) for _ in range(2))
        sampled[1:] = np.cumsum(index % 3 == residue)
        found[1:] = np.cumsum(np.bincount(places[places % 3 == residue], minlength=len(cuts))[: len(cuts)])
        top = np.clip(after, index, len(cuts))
        wanted = sampled[top] - sampled[index]
        good |= (wanted > 0) & (found[top] - found[index] == wanted)
    good &= low <= high
    return cuts[good], low[good], high[good]


def _names(data: np.ndarray, anchor: np.ndarray, step: np.ndarray, width: int, least: int) -> list[np.ndarray]:
    """Core and hull of the starts anchor - step - width + 1 to anchor - step, two hashes each,
    and whether the text has all of the hull."""
    last = anchor - step
    order = np.argsort(last, kind="stable")
    at = last[order]
    whole = (at - width + 1 >= 0) & (at + least <= len(data))
    out = []
    for start, end in ((at, at - width + 1 + least), (np.maximum(at - width + 1, 0), np.minimum(at + least, len(data)))):
        for numbers in (None, OTHER):
            value = np.empty(len(at), np.uint64)
            value[order] = span_hash(data, start, end, numbers)
            out.append(value.view(np.int64))
    full = np.empty(len(at), bool)
    full[order] = whole
    return [*out, full]


_FIELDS = ["anchor", "low", "high", "step", "known", "c1", "c2", "h1", "h2", "whole"]


def _named(texts: DataFrame, kind: str, width: int, parts: int, least: int, window: int, first: bool) -> DataFrame:
    """The ranges of each text at one width with their names. ``texts`` has key, h, text and either
    the places of repeated triples (``first``) or the ranges (work) that are cut to this width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            todo = batch.column(batch.schema.get_field_index("places" if first else "work"))
            who, lengths, columns = [], [], [[] for _ in _FIELDS]
            for k, data in _texts(batch):
                if first:
                    anchor, low, high = _ranges(data, todo[k].values.to_numpy(), least, window)
                    step, known = np.zeros(len(anchor), np.int64), np.zeros(len(anchor), bool)
                else:
                    work = todo[k].values
                    anchor, low, high, step, known = (work.field(c).to_numpy(zero_copy_only=False) for c in _FIELDS[:5])
                    step = (np.repeat(step, parts).reshape(-1, parts) + np.arange(parts) * width).ravel()
                    anchor, low, high, known = (np.repeat(x, parts) for x in (anchor, low, high, known))
                # starts of the part that the range has; what it has not is no suffix of this anchor
                inside = (anchor - step >= low) & (anchor - step - width + 1 <= high)
                anchor, low, high, step, known = (x[inside] for x in (anchor, low, high, step, known))
                values = [anchor, low, high, step, known, *_names(data, anchor, step, width, least)]
                for column, x in zip(columns, values):
                    column.append(x)
                who.append(k)
                lengths.append(len(anchor))
            kinds = [np.int64] * 4 + [bool] + [np.int64] * 4 + [bool]
            yield _rows(batch, who, lengths, _FIELDS, [_join(c, t) for c, t in zip(columns, kinds)])

    schema = "anchor long, low long, high long, step long, known boolean, c1 long, c2 long, h1 long, h2 long, whole boolean"
    return texts.mapInArrow(run, f"key {kind}, h long, {schema}")



def _same(a: str, b: str) -> Column:
    return F.col(f"{a}.key").eqNullSafe(F.col(f"{b}.key")) & (F.col(f"{a}.h") == F.col(f"{b}.h"))


def _with_texts(lists: DataFrame, docs: DataFrame, column: str) -> DataFrame:
    return docs.alias("d").join(lists.alias("l"), _same("d", "l")).select("d.key", "d.h", "d.text", f"l.{column}")


def repeated_starts(docs: DataFrame, kind: str, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """(key, h, low, high): ranges of the starts whose ``least`` bytes also start elsewhere; and
    the texts that were looked at. ``docs`` has key, h and text."""
    window = window_for(least)
    spark = docs.sparkSession
    triples_path = scratch_path(spark, "suffix-triples")
    sampled = stored(_sampled(docs, kind, least, window), path=triples_path)
    often = sampled.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    places = sampled.join(often, "name", "left_semi").groupBy("key", "h").agg(F.collect_set("place").alias("places"))
    texts = stored(_with_texts(places, docs, "places"), "suffix-texts")
    discard(spark, triples_path)
    found, work, width, parts = None, None, window, 1
    while True:
        source = texts if work is None else _with_texts(work, texts.drop("places"), "work")
        ranges_path = scratch_path(spark, "suffix-ranges")
        rows = stored(_named(source, kind, width, parts, least, window, work is None), path=ranges_path)
        hulls = rows.where("whole").groupBy("step", "h1", "h2").agg(F.count("*").alias("hulls")).where("hulls > 1")
        cores = rows.groupBy("step", "c1", "c2").agg(F.count("*").alias("cores")).where("cores > 1")
        rows = rows.join(cores, ["step", "c1", "c2"])
        rows = rows.join(hulls, ["step", "h1", "h2"], "left")
        rows = rows.withColumn("settled", F.col("known") | (F.col("whole") & F.col("hulls").isNotNull()))
        rows = stored(rows, "suffix-settled")
        discard(spark, ranges_path)
        low, high = F.greatest("low", F.col("anchor") - F.col("step") - width + 1), F.least("high", F.col("anchor") - F.col("step"))
        fresh = rows.where("settled AND NOT known").select("key", "h", low.alias("low"), high.alias("high"))
        found = fresh if found is None else found.union(fresh)
        if width == 1:
            return found, texts
        open_ = rows.where("NOT settled").select("step", "c1", "c2").distinct()
        if open_.isEmpty():
            return found, texts
        active = rows.join(open_, ["step", "c1", "c2"], "left_semi")
        item = F.struct("anchor", "low", "high", "step", F.col("settled").alias("known"))
        keep = F.struct("key", "h", item.alias("item"))
        one = active.where("settled").groupBy("step", "c1", "c2", "h1", "h2").agg(F.min(keep).alias("keep")).select("keep.*")
        work = active.where("NOT settled").select("key", "h", item.alias("item")).union(one)
        work = stored(work.groupBy("key", "h").agg(F.collect_set("item").alias("work")), "suffix-work")
        parts = min(PARTS, width)
        width //= parts


def _cover(low: np.ndarray, high: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes in a string of ``least`` bytes from any start."""
    order = np.argsort(low, kind="stable")
    low, end = low[order], np.maximum.accumulate(high[order] + least)
    new = np.ones(len(low), bool)
    new[1:] = low[1:] > end[:-1]
    return low[new], end[np.append(np.flatnonzero(new)[1:], len(low)) - 1]


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """``key``, n_bytes, kept (the bytes left, one after another) and spans (start and end of each
    removed run) of every text, without the bytes in a string of ``least`` bytes that occurs again."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), body.alias("text")).select("key", F.xxhash64("text").alias("h"), "text")
    kind = docs.schema[key].dataType.simpleString()
    found, _ = repeated_starts(rows, kind, least)
    found = found.distinct().groupBy("key", "h").agg(F.collect_list(F.struct("low", "high")).alias("starts"))
    joined = rows.alias("d").join(found.alias("f"), _same("d", "f"), "left").select("d.key", "d.text", "f.starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            starts, sizes, kept, spans = batch.column(2), [], [], []
            for k, data in _texts(batch):
                sizes.append(len(data))
                if not starts[k].is_valid:
                    kept.append(data.tobytes())
                    spans.append([])
                    continue
                own = starts[k].values
                a, b = _cover(own.field("low").to_numpy(), own.field("high").to_numpy(), least)
                edge = np.concatenate([[0], np.ravel(np.column_stack([a, b])), [len(data)]])
                kept.append(b"".join(data[x:y].tobytes() for x, y in edge.reshape(-1, 2)))
                spans.append([{"start": int(x), "end": int(y)} for x, y in zip(a, b)])
            arrays = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(kept, pa.binary()), pa.array(spans, span)]
            yield pa.RecordBatch.from_arrays(arrays, ["key", "n_bytes", "kept", "spans"])

    out = joined.mapInArrow(run, f"key {kind}, n_bytes long, kept binary, spans array<struct<start: long, end: long>>")
    return out.withColumnRenamed("key", key)
