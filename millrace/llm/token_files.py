"""Token ids as Arrow stream files of equal-length sequences.

Documents are range-partitioned by key and sorted; each task encodes its documents one after
another, ends each with an end id, cuts the run of ids into sequences of ``length`` and writes
them as batches of two fixed-size-list columns: ids, in the narrowest unsigned type that holds
the vocabulary, and mask, a bit each (false for the padding of a file's last sequence). Every batch is one block of memory, so a reader that maps the file
gets any sequence without a copy. Next to it lies an index stream: key, first id within the
file, and number of ids of every document.

Words are encoded once: the tokeniser drops white space, so the ids of a text are the ids of
its words, and a bounded table of the worker keeps the ids of the words it has met.

Defined results: a null or empty text has the end id alone; null keys come first, as they do
in Spark's ascending order; repeated keys are ordered by a hash of the text; no rows write no
file. Other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from millrace.llm.arrays import slices, span_hash, utf8, words
from millrace.llm.shared_files import open_for_read, open_for_write, stored
from millrace.llm.token_counts import Known
from millrace.session import scratch_path

LENGTH = 2048
SEQUENCES = 64  # in a batch
KNOWN_WORDS = 1 << 21
_LENGTH_BITS = 24


class WordEncoder:
    """Ids of whole texts, put together from those of their words."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        probe = self.tokenizer.encode_batch(["a b", "a  \n\t b", "a", "b"], add_special_tokens=False)
        parts = probe[2].ids + probe[3].ids
        if probe[0].ids != parts or probe[1].ids != parts:
            raise ValueError(f"{path}: white space is part of its tokens, so words cannot be encoded by themselves")
        self.size = max(self.tokenizer.get_vocab().values(), default=0) + 1
        self.known = Known(KNOWN_WORDS)
        self.pool, self.used = np.zeros(1 << 20, np.uint32), 0

    def _learn(self, keys: np.ndarray, texts: list[str]) -> None:
        if len(self.known.keys) + len(keys) > self.known.limit:
            self.used = 0  # the table is about to be emptied
        found = [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        sizes = np.array([len(x) for x in found], np.int64)
        fresh = np.array([i for x in found for i in x], np.uint32)
        need = self.used + len(fresh)
        if need > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(need, np.uint32)])
        self.pool[self.used : need] = fresh
        at = self.used + np.cumsum(sizes) - sizes
        self.used = need
        self.known.add(keys, at << _LENGTH_BITS | sizes)

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and how many each text has."""
        data, offsets = utf8(column)
        word = words(data, offsets)
        keys, at, which = np.unique(span_hash(data, word.start, word.end), return_index=True, return_inverse=True)
        values, missing = self.known.find(keys)
        if missing.any():
            raw = data.tobytes()
            new = at[missing]
            if len(self.known.keys) + missing.sum() > self.known.limit:
                missing[:] = True  # the table starts anew, so all words of this slice are learnt
                new = at
            self._learn(keys[missing], [raw[a:b].decode() for a, b in zip(word.start[new].tolist(), word.end[new].tolist())])
            values, _ = self.known.find(keys)
        start, size = (values >> _LENGTH_BITS)[which], (values & ((1 << _LENGTH_BITS) - 1))[which]
        shift = np.repeat(start - (np.cumsum(size) - size), size)
        ids = self.pool[shift + np.arange(len(shift))]
        return ids, np.bincount(word.doc, size, minlength=len(column)).astype(np.int64)


@lru_cache(maxsize=2)
def _encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _schema(length: int, ids: pa.DataType) -> pa.Schema:
    return pa.schema([("ids", pa.list_(ids, length)), ("mask", pa.list_(pa.bool_(), length))])


class SequenceFile:
    """One stream file and its index, filled document by document."""

    def __init__(self, folder: str, length: int, key: pa.DataType, size: int):
        """``size``: all ids are below it."""
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.schema = _schema(length, pa.from_numpy_dtype(self.kind))
        self.length, self.total, self.held = length, 0, []
        self.path, self.out = open_for_write(folder, ".arrows")
        self.index_path, self.index_out = open_for_write(folder, ".index.arrows")
        self.writer = pa.ipc.new_stream(self.out, self.schema)
        self.index = pa.ipc.new_stream(self.index_out, pa.schema([("key", key), ("start", pa.int64()), ("n", pa.int64())]))

    def add(self, keys: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        start = self.total + np.cumsum(sizes) - sizes
        self.index.write_batch(pa.record_batch([keys, pa.array(start), pa.array(sizes)], names=["key", "start", "n"]))
        self.total += len(ids)
        self.held.append(ids.astype(self.kind))
        block = self.length * SEQUENCES
        if sum(map(len, self.held)) >= block:
            flat = np.concatenate(self.held)
            cut = len(flat) - len(flat) % block
            for lo in range(0, cut, block):
                self._write(flat[lo : lo + block], block)
            self.held = [flat[cut:]]

    def _write(self, ids: np.ndarray, real: int) -> None:
        mask = np.arange(len(ids)) < real
        lists = [pa.FixedSizeListArray.from_arrays(pa.array(x), self.length) for x in (ids, mask)]
        self.writer.write_batch(pa.record_batch(lists, schema=self.schema))

    def close(self) -> None:
        flat = np.concatenate([np.zeros(0, self.kind), *self.held])
        if len(flat):
            padded = np.zeros(-(-len(flat) // self.length) * self.length, self.kind)
            padded[: len(flat)] = flat
            self._write(padded, len(flat))
        for x in (self.writer, self.out, self.index, self.index_out):
            x.close()


def write_sequences(
    docs: DataFrame, folder: str, vocabulary: str, end_id: int, key: str = "doc_id", text: str = "text", length: int = LENGTH
) -> DataFrame:
    """One row per file: part (files in ascending order of keys), path, index_path, n_ids."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text")).withColumn("tie", F.xxhash64("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartitionByRange(parts, "key", "tie").sortWithinPartitions("key", "tie").select("key", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, file = _encoder(vocabulary), None
        for batch in batches:
            column = batch.column(1)
            for a, b in slices(utf8(column)[1]):
                ids, sizes = encoder.encode(column.slice(a, b - a))
                ids = np.insert(ids, np.cumsum(sizes), np.uint32(end_id))
                file = file or SequenceFile(folder, length, batch.schema.field(0).type, max(encoder.size, end_id + 1))
                file.add(batch.column(0).slice(a, b - a), ids, sizes + 1)
        if file is not None:
            file.close()
            yield pa.RecordBatch.from_pylist(
                [{"part": TaskContext.get().partitionId(), "path": file.path, "index_path": file.index_path, "n_ids": file.total}]
            )

    return stored(rows.mapInArrow(run, "part long, path string, index_path string, n_ids long"), "token-files")


def read_documents(files: DataFrame, key: str, kind: str) -> DataFrame:
    """``key``, start (ids before the document in all files), n_tokens and ids_crc32, from the files."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per file
    files = files.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                yield from _documents(row)

    spread = files.repartition(files.sparkSession.sparkContext.defaultParallelism)
    out = spread.select("path", "index_path", "base").mapInArrow(run, f"key {kind}, start long, n_tokens long, ids_crc32 long")
    return out.withColumnRenamed("key", key)


def _documents(file: dict) -> Iterator[pa.RecordBatch]:
    """The documents of one file; batches of ids are read as the index asks for them."""
    with open_for_read(file["path"]) as a, open_for_read(file["index_path"]) as b:
        blocks = ((x.column("ids").flatten().to_numpy(), x.column("mask").flatten().to_numpy(zero_copy_only=False)) for x in pa.ipc.open_stream(a))
        ids = np.zeros(0, np.uint32)
        for entry in pa.ipc.open_stream(b):
            sums = []
            for n in entry.column("n").to_pylist():
                crc = 0
                while n:
                    if not len(ids):
                        flat, mask = next(blocks)
                        ids = flat[: int(mask.sum())]
                    part, ids = ids[:n], ids[n:]
                    crc = zlib.crc32(part.astype("<u4").tobytes(), crc)
                    n -= len(part)
                sums.append(crc)
            start = pa.array(entry.column("start").to_numpy() + file["base"])
            yield pa.RecordBatch.from_arrays(
                [entry.column("key"), start, entry.column("n"), pa.array(sums, pa.int64())], ["key", "start", "n_tokens", "ids_crc32"]
            )


def sequence_round_trip(docs: DataFrame, vocabulary: str, end_id: int, key: str = "doc_id", **options) -> DataFrame:
    """Writes the token files to the shared folder and returns their documents as read back."""
    files = write_sequences(docs, scratch_path(docs.sparkSession, "tokens"), vocabulary, end_id, key, **options)
    return read_documents(files, key, docs.schema[key].dataType.simpleString())
