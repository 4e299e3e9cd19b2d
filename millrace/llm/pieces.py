"""SentencePiece encoding by a table of distinct chunks, and decoding by a table of pieces.

Encoding: a space becomes the marker, and one is put before the text. A chunk is a run of markers
and the characters up to the next run. If no piece of the model has a marker after another
character, no merge crosses the border of two chunks, so a text's pieces are those of its chunks
one after the other. The chunks of a slice of texts are one Arrow array that shares the texts'
bytes; its dictionary is the table of distinct chunks. Those the worker has not met are segmented
once by the library; ids then go back to every position at once, by offsets.

The table is a worker's own and bounded by bytes (``TABLE_BYTES``; a full one is emptied), not one
for the whole corpus: distinct chunks grow almost as fast as the text, so a corpus-wide table can
neither be broadcast nor joined without shuffling every text once more. One narrow pass, no
shuffle; memory per task is that of the table and a few times a slice of texts or its longest text.

Decoding: every id is the bytes of its piece, controls have none, the first marker goes. Rows that
byte pieces leave no valid UTF-8, or with controls inside, are given to the library.

Defined results: a null or empty text has the begin and end ids alone and decodes to the empty
text; null ids decode to the empty text; U+2581 in a text is a marker, as in the library, so it
decodes to a space; keys may be null or repeat, each row is encoded for itself; no rows give no
rows. Encoding reads only key and text; decoding keeps the columns of its input, but one
named like its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from millrace.llm.arrays import slices, utf8

MARK = "▁"
TABLE_BYTES = 32 << 20
_ENTRY = 150  # bytes a table entry takes beside its chunk and ids


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every range, one range after the other."""
    ends = np.cumsum(length)
    return np.repeat(start - ends + length, length) + np.arange(ends[-1] if len(ends) else 0)


def chunks(column: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray]:
    """The chunks of all texts, each with its leading spaces, and the text each is of."""
    column = pc.replace_substring(column.cast(pa.large_string()).fill_null(""), MARK, " ")
    full = np.flatnonzero(pc.binary_length(column).to_numpy() > 0)
    wide = lambda text: pa.scalar(text, pa.large_string())
    data, offsets = utf8(pc.binary_join_element_wise(wide(""), column.take(pa.array(full)), wide(" ")))
    space = data == 32
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[offsets[:-1]] = True
    start = np.flatnonzero(first)
    edges = np.append(start, len(data))
    array = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(edges.astype(np.int64)), pa.py_buffer(data))
    return array, full[np.searchsorted(offsets, start, "right") - 1] if len(start) else full[:0]


class ChunkTable:
    """The ids of every distinct chunk met so far."""

    def __init__(self, model: str, limit: int = TABLE_BYTES):
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        self.limit = limit
        self.begin, self.end = self.library.bos_id(), self.library.eos_id()
        self._check()
        self._clear()

    def _check(self) -> None:
        """The model is one that chunks may be cut for."""
        one, probe = self.library, f"  a {MARK}b ﬁ ① "
        pieces = map(one.id_to_piece, range(one.get_piece_size()))
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces):
            raise ValueError("pieces of this model cross white-space markers")
        if one.is_unknown(self._mark()) or one.decode(one.encode(probe)) != probe.replace(MARK, " "):
            raise ValueError("this model changes texts before it cuts them into pieces")
        if min(self.begin, self.end) < 0:
            raise ValueError("this model has no begin or end id")

    def _mark(self) -> int:
        return self.library.piece_to_id(MARK)

    def _clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.held = 0
        self.ids, self.used = np.zeros(1 << 16, np.uint32), 0
        self.start, self.length = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)

    def _add(self, new: list[str]) -> None:
        found = self.library.encode([c[1:] for c in new], num_threads=1)
        found = [ids if len(c) > 1 else [self._mark()] for c, ids in zip(new, found)]
        length = np.fromiter(map(len, found), np.int64, len(found))
        total, n = int(length.sum()), len(self.rows)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while n + len(new) > len(self.start):
            self.start, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.length))
        self.ids[self.used : self.used + total] = np.fromiter((i for ids in found for i in ids), np.uint32, total)
        self.start[n : n + len(new)] = self.used + np.cumsum(length) - length
        self.length[n : n + len(new)] = length
        self.used += total
        self.rows.update(zip(new, range(n, n + len(new))))
        self.held += sum(map(len, new)) + 4 * total + _ENTRY * len(new)

    def find(self, distinct: list[str]) -> np.ndarray:
        """The table's row of every chunk; chunks not in it are segmented first."""
        if self.held > self.limit:
            self._clear()
        new = [c for c in distinct if c not in self.rows]
        if new:
            self._add(new)
        return np.fromiter(map(self.rows.__getitem__, distinct), np.int64, len(distinct))

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, begin and end ids among them, and the n + 1 offsets."""
        array, doc = chunks(column)
        table = array.dictionary_encode()
        rows = self.find(table.dictionary.to_pylist())[table.indices.to_numpy()]
        length = self.length[rows]
        n = len(column)
        count = np.bincount(doc, length, minlength=n).astype(np.int64) + 2
        offsets = np.concatenate([[0], np.cumsum(count)])
        out = np.full(offsets[-1], self.end, np.uint32)
        inner = np.ones(len(out), bool)
        inner[offsets[:-1]] = inner[offsets[1:] - 1] = False
        out[offsets[:-1]] = self.begin
        out[inner] = self.ids[ragged(self.start[rows], length)]
        return out, offsets


class PieceTable:
    """The bytes of every id."""

    def __init__(self, model: str):
        one = self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        size = one.get_piece_size()
        self.control = np.array([one.is_control(i) for i in range(size)])
        self.marked = np.zeros(size, bool)
        pieces = []
        for i in range(size):
            piece = one.id_to_piece(i)
            if one.is_control(i):
                pieces.append(b"")
            elif one.is_unknown(i):
                pieces.append(one.decode([i]).encode())
            elif one.is_byte(i):
                pieces.append(bytes([int(piece[3:5], 16)]))
            else:
                self.marked[i] = piece.startswith(MARK)
                pieces.append(piece.replace(MARK, " ").encode())
        self.length = np.array([len(p) for p in pieces])
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(pieces), np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        n = len(offsets) - 1
        if not len(ids):
            return [""] * n
        row = np.repeat(np.arange(n), np.diff(offsets))
        ids = ids.astype(np.int64)
        shown = np.flatnonzero(~self.control[ids])
        head = shown[np.flatnonzero(np.diff(row[shown], prepend=-1))]  # a row's first shown id
        start, length = self.start[ids], self.length[ids]
        cut = head[self.marked[ids[head]]]
        start[cut] += 1
        length[cut] -= 1
        data = self.data[ragged(start, length)]
        edges = np.concatenate([[0], np.cumsum(np.bincount(row, length, minlength=n).astype(np.int64))])
        inside = self.control[ids]
        inside[offsets[:-1][np.diff(offsets) > 0]] = inside[offsets[1:][np.diff(offsets) > 0] - 1] = False
        odd = set(row[inside].tolist())
        raw, out = data.tobytes(), []
        for k, (a, b) in enumerate(zip(edges[:-1].tolist(), edges[1:].tolist())):
            try:
                text = None if k in odd else raw[a:b].decode()
            except UnicodeDecodeError:
                text = None
            out.append(self.library.decode(ids[offsets[k] : offsets[k + 1]].tolist()) if text is None else text)
        return out


@lru_cache(maxsize=2)
def _chunk_table(model: str) -> ChunkTable:
    return ChunkTable(model)


@lru_cache(maxsize=2)
def _piece_table(model: str) -> PieceTable:
    return PieceTable(model)


def _binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]).cast(pa.binary())


def encode_pieces(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, n_tokens and ids (little-endian unsigned 32-bit integers) of every text.

    ``model`` is the path of a sentencepiece model on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _chunk_table(model)
        for batch in batches:
            column = batch.column(1)
            for a, b in slices(utf8(column)[1]):
                ids, offsets = table.encode(column.slice(a, b - a))
                found = _binary(ids.astype("<u4", copy=False).view(np.uint8), 4 * offsets)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(offsets)), found], ["key", "n_tokens", "ids"])

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {kind}, n_tokens long, ids binary").withColumnRenamed("key", key)


def decode_pieces(rows: DataFrame, model: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """The columns of ``rows`` and ``decoded``, the text of the ids as ``encode_pieces`` gives them."""
    kept = [c for c in rows.columns if c != decoded]
    at = kept.index(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _piece_table(model)
        for batch in batches:
            column = batch.column(at).cast(pa.large_binary()).fill_null(b"")
            whole = np.concatenate([[0], np.cumsum(pc.binary_length(column).to_numpy())])
            for a, b in slices(whole):
                part = column.slice(a, b - a)
                raw = np.frombuffer(part.buffers()[2] or b"", np.uint8)
                edge = np.frombuffer(part.buffers()[1], np.int64)[part.offset : part.offset + len(part) + 1]
                found = table.decode(raw[edge[0] : edge[-1]].view("<u4"), (edge - edge[0]) // 4)
                own = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([*own.columns, pa.array(found, pa.string())], [*own.schema.names, decoded])

    source = rows.select(*[F.col(f"`{c}`") for c in kept])
    return source.mapInArrow(run, StructType([*source.schema, StructField(decoded, StringType())]))
