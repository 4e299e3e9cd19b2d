"""Token counts by byte-pair merging of whole arrays.

A text is cut into chunks (a run of non-space bytes with the one space before it, and what is
left of the white space between). Every distinct chunk of a slice is pre-tokenised once by the
library, its bytes become ragged numpy arrays, and all of them are merged in step: in each
round every sequence applies its own pair of lowest rank, at all its places at once, until no
sequence has a pair left. What survives are the tokens. Chunks seen before are answered from a
bounded table of the worker.

Defined results: a null or empty text has 0 bytes and 0 tokens; keys may repeat or be null, each
row is counted for itself; other columns are not read. Special strings inside a text count as
one token each, as the library does by default.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import slices, span_hash, utf8, words

KNOWN_CHUNKS = 1 << 22
# White space beyond ASCII that the pre-tokeniser's \s knows (fixed values of Unicode).
_WIDE = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
WIDE_SPACE = f"[{''.join(map(chr, _WIDE))}]"
_NONE = np.int64(1 << 60)


class Known:
    """A table from 64-bit hashes to numbers that is emptied when it is full."""

    def __init__(self, limit: int = KNOWN_CHUNKS):
        self.limit = limit
        self.keys, self.values = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Values, and which keys are missing."""
        if not len(self.keys):
            return np.zeros(len(keys), np.int64), np.ones(len(keys), bool)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return self.values[at], self.keys[at] != keys

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """``keys`` ascend and are not in the table."""
        if len(self.keys) + len(keys) > self.limit:
            self.keys, self.values = keys[:0], values[:0]
        at = np.searchsorted(self.keys, keys)
        self.keys, self.values = np.insert(self.keys, at, keys), np.insert(self.values, at, values)


class PairMerger:
    """The merges of a byte-level vocabulary file as sorted arrays."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, added = spec["model"], spec.get("added_tokens", [])
        if model["type"] != "BPE" or spec.get("normalizer") or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path}: only byte-level BPE without a normaliser is supported")
        self.split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.special = [t["content"] for t in added]
        vocab = model["vocab"]
        self.symbol = np.full(1 << 16, -1, np.int64)
        for token, number in vocab.items():
            if len(token) == 1:
                self.symbol[ord(token)] = number
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.rank = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]

    def surviving(self, tokens: list[str]) -> np.ndarray:
        """The number of symbols left of each pre-token."""
        lengths = np.array([len(t) for t in tokens], np.int64)
        flat = self.symbol[np.frombuffer("".join(tokens).encode("utf-16-le"), np.uint16)]
        counts, own = np.zeros(len(tokens), np.int64), np.flatnonzero(lengths)
        lengths = lengths[own]
        while len(own):
            first = np.cumsum(lengths) - lengths
            key = np.full(len(flat), -1, np.int64)
            key[:-1] = flat[:-1] << 32 | flat[1:]
            key[first[1:] - 1] = -1  # no pair across sequences
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where(self.keys[at] == key, self.rank[at], _NONE)
            least = np.minimum.reduceat(rank, first)
            done = least == _NONE
            counts[own[done]] = lengths[done]
            seq = np.repeat(np.arange(len(own)), lengths)
            hit = np.flatnonzero((rank == least[seq]) & ~done[seq])
            # of pairs that overlap, as in a run of one symbol, every other one is taken
            run = np.ones(len(hit), bool)
            run[1:] = hit[1:] != hit[:-1] + 1
            began = hit[np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))] if len(hit) else hit
            hit = hit[(hit - began) % 2 == 0]
            flat[hit] = self.merged[at[hit]]
            stay = ~done[seq]
            stay[hit + 1] = False
            lengths = lengths - np.bincount(seq[hit], minlength=len(own))
            flat, own, lengths = flat[stay], own[~done], lengths[~done]
        return counts

    def count(self, texts: list[str]) -> np.ndarray:
        """Tokens of texts without special strings."""
        pieces = [[t for t, _ in self.split(x)] for x in texts]
        return self._sum([t for p in pieces for t in p], np.repeat(np.arange(len(texts)), list(map(len, pieces))), len(texts))

    def count_chunks(self, chunks: list[str]) -> np.ndarray:
        """The same for chunks, pre-tokenised many at a time.

        A chunk that opens with a space is cut off from what precedes it anyway; a line break
        before every other one does the same, and is itself one pre-token.
        """
        tokens, owner = [], []
        for lo in range(0, len(chunks), 4096):
            part = chunks[lo : lo + 4096]
            opened = np.array([not x.startswith(" ") for x in part])
            starts = np.cumsum([0, *(len(x) + int(o) for x, o in zip(part, opened.tolist()))])[:-1]
            found = self.split("".join("\n" + x if o else x for x, o in zip(part, opened.tolist())))
            at = np.array([span[0] for _, span in found], np.int64)
            own = np.searchsorted(starts, at, "right") - 1
            real = ~(opened[own] & (at == starts[own]))
            tokens += [found[k][0] for k in np.flatnonzero(real).tolist()]
            owner.append(own[real] + lo)
        return self._sum(tokens, np.concatenate([np.zeros(0, np.int64), *owner]), len(chunks))

    def _sum(self, tokens: list[str], owner: np.ndarray, n: int) -> np.ndarray:
        distinct: dict[str, int] = {}
        which = np.array([distinct.setdefault(t, len(distinct)) for t in tokens], np.int64)
        return np.bincount(owner.astype(np.int64), self.surviving(list(distinct))[which], minlength=n).astype(np.int64)

    def count_whole(self, text: str) -> int:
        """Tokens of one text, special strings included, without cutting it into chunks."""
        pieces = [text]
        for token in self.special:
            pieces = _cut(pieces, token)
        plain = [x for x in pieces if x is not None]
        return int(self.count(plain).sum()) + len(pieces) - len(plain)


def _cut(pieces: list, token: str) -> list:
    """Pieces between the places of ``token``; None stands for the token."""
    out = []
    for piece in pieces:
        if piece is None:
            out.append(None)
            continue
        for k, part in enumerate(piece.split(token)):
            out += [None, part] if k else [part]
    return out


@lru_cache(maxsize=2)
def _worker(path: str) -> tuple[PairMerger, Known]:
    return PairMerger(path), Known()


def _chunks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans whose tokens can be counted one by one, as the pre-tokeniser cuts at them anyway.

    White space before a word is a token without its last character, which joins the word if
    it is a space and else is a token; at the end of a text all of it is one token.
    """
    word = words(data, offsets)
    n = len(word.start)
    opening = np.ones(n, bool)
    opening[1:] = word.doc[1:] != word.doc[:-1]
    gap = np.where(opening, offsets[word.doc], np.concatenate([[0], word.end[:-1]]) if n else word.end)
    spaced = (word.start > gap) & (data[word.start - 1] == 32)
    head = word.start - spaced
    lone = (word.start > gap) & ~spaced
    rest = word.start - 1 > gap
    last = offsets[:-1].copy()
    last[word.doc] = word.end  # ascending, so the last word of a text stays
    tail = last < offsets[1:]
    start = [head, word.start[lone] - 1, gap[rest], last[tail]]
    end = [word.end, word.start[lone], word.start[rest] - 1, offsets[1:][tail]]
    doc = [word.doc, word.doc[lone], word.doc[rest], np.flatnonzero(tail)]
    start, end, doc = map(np.concatenate, (start, end, doc))
    order = np.argsort(start, kind="stable")
    return start[order], end[order], doc[order]


def _count_slice(column: pa.Array, merger: PairMerger, known: Known) -> np.ndarray:
    data, offsets = utf8(column)
    start, end, doc = _chunks(data, offsets)
    keys, at, which = np.unique(span_hash(data, start, end), return_index=True, return_inverse=True)
    values, missing = known.find(keys)
    if missing.any():
        new = at[missing]
        raw = data.tobytes()
        chunks = [raw[a:b].decode() for a, b in zip(start[new].tolist(), end[new].tolist())]
        blank = np.array([x.isspace() for x in chunks])
        fresh = np.empty(len(chunks), np.int64)
        fresh[blank] = merger.count([x for x in chunks if x.isspace()])
        fresh[~blank] = merger.count_chunks([x for x in chunks if not x.isspace()])
        values[missing] = fresh
        known.add(keys[missing], values[missing])
    out = np.bincount(doc, values[which], minlength=len(column)).astype(np.int64)
    odd = pc.match_substring_regex(column, WIDE_SPACE)
    for token in merger.special:
        odd = pc.or_(odd, pc.match_substring(column, token))
    for k in np.flatnonzero(odd.fill_null(False).to_numpy(zero_copy_only=False)):
        out[k] = merger.count_whole(column[int(k)].as_py())
    return out


def count_tokens(
    docs: DataFrame, vocabulary: str, key: str = "doc_id", text: str = "text", limit: int = 512
) -> DataFrame:
    """``key``, n_bytes, n_tokens and over_limit (more than ``limit`` tokens) of every text.

    ``vocabulary`` is the path of a tokenizers file on every executor. One narrow pass, no
    shuffle: memory per task is that of one slice of texts and the table of known chunks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        merger, known = _worker(vocabulary)
        for batch in batches:
            column = batch.column(1)
            _, offsets = utf8(column)
            tokens = [_count_slice(column.slice(a, b - a), merger, known) for a, b in slices(offsets)]
            tokens = np.concatenate([np.zeros(0, np.int64), *tokens])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.diff(offsets), pa.int64()), pa.array(tokens, pa.int64()), pa.array(tokens > limit)],
                ["key", "n_bytes", "n_tokens", "over_limit"],
            )

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    out = rows.mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long, over_limit boolean")
    return out.withColumnRenamed("key", key)
