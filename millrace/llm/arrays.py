"""Texts of a batch as numpy arrays: words, lines and hashes of byte spans, without a loop over words.

All work is on UTF-8 bytes. Memory is a small multiple of the bytes of one slice of a batch,
or of its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
_PIECE = 1 << 20

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: The same and ASCII punctuation.
BREAK = SPACE.copy()
BREAK[[b for b in range(128) if not chr(b).isalnum()]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash base to the powers 0 to n at least, and their inverses modulo 2**64."""
    if len(_powers[0]) <= n:
        for k, base in enumerate((_BASE, pow(_BASE, -1, 2**64))):
            table = np.full(n + 1, base, np.uint64)
            table[0] = 1
            _powers[k] = np.multiply.accumulate(table)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all of them."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in one array and the n + 1 offsets; a null has no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of whole texts of at most ``limit`` bytes together, or one longer text."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1
        hi = min(n, max(lo + 1, hi))
        yield lo, hi
        lo = hi


class Spans(NamedTuple):
    """Byte ranges in ascending order and the text each lies in."""

    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray


def _within(start: np.ndarray, end: np.ndarray, offsets: np.ndarray) -> Spans:
    return Spans(start, end, np.searchsorted(offsets, start, "right") - 1)


def words(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> Spans:
    """Words: runs of bytes other than space and \\x09 to \\x0D within a text."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return Spans(none, none, none)
    inside = ~space[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.ones(n, bool)
    before[1:] = ~inside[:-1]
    after = np.ones(n, bool)
    after[:-1] = ~inside[1:]
    start = np.flatnonzero(inside & (before | edge[:-1]))
    end = np.flatnonzero(inside & (after | edge[1:])) + 1
    return _within(start, end, offsets)


def lines(data: np.ndarray, offsets: np.ndarray) -> Spans:
    """Lines split at \\n, without it; a text of no bytes has none."""
    cuts = np.flatnonzero(data == 10)
    full = np.flatnonzero(np.diff(offsets))
    start = np.concatenate([offsets[full], cuts + 1])
    end = np.concatenate([cuts, offsets[full + 1]])
    doc = np.concatenate([full, np.searchsorted(offsets, cuts, "right") - 1])
    order = np.lexsort((start, doc))
    tail = np.lexsort((end, np.concatenate([np.searchsorted(offsets, cuts, "right") - 1, full])))
    return Spans(start[order], end[tail], doc[order])


#: Other numbers for the 256 bytes, for a second hash that is independent of the first.
OTHER = mix(np.arange(256, dtype=np.uint64) + np.uint64(0xA24BAED4963EE407)) | np.uint64(1)


def span_hash(data: np.ndarray, start: np.ndarray, end: np.ndarray, numbers: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of spans in ascending order of their starts; equal bytes give equal hashes."""
    out = np.empty(len(start), np.uint64)
    k = 0
    while k < len(start):
        top = max(int(np.searchsorted(start, start[k] + _PIECE)), k + 1)
        lo, hi = int(start[k]), int(end[k:top].max())
        up, down = powers(max(hi - lo, _PIECE))
        sums = np.zeros(hi - lo + 1, np.uint64)
        piece = data[lo:hi].astype(np.uint64) + np.uint64(1) if numbers is None else numbers[data[lo:hi]]
        np.cumsum(piece * up[: hi - lo], out=sums[1:])
        a, b = start[k:top] - lo, end[k:top] - lo
        out[k:top] = (sums[b] - sums[a]) * down[a]
        k = top
    return mix(out + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def per_doc(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """How many of a text's bytes are flagged."""
    total = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=total[1:])
    return total[offsets[1:]] - total[offsets[:-1]]


def windows(hashes: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``size`` consecutive words of a text, and the index of its first word."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    first = np.flatnonzero(doc[:n] == doc[size - 1 :])
    out = np.zeros(len(first), np.uint64)
    for k in range(size):
        out = mix(out * np.uint64(_BASE) + hashes[first + k])
    return out, first
