"""Line-first cleaning of texts.

Every line of a text is judged by itself: it fails as navigation (mostly separators, or a run
of them), as boilerplate (known phrases make up a share of its words, or it is a copy of an
earlier line of the same text), or for its punctuation (shouting, which takes more than one mark,
or symbols in place of words). A phrase stands between other characters than ASCII letters and
digits, in one line of one text. Failing lines are removed. Then a
text goes if it lost too much, counted in code points of words, or if it breaks one of the base
rules, which are taken on the whole text as it came.

Defined results: a null or empty text has no words, so it breaks the base rule on length and is
not kept; its clean text is null or empty. Repeated rows are judged each for itself. A text of
one line of any length is judged as any other. Only the key and text columns are read, unless
``clean`` is asked to keep the others, whose values pass unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.arrays import LOWER, SPACE, Spans, lines, mix, per_doc, slices, span_hash, utf8, windows, words

MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
REPEAT_WINDOW = 5
MAX_LOST_PERCENT = 50
NAVIGATION_PERCENT = 25
SYMBOL_PERCENT = 10
SHOUT_PERCENT = 30
SHOUT_MARKS = 2
BOILERPLATE_PERCENT = 30
BOILERPLATE = (
    "javascript is disabled",
    "enable javascript",
    "accept all cookies",
    "we use cookies",
    "cookie policy",
    "privacy policy",
    "terms of use",
    "terms of service",
    "all rights reserved",
    "lorem ipsum",
    "skip to content",
    "sign up for our newsletter",
    "click here",
    "read more",
)

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
SEPARATORS = np.zeros(256, bool)
SEPARATORS[list(b"|>")] = True
MARKS = np.zeros(256, bool)
MARKS[list(b"!?")] = True
ALNUM = np.zeros(256, bool)
ALNUM[[b for b in range(128) if chr(b).isalnum()]] = True

MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_removed_lines", "lost_chars"]


def _repeated(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which keys occur twice or more, and which are not the first of their kind."""
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice, later = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    if len(keys):
        later[order[1:]] = same
        twice[order[1:]] = same
        twice[order[:-1]] |= same
    return twice, later


def _inside(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return total[end] - total[start]


def _sums(flags: np.ndarray) -> np.ndarray:
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def _phrased(data: np.ndarray, word: Spans, start: np.ndarray, end: np.ndarray, phrases: tuple[str, ...]) -> np.ndarray:
    """Which words are of a phrase; lines are from ``start`` to ``end``."""
    edge = np.zeros(len(word.start) + 1, np.int64)
    lower = LOWER[data].tobytes()
    for phrase in phrases:
        own, places = phrase.encode(), []
        at = lower.find(own)
        while at >= 0:
            places.append(at)
            at = lower.find(own, at + 1)
        a = np.array(places, np.int64)
        b = a + len(own)
        k = np.searchsorted(start, a, "right") - 1
        inside = (k >= 0) & (b <= end[k]) if len(end) else np.zeros(len(a), bool)
        a, b, k = a[inside], b[inside], k[inside]
        whole = (a == start[k]) | ~ALNUM[data[a - 1]]
        whole &= (b == end[k]) | ~ALNUM[data[np.minimum(b, len(data) - 1)]]
        np.add.at(edge, np.searchsorted(word.end, a[whole], "right"), 1)
        np.add.at(edge, np.searchsorted(word.start, b[whole]), -1)
    return np.cumsum(edge)[:-1] > 0


def _measure(column: pa.Array, rules: dict) -> tuple[np.ndarray, list[str]]:
    """The measures of every text of a slice, one column each, and the clean texts."""
    data, offsets = utf8(column)
    n = len(column)
    word, line = words(data, offsets), lines(data, offsets)
    text_key = mix(np.arange(n, dtype=np.uint64) + np.uint64(1))
    letter = ~SPACE[data] & ((data & 0xC0) != 0x80)
    hashes = span_hash(data, word.start, word.end)
    out = np.zeros((len(MEASURES), n), np.int64)
    out[0] = np.bincount(word.doc, minlength=n)
    out[1] = per_doc(letter, offsets)
    out[2] = per_doc(SYMBOLS[data], offsets)

    shingle, first = windows(hashes, word.doc, REPEAT_WINDOW)
    twice, _ = _repeated(mix(shingle ^ text_key[word.doc[first]]))
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, first[twice], 1)
    np.add.at(cover, first[twice] + REPEAT_WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    out[4] = np.bincount(word.doc[covered], minlength=n)

    line_words = np.searchsorted(word.start, line.end) - np.searchsorted(word.start, line.start)
    full = np.flatnonzero(line_words > 0)
    start, end, doc, count = line.start[full], line.end[full], line.doc[full], line_words[full]
    _, later = _repeated(mix(span_hash(data, start, end) ^ text_key[doc]))
    out[3] = np.bincount(doc[later], minlength=n)

    chars = _inside(_sums(letter), start, end)
    lone = _inside(_sums(SEPARATORS[data] & letter), start, end)
    marks = _inside(_sums(MARKS[data]), start, end)
    symbols = _inside(_sums(SYMBOLS[data] & ~SEPARATORS[data]), start, end)
    fails = later.copy()
    fails |= 100 * lone > rules["navigation"] * count
    fails |= (marks >= SHOUT_MARKS) & (100 * marks > rules["shout"] * count)
    fails |= 100 * symbols > rules["symbols"] * chars
    said = _sums(_phrased(data, word, start, end, rules["boilerplate"]))
    said = _inside(said, np.searchsorted(word.start, start), np.searchsorted(word.start, end))
    fails |= (said > 0) & (100 * said >= rules["share"] * count)
    out[5] = np.bincount(doc, minlength=n)
    out[6] = np.bincount(doc[fails], minlength=n)
    out[7] = np.bincount(doc[fails], chars[fails], minlength=n)

    raw = data.tobytes()
    dropped: dict[int, list[tuple[int, int]]] = {}
    for k in np.flatnonzero(fails).tolist():
        dropped.setdefault(int(doc[k]), []).append((int(start[k]), int(end[k])))
    clean: list = column.to_pylist() if not dropped else [None] * n
    if dropped:
        for d in range(n):
            if not column[d].is_valid:
                continue
            parts, at, last = [], int(offsets[d]), int(offsets[d + 1])
            for a, b in dropped.get(d, ()):
                parts.append(raw[at:a])
                at = min(b + 1, last)
            clean[d] = b"".join([*parts, raw[at:last]]).decode()
    return out, clean


def clean_lines(
    docs: DataFrame,
    text: str = "text",
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    max_lost_percent: int = MAX_LOST_PERCENT,
    navigation_percent: int = NAVIGATION_PERCENT,
    symbol_percent: int = SYMBOL_PERCENT,
    shout_percent: int = SHOUT_PERCENT,
    boilerplate: tuple[str, ...] = BOILERPLATE,
    boilerplate_percent: int = BOILERPLATE_PERCENT,
) -> DataFrame:
    """All columns of ``docs`` as one struct ``row``, with the clean text and the verdict.

    Columns: row, clean_text, the measures (n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, n_lines, n_removed_lines, lost_chars), base_failed, kept. The struct keeps
    the operator's columns apart from columns of the same names. One pass, no shuffle; ``row``
    is not sent to Python beyond what the caller selected into ``docs``.
    """
    rules = {"navigation": navigation_percent, "symbols": symbol_percent, "shout": shout_percent, "boilerplate": boilerplate, "share": boilerplate_percent}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(1)
            _, offsets = utf8(column)
            for a, b in slices(offsets):
                m, clean = _measure(column.slice(a, b - a), rules)
                failed = (m[0] < min_words) | (100 * m[4] > max_repeat_percent * m[0])
                kept = ~failed & (100 * m[7] <= max_lost_percent * m[1])
                arrays = [batch.column(0).slice(a, b - a), pa.array(clean, pa.string()), *(pa.array(x) for x in m), pa.array(failed), pa.array(kept)]
                yield pa.RecordBatch.from_arrays(arrays, ["row", "clean_text", *MEASURES, "base_failed", "kept"])

    kinds = [("clean_text", T.StringType()), *((m, T.LongType()) for m in MEASURES), ("base_failed", T.BooleanType()), ("kept", T.BooleanType())]
    schema = T.StructType([T.StructField("row", docs.schema), *(T.StructField(a, b) for a, b in kinds)])
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, schema)
