"""Words one letter apart, found by bit-sliced position indexes, and the form each is a variant of.

Words of a block are columns of bits. For every position and letter the index holds the bitset of
the words that have the letter there. All queries of a block are followed letter by letter at
once: ``zero`` is the set of words equal so far, ``replaced`` those with one letter replaced,
``longer`` those with one letter more, which are looked up one position further on. After the last
letter the one-error sets are the answers. A query finds words of its own length and one more;
each pair is reported to both.

Which words meet: cut the shorter word (or either, if equally long) of a pair into ``PARTS`` parts.
One error leaves all parts but one as they are, so the pair agrees in what is left without that
part. Every word goes to the groups of what is left of it without each part, once as the shorter
and once as the longer; the index decides within a group. A group above ``GROUP`` words is split
by cutting its missing part in two, again and again, until a part is one letter, which bounds a
group by its letters (some 90 and their pairs). A pair that meets in several groups counts in the first. Groups are
packed into blocks, so a block's cost is that of its words whatever the number of groups.

A task reports for each word of a block the number of its near words and the best of them, so pairs
are never shuffled. Counting sums up before the shuffle. Forms are followed to their roots by
pointer doubling; each form has at least ``RATIO`` times the occurrences, so chains are short.

Defined results: null and empty texts have no words; a null key counts as the empty string in what
is deleted; repeated rows count each; texts of any length are taken whole; ties for the form
go to the smallest word in code-point order; no rows give no rows. Only the columns named are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared_files import discard, stored
from millrace.session import scratch_path

RUN = "[a-zÀ-ÿ]"
LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
PARTS, GROUP, BLOCK = 3, 4096, 1024
NOISE = 31  # of so many runs one loses a letter
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def word_counts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(word, n) of the noisy runs of all texts."""
    low = F.translate(F.col(f"`{text}`").cast("string"), _CAPITALS, _CAPITALS.lower())
    # a run that is too short already cannot become longer
    runs = docs.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("id"), F.explode(F.regexp_extract_all(low, F.lit(f"{RUN}{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"))
    runs = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.char_length("run")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.char_length("run")))
    words = runs.select(F.when(F.pmod("h", F.lit(NOISE)) == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _keyed(rows: DataFrame, parts: int, which) -> DataFrame:
    """(shorter, part, group, word, n): a row for each part of ``which`` that ``word`` may lack, at the length ``shorter``."""
    rows = rows.withColumn("part", F.explode(which))
    cut = lambda i: F.floor(F.col("shorter") * i / parts).cast("int")
    head, tail = cut(F.col("part")), F.col("shorter") - cut(F.col("part") + 1)
    rest = F.struct(F.substring("word", F.lit(1), head), F.substring("word", F.char_length("word") - tail + 1, tail))
    return rows.withColumn("group", F.xxhash64(F.lit(parts), "shorter", "part", rest)).select("shorter", "part", "group", "word", "n")


def _groups(vocabulary: DataFrame, home: str) -> list[tuple[int, DataFrame]]:
    """(parts, rows) of each cutting: words in groups of at most ``GROUP``, or of one letter's part."""
    longest = vocabulary.agg(F.max(F.char_length("word"))).first()[0] or 0
    length = F.char_length("word")
    start = vocabulary.withColumn("shorter", F.explode(F.array(length, length - 1)))
    parts, rows = PARTS, _keyed(start, PARTS, F.sequence(F.lit(0), F.lit(PARTS - 1)))
    out = []
    while True:
        if parts >= longest:
            return [*out, (parts, rows)]
        rows = stored(rows, path=f"{home}/groups-{parts}")
        large = stored(rows.groupBy("shorter", "part", "group").count().where(F.col("count") > GROUP).drop("count"), path=f"{home}/large-{parts}")
        if large.isEmpty():
            return [*out, (parts, rows)]
        key = ["shorter", "part", "group"]
        out.append((parts, rows.join(large, key, "left_anti")))
        part = F.col("part")
        rows = _keyed(rows.join(large, key, "left_semi").withColumn("half", part).drop("part", "group"), 2 * parts, F.array(F.col("half") * 2, F.col("half") * 2 + 1))
        parts *= 2


def _bits(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    width = -(-flags.shape[1] // 64) * 64
    packed = np.packbits(np.pad(flags, ((0, 0), (0, width - flags.shape[1]))), axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64)


def near_pairs(letters: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (x, y) of rows of one group with exactly one error, y as long as x or one letter longer.

    A row of ``letters`` is a word of s letters and a zero, or of s + 1 letters; ``group`` counts up from 0.
    """
    n, size = letters.shape
    alphabet, code = np.unique(letters, return_inverse=True)
    code = code.reshape(n, size)
    having = np.stack([_bits(code[:, k] == np.arange(len(alphabet))[:, None]) for k in range(size)])
    long = letters[:, -1] > 0
    query = np.flatnonzero(~long)
    zero = _bits(group == np.arange(group[-1] + 1)[:, None])[group[query]]
    replaced, longer = np.zeros_like(zero), np.zeros_like(zero)
    for k in range(size - 1):
        own = code[query, k]
        same, shifted = having[k][own], having[k + 1][own]
        longer = (longer | zero) & shifted
        replaced = (replaced & same) | (zero & ~same)
        zero &= same
    length = _bits(np.stack([~long, long]))
    found = (replaced & length[0]) | ((longer | zero) & length[1])
    row, word = np.nonzero(found)
    hit, bit = np.nonzero((found[row, word][:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1))
    x, y = query[row[hit]], word[hit] * 64 + bit
    once = long[y] | (x < y)  # equally long words find each other
    return x[once], y[once]


def first_meeting(a: np.ndarray, b: np.ndarray, part: np.ndarray, parts: int) -> np.ndarray:
    """Which pairs of words (rows of letters, as ``near_pairs`` takes them; ``a`` the shorter) meet in ``part`` first."""
    s = a.shape[1] - 1
    head = np.cumprod(a == b, axis=1).sum(axis=1)
    ends = np.where((b[:, -1] > 0)[:, None], b[:, ::-1], np.roll(b, 1, axis=1)[:, ::-1])[:, :s]
    tail = np.cumprod(a[:, s - 1 :: -1] == ends, axis=1).sum(axis=1)
    agrees = lambda p, of: (head >= s * p // of) & (tail >= s - s * (p + 1) // of)
    of, at = PARTS, np.full(len(a), -1)
    for p in range(PARTS):
        at = np.where((at < 0) & agrees(p, of), p, at)
    while of < parts:
        of *= 2
        at = np.where(agrees(2 * at, of), 2 * at, 2 * at + 1)
    return at == part


def _best(letters: np.ndarray, n: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple:
    """Of each word with near words: its row, how many, and the row of the best."""
    word, near = np.concatenate([x, y]), np.concatenate([y, x])
    rank = np.empty(len(letters), np.int64)
    rank[np.lexsort(letters.T[::-1])] = np.arange(len(letters))
    order = np.lexsort((rank[near], -n[near], word))
    word, near = word[order], near[order]
    first = np.flatnonzero(np.diff(word, prepend=-1))
    return word[first], np.diff(np.append(first, len(word))), near[first]


def _near(rows: DataFrame, parts: int) -> DataFrame:
    """(word, n_near, n, near): counts and the best near word of each block; words in Latin-1, filled up with zeros."""

    def block(letters: np.ndarray, n: np.ndarray, part: np.ndarray, group: np.ndarray) -> pa.RecordBatch | None:
        x, y = near_pairs(letters, group)
        keep = first_meeting(letters[x], letters[y], part[x], parts)
        x, y = x[keep], y[keep]
        if not len(x):
            return None
        word, count, best = _best(letters, n, x, y)
        text = lambda k: pa.FixedSizeBinaryArray.from_buffers(pa.binary(letters.shape[1]), len(k), [None, pa.py_buffer(np.ascontiguousarray(letters[k]))]).cast(pa.binary())
        return pa.RecordBatch.from_arrays([text(word), pa.array(count, pa.int64()), pa.array(n[best]), text(best)], ["word", "n_near", "n", "near"])

    def whole(table: pa.Table) -> Iterator[pa.RecordBatch]:
        """``table`` holds whole groups in order."""
        shorter, part, group, n = (table.column(c).to_numpy() for c in ("shorter", "part", "group", "n"))
        new = np.ones(len(group), bool)
        new[1:] = (shorter[1:] != shorter[:-1]) | (group[1:] != group[:-1])
        number = np.cumsum(new) - 1
        several = np.flatnonzero(np.bincount(number)[number] > 1)
        raw = np.frombuffer(b"".join(table.column("word").take(pa.array(several)).to_pylist()), np.uint8)
        shorter, part, number, n = shorter[several], part[several], number[several], n[several]
        start = np.concatenate([[0], np.cumsum(shorter + 1)])
        edges = np.flatnonzero(np.diff(number, prepend=-1, append=-1))  # where groups start, and the end
        lo = 0
        while lo < len(edges) - 1:
            last = np.searchsorted(edges, edges[lo] + BLOCK)
            hi = max(lo + 1, min(last, int(np.searchsorted(shorter[edges[:-1]], shorter[edges[lo]], "right"))))
            hi = min(hi, len(edges) - 1)
            a, b = edges[lo], edges[hi]
            out = block(raw[start[a] : start[b]].reshape(b - a, -1), n[a:b], part[a:b], np.unique(number[a:b], return_inverse=True)[1])
            if out is not None:
                yield out
            lo = hi

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, last, size = [], None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            size += batch.num_rows
            if size < 16 * BLOCK:
                continue
            table = pa.Table.from_batches(held).combine_chunks()
            shorter, group = table.column("shorter").to_numpy(), table.column("group").to_numpy()
            last = np.flatnonzero((shorter != shorter[-1]) | (group != group[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            yield from whole(table.slice(0, cut)) if cut else ()
            held = table.slice(cut).to_batches()
            size = table.num_rows - cut
        if held:
            yield from whole(pa.Table.from_batches(held).combine_chunks())

    filled = F.encode(F.rpad("word", F.col("shorter") + 1, "\0"), "ISO-8859-1").alias("word")
    rows = rows.select("shorter", "part", "group", filled, "n").repartition("shorter", "group").sortWithinPartitions("shorter", "group")
    return rows.mapInArrow(run, "word binary, n_near long, n long, near binary")


def near_words(vocabulary: DataFrame, home: str) -> DataFrame:
    """(word, n_near, form_n, form) of every word of (word, n) with near words; the form is the one of
    largest n. Tables go to the folder ``home``, which the result reads."""
    found = None
    for parts, rows in _groups(vocabulary, home):
        part = _near(rows, parts)
        found = part if found is None else found.unionByName(part)
    text = lambda c: F.rtrim(F.decode(c, "ISO-8859-1"), F.lit("\0")).alias(c)
    found = found.select(text("word"), "n_near", "n", text("near"))
    best = F.min(F.struct((-F.col("n")).alias("less"), F.col("near")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.near").alias("form")
    )


def _roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form): the last form that is reached."""
    links = stored(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = links.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        after = stored(after, "spelling-roots")
        links = after.select("word", "root")
        if after.where("moved").isEmpty():
            return links


def spelling_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the texts."""
    home = scratch_path(docs.sparkSession, "spelling-work")
    vocabulary = stored(word_counts(docs, key, text), path=f"{home}/words")
    near = vocabulary.join(near_words(vocabulary, home), "word", "left")
    large = F.col("form_n") >= RATIO * F.col("n")
    out = stored(
        near.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(large, F.col("form")).alias("form"), F.when(large, F.col("form_n")).alias("form_n")),
        "spelling-forms",
    )
    discard(docs.sparkSession, home)
    roots = _roots(out.where("form IS NOT NULL"))
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
