"""Benchmark decontamination by BM25 retrieval with block-max pruning.

The test items are indexed: a posting holds the BM25 weight of a term in an item, divided by
the item's score for its own text, so that 1 means that all its terms are there. Every training
text is cut into passages that overlap by half, at least twice as long as the longest item, so an
item lies whole in one of them. A passage is a query of its distinct terms. Items are ordered
and grouped into blocks, and a block keeps each term's largest weight. An item's most frequent terms, up to half of
the threshold, cannot bring it there alone: first only the lists of the other, rarer terms are added up,
and a block goes on where they reach what some item in it lacks. Where the
sum over all terms of the passage then stays below the threshold nothing in the block can reach it, so
the block is skipped. What is left is scored exactly, and all items at or above the
threshold are retrieved: there is no top k. Each is verified by the share of the word triples of
its question, and of its answer, that the passage has.

Postings and block maxima are sorted arrays of what there is, not a table of terms by items, and a
passage meets only blocks that hold one of its terms. Items are dealt to indexes of at most
``INDEX_BYTES`` (or one larger item). Spark builds each in a task of its own and writes it to the shared folder, where the
searching tasks read it; the driver holds none.

An item's answer is what follows its last question mark. An item without one, or with nothing
before or after it, is verified whole, and both shares are that of its word triples. Parts of five
to seven words are taken by pairs, so that one changed word leaves half of them.

Defined results: null or empty texts and items match nothing; very long texts and items are searched whole; repeated items and repeated
documents match each for themselves; a document with one item in two passages is one hit, the
better of them; null keys are returned as null. No rows on either side give no rows. Other
columns are not read.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.arrays import BREAK, LOWER, slices, span_hash, utf8, windows, words
from millrace.llm.shared_files import open_for_read, open_for_write, stored
from millrace.session import scratch_path

K1, B = 1.2, 0.75
THRESHOLD = 0.6
OVERLAP = 0.5
GRAM = 3
BLOCKS = (8, 1)
INDEX_BYTES = 64 << 20  # of one index; more items are searched index by index
POSTING_BYTES, WORD_BYTES = 36, 16  # at most: three levels of a key and a weight; a group of either part
STEP = 1 << 21  # postings looked up at a time
FREQUENT = 0.5  # of the threshold, that frequent terms may leave open


def _tokens(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the terms of every text, the text of each, and their byte positions."""
    data, offsets = utf8(column)
    data = LOWER[data]
    word = words(data, offsets, BREAK)
    return span_hash(data, word.start, word.end), word.doc, word.start, offsets


def _postings(items: DataFrame) -> DataFrame:
    """(number, term, tf, length): a row for each distinct term of an item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            term, doc, _, _ = _tokens(batch.column(1))
            length = np.bincount(doc, minlength=len(batch))
            edge = np.searchsorted(doc, np.arange(len(batch) + 1))
            for k in range(len(batch)):
                own, tf = np.unique(term[edge[k] : edge[k + 1]], return_counts=True)
                row = batch.column(0).slice(k, 1).take(pa.array(np.zeros(len(own), np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [row, pa.array(own.view(np.int64)), pa.array(tf), pa.array(np.full(len(own), length[k], np.int64))], ["number", "term", "tf", "length"]
                )

    return items.select("number", "text").mapInArrow(run, "number long, term long, tf long, length long")


class Index:
    """Items with their terms' normalised weights, and the block maxima of each level.

    ``levels`` holds, for each size of block, the ascending numbers term * blocks + block of the
    blocks that hold a term, and the term's largest weight there; ``rare`` the same of the first size
    without each item's frequent terms, and ``need`` what those leave open, the least in a block.
    """

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.terms, self.items, self.grams, self.edges, self.sizes = (arrays[k] for k in ("terms", "items", "grams", "edges", "sizes"))
        self.longest = int(arrays["longest"])
        self.width = [-(-max(len(self.items), 1) // BLOCKS[0]) * BLOCKS[0] // size for size in BLOCKS]
        self.levels = [(arrays[f"at{k}"], arrays[f"top{k}"]) for k in range(len(BLOCKS))]
        self.rare, self.need, self.least = (arrays["at"], arrays["top"]), arrays["need"], float(arrays["least"])
        self.edge = np.searchsorted(self.rare[0], np.arange(len(self.terms) + 1) * self.width[0])

    @classmethod
    def build(cls, numbers: list[int], texts: list[str], terms: list[np.ndarray], weights: list[np.ndarray], threshold: float) -> Index:
        """From each item's number, text, distinct terms and their BM25 weights, to be searched at ``threshold``."""
        # items that share their rarest term lie side by side, so blocks are alike inside
        rarest = [t[np.lexsort((t, w))[-1]] for t, w in zip(terms, weights)]
        order = np.lexsort((np.array(numbers, np.int64), np.array(rarest, np.int64)))
        count = np.array([len(terms[k]) for k in order], np.int64)
        term = np.concatenate([np.zeros(0, np.int64), *(terms[k] for k in order)]).view(np.uint64)
        weight = np.concatenate([np.zeros(0), *(weights[k] / np.sort(weights[k]).sum() for k in order)]).astype(np.float32)
        known, at, df = np.unique(term, return_inverse=True, return_counts=True)
        item = np.repeat(np.arange(len(order)), count)
        arrays = {"terms": known, "items": np.array(numbers, np.int64)[order]}
        full = -(-max(len(order), 1) // BLOCKS[0]) * BLOCKS[0]
        by = np.lexsort((at, -df[at], item))
        sums = np.cumsum(weight[by], dtype=np.float64)
        sums -= np.repeat(np.append(0, sums)[np.cumsum(count) - count], count)
        rare = np.zeros(len(at), bool)
        rare[by] = sums > threshold * FREQUENT
        least = threshold - 1e-4  # weights are of single precision
        need = np.full(full, np.inf)
        need[: len(order)] = least - 1e-4 - np.bincount(item, np.where(rare, 0, weight), len(order))
        arrays |= {"need": need.reshape(-1, BLOCKS[0]).min(axis=1), "least": np.array(least)}
        for name, size, own in (("", BLOCKS[0], rare), *((k, size, slice(None)) for k, size in enumerate(BLOCKS))):
            keys, top = at[own] * (full // size) + item[own] // size, weight[own]
            by = np.argsort(keys, kind="stable")
            first = np.flatnonzero(np.diff(keys[by], prepend=-1))
            arrays[f"at{name}"] = keys[by][first]
            arrays[f"top{name}"] = np.maximum.reduceat(top[by], first) if len(first) else top
        parts = [cls._parts(texts[k]) for k in order]
        grams = [g for question, answer, _ in parts for g in (question[1], answer[1])]
        arrays["grams"] = np.concatenate([np.zeros(0, np.uint64), *grams])
        arrays["edges"] = np.cumsum([0, *map(len, grams)])
        arrays["sizes"] = np.array([p[0] for question, answer, _ in parts for p in (question, answer)], np.int8)
        arrays["longest"] = np.array(max((n for _, _, n in parts), default=1))
        return cls(arrays)

    @property
    def nbytes(self) -> int:
        return sum(a.nbytes for a in self.arrays.values())

    def save(self, folder: str) -> str:
        data = io.BytesIO()
        np.savez(data, **self.arrays)
        path, out = open_for_write(folder, ".npz")
        with out:
            out.write(data.getbuffer())
        return path

    @classmethod
    def load(cls, path: str) -> Index:
        with open_for_read(path) as file:
            return cls(dict(np.load(io.BytesIO(file.read()))))

    @staticmethod
    def _grams(term: np.ndarray) -> tuple[int, np.ndarray]:
        n = len(term)
        size = min(GRAM, n) if n < 5 else min(GRAM, (n + 1) // 3)  # one changed word leaves half of the groups of 5 or more
        return size, np.unique(windows(term, np.zeros(n, np.int64), size)[0]) if size else np.zeros(0, np.uint64)

    @classmethod
    def _parts(cls, text: str) -> tuple:
        """Question and answer, or twice the whole item, as sets of word groups, and the number of words."""
        term, _, start, _ = _tokens(pa.array([text]))
        mark = text.encode().rfind(b"?")
        cut = int(np.searchsorted(start, mark)) if mark >= 0 else len(term)
        if cut in (0, len(term)):
            whole = cls._grams(term)
            return whole, whole, len(term)
        return cls._grams(term[:cut]), cls._grams(term[cut:]), len(term)

    def parts(self, item: int) -> list[tuple[int, np.ndarray]]:
        return [(int(self.sizes[k]), self.grams[self.edges[k] : self.edges[k + 1]]) for k in (2 * item, 2 * item + 1)]

    def _blocks(self, passage: np.ndarray, term: np.ndarray, count: int) -> tuple[np.ndarray, ...]:
        """(passage, block) where rare terms reach what is needed: adds up the blocks
        that the terms' lists name, ``STEP`` of them at a time, or those of one passage."""
        (at, top), width = self.rare, self.width[0]
        held = self.edge[term + 1] - self.edge[term]
        total = np.bincount(passage, held, count).astype(np.int64)
        step = np.cumsum(np.maximum(total, width)) // STEP
        cuts = np.append(np.flatnonzero(np.diff(step, prepend=-1)), count)
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for lo, hi in zip(cuts, cuts[1:]):
            a, b = np.searchsorted(passage, (lo, hi))
            n = held[a:b]
            where = np.arange(int(n.sum())) + np.repeat(self.edge[term[a:b]] - (np.cumsum(n) - n), n)
            key = np.repeat((passage[a:b] - lo) * width, n) + at[where] - np.repeat(term[a:b] * width, n)
            score = np.bincount(key, top[where], (hi - lo) * width)
            found = np.nonzero(score.reshape(hi - lo, width) >= self.need)
            out.append((lo + found[0], found[1]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def _lookup(self, level: int, key: np.ndarray) -> np.ndarray:
        at, top = self.levels[level]
        where = np.minimum(np.searchsorted(at, key), len(at) - 1)
        return np.where(at[where] == key, top[where], 0)

    def retrieve(self, passage: np.ndarray, term: np.ndarray, count: int) -> tuple[np.ndarray, ...]:
        """(passage, item, score) at or above the threshold; ``passage`` ascends and has each term once."""
        first = np.searchsorted(passage, np.arange(count + 1))
        size = np.diff(first)
        who, block = self._blocks(passage, term, count)
        for k, width in enumerate(self.width):
            if k:
                ratio = BLOCKS[k - 1] // BLOCKS[k]
                who, block = np.repeat(who, ratio), np.repeat(block * ratio, ratio) + np.tile(np.arange(ratio), len(block))
            step = np.cumsum(size[who]) // STEP  # bounds the memory of one step
            cuts = np.append(np.flatnonzero(np.diff(step, prepend=-1)), len(who))
            score = [np.zeros(0)]
            for lo, hi in zip(cuts, cuts[1:]):
                p, b = who[lo:hi], block[lo:hi]
                n = size[p]
                begin = np.cumsum(n) - n
                at = np.repeat(first[p] - begin, n) + np.arange(int(n.sum()))
                score.append(np.add.reduceat(self._lookup(k, term[at] * width + np.repeat(b, n)), begin))
            score = np.concatenate(score)
            keep = score >= self.least
            who, block, score = who[keep], block[keep], score[keep]
        return who, block, score


def _share(part: tuple[int, np.ndarray], term: np.ndarray) -> float:
    size, grams = part
    if not len(grams):
        return 1.0
    return float(np.isin(grams, windows(term, np.zeros(len(term), np.int64), size)[0]).mean())


def _search(column: pa.Array, index: Index, overlap: float) -> list[tuple]:
    """(text, item, score, question share, answer share) of a slice, the best of each text and item."""
    term, doc, _, _ = _tokens(column)
    if not len(term) or not len(index.items):
        return []
    step = max(index.longest, 32)
    counts = np.bincount(doc, minlength=len(column))
    begin = np.cumsum(counts) - counts
    last = np.maximum(-(-counts // step) - 2, 0)  # the last passage of each text
    base = np.cumsum(last + 1) - (last + 1)
    at = np.minimum(np.searchsorted(index.terms, term), len(index.terms) - 1)
    known = np.flatnonzero(index.terms[at] == term)
    place = (known - begin[doc[known]]) // step
    pairs = []
    for back in (0, 1):
        inside = (place - back >= 0) & (place - back <= last[doc[known]])
        pairs.append((base[doc[known]] + place - back)[inside] * len(index.terms) + at[known][inside])
    pairs = np.unique(np.concatenate(pairs))
    passage, item, score = index.retrieve(pairs // len(index.terms), pairs % len(index.terms), int(base[-1] + last[-1] + 1))
    best = {}
    for p, i, s in zip(passage.tolist(), item.tolist(), score.tolist()):
        d = int(np.searchsorted(base, p, "right")) - 1
        lo = begin[d] + (p - base[d]) * step
        own = term[lo : min(lo + 2 * step, begin[d] + counts[d])]
        question, answer = (_share(part, own) for part in index.parts(i))
        if question >= overlap and answer >= overlap:
            best[d, i] = max(best.get((d, i), (0,)), (s, question, answer))
    return [(d, i, *v) for (d, i), v in sorted(best.items())]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
) -> DataFrame:
    """One row per document and item found in it: ``key``, ``item``, score, question_overlap,
    answer_overlap.

    Weights use the term counts of all items. The documents are scanned once for each index.
    """
    if threshold < 0.01:
        raise ValueError("a threshold of at least 0.01 is needed: below it every item is a hit of every passage")
    spark = docs.sparkSession
    items = benchmark.select(F.monotonically_increasing_id().alias("number"), F.col(item).alias("item"), F.col(item_text).cast("string").alias("text"))
    items = stored(items, "leak-items")
    postings = stored(_postings(items), "leak-postings")
    df = stored(postings.groupBy("term").agg(F.count("*").alias("df")), "leak-terms")
    size = postings.agg(F.count("*").alias("rows"), F.coalesce(F.sum("tf"), F.lit(0)).alias("words")).first()
    count = items.where("text IS NOT NULL").count()
    mean = max(size["words"], 1) / max(count, 1)
    idf = F.log1p((count - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / mean))
    own = postings.join(df, "term").groupBy("number").agg(F.collect_list(F.struct("term", weight.alias("weight"))).alias("own"))
    own = own.select("number", F.col("own.term").alias("term"), F.col("own.weight").alias("weight"))
    parts = max(1, -(-(size["rows"] * POSTING_BYTES + size["words"] * WORD_BYTES) // INDEX_BYTES))
    dealt = items.join(own, "number").select(F.pmod(F.xxhash64("number"), F.lit(parts)).alias("part"), "number", "text", "term", "weight")
    home = scratch_path(spark, "leak-index")
    paths = stored(dealt.groupBy("part").applyInArrow(_build(home, threshold), "path string"), "leak-indexes")
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    schema = f"key {docs.schema[key].dataType.simpleString()}, number long, score double, question_overlap double, answer_overlap double"
    out = spark.createDataFrame([], schema)
    for row in sorted(paths.collect()):  # one short path for each index
        out = out.union(rows.mapInArrow(_scan(row["path"], overlap), schema))
    out = out.join(items.select("number", "item"), "number")
    return out.select(F.col("key").alias(key), F.col("item").alias(item), "score", "question_overlap", "answer_overlap")


def _build(home: str, threshold: float):
    def run(table: pa.Table) -> pa.Table:
        numbers, texts = table.column("number").to_pylist(), table.column("text").to_pylist()
        terms, weights = ([np.array(v.values) for v in table.column(c)] for c in ("term", "weight"))
        by = [np.argsort(t) for t in terms]
        index = Index.build(numbers, texts, [t[k] for t, k in zip(terms, by)], [w[k] for w, k in zip(weights, by)], threshold)
        return pa.table({"path": [index.save(home)]})

    return run


@lru_cache(maxsize=1)
def _index(path: str) -> Index:
    return Index.load(path)


def _scan(path: str, overlap: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(path)
        for batch in batches:
            column = batch.column(1)
            for a, b in slices(utf8(column)[1]):
                hits = _search(column.slice(a, b - a), index, overlap)
                if hits:
                    d, i, *scores = zip(*hits)
                    arrays = [batch.column(0).take(pa.array([a + x for x in d])), pa.array(index.items[list(i)]), *(pa.array(x, pa.float64()) for x in scores)]
                    yield pa.RecordBatch.from_arrays(arrays, ["key", "number", "score", "question_overlap", "answer_overlap"])

    return run
