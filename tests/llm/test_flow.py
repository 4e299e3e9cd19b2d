"""Sharding, mixing and the pipeline."""

import zlib
from collections import Counter, defaultdict

import brute
import pytest

import corpus_pipeline
from millrace.llm.mixing import fair_queue
from millrace.llm.ring import shard_rows, walk


@pytest.mark.parametrize("table", ["docs", "odd", "none"])
def test_ring_shards(table, request):
    rows = request.getfixturevalue(table)
    known = [(r["doc_id"], (r["text"] or "").encode()) for r in rows.collect()]
    out = shard_rows(rows, shards=7).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in out) == Counter((k, len(t) + 8, zlib.crc32(t)) for k, t in known)
    slots = defaultdict(list)
    for r in out:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots[s]) for s in range(7)]
    assert max(counts) - min(counts) <= 1


def test_few_rows_move_when_a_shard_is_added(docs):
    before, after = ({r["doc_id"]: r["shard"] for r in shard_rows(docs, shards=n).collect()} for n in (9, 10))
    assert sum(before[k] != after[k] for k in before) < 0.35 * len(before)


def test_walk_goes_on_clockwise():
    pieces = walk([(0, 5), (1, 1), (0, 2), (2, 0)], [3, 3, 2])
    assert pieces == {0: [(0, 3, 0, 0), (3, 5, 1, 1)], 1: [(0, 1, 1, 0)], 2: [(0, 2, 2, 0)], 3: []}


def plain_targets(sizes: dict, weights=(3, 1, 2), budget=1.5, epochs=2) -> dict:
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[k % 3] for k, s in enumerate(names)}
    total, full = budget * sum(sizes.values()), set()
    while True:
        open_ = [s for s in names if s not in full]
        left = total - sum(epochs * sizes[s] for s in full)
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > epochs * sizes[s]}
        if not over:
            return {s: float(epochs * sizes[s]) if s in full else share[s] for s in names}
        full |= over


@pytest.mark.parametrize("table", ["docs", "odd"])
def test_fair_mix(table, request):
    rows = request.getfixturevalue(table)
    out = [r.asDict() for r in fair_queue(rows, slices=16).collect()]
    again = [r.asDict() for r in fair_queue(rows.repartition(5), slices=16).collect()]
    assert Counter(map(str, out)) == Counter(map(str, again))
    known = [(r["doc_id"], r["source"], len(brute.WORD.findall(r["text"] or ""))) for r in rows.collect()]
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in out) == Counter(known)
    sizes, largest = Counter(), Counter()
    for _, s, n in known:
        sizes[s] += n
        largest[s] = max(largest[s], n)
    want, taken = plain_targets(sizes), Counter()
    for r in out:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
        assert r["taken"] == r["turns"] * r["size"] and r["turns"] in (0, 1, 2)
        taken[r["source"]] += r["taken"]
    assert sum(taken.values()) <= 1.5 * sum(sizes.values())
    assert all(abs(taken[s] - want[s]) <= 2 * max(largest.values()) for s in sizes)


def test_mix_of_nothing(none):
    assert fair_queue(none).isEmpty()


def stages(spark, docs, sf_dir, folder):
    out = []
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        out.append((name, docs, spark.read.parquet(f"{folder}/{name}")))
        docs = out[-1][2]
    return out


def test_pipeline_on_documents(spark, docs, tmp_path):
    done = {n: (a, b) for n, a, b in stages(spark, docs, "/root/testdata/sf0.001", tmp_path)}
    before, after = done["quality"]
    clean = {r["doc_id"] for r in before.collect() if not brute.quality(r["text"])[-1]}
    assert {r["doc_id"] for r in after.collect()} <= clean
    before, after = done["near_duplicates"]
    groups = brute.near([(r["doc_id"], r["text"]) for r in before.collect()], 5)
    assert {r["doc_id"] for r in after.collect()} == {g for _, _, g in groups}
    before, after = done["decontaminate"]
    items = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]
    bad = {k for k, _ in brute.leaks([(r["doc_id"], r["text"]) for r in before.collect()], items)}
    assert {r["doc_id"] for r in after.collect()} == {r["doc_id"] for r in before.collect()} - bad
    before, after = done["mix"]
    turns = {r["doc_id"]: r["turns"] for r in fair_queue(before).collect() if r["turns"]}
    assert Counter(r["doc_id"] for r in after.collect()) == Counter(turns)
    before, after = done["shard"]
    assert after.count() == before.count() and after.columns == [*docs.columns, "size", "text_crc32", "shard", "slot"]


def test_pipeline_on_odd_rows(spark, odd, none, tmp_path):
    for k, rows in enumerate((odd, odd.unionByName(odd), none)):
        done = stages(spark, rows, "/root/testdata/sf0.001", tmp_path / str(k))
        assert all(b.columns == rows.columns for _, _, b in done[:-1])
        texts = [r["text"] for r in done[1][2].collect()]
        assert len(texts) == len(set(texts)) == (3 if k < 2 else 0)


def test_pipeline_tells_rows_of_one_doc_id_apart(spark, tmp_path):
    """Null and repeated ids: one leak takes no other row with it, and one near copy of a group stays."""
    text = lambda c: " ".join(f"{c}{i * i % 89}x{i}" for i in range(90))
    item = "Which river runs past the old mill of Marvento? The quiet Ostrel, since the flood of the year 1804."
    spark.createDataFrame([(9, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    near_a, near_b = (text("a").replace(w, "changed") for w in ("a0x0 ", "a1x1 "))
    clean, leak, other, twice = text("b"), f"{text('c')} {item} {text('d')}", text("e"), text("f")
    rows = [(None, text("a")), (None, near_a), (None, near_b), (None, clean), (None, leak), (7, other), (7, f"{text('g')} {item}"), (7, twice), (8, twice), (None, twice)]
    docs = spark.createDataFrame([(k, t, "s") for k, t in rows], "doc_id long, text string, source string").repartition(3)
    kept = corpus_pipeline.near(spark, docs, str(tmp_path))
    got = [(r["doc_id"], r["text"]) for r in kept.collect()]
    assert sum(t in (text("a"), near_a, near_b) for _, t in got) == 1
    assert {x for x in got if x[1] in (clean, leak, other, twice)} == {(None, clean), (None, leak), (7, other), (7, twice)} and len(got) == 6
    left = {(r["doc_id"], r["text"]) for r in corpus_pipeline.decontaminate(spark, kept, str(tmp_path)).collect()}
    assert left == {(k, t) for k, t in got if item not in t} and len(left) == 4
