"""Piece ids, the filter audit and spelling groups against plain versions."""

import random
import re
import zlib
from collections import Counter
from itertools import permutations

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import filter_audit, spelling
from millrace.llm.filter_audit import FILTERS, HAS_KEY, audit_filters, follow, stream_documents
from millrace.llm.pieces import ChunkTable, PieceTable, decode_pieces, encode_pieces
from millrace.llm.spelling import near_pairs, spelling_groups

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.sampled_from(list("ab The é日▁  \n\t\x00　①ﬁ�<s>")), max_size=30)), max_size=8))
def test_chunks_give_the_library_ids(values):
    one = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    table, pieces = ChunkTable(MODEL, 500), PieceTable(MODEL)
    for column in (pa.array(values, pa.string()), pa.array([None, *values], pa.string())[1:]):
        ids, offsets = table.encode(column)
        want = [[1, *one.encode(v or ""), 2] for v in values]
        assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == want
        assert pieces.decode(ids, offsets) == [one.decode(w) for w in want]


def test_decoding_any_ids(library):
    rng, table = random.Random(2), PieceTable(MODEL)
    rows = [[rng.choice([0, 1, 2, 131, 197, 200, 259, 28705, rng.randrange(32000)]) for _ in range(rng.randrange(10))] for _ in range(3000)]
    got = table.decode(np.array(sum(rows, []), np.uint32), np.cumsum([0, *map(len, rows)]))
    assert got == [library.decode(r) for r in rows]


@pytest.mark.parametrize("table", ["docs", "odd", "none"])
def test_piece_round_trip(table, request, library):
    rows = request.getfixturevalue(table)
    known = [(r["doc_id"], r["text"]) for r in rows.collect()]
    encoded = encode_pieces(rows, MODEL)
    out = decode_pieces(encoded.selectExpr("*", "'own' AS decoded", "n_tokens AS `odd name`"), MODEL)
    assert out.columns == ["doc_id", "n_tokens", "ids", "odd name", "decoded"]
    got = Counter((r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in out.collect())
    want = Counter()
    for key, text in known:
        ids = [1, *library.encode(text or ""), 2]
        want[key, len(ids), np.array(ids, "<u4").tobytes(), library.decode(ids)] += 1
    assert got == want


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, b"")], "doc_id long, ids binary")
    assert [r["decoded"] for r in decode_pieces(rows, MODEL).collect()] == ["", ""]


def plain_audit(rows: list[tuple], labels: list[tuple]) -> Counter:
    """Rows of the audit of (key, text, part), by trying every order."""
    good, toxic = ({k for k, *v in labels if v[i] == 1 and k is not None} for i in (0, 1))
    least: dict = {}
    for key, text, _ in rows:
        if key is not None:
            least[text or ""] = min(least.get(text or "", key), key)
    fails = {}
    for n, (key, text, part) in enumerate(rows):
        text = text or ""
        words = brute.WORD.findall(text)
        fails[n] = {
            "A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words), "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)), "E": key is not None and least[text] < key,
        }
    out, shapley = {}, Counter()
    for order in permutations(FILTERS):
        gone = set()
        for step, f in enumerate(order, 1):
            cell = {p: Counter() for p in {r[2] or "" for r in rows}}
            before = set(gone)
            for n, (key, _, part) in enumerate(rows):
                c, bad = cell[part or ""], fails[n][f]
                c["removed"] += bad and n not in before
                c["redundant"] += bad and n in before
                c["unique"] += bad and sum(fails[n].values()) == 1
                c["good"] += bad and n not in before and key in good
                c["toxic"] += bad and n not in before and key in toxic
                gone |= {n} if bad else set()
                c["kept"] += n not in gone
            for p, c in cell.items():
                out[p, "".join(order), step] = c
                shapley[p, f] += c["removed"]
    return Counter((p, o, s, c["kept"], c["removed"], c["redundant"], c["unique"], c["good"], c["toxic"], shapley[p, o[s - 1]]) for (p, o, s), c in out.items())


def audited(spark, folder, labels, rows_expected=40, per_core=1):
    out = audit_filters(stream_documents(spark, str(folder), per_core), labels, rows_expected)
    return Counter(tuple(r) for r in out.collect())


def test_filter_audit_with_smaller_keys_later(spark, odd, tmp_path):
    """Files arrive one by one, the largest keys first, so earlier masks are retracted."""
    rows = [(r["doc_id"], (r["text"] or None) and r["text"][:20_000], r["source"]) for r in odd.collect()]
    rows += [(90 - k, "The SAME text # again", "ab"[k % 2]) for k in range(6)] + [(85, "The SAME text # again", "c")] * 2 + [(None, "The SAME text # again", "a")] * 2
    labels = [(85, 1, 0), (85, 0, 1), (86, 1, None), (90, None, 1), (None, 1, 1), (3, 1, 0), (777, 1, 1)]
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    for k, row in enumerate(sorted(rows, key=lambda r: -(r[0] or 0))):
        one = spark.createDataFrame([(*row, "clash", "clash")], "doc_id long, text string, source string, mark string, `digest` string")
        one.coalesce(1).write.parquet(f"{tmp_path}/docs/{k:03}") if k % 3 else one.coalesce(1).write.mode("append").parquet(f"{tmp_path}/docs/000")
    folder = tmp_path / "docs"
    flat = tmp_path / "flat"
    spark.read.option("recursiveFileLookup", True).parquet(str(folder)).repartition(7).write.parquet(str(flat))
    want = plain_audit(rows, labels)
    assert audited(spark, flat, marks) == audited(spark, flat, marks, 0, 1 << 20) == want


def test_filter_audit_of_documents(spark, docs, tmp_path, monkeypatch):
    """With the state in RocksDB."""
    monkeypatch.setattr(filter_audit, "TEXTS_IN_MEMORY", 0)
    docs.orderBy("doc_id", ascending=False).repartitionByRange(4, -docs["doc_id"]).write.parquet(str(tmp_path / "docs"))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    want = plain_audit([(r["doc_id"], r["text"], r["source"]) for r in docs.collect()], [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()])
    assert audited(spark, tmp_path / "docs", labels) == want


def test_filter_audit_of_nothing(spark, none, tmp_path):
    none.write.parquet(str(tmp_path / "docs"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert not audited(spark, tmp_path / "docs", labels)
    with pytest.raises(ValueError):
        audit_filters(none, labels, 0)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.sampled_from("ab"), st.integers(1, 3)), max_size=8), st.integers(0, 8))
def test_retraction_does_not_depend_on_the_order(rows, cut):
    """Any split into micro-batches in any order gives the counters of the whole."""
    rows = [(key, HAS_KEY, part, 1, n) for key, part, n in rows]
    total = Counter()
    least, held = None, {}
    for batch in (rows[:cut], rows[cut:]):
        least, held, change = follow(least, held, iter(batch))
        total.update(change)
    want = Counter()
    for key, _, part, mark, n in rows:
        want[part, mark | 16 * (key > min(r[0] for r in rows))] += n
    assert {k: n for k, n in total.items() if n} == dict(want)


def plain_spelling(rows: list[tuple]) -> list[tuple]:
    count, low = Counter(), str.maketrans(spelling._CAPITALS, spelling._CAPITALS.lower())
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(low)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += len(run) >= 7
    words = {w: n for w, n in count.items() if n >= 2}
    less: dict = {}
    for w in words:
        for i in range(len(w)):
            less.setdefault((w[:i], w[i + 1 :]), set()).add(w)
    near = {w: set().union(*(less[w[:i], w[i + 1 :]] for i in range(len(w)))) - {w} for w in words}
    for w in words:
        for i in range(len(w)):
            if (other := w[:i] + w[i + 1 :]) in words:
                near[w].add(other)
                near[other].add(w)
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda o: (-words[o], o), default=None)
        if best and words[best] >= 10 * words[w]:
            form[w] = best
    out = []
    for w, n in words.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), words[form[w]] if w in form else None))
    return sorted(out)


def spelled(df):
    return sorted(tuple(r) for r in spelling_groups(df).select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("table,group", [("docs", 4096), ("docs", 5), ("odd", 4096), ("none", 4096)])
def test_spelling_groups(table, group, request, monkeypatch):
    monkeypatch.setattr(spelling, "GROUP", group)
    rows = request.getfixturevalue(table)
    assert spelled(rows) == plain_spelling([(r["doc_id"], r["text"]) for r in rows.collect()])


@pytest.mark.parametrize("group", [4096, 8])
def test_spelling_groups_follow_forms(spark, group, monkeypatch):
    monkeypatch.setattr(spelling, "GROUP", group)
    rng = random.Random(4)
    base = ["wonderful", "aaaaaaa", "élégances", "x" * 60, "mississippi", "ababababa"]
    texts, n = [], 3000
    for w in base:
        chain = [w]
        for _ in range(3):
            k = rng.randrange(len(chain[-1]))
            chain.append(chain[-1][:k] + rng.choice("abzé") + chain[-1][k + rng.randrange(2) :])
        texts += [f"{v} " * (n // 11**k) for k, v in enumerate(chain)]
        texts += [" ".join([w[:k] + c + w[k + 1 :], w[:k] + w[k + 1 :], w[:k] + c + w[k:]]) for k in range(len(w)) for c in "aqé" for _ in range(2)]
    rows = [(k, t.upper() if k % 5 == 0 else t) for k, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, word string")
    assert spelled(df) == plain_spelling(rows)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("abé", min_size=4, max_size=5), min_size=1, max_size=90, unique=True), st.integers(1, 3))
def test_bit_sliced_index(words, groups):
    words.sort(key=lambda w: len(w) * 7 % groups)
    group = np.unique([len(w) * 7 % groups for w in words], return_inverse=True)[1]
    letters = np.stack([np.frombuffer(w.ljust(5, "\0").encode("latin-1"), np.uint8) for w in words])
    edits = lambda w: {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in "abé"} | {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in "abé"}
    want = set()
    for i, x in enumerate(words):
        for j, y in enumerate(words):
            if len(x) == 4 and y != x and y in edits(x) and group[i] == group[j] and (len(y) > 4 or i < j):
                want.add((i, j))
    x, y = near_pairs(letters, group)
    assert sorted(zip(x.tolist(), y.tolist())) == sorted(want)
