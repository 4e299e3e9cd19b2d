"""Quality, token counts, token files and the array helpers."""

import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from millrace.llm import arrays
from millrace.llm.quality import BOILERPLATE, clean_lines
from millrace.llm.shared_files import open_for_read
from millrace.llm.token_counts import PairMerger, count_tokens
from millrace.llm.token_files import WordEncoder, read_documents, sequence_round_trip, write_sequences

COUNTS, WORDS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
texts = st.lists(st.one_of(st.none(), st.text(st.sampled_from(list("ab \n\t|.é日 '1!A")), max_size=30)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(texts)
def test_words_and_lines(values):
    data, offsets = arrays.utf8(pa.array(values, pa.string()))
    word, line = arrays.words(data, offsets), arrays.lines(data, offsets)
    raw = data.tobytes()
    for spans, split in ((word, brute.WORD.findall), (line, lambda t: t.split("\n") if t else [])):
        got = [(int(d), raw[a:b].decode()) for a, b, d in zip(*spans)]
        assert got == [(k, w) for k, t in enumerate(values) for w in split(t or "")]
    keys = arrays.span_hash(data, word.start, word.end)
    assert len(set(keys.tolist())) == len({w for t in values for w in brute.WORD.findall(t or "")})


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=6))
def test_merging_in_step_gives_the_library_counts(values):
    want = [len(e.ids) for e in Tokenizer.from_file(COUNTS).encode_batch(values, add_special_tokens=False)]
    merger = PairMerger(COUNTS)
    assert [merger.count_whole(v) for v in values] == want


def pairs(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("table", ["docs", "odd", "none"])
def test_quality(table, request):
    rows = request.getfixturevalue(table)
    out = clean_lines(rows)
    got = Counter((r["row"]["doc_id"], *[r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")]) for r in out.collect())
    assert got == Counter((r["doc_id"], *brute.quality(r["text"])) for r in rows.collect())
    assert out.where("kept AND base_failed").isEmpty()


def test_quality_removes_failing_lines(spark):
    other = " ".join(f"words{k}" for k in range(100))
    prose = "These are plain words that stand in a line of their own."
    text = f"Home | News | Shop | Login\n{prose}\n{prose}\nWe use cookies here.\nBUY!! NOW!! IT!! IS!! GOOD!!\n\nOther {other}"
    rows = spark.createDataFrame([(1, text), (2, "a | b | c | d\n" * 9 + "x.")], "doc_id long, text string")
    good, bad = sorted(clean_lines(rows).collect(), key=lambda r: r["row"]["doc_id"])
    assert good["clean_text"] == f"{prose}\n\nOther {other}" and good["kept"] and good["n_removed_lines"] == 4
    assert not bad["kept"]


def test_quality_verdict_of_long_lines_questions_and_neighbours(spark):
    prose = " ".join(f"w{k * k % 97}x{k}" for k in range(300))
    said = [f"{prose} {p.title()} {prose.replace('w', 'v')}" for p in BOILERPLATE]
    talk = f"What is it?\nWho?\nIt is this!\n{prose}"
    short = f"Spread more of it.\nRead more\n\u201cClick here\u201d now\nNO!! NO!!\nPrivacy Policy | Terms of use\n{prose}"
    values = [*said, talk, f"{prose} click ", f"here {prose}", short, "We use cookies. " + "Read more. " * 40, f"{prose}\nread more", " ".join(BOILERPLATE)]
    rng, parts = random.Random(1), [*BOILERPLATE, "a", "bread", "more?", "!", "|", "##", "x1", "\n", "\n", "é", prose]
    values += ["".join(rng.choice(parts) + rng.choice([" ", "", "\n"]) for _ in range(rng.randrange(1, 30))) for _ in range(300)]
    rows = spark.createDataFrame(list(enumerate(values)), "doc_id long, text string").coalesce(1)
    got = {r["row"]["doc_id"]: (r["clean_text"], r["n_removed_lines"], r["kept"]) for r in clean_lines(rows).collect()}
    assert got == {k: brute.verdict(v, BOILERPLATE) for k, v in enumerate(values)}
    assert all(got[k] == (values[k], 0, True) for k in range(len(said) + 3))
    assert got[len(said) + 3] == (f"Spread more of it.\n{prose}", 4, True) and not got[len(said) + 4][2]


@pytest.mark.parametrize("table", ["docs", "odd", "none"])
def test_token_counts(table, request):
    rows = request.getfixturevalue(table)
    known = rows.select("doc_id", "text").collect()
    sizes = [len(e.ids) for e in Tokenizer.from_file(COUNTS).encode_batch([r["text"] or "" for r in known], add_special_tokens=False)]
    want = Counter((r["doc_id"], len((r["text"] or "").encode()), n, n > 512) for r, n in zip(known, sizes))
    assert pairs(count_tokens(rows, COUNTS), "doc_id", "n_bytes", "n_tokens", "over_limit") == want


def test_token_files_hold_the_library_ids(spark, docs, odd, none):
    for rows in (docs, odd, none):
        known = rows.select("doc_id", "text").collect()
        ids = [np.array([*e.ids, 2], "<u4") for e in Tokenizer.from_file(WORDS).encode_batch([r["text"] or "" for r in known], add_special_tokens=False)]
        out = sequence_round_trip(rows, WORDS, 2, length=256).collect()
        assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in out) == Counter((r["doc_id"], len(x), zlib.crc32(x.tobytes())) for r, x in zip(known, ids))
        out.sort(key=lambda r: r["start"])
        assert [r["start"] for r in out] == [0, *np.cumsum([r["n_tokens"] for r in out])[:-1]] if out else True
        order = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in out]
        assert order == sorted(order)


def test_sequences_are_of_equal_length_and_mapped_without_a_copy(spark, docs, tmp_path):
    files = write_sequences(docs, f"file://{tmp_path}", WORDS, 2, length=128)
    total = 0
    for f in files.collect():
        mapped = pa.memory_map(f["path"].removeprefix("file://"))
        base, size = mapped.read_buffer(mapped.size()).address, mapped.size()
        mapped.seek(0)
        real = 0
        for batch in pa.ipc.open_stream(mapped):
            assert batch.schema.field("ids").type == pa.list_(pa.uint16(), 128)
            assert base <= batch.column("ids").values.buffers()[1].address < base + size
            real += sum(batch.column("mask").flatten().to_pylist())
        assert real == f["n_ids"]
        total += real
        with open_for_read(f["index_path"]) as raw:
            assert sum(sum(b.column("n").to_pylist()) for b in pa.ipc.open_stream(raw)) == real
    assert total == sum(r["n_tokens"] for r in read_documents(files, "doc_id", "bigint").collect())


def test_encoder_starts_anew_when_its_table_is_full():
    encoder = WordEncoder(WORDS)
    encoder.known.limit = 40
    tokenizer = Tokenizer.from_file(WORDS)
    for k in range(5):
        values = [" ".join(f"{c}{k}{i}" for i in range(15)) for c in "pq"]
        ids, sizes = encoder.encode(pa.array(values))
        want = [e.ids for e in tokenizer.encode_batch(values, add_special_tokens=False)]
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == want


def test_patterns_agree():
    assert re.sub(brute.WORD, "", "a\x0bb c d") == "\x0b "
