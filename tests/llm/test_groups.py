"""Suffix and near-duplicate removal, licences, archives and decontamination."""

import hashlib
import random
import textwrap
from collections import Counter

import brute
import numpy as np
import pytest

from millrace.llm import decontaminate, licenses, near, warc
from millrace.llm.decontaminate import find_leaks
from millrace.llm.graph import components
from millrace.llm.licenses import STATEMENTS, UNKNOWN, scan_licenses
from millrace.llm.near import near_duplicates, registers, similarity
from millrace.llm.queries import QUERIES
from millrace.llm.suffix import parse, remove_repeats, triples
from millrace.llm.warc import archive_round_trip, assemble, read_records, write_archives

SF = "/root/testdata/sf0.001"


def removed(df, key="doc_id"):
    return Counter(
        (r[key], r["n_bytes"], sum(s["end"] - s["start"] for s in r["spans"]), len(r["spans"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in df.collect()
    )


@pytest.mark.parametrize("table", ["docs", "odd", "none"])
def test_suffix_dedup(table, request):
    rows = request.getfixturevalue(table).select("doc_id", "text", "source")
    if table == "odd":  # the long texts only through their length, else the plain version takes minutes
        rows = rows.withColumn("text", rows["text"].substr(1, 30_000))
    known = rows.collect()
    want = Counter((r["doc_id"], *w) for r, w in zip(known, brute.repeats([r["text"] for r in known], 400)))
    assert removed(remove_repeats(rows)) == want


def test_suffix_dedup_at_every_kind_of_edge(spark):
    rng = random.Random(5)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    passage = noise(1200)
    texts = [passage[a:b] + noise(c) for a, b, c in ((0, 1200, 0), (100, 500, 900), (100, 499, 900), (700, 1200, 50), (3, 430, 2), (399, 801, 0))]
    texts += [noise(77) + passage[50:449] + "Z", noise(77) + passage[50:450] + "Z", "x" * 1500, "xy" * 500, noise(300) + passage[200:640] + passage[200:640], passage[:399]]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    known = rows.collect()
    assert removed(remove_repeats(rows)) == Counter((r["doc_id"], *w) for r, w in zip(known, brute.repeats([r["text"] for r in known], 400)))


def test_suffix_dedup_query_returns_what_is_left(spark, tmp_path):
    rng = random.Random(8)
    words = lambda n: " ".join("".join(rng.choice("abcdefgh") for _ in range(7)) for _ in range(n))
    passage, short, own = words(60), words(45), [words(80) for _ in range(7)]
    assert len(passage) >= 400 > len(short) + 2
    texts = [f"{own[0]}<{passage}>{own[1]}", f"{own[2]}({passage})", f"{own[3]}<{short}>", f"({short}){own[4]}", own[5], None, ""]
    texts += [f"é{passage[:410]}à", f"è{passage[:410]}á", own[6] + "ü"]  # the last characters of the copies share a byte
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r["doc_id"]: r for r in QUERIES["op1_suffix_dedup"](spark, str(tmp_path)).collect()}
    want = [f"{own[0]}<>{own[1]}", f"{own[2]}()", *texts[2:5], "", "", "é\ufffd", "è\ufffd", texts[9]]
    assert [rows[k]["text"] for k in range(10)] == want
    assert [rows[k]["changed"] for k in range(10)] == [k in (0, 1, 7, 8) for k in range(10)]
    for k, r in rows.items():
        assert r["n_kept"] == r["n_bytes"] - r["n_removed"]
        if k not in (7, 8):
            assert r["n_kept"] == len(r["text"].encode()) and r["kept_sha256"] == hashlib.sha256(r["text"].encode()).hexdigest()
    known = [(r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for _, r in sorted(rows.items())]
    assert known == [(k, *w) for k, w in enumerate(brute.repeats(texts, 400))]


def test_equal_strings_share_a_sampled_triple():
    rng = np.random.default_rng(1)
    for _ in range(50):
        own = rng.integers(97, 101, 400).astype(np.uint8)
        a, b = (np.concatenate([rng.integers(97, 101, rng.integers(0, 300)).astype(np.uint8), own, rng.integers(97, 101, 200).astype(np.uint8)]) for _ in range(2))
        names = [set(triples(x, np.unique(parse(x)))[0].tolist()) for x in (a, b)]
        assert names[0] & names[1]


@pytest.mark.parametrize("table", ["docs", "odd", "none"])
def test_near_duplicates(table, request):
    rows = request.getfixturevalue(table)
    known = [(r["doc_id"], r["text"]) for r in rows.collect()]
    out = near_duplicates(rows, size=4).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in out) == Counter(brute.near(known, 4))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in out)


def test_near_duplicates_in_one_family_of_many(spark):
    """Copies with changes of their own, a chain whose ends are unlike, and texts that share a passage."""
    rng = random.Random(3)
    base = [f"b{i}" for i in range(200)]
    texts = []
    for k in range(120):
        own = list(base)
        for _ in range(rng.randrange(1, 5)):
            own[rng.randrange(200)] = f"c{k}"
        texts.append(" ".join(own))
    texts += [" ".join(f"d{i}" for i in range(8 * k, 8 * k + 100)) for k in range(12)]
    texts += [" ".join([*base[:60], *(f"e{k}x{i}" for i in range(90))]) for k in range(40)]
    rng.shuffle(texts)
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    out = near_duplicates(rows, size=4).collect()
    assert {(r["doc_id"], r["n_shingles"], r["component_id"]) for r in out} == set(brute.near(list(enumerate(texts)), 4))


def test_registers_estimate_the_similarity():
    rng = np.random.default_rng(0)
    both = rng.integers(0, 2**63, 4000).astype(np.uint64)
    for shared in (0, 1000, 3000, 4000):
        a = np.concatenate([both[:shared], rng.integers(0, 2**63, 4000 - shared).astype(np.uint64)])
        regs = registers(np.concatenate([both, a]), np.repeat([0, 1], 4000), 2)
        guess, used = similarity(regs[:1], regs[1:])
        assert used[0] == near.REGISTERS and abs(guess[0] - shared / (8000 - shared)) < 0.15


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 150)] + [(7, 7), (200, 201)]
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 150)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def test_license_scan(spark, docs, odd, none):
    planted = [(k, f"Some words before.\n{s}\nand after", f, "x") for k, (f, s) in enumerate((f, s) for f, all_ in STATEMENTS.items() for s in all_)]
    clean = [(1000 + k, t, UNKNOWN, "x") for k, t in enumerate(["The court released him under the bridge.", "A driving license is needed.", "", None, "Public general words."])]
    rows = spark.createDataFrame(planted + clean, "doc_id long, text string, family string, probability string")
    rows = rows.unionByName(docs.selectExpr("doc_id + 5000 AS doc_id", "text"), allowMissingColumns=True)
    out = scan_licenses(rows)
    got = Counter((r["doc_id"], r["family"]) for r in out.collect() if r["family"] != UNKNOWN and r["doc_id"] < 5000)
    assert got == Counter((k, f) for k, _, f, _ in planted)
    lines = {"Apache": "Apache License, V", "MIT": "under the MIT License", "GPL": "GNU General Public", "CC-BY-NC": "under CC BY-NC"}
    want = Counter((r["doc_id"] + 5000, f) for r in docs.collect() for f, p in lines.items() for line in (r["text"] or "").split("\n") if p in line)
    assert Counter((r["doc_id"], r["family"]) for r in out.collect() if r["family"] != UNKNOWN and r["doc_id"] >= 5000) == want
    assert scan_licenses(odd).where(f"family <> '{UNKNOWN}'").isEmpty() and scan_licenses(none).isEmpty()


MIT_NOTICE = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and
associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the
Software is furnished to do so, subject to the following conditions: The above copyright notice shall be included in all copies."""
BSD_NOTICE = """Copyright (c) 2020, The Authors. Redistribution and use in source and binary forms, with or without modification,
are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice."""
LGPL_NOTICE = """This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."""


def test_license_scan_of_wrapped_notices_and_names(spark):
    notices = [(MIT_NOTICE, "MIT"), (BSD_NOTICE, "BSD"), (LGPL_NOTICE, "LGPL"), *((s, f) for f, all_ in STATEMENTS.items() for s in all_)]
    want, texts = Counter(), []
    for text, family in notices:
        for mark, width in (("", 72), (" * ", 38), ("# ", 60)):
            own = "\n".join(mark + line for line in textwrap.wrap(text, width))
            want[len(texts), family] += 1
            texts.append(f"{mark}some words before\n{mark.rstrip()}\n{own}\n{mark.rstrip()}\n{mark}and after it all")
    for name, family in (("MIT License", "MIT"), ("License: MIT", "MIT"), ("# License: BSD-3-Clause", "BSD")):
        want[len(texts), family] += 1
        texts.append(f"Some project\n{name}\nby its authors")
    long = " ".join(f"w{k * k % 97}x{k}" for k in range(400))
    want[len(texts), "MIT"] += 1
    want[len(texts), "Apache"] += 1
    texts.append(f"{long} {STATEMENTS['MIT'][3]} {long} {STATEMENTS['Apache'][2]} {long}")
    texts += ["We read the MIT License and the general public did not.", f"{long} software {long}"]
    out = scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = Counter((r["doc_id"], r["family"]) for r in out if r["family"] != UNKNOWN)
    assert got == want, [(texts[k], f) for k, f in (got - want) + (want - got)]


def plain_shares(paragraph: str) -> dict[str, float]:
    """For each family the largest share of a statement's bigrams that a window or a name holds."""
    words, best = licenses._words(paragraph), dict.fromkeys(STATEMENTS, 0.0)
    spans = [words[k : k + size] for size in licenses.WINDOWS for k in range(0, max(len(words) - size // 2, 1), size // 2)]
    for family, all_ in STATEMENTS.items():
        for pairs in ({*licenses._pairs(licenses._words(x))} for x in all_):
            best[family] = max([best[family], *(len(pairs & {*licenses._pairs(span)}) / len(pairs) for span in spans)])
        names = {" ".join(licenses._words(x)) for x in licenses.NAMES[family]}
        if names & {" ".join(licenses._words(line)) for line in paragraph.split("\n")}:
            best[family] = 1.0
    return best


def test_license_scan_against_every_window(spark, docs):
    """What stands is what templates confirm, with the similarity they give; statements with a word
    changed, among words of their own, are found."""
    rng = random.Random(3)
    prose = [w for r in docs.collect() for w in (r["text"] or "").split()]
    some = lambda n: " ".join(rng.choice(prose) for _ in range(n))
    planted = []
    for family, all_ in STATEMENTS.items():
        for statement in all_:
            words = statement.split()
            if len(words) > 8:
                words[rng.randrange(len(words))] = "altered"
            planted.append((len(planted), f"{some(rng.randint(0, 60))} {' '.join(words)} {some(rng.randint(0, 60))}", family))
    long = some(30_000)
    texts = [(k, t) for k, t, _ in planted] + [(1000, f"{long} {STATEMENTS['GPL'][2]} {long}")]
    rows = spark.createDataFrame(texts, "doc_id long, text string").unionByName(docs.selectExpr("doc_id + 5000 AS doc_id", "text"))
    out = scan_licenses(rows).collect()
    for r in out:
        if len(r["paragraph"]) < 20_000:
            shares = plain_shares(r["paragraph"])
            assert r["family"] == UNKNOWN or (r["similarity"] <= shares[r["family"]] + 1e-9 and r["similarity"] >= 0.7)
            assert r["family"] != UNKNOWN or r["similarity"] is None
    got = {(r["doc_id"], r["family"]) for r in out if r["family"] != UNKNOWN}
    sure = {(k, f) for k, t, f in planted if (shares := plain_shares(t))[f] >= 0.7 and shares[f] == max(shares.values())}
    assert len(sure) > 30 and len(sure & got) >= 0.9 * len(sure) and (1000, "GPL") in got
    assert not {(k, f) for k, f in got if k < 1000 and f != planted[k][2]}


def pages(spark):
    tricky = "<p>" + "x" * 120 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n</p>"
    rows = [
        (1, "http://a/1", tricky, "q"), (2, None, tricky, "q"), (3, "http://a/3\r\nX: y", None, None), (4, "http://a/4", "", "q"), (5, "", "é" * 49, "q"),
        (6, "http://a/6", "é" * 49, "q"), (7, "u", "é" * 50, "q"), (8, "u", "é" * 50, "q"), (9, "u", "long " * 200_000, "q"), (10, "u", "long " * 200_000, "q"),
        (None, "u", tricky, "q"), (11, "u", "same " * 30, "q"), (11, "u", "same " * 30, "q"),
    ]
    return spark.createDataFrame(rows, "page_id long, url string, html string, main string").repartition(3)


def test_archives_round_trip(spark):
    rows = pages(spark)
    known = [(r["page_id"], (r["html"] or "").encode()) for r in rows.collect()]
    first: dict = {}
    for k, body in known:
        if k is not None:
            first[body] = min(first.get(body, k), k)
    out = archive_round_trip(rows).collect()
    got = Counter((r["key"], r["main"]["payload_digest"], r["main"]["payload_bytes"] if r["main"]["kind"] == "response" else r["original"]["payload_bytes"]) for r in out)
    assert got == Counter((None if k is None else str(k), hashlib.sha256(b).hexdigest(), len(b)) for k, b in known)
    kinds = Counter((r["key"], r["main"]["kind"], r["original"]["key"] if r["original"] else None) for r in out)
    want = Counter()
    for k, b in known:
        again = len(b) >= 100 and (first[b] != k or (k == 11 and want[("11", "response", None)]))
        want[(None if k is None else str(k), "revisit" if again else "response", str(first[b]) if again else None)] += 1
    assert kinds == want
    assert all(len(r["requests"]) == len(r["metadata"]) == 1 for r in out)


def test_archives_give_odd_keys_back(spark):
    keys = ["", " ", "k\r\nx: 1", "a%41+b c", "%", "é\u2028\x85", "\x00", "plain", None]
    rows = spark.createDataFrame([(k, k, f"page {n}") for n, k in enumerate(keys)], "page_id string, url string, html string")
    assert Counter(r["key"] for r in archive_round_trip(rows).collect()) == Counter(keys)


@pytest.mark.parametrize("copies", [1, 2, 25])
def test_archives_choose_the_first_by_content(spark, copies, monkeypatch):
    """Equal rows in any order and number: one response, and a capture for every row."""
    monkeypatch.setattr(warc, "PIECE", 4)
    long, other = "same " * 30, "else " * 30
    known = [(3, "b", long), (3, None, long), (4, "a", long), (None, "a", long), (5, None, other), (6, "s", "short"), (6, "s", "short")]
    known += [(3, "a", long)] * copies + [(None, "z", "none " * 30)] * copies
    for seed in (1, 2):
        rows = random.Random(seed).sample(known, len(known))
        out = archive_round_trip(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)).collect()
        responses = Counter((r["key"], r["main"]["uri"]) for r in out if r["main"]["kind"] == "response")
        assert responses == Counter({("3", "a"): 1, ("5", None): 1, ("6", "s"): 2, (None, "z"): 1})
        assert Counter(r["key"] for r in out) == Counter(None if k is None else str(k) for k, _, _ in known)
        assert all(r["original"]["payload_bytes"] == 150 for r in out if r["main"]["kind"] == "revisit")


def test_a_payload_of_most_rows_is_split(spark):
    """The first captures are stored, so that the join may split a digest; the plan shows an exchange on either side."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(6000).selectExpr("id AS page_id", "sha2(string(-id), 512) AS url", "if(id % 3 = 0, repeat('hot ', 60), repeat(sha2(string(id), 256), 3)) AS html")
        firsts, joined = warc.marked(rows.repartition(12), "page_id", "url", "html", 100)
        shown = joined.selectExpr("count(*)", "count(first)", "sum(octet_length(url) + octet_length(body))")
        assert tuple(shown.collect()[0]) [:2] == (6000, 2000) and firsts.count() == 1
        assert "skew=true" in shown._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_archives_keep_payloads_and_roll_files(spark, tmp_path):
    rows = pages(spark)
    files = write_archives(rows, str(tmp_path), file_bytes=1000)
    assert files.count() > 3
    out = assemble(read_records(files)).where("main.kind = 'response'").collect()
    got = {r["key"]: bytes(r["main"]["body"]).decode() for r in out}
    assert all(got[str(r["page_id"])] == (r["html"] or "") for r in rows.collect() if str(r["page_id"]) in got) and len(got) == 8
    assert archive_round_trip(rows.limit(0)).isEmpty()


@pytest.mark.parametrize("size", [decontaminate.INDEX_BYTES, 12_000])
def test_leaks(spark, docs, odd, none, size, monkeypatch):
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", size)
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    known, items = ([tuple(r) for r in t.select(k, "text").collect()] for t, k in ((docs, "doc_id"), (benchmark, "item_id")))
    got = {(r["doc_id"], r["item_id"]) for r in find_leaks(docs, benchmark).collect()}
    assert got == brute.leaks(known, items) and got
    extra = spark.createDataFrame([(1, odd_item, "z") for odd_item in ("", None, "one two", "one two")], "item_id long, text string, doc_id string")
    assert {r["doc_id"] for r in find_leaks(odd, extra).collect()} == {9, 10}
    assert find_leaks(none, benchmark).isEmpty() and find_leaks(docs, extra.limit(0)).isEmpty()


@pytest.mark.parametrize("step", [decontaminate.STEP, 50])
def test_every_item_that_scores_enough_is_retrieved(spark, docs, step, monkeypatch):
    """Against BM25 of every item in every passage, at thresholds that many reach."""
    monkeypatch.setattr(decontaminate, "STEP", step)
    rng = random.Random(5)
    items = [(k, " ".join(f"w{int(300 * rng.random() ** 3)}" for _ in range(rng.randint(1, 40)))) for k in range(300)]
    texts = [(k, " ".join(f"w{int(330 * rng.random() ** 3)}" for _ in range(rng.randint(0, 400)))) for k in range(25)]
    texts += [(100, items[0][1]), (101, f"{texts[0][1]} {items[7][1]} {texts[1][1]}"), (102, "")]
    found = find_leaks(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), threshold=0.7, overlap=0.0)
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in found.collect()}
    want = brute.bm25(texts, items, max(40, 32))
    assert {k for k, v in want.items() if v >= 0.7 + 1e-3} <= got.keys() <= {k for k, v in want.items() if v >= 0.7 - 1e-3}
    assert 100 < len(got) < len(want) / 2 and all(abs(want[k] - v) < 1e-4 for k, v in got.items())


def test_index_grows_with_its_postings_alone(tmp_path):
    """3,000 items over 30,000 terms: a table of them would take 360 MB."""
    rng = np.random.default_rng(3)
    terms = [np.unique(rng.integers(0, 30_000, 34)) for _ in range(3000)]
    texts = [" ".join(f"t{t}" for t in own) for own in terms]
    index = decontaminate.Index.build(list(range(3000)), texts, terms, [rng.random(len(t)) + 0.1 for t in terms], 0.9)
    n = sum(map(len, terms))
    assert index.nbytes <= n * (decontaminate.POSTING_BYTES + decontaminate.WORD_BYTES + 8) + 3000 * 40
    same = decontaminate.Index.load(index.save(str(tmp_path)))
    at = np.searchsorted(index.terms, np.concatenate([terms[5], terms[2999]]).astype(np.uint64))
    passage = np.repeat([0, 2], [len(terms[5]), len(terms[2999])])
    for one in (index, same):
        who, item, score = one.retrieve(passage, at, 3)
        assert [(w, int(one.items[i])) for w, i in zip(who, item)] == [(0, 5), (2, 2999)] and np.allclose(score, 1)


def test_leaks_with_other_words_around_case_and_marks(spark):
    item = "What is the capital of the old river province? It is called Marvento since the great flood of the year 1804."
    texts = [
        (1, f"{'filler words all the way ' * 300}{item.upper()}{' and more of it' * 200}"),
        (2, item.replace(" ", "  \n").replace("?", " ???")),
        (3, "What is the capital of the old river province? Nobody knows."),
        (4, "It is called Marvento since the great flood of the year 1804."),
        (5, item.replace("great", "big")),
        (6, "the of is it year what since " * 50),
    ]
    found = find_leaks(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame([(9, item)], "item_id long, text string"))
    assert sorted(r["doc_id"] for r in found.collect()) == [1, 2, 5]


def test_leaks_with_words_changed_in_any_part_of_short_items(spark):
    plain = "the quiet river Ostrel floods its lower valley every eleventh spring when snow melts early upstream"
    long = " ".join(f"t{k * k % 41}x{k}" for k in range(39))
    pair = "Which town lies at the mouth of the river Ostrel? Old Marvento by the sea"
    items, texts, want = [(1, plain), (2, long), (3, pair)], [], set()
    for item, text in items:
        words = text.split()
        for at in range(len(words)):
            own = [f"other{at}" if k == at else w for k, w in enumerate(words)]
            if item == 2:
                own[(at + 4) % len(words)] = "another"
            want.add((len(texts), item))
            texts.append("some words before " + " ".join(own) + " and some after")
    texts += [pair.split("?")[0], pair.split("? ")[1], " ".join(plain.split()[::-1]), " ".join(plain.split()[:7])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = find_leaks(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == want


def test_queries_are_registered_once_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
