"""Quality rules, toxicity, decontamination, licenses."""

import random
import textwrap

import numpy as np
import pytest
from brute import rule_counts

from strobe.llm import decontamination, licenses, quality_rules, toxicity
from strobe.llm.shared import crc32_text, held_out_column
from strobe.llm.words import chunks, covered

import pyarrow as pa

VOCABULARY = [f"{a}{b}{c}" for a in ("ba", "ko", "mi", "ru") for b in ("len", "tor", "sa", "vi") for c in ("", "n", "st", "ra")]


def prose(rng, n, words=VOCABULARY):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    return [(i, prose(rng, rng.randint(20, 120))) for i in range(200)]


EDGES = [(None, "null id with some words in it"), (1000, None), (1001, ""), (1002, " \n\t"), (1003, "a b c d e f g h i j\na b c d e f g h i j"),
         (1004, "x\x0by\x0cz é ü # * $"), (1005, "same line here\nsame line here\n \nsame line here "), (1005, "again"), (1006, "w " * 300_000)]


def test_rule_counts_match_plain_version(spark, make_docs, corpus):
    docs = make_docs(corpus + EDGES)
    got = quality_rules.apply_rules(docs, quality_rules.Forest()).collect()
    want = sorted((i, *rule_counts(t)) for i, t in corpus + EDGES if i is not None)
    have = sorted((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got if r.doc_id is not None)
    assert have == want
    assert sum(r.doc_id is None for r in got) == 1
    assert all(r.kept == (not r.base_failed) for r in got)


def test_forest_rejects_junk_and_keeps_columns(spark, make_docs, corpus):
    rng = random.Random(5)
    junk = [(i, " ".join(w + "***" for w in prose(rng, 60).split())) for i in range(500, 560)]
    docs = make_docs(corpus + junk)
    labels = spark.createDataFrame([(i, 1) for i, _ in corpus[:150]] + [(i, 0) for i, _ in junk[:40]] + [(None, 1), (3, None)], "doc_id long, quality int")
    forest = quality_rules.fit_forest(docs, labels)
    kept = quality_rules.keep_documents(docs, forest)
    assert kept.schema == docs.schema
    ids = {r.doc_id for r in kept.collect()}
    assert not ids & {i for i, _ in junk}
    assert len(ids & {i for i, _ in corpus}) >= 195


def test_rules_without_rows_or_labels(spark, make_docs):
    none = make_docs([])
    labels = spark.createDataFrame([], "doc_id long, quality int")
    forest = quality_rules.fit_forest(none, labels)
    assert forest.threshold == float("inf")
    assert quality_rules.apply_rules(none, forest).count() == 0
    assert quality_rules.keep_documents(none, forest).columns == none.columns


def test_chunks_cover_long_texts():
    texts = pa.array(["a" * 10, None, "b c " * 1000, "", "d"])
    parts = list(chunks(texts, 100))
    assert [c.rows.stop - c.rows.start for c in parts] == [2, 1, 2]
    assert covered(np.array([0, 1, 0, 0, 0, 1], dtype=bool), 2).tolist() == [False, True, True, False, False, True]


def test_held_out_rows(spark):
    got = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long").withColumn("h", held_out_column()).collect()
    assert all(r.h == (r.doc_id is not None and crc32_text(r.doc_id) % 5 == 0) for r in got)


def test_toxicity_learns_words_and_pairs(spark, make_docs):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(1200):
        text = prose(rng, 30)
        kind = i % 4
        # "grolk" and "zint" are harmless alone; together, or "vermel", they are not
        text += {0: " grolk", 1: " zint", 2: " grolk zint", 3: ""}[kind] + (" VERMEL!" if i % 10 == 3 else "")
        rows.append((i, text))
        labels.append((i, int(kind == 2 or i % 10 == 3)))
    docs = make_docs(rows + [(5000, None), (5001, ""), (None, "vermel")])
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    machine = toxicity.fit_machine(docs, known, ~held_out_column())
    got = {r.doc_id: r.score for r in toxicity.score_documents(docs, machine).collect()}
    assert len(got) == 1203
    held = [(i, y) for i, y in labels if crc32_text(i) % 5 == 0]
    right = np.mean([(got[i] >= 0.5) == (y == 1) for i, y in held])
    assert right > 0.95
    assert got[5000] == got[5001] < 0.5
    assert all(0 <= s <= 1 for s in got.values())


def test_toxicity_without_labels(spark, make_docs):
    docs = make_docs([(1, "a b"), (2, None)])
    machine = toxicity.fit_machine(docs, spark.createDataFrame([], "doc_id long, toxic int"), ~held_out_column())
    assert {r.score < 0.5 for r in toxicity.score_documents(docs, machine).collect()} == {True}
    assert toxicity.score_documents(make_docs([]), machine).count() == 0


def test_leaks_are_found_and_clean_documents_are_not(spark, make_docs):
    rng = random.Random(7)
    # texts of many rare words
    own = [f"{a}{b}{c}" for a in VOCABULARY[:12] for b in VOCABULARY[:12] for c in ("o", "e", "ing")]
    items = [(i, prose(rng, 40, own) + ". The answer is " + prose(rng, 3, own)) for i in range(20)]
    clean = [(i, prose(rng, rng.randint(1, 200), own)) for i in range(100)]
    leaks, paraphrased = [], []
    for i, text in items:
        leaks.append((200 + i, prose(rng, 50, own) + " " + text.upper() + " " + prose(rng, 50, own)))
        words = text.split()
        for p in rng.sample(range(len(words) - 6), 5):
            words[p] = rng.choice(own)
        paraphrased.append((300 + i, prose(rng, 20, own) + " " + " ".join(words)))
    docs = make_docs(clean + leaks + paraphrased + [(None, items[0][1]), (400, None), (401, "")])
    benchmark = spark.createDataFrame(items + [(50, None), (51, ""), (52, items[3][1])], "item_id long, text string")
    found = decontamination.flag_documents(docs, benchmark).collect()
    by = {r.doc_id: r[decontamination.ITEM_COLUMN] for r in found}
    assert len(found) == len(clean) + 43
    assert [by[i] for i, _ in leaks] == [i for i, _ in items]
    assert [by[i] for i, _ in paraphrased] == [i for i, _ in items]
    assert by[None] == 0 and by[400] is None and by[401] is None
    assert not any(by[i] is not None for i, _ in clean)
    kept = decontamination.drop_leaks(docs, benchmark)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in clean} | {400, 401}


def test_blocks_of_the_benchmark_agree(spark, make_docs, monkeypatch):
    rng = random.Random(8)
    items = [(i, prose(rng, 30)) for i in range(9)]
    docs = make_docs([(i, prose(rng, 20) + " " + items[i % 9][1]) for i in range(18)])
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    whole = {r.doc_id: r[decontamination.ITEM_COLUMN] for r in decontamination.flag_documents(docs, benchmark).collect()}
    monkeypatch.setattr(decontamination, "ITEMS", 3)
    parts = {r.doc_id: r[decontamination.ITEM_COLUMN] for r in decontamination.flag_documents(docs, benchmark, text=False).collect()}
    assert whole == parts == {i: i % 9 for i in range(18)}
    assert decontamination.flag_documents(make_docs([]), benchmark).count() == 0
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.drop_leaks(docs, empty).count() == 18


def test_recall_does_not_depend_on_the_size_of_the_benchmark(spark, make_docs):
    rng = random.Random(10)
    own = [a + b + c for a in VOCABULARY for b in VOCABULARY for c in ("", "e")]
    items = [(i, prose(rng, 38, own)) for i in range(1200)]
    docs = make_docs([(i, prose(rng, 40, own) + " " + t + " " + prose(rng, 40, own)) for i, t in items])
    found = decontamination.flag_documents(docs, spark.createDataFrame(items, "item_id long, text string"), text=False).collect()
    assert {r.doc_id: r[decontamination.ITEM_COLUMN] for r in found} == {i: i for i, _ in items}


def test_copies_of_short_and_long_items(spark, make_docs, monkeypatch):
    rng = random.Random(11)
    common = [a + b for a in VOCABULARY[:10] for b in VOCABULARY[:10]]
    rare = [a + b + "u" for a in VOCABULARY for b in VOCABULARY]
    items = [(i, prose(rng, n, common + rare)) for i, n in enumerate([5, 5, 9, 15, 16, 40, 64, 65, 300, 300, 1000, 1000])]
    items.append((12, prose(rng, 5, common)))
    clean = [(100 + i, prose(rng, 300, common + rare)) for i in range(60)]
    docs = make_docs([(i, prose(rng, 200, rare) + " " + t + " " + prose(rng, 207, rare)) for i, t in items] + clean)
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = {i: i for i, _ in items} | {i: None for i, _ in clean}
    found = decontamination.flag_documents(docs, benchmark).collect()
    assert {r.doc_id: r[decontamination.ITEM_COLUMN] for r in found} == want
    # several blocks and passes
    monkeypatch.setattr(decontamination, "ITEMS", 30)
    monkeypatch.setattr(decontamination, "SPACES", 2)
    found = decontamination.flag_documents(docs, benchmark, text=False).collect()
    assert {r.doc_id: r[decontamination.ITEM_COLUMN] for r in found} == want


def test_subsequence_against_dynamic_programming():
    rng = random.Random(9)
    for _ in range(50):
        a, b = [rng.randint(0, 6) for _ in range(rng.randint(1, 30))], [rng.randint(0, 6) for _ in range(rng.randint(0, 40))]
        row = [0] * (len(b) + 1)
        for x in a:
            last = row[:]
            for j, y in enumerate(b):
                row[j + 1] = last[j] + 1 if x == y else max(row[j], last[j + 1])
        masks = decontamination._masks(np.array(a, dtype=np.uint64))
        assert decontamination.common_subsequence(masks, len(a), b) == row[-1]


def test_license_notices(spark, make_docs):
    apache = "Licensed under the Apache License, Version 2.0."
    rows = [
        (1, f"Some prose here.\n{apache}"), (2, "Released under the MIT License."), (3, "Licensed under CC BY-NC 4.0."),
        (4, "This work is licensed under the GNU General Public License, version 3. More text."),
        (5, "Licensed under the Apache License, Version 7.1."), (6, "A license to drive is needed."), (7, None), (8, ""),
        (9, "é" * 30 + ". " + apache), (None, apache), (10, "Released under the terms of the MIT License."), (10, apache),
    ]
    got = licenses.scan_licenses(make_docs(rows)).collect()
    found = {(r.doc_id, r.license) for r in got}
    assert found == {(1, "Apache-2.0"), (2, "MIT"), (3, "CC-BY-NC-4.0"), (4, "GPL-3.0"), (9, "Apache-2.0"), (None, "Apache-2.0"), (10, "MIT"), (10, "Apache-2.0")}
    nine = next(r for r in got if r.doc_id == 9)
    assert ("é" * 30 + ". " + apache)[nine.start : nine.start + nine.length].strip() == apache and nine.exact
    worded = next(r for r in got if r.doc_id == 10 and r.license == "MIT")
    assert worded.added == "terms of the" and not worded.exact
    assert licenses.scan_licenses(make_docs([])).count() == 0


def test_notices_among_other_legal_lines(spark, make_docs):
    header = "Copyright (c) 2019 Jane Doe <jane@example.org>. All rights reserved.\n"
    warranty = "The software is provided as is, without warranty of any kind, express or implied.\n"
    mit, isc, cc, apache = (licenses.TEMPLATES[k][0] + "\n" for k in ("MIT", "ISC", "CC-BY-4.0", "Apache-2.0"))
    legal = [f"Copyright (c) {1990 + i} holder number {i}.\nNo license is given for part {i} of the redistributable files.\n" for i in range(8)]
    rows = [(1, header + mit + warranty), (2, "".join(legal[:4]) + mit + "".join(legal[4:])), (3, mit + header + isc + cc + apache + "This work is licensed under the GNU General Public License, version 2.")]
    got = licenses.scan_licenses(make_docs(rows)).collect()
    assert {(r.doc_id, r.license) for r in got} == {(1, "MIT"), (2, "MIT"), *((3, k) for k in ("MIT", "ISC", "CC-BY-4.0", "Apache-2.0", "GPL-2.0"))}
    assert all(r.exact for r in got)
    texts = dict(rows)
    assert [texts[r.doc_id][r.start : r.start + r.length].strip() for r in got if r.license == "MIT"] == [mit.strip()] * 3


def test_every_template_matches_its_own_text():
    scanner = licenses.Scanner()
    for name, texts in licenses.TEMPLATES.items():
        for i, text in enumerate(texts):
            for given in (text, f"Some words first. {text} And some prose after it. More of it."):
                assert [(r[2], r[3], r[8]) for r in scanner.scan(given)] == [(name, i, True)], given
            wrapped = "\n".join(textwrap.wrap(text, 60))
            assert [(r[2], r[3], r[8]) for r in scanner.scan(wrapped)] == [(name, i, True)], wrapped
