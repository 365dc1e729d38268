"""Near-dedup and substring dedup against plain versions."""

import random

import pytest
from brute import components, sha, substrings
from pyspark.sql import functions as F

from strobe.llm import near_dedup, substring_dedup
from strobe.llm.shared import connected_components


def prose(rng, n):
    return [rng.choice("ab cd ef gh ij kl mn op qr st uv wx yz".split()) + str(rng.randint(0, 60)) for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    rows, passage = [], prose(rng, 40)
    for _ in range(10):
        base = prose(rng, rng.randint(5, 120))
        for _ in range(rng.choice((1, 2, 6, 20))):
            words = list(base)
            for _ in range(rng.choice((0, 0, 1, 2, 3, 6))):
                words[rng.randrange(len(words))] = rng.choice(("X", "y", "new"))
            if rng.random() < 0.3:
                at = rng.randrange(len(words))
                words[at:at] = passage
            rows.append((len(rows), " ".join(words).upper() if rng.random() < 0.1 else " ".join(words)))
    rng.shuffle(rows)
    return rows


EDGES = [(900, None), (901, ""), (902, " \t\n"), (903, "one"), (904, "ONE"), (905, "one two"), (None, "one"), (None, None)]


def check_components(docs, rows, size, percent):
    got = near_dedup.near_duplicates(docs, size, percent).collect()
    want, sizes = components([r for r in rows if r[0] is not None], size, percent)
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id], r
            assert r.n_shingles in sizes[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def test_components_match_plain_version(make_docs, corpus):
    # repeated ids are one node, whatever their texts
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    rows = corpus + EDGES + [(-1, a), (-2, b), (907, a), (907, b), (907, b)]
    check_components(make_docs(rows), rows, 3, 85)


def test_cluster_step_alone_gives_the_same_groups(make_docs, corpus, monkeypatch):
    monkeypatch.setattr(near_dedup, "ROUNDS", 0)
    monkeypatch.setattr(near_dedup, "BLOCK", 16)
    check_components(make_docs(corpus), corpus, 3, 85)


def test_one_document_of_each_group_stays(make_docs, corpus):
    docs = make_docs(corpus + EDGES + [corpus[0], corpus[0]])
    kept = near_dedup.keep_representatives(docs)
    assert kept.columns == docs.columns
    want, _ = components([r for r in corpus + EDGES if r[0] is not None], 5, 80)
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({i for i in want if want[i] == i})
    assert sum(i is None for i in ids) == 2


def test_no_documents(make_docs):
    none = make_docs([])
    assert near_dedup.keep_representatives(none).count() == 0
    assert substring_dedup.dedup_spans(none).count() == 0


def test_scheme_bounds_the_miss():
    for size, percent in ((3, 85), (5, 80), (5, 50), (2, 95)):
        s = near_dedup.scheme(size, percent)
        assert s.errors // s.chunks == 1
    with pytest.raises(ValueError):
        near_dedup.scheme(3, 1)


def test_chains_end_in_the_smallest_node(spark):
    edges = [(i, i + 1) for i in range(0, 20)] + [(100, 99), (99, 98), (7, 7), (200, 201)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(21)} | {98: 98, 99: 98, 100: 98, 200: 200, 201: 200}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def check_substrings(docs, rows, **options):
    got = substring_dedup.dedup_spans(docs, **options).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("h"), "spans").collect()
    want = sorted(((i, n, gone, sha(kept)) for i, n, gone, kept in substrings(rows)), key=str)
    assert sorted(((r[0], r[1], r[2], r[3]) for r in got), key=str) == want
    return got


def test_substrings_match_plain_version(make_docs, corpus):
    rng = random.Random(2)
    passage = prose(rng, 60)
    rows = corpus + EDGES
    for i in range(1000, 1060):
        words = prose(rng, rng.randint(0, 40))
        a = rng.randrange(45)
        rows.append((i, " ".join(words + passage[a : a + rng.randint(10, 40)] + prose(rng, 10))))
    rows += [(2000, " ".join(passage)), (2000, " ".join(passage)), (None, " ".join(passage)), (2001, "w " * 50), (2002, "w " * 40)]
    rows.append((-5, " ".join(passage[5:30])))
    rng.shuffle(rows)
    docs = make_docs(rows).repartition(5)
    check_substrings(docs, rows)
    check_substrings(docs, rows, buckets=3)


def test_spans_name_their_source(make_docs):
    rng = random.Random(3)
    passage = prose(rng, 30)
    rows = [(1, " ".join(prose(rng, 5) + passage + prose(rng, 5))), (2, " ".join(prose(rng, 9) + passage + prose(rng, 4)))]
    got = {r.doc_id: r for r in check_substrings(make_docs(rows), rows)}
    assert got[1].spans == []
    (span,) = got[2].spans
    assert (span.start, span.length, span.owner, span.owner_start) == (9, 30, 1, 5)


def test_long_texts(make_docs):
    rng = random.Random(4)
    long = prose(rng, 120_000)
    rows = [(1, " ".join(long)), (2, " ".join(long[50_000:])), (3, " ".join(prose(rng, 30) + long[:20]))]
    check_substrings(make_docs(rows), rows)


def test_near_dedup_leaves_no_joined_table_in_the_driver(spark, make_docs, monkeypatch):
    """Every table that the rounds write is joined by shuffles; the session's
    own setting is there again afterwards, also after a failure."""
    from strobe.llm import near_dedup, shared

    conf, seen = "spark.sql.autoBroadcastJoinThreshold", []
    before = spark.conf.get(conf)
    write = shared.materialise
    for module in (near_dedup, shared):
        monkeypatch.setattr(module, "materialise", lambda df, purpose: seen.append(spark.conf.get(conf)) or write(df, purpose))
    words = " ".join(f"word{i}" for i in range(60))
    rows = near_dedup.near_duplicates(make_docs([(1, words), (2, words + " more"), (3, "other text of its own")])).collect()
    assert {r.doc_id: r.component_id for r in rows} == {1: 1, 2: 1, 3: 3}
    assert seen and set(seen) == {"-1"}
    assert spark.conf.get(conf) == before

    def broken(df, purpose):
        raise OSError

    monkeypatch.setattr(near_dedup, "materialise", broken)
    with pytest.raises(OSError):
        near_dedup.near_duplicates(make_docs([(1, "a b")]))
    assert spark.conf.get(conf) == before
