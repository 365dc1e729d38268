"""Models are fitted on all rows, not on those with the smallest hashes."""

import random

import numpy as np
from pyspark.sql import functions as F

from strobe.llm import decontamination, pii, quality_rules


def by_hash(spark, n):
    """Ids below n, those that a draw by hash would take last at the end."""
    return [r.id for r in spark.range(n).orderBy(F.xxhash64("id"), "id").collect()]


def test_space_of_the_benchmark_keeps_every_cosine():
    rng = random.Random(2)
    items = [decontamination.Item(i, w, w[:0]) for i, w in enumerate(decontamination._each([" ".join(f"w{rng.randrange(900)}" for _ in range(40)) for _ in range(200)]))]
    block = [(item, *p) for item in items for p in item.passages()]
    idf = np.random.default_rng(1).uniform(0.5, 6, decontamination.SLOTS)
    space = decontamination.fit_space(block, idf)
    dense = np.zeros((len(block), decontamination.SLOTS), dtype=np.float32)
    for i, (item, a, b) in enumerate(block):
        slot, tf = np.unique(decontamination._slots(item.words[a:b]), return_counts=True)
        dense[i, slot] = np.sqrt(tf) * idf[slot]
    used = np.flatnonzero(dense.any(axis=0))
    unit = dense[:, used] / np.linalg.norm(dense[:, used], axis=1)[:, None]
    assert np.abs(space.target @ space.target.T - unit @ unit.T).max() < 1e-4


def test_trees_learn_from_every_document(spark, make_docs):
    rng = random.Random(3)
    hexes = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = []
    for at, i in enumerate(by_hash(spark, 7200)):
        tail = "plain"
        if at >= 6000:
            tail = {0: f'token = "{hexes()}" end', 1: f"hash {hexes()} end", 2: f"a{i}@b.co card 4111 1111 1111 1112", 3: "plain"}[at % 4]
        rows.append((i, f"some words {tail}"))
    docs = make_docs(rows, extra=False)
    added = pii.find_spans(docs, pii.fit_trees(docs)).where(F.size(pii.ADDED) > 0).select("doc_id").collect()
    assert {r.doc_id for r in added} == {i for i, t in rows if "token" in t}


def test_forest_is_calibrated_on_every_labelled_document(spark, make_docs):
    rng = random.Random(4)
    ids = by_hash(spark, 8200)
    words = [f"word{i}" for i in range(400)]
    rows = [(i, " ".join(w + ("***" if at >= 8000 else "") for w in rng.sample(words, 30))) for at, i in enumerate(ids)]
    docs = make_docs(rows, extra=False)
    labels = spark.createDataFrame([(i, int(at < 8000)) for at, i in enumerate(ids)], "doc_id long, quality int")
    forest = quality_rules.fit_forest(docs, labels)
    kept = {r.doc_id for r in quality_rules.keep_documents(docs, forest).collect()}
    assert not kept & set(ids[8000:])
    assert len(kept) >= 8000 * (1 - 2 * quality_rules.MAX_GOOD_REJECTED)


def test_threshold_is_that_of_all_scores(spark):
    """Against the same rule on arrays, ties included."""
    gen = np.random.default_rng(6)
    x = gen.choice(np.linspace(0, 1, 40), (3000, len(quality_rules.FEATURES)))
    label = (gen.random(3000) < 0.9).astype(int)
    x[label == 0] += 0.7
    rows = [(i, int(m), *map(float, v)) for i, (m, v) in enumerate(zip(label, x, strict=True))]
    found = spark.createDataFrame(rows, "doc_id long, _label int, " + ", ".join(f"{f} double" for f in quality_rules.FEATURES))
    root = np.sqrt(x)
    forest = quality_rules.grow_forest(root[label == 1], np.stack([root.min(0), root.max(0)]))
    score, good = forest.score(root), label == 1
    own = np.sort(score[good])[::-1]
    for share in (0.0, 0.002, 0.1):
        bad = score[~good & (score > own[int(share * len(own))])]
        want = float(bad.min()) if len(bad) else float("inf")
        assert quality_rules.calibrate(found, forest, int(good.sum()), share) == want
