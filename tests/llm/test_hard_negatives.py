"""Hard negatives against all scores."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strobe.llm import hard_negatives
from strobe.llm.queries import ORACLES, QUERIES


def brute(rows, is_anchor, positives=5, negatives=5, share=80):
    rows = {i: (lab, v) for i, lab, v in sorted(((i, lab, v) for i, lab, v in rows if None not in (i, lab, v)), reverse=True)}
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (label, v) in rows.items():
        if not is_anchor(a):
            continue
        ranked = sorted((-score(v, w), i, lab) for i, (lab, w) in rows.items() if i != a)
        for s, p, _ in [x for x in ranked if x[2] == label][:positives]:
            near = [x for x in ranked if x[2] != label and 100 * x[0] >= 100 * s and -100 * x[0] >= share * -s][:negatives]
            out += [(a, p, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(near)]
    return sorted(out)


def mined(spark, rows, **kw):
    df = spark.createDataFrame(rows, "id long, label long, vector array<long>").withColumn("score", F.lit("x")).withColumn("block", F.lit(1))
    found = hard_negatives.mine(df, F.col("id") % 10 == 0, **kw)
    return sorted(tuple(r) for r in found.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect())


@pytest.fixture
def vectors():
    r = random.Random(2)
    centres = [[r.randint(-60, 60) for _ in range(8)] for _ in range(6)]
    return [(i, r.randint(0, 3), [x + r.randint(-9, 9) for x in r.choice(centres)]) for i in range(400)]


def test_all_windows(spark, vectors, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 16)
    monkeypatch.setattr(hard_negatives, "GROUP_BYTES", 3000)
    got = mined(spark, vectors)
    assert got == brute(vectors, lambda i: i % 10 == 0) and len(got) > 100


def test_defined_results(spark):
    same = [(i, i % 2, [3, 4]) for i in range(30)]  # ties everywhere
    odd = [(None, 1, [1]), (40, None, [1]), (50, 1, None), (60, 1, []), (61, 0, []), (70, 1, [9]), (71, 1, [8, 5, 2]), (72, 0, [8, 1])]
    twice = [(80, 1, [5, 5]), (80, 1, [5, 5]), (80, 0, [7, 7]), (81, 0, [6, 6])]
    negative = [(90, 5, [-3, 0]), (91, 5, [2, 0])]  # a positive with a negative score has an empty window
    rows = same + odd + twice + negative
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    assert mined(spark, []) == []
    assert mined(spark, [(1, 1, [1])]) == []


def test_scores_beyond_doubles(spark):
    big = 1 << 30
    rows = [(i, i % 2, [big + i, big - 3 * i, i]) for i in range(25)]
    assert mined(spark, rows) == brute(rows, lambda i: i % 10 == 0)
    with pytest.raises(Exception, match="out of the range"):
        mined(spark, [(i, i % 2, [1 << 40]) for i in range(3)])


def test_tree_saves_scores():
    r = np.random.default_rng(1)
    centre = r.integers(-500, 500, (4, 16))
    x = centre[r.integers(0, 4, 3000)] + r.integers(-4, 5, (3000, 16))
    order, parent, edge = hard_negatives.spanning_tree(x[:200])
    place = np.argsort(order)
    block = hard_negatives.Block(np.arange(200)[order], np.zeros(200, dtype=int), x[:200][order], place[parent[order]], edge[order])
    assert (block.parent[1:] < np.arange(1, 200)).all()
    windows = [[hard_negatives.Best(5)] for _ in range(200)]
    tile = hard_negatives.Tile(np.arange(3000), np.zeros(3000, dtype=int), x)
    hard_negatives.scan(block, windows, tile, True)
    taken = hard_negatives.scan(block, windows, hard_negatives.Tile(np.arange(3000, 6000), np.zeros(3000, dtype=int), x // 2), True)
    assert taken < 200 * 3000 / 2


def test_query_equals_sql(spark):
    import duckdb

    from paths import SF_SMALL
    from strobe.plans.compare import same_result

    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_SMALL}/embeddings.parquet')")
    ok, why = same_result(QUERIES["op11_hard_negatives"](spark, SF_SMALL).toPandas(), con.execute(ORACLES["op11_hard_negatives"]).df())
    assert ok, why


def test_matrix_fills_with_zeros():
    got = hard_negatives.matrix(pa.array([[1, 2], [], [3]], pa.list_(pa.int64())))
    assert got.tolist() == [[1, 2], [0, 0], [3, 0]]
