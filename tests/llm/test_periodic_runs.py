"""Runs by synchronising sets against a search over all periods."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from strobe.llm import periodic_runs
from strobe.llm.queries import QUERIES
from strobe.llm.words import chunks, split_words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w):
    """Every run of at least four periods and six words, period by period."""
    out = {}
    for q in range(1, len(w) // 4 + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j + q - i >= 4 * q:
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted((s, e - s, q) for (s, e), q in out.items() if e - s >= 6)


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def found(texts, size=20_000):
    out = []
    for c in chunks(pa.array(texts, pa.string()), size):
        words = split_words(c)
        start, end, period = periodic_runs.find_runs(words)
        first = words.first()
        of = np.searchsorted(first, start, side="right") - 1
        out += [[(int(a - first[k]), int(b - a), int(q)) for a, b, q in zip(start[of == k], end[of == k], period[of == k], strict=True)] for k in range(c.n)]
    return out


def test_many_texts():
    r = random.Random(3)
    texts = []
    for _ in range(800):
        k, n, w = r.choice([1, 2, 2, 3, 30]), r.choice([0, 1, 5, 7, 20, 60, 150, 400]), []
        while len(w) < n:
            if r.random() < 0.4:
                p = [r.choice("abcdefghijklmnopqrstuvwxyzABCD"[:k]) for _ in range(r.randint(1, 25))]
                w += (p * 10)[: r.randint(1, len(p) * 9)]
            elif r.random() < 0.3 and w:
                w += w[-r.randint(1, 40) :]
            else:
                w.append(r.choice("abcdefghijklmnopqrstuvwxyzABCD"[:k]))
        texts.append(" ".join(w))
    want = [brute(t.split()) for t in texts]
    assert found(texts) == want
    assert sum(map(len, want)) > 1000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab ", max_size=120), max_size=5))
def test_any_text(texts):
    assert found(texts) == [brute(t.split()) for t in texts]


def test_long_periods_and_tails():
    base = [f"w{i}" for i in range(3000)]
    texts = [" ".join((base[:p] * 5)[: 4 * p + extra]) for p in (64, 100, 127, 128, 129, 700) for extra in (-1, 0, 1)]
    assert found(texts, 1 << 20) == [brute(t.split()) for t in texts]


def test_equal_hashes_by_chance_are_checked():
    (chunk,) = chunks(pa.array(["a b a b a b a c a b a b"]))
    text = periodic_runs.Text(split_words(chunk))
    assert text.checked(0, 12, 2, 0) == (0, 7)


def test_operator(spark, make_docs):
    pairs = [(1, None), (2, ""), (3, " \n "), (4, "x " * 50), (5, "a b c d"), (4, "y y y y y y z"), (None, "q q\tq q q q"), (6, "a b " * 3000 + "end")]
    rows = periodic_runs.periodic_runs(make_docs(pairs)).collect()
    got = sorted((str(r.doc_id), r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in rows)
    want = []
    for i, t in pairs:
        w = WORD.findall(t or "")
        want.append((str(i), len(w), brute(w), collapsed(w, brute(w))))
    assert got == sorted(want)
    assert periodic_runs.periodic_runs(make_docs([])).count() == 0


def _expected(i, text):
    w = WORD.findall(text or "")
    n, h = len(w), zlib.crc32(str(i).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (x - a) % p] for x in range(a, n)]
    runs = brute(w)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (
        len(runs),
        *(best or (None,) * 3),
        best and 1000 * best[1] // best[2],
        sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)),
        sha(collapsed(w, runs)),
    )


@pytest.fixture(scope="module")
def small(tmp_path_factory, spark):
    """A folder with the shorter documents of the small tables, since the
    search over all periods takes the square of a text's words."""
    import pyarrow.compute as pc
    import pyarrow.parquet as pq

    from paths import SF_SMALL

    docs = pq.read_table(f"{SF_SMALL}/documents.parquet")
    docs = docs.filter(pc.less(pc.utf8_length(docs["text"]), 4000))
    folder = tmp_path_factory.mktemp("runs")
    pq.write_table(docs, folder / "documents.parquet")
    return str(folder), docs.to_pydict()


def test_query_equals_brute_force(spark, small):
    folder, docs = small
    want = {i: _expected(i, t) for i, t in zip(docs["doc_id"], docs["text"], strict=True)}
    rows = QUERIES["op12_periodic_runs"](spark, folder).collect()
    got = {r.doc_id: (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in rows}
    assert got == want and len(rows) == len(want)
    assert any(w[0] for w in want.values())
