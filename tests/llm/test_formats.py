"""Chat formatting, PII, packing and HTML extraction."""

import random
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from brute import pii_spans, sha
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from strobe.llm import chat, html_text, packing, pii
from strobe.plans.compare import same_result

SF = "/root/testdata/sf0.001"
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


# -- chat --------------------------------------------------------------------


def test_events_fold_into_messages(spark):
    log = [
        (1, 1, 1, "message", "user", "hi"), (1, 2, 2, "message", "assistant", None), (1, 3, 2, "delta", None, "a<b"),
        (1, 4, 2, "delta", None, "\\l>"), (1, 5, 3, "message", "user", "more"), (1, 6, 1, "edit", None, "hello"),
        (1, 7, 2, "regenerate", None, None), (1, 8, 2, "delta", None, "new"), (1, 9, 2, "delta", None, "!"),
        (1, 10, 3, "message", "user", "again"), (2, 1, 1, "delta", None, "x"), (None, 1, 1, "message", "assistant", "n"),
        (3, 1, 1, "message", "user", "u"), (3, 2, 2, "message", "assistant", "old"), (3, 3, 1, "regenerate", None, None),
    ]
    events = spark.createDataFrame(log, "conv_id long, seq long, target long, op string, role string, text string")
    got = [tuple(r) for r in chat.fold(events).orderBy("conv_id", "target").collect()]
    assert got == [(None, 1, "assistant", "n"), (1, 1, "user", "hello"), (1, 2, "assistant", "new!"), (1, 3, "user", "again"), (2, 1, "", "x"), (3, 1, "user", "")]
    assert chat.fold(events.limit(0)).count() == 0


def test_output_reads_back_exactly(spark):
    rng = random.Random(1)
    pieces = ["\\", "<", ">", "\\l", "</turn>\n", "<turn role=assistant>", "\n", "é😀", "ok", "### Assistant:", "\\\\", "$1"]
    rows = []
    for conv in range(30):
        for turn in range(rng.randint(1, 6)):
            text = None if rng.random() < 0.05 else "".join(rng.choice(pieces) for _ in range(rng.randint(0, 12)))
            rows.append((conv, turn, rng.choice(["user", "assistant", "a<b>\\"]), text))
    rows.append((99, 0, "assistant", "long \\<" * 40_000))
    rows += [(98, 0, "user", "same"), (98, 0, "user", "same"), (98, 0, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.render(chat.fold(chat.as_events(df)))).collect()}
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, role is not None, role or "", text is not None, text or ""))
    for conv, turns in by.items():
        turns.sort()
        assert got[conv].roles == [t[2] for t in turns]
        assert got[conv].texts == [t[4] for t in turns]
        assert got[conv].loss_text == "".join(t[4] for t in turns if t[2] == "assistant")


def test_chat_query_matches_oracle(spark):
    from strobe.llm.queries import ORACLES, QUERIES

    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{SF}/conversations.parquet')")
    name = "op9_chat_formatting"
    ok, why = same_result(QUERIES[name](spark, SF).toPandas(), con.execute(ORACLES[name]).df())
    assert ok, why


# -- PII ---------------------------------------------------------------------

HARD = [
    (1, "a@b.c_d@e.f x@y@z.co ..q@r.s..t@u.v a+b%c@d-e.f-g. @no.pe no@dot"), (2, "1.2.3.4.5.6.7.8 300.1.1.1 01.002.0003.4 1.2.3 9.9.9.99999999999999999999"),
    (3, "4111 1111 1111 1111 and 4111-1111-1111-1112, +1 (523) 555-1055 +12 3 +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 +49-30.1234 5"),
    (4, None), (None, ""), (5, "é" * 50 + "x@y.zz " + "9" * 40 + " 😀 a@b.cc"), (6, "1" * 30000 + "." + "a" * 30000 + "@ " + "1." * 20000), (6, "b@c.dd"),
]


def test_base_spans_match_plain_version(spark, make_docs):
    rng = random.Random(2)
    parts = ["a@b.co", "1.2.3.4", "256.1.1.1", "4111111111111111", "4111-1111 1111 1111", "+1 (523) 555-1055", "+", "12", ".", "-", " ", "@", "é", "x_"]
    rows = HARD + [(100 + i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 30)))) for i in range(150)]
    found = pii.find_spans(make_docs(rows), pii.Trees())
    got = found.select("doc_id", "text", pii.span_list(F.col(pii.BASE)).alias("spans"), F.size(pii.ADDED).alias("added")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.spans == ",".join(pii_spans(r.text)) and r.added == 0


def test_redaction_keeps_columns_and_the_rest(spark, make_docs):
    docs = make_docs([(1, "write a@b.co or +1 (523) 555-1055."), (2, None), (3, "nothing"), (4, "x@1.2.3.4 y")])
    out = pii.redact_documents(docs, pii.Trees())
    assert out.columns == docs.columns
    got = {r.doc_id: r for r in out.collect()}
    assert got[1].text == "write [EMAIL] or [PHONE]." and got[1].n_chars == len(got[1].text)
    assert got[2].text is None and got[2].n_chars is None and got[3].text == "nothing"
    assert got[4].text == "[EMAIL] y"


def test_trees_add_named_secrets(spark, make_docs):
    rng = random.Random(3)
    hexes = lambda: "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows = []
    for i in range(400):
        kind = i % 4
        tail = {0: f'token = "{hexes()}" end', 1: f"hash {hexes()} end", 2: f"a{i}@b.co card 4111 1111 1111 1112", 3: "handnehseinunggeheitlichkeiten plain"}[kind]
        rows.append((i, f"some words {tail}"))
    docs = make_docs(rows)
    trees = pii.fit_trees(docs)
    added = pii.find_spans(docs, trees).select("doc_id", F.explode(pii.ADDED).alias("s")).collect()
    assert {r.doc_id for r in added} == {i for i in range(0, 400, 4)}
    assert all(pii.KINDS[r.s.kind] == "secret" and len(r.s.value) == 40 for r in added)
    assert pii.fit_trees(make_docs([])).thresholds == {}
    assert pii.redact_documents(make_docs([]), trees).count() == 0


# -- packing -----------------------------------------------------------------


def check_pieces(rows, got):
    coder = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = defaultdict(list)
    for i, text in rows:
        ids[i].append(np.array([*coder.encode(text or "", add_special_tokens=False).ids, 0], dtype="<u4"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    assert set(pieces) == set(ids)
    for i, own in ids.items():
        assert sorted({p.doc_tokens for p in pieces[i]}) == sorted({len(x) for x in own})
        assert sum(p.length for p in pieces[i]) == sum(map(len, own))
        if len(own) == 1:
            at = 0
            for p in sorted(pieces[i], key=lambda p: p.start):
                assert p.start == at and p.ids_crc32 == zlib.crc32(own[0][at : at + p.length].tobytes())
                at += p.length
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= packing.WINDOW and at & (at - 1) == 0


def test_pieces_hold_every_id_once(spark, make_docs, monkeypatch):
    rng = random.Random(4)
    vocabulary = [f"{a}{b}" for a in ("the", "über", "né", "42", "Zz") for b in ("", "ing", "!?", "ß", "'s")]
    rows = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice((0, 1, 30, 400, 3000))))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "<|endoftext|> in a text"), (503, "two  spaces\n\n\ttabs   x"), (None, "null id"), (504, "again"), (504, "and again")]
    monkeypatch.setattr(packing, "SHARD_DOCUMENTS", 16)
    check_pieces(rows, packing.pack(make_docs(rows), RANKS).collect())
    assert packing.pack(make_docs([]), RANKS).count() == 0


def test_neighbours_follow_their_seed():
    topics = [["ember", "coal", "forge"], ["reef", "kelp", "tide"]]
    rng = random.Random(5)
    terms, tokens = [], []
    for i in range(40):
        words = [packing.np.uint64(zlib.crc32(w.encode())) for w in topics[i % 2]] + [packing.np.uint64(1000 + rng.randint(0, 5000))]
        slots = np.unique(np.array(words, dtype=np.uint64) % np.uint64(packing.SLOTS)).astype(np.int64)
        terms.append((slots, np.ones(len(slots), dtype=np.int64)))
        tokens.append(np.zeros(100, dtype="<u4"))
    shard = packing.Shard(list(range(40)), tokens, terms)
    shard.index(np.ones(packing.SLOTS, dtype=np.float32), 4.0)
    order = shard.order(1024)
    assert sorted(order) == list(range(40))
    same = sum(a % 2 == b % 2 for a, b in zip(order, order[1:], strict=False))
    assert same >= 34


def test_a_seed_asks_until_its_window_is_full():
    own = [np.array([5, 9], dtype=np.int64)] * 40
    other = [np.array([7], dtype=np.int64)] * 40
    # two kinds of short documents by turns
    terms = [(t, np.ones(len(t), dtype=np.int64)) for pair in zip(own, other, strict=True) for t in pair]
    shard = packing.Shard(list(range(80)), [np.zeros(10, dtype="<u4")] * 80, terms)
    shard.index(np.ones(packing.SLOTS, dtype=np.float32), 1.5)
    order = shard.order(1024)
    assert sorted(order) == list(range(80)) and [d % 2 for d in order[:40]] == [0] * 40


def test_a_seed_asks_with_all_its_terms():
    # the best neighbour shares many terms, none of them among the rarest
    rare, common = np.arange(12), np.arange(100, 180)
    terms = [np.r_[rare, common], common, rare[:1], rare[1:], np.r_[200]]
    shard = packing.Shard(list(range(5)), [np.zeros(10, dtype="<u4")] * 5, [(t.astype(np.int64), np.ones(len(t), dtype=np.int64)) for t in terms])
    rarity = np.ones(packing.SLOTS, dtype=np.float32)
    rarity[rare] = 1.5
    shard.index(rarity, 40)
    assert shard.neighbours(0, np.array([False, True, True, True, True]))[0] == 1


@pytest.mark.parametrize(("frequent", "pairs"), [(64, 1 << 21), (3, 50), (1, 10), (1000, 7)])
def test_scores_are_bm25(monkeypatch, frequent, pairs):
    """All scores of a shard against a sum over the terms of each pair."""
    monkeypatch.setattr(packing, "FREQUENT", frequent)
    monkeypatch.setattr(packing, "PAIRS", pairs)
    rng = np.random.default_rng(6)
    terms = []
    for _ in range(50):
        slots = np.unique(rng.zipf(1.4, rng.integers(0, 60)) % 500).astype(np.int64)
        terms.append((slots, rng.integers(1, 6, len(slots))))
    rarity = rng.uniform(0.01, 9, packing.SLOTS).astype(np.float32)
    mean = float(np.mean([len(t[0]) for t in terms]))
    shard = packing.Shard(list(range(50)), [np.zeros(10, dtype="<u4")] * 50, terms)
    shard.index(rarity, mean)
    unused = rng.random(50) < 0.7
    for seed in range(50):
        want = np.zeros(50)
        for d, (slots, counts) in enumerate(terms):
            norm = packing.K1 * (1 - packing.B + packing.B * counts.sum() / mean)
            for t, c in zip(slots, counts, strict=True):
                if t in terms[seed][0]:
                    want[d] += rarity[t] * c * (packing.K1 + 1) / (c + norm)
        size = len(terms[seed][0])
        assert (np.abs(shard.scores[seed] / packing.STEPS - want) <= size / packing.STEPS + 1e-4)[np.arange(50) != seed].all()
        best = shard.neighbours(seed, unused)
        assert unused[best].all() and len(best) == min(packing.TRIED, np.count_nonzero(shard.scores[seed] * unused))
        rest = np.setdiff1d(np.flatnonzero(unused), best)
        assert not len(rest) or not len(best) or shard.scores[seed][best].min() >= shard.scores[seed][rest].max()


def test_related_documents_of_the_whole_corpus_meet(spark, make_docs, monkeypatch):
    monkeypatch.setattr(packing, "SHARED", (3, 2, 2))
    rows = [(i, f"topic{i % 50} " + " ".join(f"w{i}x{j}" for j in range(20))) for i in range(200)]
    docs = make_docs(rows).repartition(4, "doc_id").select("doc_id", "text")
    counts, _, _ = packing.document_frequencies(docs)
    dealt = [r.doc_id for r in packing.deal(docs, counts).collect()]
    assert sorted(dealt) == list(range(200))
    together = sum(a % 50 == b % 50 for a, b in zip(dealt, dealt[1:], strict=False))
    assert together >= 140


def test_document_frequencies_cover_all_documents(spark, make_docs):
    counts, n, mean = packing.document_frequencies(make_docs([(1, "a b b"), (2, "b C"), (3, None)]).repartition(3))
    assert n == 3 and counts.sum() == 4 and sorted(counts[counts > 0].tolist()) == [1, 1, 2] and mean == pytest.approx(4 / 3)


# -- HTML --------------------------------------------------------------------


@pytest.mark.parametrize(("page", "text"), [
    (None, ""), ("", ""), ("plain & simple", "plain & simple"), ("a<br>b<br><br>c", "a\nb\n\nc"),
    ("<p>one<p>two &amp; <b>bold</b> x</p>", "one\n\ntwo & bold x"),
    ("<head><title>t</title><style>p{}</style></head><body><script>var a='</p>'</script>seen<!-- no --></body>", "seen"),
    ("<div hidden>no</div><div style='display:none'>no<p>no</div><input type=hidden value=x>yes", "yes"),
    ("<ul><li>x<li>y<ol start=3><li>q<li>r</ol></ul>after", "- x\n- y\n\n  3. q\n  4. r\n\nafter"),
    ("<table><tr><th>a<th>bb<tr><td>ccc<td>d<br>e<tr><td><td>f</table>", "a    bb\nccc  d\n     e\n     f"),
    ("<pre> k\n  l\n</pre>z", " k\n  l\n\nz"), ("<dl><dt>t<dd>d1<dd>d2</dl>", "t\n    d1\n    d2"),
    ("<blockquote>q<p>r</blockquote>", "> q\n>\n> r"), ("<h1>T</h1>b", "T\n\nb"), ("<a href='x>y'>l</a> 1 < 2", "l 1 < 2"),
    ("<p>open <i>tags <b>never closed", "open tags never closed"), ("</div></p>x", "x"), ("<textarea>a &lt; b</textarea>", "a < b"),
])
def test_rendering(page, text):
    assert html_text.page_text(page) == text


@pytest.mark.parametrize(("page", "text"), [
    ('<p title="hidden costs">a</p><a aria-label="hidden menu items">b</a><div class="hidden md:block">c</div>', "a\n\nb\nc"),
    ("<p data-hidden=1>a<p data-style='display:none'>b<p title='style=\"display:none\"'>c<button type='hidden'>d</button>", "a\n\nb\n\ncd"),
    ("<p HIDDEN>no<p hidden=''>no<p style='color:red; Display : none !important'>no<p style=visibility:hidden>no<p>yes", "yes"),
    ("<p>so <math><mi>x</mi><mo>=</mo><mn>2</mn><annotation>x=2</annotation></math> holds", "so x=2 holds"),
    ("<svg viewBox='0 0 1 1'><title>t</title> <desc>d</desc><defs><text>no</text></defs><g><text>one <tspan>two</tspan></text><text>three</text></g></svg>z", "one two\nthree\nz"),
    ("<svg><path d=''><p>after a drawing that is left open", "after a drawing that is left open"),
    ("<p>pick <select><optgroup label=g><option>x<option selected>y</select> now", "pick\ng\nx\ny\n now"),
    ("<ol data-start=7><li>a</ol>", "1. a"),
])
def test_visible_text_stays(page, text):
    assert [x.strip() for x in html_text.page_text(page).split("\n")] == [x.strip() for x in text.split("\n")]


def test_hidden_text_beyond_the_depth():
    deep = "<div>" * html_text.DEPTH
    assert html_text.page_text(deep + "a<span hidden>no<b>no</b><br>no</span>b<span>c</span>" + "</div>" * html_text.DEPTH) == "abc"
    # an end tag there closes its own element
    hidden = "<div hidden>" + "<div>" * html_text.DEPTH + "</div>no" + "</div>" * html_text.DEPTH + "yes"
    assert html_text.page_text(hidden) == "yes"
    assert html_text.page_text("<p><button>" + "<span>" * 100_000 + "<div>x</div>" * 1000).count("x") == 1000


def test_deep_and_long_pages_keep_their_text():
    assert html_text.page_text("<div>" * 5000 + "deep" + "</div>" * 5000) == "deep"
    assert html_text.page_text("<" * 50_000).count("<") == 50_000
    assert html_text.page_text("<p class=\"" + "x" * 200_000).strip() == ""


def test_pages_query(spark):
    pages = spark.createDataFrame([(1, "<p>a"), (1, "<p>a"), (2, None), (None, "b")], "page_id long, html string").withColumn("text", F.lit("clash"))
    got = sorted((r.page_id or 0, r.text, r.n_lines) for r in html_text.extract_text(pages).collect())
    assert got == [(0, "b", 1), (1, "a", 1), (1, "a", 1), (2, "", 0)]
    assert html_text.extract_text(pages.limit(0)).count() == 0
    assert sha("") == sha("")
