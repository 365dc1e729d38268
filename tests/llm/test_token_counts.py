"""Token counts against the library of the model."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from strobe.llm import token_counts
from strobe.llm.queries import QUERIES
from strobe.llm.words import chunks

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def counted(texts, machine=None):
    machine = machine or token_counts.transducer(MODEL)
    found = [machine.chunk_counts(c) for c in chunks(pa.array(texts, pa.string()))]
    return np.concatenate(found).tolist() if found else []


def wanted(library, texts):
    return [len(library.encode(t or "")) for t in texts]


HARD = ["", " ", "  ", None, "a", "a ", " a", "a  b\n\tc", "ﬁ ½ é Å 東京 ▁x\x00y", "<s> </s> <unk> <0x0A>", "　a", "👍🏽", "\xa0x​"]


def test_hard_texts(library):
    long = ["=" * n for n in (1, 16, 17, 1023, 1024, 1025, 5000)] + [" " * n for n in (15, 16, 17, 1024, 9999)]
    texts = HARD + long + ["ab" * 4000, "=-" * 3000 + "x" * 5000, "word " * 3000]
    assert counted(texts) == wanted(library, texts)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from("aehtsingd=-_. \n▁10é東ﬁ👍</>"), max_size=80), max_size=8))
def test_any_text(texts):
    assert counted(texts) == wanted(sentencepiece.SentencePieceProcessor(model_file=MODEL), texts)


def test_pieces_of_long_stretches_agree(library, monkeypatch):
    r = random.Random(5)
    texts = ["".join(r.choice("=-_abthe.") for _ in range(r.randint(1, 700))) for _ in range(60)] + ["=" * 333, "ab" * 200]
    monkeypatch.setattr(token_counts, "LANE", 48)
    monkeypatch.setattr(token_counts, "CONTEXT", 3)
    assert counted(texts) == wanted(library, texts)


def test_full_tables_start_anew(library, monkeypatch):
    monkeypatch.setattr(token_counts, "TRANSITIONS", 50)
    machine = token_counts.Transducer(MODEL)
    for text in ("the quick brown fox", "jumps over lazy dogs", "internationalisation ======="):
        assert counted([text], machine) == wanted(library, [text])
    assert len(machine.keys) < 200


def test_operator(spark, make_docs, library):
    pairs = [(i, t) for i, t in enumerate(HARD)] + [(1, "again"), (None, "no id")]
    rows = token_counts.count_tokens(make_docs(pairs), MODEL).collect()
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens) for r in rows)
    assert got == sorted((i is None, i or 0, len((t or "").encode()), len(library.encode(t or ""))) for i, t in pairs)
    assert token_counts.count_tokens(make_docs([]), MODEL).count() == 0


def test_query_equals_the_library(spark, library):
    import pyarrow.parquet as pq

    from paths import SF_SMALL

    docs = pq.read_table(f"{SF_SMALL}/documents.parquet").to_pydict()
    want = {i: (len(t.encode()), n, n > 4096) for i, t, n in zip(docs["doc_id"], docs["text"], wanted(library, docs["text"]))}
    got = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in QUERIES["op13_token_counts"](spark, SF_SMALL).collect()}
    assert got == want
