"""Packing: lexical retrieval with a sharded BM25 index.

Documents are dealt to tasks by a rare term that they share, so that related
documents of the whole corpus meet, those of a frequent term in parts of
bounded size.  A task sorts its documents by their shared terms and fills
shards of bounded size.  A shard has an inverted index of its documents; all
terms of a seed retrieve unused neighbours by BM25, which greedily fill the
window that the seed left open: the best that fits, else the best is cut and
its rest becomes the next seed.  When the neighbours are used up and there is
room, the seed asks again.  What a shard has left at its end is cut into
sequences whose lengths are powers of two, so there is no padding at all.

Document frequencies are counted over all documents, in hashed slots, before
the shards are built.  Ids come from a byte-level BPE vocabulary; the faster of
two readers of the same vocabulary is used, and tests compare their ids.

Defined results: a null or empty text is the end id alone; a null id is packed
under a null id; rows that repeat an id are packed each; other columns are not
read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strobe.llm.words import TERM_BREAKS, Chunk, by_chunk, distinct, split_words

WINDOW = 1024
END_ID = 0
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256
SLOTS = 1 << 18
#: Bounds of a shard: documents and tokens.
SHARD_DOCUMENTS = 2048
SHARD_TOKENS = 1 << 22
#: Neighbours that a seed asks for at a time.
TRIED = 24
#: Documents are dealt by their rarest term that so many have, and sorted by
#: those that fewer have; documents of a term that stay together.
SHARED = (64, 8, 2)
TOGETHER = 256
K1, B = 1.2, 0.75
#: Steps of a score; terms in so many documents of a shard count as frequent;
#: pairs that are summed at a time.
STEPS = 64
FREQUENT = 64
PAIRS = 1 << 21
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, seed boolean"

_encoders: dict[str, object] = {}


def encoder(path: str):
    """Encoder of a rank file, kept in the worker process."""
    if path not in _encoders:
        import base64

        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        _encoders[path] = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: SPECIAL_ID})
    return _encoders[path]


def token_ids(text: str, path: str) -> np.ndarray:
    """Ids of a text and the end id after them."""
    special = {"allowed_special": "all"} if SPECIAL in text else {"disallowed_special": ()}
    ids = encoder(path).encode_to_numpy(text, **special)
    out = np.empty(len(ids) + 1, dtype="<u4")
    out[:-1] = ids
    out[-1] = END_ID
    return out


def term_counts(chunk: Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, slot) pairs of a chunk and how often they occur."""
    words = split_words(chunk, lower=True, breaks=TERM_BREAKS)
    pair, n = np.unique(words.doc() * SLOTS + (words.hash & np.uint64(SLOTS - 1)).astype(np.int64), return_counts=True)
    return pair // SLOTS, pair % SLOTS, n


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int, float]:
    """Documents with a term of each slot, documents, and mean distinct terms,
    over all documents.  Each task sends one vector of fixed size in parts;
    their sum of fixed size comes to the driver."""
    parts = 64

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, dtype=np.int64)
        n = 0
        for batch in batches:
            for _, chunk in by_chunk(batch, "text"):
                words = split_words(chunk, lower=True, breaks=TERM_BREAKS)
                pair = distinct(words.doc() * SLOTS + (words.hash & np.uint64(SLOTS - 1)).astype(np.int64))
                total += np.bincount(pair % SLOTS, minlength=SLOTS)
                n += chunk.n
        step = SLOTS // parts
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(range(parts)), pa.int32()),
                pa.array([total[i * step : (i + 1) * step].tobytes() for i in range(parts)], pa.binary()),
                pa.array([n] + [0] * (parts - 1), pa.int64()),
            ],
            ["part", "counts", "n"],
        )

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        for batch in batches:
            for part, counts, n in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = held.setdefault(part, [np.zeros(SLOTS // parts, dtype=np.int64), 0])
                own[0] += np.frombuffer(counts, dtype=np.int64)
                own[1] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array([x[0].tobytes() for x in held.values()], pa.binary()), pa.array([x[1] for x in held.values()], pa.int64())],
            ["part", "counts", "n"],
        )

    schema = "part int, counts binary, n long"
    found = docs.select("text").mapInArrow(rows, schema).repartition("part").mapInArrow(add, schema).collect()
    total, n = np.zeros(SLOTS, dtype=np.int64), 0
    for r in found:
        total[r.part * (SLOTS // parts) : (r.part + 1) * (SLOTS // parts)] += np.frombuffer(r.counts, dtype=np.int64)
        n += r.n
    return total, n, float(total.sum() / max(n, 1))


@dataclass
class Shard:
    """Documents of a shard and its inverted index."""

    ids: list
    tokens: list[np.ndarray]
    terms: list[tuple[np.ndarray, np.ndarray]]

    def index(self, rarity: np.ndarray, mean_terms: float) -> None:
        """Scores of every document for every seed's terms, at once: frequent
        terms as a product of matrices, the others as pairs from their lists."""
        n = len(self.terms)
        doc = np.repeat(np.arange(n), [len(t[0]) for t in self.terms])
        slot = np.concatenate([t[0] for t in self.terms])
        count = np.concatenate([t[1] for t in self.terms])
        length = np.bincount(doc, count, minlength=n)
        norm = K1 * (1 - B + B * length[doc] / max(mean_terms, 1e-9))
        # whole steps, so that sums do not depend on their order
        weight = np.ceil(rarity[slot] * count * (K1 + 1) / (count + norm) * STEPS).astype(np.float32)
        shared = np.bincount(slot, minlength=SLOTS)
        keep = shared[slot] > 1
        order = np.argsort(slot[keep], kind="stable")
        slot, doc, weight = slot[keep][order], doc[keep][order], weight[keep][order]
        first = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.zeros(0, dtype=np.int64)
        size = np.diff(np.append(first, len(slot)))
        self.scores = np.zeros((n, n), dtype=np.float32)
        many = np.flatnonzero(size >= FREQUENT)
        if len(many):
            has, weighs = (np.zeros((n, len(many)), dtype=np.float32) for _ in range(2))
            at = np.concatenate([np.arange(first[m], first[m] + size[m]) for m in many.tolist()])
            column = np.repeat(np.arange(len(many)), size[many])
            has[doc[at], column] = 1
            weighs[doc[at], column] = weight[at]
            self.scores += has @ weighs.T
        few = np.flatnonzero(size < FREQUENT)
        upto = np.cumsum(size[few] ** 2)
        for group in np.split(few, np.searchsorted(upto, np.arange(PAIRS, upto[-1], PAIRS))) if len(few) else []:
            if not len(group):
                continue
            own = np.repeat(size[group], size[group])
            member = np.repeat(first[group], size[group]) + np.arange(len(own)) - np.repeat(np.cumsum(size[group]) - size[group], size[group])
            other = np.repeat(np.repeat(first[group], size[group]), own) + np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)
            pair = np.repeat(doc[member] * n, own) + doc[other]
            self.scores += np.bincount(pair, weight[other], minlength=n * n).reshape(n, n)

    def neighbours(self, seed: int, unused: np.ndarray) -> np.ndarray:
        """The best unused documents of the shard with a term of the seed,
        best first; none only if no unused one has any."""
        score = self.scores[seed] * unused
        hit = np.flatnonzero(score)
        if len(hit) > TRIED:
            hit = hit[np.argpartition(-score[hit], TRIED)[:TRIED]]
        return hit[np.lexsort((hit, -score[hit]))]

    def order(self, window: int) -> list[int]:
        """All documents in packing order."""
        unused = np.ones(len(self.ids), dtype=bool)
        size = np.array([len(t) for t in self.tokens])
        out, room, following, seed = [], 0, 0, None
        near: list[int] = []
        while True:
            choice = next((d for d in near if unused[d] and size[d] <= room), None) if room else None
            if choice is None:
                choice = next((d for d in near if unused[d]), None)
            if choice is None and near:
                # used up: the seed asks for more
                near = self.neighbours(seed, unused).tolist() if room else []
                if near:
                    continue
            if choice is None:
                while following < len(unused) and not unused[following]:
                    following += 1
                if following == len(unused):
                    return out
                choice = following
            unused[choice] = False
            out.append(int(choice))
            cut = size[choice] > room
            room = int((room - size[choice]) % window)
            if cut or not near:
                # the document runs into a new window and is its seed
                seed = choice
                near = self.neighbours(choice, unused).tolist() if room else []


def by_rarity(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Slots from the rarest term on (the smaller slot first), the place of
    each slot among them, and the first place of a term that SHARED have."""
    order = np.argsort(counts, kind="stable")
    place = np.empty(SLOTS, dtype=np.int64)
    place[order] = np.arange(SLOTS)
    return order, place, np.searchsorted(counts[order], SHARED).tolist()


def rarest(doc: np.ndarray, place: np.ndarray, order: np.ndarray, least: list[int], n: int) -> list[np.ndarray]:
    """For each bound, every document's rarest term at or behind that place:
    its slot, -1 if there is none.  doc ascends; place: that of each term."""
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]]) if len(doc) else np.zeros(0, dtype=np.int64)
    out = []
    for at in least:
        key = np.full(n, -1, dtype=np.int64)
        if len(doc):
            first = np.minimum.reduceat(np.where(place >= at, place, SLOTS), starts)
            has = first < SLOTS
            key[doc[starts[has]]] = order[first[has]]
        out.append(key)
    return out


def deal(docs: DataFrame, counts: np.ndarray) -> DataFrame:
    """doc_id and text, dealt and sorted by shared terms.  counts: documents
    with a term of each slot."""
    df = docs.sparkSession.sparkContext.broadcast((counts, *by_rarity(counts)))
    names = ["group", "part", "finer", "finest"]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        number = task.partitionId() if task else 0
        for batch in batches:
            for rows_, chunk in by_chunk(batch, "text"):
                words = split_words(chunk, lower=True, breaks=TERM_BREAKS)
                # a term's repeats do not change a minimum, so they stay
                slot = (words.hash & np.uint64(SLOTS - 1)).astype(np.int64)
                n, order, place, least = df.value
                keys = rarest(words.doc(), place[slot], order, least, chunk.n)
                # a frequent term's documents, or those of none, go to several parts
                size = np.where(keys[0] < 0, SLOTS, n[keys[0]])
                part = (number + np.arange(chunk.n)) % np.maximum(1, -(-size // TOGETHER))
                number += chunk.n
                yield pa.RecordBatch.from_arrays(
                    [rows_.column("doc_id"), rows_.column("text"), *(pa.array(k, pa.int64()) for k in (keys[0], part, *keys[1:]))], ["doc_id", "text", *names]
                )

    keyed = docs.mapInArrow(rows, "doc_id long, text string, group long, part long, finer long, finest long")
    return keyed.repartition("group", "part").sortWithinPartitions(*names, "doc_id").select("doc_id", "text")


def pieces(sizes: list[int], window: int = WINDOW) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of documents laid one after
    the other and cut into windows; the rest is cut into powers of two."""
    total = sum(sizes)
    lengths = [window] * (total // window)
    lengths += [1 << b for b in range(window.bit_length() - 1, -1, -1) if (total % window) >> b & 1]
    sequence, offset = 0, 0
    for d, size in enumerate(sizes):
        at = 0
        while at < size:
            n = min(size - at, lengths[sequence] - offset)
            yield d, at, n, sequence, offset
            at, offset = at + n, offset + n
            if offset == lengths[sequence]:
                sequence, offset = sequence + 1, 0


def pack(docs: DataFrame, vocabulary: str, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents; sequences have ``window`` tokens or a smaller
    power of two.  vocabulary: path of a rank file that every worker has."""
    counts, n, mean_terms = document_frequencies(docs)
    rarity = docs.sparkSession.sparkContext.broadcast(np.log1p((n - counts + 0.5) / (counts + 0.5)).astype(np.float32))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        sequence = (task.partitionId() << 36) if task else 0
        shard, held = Shard([], [], []), 0

        def flush():
            nonlocal sequence, shard, held
            shard.index(rarity.value, mean_terms)
            order = shard.order(window)
            out: list[tuple] = []
            seeds = 0
            for d, at, size, s, offset in pieces([len(shard.tokens[i]) for i in order], window):
                own = shard.tokens[order[d]]
                crc = zlib.crc32(own[at : at + size].tobytes())
                out.append((shard.ids[order[d]], at, size, crc, len(own), sequence + s, offset, offset == 0))
                seeds = s
            sequence += seeds + 1
            shard, held = Shard([], [], []), 0
            types = [pa.int64()] * 7 + [pa.bool_()]
            names = [c.split()[0] for c in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)

        for batch in batches:
            for part, chunk in by_chunk(batch, "text"):
                doc, slot, count = term_counts(chunk)
                bound = np.searchsorted(doc, np.arange(chunk.n + 1))
                texts, ids = part.column("text").to_pylist(), part.column("doc_id").to_pylist()
                for i in range(chunk.n):
                    shard.ids.append(ids[i])
                    shard.tokens.append(token_ids(texts[i] or "", vocabulary))
                    shard.terms.append((slot[bound[i] : bound[i + 1]], count[bound[i] : bound[i + 1]]))
                    held += len(shard.tokens[-1])
                    if len(shard.ids) >= SHARD_DOCUMENTS or held >= SHARD_TOKENS:
                        yield flush()
        if shard.ids:
            yield flush()

    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return deal(own, counts).mapInArrow(rows, PIECES)
