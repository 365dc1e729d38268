"""Substring dedup: compaction of a de Bruijn graph of token windows.

Nodes are windows of k consecutive words, edges the (k+1)-word runs between
them.  A window owned by the document with the smallest id that holds it is
removed from every document with a larger id.  Repeated windows that follow
each other in the owner without branching compact into one path, and a
document's pieces of such paths, joined back to its source coordinates, are
its repeated spans.

Three passes, none of which holds a key's rows in one place:

1. Documents are cut into blocks of bounded bytes, stored compressed in a
   table of the shared folder.
2. Each block turns its windows into runs that share a minimizer (the smallest
   hash of the short word sequences in a window, so equal windows share it),
   keeps one run of each content with the smallest document that holds it, and
   sends it to the bucket of the minimizer.  A passage in a third of all
   documents thus sends one run per block.  Buckets find each window's owner
   and its in and out degrees.
3. Buckets answer every block with the compacted pieces of repeated windows;
   blocks join the answers and expand them to their documents.

Defined results: a null or empty text has no words; a null id neither owns nor
loses words; rows that repeat an id do not remove each other's words; texts
shorter than a window are left alone; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strobe.llm.shared import materialise, small_batches
from strobe.llm.words import Chunk, Words, chunks, covered, ngrams, split_words

WINDOW = 13
#: Words of the sequences that minimizers are chosen from.
CORE = 5
BLOCK_BYTES = 1 << 20
#: Bytes of text that one bucket stands for.
BUCKET_BYTES = 4 << 20
NO_OWNER = np.iinfo(np.int64).max
BLOCK_SCHEMA = "block long, size long, ids binary, data binary, bounds binary"
RUN_SCHEMA = "bucket int, block long, core binary, size binary, owner binary, place binary, prints binary, sides binary"
PIECE_SCHEMA = "block long, run binary, offset binary, length binary, owner binary, place binary, linked binary"
SPAN = "array<struct<start:long,length:long,owner:long,owner_start:long>>"


# -- blocks ------------------------------------------------------------------


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get()
    number = (task.partitionId() << 32) if task else 0
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        ids = batch.column("doc_id")
        known = np.asarray(ids.is_valid())
        values = np.asarray(ids.fill_null(0)).astype(np.int64)
        values = np.where(known, values, NO_OWNER)
        for c in chunks(batch.column("text"), BLOCK_BYTES):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([len(c.data)], pa.int64()),
                    pa.array([values[c.rows].tobytes()]),
                    pa.array([pack.compress(c.data.tobytes())]),
                    pa.array([c.bounds.astype(np.int64).tobytes()]),
                ],
                ["block", "size", "ids", "data", "bounds"],
            )
            number += 1


def _load(ids: bytes, data: bytes, bounds: bytes) -> tuple[np.ndarray, Chunk]:
    own = np.frombuffer(bounds, dtype=np.int64)
    raw = zstandard.ZstdDecompressor().decompress(data, max_output_size=max(int(own[-1]), 1))
    return np.frombuffer(ids, dtype=np.int64), Chunk(slice(0, len(own) - 1), np.frombuffer(raw, dtype=np.uint8), own)


# -- runs of windows that share a minimizer ----------------------------------


@dataclass
class Runs:
    """Runs of consecutive windows with one minimizer, one of each content.

    first: word index of the run's first window in the document that stands
    for it; size: windows; core: minimizer; member: for each run of the block,
    in order, the content it belongs to, with where it starts.
    """

    core: np.ndarray
    size: np.ndarray
    first: np.ndarray
    member: np.ndarray
    start: np.ndarray
    prints: np.ndarray


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Smallest of the width entries from each one on."""
    out, have = x, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def find_runs(ids: np.ndarray, words: Words, k: int = WINDOW, core: int = CORE) -> Runs:
    """Runs of a block and the distinct contents among them; the smallest
    document id stands for a content."""
    prints, ok = ngrams(words, k)
    doc = words.doc()
    ok = ok & (ids[doc] != NO_OWNER) if len(doc) else ok
    if not ok.any():
        none = np.zeros(0, dtype=np.int64)
        return Runs(none.astype(np.uint64), none, none, none, none, prints)
    small, _ = ngrams(words, core)
    least = np.zeros(len(ok), dtype=np.uint64)
    sliding = _sliding_min(small, k - core + 1)
    least[: len(sliding)] = sliding
    at = np.flatnonzero(ok)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (least[at[1:]] != least[at[:-1]]) | (doc[at[1:]] != doc[at[:-1]])
    start = at[new]
    size = np.diff(np.append(np.flatnonzero(new), len(at)))
    # a run is cut so that its size fits a byte
    while (size > 255).any():
        long = np.flatnonzero(size > 255)
        start = np.concatenate([start, start[long] + 255])
        size = np.concatenate([size, size[long] - 255])
        size[long] = 255
        order = np.argsort(start, kind="stable")
        start, size = start[order], size[order]
    # content: the prints around and in the run, so that neighbours agree too
    total = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(np.where(ok, prints, 0) * np.uint64(0xD6E8FEB86659FD93))])
    around = lambda i: np.where((i >= 0) & (i < len(ok)), np.where(ok, prints, 0)[np.clip(i, 0, len(ok) - 1)], 0)
    same_doc = lambda i, j: doc[np.clip(i, 0, len(doc) - 1)] == doc[j]
    before = np.where(same_doc(start - 1, start) & (start > 0), around(start - 1), 0).astype(np.uint64)
    after = np.where(same_doc(start + size, start), around(start + size), 0).astype(np.uint64)
    content = (total[start + size] - total[start]) ^ (before * np.uint64(3)) ^ (after * np.uint64(5)) ^ size.astype(np.uint64)
    content ^= prints[start]
    order = np.lexsort((start, ids[doc[start]], content))
    fresh = np.ones(len(order), dtype=bool)
    fresh[1:] = content[order][1:] != content[order][:-1]
    member = np.empty(len(order), dtype=np.int64)
    member[order] = np.cumsum(fresh) - 1
    best = order[fresh]
    return Runs(least[start[best]], size[best], start[best], member, start, np.where(ok, prints, 0))


def _expand(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Indices first, first + 1, ... of every run, in order."""
    total = np.cumsum(size)
    return np.arange(total[-1] if len(total) else 0) - np.repeat(total - size - first, size)


def _narrow(x: np.ndarray, low: int = 0) -> bytes:
    """Values as the smallest unsigned type that holds them, after its size
    and the value taken off."""
    base = int(x.min()) if len(x) else 0
    top = int(x.max()) - base if len(x) else 0
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max)
    return np.array([np.dtype(kind).itemsize, base], dtype=np.int64).tobytes() + (x - base).astype(kind).tobytes()


def _wide(raw: bytes) -> np.ndarray:
    size, base = np.frombuffer(raw[:16], dtype=np.int64)
    return np.frombuffer(raw[16:], dtype=f"u{size}").astype(np.int64) + base


def _prints40(x: np.ndarray) -> bytes:
    return (x & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes() + ((x >> np.uint64(32)) & np.uint64(0xFF)).astype(np.uint8).tobytes()


def _from40(raw: bytes) -> np.ndarray:
    n = len(raw) // 5
    return np.frombuffer(raw[: 4 * n], dtype="<u4").astype(np.uint64) | (np.frombuffer(raw[4 * n :], dtype=np.uint8).astype(np.uint64) << np.uint64(32))


def _neighbour(prints: np.ndarray) -> np.ndarray:
    """Sixteen bits of a neighbour's print, 0 for no window there: enough to
    tell whether a path branches, which cuts spans and removes nothing."""
    return np.where(prints == 0, 0, np.maximum(prints & np.uint64(0xFFFF), 1))


def _send_runs(buckets: int, k: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                block, ids, data, bounds = (batch.column(c)[i].as_py() for c in ("block", "ids", "data", "bounds"))
                own, chunk = _load(ids, data, bounds)
                words = split_words(chunk)
                runs = find_runs(own, words, k)
                doc, first = words.doc(), words.first()
                bucket = ((runs.core >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
                order = np.argsort(bucket, kind="stable")
                cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
                out = {name: [] for name in ("bucket", "core", "size", "owner", "place", "prints", "sides")}
                for b in range(buckets):
                    at = order[cuts[b] : cuts[b + 1]]
                    if not len(at):
                        continue
                    start, size = runs.first[at], runs.size[at]
                    owner = own[doc[start]]
                    lead = (start > 0) & (doc[np.maximum(start - 1, 0)] == doc[start])
                    trail_at = np.minimum(start + size, len(doc) - 1)
                    trail = (doc[trail_at] == doc[start]) & (start + size < len(doc))
                    sides = [np.where(lead, _neighbour(runs.prints[np.maximum(start - 1, 0)]), 0), np.where(trail, _neighbour(runs.prints[trail_at]), 0)]
                    out["bucket"].append(b)
                    out["core"].append((runs.core[at] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes())
                    out["size"].append(size.astype(np.uint8).tobytes())
                    out["owner"].append(_narrow(owner))
                    out["place"].append(_narrow(start - first[doc[start]]))
                    out["prints"].append(_prints40(runs.prints[_expand(start, size)]))
                    out["sides"].append(np.concatenate(sides).astype("<u2").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out["bucket"], pa.int32()), pa.array([block] * len(out["bucket"]), pa.int64())]
                    + [pa.array(out[c], pa.binary()) for c in ("core", "size", "owner", "place", "prints", "sides")],
                    ["bucket", "block", "core", "size", "owner", "place", "prints", "sides"],
                )

    return rows


# -- buckets: owners, degrees and compacted pieces ---------------------------


def _run_start(key: np.ndarray) -> np.ndarray:
    fresh = np.ones(len(key), dtype=bool)
    fresh[1:] = key[1:] != key[:-1]
    return fresh


def _pieces_of(rows: list[tuple]) -> Iterator[tuple]:
    """Answers of one bucket to its blocks: for each run with removed windows
    the pieces that follow each other in one owner without branching."""
    core = np.concatenate([np.frombuffer(r[1], dtype="<u4") for r in rows]).astype(np.uint64)
    size = np.concatenate([np.frombuffer(r[2], dtype=np.uint8) for r in rows]).astype(np.int64)
    owner = np.concatenate([_wide(r[3]) for r in rows])
    place = np.concatenate([_wide(r[4]) for r in rows])
    prints = np.concatenate([_from40(r[5]) for r in rows])
    count = np.array([len(r[2]) for r in rows])
    # only minimizers that two contents share, or one content of two blocks
    _, inverse, shared = np.unique(core, return_inverse=True, return_counts=True)
    use = np.flatnonzero(shared[inverse] > 1)
    edge = np.cumsum(size) - size
    sides = [np.frombuffer(r[6], dtype="<u2").reshape(2, -1) for r in rows]
    lead, trail = (np.concatenate([x[i] for x in sides]).astype(np.uint64) for i in (0, 1))
    block_of = np.repeat(np.arange(len(rows)), count)
    local = np.arange(len(core)) - np.repeat(np.cumsum(count) - count, count)
    # contents that stand alone are owned by their own document, but may
    # stand for more documents of their block: those answers are kept local
    size_u, run = size[use], np.repeat(use, size[use])
    at = _expand(edge[use], size_u)
    offset = at - edge[run]
    window = prints[at]
    before = np.where(offset == 0, lead[run], _neighbour(prints[np.maximum(at - 1, 0)]))
    after = np.where(offset == size[run] - 1, trail[run], _neighbour(prints[np.minimum(at + 1, len(prints) - 1)]))
    key = window ^ (core[run] * np.uint64(0x9E3779B97F4A7C15))
    spot = place[run] + offset
    order = np.lexsort((spot, owner[run], key))
    fresh = _run_start(key[order])
    group = np.cumsum(fresh) - 1
    head = order[fresh]
    many = np.bincount(group) > 1
    best_owner, best_spot = owner[run][head][group], spot[head][group]

    def single(side: np.ndarray) -> np.ndarray:
        """Whether all occurrences of a window that have a neighbour there
        have the same one."""
        value = side[order]
        low = np.minimum.reduceat(np.where(value == 0, np.uint64(2**63), value), np.flatnonzero(fresh)) if len(value) else value
        high = np.maximum.reduceat(value, np.flatnonzero(fresh)) if len(value) else value
        return ((low == high) | (high == 0))[group]

    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.arange(len(order))
    o, s = best_owner[back], best_spot[back]
    one_in, one_out = (single(before) if len(order) else before)[back], (single(after) if len(order) else after)[back]
    # what the content's own document owns needs no answer
    hit = many[group][back] & (o != owner[run])
    # a piece: windows of one run, next to each other there and in the owner
    join = np.zeros(len(o), dtype=bool)
    join[1:] = (run[1:] == run[:-1]) & hit[1:] & hit[:-1] & (o[1:] == o[:-1]) & (s[1:] == s[:-1] + 1) & one_out[:-1] & one_in[1:]
    begin = np.flatnonzero(hit & ~join)
    if not len(begin):
        return
    piece = np.cumsum(hit & ~join) - 1
    length = np.bincount(piece[hit], minlength=len(begin))
    last = begin + length - 1
    linked = one_in[begin].astype(np.uint8) | (one_out[last].astype(np.uint8) << 1)
    where = block_of[run[begin]]
    cuts = np.searchsorted(where, np.arange(len(rows) + 1))
    for i, r in enumerate(rows):
        own = slice(cuts[i], cuts[i + 1])
        if cuts[i] < cuts[i + 1]:
            b = begin[own]
            yield r[0], local[run[b]], offset[b], length[own], o[b], s[b], linked[own]


def _answer(buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None

        def flush():
            found = list(_pieces_of(held)) if held else []
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([f[0] for f in found], pa.int64()),
                        # runs of a bucket are numbered as they were sent
                        pa.array([_narrow(f[1]) + now.to_bytes(4, "little") for f in found], pa.binary()),
                        pa.array([f[2].astype(np.uint8).tobytes() for f in found], pa.binary()),
                        pa.array([f[3].astype(np.uint8).tobytes() for f in found], pa.binary()),
                        pa.array([_narrow(f[4]) for f in found], pa.binary()),
                        pa.array([_narrow(f[5]) for f in found], pa.binary()),
                        pa.array([f[6].tobytes() for f in found], pa.binary()),
                    ],
                    ["block", "run", "offset", "length", "owner", "place", "linked"],
                )

        for batch in batches:
            for i in range(batch.num_rows):
                row = [batch.column(c)[i].as_py() for c in range(8)]
                if row[0] != now:
                    yield from flush()
                    held, now = [], row[0]
                held.append(row[1:])
        yield from flush()

    return rows


# -- documents ---------------------------------------------------------------


def _finish(buckets: int, k: int):
    """Expand the answers to a block's documents, remove and list the spans."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, data, bounds, answers = (batch.column(c)[i].as_py() for c in ("ids", "data", "bounds", "answers"))
                yield _document_rows(*_load(ids, data, bounds), answers or [], buckets, k)

    return rows


def _document_rows(ids: np.ndarray, chunk: Chunk, answers: list[dict], buckets: int, k: int) -> pa.RecordBatch:
    words = split_words(chunk)
    runs = find_runs(ids, words, k)
    n = len(words.hash)
    doc, first = words.doc(), words.first()
    owner = np.full(n, NO_OWNER, dtype=np.int64)
    place = np.zeros(n, dtype=np.int64)
    linked = np.zeros(n, dtype=np.uint8)
    # what the bucket says of each content
    bucket = ((runs.core >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    said = [np.zeros(0, dtype=np.int64)] * 6
    if answers:
        parts = []
        for a in answers:
            b = int.from_bytes(a["run"][-4:], "little")
            parts.append(
                (order[cuts[b] + _wide(a["run"][:-4])], np.frombuffer(a["offset"], np.uint8), np.frombuffer(a["length"], np.uint8), _wide(a["owner"]), _wide(a["place"]), np.frombuffer(a["linked"], np.uint8))
            )
        said = [np.concatenate([p[i] for p in parts]).astype(np.int64) for i in range(6)]
    # of windows that only this block holds, the content's first document owns
    every = _expand(runs.first[runs.member], runs.size[runs.member]) if len(runs.member) else np.zeros(0, dtype=np.int64)
    at = _expand(runs.start, runs.size[runs.member]) if len(runs.member) else every
    stands = ids[doc[every]] if n else every
    owner[at] = stands
    place[at] = every - first[doc[every]] if n else every
    linked[at] = 3
    if len(said[0]):
        by = np.argsort(said[0], kind="stable")
        said = [x[by] for x in said]
        low = np.searchsorted(said[0], runs.member)
        high = np.searchsorted(said[0], runs.member, side="right")
        member = np.repeat(np.arange(len(runs.member)), high - low)
        piece = _expand(low, high - low)
        size = said[2][piece]
        to = _expand(runs.start[member] + said[1][piece], size)
        step = _expand(np.zeros(len(piece), dtype=np.int64), size)
        owner[to] = np.repeat(said[3][piece], size)
        place[to] = np.repeat(said[4][piece], size) + step
        flag = np.full(len(to), 3, dtype=np.uint8)
        link = said[5][piece].astype(np.uint8)
        flag[step == 0] &= link | 2
        ends = np.cumsum(size) - 1
        flag[ends] &= link | 1
        linked[to] = flag
    lost = (owner < ids[doc]) & (ids[doc] != NO_OWNER) if n else np.zeros(0, dtype=bool)
    gone = covered(lost, k)
    # spans: pieces that follow each other in the document and in the owner
    join = np.zeros(n, dtype=bool)
    if n > 1:
        join[1:] = lost[1:] & lost[:-1] & (doc[1:] == doc[:-1]) & (owner[1:] == owner[:-1]) & (place[1:] == place[:-1] + 1)
        join[1:] &= ((linked[:-1] & 2) > 0) & ((linked[1:] & 1) > 0)
    begin = np.flatnonzero(lost & ~join)
    length = np.bincount((np.cumsum(lost & ~join) - 1)[lost], minlength=len(begin)) + k - 1 if len(begin) else begin
    span = pa.StructArray.from_arrays(
        [pa.array(begin - first[doc[begin]] if len(begin) else begin, pa.int64()), pa.array(length, pa.int64()), pa.array(owner[begin], pa.int64()), pa.array(place[begin], pa.int64())],
        ["start", "length", "owner", "owner_start"],
    )
    offsets = np.searchsorted(begin, first).astype(np.int32)
    raw = chunk.data.tobytes()
    keep = np.flatnonzero(~gone)
    pieces = [raw[a:b] for a, b in zip(words.start[keep].tolist(), words.end[keep].tolist(), strict=True)]
    bound = np.searchsorted(keep, first).tolist()
    kept = [b" ".join(pieces[a:b]) for a, b in zip(bound[:-1], bound[1:], strict=True)]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64(), mask=ids == NO_OWNER),
            pa.array(words.counts, pa.int64()),
            pa.array(np.bincount(doc[gone], minlength=len(ids)), pa.int64()),
            pa.array(kept, pa.binary()).cast(pa.string()),
            pa.ListArray.from_arrays(pa.array(offsets), span),
        ],
        ["doc_id", "n_words", "n_removed", "kept_text", "spans"],
    )


def dedup_spans(docs: DataFrame, k: int = WINDOW, buckets: int | None = None) -> DataFrame:
    """doc_id, n_words, n_removed, kept_text (kept words joined by one space)
    and spans (removed runs of words with their owner's coordinates)."""
    spark = docs.sparkSession
    small_batches(spark)
    blocks = materialise(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_blocks, BLOCK_SCHEMA), "substring-blocks")
    if buckets is None:
        size = blocks.agg(F.coalesce(F.sum("size"), F.lit(0))).collect()[0][0]
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // BUCKET_BYTES)
    runs = blocks.mapInArrow(_send_runs(buckets, k), RUN_SCHEMA)
    pieces = runs.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(_answer(buckets), PIECE_SCHEMA)
    answers = pieces.groupBy("block").agg(F.collect_list(F.struct("run", "offset", "length", "owner", "place", "linked")).alias("answers"))
    joined = blocks.join(answers, "block", "left").select("ids", "data", "bounds", "answers")
    schema = f"doc_id long, n_words long, n_removed long, kept_text string, spans {SPAN}"
    return joined.mapInArrow(_finish(buckets, k), schema)
