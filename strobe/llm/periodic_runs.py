"""Runs of repeated words by string synchronising sets.

A run is a stretch of words with smallest period q that is at least four
periods long and cannot be extended.  For each dyadic scale t the run's period
lies in [t, 2t) for one of them, and there:

1. Every position has the hash of its t words.  Position i is in the
   synchronising set if the smallest hash of the positions i..i+t, highly
   periodic ones left out, is that of i or i+t.  This depends on the 2t words
   from i alone, so a position and its copy one period on are both in the set,
   and any t positions whose 3t - 1 words are not highly periodic hold one.
2. Highly periodic are the t-word stretches with a period of at most t/4: they
   lie inside runs of smaller scales, which have been found by then.  Leaving
   them out keeps the set sparse; their own small periods are already known.
3. Neighbours in the set with equal 2t-word contexts propose their distance as
   a period.  Inside a run no nearer position has the same context, or its
   smallest period would be smaller, so each run of the scale is proposed.
4. Proposals of one period whose contexts overlap are one; they are extended
   both ways by comparing prefix hashes, and what is long enough is checked
   word by word.  One stretch keeps its smallest period.

Work is numpy over the words of one bounded chunk of texts (or one very long
text): O(n) positions a scale for the documents long enough for it.  Words are
compared by 64-bit hashes.

Defined results: a null or empty text has no runs and collapses to an empty
text; a null id and rows that repeat an id get their own row each; other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strobe.llm.shared import small_batches
from strobe.llm.words import Words, by_chunk, mix, split_words

#: Periods that a run has at least, and words.
LEAST_PERIODS = 4
LEAST_WORDS = 6
_ODD = np.uint64(0xD6E8FEB86659FD93)
_BASE = 0x9E3779B97F4A7C15 | 1
_NEVER = np.uint64(0xFFFFFFFFFFFFFFFF)

_powers = np.ones(1, dtype=np.uint64)


def _powers_to(n: int) -> np.ndarray:
    global _powers
    while len(_powers) <= n:
        _powers = np.concatenate([_powers, _powers * np.uint64(pow(_BASE, len(_powers), 1 << 64))])
    return _powers


def _marked(n: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Positions inside any [start, end)."""
    step = np.bincount(start, minlength=n + 1).astype(np.int64) - np.bincount(end, minlength=n + 1)
    return np.cumsum(step[:n]) > 0


def synchronising(ids: np.ndarray, periodic: np.ndarray, t: int) -> np.ndarray:
    """Whether each position but the last t is in the set of scale t.  ids:
    hashes of t words; periodic: positions that are left out."""
    own = np.where(periodic, _NEVER, ids)
    low = own
    size = 1
    while size < t:
        low = np.minimum(low[: len(low) - size], low[size:])
        size *= 2
    low = np.minimum(low[:-1], low[1:])  # of i..i+t
    n = len(low)
    return ((low == own[:n]) | (low == own[t : t + n])) & (low != _NEVER)


def proposals(ids: np.ndarray, context: np.ndarray, periodic: np.ndarray, doc: np.ndarray, end: np.ndarray, t: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions with the same context as the next of their kind in the set,
    and the distance, if it is in [t, 2t)."""
    chosen = np.flatnonzero(synchronising(ids, periodic, t))
    chosen = chosen[chosen + 2 * t <= end[chosen]]
    key = context[chosen] ^ mix(doc[chosen].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    at, key = chosen[order], key[order]
    apart = at[1:] - at[:-1]
    hit = np.flatnonzero((key[1:] == key[:-1]) & (apart >= t) & (apart < 2 * t))
    return at[hit], apart[hit]


class Text:
    """Words of several documents side by side, with prefix hashes."""

    def __init__(self, words: Words):
        self.hash = words.hash
        first = words.first()
        self.first, self.counts = first[:-1], words.counts
        self.begin = np.repeat(first[:-1], words.counts)
        self.end = np.repeat(first[1:], words.counts)
        n = len(self.hash)
        self.powers = _powers_to(n + 1)
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.hash * self.powers[:n], out=self.total[1:])

    def same(self, x: np.ndarray, size: np.ndarray, apart: np.ndarray) -> np.ndarray:
        """Whether the words from x and from x + apart on are equal."""
        y = x + apart
        return (self.total[x + size] - self.total[x]) * self.powers[apart] == self.total[y + size] - self.total[y]

    def _longest(self, fits, most: np.ndarray) -> np.ndarray:
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            mid = (low + high + 1) // 2
            ok = fits(mid)
            low, high = np.where(ok, mid, low), np.where(ok, high, mid - 1)
        return low

    def extend(self, a: np.ndarray, b: np.ndarray, apart: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The runs of period apart around equal stretches [a, b)."""
        more = self._longest(lambda m: self.same(b, m, apart), self.end[a] - apart - b)
        less = self._longest(lambda m: self.same(a - m, m, apart), a - self.begin[a])
        return a - less, b + more + apart

    def checked(self, start: int, end: int, period: int, inside: int) -> tuple[int, int]:
        """The run around a position compared word by word, if the hashes of
        its stretches were equal by chance."""
        h = self.hash
        if np.array_equal(h[start : end - period], h[start + period : end]):
            return start, end
        lo, hi = int(self.begin[start]), int(self.end[start])
        other = np.flatnonzero(h[lo : hi - period] != h[lo + period : hi]) + lo
        before, after = other[other < inside], other[other >= inside]
        return (int(before[-1]) + 1 if len(before) else lo), (int(after[0]) + period if len(after) else hi)


def find_runs(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and period of all runs of at least LEAST_PERIODS periods, by
    start, then period; positions count over all documents of the chunk."""
    text = Text(words)
    starts, ends, periods = (np.zeros(0, dtype=np.int64) for _ in range(3))
    at = np.arange(len(text.hash))  # positions of the documents that are long enough
    ids, doc, size = text.hash, words.doc(), np.repeat(words.counts, words.counts)
    t = 1
    while True:
        keep = size >= LEAST_PERIODS * t
        if not keep.any():
            break
        if not keep.all():
            at, ids, doc, size = at[keep], ids[keep], doc[keep], size[keep]
        n = len(at)
        end = np.searchsorted(doc, doc, side="right")
        inner = (LEAST_PERIODS * periods <= t) & (ends - starts >= t)
        a, b = np.searchsorted(at, starts[inner]), np.searchsorted(at, ends[inner] - 1) + 1
        # runs lie in documents of their length, which are all still there
        here = np.flatnonzero((a < n) & (at[np.minimum(a, n - 1)] == starts[inner]))
        periodic = _marked(n, a[here], b[here] - t + 1)
        following = np.roll(ids, -t)
        context = mix(ids * _ODD + ((following << np.uint64(23)) | (following >> np.uint64(41))))
        i, apart = proposals(ids, context, periodic, doc, end, t)
        order = np.lexsort((i, apart))
        i, apart = at[i[order]], apart[order]
        if len(i):
            opens = np.r_[True, (apart[1:] != apart[:-1]) | (i[1:] >= i[:-1] + 2 * t)]
            head = np.flatnonzero(opens)
            last = np.r_[head[1:], len(i)] - 1
            lo, hi, d = i[head], i[last] + 2 * t, apart[head]
            s, e = text.extend(lo, hi, d)
            for k in np.flatnonzero(e - s >= LEAST_PERIODS * d).tolist():
                s[k], e[k] = text.checked(int(s[k]), int(e[k]), int(d[k]), int(lo[k]))
            long = e - s >= LEAST_PERIODS * d
            starts, ends, periods = (np.concatenate(x) for x in ((starts, s[long]), (ends, e[long]), (periods, d[long])))
            order = np.lexsort((periods, ends, starts))
            starts, ends, periods = starts[order], ends[order], periods[order]
            new = np.r_[True, (starts[1:] != starts[:-1]) | (ends[1:] != ends[:-1])][: len(starts)]
            starts, ends, periods = starts[new], ends[new], periods[new]
        ids = context
        t *= 2
    order = np.lexsort((periods, starts))
    order = order[(ends - starts)[order] >= LEAST_WORDS]
    return starts[order], ends[order], periods[order]


def joined(data: np.ndarray, words: Words, index: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Texts of the words with the given indexes, joined by one space; counts:
    words of each text."""
    last = np.zeros(len(index), dtype=bool)
    ends = np.cumsum(counts)
    last[ends[counts > 0] - 1] = True
    start = words.start[index]
    size = words.end[index] - start + ~last
    to = np.cumsum(size)
    total = int(to[-1]) if len(to) else 0
    source = np.arange(total) + np.repeat(start - (to - size), size)
    gap = (to - 1)[~last]
    source[gap] = 0
    out = data[source] if total else np.zeros(0, dtype=np.uint8)
    out[gap] = 0x20
    offsets = np.concatenate([[0], to])[np.concatenate([[0], ends])]
    return pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(offsets.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes()))


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
SCHEMA = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def periodic_runs(docs: DataFrame) -> DataFrame:
    """Runs of every text (word numbers, by start, then period) and the text
    with each run collapsed to its first period."""
    small_batches(docs.sparkSession)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, chunk in by_chunk(batch, "text"):
                words = split_words(chunk)
                start, end, period = find_runs(words)
                n = len(words.hash)
                kept = np.flatnonzero(~_marked(n, start + period, end)) if n else np.zeros(0, dtype=np.int64)
                first = words.first()
                of = np.searchsorted(first, start, side="right") - 1
                found = pa.StructArray.from_arrays([pa.array(start - first[of]), pa.array(end - start), pa.array(period)], fields=list(RUN))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(words.counts.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(np.searchsorted(of, np.arange(chunk.n + 1)), pa.int32()), found),
                        joined(chunk.data, words, kept, np.diff(np.searchsorted(kept, first))).cast(pa.string()),
                    ],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, SCHEMA)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text; one text in ten, by the checksum of its id, repeats a
    stretch of its words from a place on to its end."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, chunk in by_chunk(batch, "text"):
                ids = part.column("doc_id").to_pylist()
                sums = [None if i is None else zlib.crc32(str(i).encode()) for i in ids]
                chosen = [k for k, h in enumerate(sums) if h is not None and h % 10 == 0]
                texts = part.column("text")
                if chosen:
                    words = split_words(chunk)
                    first = words.first()
                    index, counts = [], []
                    for k in chosen:
                        n = int(words.counts[k])
                        at = np.arange(n)
                        if n:
                            g = sums[k] // 10
                            a = g % n
                            p = 1 + (n - a) // (3 + g % 8)
                            at[a:] = a + (at[a:] - a) % p
                        index.append(first[k] + at)
                        counts.append(n)
                    made = joined(chunk.data, words, np.concatenate(index), np.array(counts)).cast(pa.string())
                    new = np.full(part.num_rows, -1)
                    new[chosen] = np.arange(len(chosen))
                    mine = pa.array(new >= 0)
                    texts = pc.if_else(mine, made.take(pa.array(np.maximum(new, 0))), texts)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), texts], ["doc_id", "text"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, text string")


def greatest(runs: Column) -> Column:
    """The run with the greatest exact length / period; the first of equal ones."""
    none = F.lit(None).cast("struct<start:long,length:long,period:long>")
    return F.aggregate(
        runs, none, lambda best, x: F.when(best.isNull() | (x["length"] * best["period"] > best["length"] * x["period"]), x).otherwise(best)
    )
