"""Word and n-gram hashes of whole texts, computed over Arrow buffers.

A word is a maximal run of characters other than the ASCII white space
``\\x20 \\x09-\\x0D``.  All functions work on one bounded chunk of documents at
a time, so memory follows the chunk (or one very long text), not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1
_BASE_INV = pow(_BASE, -1, 1 << 64)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_powers = np.ones(1, dtype=np.uint64)
_inverses = np.ones(1, dtype=np.uint64)


def _grow(n: int) -> None:
    """Powers of the hash base and of its inverse modulo 2**64, up to n."""
    global _powers, _inverses
    if len(_powers) > n:
        return
    size = max(n + 1, CHUNK_BYTES + 1)
    for name, base in (("_powers", _BASE), ("_inverses", _BASE_INV)):
        out = np.ones(1, dtype=np.uint64)
        while len(out) < size:
            out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
        globals()[name] = out[:size].copy()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalising mix of 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Chunk:
    """Consecutive documents of a batch.

    rows: their slice of the batch; data: their bytes; bounds: byte offset of
    each document in data (one more than documents).
    """

    rows: slice
    data: np.ndarray
    bounds: np.ndarray

    @property
    def n(self) -> int:
        return len(self.bounds) - 1


@dataclass
class Words:
    """Words of a chunk: 64-bit hash, byte span, and words per document."""

    hash: np.ndarray
    start: np.ndarray
    end: np.ndarray
    counts: np.ndarray
    total: np.ndarray

    def prefix(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the first bytes of each word that is longer, and the index
        of those words."""
        at = np.flatnonzero(self.end - self.start > size)
        start = self.start[at]
        return mix((self.total[start + size] - self.total[start]) * _inverses[start] + np.uint64(size)), at

    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    def first(self) -> np.ndarray:
        """Index of each document's first word (one more than documents)."""
        return np.concatenate([[0], np.cumsum(self.counts)])


def chunks(texts: pa.Array, max_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a string array (null: empty text) into chunks of bounded bytes; a
    text longer than the bound is a chunk of its own."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    n = len(texts)
    if not n:
        return
    wide = pa.types.is_large_string(texts.type)
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + n + 1].astype(np.int64)
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.zeros(0, dtype=np.uint8)
    at = 0
    while at < n:
        to = int(np.searchsorted(offsets, offsets[at] + max_bytes, side="right")) - 1
        to = min(n, max(at + 1, to))
        lo, hi = offsets[at], offsets[to]
        yield Chunk(slice(at, to), data[lo:hi], offsets[at : to + 1] - lo)
        at = to


#: Everything in ASCII but letters and digits parts the terms of a text.
TERM_BREAKS = np.ones(256, dtype=bool)
TERM_BREAKS[np.r_[48:58, 65:91, 97:123, 128:256]] = False


def split_words(chunk: Chunk, lower: bool = False, breaks: np.ndarray = _SPACE) -> Words:
    """Words of each document of the chunk; lower: A-Z are lower-cased first
    (for other breaks than white space also the Latin letters above ASCII, as
    far as they take two bytes that start with C3); breaks: the bytes that
    part words."""
    b, bounds = chunk.data, chunk.bounds
    n = len(b)
    if not n:
        empty = np.zeros(0, dtype=np.int64)
        return Words(np.zeros(0, dtype=np.uint64), empty, empty, np.zeros(chunk.n, dtype=np.int64), np.zeros(1, dtype=np.uint64))
    if lower:
        b = _LOWER[b]
        if breaks is not _SPACE:
            at = np.flatnonzero(b[:-1] == 0xC3) + 1
            at = at[(b[at] >= 0x80) & (b[at] <= 0x9E) & (b[at] != 0x97)]
            b[at] += 0x20
    space = breaks[b]
    solid = ~space
    head, tail = solid.copy(), solid.copy()
    head[1:] &= space[:-1]
    tail[:-1] &= space[1:]
    first = bounds[:-1]
    first = first[first < n]
    head[first] = solid[first]
    last = bounds[1:] - 1
    last = last[last >= 0]
    tail[last] = solid[last]
    start, end = np.flatnonzero(head), np.flatnonzero(tail) + 1
    _grow(n)
    total = np.empty(n + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * _powers[:n], out=total[1:])
    h = mix((total[end] - total[start]) * _inverses[start])
    counts = np.diff(np.searchsorted(start, bounds))
    return Words(h, start, end, counts, total)


def ngrams(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the k words from each word on, and whether they all belong to
    the word's document."""
    h = words.hash
    n = len(h)
    if n < k:
        return np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=bool)
    m = n - k + 1
    out = np.zeros(n, dtype=np.uint64)
    acc = h[:m].copy()
    for j in range(1, k):
        acc *= np.uint64(_BASE)
        acc += h[j : j + m]
    out[:m] = mix(acc)
    doc = words.doc()
    ok = np.zeros(n, dtype=bool)
    ok[:m] = doc[:m] == doc[k - 1 :]
    return out, ok


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values; much faster than np.unique without options,
    which hashes."""
    x = np.sort(x)
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def by_chunk(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, Chunk]]:
    """Slices of a batch, with the text chunk of each."""
    for c in chunks(batch.column(column)):
        yield batch.slice(c.rows.start, c.rows.stop - c.rows.start), c


def covered(flags: np.ndarray, k: int) -> np.ndarray:
    """Words in any flagged window of k words (flags: by first word)."""
    n = len(flags)
    step = np.zeros(n + k, dtype=np.int32)
    step[:n] += flags
    step[k:] -= flags
    return np.cumsum(step[:n]) > 0


def strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(start.tolist(), end.tolist(), strict=True)]
