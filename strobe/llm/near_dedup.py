"""MinHash near-dedup by a multi-index Hamming join over b-bit signatures.

Documents whose sets of word shingles have a Jaccard similarity of at least
the threshold are linked; components of links are the groups.

1. Every document gets its shingle set's hash and a signature of m * s symbols
   of b bits.  Copies with one set become one class, its smallest id the node.
2. Two sets at the threshold differ in a symbol with probability 1 - J, so at
   most 2m - 1 of the m * s symbols differ but for a chance below MISS; m
   follows from that.  By the pigeonhole principle one of the m chunks then
   has at most one error.  All one-error patterns of a chunk are enumerated by
   leaving each of its symbols out in turn: nodes that share a key of (chunk,
   left-out position, other symbols) are candidates, and every pair within
   2m - 1 differing symbols shares one.
3. In each of a few rounds, every node of a bucket that holds several
   groups is paired with one node that stands for another: one pair a node.
   Pairs whose signatures are near enough are confirmed on the full shingle
   sets, and confirmed links bring groups together: the smallest node within
   two links, which two grouped minima find.
4. Nodes whose buckets still hold several components are compared across these
   components in blocks, by signature and then on the full sets, inside the
   tasks: only links leave them.  Pairs inside a group cannot change the
   result and are not compared.  All links together then give the components.

Defined results: texts without words have an empty set and no links; rows that
repeat an id are one node, whatever their texts; a null id gets its set's size
but no group (component null, kept); other columns are not read.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strobe.functions.columns import q
from strobe.llm.shared import connected_components, counted, materialise, nearest_roots, shuffled_joins, small_batches
from strobe.llm.words import Chunk, by_chunk, chunks, distinct, mix, ngrams, signed, split_words

#: Chance that a pair right at the threshold has more differing symbols than
#: the join allows; it falls off steeply above the threshold.
MISS = 1e-4
#: Members of one verification group, and nodes of one block of a cluster.
GROUP = 64
BLOCK = 512
#: Rounds of one pair for each node before clusters are compared in full; any
#: number gives the same groups.
ROUNDS = 3


@dataclass(frozen=True)
class Scheme:
    """Signature layout for a shingle size and a threshold in percent."""

    size: int
    percent: int
    chunks: int
    symbols: int

    @property
    def length(self) -> int:
        return self.chunks * self.symbols

    @property
    def errors(self) -> int:
        return 2 * self.chunks - 1


def scheme(size: int, percent: int) -> Scheme:
    """Chunks of about one expected error each, as few as MISS allows."""
    q = 1 - percent / 100
    symbols = min(9, max(3, round(0.95 / q)))
    for m in range(2, 200):
        n, t = m * symbols, 2 * m - 1
        tail = 1 - sum(math.comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(t + 1))
        if tail <= MISS:
            return Scheme(size, percent, m, symbols)
    raise ValueError(f"no signature for a threshold of {percent} %")


def shingle_sets(chunk: Chunk, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each document; with fewer words than
    a shingle has, the whole sequence is one."""
    words = split_words(chunk, lower=True)
    grams, _ = ngrams(words, size)
    first = words.first()
    out = []
    for i in range(chunk.n):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= size:
            out.append(distinct(grams[a : b - size + 1]))
        elif b > a:
            whole = np.uint64(xxhash.xxh3_64_intdigest(words.hash[a:b].tobytes()))
            out.append(np.array([whole], dtype=np.uint64))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def _multipliers(n: int) -> tuple[np.ndarray, np.ndarray]:
    raw = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (raw[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (raw[n:] >> np.uint64(32)).astype(np.uint32)


def signature(shingles: np.ndarray, odd: np.ndarray, flip: np.ndarray) -> np.ndarray:
    """One byte for each hash function: bits of the smallest hash of the set."""
    low = np.full(len(odd), 0xFFFFFFFF, dtype=np.uint32)
    short = (shingles >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(short), 4096):
        x = short[at : at + 4096, None] ^ flip
        x *= odd
        x ^= x >> np.uint32(15)
        x *= np.uint32(0x2C1B3C6D)
        np.minimum(low, x.min(axis=0), out=low)
    return (mix(low.astype(np.uint64) + np.uint64(1)) & np.uint64(0xFF)).astype(np.uint8)


SIGNED = "doc_id long, set_a long, set_b long, n_shingles long, signature binary"


def signatures(docs: DataFrame, s: Scheme) -> DataFrame:
    """Set size, 128-bit set hash and signature of every document."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        odd, flip = _multipliers(s.length)
        for batch in batches:
            for part, chunk in by_chunk(batch, "text"):
                sets = shingle_sets(chunk, s.size)
                digest = np.frombuffer(b"".join(xxhash.xxh3_128_digest(x.tobytes()) for x in sets), dtype=np.int64).reshape(-1, 2)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(digest[:, 0]),
                        pa.array(digest[:, 1]),
                        pa.array([len(x) for x in sets], pa.int64()),
                        pa.array([signature(x, odd, flip).tobytes() if len(x) else None for x in sets], pa.binary()),
                    ],
                    ["doc_id", "set_a", "set_b", "n_shingles", "signature"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, SIGNED)


def _matrix(column: pa.Array, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, length)


def bucket_keys(nodes: DataFrame, s: Scheme) -> DataFrame:
    """(key, node): each chunk of a signature with each symbol left out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sig = _matrix(batch.column("signature"), s.length).astype(np.uint64)
            for c in range(s.chunks):
                for j in range(s.symbols):
                    packed = np.full(len(sig), c * s.symbols + j + 1, dtype=np.uint64)
                    for i in range(s.symbols):
                        if i != j:
                            packed = packed * np.uint64(257) + sig[:, c * s.symbols + i]
                    yield pa.RecordBatch.from_arrays([pa.array(signed(mix(packed))), batch.column("node")], ["key", "node"])

    return nodes.select("node", "signature").mapInArrow(rows, "key long, node long")


def near_pairs(pairs: DataFrame, nodes: DataFrame, s: Scheme) -> DataFrame:
    """The (a, b) pairs whose signatures differ in at most the allowed symbols."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                far = (_matrix(batch.column("x"), s.length) != _matrix(batch.column("y"), s.length)).sum(axis=1)
                yield batch.select(["a", "b"]).filter(pa.array(far <= s.errors))

    own = nodes.select("node", "signature")
    both = pairs.join(own.select(F.col("node").alias("a"), F.col("signature").alias("x")), "a").join(
        own.select(F.col("node").alias("b"), F.col("signature").alias("y")), "b"
    )
    return both.select("a", "b", "x", "y").mapInArrow(rows, "a long, b long").distinct()


def _overlap(x: np.ndarray, y: np.ndarray) -> int:
    if not len(x) or not len(y):
        return 0
    return int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum())


def confirm(pairs: DataFrame, texts: DataFrame, s: Scheme) -> DataFrame:
    """The (a, b) pairs whose full shingle sets reach the threshold.

    Partners of one node a come to tasks in groups of at most about GROUP, each
    with the text of a before them, so only one set is held at a time.
    """
    counts = pairs.groupBy("a").agg(F.count("*").alias("n"))
    dealt = pairs.join(counts, "a").select(
        "a", "b", F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / GROUP)).cast("int").alias("part")
    )
    dealt = materialise(dealt, "near-pairs")
    partners = dealt.join(texts.select(F.col("node").alias("b"), "text"), "b").select("a", "part", "b", "text")
    heads = (
        dealt.select("a", "part").distinct().join(texts.select(F.col("node").alias("a"), "text"), "a")
        .select("a", "part", F.lit(None).cast("long").alias("b"), "text")
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, heads = None, []
        for batch in batches:
            found = []
            a, part, b = (batch.column(c).to_pylist() for c in ("a", "part", "b"))
            for c in chunks(batch.column("text")):
                for i, own in zip(range(c.rows.start, c.rows.stop), shingle_sets(c, s.size), strict=True):
                    if (a[i], part[i]) != now:
                        now, heads = (a[i], part[i]), []
                    if b[i] is None:
                        heads.append(own)
                        continue
                    for head in heads:
                        both = _overlap(head, own)
                        if 100 * both >= s.percent * (len(head) + len(own) - both) and both:
                            found.append((a[i], b[i]))
                            break
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1] for x in found], pa.int64())], ["a", "b"])

    together = partners.unionByName(heads).repartition("a", "part").sortWithinPartitions("a", "part", F.col("b").asc_nulls_first())
    return together.mapInArrow(rows, "a long, b long").distinct()


def _opened(members: DataFrame, groups: DataFrame | None) -> DataFrame:
    """Members of buckets that hold several components, with the smallest and
    the largest (component, node) of the bucket."""
    labelled = members.select("key", "node", F.col("node").alias("component"))
    if groups is not None:
        labelled = members.select("key", "node").join(groups, "node", "left").select("key", "node", F.coalesce("root", "node").alias("component"))
    pair = F.struct("component", "node")
    ends = labelled.groupBy("key").agg(F.min(pair).alias("first"), F.max(pair).alias("last")).where("first.component < last.component")
    return labelled.join(ends, "key")


def _star(opened: DataFrame) -> DataFrame:
    """One pair (a, b) for each node: with the smallest node that stands for
    another component in one of its buckets."""
    other = F.when(F.col("first.component") != F.col("component"), F.col("first.node")).otherwise(F.col("last.node"))
    one = opened.select("node", other.alias("other")).groupBy("node").agg(F.min("other").alias("other"))
    return one.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct()


def _cluster_links(opened: DataFrame, nodes: DataFrame, texts: DataFrame, s: Scheme) -> DataFrame:
    """Every link across components among nodes that buckets still connect.

    Such nodes form clusters.  A cluster is dealt to blocks of about BLOCK
    nodes, and every two of its blocks meet in a task with their texts, where
    pairs across components within the allowed distance are confirmed.  Only
    links leave the task, and pairs that found links have joined are skipped.
    """
    opened = opened.select("key", "node", "component", F.col("first.node").alias("centre"))
    ties = opened.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    clusters = connected_components(ties, "near-clusters").withColumnRenamed("root", "cluster")
    own = opened.select("node", "component").distinct().join(clusters, "node")
    sizes = own.groupBy("cluster").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    dealt = own.join(sizes, "cluster").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    meet = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "cluster", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "node", "component"
    )
    full = meet.join(nodes.select("node", "signature"), "node").join(texts, "node")
    columns = ["cluster", "low", "high", "own", "node", "component", "signature", "text"]

    def links(now: tuple, rows: list[tuple]) -> Iterator[tuple[int, int]]:
        node, component, sig = np.array([r[1] for r in rows]), np.array([r[2] for r in rows]), np.stack([r[3] for r in rows])
        side = np.array([r[0] for r in rows])
        left, right = np.flatnonzero(side == now[1]), np.flatnonzero(side == now[2])
        for i in left:
            at = right[right > i] if now[1] == now[2] else right
            at = at[component[at] != component[i]]
            if not len(at):
                continue
            far = (sig[at] != sig[i]).sum(axis=1)
            near = far <= s.errors
            for j in at[near][np.argsort(far[near], kind="stable")]:
                if component[i] == component[j]:
                    continue
                both = _overlap(rows[i][4], rows[j][4])
                if both and 100 * both >= s.percent * (len(rows[i][4]) + len(rows[j][4]) - both):
                    yield min(node[i], node[j]), max(node[i], node[j])
                    component[component == component[j]] = component[i]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def flush():
            found = list(links(now, held)) if len(held) > 1 else []
            yield pa.RecordBatch.from_arrays([pa.array([int(f[i]) for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])

        for batch in batches:
            key, low, high, own, node, component, sig = (batch.column(c).to_pylist() for c in columns[:-1])
            for c in chunks(batch.column("text")):
                for i, shingles in zip(range(c.rows.start, c.rows.stop), shingle_sets(c, s.size), strict=True):
                    if (key[i], low[i], high[i]) != now:
                        yield from flush()
                        now, held = (key[i], low[i], high[i]), []
                    held.append((own[i], node[i], component[i], np.frombuffer(sig[i], dtype=np.uint8), shingles))
        yield from flush()

    together = full.select(*columns).repartition("cluster", "low", "high").sortWithinPartitions("cluster", "low", "high")
    return together.mapInArrow(rows, "a long, b long")


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document."""
    small_batches(docs.sparkSession)
    with shuffled_joins(docs.sparkSession):
        found, classes, groups = _grouped(docs, scheme(size, percent))
    by_doc = found.join(classes.select("set_a", "set_b", "node"), ["set_a", "set_b"], "left").join(groups, "node", "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("root", "node")).otherwise(F.col("doc_id"))
    return by_doc.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id")).select(
        "*", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


def _grouped(docs: DataFrame, s: Scheme) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signed documents, classes of one set, and the root of every linked node."""
    found = materialise(signatures(docs, s), "near-signatures")
    linkable = found.where("doc_id is not null and n_shingles > 0")
    classes = linkable.groupBy("set_a", "set_b").agg(F.min("doc_id").alias("node"), F.min("signature").alias("signature"))
    classes = materialise(classes, "near-classes")
    nodes = classes.select("node", "signature")

    keys = bucket_keys(nodes, s)
    shared = keys.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("most")).where("least < most").select("key")
    members = materialise(keys.join(shared, "key"), "near-buckets")
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text").join(members.select("node").distinct(), "node", "left_semi")
    texts = materialise(texts, "near-texts")

    # ids with several sets tie their classes
    same = linkable.select("doc_id", "set_a", "set_b").distinct().join(classes.select("set_a", "set_b", "node"), ["set_a", "set_b"])
    same = same.groupBy("doc_id").agg(F.min("node").alias("a"), F.collect_set("node").alias("others")).where(F.size("others") > 1)
    links, n, _ = counted(same.select("a", F.explode("others").alias("b")).where("a < b"), "near-links")
    every = [links] if n else []
    # nodes that links have brought together, as far as a cheap step tells
    groups = nearest_roots(links, "near-groups") if n else None
    # buckets whose nodes have come together stay closed, so each round reads
    # what the one before left open
    left, open_rows, _ = counted(_opened(members, groups), "near-open")
    rounds = ROUNDS
    while open_rows:
        last = rounds == 0
        found_links = _cluster_links(left, nodes, texts, s) if last else confirm(near_pairs(_star(left), nodes, s), texts, s)
        links, n, _ = counted(found_links, "near-links", None if last else open_rows)
        every += [links] if n else []
        if last:
            break
        rounds = rounds - 1 if n else 0
        if n:
            known = links if groups is None else links.unionByName(groups.select(F.col("node").alias("a"), F.col("root").alias("b")))
            groups = nearest_roots(known, "near-groups", open_rows)
            left, open_rows, _ = counted(_opened(left, groups), "near-open", open_rows)
    if every:
        groups = connected_components(functools.reduce(DataFrame.unionByName, every), "near-components")
    else:
        groups = classes.select("node", F.col("node").alias("root")).limit(0)
    return found, classes, groups


def keep_representatives(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with all its columns: that of the smallest
    id, and where rows repeat the id the smallest of them by its columns in
    order.  Rows without id stay."""
    kept = near_duplicates(docs, size, percent).where("kept and doc_id is not null").select(F.col("doc_id").alias("__kept_id")).distinct()
    known = docs.join(kept, docs["doc_id"].cast("long") == F.col("__kept_id"), "left_semi")
    known = known.groupBy(F.col("doc_id").alias("__id")).agg(F.min(F.struct(*[F.col(q(c)) for c in docs.columns])).alias("__row"))
    return known.select("__row.*").unionByName(docs.where("doc_id is null"))
