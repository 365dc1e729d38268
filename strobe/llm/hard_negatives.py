"""Hard negatives by bounds along a spanning tree of the anchors.

The score of a row for an anchor is the inner product of their integer
vectors.  Anchors are dealt, near ones together, to blocks of bounded size, and
each block gets a minimum spanning tree.  For a row c, an anchor a and its
parent p in the tree

    | <a, c> - <p, c> |  <=  |a - p| * |c|

so what is known of the row's score at the parent, exactly or as an interval,
bounds its score at the child.  Only rows whose interval meets a window of the
anchor are scored again; the others pass their wider interval on.

1. Positives: the window of an anchor is its own label, from the least of the
   best scores so far upwards.
2. Negatives: other labels; each positive has a window from a share of its
   score up to the score, whose lower end rises with the best found.

Every task scans its rows, tile by tile, for a group of blocks at a time whose
bytes are bounded (one broadcast), and emits for each window its best rows
alone; the best of all tasks are taken by rank.  Groups follow one another, so
work is rows times anchors less what the bounds save, and no join of rows with
anchors is built.

Defined results: rows without id, label or vector take no part; of rows that
repeat an id the smallest (label, vector) does; a row is no other row of its
own id; vectors of different lengths are compared as if zeros followed the
shorter; equal scores rank by smaller id; anchors without positives or
negatives give no rows.  Scores are exact integers; one that no long holds is
an error.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from strobe.llm.shared import materialise
from strobe.session import shared_dir

#: Anchors of a block, rows of a tile, and bytes of anchors of a group.
BLOCK = 1024
TILE = 2048
GROUP_BYTES = 8 << 20
#: Integers up to which sums of doubles are exact.
EXACT = float(1 << 53)


def matrix(column: pa.Array) -> np.ndarray:
    """Vectors of a list column as rows, shorter ones filled with zeros."""
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(size.max(initial=0))
    if (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), dtype=np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def widened(x: np.ndarray, width: int) -> np.ndarray:
    return x if x.shape[1] >= width else np.pad(x, ((0, 0), (0, width - x.shape[1])))


def spanning_tree(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order in which nodes join a minimum spanning tree of distances, with
    each node's parent and edge; the first is its own parent."""
    x = vectors.astype(np.float64)
    n = len(x)
    order, parent, edge = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), np.zeros(n)
    near, by = np.full(n, np.inf), np.zeros(n, dtype=np.int64)
    now = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
    parent[now] = now
    for i in range(n):
        order[i] = now
        near[now] = -np.inf
        far = np.sqrt(((x - x[now]) ** 2).sum(axis=1))
        closer = far < near
        near[closer], by[closer] = far[closer], now
        if i + 1 < n:
            now = int(np.argmin(np.where(near == -np.inf, np.inf, near)))
            parent[now], edge[now] = by[now], near[now]
    return order, parent, edge


@dataclass
class Block:
    """Anchors of a tree in an order in which parents come first, by level."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    parent: np.ndarray
    edge: np.ndarray
    #: scores of the anchors' positives, best first; None while they are sought
    goals: list[list[int]] | None = None

    def __post_init__(self):
        depth = np.zeros(len(self.ids), dtype=np.int64)
        for i in range(1, len(self.ids)):
            depth[i] = depth[self.parent[i]] + 1
        self.levels = [np.flatnonzero(depth == d) for d in range(int(depth.max(initial=0)) + 1)]
        self.most = float(np.abs(self.vectors.astype(np.float64)).max(initial=0))


class Tile:
    """Some rows, ready to be scored."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.doubles = vectors.astype(np.float64)
        self.norm = np.sqrt((self.doubles**2).sum(axis=1))
        self.most = float(np.abs(self.doubles).max(initial=0))

    def scores(self, rows: np.ndarray, anchor: np.ndarray, exact: bool) -> np.ndarray:
        if exact:
            return (self.doubles[rows] @ anchor.astype(np.float64)).astype(np.int64)
        found = self.vectors[rows].astype(object) @ anchor.astype(object)
        if any(not -(1 << 63) <= int(s) < 1 << 63 for s in found):
            raise ValueError("a score is out of the range of long")
        return found.astype(np.int64)


class Best:
    """The best (score, id) of a window, at most k."""

    def __init__(self, k: int, low: int | None = None, high: int | None = None):
        self.k, self.low, self.high = k, low, high
        self.score = np.zeros(0, dtype=np.int64)
        self.id = np.zeros(0, dtype=np.int64)

    def least(self) -> int | None:
        """The score from which a row can still come in."""
        return int(self.score[-1]) if len(self.score) == self.k else self.low

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        least = self.least()
        use = np.ones(len(score), dtype=bool) if least is None else score >= least
        if self.high is not None:
            use &= score <= self.high
        if use.any():
            s, i = np.concatenate([self.score, score[use]]), np.concatenate([self.id, ids[use]])
            order = np.lexsort((i, -s))[: self.k]
            self.score, self.id = s[order], i[order]


def scan(block: Block, windows: list[list[Best]], tile: Tile, same_label: bool) -> int:
    """Score the rows of a tile whose intervals meet an anchor's windows;
    returns how many scores that took."""
    width = max(block.vectors.shape[1], tile.doubles.shape[1])
    if tile.doubles.shape[1] < width:
        tile = Tile(tile.ids, tile.labels, widened(tile.vectors, width))
    vectors = widened(block.vectors, width)
    exact = block.most * tile.most * max(width, 1) < EXACT
    n, taken = len(tile.ids), 0
    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # intervals of the level above
    for depth, level in enumerate(block.levels):
        here: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for a in level.tolist():
            if depth:
                reach = block.edge[a] * tile.norm * (1 + 1e-9) + 1
                low, high = known[int(block.parent[a])]
                low, high = low - reach, high + reach
            else:
                low, high = np.full(n, -np.inf), np.full(n, np.inf)
            meets = np.zeros(n, dtype=bool)
            for w in windows[a]:
                least = w.least()
                m = np.ones(n, dtype=bool) if least is None else high >= least
                if w.high is not None:
                    m &= low <= w.high
                meets |= m
            meets &= ((tile.labels == block.labels[a]) == same_label) & (tile.ids != block.ids[a])
            # the root's scores are all taken, for they bound the others'
            rows = np.flatnonzero(meets) if depth or not exact else np.arange(n)
            found = tile.scores(rows, vectors[a], exact)
            taken += len(rows)
            if exact:
                low[rows] = high[rows] = found
            for w in windows[a]:
                w.add(found[meets[rows]], tile.ids[rows][meets[rows]])
            here[a] = low, high
        known = here
    return taken


def trees(rows: DataFrame, is_anchor: Column) -> DataFrame:
    """Anchors in blocks of at most BLOCK, with their place in the block's tree."""
    anchors = rows.where(is_anchor)
    parts = max(1, -(-anchors.count() // BLOCK))
    near = anchors.repartitionByRange(parts, "label", F.coalesce(F.try_element_at("vector", F.lit(1)), F.lit(0)), "id")
    schema = "block long, place int, parent int, edge double, id long, label long, vector array<long>"

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        block = (task.partitionId() if task else 0) << 32
        held = None

        def flush(batch):
            order, parent, edge = spanning_tree(matrix(batch.column("vector")))
            place = np.empty_like(order)
            place[order] = np.arange(len(order))
            taken = batch.take(pa.array(order))
            return pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(order), block)), pa.array(np.arange(len(order)), pa.int32()), pa.array(place[parent[order]], pa.int32()), pa.array(edge[order]), *(taken.column(c) for c in ("id", "label", "vector"))],
                ["block", "place", "parent", "edge", "id", "label", "vector"],
            )

        for batch in batches:
            held = batch if held is None else pa.concat_batches([held, batch])
            while held.num_rows >= BLOCK:
                yield flush(held.slice(0, BLOCK))
                block += 1
                held = held.slice(BLOCK)
        if held is not None and held.num_rows:
            yield flush(held)

    return materialise(near.select("id", "label", "vector").mapInArrow(build, schema), "anchor-trees")


def groups(built: DataFrame) -> Iterator[list[int]]:
    """Block numbers, together as many as GROUP_BYTES of anchors allow."""
    sizes = built.groupBy("block").agg(F.sum(8 * F.size("vector") + 64).alias("bytes")).orderBy("block")
    held, taken = [], 0
    for row in sizes.toLocalIterator():
        if held and taken + row.bytes > GROUP_BYTES:
            yield held
            held, taken = [], 0
        held.append(row.block)
        taken += row.bytes
    if held:
        yield held


def _blocks(rows: list) -> list[Block]:
    out = []
    for number in sorted({r.block for r in rows}):
        own = sorted((r for r in rows if r.block == number), key=lambda r: r.place)
        vectors = matrix(pa.array([r.vector for r in own], pa.list_(pa.int64())))
        goals = [list(r.goals or []) for r in own] if "goals" in own[0] else None
        out.append(Block(np.array([r.id for r in own]), np.array([r.label for r in own]), vectors, np.array([r.parent for r in own]), np.array([r.edge for r in own]), goals))
    return out


def _mined(rows: DataFrame, blocks: list[Block], k: int, share: int | None) -> DataFrame:
    """(anchor_id, goal, score, id): the best k rows of each window that each
    task has found.  share: percent of a goal from which its window starts;
    None: the windows of the positives, goal 0."""
    sent = rows.sparkSession.sparkContext.broadcast(blocks)

    def windows(block: Block) -> list[list[Best]]:
        if share is None:
            return [[Best(k)] for _ in block.ids]
        return [[Best(k, -(-share * g // 100), g) for g in goals] for goals in block.goals]

    def mine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [(b, windows(b)) for b in sent.value]
        for batch in batches:
            for at in range(0, batch.num_rows, TILE):
                part = batch.slice(at, TILE)
                tile = Tile(part.column("id").to_numpy(), part.column("label").to_numpy(), matrix(part.column("vector")))
                for block, own in found:
                    scan(block, own, tile, share is None)
        for block, own in found:
            kept = [(a, g, w) for a, ws in enumerate(own) for g, w in enumerate(ws) if len(w.score)]
            size = [len(w.score) for *_, w in kept]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(block.ids[[a for a, *_ in kept]] if kept else block.ids[:0], size)),
                    pa.array(np.repeat(np.array([g for _, g, _ in kept], dtype=np.int32), size)),
                    pa.array(np.concatenate([w.score for *_, w in kept]) if kept else np.zeros(0, dtype=np.int64)),
                    pa.array(np.concatenate([w.id for *_, w in kept]) if kept else np.zeros(0, dtype=np.int64)),
                ],
                ["anchor_id", "goal", "score", "id"],
            )

    best = rows.select("id", "label", "vector").mapInArrow(mine, "anchor_id long, goal int, score long, id long")
    place = F.row_number().over(Window.partitionBy("anchor_id", "goal").orderBy(F.desc("score"), "id"))
    return best.withColumn("rank", place).where(F.col("rank") <= k)


def mine(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 5, share: int = 80) -> DataFrame:
    """Hard negatives of (id, label, vector) rows, vectors of longs: anchor_id,
    positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are its best rows of the same label; a positive's
    negatives are the best rows of other labels whose score is between share
    percent of the positive's and the positive's.  is_anchor: condition on id.
    """
    spark = vectors.sparkSession
    part = vectors.where("id is not null and label is not null and vector is not null")
    one = part.groupBy(F.col("id").cast("long").alias("id")).agg(F.min(F.struct(F.col("label").cast("long").alias("label"), "vector")).alias("row"))
    rows = materialise(one.select("id", "row.label", "row.vector"), "vectors")
    built = trees(rows, is_anchor)

    found = shared_dir(spark, "positives")
    spark.createDataFrame([], "anchor_id long, goal int, score long, id long, rank int").write.parquet(found)
    for group in groups(built):
        blocks = _blocks(built.where(F.col("block").isin(group)).collect())
        _mined(rows, blocks, positives, None).write.mode("append").parquet(found)
    best = spark.read.parquet(found)

    goals = best.groupBy(F.col("anchor_id").alias("id")).agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "score"))), lambda x: x["score"]).alias("goals"))
    aimed = materialise(built.join(goals, "id", "left"), "anchor-goals")
    out = shared_dir(spark, "negatives")
    spark.createDataFrame([], "anchor_id long, goal int, score long, id long, rank int").write.parquet(out)
    for group in groups(aimed):
        blocks = _blocks(aimed.where(F.col("block").isin(group)).collect())
        _mined(rows, blocks, negatives, share).write.mode("append").parquet(out)
    named = best.select("anchor_id", (F.col("rank") - 1).alias("goal"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return spark.read.parquet(out).join(named, ["anchor_id", "goal"]).select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
    )
