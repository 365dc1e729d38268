"""Quality rules: an isolation forest over rule statistics.

``measure`` counts over whole texts; ``fit_forest`` grows random-split trees, each
on its own draw of all documents labelled good (what an isolation tree is grown
on), and calibrates the anomaly threshold on every labelled document;
``apply_rules`` and ``keep_documents`` judge every document.

Defined results: a null or empty text has no words and fails the base rules; a
null id is kept as it is; repeated rows are judged each; without labelled rows
of both kinds only the base rules reject; other columns pass through untouched.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strobe.llm.shared import materialise
from strobe.llm.words import _SPACE, Chunk, by_chunk, covered, ngrams, split_words, mix
from strobe.operators.ordering import position_within

#: Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20

#: Rows to grow a tree on, trees.
TREE_ROWS = 1024
TREES = 100
#: Share of labelled good documents that the calibrated threshold may reject.
MAX_GOOD_REJECTED = 0.002

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["symbols", "upper", "digits", "marks", "repeats", "dup_lines", "word_length", "variety"]

_IS_SYMBOL = np.isin(np.arange(256), np.frombuffer(SYMBOLS, dtype=np.uint8))
_IS_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_IS_LOWER = (np.arange(256) >= 97) & (np.arange(256) <= 122)
_IS_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_IS_MARK = (np.arange(256) > 32) & (np.arange(256) < 127) & ~_IS_UPPER & ~_IS_LOWER & ~_IS_DIGIT
_IS_CHAR = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point


def _per_doc(mask: np.ndarray, chunk: Chunk) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask, dtype=np.int64)])
    return total[chunk.bounds[1:]] - total[chunk.bounds[:-1]]


def _repeat_flags(key: np.ndarray, ok: np.ndarray) -> np.ndarray:
    """Entries whose key occurs at least twice among the allowed ones."""
    flags = np.zeros(len(key), dtype=bool)
    at = np.flatnonzero(ok)
    if len(at):
        order = at[np.argsort(key[at], kind="stable")]
        same = key[order][1:] == key[order][:-1]
        flags[order[1:][same]] = True
        flags[order[:-1][same]] = True
    return flags


def _dup_lines(chunk: Chunk) -> np.ndarray:
    raw = chunk.data.tobytes()
    out = np.zeros(chunk.n, dtype=np.int64)
    for i in range(chunk.n):
        text = raw[chunk.bounds[i] : chunk.bounds[i + 1]]
        if b"\n" in text:
            lines = [x for x in text.split(b"\n") if x and not x.isspace()]
            out[i] = len(lines) - len(set(lines))
    return out


def measure(chunk: Chunk) -> dict[str, np.ndarray]:
    """Counts and forest features of each document of a chunk."""
    words = split_words(chunk)
    n, doc = words.counts, words.doc()
    solid = ~_SPACE[chunk.data]
    salt = mix(doc.astype(np.uint64) + np.uint64(1))
    grams, ok = ngrams(words, WINDOW)
    repeated = covered(_repeat_flags(grams ^ salt, ok), WINDOW)
    count = lambda table: _per_doc(table[chunk.data], chunk)
    out = {
        "n_words": n,
        "word_chars": _per_doc(solid & _IS_CHAR[chunk.data], chunk),
        "n_symbols": count(_IS_SYMBOL),
        "n_dup_lines": _dup_lines(chunk),
        "n_repeat_words": np.bincount(doc[repeated], minlength=chunk.n),
    }
    chars = np.maximum(out["word_chars"], 1)
    many = np.maximum(n, 1)
    key = words.hash ^ salt
    distinct = np.bincount(doc[np.unique(key, return_index=True)[1]], minlength=chunk.n) if len(key) else 0 * n
    lines = np.maximum(count(np.arange(256) == 10) + 1, 1)
    out |= {
        "symbols": out["n_symbols"] / chars,
        "upper": count(_IS_UPPER) / np.maximum(count(_IS_UPPER | _IS_LOWER), 1),
        "digits": count(_IS_DIGIT) / chars,
        "marks": count(_IS_MARK) / chars,
        "repeats": out["n_repeat_words"] / many,
        "dup_lines": out["n_dup_lines"] / lines,
        "word_length": chars / many,
        # distinct words against what a text of this length usually has
        "variety": distinct / many**0.85,
    }
    return out


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > MAX_REPEAT_PERCENT * s["n_words"])


@dataclass
class Forest:
    """Isolation trees as arrays: split feature (-1: leaf), split value,
    children, and path length at a leaf; documents scoring above the threshold
    are anomalous."""

    feature: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)
    left: list[np.ndarray] = field(default_factory=list)
    length: list[np.ndarray] = field(default_factory=list)
    scale: float = 1.0
    threshold: float = float("inf")

    def score(self, x: np.ndarray) -> np.ndarray:
        """2 ** (-mean path length / expected length): 0 to 1, anomalous: high."""
        if not self.feature or not len(x):
            return np.zeros(len(x))
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, value, left, length in zip(self.feature, self.value, self.left, self.length, strict=True):
            at = np.zeros(len(x), dtype=np.int64)
            while True:
                inner = feature[at] >= 0
                if not inner.any():
                    break
                go = x[rows, np.maximum(feature[at], 0)] >= value[at]
                at = np.where(inner, left[at] + go, at)
            total += length[at]
        return 2.0 ** (-total / len(self.feature) / self.scale)


def _expected(n: int) -> float:
    """Mean path length of an unsuccessful search among n points."""
    return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + 0.5772156649) - 2 * (n - 1) / n


def grow_forest(x: np.ndarray, box: np.ndarray, trees: int = TREES, rows: int = TREE_ROWS, seed: int = 7) -> Forest:
    """Random splits uniform over a box (2 x features: low, high) that holds
    every kind of document, around the given rows: what lies where none of the
    rows is gets a short path."""
    rng = np.random.default_rng(seed)
    rows = min(rows, len(x))
    depth_limit = int(np.ceil(np.log2(max(rows, 2)))) + 4
    out = Forest(scale=max(_expected(rows), 1e-9))
    for _ in range(trees if rows >= 2 else 0):
        feature, value, left, length = [-1], [0.0], [0], [0.0]
        todo = [(0, rng.choice(len(x), rows, replace=False), 0, box)]
        while todo:
            node, own, depth, space = todo.pop()
            can = np.flatnonzero(space[1] > space[0])
            if depth >= depth_limit or len(own) < 2 or not len(can):
                length[node] = depth + _expected(len(own))
                continue
            f = int(rng.choice(can))
            cut = rng.uniform(space[0, f], space[1, f])
            feature[node], value[node], left[node] = f, cut, len(feature)
            right = x[own, f] >= cut
            for side, part in ((1, own[~right]), (0, own[right])):
                half = space.copy()
                half[side, f] = cut
                todo.append((len(feature), part, depth + 1, half))
                feature.append(-1), value.append(0.0), left.append(0), length.append(0.0)
        out.feature.append(np.array(feature))
        out.value.append(np.array(value))
        out.left.append(np.array(left))
        out.length.append(np.array(length))
    return out


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, rows: int, where=None) -> DataFrame:
    """At most ``rows`` labelled documents, the same ones at each run: the ids
    with the smallest hashes.  The id list has that bound, so it is broadcast."""
    ids = labels.select("doc_id", label).where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if where is not None:
        ids = ids.where(where)
    ids = ids.groupBy("doc_id").agg(F.min(label).cast("int").alias("_label"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id")


def _features(s: dict[str, np.ndarray]) -> np.ndarray:
    """Square roots spread the many small shares."""
    return np.sqrt(np.stack([s[f] for f in FEATURES], axis=1).astype(float))


def _measured_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, chunk in by_chunk(batch, "text"):
            s = measure(chunk)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(base_failed(s))] + [pa.array(s[f], pa.float64()) for f in FEATURES],
                ["doc_id", "failed", *FEATURES],
            )


def labelled_statistics(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, _label (1: good, 0: bad) and FEATURES of every labelled document
    that passes the base rules; only statistics are shuffled, no texts."""
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    marks = marks.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("_label"))
    schema = "doc_id long, failed boolean, " + ", ".join(f"{f} double" for f in FEATURES)
    measured = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_measured_rows, schema)
    return materialise(measured.where("not failed").drop("failed").join(marks, "doc_id"), "quality-labelled")


def fit_forest(docs: DataFrame, labels: DataFrame) -> Forest:
    """Grow and calibrate on the labelled documents that pass the base rules."""
    found = labelled_statistics(docs, labels)
    good = F.col("_label") == 1
    ends = [f(x).alias(f"{name}_{x}") for name, f in (("least", F.min), ("most", F.max)) for x in FEATURES]
    all_of = found.agg(F.count(F.lit(1)).alias("n"), F.count(F.when(good, 1)).alias("n_good"), *ends).collect()[0]
    if not all_of.n:
        return Forest()
    # what the trees draw from: all good rows, or enough for each tree to have its own
    most = max(1, -(-all_of.n_good // (TREES * TREE_ROWS)))
    drawn = found.where(good & (F.pmod(F.xxhash64("doc_id", *FEATURES), F.lit(most)) == 0)).select("doc_id", *FEATURES)
    drawn = drawn.toPandas().sort_values(["doc_id", *FEATURES])
    box = _features({x: np.array([all_of[f"least_{x}"], all_of[f"most_{x}"]]) for x in FEATURES})
    forest = grow_forest(_features({x: drawn[x].to_numpy() for x in FEATURES}), box)
    if 0 < all_of.n_good < all_of.n:
        forest.threshold = calibrate(found, forest, all_of.n_good)
    return forest


def calibrate(found: DataFrame, forest: Forest, n_good: int, max_good_rejected: float = MAX_GOOD_REJECTED) -> float:
    """The highest threshold that rejects most labelled bad rows among those
    that reject at most the allowed share of the good ones; infinite if no bad
    row scores so high.  Exact over all rows: the score at that place in the
    order of the good ones, and the smallest one of the bad ones above it."""
    model = found.sparkSession.sparkContext.broadcast(forest)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _features({f: batch.column(f).to_numpy() for f in FEATURES})
            score = model.value.score(x) if len(x) else np.zeros(0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("_label"), pa.array(score, pa.float64())], ["doc_id", "_label", "score"])

    scored = materialise(found.mapInArrow(rows, "doc_id long, _label int, score double"), "quality-scores")
    own = position_within(scored.where("_label = 1").withColumn("all", F.lit(0)), ["all"], ["score", "doc_id"], out="at")
    least = own.where(F.col("at") == n_good - 1 - int(max_good_rejected * n_good)).first().score
    bad = scored.where((F.col("_label") != 1) & (F.col("score") > least)).agg(F.min("score")).first()[0]
    return float("inf") if bad is None else float(bad)


def judge(chunk: Chunk, forest: Forest) -> dict[str, np.ndarray]:
    s = measure(chunk)
    s["base_failed"] = base_failed(s)
    s["score"] = forest.score(_features(s))
    s["kept"] = ~s["base_failed"] & (s["score"] < forest.threshold)
    return s


def apply_rules(docs: DataFrame, forest: Forest) -> DataFrame:
    """Statistics and verdict of every document; no shuffle."""
    model = docs.sparkSession.sparkContext.broadcast(forest)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, chunk in by_chunk(batch, "text"):
                s = judge(chunk, model.value)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id")]
                    + [pa.array(s[c], pa.int64()) for c in COUNTS]
                    + [pa.array(s["base_failed"]), pa.array(s["kept"]), pa.array(s["score"], pa.float64())],
                    ["doc_id", *COUNTS, "base_failed", "kept", "anomaly"],
                )

    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, kept boolean, anomaly double"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, schema)


def keep_documents(docs: DataFrame, forest: Forest) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(forest)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, chunk in by_chunk(batch, "text"):
                yield part.filter(pa.array(judge(chunk, model.value)["kept"]))

    return docs.mapInArrow(rows, docs.schema)
