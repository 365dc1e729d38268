"""Toxicity: a factorization machine over hashed terms.

A document is the set of its hashed lower-case terms and their stems.  Besides a weight, each
term has a vector, and the inner products of the vectors of terms that stand
in one document add to its score: an insult beside a group mention can score
where neither does alone.

Defined results: a null or empty text has no terms and scores the bias; ties
and repeated rows score alike; with no labelled rows every score is that of
the prior; ids, languages, sources and labels are never inputs of a score.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strobe.llm.quality_rules import labelled_sample
from strobe.llm.words import TERM_BREAKS, Chunk, by_chunk, split_words

SLOTS = 1 << 20
#: Besides whole terms, their first bytes: inflected forms share these.
STEMS = (4, 5)
FACTORS = 6
#: Bound of the labelled rows that the machine is fitted on.
LABELLED_ROWS = 12000
#: Labelled documents that must hold a term before it gets parameters.
MIN_DOCUMENTS = 3
MIN_SHARE = 0.002
#: Each step draws parameters towards zero, so that terms which tell nothing
#: end without any.
SHRINK = 0.25
#: Weight of a toxic document in the loss; they are the fewer.
TOXIC_WEIGHT = 2.0
#: Passes over the sample; more over a small one, for that many steps.
EPOCHS = 5
LEAST_STEPS = 250
BATCH = 256
RATE = 0.5
#: Terms whose learned parameters stay below this have none: noise of
#: thousands of neutral terms does not add up in long texts.
LEAST = 0.08


def term_slots(chunk: Chunk, active: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (document, slot) pairs of a chunk, in order; active: only the
    slots set there."""
    words = split_words(chunk, lower=True, breaks=TERM_BREAKS)
    doc = words.doc()
    stems = [words.prefix(size) for size in STEMS]
    slot = np.concatenate([words.hash, *(h for h, _ in stems)])
    slot = (slot & np.uint64(SLOTS - 1)).astype(np.int64)
    doc = np.concatenate([doc, *(doc[at] for _, at in stems)])
    if active is not None:
        use = active[slot]
        slot, doc = slot[use], doc[use]
    pair = np.unique(doc * SLOTS + slot)
    return pair // SLOTS, pair % SLOTS


@dataclass
class Machine:
    """Parameters of the slots that have any; slots: their sorted numbers."""

    bias: float
    slots: np.ndarray
    weight: np.ndarray
    vector: np.ndarray
    scale: float = 1.0
    shift: float = 0.0

    def active(self) -> np.ndarray:
        out = np.zeros(SLOTS, dtype=bool)
        out[self.slots] = True
        return out

    def score(self, doc: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        """Calibrated scores from 0 to 1 of n documents."""
        return 1.0 / (1.0 + np.exp(-np.clip(self.scale * self.margin(doc, slot, n) + self.shift, -40, 40)))

    def margin(self, doc: np.ndarray, slot: np.ndarray, n: int) -> np.ndarray:
        at = np.searchsorted(self.slots, slot)
        linear = np.bincount(doc, self.weight[at], minlength=n)
        pairs = np.zeros(n)
        for f in range(self.vector.shape[1]):
            v = self.vector[at, f]
            pairs += np.bincount(doc, v, minlength=n) ** 2 - np.bincount(doc, v * v, minlength=n)
        return self.bias + linear + pairs / 2


def fit(every: np.ndarray, counts: np.ndarray, label: np.ndarray, seed: int = 11) -> Machine:
    """Logistic loss by adaptive gradient steps over mini-batches.

    every: slots of all documents, one after the other; counts: how many each
    document has.  Every fifth document is left to calibrate the scores on."""
    none = Machine(-4.0, np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros((0, FACTORS)))
    if not len(label) or label.all() or not label.any():
        if len(label):
            none.bias = 4.0 if label.all() else -4.0
        return none
    held = np.bincount(every, minlength=SLOTS)
    use = (held >= max(MIN_DOCUMENTS, MIN_SHARE * len(label))) & (held <= 0.5 * len(label))
    slots = np.flatnonzero(use)
    known = use[every]
    owner = np.repeat(np.arange(len(label), dtype=np.int32), counts)
    number = np.cumsum(use, dtype=np.int32) - np.int32(1)
    every = number[every[known]]
    rows = np.split(every, np.cumsum(np.bincount(owner[known], minlength=len(label)))[:-1])
    test = np.arange(len(label)) % 5 == 4
    learn = np.flatnonzero(~test)
    del every, owner, known, held
    rng = np.random.default_rng(seed)
    bias, gb = float(np.log(label.mean() / (1 - label.mean()))), 1.0
    w, v = np.zeros(len(slots)), rng.normal(0, 0.02, (len(slots), FACTORS))
    gw, gv = np.full(len(slots), 1.0), np.full((len(slots), FACTORS), 1.0)
    decay = 1e-4
    for _ in range(max(EPOCHS, LEAST_STEPS * BATCH // len(learn))):
        order = rng.permutation(learn)
        for at in range(0, len(order), BATCH):
            own = order[at : at + BATCH]
            counts = np.array([len(rows[i]) for i in own])
            idx = np.concatenate([rows[i] for i in own])
            doc = np.repeat(np.arange(len(own)), counts)
            total = np.zeros((len(own), FACTORS))
            va = v[idx]
            for f in range(FACTORS):
                total[:, f] = np.bincount(doc, va[:, f], minlength=len(own))
            square = np.bincount(doc, (va * va).sum(1), minlength=len(own))
            z = bias + np.bincount(doc, w[idx], minlength=len(own)) + ((total**2).sum(1) - square) / 2
            err = (1 / (1 + np.exp(-np.clip(z, -40, 40))) - label[own]) * np.where(label[own] > 0, TOXIC_WEIGHT, 1.0)
            e = err[doc]
            use, inv = np.unique(idx, return_inverse=True)
            g = np.bincount(inv, e, minlength=len(use)) + decay * BATCH * w[use]
            gw[use] += g * g
            step = RATE / np.sqrt(gw[use])
            stepped = w[use] - step * g
            w[use] = np.sign(stepped) * np.maximum(np.abs(stepped) - SHRINK * step, 0)
            for f in range(FACTORS):
                g = np.bincount(inv, e * (total[doc, f] - va[:, f]), minlength=len(use)) + 10 * decay * BATCH * v[use, f]
                gv[use, f] += g * g
                step = 0.3 * RATE / np.sqrt(gv[use, f])
                stepped = v[use, f] - step * g
                v[use, f] = np.sign(stepped) * np.maximum(np.abs(stepped) - SHRINK * step, 0)
            gb += err.sum() ** 2
            bias -= RATE * err.sum() / np.sqrt(gb)
    keep = (np.abs(w) >= LEAST) | (np.abs(v).max(1) >= LEAST)
    out = Machine(bias, slots[keep], w[keep], v[keep])
    number = np.cumsum(keep) - 1
    held = [number[rows[i][keep[rows[i]]]] for i in np.flatnonzero(test)]
    doc = np.repeat(np.arange(len(held)), [len(x) for x in held])
    margin = out.margin(doc, out.slots[np.concatenate(held)] if held else doc, len(held))
    out.scale, out.shift = calibrate(margin, label[test])
    return out


def calibrate(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Scale and shift of the margins by a logistic fit (Newton steps, a weak
    prior on scale 1 and shift 0); these without both kinds of rows."""
    if not label.any() or label.all():
        return 1.0, 0.0
    x, prior = np.stack([margin, np.ones(len(margin))], axis=1), np.array([1.0, 0.0])
    at = prior.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -30, 30)))
        slope = x.T @ (p - label) + 0.05 * (at - prior)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 0.05 * np.eye(2), slope)
        at = at - step / max(1.0, np.abs(step).max() / 2)
    return (float(at[0]), float(at[1])) if at[0] > 0 else (1.0, 0.0)


def _sample_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, chunk in by_chunk(batch, "text"):
            doc, slot = term_slots(chunk)
            offsets = np.searchsorted(doc, np.arange(chunk.n + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("_label"), pa.ListArray.from_arrays(pa.array(offsets), pa.array(slot.astype(np.int32)))],
                ["doc_id", "_label", "slots"],
            )


def fit_machine(docs: DataFrame, labels: DataFrame, train: Column, rows: int = LABELLED_ROWS) -> Machine:
    """Fit on at most ``rows`` labelled documents for which ``train`` holds."""
    sample = labelled_sample(docs, labels, "toxic", rows, train).mapInArrow(_sample_rows, "doc_id long, _label int, slots array<int>")
    found = sample.toArrow().combine_chunks()
    ids, slots = found.column("doc_id").to_numpy(), found.column("slots").combine_chunks()
    counts = np.diff(slots.offsets.to_numpy())
    order = np.lexsort((counts, ids))
    every, start = slots.flatten().to_numpy(), np.cumsum(counts) - counts
    every = every[np.repeat(start[order] - np.cumsum(counts[order]) + counts[order], counts[order]) + np.arange(len(every))]
    return fit(every, counts[order], (found.column("_label").to_numpy() == 1).astype(float)[order])


def score_documents(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id and score of every document; no shuffle."""
    model = docs.sparkSession.sparkContext.broadcast(machine)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        active = model.value.active()
        for batch in batches:
            for part, chunk in by_chunk(batch, "text"):
                score = model.value.score(*term_slots(chunk, active), chunk.n)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(score, pa.float64())], ["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, score double")
