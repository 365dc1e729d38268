"""Token counts by a compiled finite-state tokenizer.

The pieces of a BPE model are compiled into a deterministic transducer whose
transitions carry emitted-token counts, so texts are counted without building
their tokens:

1. A boundary lies between two characters that stand side by side in no piece.
   No merge crosses it, so the transducer is in its start state there whatever
   was read before.
2. Between boundaries a state holds what the tokens of any continuation depend
   on: for each end of a token from which a piece may still run on, the node in
   the trie of pieces, the token before it, and its count against the count so
   far.  A sequence of tokens is the BPE of its text exactly if every two
   neighbours are (a merge that crosses an end in the sequence also crosses it
   in the pair), so the last token of every prefix is the one piece that fits
   the last token before it.  A transition carries the change of the prefix's
   count; it is negative where a longer piece takes back tokens.
3. Transitions are compiled when a text first needs them, into sorted arrays
   that all lanes of a chunk step through together, one character a step.
4. A stretch between boundaries is entered in the start state, so its map of
   states is a constant, and maps compose by prefix sums of the counts.  Long
   stretches are cut into pieces: the map of a piece is evaluated at the state
   that its left context suggests, and the scan over the pieces evaluates it
   again at the state that the piece before it leaves, until they agree.

The text is prepared as the library does it for a model without normalisation
rules: one space before it, spaces as U+2581; characters that are no piece
count as their bytes.  Models that do otherwise are refused.

Defined results: a null or empty text has 0 bytes and 0 tokens; strings that
look like special tokens are ordinary text; a null id and rows that repeat an
id are counted each; other columns are not read.  Memory follows one chunk of
texts or one very long text, and the table of states is dropped when it is full.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strobe.llm.words import Chunk, by_chunk, mix

SPACE = 0x2581
#: Characters of a lane; longer stretches are cut into pieces of it.
LANE = 1024
#: Left context from which a piece's first state is guessed.
CONTEXT = 64
#: Compiled transitions, and known pairs of tokens, of a process; beyond it
#: the tables start anew.
TRANSITIONS = 1 << 19
NONE = -1


class Pieces:
    """Pieces and scores of a model, and its merges on short strings."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        for given, made in (("a", "▁a"), ("  ﬁ  a\t ", "▁▁ ﬁ▁▁a\t▁")):
            if model.normalize(given) != made:
                raise ValueError(f"{path}: texts are normalised in a way that is not supported")
        ids = [i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))]
        if any(model.is_unused(i) for i in ids):
            raise ValueError(f"{path}: unused pieces are not supported")
        if not any(model.is_byte(i) for i in range(model.get_piece_size())):
            raise ValueError(f"{path}: a model without bytes is not supported")
        self.score = {model.id_to_piece(i): model.get_score(i) for i in ids}

    def encode(self, symbols: list[str]) -> list[str]:
        """Merge the best pair, the leftmost of equal ones, until none is a piece."""
        symbols = list(symbols)
        while True:
            best, at = None, -1
            for i in range(len(symbols) - 1):
                score = self.score.get(symbols[i] + symbols[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return symbols
            symbols[at : at + 2] = [symbols[at] + symbols[at + 1]]


class Transducer:
    """The compiled model; transitions are added as texts need them."""

    def __init__(self, path: str):
        self.pieces = Pieces(path)
        joined = [p for p in self.pieces.score if len(p) > 1]
        letters = sorted(set("".join(joined)))
        self.classes = np.zeros(0x110000, dtype=np.int32)  # 0: characters that no piece joins to others
        self.classes[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.width = len(letters) + 1
        self.beside = np.zeros((self.width, self.width), dtype=bool)
        points = np.arange(0x110000)
        self.alone = (1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)).astype(np.int64)
        self.alone[[ord(p) for p in self.pieces.score if len(p) == 1]] = 1
        self.children: dict[tuple[int, int], int] = {}
        self.inner: set[int] = {0}
        self.token: list[int] = [NONE]
        self.texts: list[str] = []
        self.cost: list[int] = []
        at = {c: i + 1 for i, c in enumerate(letters)}
        for piece in [*letters, *joined]:
            node = 0
            for a, b in zip(piece, piece[1:]):
                self.beside[at[a], at[b]] = True
            for c in piece:
                self.inner.add(node)
                nxt = self.children.get((node, at[c]))
                if nxt is None:
                    nxt = self.children[node, at[c]] = len(self.token)
                    self.token.append(NONE)
                node = nxt
            if self.token[node] == NONE:
                self.token[node] = len(self.texts)
                self.texts.append(piece)
                self.cost.append(1 if piece in self.pieces.score else int(self.alone[ord(piece)]))
        self.clear()

    def clear(self) -> None:
        """Forget the compiled states; 0 is the start state."""
        self.states: list[tuple] = [((0, NONE, 0),)]
        self.numbers = {self.states[0]: 0}
        self.keys = np.zeros(0, dtype=np.int64)
        self.next = np.zeros(0, dtype=np.int64)
        self.count = np.zeros(0, dtype=np.int64)
        self.pairs: dict[tuple[int, int], bool] = {}

    def fits(self, last: int, token: int) -> bool:
        """Whether the two tokens, or the one alone, are the BPE of their text."""
        known = self.pairs.get((last, token))
        if known is None:
            own = [self.texts[t] for t in (last, token) if t != NONE]
            known = self.pairs[last, token] = self.pieces.encode(list("".join(own))) == own
        return known

    def step(self, state: int, letter: int) -> tuple[int, int]:
        """State after a letter, and the change of the count."""
        grown, found = [], None
        for node, last, behind in self.states[state]:
            nxt = self.children.get((node, letter))
            if nxt is None:
                continue
            if nxt in self.inner:
                grown.append((nxt, last, behind))
            token = self.token[nxt]
            if found is None and token != NONE and self.fits(last, token):
                found = (token, behind + self.cost[token])
        token, change = found
        after = (*sorted((n, t, behind - change) for n, t, behind in grown), (0, token, 0))
        number = self.numbers.get(after)
        if number is None:
            number = self.numbers[after] = len(self.states)
            self.states.append(after)
        return number, change

    def run(self, letters: np.ndarray, start: np.ndarray, length: np.ndarray, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """State and count after each lane of letters, all lanes side by side."""
        order = np.argsort(-length, kind="stable")
        start, state = start[order], state[order].copy()
        total = np.zeros(len(order), dtype=np.int64)
        left = np.searchsorted(-length[order], -np.arange(int(length.max(initial=0))), side="left")  # lanes longer than each step
        for t, n in enumerate(left.tolist()):
            key = state[:n] * self.width + letters[start[:n] + t]
            at = np.searchsorted(self.keys, key)
            missing = np.ones(n, dtype=bool) if not len(self.keys) else self.keys[np.minimum(at, len(self.keys) - 1)] != key
            if missing.any():
                new = np.unique(key[missing])
                made = np.array([self.step(*divmod(k, self.width)) for k in new.tolist()], dtype=np.int64).reshape(-1, 2)
                where = np.searchsorted(self.keys, new)
                self.keys = np.insert(self.keys, where, new)
                self.next = np.insert(self.next, where, made[:, 0])
                self.count = np.insert(self.count, where, made[:, 1])
                at = np.searchsorted(self.keys, key)
            state[:n] = self.next[at]
            total[:n] += self.count[at]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return state[back], total[back]

    def long_counts(self, letters: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Counts of stretches that are cut into pieces."""
        pieces = -(-length // LANE)
        of = np.repeat(np.arange(len(start)), pieces)
        no = np.arange(len(of)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        at = start[of] + no * LANE
        size = np.minimum(LANE, length[of] - no * LANE)
        entered = np.zeros(len(of), dtype=np.int64)
        later = np.flatnonzero(no > 0)
        entered[later] = self.run(letters, at[later] - CONTEXT, np.full(len(later), CONTEXT), np.zeros(len(later), dtype=np.int64))[0]
        left, count = self.run(letters, at, size, entered)
        while True:
            wrong = later[entered[later] != left[later - 1]]
            if not len(wrong):
                return np.bincount(of, count, minlength=len(start)).astype(np.int64)
            entered[wrong] = left[wrong - 1]
            left[wrong], count[wrong] = self.run(letters, at[wrong], size[wrong], entered[wrong])

    def chunk_counts(self, chunk: Chunk) -> np.ndarray:
        """Tokens of each text of a chunk."""
        if max(len(self.keys), len(self.pairs)) > TRANSITIONS:
            self.clear()
        points = np.frombuffer(chunk.data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        first = np.concatenate([[0], np.cumsum((chunk.data & 0xC0) != 0x80)])[chunk.bounds]
        full = np.flatnonzero(np.diff(first) > 0)
        if not len(full):
            return np.zeros(chunk.n, dtype=np.int64)
        points[points == 0x20] = SPACE
        points = np.insert(points, first[full], SPACE)
        head = first[full] + np.arange(len(full))
        letters = self.classes[points]
        opens = np.ones(len(points), dtype=bool)
        opens[1:] = ~self.beside[letters[:-1], letters[1:]]
        opens[head] = True
        start = np.flatnonzero(opens)
        length = np.diff(np.append(start, len(points)))
        count = self.alone[points[start]]  # of a stretch of one character
        many = np.flatnonzero(length > 1)
        within = np.arange(len(points)) - np.repeat(start, length)
        same = np.add.reduceat(mix((within.astype(np.uint64) << np.uint64(20)) + letters.astype(np.uint64)), start)
        _, one, lane = np.unique(same[many], return_index=True, return_inverse=True)
        one = many[one]  # equal stretches share a lane
        short = length[one] <= LANE
        found = np.zeros(len(one), dtype=np.int64)
        a, b = one[short], one[~short]
        found[short] = self.run(letters, start[a], length[a], np.zeros(len(a), dtype=np.int64))[1]
        if len(b):
            found[~short] = self.long_counts(letters, start[b], length[b])
        count[many] = found[lane]
        out = np.zeros(chunk.n, dtype=np.int64)
        out[full] = np.add.reduceat(count, np.searchsorted(start, head))
        return out


_compiled: dict[str, Transducer] = {}


def transducer(path: str) -> Transducer:
    """Transducer of a model, kept in the worker process."""
    if path not in _compiled:
        _compiled[path] = Transducer(path)
    return _compiled[path]


def count_tokens(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, n_bytes, n_tokens of every text.  model: path of a piece model
    that every worker has."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = transducer(model)
        for batch in batches:
            for part, chunk in by_chunk(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(chunk.bounds)), pa.array(compiled.chunk_counts(chunk))],
                    ["doc_id", "n_bytes", "n_tokens"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(rows, "doc_id long, n_bytes long, n_tokens long")
