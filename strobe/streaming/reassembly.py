"""Streaming reassembly and decode of capture streams (Structured Streaming).

Chunks of a connection's byte stream arrive as rows in micro-batches, numbered
(conn_id, chunk_no, data) or placed by their byte position (conn_id, start,
data). A ``transformWithState`` processor per connection keeps what a frame
boundary has not yet released -- pending bytes (less than one message), the
current header's layout and counters -- as a value state, and chunks that
arrived before their turn in a map state, one entry each. Complete frames are
emitted in append mode as index rows with their payload; decoding them is a
stateless step on the output.

* rows do not depend on how the stream was cut, batched or ordered (ST1, ST2);
* a chunk that is missing for longer than ``retention_ms`` is given up by a
  timer: its gap is a reject, and the stream goes on behind it at the next
  header. Within that time nothing is given up, however many chunks wait (they
  lie in the state store, not in memory); a chunk that arrives after its gap
  was given up is emitted as a ``late`` row with its bytes, so none is lost.
  What was given up is remembered for ``remember_ms`` (a TTL of the state);
* a connection silent for longer than ``idle_timeout_ms`` emits an ``idle``
  row (processing-time timer; ST3) and keeps its state;
* ``max_acquisitions`` stops emitting after that many acquisitions (ST6).
"""

from __future__ import annotations

import itertools
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from strobe.functions.frames import typed_frame
from strobe.sources.capture_format import (
    END_MARKER,
    END_REASONS,
    FRAME_MARKER,
    HEADER_CLOSE,
    HEADER_OPEN,
    READY_LINE,
    fields_to_json,
    parse_header,
)

OUTPUT_SCHEMA = T.StructType(
    [
        T.StructField("conn_id", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("acq_no", T.LongType()),
        T.StructField("frame_no", T.LongType()),
        T.StructField("first_sample", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("layout", T.StringType()),
        T.StructField("process", T.StringType()),
        T.StructField("header", T.StringType()),
        T.StructField("samples", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("payload", T.BinaryType()),
    ]
)

STATE_SCHEMA = T.StructType(
    [
        T.StructField("phase", T.StringType()),
        T.StructField("pending", T.BinaryType()),
        T.StructField("header", T.StringType()),
        T.StructField("layout", T.StringType()),
        T.StructField("process", T.StringType()),
        T.StructField("record", T.LongType()),
        T.StructField("acq_no", T.LongType()),
        T.StructField("frame_no", T.LongType()),
        T.StructField("samples", T.LongType()),
        T.StructField("next", T.LongType()),  # chunk, or byte, whose turn it is
        T.StructField("waiting", T.LongType()),  # chunks in the map state
        T.StructField("gap_at", T.LongType()),  # when the gap before them is given up
        T.StructField("gap_next", T.LongType()),
        T.StructField("idle_at", T.LongType()),
    ]
)


class PushParser:
    """Incremental parser: ``feed(bytes)`` returns the messages completed so far.

    ``feed`` scans one buffer by position and cuts it once at the end, so a
    feed is linear in its bytes. What cannot be read as a message becomes a
    reject, and the parser goes on at the next ``<header>`` line; the reject
    is reported there, with the bytes that were passed over. After
    ``max_acquisitions`` nothing more is kept.
    """

    def __init__(self, state: dict | None = None, max_acquisitions: int = 0):
        s = state or {}
        self.phase = s.get("phase") or "ready"
        self.parts = [bytes(s["pending"])] if s.get("pending") else []
        self.size = sum(map(len, self.parts))
        self.need = 0  # bytes that the open message has at least
        self.searched = 0  # of them, those known not to end it
        self.header = s.get("header") or ""
        self.layout = s.get("layout")
        self.process = s.get("process")
        self.record = int(s.get("record") or 0)
        self.acq_no = int(s.get("acq_no") or 0)
        self.frame_no = int(s.get("frame_no") or 0)
        self.samples = int(s.get("samples") or 0)
        self.max_acq = max_acquisitions

    @property
    def pending(self) -> bytes:
        """Bytes of the message that is not complete."""
        if len(self.parts) > 1:
            self.parts = [b"".join(self.parts)]
        return self.parts[0] if self.parts else b""

    def drop_pending(self) -> None:
        self.parts, self.size, self.need, self.searched = [], 0, 0, 0

    def state(self) -> dict:
        return {
            "phase": self.phase, "pending": self.pending, "header": self.header, "layout": self.layout,
            "process": self.process, "record": self.record, "acq_no": self.acq_no,
            "frame_no": self.frame_no, "samples": self.samples,
        }

    def feed(self, data: bytes) -> list[dict]:
        if self.phase == "stopped":
            self.drop_pending()
            return []
        self.parts.append(bytes(data))
        self.size += len(data)
        if self.size < self.need:  # the open message cannot be complete yet
            return []
        buf = self.pending
        out: list[dict] = []
        at, self.need = 0, 0
        while self.phase != "stopped":
            to = getattr(self, "_" + self.phase)(buf, at, out)
            if to is None:
                break
            at, self.searched = to, 0
        if self.phase == "stopped":
            self.drop_pending()
        else:
            self.parts = [buf[at:]] if at < len(buf) else []
            self.size = len(buf) - at
            self.need = max(0, self.need - at)
        return out

    def _reject(self, out: list[dict], message: str) -> None:
        out.append({"kind": "reject", "acq_no": self.acq_no, "message": message})
        self.phase = "seek"

    # Each phase looks at buf from ``at`` on and returns where the next one
    # starts, or None while its message is not complete.

    def _ready(self, buf: bytes, at: int, out: list[dict]) -> int | None:
        cut = buf.find(b"\n", at)
        if cut < 0:
            return None
        self.phase = "seek"
        if buf[at:cut] != READY_LINE:
            self._reject(out, f"expected OK, got {buf[at:cut]!r}")
        return cut + 1

    def _seek(self, buf: bytes, at: int, out: list[dict]) -> int | None:
        """Pass over lines up to the next header's first one."""
        mark = HEADER_OPEN + b"\n"
        if buf.startswith(mark, at):
            self.phase = "head"
            return at
        hit = buf.find(b"\n" + mark, at)
        if hit >= 0:
            self.phase = "head"
            return hit + 1
        # whole lines are done with; the last, open one may become a header's
        last = buf.rfind(b"\n", at)
        if last >= at:
            return last + 1
        if mark.startswith(buf[at:]) or len(buf) - at < 2:
            return None
        return len(buf) - 1  # the open line is none; its last byte stands for it

    def _head(self, buf: bytes, at: int, out: list[dict]) -> int | None:
        mark = b"\n" + HEADER_CLOSE + b"\n"
        close = buf.find(mark, at + self.searched)
        end = close + len(mark)
        if close < 0 or len(buf) <= end:
            # what has been searched is not searched again
            self.searched = max(0, (len(buf) if close < 0 else close) - at - len(mark) + (close >= 0))
            return None
        self.acq_no += 1
        self.header = buf[at:end].replace(b"\n", b"").decode(errors="replace")
        try:
            h = parse_header(self.header)
        except Exception as exc:  # noqa: BLE001 - any malformed header is a reject
            self._reject(out, f"bad header: {exc}")
            return end
        self.layout, self.process, self.record = fields_to_json(h.fields), h.process, h.sample_bytes
        self.frame_no, self.samples, self.phase = 0, 0, "data"
        out.append({"kind": "header", "acq_no": self.acq_no, "header": self.header, "layout": self.layout, "process": self.process})
        if buf[end : end + 1] != b"\n":
            self._reject(out, "expected newline after header")
            return end
        return end + 1

    def _data(self, buf: bytes, at: int, out: list[dict]) -> int | None:
        marker = buf[at : at + 4]
        if len(marker) < 4:
            return None
        if marker == FRAME_MARKER:
            if len(buf) < at + 8:
                return None
            total = struct.unpack_from("<I", buf, at + 4)[0]
            if total < 8 or self.record <= 0 or (total - 8) % self.record:
                self._reject(out, f"frame of {total - 8} bytes is not whole records of {self.record}")
                return at + 8
            if len(buf) < at + total:
                self.need = at + total
                return None
            n = (total - 8) // self.record
            out.append({
                "kind": "frame", "acq_no": self.acq_no, "frame_no": self.frame_no, "first_sample": self.samples, "n_rows": n,
                "layout": self.layout, "process": self.process, "payload": buf[at + 8 : at + total],
            })
            self.frame_no, self.samples = self.frame_no + 1, self.samples + n
            return at + total
        if marker != END_MARKER:
            self._reject(out, f"bad marker {marker!r}")
            return at + 4
        cut = buf.find(b"\n", at)
        if cut < 0:
            return None
        count, _, reason = buf[at + 4 : cut].partition(b" ")
        if not count.isdigit() or reason.decode(errors="replace") not in END_REASONS:
            self._reject(out, f"bad end record {buf[at + 4 : cut]!r}")
            return cut + 1
        out.append({"kind": "end", "acq_no": self.acq_no, "samples": int(count), "reason": reason.decode(), "n_rows": self.samples})
        self.phase = "stopped" if self.max_acq and self.acq_no >= self.max_acq else "seek"
        return cut + 1


def _frame(rows: list[dict]) -> pd.DataFrame:
    return typed_frame(rows, OUTPUT_SCHEMA)


def _frames(rows: Iterator[dict]) -> Iterator[pd.DataFrame]:
    """Output frames of bounded size, made while the rows come."""
    out: list[dict] = []
    size = 0
    for r in rows:
        out.append(r)
        size += ROW_BYTES + sum(len(r.get(x) or b"") for x in ("payload", "layout", "header"))
        if size >= OUTPUT_BYTES:
            yield _frame(out)
            out, size = [], 0
    if out:
        yield _frame(out)


#: Bytes of the rows of one output frame, about; bytes that a row takes besides
#: its texts and payload; bytes of a batch of chunks handed to the parser.
OUTPUT_BYTES = 16 << 20
ROW_BYTES = 1 << 10
INPUT_BYTES = 8 << 20
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
DEFAULT_RETENTION_MS = 10 * 60 * 1000
DEFAULT_REMEMBER_MS = 24 * 60 * 60 * 1000


class Reassembler(StatefulProcessor):
    """Keyed by connection; see the module's description."""

    def __init__(self, by_position: bool, max_acquisitions: int, idle_timeout_ms: int, retention_ms: int, remember_ms: int, watch: bool = True):
        self.by_position = by_position
        self.watch = watch
        self.max_acquisitions = max_acquisitions
        self.idle_timeout_ms = idle_timeout_ms
        self.retention_ms = retention_ms
        self.remember_ms = remember_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.parser = handle.getValueState("parser", STATE_SCHEMA)
        self.early = handle.getMapState("early", "at long", "data binary")
        # a TTL needs a clock, as timers do
        self.given_up = handle.getMapState("given_up", "first long", "next long", self.remember_ms if self.watch else None)

    def close(self) -> None:
        pass

    def _load(self) -> dict:
        return dict(zip(STATE_SCHEMA.names, self.parser.get(), strict=True)) if self.parser.exists() else {}

    def _store(self, st: dict) -> None:
        self.parser.update(tuple(st.get(n) for n in STATE_SCHEMA.names))

    def _late(self, at: int) -> bool:
        """Whether a chunk lies in a gap that was given up; else it is a copy."""
        return any(int(first[0]) <= at < int(self.given_up.getValue(first)[0]) for first in list(self.given_up.keys()))

    def _unit(self, data: bytes) -> int:
        return len(data) if self.by_position else 1

    def _feed(self, st: dict, parser: PushParser, data: bytes, conn_id: int) -> list[dict]:
        st["next"] = int(st.get("next") or 0) + self._unit(data)
        return [{"conn_id": conn_id, **r} for r in parser.feed(data)]

    def _drain(self, st: dict, parser: PushParser, conn_id: int) -> Iterator[dict]:
        """Chunks that waited and whose turn it is."""
        while st.get("waiting") and self.early.containsKey((st["next"],)):
            key = (st["next"],)
            data = bytes(self.early.getValue(key)[0])
            self.early.removeKey(key)
            st["waiting"] -= 1
            yield from self._feed(st, parser, data, conn_id)

    def _watch_gap(self, st: dict, now: int) -> None:
        """The timer of the gap in front of the waiting chunks."""
        if not self.watch:
            return
        if not st.get("waiting"):
            st["gap_at"] = None
        elif st.get("gap_at") is None or st.get("gap_next") != st["next"]:
            st["gap_at"], st["gap_next"] = now + self.retention_ms, st["next"]
            self.handle.registerTimer(st["gap_at"])

    def _watch_idle(self, st: dict, now: int) -> None:
        if self.idle_timeout_ms and self.watch:
            if st.get("idle_at"):
                self.handle.deleteTimer(st["idle_at"])
            st["idle_at"] = now + self.idle_timeout_ms
            self.handle.registerTimer(st["idle_at"])

    def _fed(self, st: dict, parser: PushParser, conn_id: int, rows: Iterator[pd.DataFrame]) -> Iterator[dict]:
        """What the chunks complete, and those that waited for them."""
        for pdf in rows:
            for at, data in zip(pdf["start" if self.by_position else "chunk_no"], pdf["data"], strict=True):
                at, data = int(at), bytes(data)
                if parser.phase == "stopped" or not data and self.by_position:
                    continue
                if at == st["next"]:
                    yield from self._feed(st, parser, data, conn_id)
                    yield from self._drain(st, parser, conn_id)
                elif at > st["next"]:
                    if not self.early.containsKey((at,)):
                        st["waiting"] += 1
                        self.early.updateValue((at,), (data,))
                elif self._late(at):
                    yield {"conn_id": conn_id, "kind": "late", "acq_no": parser.acq_no, "payload": data,
                           "message": f"chunk {at} arrived after its gap was given up"}

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        conn_id, st = int(key[0]), self._load()
        now = timerValues.getCurrentProcessingTimeInMs() if self.watch else 0
        parser = PushParser(st, self.max_acquisitions)
        st["next"] = int(st.get("next") or 0)
        st["waiting"] = int(st.get("waiting") or 0)
        yield from _frames(self._fed(st, parser, conn_id, rows))
        if parser.phase == "stopped" and st["waiting"]:
            self.early.clear()
            st["waiting"] = 0
        st |= parser.state()
        self._watch_gap(st, now)
        self._watch_idle(st, now)
        self._store(st)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        conn_id, st = int(key[0]), self._load()
        now, at = timerValues.getCurrentProcessingTimeInMs(), expiredTimerInfo.getExpiryTimeInMs()
        if st.get("waiting") and st.get("gap_at") == at:
            parser = PushParser(st, self.max_acquisitions)
            found = min(int(k[0]) for k in self.early.keys())
            gap = {"conn_id": conn_id, "kind": "reject", "acq_no": parser.acq_no,
                   "message": f"{'bytes' if self.by_position else 'chunks'} {st['next']} to {found - 1} are missing"}
            self.given_up.updateValue((st["next"],), (found,))
            # what is pending continues in the gap; a new line may start a header
            parser.phase, st["next"] = "seek", found
            parser.drop_pending()
            yield from _frames(itertools.chain([gap], self._drain(st, parser, conn_id)))
            st |= parser.state()
            self._watch_gap(st, now)
        elif st.get("idle_at") == at:
            # the connection may go on: its state stays, and the timer runs again
            yield _frame([{"conn_id": conn_id, "kind": "idle", "acq_no": st.get("acq_no"), "message": f"no data for {self.idle_timeout_ms} ms"}])
            st["idle_at"] = None
            self._watch_idle(st, now)
        self._store(st)


def reassemble_stream(
    chunks: DataFrame,
    max_acquisitions: int = 0,
    idle_timeout_ms: int = 0,
    retention_ms: int = DEFAULT_RETENTION_MS,
    remember_ms: int = DEFAULT_REMEMBER_MS,
    watch: bool = True,
) -> DataFrame:
    """Streaming chunks (conn_id, chunk_no, data) or (conn_id, start, data) ->
    index rows with payloads. The state store has to be RocksDB, which is set
    where the session names none. ``watch``: run timers for gaps and silence; a
    query that watches runs on for them, so one that is to end by itself
    (``availableNow``) does not watch, and early chunks wait in its state."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    spark = chunks.sparkSession
    if not spark.conf.get(provider, None):
        spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    # the worker holds a batch several times
    spark.conf.set(BATCH_CONF, str(INPUT_BYTES))
    by_position = "start" in chunks.columns
    processor = Reassembler(by_position, max_acquisitions, idle_timeout_ms, retention_ms, remember_ms, watch)
    return chunks.select("conn_id", "start" if by_position else "chunk_no", "data").groupBy("conn_id").transformWithStateInPandas(
        processor, OUTPUT_SCHEMA, "Append", "ProcessingTime" if watch else "None"
    )


def decode_stream(index_rows: DataFrame, fields, process: str, calibrated: bool = True) -> DataFrame:
    """Stateless decode of streamed frame rows for one known layout."""
    from strobe.operators.calibrate import calibrate
    from strobe.sources.captures import decode_payloads

    frames = index_rows.where(F.col("kind") == "frame").select(
        "conn_id", "acq_no", "frame_no", "process", "first_sample", "payload"
    )
    dec = decode_payloads(frames, fields, keep=["conn_id", "acq_no", "frame_no", "process"])
    return calibrate(dec, fields, process) if calibrated else dec
