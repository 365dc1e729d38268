"""Frame index of a capture archive, built in parallel for any cut of its streams.

A stream cannot be parsed from an arbitrary byte, but what a stretch of bytes
does to the parser is a function of the state in which it is entered, and these
functions compose.  There are two states: a marker is expected at a byte
position, in records of some size (``M``), or the next header line is awaited
from a position on (``W``).  So:

1. Streams are read in blocks of equal size, whatever the files are; an
   interval lookup from stream offsets to files (running starts, joined on
   buckets of about one file) says where a block's bytes lie.
2. Each block is scanned on its own for every position that could start a
   message, with what follows it.  The first header line, header close and line
   end of every block are scanned backwards over the blocks (last non-null
   value), so that text of any length that leaves a block ends at a known
   position: nothing looks ahead.  Such texts are read and parsed next.
3. Chains through a block make its function: where an entry leaves the block,
   for each record size of the connection.  A position that is no marker, and a
   frame that is not whole records, are rejects, after which the next header
   line is awaited; both are part of the function.
4. The functions are composed from the start of the stream by pointer doubling
   (log2 rounds of joins over a few rows a block), and every block then lists
   the messages on its true chain.  Acquisition, frame and sample numbers come
   from ordered scans.

No step holds a connection in one task; groups are blocks.  The rows are those
of the forward walk (``dumps.index_chunks``), rejects included.
"""

from __future__ import annotations

import bisect
import struct
from collections.abc import Callable, Iterator
from xml.etree.ElementTree import ParseError

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strobe.functions.frames import typed_frame
from strobe.operators.ordering import ordered_scan, position_within
from strobe.session import shared_dir
from strobe.sources.capture_format import (
    END_MARKER,
    END_REASONS,
    FRAME_MARKER,
    HEADER_CLOSE,
    HEADER_OPEN,
    READY_LINE,
)
from strobe.sources.dumps import INDEX_SCHEMA, PieceReader, concat_binary_in_order, index_chunks, materialize_index, read_header

DEFAULT_BLOCK_BYTES = 8 << 20
#: Connections up to so many bytes are walked, one task each; the walk reads
#: their headers and markers, not their payloads.
DEFAULT_WALK_BYTES = 256 << 20
#: Stream bytes of a task, about, where there are more than the session's
#: shuffle partitions take; of the blocks that one call looks at; and rows of
#: an output frame of a scan.
TASK_BYTES = 64 << 20
SPAN_BYTES = 1 << 20
FRAME_ROWS = 8192
#: Bytes read beyond a block for marks that its end cuts, and before it.
AFTER, BEFORE = 16, 1
BAD_MARKER = "bad marker"
OPEN, CLOSE = HEADER_OPEN + b"\n", b"\n" + HEADER_CLOSE + b"\n"

FOUND = (
    "conn_id long, block long, pos long, kind string, next long, wait long, stop long, cut boolean, n_bytes long, samples long, "
    "reason string, header string, layout string, process string, record long, message string, "
    "first_head long, first_close long, first_line long"
)
#: One step of a true chain.
TRUE = (
    "conn_id long, pos long, kind string, n_bytes long, samples long, reason string, header string, layout string, process string, "
    "record long, message string, is_head long"
)
REJECTS = "conn_id long, acq_no long, pos long, n_bytes long, message string"
EDGES = "conn_id long, pos long, record long, to_pos long, to_record long"


def _type(ddl: str) -> T.StructType:
    kinds = {"long": T.LongType(), "string": T.StringType(), "boolean": T.BooleanType()}
    return T.StructType([T.StructField(name, kinds[kind]) for name, kind in (x.split() for x in ddl.split(", "))])


FOUND_TYPE, TRUE_TYPE, EDGES_TYPE, REJECTS_TYPE = _type(FOUND), _type(TRUE), _type(EDGES), _type(REJECTS)

# --------------------------------------------------------------------------- where bytes lie


class Stream:
    """Byte ranges of connections and the files, or chunks in memory, that hold them."""

    def __init__(self, chunks: DataFrame, block_bytes: int):
        self.in_memory = "data" in chunks.columns
        if self.in_memory:
            chunks = chunks.withColumn("size", F.length("data").cast("long")).withColumn("path", F.lit(None).cast("string"))
        else:
            chunks = chunks.withColumn("data", F.lit(None).cast("binary"))
        chunks = chunks.where("size > 0").select("conn_id", "chunk_no", "path", "size", "data")
        self.spark = chunks.sparkSession
        self.block_bytes = block_bytes
        place = ordered_scan(chunks.select("conn_id", "chunk_no", "size"), ["conn_id"], ["chunk_no"], out="start", weight="size")
        place = place.select("conn_id", "chunk_no", "start")
        self.files = self._table(chunks.join(place, ["conn_id", "chunk_no"]), "index-files")
        self.length = self._table(chunks.groupBy("conn_id").agg(F.sum("size").alias("length")), "index-lengths")
        mean = self.files.agg(F.sum("size"), F.count(F.lit(1))).collect()[0]
        self.bucket = max(256, min(block_bytes, (mean[0] or 1) // max(1, mean[1])))
        # a block is a few numbers in a shuffle and its bytes are read behind it:
        # tasks are counted by bytes of the streams, and AQE, which would count
        # those of the shuffle, does not merge a given number
        self.tasks = max(int(self.spark.conf.get("spark.sql.shuffle.partitions")), -(-(mean[0] or 1) // TASK_BYTES))
        self.span = max(1, SPAN_BYTES // block_bytes)

    def _table(self, df: DataFrame, purpose: str) -> DataFrame:
        path = shared_dir(self.spark, purpose)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _part(self, lo, hi):
        """The bytes [lo, hi) of the file in the row."""
        a, b = F.greatest(lo, F.col("start")), F.least(hi, F.col("start") + F.col("size"))
        data = F.substring("data", (a - F.col("start") + 1).cast("int"), (b - a).cast("int")) if self.in_memory else F.lit(None).cast("binary")
        return F.struct(a.alias("at"), F.col("path").alias("path"), (a - F.col("start")).alias("start"), (b - a).alias("length"), data.alias("data"))

    def blocks(self) -> DataFrame:
        """(conn_id, block, length, parts): each block's bytes and a few around."""
        size = F.lit(self.block_bytes)
        first = F.greatest(F.lit(0), F.floor((F.col("start") - AFTER) / size)).cast("long")
        last = F.floor((F.col("start") + F.col("size")) / size).cast("long")
        spread = self.files.withColumn("block", F.explode(F.sequence(first, last))).join(self.length, "conn_id").where(F.col("block") * size < F.col("length"))
        lo, hi = F.col("block") * size - BEFORE, (F.col("block") + 1) * size + AFTER
        spread = spread.where((F.col("start") < hi) & (F.col("start") + F.col("size") > lo))
        spread = spread.select("conn_id", "block", "length", self._part(lo, hi).alias("part")).repartition(self.tasks, "conn_id", "block")
        return spread.groupBy("conn_id", "block", "length").agg(F.array_sort(F.collect_list("part")).alias("parts"))

    def spans(self, df: DataFrame) -> DataFrame:
        """Rows of blocks, dealt to tasks by runs of blocks that one call looks at."""
        return df.withColumn("span", F.floor(F.col("block") / self.span).cast("long")).repartition(self.tasks, "conn_id", "span")

    def gather(self, ranges: DataFrame) -> DataFrame:
        """Adds the parts of each [lo, hi) of (conn_id, lo, hi) rows; a row that
        has no bytes has none."""
        size = F.lit(self.bucket)
        last = F.greatest(F.col("lo"), F.col("hi") - 1)
        asked = ranges.where("lo < hi").select("conn_id", "lo", "hi").distinct()
        asked = asked.withColumn("bucket", F.explode(F.sequence(F.floor(F.col("lo") / size).cast("long"), F.floor(last / size).cast("long"))))
        held = self.files.withColumn(
            "bucket", F.explode(F.sequence(F.floor(F.col("start") / size).cast("long"), F.floor((F.col("start") + F.col("size") - 1) / size).cast("long")))
        )
        lo = F.greatest(F.col("lo"), F.col("bucket") * size)
        hi = F.least(F.col("hi"), (F.col("bucket") + 1) * size)
        met = asked.join(held, ["conn_id", "bucket"]).where((F.col("start") < hi) & (F.col("start") + F.col("size") > lo))
        # a file that several buckets hold is cut there; the cuts are joined again
        parts = met.groupBy("conn_id", "lo", "hi", "chunk_no").agg(
            F.min(F.greatest(lo, F.col("start"))).alias("a"), F.max(F.least(hi, F.col("start") + F.col("size"))).alias("b"),
            F.first("start").alias("start"), F.first("size").alias("size"), F.first("path").alias("path"), F.first("data").alias("data"),
        )
        parts = parts.select("conn_id", "lo", "hi", self._part(F.col("a"), F.col("b")).alias("part"))
        parts = parts.groupBy("conn_id", "lo", "hi").agg(F.array_sort(F.collect_list("part")).alias("parts"))
        return ranges.join(parts, ["conn_id", "lo", "hi"], "left")


def _bytes(parts, reader: PieceReader) -> bytes:
    out = []
    for p in parts if parts is not None else []:
        out.append(bytes(p["data"]) if p["data"] is not None else reader.read([p]))
    return b"".join(out)


# --------------------------------------------------------------------------- scan


def finish(kind: str, pos: int, text: bytes, after: bytes) -> dict:
    """What follows a message whose text is complete: ``text`` runs from pos
    to its last line end, ``after`` is the byte behind it."""
    stop = pos + len(text)
    if kind == "R":
        if text == READY_LINE + b"\n":
            return {"wait": stop}
        return {"wait": stop, "message": f"expected OK, got {text[:-1][:64]!r}"}
    if kind == "E":
        parts = text[4:-1].split(maxsplit=1)
        reason = parts[1].decode(errors="replace") if len(parts) == 2 else ""
        if reason not in END_REASONS or not parts[0].isdigit():
            return {"wait": stop, "message": f"bad end record {text[4:-1][:64]!r}"}
        return {"wait": stop, "samples": int(parts[0]), "reason": reason}
    try:
        header, joined, layout = read_header(text)
    except (ParseError, ValueError, TypeError) as wrong:
        return {"wait": stop, "message": f"bad header: {wrong}"}
    out = {"stop": stop, "header": joined, "layout": layout, "process": header.process, "record": header.sample_bytes}
    if not after:
        return out  # the stream ends here
    return out | ({"next": stop + 1} if after == b"\n" else {"wait": stop + 1, "message": "expected newline after header"})


def scan_block(data: bytes, base: int, lo: int, hi: int, length: int) -> list[dict]:
    """Every possible message of [lo, hi) of a stream, and a row of the first
    marks of the block.  data: the bytes from base on, a few more than that."""
    rows: list[dict] = []

    def text_to(mark: bytes, at: int, plus: int) -> int | None:
        """Where the text that ends with the mark from ``at`` on stops, if the
        mark starts in the block or the stream ends within the bytes."""
        hit = data.find(mark, at - base)
        return base + hit + plus if 0 <= hit and base + hit < hi else None

    def add(kind: str, pos: int, mark: bytes, at: int) -> None:
        stop, start = text_to(mark, at, len(mark)), max(pos, 0)
        if stop is None:
            rows.append({"pos": pos, "kind": kind, "cut": True})
        else:
            rows.append({"pos": pos, "kind": kind} | finish(kind, start, data[start - base : stop - base], data[stop - base : stop - base + 1] if stop < length else b""))

    if lo == 0:
        add("R", -1, b"\n", 0)
    at = data.find(FRAME_MARKER, lo - base)
    while 0 <= at and base + at < hi:
        pos = base + at
        if pos + 8 <= length:
            total = struct.unpack("<I", data[at + 4 : at + 8])[0]
            if total < 8:
                rows.append({"pos": pos, "kind": "B", "n_bytes": total - 8})
            elif pos + total <= length:
                rows.append({"pos": pos, "kind": "B", "next": pos + total, "n_bytes": total - 8})
            else:
                rows.append({"pos": pos, "kind": "Z"})  # the stream ends inside
        else:
            rows.append({"pos": pos, "kind": "Z"})
        at = data.find(FRAME_MARKER, at + 1)
    at = data.find(END_MARKER, lo - base)
    while 0 <= at and base + at < hi:
        add("E", base + at, b"\n", base + at + 4)
        at = data.find(END_MARKER, at + 1)
    heads = []
    at = data.find(b"\n" + OPEN, max(0, lo - base - 1))
    while 0 <= at and base + at + 1 < hi:
        if base + at + 1 >= lo:
            heads.append(base + at + 1)
            add("H", heads[-1], CLOSE, heads[-1] + len(HEADER_OPEN))
        at = data.find(b"\n" + OPEN, at + 1)

    def first(mark: bytes, from_: int) -> int | None:
        hit = data.find(mark, from_ - base)
        return base + hit if 0 <= hit and base + hit < hi else None

    rows.append({"kind": "S", "first_head": heads[0] if heads else None, "first_close": first(CLOSE, lo), "first_line": first(b"\n", lo)})
    return rows


def _scan(block_bytes: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader, out = PieceReader(), []
        for pdf in batches:
            for r in pdf.itertuples(index=False):
                lo = int(r.block) * block_bytes
                found = scan_block(_bytes(r.parts, reader), max(0, lo - BEFORE), lo, min(lo + block_bytes, int(r.length)), int(r.length))
                out += [{"conn_id": r.conn_id, "block": r.block, "cut": False} | x for x in found]
                if len(out) >= FRAME_ROWS:
                    yield typed_frame(out, FOUND_TYPE)
                    out = []
        if out:
            yield typed_frame(out, FOUND_TYPE)

    return run


def _complete(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Messages whose text leaves their block, with the text."""
    reader = PieceReader()
    for pdf in batches:
        out = []
        for r in pdf.itertuples(index=False):
            row = {"conn_id": r.conn_id, "block": r.block, "pos": r.pos, "kind": r.kind, "cut": True}
            if pd.isna(r.stop):  # the stream ends inside
                if r.kind == "H":
                    row["message"] = "stream ends inside a header"
                elif r.kind == "R":
                    row |= {"message": "expected OK, got None", "wait": int(r.length)}
                else:
                    row["kind"] = "Z"
            else:
                text, stop, start = _bytes(r.parts, reader), int(r.stop), max(0, int(r.pos))
                row |= finish(r.kind, start, text[: stop - start], text[stop - start : stop - start + 1])
            out.append(row)
        yield typed_frame(out, FOUND_TYPE)


# --------------------------------------------------------------------------- functions of blocks


class Block:
    """The candidates of a block and what lies around it."""

    def __init__(self, rows: list[dict], info: dict, block_bytes: int, whole: bool):
        self.whole = whole
        self.lo, self.length = int(info["block"]) * block_bytes, int(info["length"])
        self.hi = min(self.lo + block_bytes, self.length)
        self.next_head = None if pd.isna(info["last_first_head"]) else int(info["last_first_head"])
        self.markers = {int(r["pos"]): r for r in rows if r["kind"] in ("B", "E", "Z")}
        self.headers = {int(r["pos"]): r for r in rows if r["kind"] == "H"}
        self.root = next((r for r in rows if r["kind"] == "R"), None)
        self.heads = sorted(self.headers)

    def head_from(self, at: int) -> int | None:
        """The first header line from a position on; in this block or beyond."""
        i = bisect.bisect_left(self.heads, at)
        return self.heads[i] if i < len(self.heads) else self.next_head

    def inside(self, pos: int | None) -> bool:
        return pos is not None and (self.lo <= pos < self.hi or pos == -1 and self.lo == 0)

    def follow(self, pos: int, record: int, seen: list | None = None) -> tuple[int, int] | None:
        """Where the chain from an entry leaves the block: a marker position
        with its record size, or a header line with 0; None: it ends.  seen:
        gets the messages on the way as (kind, row, position, reject bytes)."""
        while self.inside(pos):
            wait = None
            if record:
                row = self.markers.get(pos)
                if row is None or row["kind"] == "Z":
                    if row is not None or pos + 4 > self.length:
                        return None
                    wait, wrong, at = pos + 4, BAD_MARKER, pos
                elif row["kind"] == "B":
                    n = int(row["n_bytes"])
                    if n >= 0 and (not self.whole or n % record == 0):
                        if seen is not None:
                            seen.append(("frame", row, pos, None))
                        pos = int(row["next"])
                        continue
                    wait, wrong, at = pos + 8, f"frame of {n} bytes is not whole records of {record}", pos
                else:
                    wait, wrong, at = int(row["wait"]), row["message"], pos
                    if wrong is None and seen is not None:
                        seen.append(("end", row, pos, None))
            else:
                row = self.root if pos == -1 else self.headers[pos]
                if pos >= 0 and seen is not None:
                    seen.append(("header" if row["header"] is not None else "head", row, pos, None))
                if pd.notna(row["next"]):
                    pos, record = int(row["next"]), int(row["record"])
                    continue
                at = max(pos, 0) if pd.isna(row["stop"]) else int(row["stop"])
                wrong = row["message"]
                if pd.isna(row["wait"]):
                    if wrong is not None and seen is not None:
                        seen.append(("reject", {"message": wrong}, at, self.length - at))
                    return None
                wait = int(row["wait"])
            head = self.head_from(wait)
            if wrong is not None and seen is not None:
                seen.append(("reject", {"message": wrong}, at, (self.length if head is None else head) - at))
            if head is None:
                return None
            pos, record = head, 0
        return None if pos is None or pos >= self.length else (pos, record)


def _by_block(cands: pd.DataFrame) -> dict[int, list[dict]]:
    out: dict[int, list[dict]] = {}
    for row in cands.to_dict("records"):
        out.setdefault(int(row["block"]), []).append(row)
    return out


def _edges(block_bytes: int, whole: bool):
    def run(key, cands: pd.DataFrame, info: pd.DataFrame) -> pd.DataFrame:
        rows, of = [], _by_block(cands)
        for i in info.to_dict("records"):
            block = Block(of.get(int(i["block"]), []), i, block_bytes, whole)
            asked = [(int(p), int(r)) for p in (i["entries"] if i["entries"] is not None else []) for r in (i["records"] if i["records"] is not None else [])]
            asked += [(block.heads[0], 0)] if block.heads else []
            asked += [(-1, 0)] if block.root is not None else []
            for pos, record in asked:
                to = block.follow(pos, record)
                if to is not None:
                    rows.append({"conn_id": i["conn_id"], "pos": pos, "record": record, "to_pos": to[0], "to_record": to[1]})
        return typed_frame(rows, EDGES_TYPE)

    return run


def _messages(block_bytes: int, whole: bool):
    def run(key, cands: pd.DataFrame, info: pd.DataFrame) -> pd.DataFrame:
        rows, of = [], _by_block(cands)
        for i in info.to_dict("records"):
            block, seen = Block(of.get(int(i["block"]), []), i, block_bytes, whole), []
            block.follow(int(i["at_pos"]), int(i["at_record"]), seen)
            for kind, row, pos, lost in seen:
                own = {k: row.get(k) for k in ("samples", "reason", "header", "layout", "process", "record", "message")}
                if kind == "head":  # a header that cannot be read counts, its reject follows
                    own = {}
                elif kind != "reject":
                    own["message"] = None
                rows.append(own | {"conn_id": i["conn_id"], "pos": pos, "kind": kind, "n_bytes": lost if kind == "reject" else row.get("n_bytes"), "is_head": int(kind in ("header", "head"))})
        return typed_frame(rows, TRUE_TYPE)

    return run


def _reached(edges: DataFrame, table: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Nodes (conn_id, pos, record) on the path from each stream's start.

    With J_k(x) = x's successor 2^k steps on, the path grows as S <- S u
    J_k(S); after about log2(path length) rounds it is whole.
    """
    jump = edges
    path = table(edges.where("pos = -1").select("conn_id", "pos", "record").distinct(), "index-path")
    size = path.count()
    while size:
        step = path.join(jump, ["conn_id", "pos", "record"]).select("conn_id", F.col("to_pos").alias("pos"), F.col("to_record").alias("record"))
        grown = table(path.unionByName(step).distinct(), "index-path")
        new = grown.count()
        if new == size:
            break
        on = jump.select("conn_id", F.col("pos").alias("to_pos"), F.col("record").alias("to_record"), F.col("to_pos").alias("p"), F.col("to_record").alias("r"))
        jump = table(
            jump.join(on, ["conn_id", "to_pos", "to_record"]).select("conn_id", "pos", "record", F.col("p").alias("to_pos"), F.col("r").alias("to_record")),
            "index-jump",
        )
        path, size = grown, new
    return path


def index_chunks_parallel(chunks: DataFrame, block_bytes: int | None = None, whole_frames: bool = True) -> DataFrame:
    """Index rows of a listing (conn_id, chunk_no, path, size), or of chunks in
    memory (conn_id, chunk_no, data; frames then carry their payload).
    Without ``whole_frames`` records may be split over frames."""
    spark = chunks.sparkSession
    size = block_bytes or int(spark.conf.get("strobe.index.blockBytes", str(DEFAULT_BLOCK_BYTES)))
    stream = Stream(chunks, size)
    table = stream._table
    scanned = table(stream.blocks().mapInPandas(_scan(size), FOUND), "index-candidates")

    # what the blocks after each one hold first
    firsts = scanned.where("kind = 'S'").select("conn_id", "block", "first_head", "first_close", "first_line", (-F.col("block")).alias("back"))
    around = ordered_scan(firsts, ["conn_id"], ["back"], out="n", fill=["first_head", "first_close", "first_line"]).join(stream.length, "conn_id")
    around = table(around.select("conn_id", "block", "length", "last_first_head", "last_first_close", "last_first_line"), "index-blocks")

    # texts that leave their block
    cut = scanned.where("cut").select("conn_id", "block", "pos", "kind").join(around, ["conn_id", "block"])
    stop = F.when(F.col("kind") == "H", F.col("last_first_close") + len(CLOSE)).otherwise(F.col("last_first_line") + 1)
    lo = F.greatest(F.col("pos"), F.lit(0))
    ranges = cut.withColumn("stop", stop).withColumn("lo", lo).withColumn("hi", F.coalesce(F.least(stop + 1, F.col("length")), lo))
    texts = stream.gather(ranges.select("conn_id", "block", "pos", "kind", "stop", "length", "lo", "hi")).mapInPandas(_complete, FOUND)
    cands = table(scanned.where("kind <> 'S' AND NOT coalesce(cut, false)").unionByName(texts), "index-messages")

    # functions of the blocks, composed
    records = cands.where("kind = 'H' AND next IS NOT NULL").groupBy("conn_id").agg(F.collect_set("record").alias("records"))
    beyond = (F.col("block") + 1) * F.lit(size)
    entries = cands.where(F.col("next") >= beyond).select("conn_id", "next").distinct().groupBy(
        "conn_id", F.floor(F.col("next") / size).cast("long").alias("block")
    ).agg(F.collect_list("next").alias("entries"))
    info = around.join(records, "conn_id", "left").join(entries, ["conn_id", "block"], "left")
    by_span = ["conn_id", "span"]
    spanned = stream.spans(cands).groupBy(*by_span)
    edges = stream.spans(info).groupBy(*by_span)
    edges = table(spanned.cogroup(edges).applyInPandas(_edges(size, whole_frames), EDGES), "index-edges")
    path = _reached(edges, table)
    start = F.greatest(F.col("pos"), F.lit(0))
    roots = cands.where("kind = 'R'").select("conn_id", "pos", F.lit(0).cast("long").alias("record"))
    entered = path.where("pos >= 0").unionByName(roots)  # a chain enters a block once
    entered = entered.select("conn_id", F.floor(start / size).cast("long").alias("block"), F.col("pos").alias("at_pos"), F.col("record").alias("at_record"))
    chosen = stream.spans(around.join(entered, ["conn_id", "block"]))
    true = spanned.cogroup(chosen.groupBy(*by_span)).applyInPandas(_messages(size, whole_frames), TRUE)
    return _index_rows(true, stream)


def _named(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rejects, with the bytes that are no marker in the message."""
    reader = PieceReader()
    for pdf in batches:
        rows = []
        for r in pdf.itertuples(index=False):
            wrong = f"{BAD_MARKER} {_bytes(r.parts, reader)!r}" if r.message == BAD_MARKER else r.message
            rows.append({"conn_id": r.conn_id, "acq_no": r.acq_no, "pos": r.pos, "n_bytes": r.n_bytes, "message": wrong})
        yield typed_frame(rows, REJECTS_TYPE)


def _index_rows(true: DataFrame, stream: Stream) -> DataFrame:
    """True messages -> index rows with acquisition, frame and sample counters."""
    numbered = stream._table(true, "index-true").withColumn("rank", F.when(F.col("kind") == "reject", 1).otherwise(0))
    numbered = ordered_scan(numbered, ["conn_id"], ["pos", "rank"], out="before", weight="is_head")
    numbered = stream._table(numbered.withColumn("acq_no", F.col("before") + F.col("is_head")), "index-numbered")
    heads = numbered.where("kind = 'header'").select("conn_id", "acq_no", F.col("layout").alias("own_layout"), F.col("process").alias("own_process"), F.col("record").alias("own_record"))
    frames = numbered.where("kind = 'frame'").drop("layout", "process", "record").join(heads, ["conn_id", "acq_no"])
    frames = position_within(frames, ["conn_id", "acq_no"], ["pos"], out="frame_no")
    frames = ordered_scan(frames, ["conn_id", "acq_no"], ["pos"], out="taken", weight="n_bytes")
    # a record counts in the frame where it ends
    frames = frames.withColumn("first_sample", F.expr("taken div own_record"))
    frames = frames.withColumn("n_rows", F.expr("(taken + n_bytes) div own_record - first_sample"))
    totals = frames.groupBy("conn_id", "acq_no").agg(F.sum("n_rows").alias("rows"))
    frames = stream.gather(frames.withColumn("lo", F.col("pos") + 8).withColumn("hi", F.col("pos") + 8 + F.col("n_bytes")))
    if stream.in_memory:
        data = F.transform("parts", lambda p: F.struct(p["at"].alias("start"), p["data"].alias("data")))
        pieces = F.array().cast(INDEX_SCHEMA["pieces"].dataType)
        payload = F.coalesce(concat_binary_in_order(data), F.lit("").cast("binary"))
    else:
        pieces = F.transform("parts", lambda p: F.struct(p["path"].alias("path"), p["start"].alias("start"), p["length"].alias("length")))
        payload = F.lit(None).cast("binary")

    def rows(df: DataFrame, **given) -> DataFrame:
        return df.select(*[given.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in INDEX_SCHEMA.fields])

    col = F.col
    common = {"conn_id": col("conn_id"), "acq_no": col("acq_no"), "pos": col("pos")}
    frame_rows = rows(
        frames, **common | {"pos": col("pos") + 8}, kind=F.lit("frame"), frame_no=col("frame_no"), n_bytes=col("n_bytes"), first_sample=col("first_sample"),
        n_rows=col("n_rows"), layout=col("own_layout"), process=col("own_process"), pieces=F.coalesce(pieces, F.array().cast(INDEX_SCHEMA["pieces"].dataType)), payload=payload,
    )
    header_rows = rows(numbered.where("kind = 'header'"), **common, kind=F.lit("header"), header=col("header"), layout=col("layout"), process=col("process"))
    ends = numbered.where("kind = 'end'").join(totals, ["conn_id", "acq_no"], "left")
    end_rows = rows(ends, **common, kind=F.lit("end"), samples=col("samples"), reason=col("reason"), n_rows=F.coalesce("rows", F.lit(0)))
    named = F.when(col("message") == BAD_MARKER, 4).otherwise(0)
    lost = numbered.where("kind = 'reject'").select("conn_id", "acq_no", "pos", "n_bytes", "message", col("pos").alias("lo"), (col("pos") + named).alias("hi"))
    lost = stream.gather(lost).select("conn_id", "acq_no", "pos", "n_bytes", "message", "parts").mapInPandas(_named, REJECTS)
    reject_rows = rows(lost, **common | {"acq_no": F.when(col("acq_no") > 0, col("acq_no"))}, kind=F.lit("reject"), n_bytes=col("n_bytes"), message=col("message"))
    return frame_rows.unionByName(header_rows).unionByName(end_rows).unionByName(reject_rows)


def index_archive_files(
    chunks: DataFrame, walk_bytes: int | None = None, block_bytes: int | None = None, whole_frames: bool = True
) -> DataFrame:
    """Frame index of an archive listing, or of chunks in memory.

    Connections of more than ``walk_bytes`` (``strobe.index.walkBytes``,
    default 256 MiB) are indexed in parallel over their blocks, the others are
    walked, one bounded task each; the rows are the same either way.
    """
    spark = chunks.sparkSession
    limit = int(spark.conf.get("strobe.index.walkBytes", str(DEFAULT_WALK_BYTES))) if walk_bytes is None else walk_bytes
    size = F.length("data") if "data" in chunks.columns else F.col("size")
    large = chunks.groupBy("conn_id").agg(F.sum(size).alias("bytes")).where(F.col("bytes") > limit).select("conn_id")
    if large.isEmpty():
        return index_chunks(chunks, whole_frames=whole_frames)
    parallel = materialize_index(index_chunks_parallel(chunks.join(large, "conn_id", "left_semi"), block_bytes, whole_frames))
    return parallel.unionByName(index_chunks(chunks.join(large, "conn_id", "left_anti"), whole_frames=whole_frames))
