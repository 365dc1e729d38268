"""Capture archives on shared storage, and the frame index over them.

Archive layout: ``<root>/conn=<id>/chunk-<n>.bin`` -- each connection's byte
stream cut into ordered chunk files at arbitrary byte positions.

A stream is not splittable from an arbitrary byte (markers are not unique
bytes). This module's index is a forward walk per connection that reads only
header lines, 8-byte frame prefixes and end lines, seeking over payloads;
``parallel_index`` builds the same index in parallel over blocks of large
connections, however they are cut into files. The *frame index* says where each frame's payload lies,
with its acquisition, sample base and record layout; decoding then reads
payload byte ranges in parallel over the index, independent of how the stream
was chunked.
"""

from __future__ import annotations

import bisect
import itertools
import struct
from collections.abc import Iterator
from xml.etree.ElementTree import ParseError

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strobe.operators.ordering import ordered_scan
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


def concat_binary_in_order(items: Column, value: str = "data") -> Column:
    """Concatenate the binary ``value`` of a sorted array of structs, linearly."""
    return F.unhex(F.array_join(F.transform(items, lambda x: F.hex(x[value])), ""))


PIECE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
    ]
)

INDEX_SCHEMA = T.StructType(
    [
        T.StructField("conn_id", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("acq_no", T.LongType()),
        T.StructField("frame_no", T.LongType()),
        T.StructField("pos", T.LongType()),
        T.StructField("n_bytes", T.LongType()),
        T.StructField("first_sample", T.LongType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("header", T.StringType()),
        T.StructField("layout", T.StringType()),
        T.StructField("process", T.StringType()),
        T.StructField("samples", T.LongType()),
        T.StructField("reason", T.StringType()),
        T.StructField("message", T.StringType()),
        T.StructField("pieces", T.ArrayType(PIECE)),
        T.StructField("payload", T.BinaryType()),
    ]
)


def _filesystem(path: str):
    from pyarrow import fs

    if path.startswith("file:"):
        local = path[len("file:"):]
        while local.startswith("//"):
            local = local[1:]
        return fs.LocalFileSystem(), local
    if "://" in path:
        filesystem, inner = fs.FileSystem.from_uri(path)
        return filesystem, inner
    return fs.LocalFileSystem(), path


# --------------------------------------------------------------------------- write


def write_chunks(chunks: DataFrame, root: str) -> DataFrame:
    """Write each (conn_id, chunk_no, data) row as one chunk file.

    Each file is written under a temporary name and moved into place, so a
    retried or speculative task never leaves a torn chunk. Returns the
    listing (conn_id, chunk_no, path, size).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import uuid

        for batch in batches:
            conns = batch.column(batch.schema.get_field_index("conn_id")).to_pylist()
            nos = batch.column(batch.schema.get_field_index("chunk_no")).to_pylist()
            datas = batch.column(batch.schema.get_field_index("data")).to_pylist()
            paths, sizes = [], []
            for conn, no, data in zip(conns, nos, datas):
                path = f"{root.rstrip('/')}/conn={conn}/chunk-{no:09d}.bin"
                filesystem, inner = _filesystem(path)
                folder = inner.rsplit("/", 1)[0]
                filesystem.create_dir(folder, recursive=True)
                tmp = f"{folder}/.tmp-{uuid.uuid4().hex}"
                with filesystem.open_output_stream(tmp) as out:
                    out.write(data)
                filesystem.move(tmp, inner)
                paths.append(path)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays(
                [pa.array(conns, pa.int64()), pa.array(nos, pa.int64()), pa.array(paths), pa.array(sizes, pa.int64())],
                names=["conn_id", "chunk_no", "path", "size"],
            )

    schema = "conn_id long, chunk_no long, path string, size long"
    return chunks.select("conn_id", "chunk_no", "data").mapInArrow(run, schema)


def list_chunks(spark: SparkSession, root: str) -> DataFrame:
    """Listing of an archive: (conn_id, chunk_no, path, size); no bytes are read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "chunk-*.bin")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", "length")
    )
    return files.select(
        F.regexp_extract("path", r"conn=(-?\d+)", 1).cast("long").alias("conn_id"),
        F.regexp_extract("path", r"chunk-(\d+)\.bin$", 1).cast("long").alias("chunk_no"),
        "path",
        F.col("length").alias("size"),
    )


# --------------------------------------------------------------------------- walk


class _Cursor:
    """Forward-only view of one connection's stream over its ordered chunks."""

    def __init__(self, chunks: Iterator[tuple]):
        self._it = chunks  # (chunk_no, size, path, data | None)
        self._win: list[tuple] = []  # (size, path, data); those before _head are behind the cursor
        self._starts: list[int] = []  # their stream positions
        self._head = 0
        self._end = 0
        self.pos = 0
        self._handles: dict[str, object] = {}
        self._ahead = (0, b"")  # where the last block of lines starts, and its bytes
        self.bytes_read = 0

    def _fill(self, upto: int) -> bool:
        while self._end < upto:
            nxt = next(self._it, None)
            if nxt is None:
                return False
            _, size, path, data = nxt
            self._win.append((int(size), path, data))
            self._starts.append(self._end)
            self._end += int(size)
        # forget chunks wholly behind the cursor: memory stays bounded
        while self._head < len(self._win) - 1 and self._starts[self._head + 1] <= self.pos:
            self._handles.pop(self._win[self._head][1], None)
            self._head += 1
        if self._head > 64 and 2 * self._head > len(self._win):
            del self._win[: self._head], self._starts[: self._head]
            self._head = 0
        return True

    def _spans(self, start: int, n: int) -> Iterator[tuple[tuple, int, int]]:
        """Chunks that hold [start, start + n), with the span inside each."""
        i = max(self._head, bisect.bisect_right(self._starts, start, self._head) - 1)
        while i < len(self._win) and self._starts[i] < start + n:
            at, size = self._starts[i], self._win[i][0]
            lo, hi = max(start, at), min(start + n, at + size)
            if lo < hi:
                yield self._win[i], lo - at, hi - lo
            i += 1

    def _bytes(self, start: int, n: int) -> bytes:
        out = []
        for (_, path, data), at, length in self._spans(start, n):
            self.bytes_read += length
            if data is not None:
                out.append(bytes(data[at : at + length]))
            else:
                handle = self._handles.get(path)
                if handle is None:
                    filesystem, inner = _filesystem(path)
                    handle = filesystem.open_input_file(inner)
                    self._handles[path] = handle
                out.append(handle.read_at(length, at))
        return b"".join(out)

    def pieces(self, n: int) -> list[dict]:
        self._fill(self.pos + n)
        return [{"path": path, "start": at, "length": length} for (_, path, _), at, length in self._spans(self.pos, n)]

    def read(self, n: int) -> bytes | None:
        if not self._fill(self.pos + n):
            return None
        data = self._bytes(self.pos, n)
        self.pos += n
        return data

    def reaches(self, n: int) -> bool:
        """Whether the stream has n more bytes."""
        return self._fill(self.pos + n)

    def skip(self, n: int) -> bool:
        if not self._fill(self.pos + n):
            return False
        self.pos += n
        return True

    def readline(self) -> bytes | None:
        at, block = self._ahead
        if not at <= self.pos < at + len(block):
            at, block = self.pos, b""
        step = 256
        while True:
            cut = block.find(b"\n", self.pos - at)
            if cut >= 0:
                self._ahead = (at, block)
                line = block[self.pos - at : cut]
                self.pos = at + cut + 1
                return line
            have = at + len(block)
            self._fill(have + step)
            more = self._bytes(have, min(step, self._end - have))
            if not more:
                return None
            at, block = self.pos, block[self.pos - at :] + more
            step = min(2 * step, 1 << 20)

    def seek_header(self, line_start: bool = True, most: int = 1 << 20) -> bool:
        """Move to the next ``<header>`` line, from here on if this is the
        start of a line; False at the end of the stream. A header that starts
        here costs its own line; else blocks double from 256 bytes."""
        mark = HEADER_OPEN + b"\n"
        self._fill(self.pos + len(mark))
        if line_start and self._bytes(self.pos, min(len(mark), self._end - self.pos)) == mark:
            return True
        size = 256
        while True:
            self._fill(self.pos + size)
            block = self._bytes(self.pos, min(size, self._end - self.pos))
            hit = block.find(b"\n" + mark)
            if hit >= 0:
                self.pos += hit + 1
                return True
            if len(block) <= len(mark):
                self.pos += len(block)
                return False
            self.pos += len(block) - len(mark)  # a line that the block cuts is seen again
            size = min(2 * size, most)


_LAYOUTS: dict[str, str] = {}


def _layout_cached(text: str, header) -> str:
    """Field layouts repeat across acquisitions (only times differ): encode the
    JSON once per distinct ``<fields>`` block."""
    cut = text.find("<fields>")
    key = text[cut:] + str(header.sample_bytes) if cut >= 0 else text
    layout = _LAYOUTS.get(key)
    if layout is None:
        if len(_LAYOUTS) > 4096:
            _LAYOUTS.clear()
        layout = _LAYOUTS[key] = fields_to_json(header.fields)
    return layout


def read_header(block: bytes):
    """Parsed header, its lines joined, and its layout as JSON, of a header
    block with its line ends."""
    text = b"".join(block.split(b"\n")).decode(errors="replace")
    header = parse_header(text)
    if not header.sample_bytes:
        raise ValueError("records without bytes")
    return header, text, _layout_cached(text, header)


def _walk(conn_id: int, cursor: _Cursor, with_payload: bool, whole_frames: bool = True) -> Iterator[dict]:
    """Index rows of one stream. What cannot be read as a message is a reject:
    the walk goes on at the next ``<header>`` line, and the reject row says
    where (``pos``) and how many bytes (``n_bytes``) were passed over. Without
    ``whole_frames`` a record may be split over frames; it counts in the frame
    where it ends."""

    def row(kind: str, **kw) -> dict:
        base = {name: None for name in INDEX_SCHEMA.names}
        base.update(conn_id=conn_id, kind=kind, **kw)
        return base

    lost: dict | None = None
    acq_no = 0
    line_start = True  # whether the last byte read ended a line
    line = cursor.readline()
    if line != READY_LINE:
        lost = row("reject", pos=0, message=f"expected OK, got {line if line is None else line[:64]!r}")
    while True:
        # discard lines until the header opens; end of stream here is a clean end
        found = cursor.seek_header(line_start)
        line_start = True
        start = cursor.pos  # a header's position is the start of its "<header>" line
        if lost is not None:
            yield lost | {"n_bytes": (start if found else cursor._end) - lost["pos"]}
            lost = None
        if not found:
            return
        acq_no += 1
        lines, line = [], None
        while line != HEADER_CLOSE:
            line = cursor.readline()
            if line is None:
                yield row("reject", acq_no=acq_no, pos=start, n_bytes=cursor._end - start, message="stream ends inside a header")
                return
            lines.append(line)
        try:
            header, header_text, layout = read_header(b"\n".join(lines))
        except (ParseError, ValueError, TypeError) as exc:
            lost = row("reject", acq_no=acq_no, pos=start, message=f"bad header: {exc}")
            continue
        record = header.sample_bytes
        yield row(
            "header", acq_no=acq_no, pos=start, header=header_text, layout=layout, process=header.process
        )
        at = cursor.pos
        newline = cursor.read(1)
        if newline is None:
            return
        if newline != b"\n":
            lost = row("reject", acq_no=acq_no, pos=at, message="expected newline after header")
            line_start = False
            continue
        frame_no = 0
        taken = 0  # payload bytes of the acquisition
        while lost is None:
            at = cursor.pos
            marker = cursor.read(4)
            if marker is None:
                return  # stream cut: acquisition stays unterminated
            if marker == FRAME_MARKER:
                size = cursor.read(4)
                if size is None:
                    return
                n = struct.unpack("<I", size)[0] - 8
                if n >= 0 and not cursor.reaches(n):
                    return
                if n < 0 or whole_frames and n % record:
                    lost = row("reject", acq_no=acq_no, pos=at, message=f"frame of {n} bytes is not whole records of {record}")
                    line_start = size.endswith(b"\n")
                    break
                pieces = cursor.pieces(n)
                payload = cursor.read(n) if with_payload else (b"" if cursor.skip(n) else None)
                yield row(
                    "frame",
                    acq_no=acq_no,
                    frame_no=frame_no,
                    pos=at + 8,
                    n_bytes=n,
                    first_sample=taken // record,
                    n_rows=(taken + n) // record - taken // record,
                    layout=layout,
                    process=header.process,
                    pieces=pieces,
                    payload=payload if with_payload else None,
                )
                frame_no += 1
                taken += n
            elif marker == END_MARKER:
                line = cursor.readline()
                if line is None:
                    return
                parts = line.split(maxsplit=1)
                reason = parts[1].decode(errors="replace") if len(parts) == 2 else ""
                if reason not in END_REASONS or not parts[0].isdigit():
                    lost = row("reject", acq_no=acq_no, pos=at, message=f"bad end record {line[:64]!r}")
                    break
                yield row("end", acq_no=acq_no, pos=at, samples=int(parts[0]), reason=reason, n_rows=taken // record)
                break
            else:
                lost = row("reject", acq_no=acq_no, pos=at, message=f"bad marker {marker!r}")
                line_start = marker.endswith(b"\n")


#: Payload bytes of one output frame of the walk, about.
WALK_BYTES = 32 << 20


def _walker(with_payload: bool, whole_frames: bool = True):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def rows():
            for pdf in batches:
                has_data = "data" in pdf.columns
                for rec in pdf.itertuples(index=False):
                    yield rec.conn_id, (rec.chunk_no, rec.size, getattr(rec, "path", None), rec.data if has_data else None)

        out: list[dict] = []
        held = 0
        for conn_id, group in itertools.groupby(rows(), key=lambda r: r[0]):
            cursor = _Cursor(item for _, item in group)
            for rec in _walk(int(conn_id), cursor, with_payload, whole_frames):
                out.append(rec)
                held += len(rec["payload"] or b"")
                if len(out) >= 4096 or held >= WALK_BYTES:
                    yield pd.DataFrame(out, columns=INDEX_SCHEMA.names)
                    out, held = [], 0
            for _ in cursor._it:  # drain chunks after a cut
                pass
        if out:
            yield pd.DataFrame(out, columns=INDEX_SCHEMA.names)

    return run


def index_chunks(chunks: DataFrame, with_payload: bool | None = None, whole_frames: bool = True) -> DataFrame:
    """Walk each connection's stream and emit index rows.

    ``chunks`` is either a listing (conn_id, chunk_no, path, size) -- payloads
    are then located, not read -- or in-memory chunks (conn_id, chunk_no,
    data). Rows have kind ``header`` / ``frame`` / ``end`` / ``reject``.
    """
    if "data" in chunks.columns:
        chunks = chunks.withColumn("size", F.length("data").cast("long"))
        if "path" not in chunks.columns:
            chunks = chunks.withColumn("path", F.lit(None).cast("string"))
        with_payload = True if with_payload is None else with_payload
    else:
        with_payload = False
    cols = ["conn_id", "chunk_no", "size", "path"] + (["data"] if "data" in chunks.columns else [])
    # an explicit count keeps AQE from merging connections into one walking task
    n = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = chunks.select(*cols).repartition(n, "conn_id").sortWithinPartitions("conn_id", "chunk_no")
    return ordered.mapInPandas(_walker(with_payload, whole_frames), INDEX_SCHEMA)


def _record_bytes(layout: Column) -> Column:
    """Bytes of a record, from the layout of its fields."""
    fields = F.from_json(layout, "array<struct<type string>>")
    size = F.transform(fields, lambda f: F.regexp_extract(f["type"], r"(\d+)$", 1).cast("long") / 8)
    return F.aggregate(size, F.lit(0.0), lambda a, x: a + x).cast("long")


def coalesce_frames(index: DataFrame, batch_rows: int) -> DataFrame:
    """The index with each acquisition's frames as batches of ``batch_rows``
    records (the last may be shorter), in the columns of the index.

    Batches follow the payload bytes, not the frames: a record that is split
    over two frames is whole in its batch, which keeps its bytes as pieces of
    both. Bytes behind the last whole record of an acquisition are left out;
    ``trailing_bytes`` lists them.
    """
    key = ["conn_id", "acq_no"]
    frames = index.where(F.col("kind") == "frame").withColumn("record", _record_bytes(F.col("layout")))
    frames = ordered_scan(frames, key, ["frame_no"], out="off", weight="n_bytes")
    total = index.where(F.col("kind") == "frame").groupBy(*key).agg(F.sum("n_bytes").alias("total"))
    frames = frames.join(total, key).withColumn("batch", F.col("record") * batch_rows).withColumn("usable", F.col("total") - F.col("total") % F.col("record"))
    stop = F.least(F.col("off") + F.col("n_bytes"), F.col("usable"))
    frames = frames.withColumn("stop", stop).where("off < stop")
    frames = frames.withColumn("batch_no", F.explode(F.sequence(F.expr("off div batch"), F.expr("(stop - 1) div batch"))))
    lo = F.greatest(F.col("off"), F.col("batch_no") * F.col("batch")) - F.col("off")
    hi = F.least(F.col("stop"), (F.col("batch_no") + 1) * F.col("batch")) - F.col("off")
    frames = frames.withColumn("lo", lo).withColumn("hi", hi)

    def clipped(piece: Column, i: Column) -> Column:
        at = F.aggregate(F.slice("pieces", F.lit(1), i), F.lit(0).cast("long"), lambda a, x: a + x["length"])
        a, b = F.greatest(at, F.col("lo")), F.least(at + piece["length"], F.col("hi"))
        return F.struct(piece["path"].alias("path"), (piece["start"] + a - at).alias("start"), (b - a).alias("length"))

    part = F.struct(
        F.col("off").alias("at"),
        F.filter(F.transform("pieces", clipped), lambda p: p["length"] > 0).alias("pieces"),
        F.substring("payload", (F.col("lo") + 1).cast("int"), (F.col("hi") - F.col("lo")).cast("int")).alias("data"),
        (F.col("hi") - F.col("lo")).alias("size"),
    )
    made = frames.select(*key, "batch_no", "layout", "process", "record", "pos", part.alias("part")).groupBy(*key, "batch_no", "layout", "process", "record").agg(
        F.min("pos").alias("pos"), F.array_sort(F.collect_list("part")).alias("parts")
    )
    size = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["size"])
    data = concat_binary_in_order(F.col("parts"))
    made = made.withColumn("size", size).select(
        *[
            {
                "kind": F.lit("frame"), "frame_no": F.col("batch_no"), "n_bytes": F.col("size"), "first_sample": F.col("batch_no") * batch_rows,
                "n_rows": F.expr("size div record"), "pieces": F.flatten(F.transform("parts", lambda p: p["pieces"])),
                "payload": F.when(F.exists("parts", lambda p: p["data"].isNotNull()), data),
            }.get(f.name, F.col(f.name) if f.name in (*key, "layout", "process", "pos") else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in INDEX_SCHEMA.fields
        ]
    )
    return made.unionByName(index.where(F.col("kind") != "frame").select(*INDEX_SCHEMA.names))


def trailing_bytes(index: DataFrame) -> DataFrame:
    """(conn_id, acq_no, n_bytes) of acquisitions whose payload ends inside a record."""
    frames = index.where(F.col("kind") == "frame").withColumn("record", _record_bytes(F.col("layout")))
    rest = frames.groupBy("conn_id", "acq_no").agg((F.sum("n_bytes") % F.max("record")).alias("n_bytes"))
    return rest.where("n_bytes > 0")


class PieceReader:
    """Reads byte pieces (path, start, length) with a small cache of open files."""

    def __init__(self, max_open: int = 64):
        self._handles: dict[str, object] = {}
        self._max = max_open

    def read_many(self, wanted: list, gap: int = 1 << 16, most: int = 8 << 20) -> list[bytes]:
        """The bytes of each list of pieces. Pieces of one file that lie at
        most ``gap`` bytes apart are read together, up to ``most`` bytes."""
        asked = sorted((p["path"], p["start"], p["length"], i, j) for i, pieces in enumerate(wanted) for j, p in enumerate(pieces if pieces is not None else []))
        parts: list[dict[int, bytes]] = [{} for _ in wanted]
        at = 0
        while at < len(asked):
            path, start, length = asked[at][:3]
            end, to = start + length, at + 1
            while to < len(asked) and asked[to][0] == path and asked[to][1] <= end + gap and asked[to][1] + asked[to][2] - start <= most:
                end, to = max(end, asked[to][1] + asked[to][2]), to + 1
            block = memoryview(self.read([{"path": path, "start": start, "length": end - start}]))
            for _, lo, n, i, j in asked[at:to]:
                parts[i][j] = bytes(block[lo - start : lo - start + n])
            at = to
        return [b"".join(own[j] for j in sorted(own)) for own in parts]

    def read(self, pieces) -> bytes:
        parts = []
        for p in pieces or []:
            handle = self._handles.get(p["path"])
            if handle is None:
                if len(self._handles) >= self._max:
                    self._handles.pop(next(iter(self._handles)))  # the oldest
                filesystem, inner = _filesystem(p["path"])
                handle = filesystem.open_input_file(inner)
                self._handles[p["path"]] = handle
            parts.append(handle.read_at(p["length"], p["start"]))
        return b"".join(parts)


def materialize_index(index: DataFrame, path: str | None = None) -> DataFrame:
    """Write the frame index (one small row per frame) to the shared folder and
    read it back: the forward walk then runs once, and later stages read a
    table that survives executor loss."""
    from strobe.session import shared_dir

    spark = index.sparkSession
    path = path or shared_dir(spark, "frame-index")
    index.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


REGISTRY = "_registry"


def publish_index(index: DataFrame, path: str, partition_bytes: int = 128 << 20) -> str:
    """Write an index for ``capture_dump``: files of about ``partition_bytes``
    of payload each, in stream order, which become its input partitions, and a
    registry of the record layouts (``sig``, ``layout``, ``process``, frames,
    bytes)."""
    frames = index.where(F.col("kind") == "frame")
    spark = index.sparkSession
    kinds = frames.groupBy("layout", "process").agg(F.count(F.lit(1)).alias("frames"), F.sum("n_bytes").alias("bytes"))
    # one row for each layout of the archive; numbered in one order
    registry = kinds.withColumn("sig", (F.row_number().over(Window.orderBy("layout", "process")) - 1).cast("int"))
    registry.coalesce(1).write.mode("overwrite").parquet(f"{path.rstrip('/')}/{REGISTRY}")
    registry = spark.read.parquet(f"{path.rstrip('/')}/{REGISTRY}")
    total = registry.agg(F.coalesce(F.sum("bytes"), F.lit(0))).collect()[0][0]
    order = ["conn_id", "acq_no", "frame_no"]
    # one order over all frames: the scan sees four numbers of each, not its
    # layout, pieces and payload
    before = ordered_scan(frames.select(F.lit(0).alias("all"), *order, "n_bytes"), ["all"], order, out="before", weight="n_bytes").select(*order, "before")
    slim = frames.join(registry.select("layout", "process", "sig"), ["layout", "process"]).drop("layout", "process")
    placed = slim.join(before, order).join(F.broadcast(registry.select("layout", "process", "sig")), "sig")
    placed = placed.withColumn("part", F.floor(F.col("before") / partition_bytes).cast("int"))
    n = -(-int(total) // partition_bytes) + 1
    placed = placed.select("part", *INDEX_SCHEMA.names, "sig").repartitionByRange(n, "part", *order).sortWithinPartitions(*order)
    placed.drop("part").write.mode("overwrite").parquet(f"{path.rstrip('/')}/frames")
    return path


# --------------------------------------------------------------------------- decode


def signature_sizes(index: DataFrame) -> list[tuple[str, str, int]]:
    """(layout, process, payload bytes) per signature, in one small aggregate
    over the index: a row for each record layout of the archive."""
    frames = index.where(F.col("kind") == "frame").groupBy("layout", "process").agg(F.sum("n_bytes").alias("bytes"))
    return [(r["layout"], r["process"], int(r["bytes"] or 0)) for r in frames.collect()]


DEFAULT_DECODE_BYTES = 256 << 20


def decode_partitions(spark: SparkSession, payload_bytes: int) -> int:
    """Partition count for decoding: payload bytes divided by a per-task target
    (``strobe.decode.bytesPerPartition``, default 256 MiB), never below the
    session's shuffle partitions."""
    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    target = int(spark.conf.get("strobe.decode.bytesPerPartition", str(DEFAULT_DECODE_BYTES)))
    return max(floor, -(-int(payload_bytes) // target))


def decode_index(
    index: DataFrame,
    select: list[str] | None = None,
    calibrated: bool = False,
    from_files: bool = True,
    partitions: int | None = None,
) -> DataFrame:
    """Decode all frames of an index, one plan per signature, unioned by name.

    Output partitions hold contiguous frame ranges in (connection,
    acquisition, frame) order, which ``write_acquisitions(presorted=True)``
    uses to write without shuffling samples.
    """
    from strobe.operators.calibrate import calibrate, gate_column
    from strobe.sources.capture_format import fields_from_json
    from strobe.sources.captures import decode_payloads

    frames = index.where(F.col("kind") == "frame")
    spark = index.sparkSession
    out = None
    for layout, process, size in signature_sizes(index):
        n = partitions or decode_partitions(spark, size)
        fields = fields_from_json(layout)
        names = [f.column for f in fields]
        wanted = list(select) if select is not None else names
        if calibrated and process == "Raw" and any(
            f.capture == "Mean" and f.column in wanted for f in fields
        ):
            gate = gate_column(names)
            if gate not in wanted:
                wanted.append(gate)
        # Range-partition the (small) frame index, not the samples: each task
        # decodes a contiguous run of frames, so a huge acquisition is spread
        # over many tasks and the output is already grouped for the writer.
        part = frames.where((F.col("layout") == layout) & (F.col("process") == process))
        part = part.repartitionByRange(n, "conn_id", "acq_no", "frame_no").sortWithinPartitions(
            "conn_id", "acq_no", "frame_no"
        )
        cols = ["conn_id", "acq_no", "frame_no", "first_sample", "payload"]
        if from_files:
            cols.append("pieces")
        decoded = decode_payloads(part.select(*cols), fields, keep=["conn_id", "acq_no", "frame_no"], select=wanted)
        # the process is fixed per signature: a literal, not a per-row string from Python
        decoded = decoded.withColumn("process", F.lit(process))
        rest = [F.col(f"`{c}`") for c in decoded.columns if c not in ("conn_id", "acq_no", "frame_no", "process")]
        decoded = decoded.select("conn_id", "acq_no", "frame_no", "process", *rest)
        if calibrated:
            decoded = calibrate(decoded, [f for f in fields if f.column in wanted], process)
        out = decoded if out is None else out.unionByName(decoded, allowMissingColumns=True)
    return out
