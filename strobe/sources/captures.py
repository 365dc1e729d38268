"""Capture streams as DataFrames: encode samples to wire bytes, cut and index
streams, decode frames back to typed columns.

Representations (all DataFrames, all partitioned by Spark):

* ``samples``  -- (conn_id, acq_no, sample_idx, <field columns>)
* ``frames``   -- (conn_id, acq_no, frame_no, n_rows, first_sample, payload)
* ``messages`` -- (conn_id, acq_no, part, seq, data): the stream as ordered
  wire messages (ready line, header block, ``BIN`` frames, ``END`` line)
* ``chunks``   -- (conn_id, chunk_no, data): the same byte stream cut at
  arbitrary byte positions, as received from a socket or stored in files.

Encoding and decoding of records run in ``mapInArrow`` with numpy (bytes
cannot be built or viewed with Column expressions); everything else is
DataFrame work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strobe.functions.columns import q
from strobe.operators.ordering import ordered_scan
from strobe.sources.capture_format import SPARK_TYPES, FieldSpec, record_dtype
from strobe.sources.dumps import concat_binary_in_order

# message parts, in stream order within an acquisition
PART_READY, PART_HEADER, PART_FRAME, PART_END = 0, 1, 2, 3


def le_uint32(col: Column) -> Column:
    """4-byte little-endian encoding of a non-negative integer column."""
    h = F.lpad(F.hex(col.cast("long")), 8, "0")
    return F.unhex(
        F.concat(F.substring(h, 7, 2), F.substring(h, 5, 2), F.substring(h, 3, 2), F.substring(h, 1, 2))
    )


# --------------------------------------------------------------------------- encode


def encode_records(samples: DataFrame, fields: list[FieldSpec], out: str = "record") -> DataFrame:
    """Add ``out`` (BINARY): each row's fields packed as one little-endian record."""
    dtype = record_dtype(fields)
    size = dtype.itemsize
    names = list(samples.columns)
    position = {name: i for i, name in enumerate(names)}
    # mapInArrow resolves its inputs by name: hide the dots of capture names
    safe = samples.select(*[F.col(q(n)).alias(f"__c{i}") for i, n in enumerate(names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            packed = np.zeros(n, dtype=dtype)
            for f in fields:
                col = batch.column(position[f.column])
                packed[f.column] = np.asarray(
                    col.fill_null(0).to_numpy(zero_copy_only=False)
                ).astype(np.dtype(f.type), copy=False)
            fixed = pa.FixedSizeBinaryArray.from_buffers(
                pa.binary(size), n, [None, pa.py_buffer(packed.tobytes())]
            )
            yield pa.RecordBatch.from_arrays(
                list(batch.columns) + [fixed.cast(pa.binary())],
                names=[f"__c{i}" for i in range(len(names))] + [out],
            )

    schema = T.StructType(list(samples.schema.fields) + [T.StructField(out, T.BinaryType())])
    return safe.mapInArrow(run, schema)


def frame_records(records: DataFrame, frame_rows: int, keys=("conn_id", "acq_no")) -> DataFrame:
    """Group consecutive records into frames of ``frame_rows`` samples.

    Groups are (acquisition, frame) and hold at most ``frame_rows`` records.
    """
    keys = list(keys)
    framed = records.withColumn("frame_no", F.floor(F.col("sample_idx") / frame_rows).cast("long"))
    grouped = framed.groupBy(*keys, "frame_no").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("sample_idx").alias("first_sample"),
        F.array_sort(F.collect_list(F.struct("sample_idx", F.col("record").alias("data")))).alias("recs"),
    )
    return grouped.select(
        *keys, "frame_no", "n_rows", "first_sample", concat_binary_in_order(F.col("recs")).alias("payload")
    )


def stream_messages(acquisitions: DataFrame, frames: DataFrame) -> DataFrame:
    """Lay out the wire messages of each connection.

    ``acquisitions``: (conn_id, acq_no, header, samples, reason) -- ``header``
    is the header block text, ``samples``/``reason`` the end record (reason
    NULL = stream cut before the end record).
    """
    ready = acquisitions.select("conn_id").distinct().select(
        "conn_id",
        F.lit(0).cast("long").alias("acq_no"),
        F.lit(PART_READY).alias("part"),
        F.lit(0).cast("long").alias("seq"),
        F.lit(b"OK\n").cast("binary").alias("data"),
    )
    headers = acquisitions.select(
        "conn_id",
        F.col("acq_no").cast("long").alias("acq_no"),
        F.lit(PART_HEADER).alias("part"),
        F.lit(0).cast("long").alias("seq"),
        F.concat(F.col("header"), F.lit("\n")).cast("binary").alias("data"),
    )
    bins = frames.select(
        "conn_id",
        F.col("acq_no").cast("long").alias("acq_no"),
        F.lit(PART_FRAME).alias("part"),
        F.col("frame_no").cast("long").alias("seq"),
        F.concat(
            F.lit(b"BIN ").cast("binary"),
            le_uint32(F.length("payload") + 8),
            F.col("payload"),
        ).alias("data"),
    )
    ends = acquisitions.where(F.col("reason").isNotNull()).select(
        "conn_id",
        F.col("acq_no").cast("long").alias("acq_no"),
        F.lit(PART_END).alias("part"),
        F.lit(0).cast("long").alias("seq"),
        F.format_string("END %d %s\n", F.col("samples"), F.col("reason")).cast("binary").alias("data"),
    )
    return ready.unionByName(headers).unionByName(bins).unionByName(ends)


def stream_offsets(messages: DataFrame) -> DataFrame:
    """Absolute byte offset of every message in its connection's stream."""
    sized = messages.withColumn("n_bytes", F.length("data").cast("long"))
    return ordered_scan(sized, ["conn_id"], ["acq_no", "part", "seq"], out="offset", weight="n_bytes")


def cut_chunks(messages: DataFrame, chunk_bytes: int) -> DataFrame:
    """Cut each connection's byte stream into chunks of ``chunk_bytes``.

    Cut points ignore message boundaries, as a socket or a file split would;
    every (connection, chunk) group holds at most ``chunk_bytes`` bytes.
    Messages that already carry ``offset``/``n_bytes`` (see ``stream_offsets``)
    are cut directly.
    """
    placed = messages if "offset" in messages.columns else stream_offsets(messages)
    end = F.col("offset") + F.col("n_bytes")
    pieces = placed.withColumn(
        "chunk_no",
        F.explode(
            F.sequence(
                F.floor(F.col("offset") / chunk_bytes).cast("long"),
                F.floor((end - 1) / chunk_bytes).cast("long"),
            )
        ),
    )
    lo = F.greatest(F.col("offset"), F.col("chunk_no") * chunk_bytes)
    hi = F.least(end, (F.col("chunk_no") + 1) * chunk_bytes)
    pieces = pieces.select(
        "conn_id",
        "chunk_no",
        lo.alias("start"),
        F.substring(F.col("data"), (lo - F.col("offset") + 1).cast("int"), (hi - lo).cast("int")).alias("data"),
    )
    return pieces.groupBy("conn_id", "chunk_no").agg(
        concat_binary_in_order(F.array_sort(F.collect_list(F.struct("start", "data")))).alias("data")
    )


# --------------------------------------------------------------------------- decode


def spark_schema(fields: list[FieldSpec]) -> list[T.StructField]:
    return [T.StructField(f.column, SPARK_TYPES[np.dtype(f.type).name], True) for f in fields]


def _column_array(values: np.ndarray, type_name: str) -> pa.Array:
    if type_name == "uint64":
        # a decimal is 16 bytes, little-endian: the value and eight zero bytes
        wide = np.zeros((len(values), 2), dtype="<u8")
        wide[:, 0] = values
        return pa.Array.from_buffers(pa.decimal128(20, 0), len(values), [None, pa.py_buffer(wide.tobytes())])
    widen = {"uint8": np.int16, "uint16": np.int32, "uint32": np.int64}.get(type_name)
    return pa.array(values.astype(widen) if widen is not None else values)


MAX_RECORDS_PER_BATCH = 1 << 17


def decode_payloads(
    frames: DataFrame,
    fields: list[FieldSpec],
    keep: list[str] | None = None,
    select: list[str] | None = None,
    max_records: int = MAX_RECORDS_PER_BATCH,
) -> DataFrame:
    """Decode ``payload`` of each frame row into one row per sample.

    ``frames`` must carry ``payload`` (BINARY, or NULL with ``pieces`` to read
    from storage) and ``first_sample``; ``keep`` columns are repeated on every
    sample. ``select`` restricts the decoded field columns (the others are
    never materialised). Output batches hold at most ``max_records`` samples,
    so memory per batch is bounded however large the frames are.
    """
    keep = keep if keep is not None else ["conn_id", "acq_no", "frame_no"]
    dtype = record_dtype(fields)
    wanted = [f for f in fields if select is None or f.column in select]
    has_pieces = "pieces" in frames.columns
    names = keep + ["sample_idx"] + [f.column for f in wanted]

    def emit(batch: pa.RecordBatch, rows: list[int], blobs: list[bytes], first: np.ndarray) -> pa.RecordBatch:
        lengths = np.fromiter((len(b) for b in blobs), dtype=np.int64, count=len(blobs))
        if (lengths % dtype.itemsize).any():
            raise ValueError("frame payload is not a whole number of records")
        counts = lengths // dtype.itemsize
        records = np.frombuffer(b"".join(blobs), dtype=dtype)
        local = np.repeat(np.arange(len(blobs)), counts)
        starts = np.cumsum(counts) - counts
        row_of = np.asarray(rows, dtype=np.int64)[local]
        sample_idx = first[row_of] + (np.arange(len(records)) - starts[local])
        take = pa.array(row_of)
        cols = [batch.column(batch.schema.get_field_index(k)).take(take) for k in keep]
        cols.append(pa.array(sample_idx.astype(np.int64)))
        for f in wanted:
            cols.append(_column_array(records[f.column], np.dtype(f.type).name))
        return pa.RecordBatch.from_arrays(cols, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from strobe.sources.dumps import PieceReader

        reader = PieceReader()
        for batch in batches:
            payload = batch.column(batch.schema.get_field_index("payload")).to_pylist()
            pieces = batch.column(batch.schema.get_field_index("pieces")).to_pylist() if has_pieces else None
            first = batch.column(batch.schema.get_field_index("first_sample")).to_numpy(zero_copy_only=False)
            rows: list[int] = []
            pending = 0

            def taken(rows: list[int]) -> pa.RecordBatch:
                # frames of an archive on storage are read from their byte pieces here, near ones together
                stored = [i for i in rows if payload[i] is None]
                read = dict(zip(stored, reader.read_many([pieces[i] for i in stored]), strict=True)) if pieces is not None else {}
                return emit(batch, rows, [payload[i] if payload[i] is not None else read.get(i, b"") for i in rows], first)

            for i, blob in enumerate(payload):
                rows.append(i)
                size = len(blob) if blob is not None else sum(p["length"] for p in (pieces[i] or [])) if pieces is not None else 0
                pending += size // dtype.itemsize
                if pending >= max_records:
                    yield taken(rows)
                    rows, pending = [], 0
            if rows:
                yield taken(rows)

    schema = T.StructType(
        [frames.schema[k] for k in keep]
        + [T.StructField("sample_idx", T.LongType(), False)]
        + spark_schema(wanted)
    )
    return frames.mapInArrow(run, schema)
