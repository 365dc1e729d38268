"""Plain-Python capture stream builder for tests (independent of the Spark
encoder, so the decoder is checked against a second implementation)."""

from __future__ import annotations

import struct

import numpy as np

from strobe.sources.capture_format import FieldSpec, header_text, record_dtype


def acquisition(fields, values: dict, frames, process="Scaled", end=("Disarmed",), sample_bytes=None,
                record_fields=None, **attrs) -> bytes:
    rec = record_fields or fields
    dt = record_dtype(rec)
    n = sum(frames)
    arr = np.zeros(n, dtype=dt)
    for name, col in values.items():
        arr[name] = col
    out = header_text(fields, process=process, sample_bytes=sample_bytes or dt.itemsize, **attrs).encode() + b"\n"
    i = 0
    for k in frames:
        payload = arr[i : i + k].tobytes()
        i += k
        out += b"BIN " + struct.pack("<I", len(payload) + 8) + payload
    if end is not None:
        samples = end[1] if len(end) > 1 else n
        out += f"END {samples} {end[0]}\n".encode()
    return out


def stream(*acqs: bytes) -> bytes:
    return b"OK\n" + b"".join(acqs)


def chunks_df(spark, data: bytes, size: int, conn_id: int = 0):
    rows = [(conn_id, i, data[o : o + size]) for i, o in enumerate(range(0, len(data), size))]
    return spark.createDataFrame(rows, "conn_id long, chunk_no long, data binary")


SCALED_FIELDS = [
    FieldSpec("PCAP.BITS2", "uint32", "Value"),
    FieldSpec("COUNTER1.OUT", "float64", "Min", 1.0, 0.0, ""),
    FieldSpec("COUNTER1.OUT", "float64", "Max", 1.0, 0.0, ""),
    FieldSpec("COUNTER3.OUT", "float64", "Value", 1.0, 0.0, ""),
    FieldSpec("PCAP.TS_START", "float64", "Value", 8e-09, 0.0, "s"),
    FieldSpec("COUNTER1.OUT", "float64", "Mean", 1.0, 0.0, ""),
    FieldSpec("COUNTER2.OUT", "float64", "Mean", 1.0, 0.0, ""),
]


def fast_values(n=58):
    i = np.arange(1, n + 1, dtype=np.float64)
    bits = np.full(n, 8, dtype=np.uint32)
    zero = [k for k in (0, 1, 10, 19, 28, 37, 46, 55) if k < n]
    bits[zero] = 0
    return {
        "PCAP.BITS2.Value": bits,
        "COUNTER1.OUT.Min": i,
        "COUNTER1.OUT.Max": i,
        "COUNTER3.OUT.Value": 3 * i,
        "PCAP.TS_START.Value": (i - 1) * 0.01 + 5.6e-08,
        "COUNTER1.OUT.Mean": i,
        "COUNTER2.OUT.Mean": 2 * i,
    }


def raw_fields(with_duration: bool):
    base = [
        FieldSpec("PCAP.BITS2", "uint32", "Value"),
        FieldSpec("COUNTER1.OUT", "int32", "Min", 1.0, 0.0, ""),
        FieldSpec("COUNTER1.OUT", "int32", "Max", 1.0, 0.0, ""),
        FieldSpec("COUNTER3.OUT", "int32", "Value", 1.0, 0.0, ""),
        FieldSpec("PCAP.TS_START", "int64", "Value", 8e-09, 0.0, "s"),
        FieldSpec("COUNTER1.OUT", "int64", "Mean", 1.0, 0.0, ""),
        FieldSpec("COUNTER2.OUT", "int64", "Mean", 1.0, 0.0, ""),
    ]
    if with_duration:
        return base + [FieldSpec("PCAP.GATE_DURATION", "uint32", "Value")]
    return base


def raw_values(n=10000, gate_name="PCAP.GATE_DURATION.Value"):
    i = np.arange(1, n + 1, dtype=np.int64)
    return {
        "PCAP.BITS2.Value": np.zeros(n, dtype=np.uint32),
        "COUNTER1.OUT.Min": i,
        "COUNTER1.OUT.Max": i,
        "COUNTER3.OUT.Value": 3 * i,
        "PCAP.TS_START.Value": 9 + 250 * (i - 1),
        "COUNTER1.OUT.Mean": 125 * i,
        "COUNTER2.OUT.Mean": 250 * i,
        gate_name: np.full(n, 125, dtype=np.uint32),
    }
