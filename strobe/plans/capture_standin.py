"""Captures derived from the ``events`` table, and the archive built from them.

Stand-in mapping (every value is derived from ``events`` by Spark, so the work
grows with the table):

* acquisition = one user; connection = ``user_id % 4``; connections 0 and 2
  stream ``Raw`` data, 1 and 3 ``Scaled``; acquisition number = rank of the
  user within its connection (1-based);
* two record layouts: users with ``user_id % 5 == 0`` capture an explicit
  ``PCAP.GATE_DURATION`` word at the end of the record; the others rely on the
  implicit leading ``PCAP.SAMPLES`` gate (header 4 bytes short);
* sample order = (ts, event_id); frame = 10 consecutive samples;
* gate = ``1 + event_id % 125`` (sent as the implicit ``PCAP.SAMPLES`` word),
  bit word = ``event_id``, raw value = ``value``, timestamp ticks = 8 ns ticks
  since the user's first event;
* end reason from the user's last event type; the last acquisition of
  connection 3 is cut before its end record; acquisitions of users with
  ``user_id % 7 == 0`` declare one sample more than they carry;
* header times: start = first event with ``user_id % 1000`` as the nanosecond
  digits, arm = one second earlier; ``hw_time_offset_ns`` is absent, a number
  (``user_id * 1001``) or blank by ``user_id % 3``; missed = ``user_id % 5``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strobe.operators.ordering import position_within
from strobe.plans.tables import table
from strobe.session import shared_dir
from strobe.sources.capture_format import FieldSpec
from strobe.sources.captures import cut_chunks, encode_records, frame_records, stream_messages, stream_offsets
from strobe.sources.dumps import (  # noqa: F401
    decode_index,
    index_chunks,
    list_chunks,
    materialize_index,
    write_chunks,
)

# Fields declared in the stand-in headers, in header order. Layout A records
# start with the implicit 4-byte PCAP.SAMPLES gate; layout B declares an
# explicit PCAP.GATE_DURATION word last. Both records are 48 bytes.
DECLARED = [
    FieldSpec("PCAP.BITS0", "uint32", "Value"),
    FieldSpec("EVENT.ID", "int64", "Value"),
    FieldSpec("COUNTER1.OUT", "float64", "Mean", 0.5, 3.0, "mm"),
    FieldSpec("COUNTER1.OUT", "float64", "Min", 0.5, 3.0, "mm"),
    FieldSpec("COUNTER1.OUT", "float64", "Max", 1.0, 0.0, ""),
    FieldSpec("PCAP.TS_START", "int64", "Value", 8e-09, 0.0, "s"),
]
GATE = FieldSpec("PCAP.SAMPLES", "uint32", "Value")
GATE_DURATION = FieldSpec("PCAP.GATE_DURATION", "uint32", "Value")
RECORD = [GATE] + DECLARED
DECLARED_B = DECLARED + [GATE_DURATION]
RECORD_B = DECLARED_B
SAMPLE_BYTES = sum(f.itemsize for f in RECORD)
assert SAMPLE_BYTES == sum(f.itemsize for f in RECORD_B)


def is_layout_b(user_id: Column) -> Column:
    return user_id % 5 == 0
FRAME_ROWS = 10

# Stand-in end reasons by the user's last event type (fixed mapping).
REASON_BY_EVENT = {
    "view": "Ok",
    "signup": "Disarmed",
    "error": "Data overrun",
    "click": "Manually stopped",
    "purchase": "Early disconnect",
}


def _field_lines(fields: list[FieldSpec]) -> str:
    out = []
    for f in fields:
        extra = ""
        if f.scale is not None:
            extra += f' scale="{f.scale!r}" offset="{f.offset!r}" units="{f.units}"'
        out.append(f'<field name="{f.name}" type="{f.type}" capture="{f.capture}"{extra} />\n')
    return "".join(out)


def _attr(name: str, value: Column) -> Column:
    return F.when(value.isNull(), F.lit("")).otherwise(F.concat(F.lit(f' {name}="'), value, F.lit('"')))


def header_column(acq: DataFrame) -> Column:
    """Header block text per acquisition (ends with ``</header>\\n``)."""
    return F.concat(
        F.lit("<header>\n<data missed=\""),
        F.col("missed").cast("string"),
        F.lit('" process="'),
        F.col("process"),
        F.lit(f'" format="Framed" sample_bytes="{SAMPLE_BYTES}"'),
        _attr("arm_time", F.col("arm_time")),
        _attr("start_time", F.col("start_time")),
        _attr("hw_time_offset_ns", F.col("offset_attr")),
        F.lit(" />\n<fields>\n"),
        F.when(is_layout_b(F.col("user_id")), F.lit(_field_lines(DECLARED_B))).otherwise(F.lit(_field_lines(DECLARED))),
        F.lit("</fields>\n</header>\n"),
    )


@dataclass
class StandinCapture:
    acquisitions: DataFrame  # conn_id, acq_no, user_id, process, header, samples, reason, ...
    samples: DataFrame  # conn_id, acq_no, user_id, event_id, sample_idx, <record columns>
    frames: DataFrame
    messages: DataFrame


def _iso(ts: Column, nanos: Column) -> Column:
    return F.concat(
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lpad(nanos.cast("string"), 3, "0"), F.lit("Z")
    )


def build(
    spark: SparkSession, sf_dir: str, events: DataFrame | None = None, frame_rows: int = FRAME_ROWS
) -> StandinCapture:
    ev = events if events is not None else table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    per_user = ev.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("ts").alias("t0"),
        F.max_by("event_type", F.struct("ts", "event_id")).alias("last_type"),
    )
    per_user = per_user.withColumn("conn_id", (F.col("user_id") % 4).cast("long"))
    per_user = position_within(per_user, ["conn_id"], ["user_id"], out="acq_idx").withColumn(
        "acq_no", F.col("acq_idx") + 1
    )
    # the last acquisition of connection 3 is cut (one row per connection)
    cut = (
        per_user.where(F.col("conn_id") == 3)
        .groupBy("conn_id")
        .agg(F.max("user_id").alias("cut_user"))
    )
    reason_map = F.create_map(*[F.lit(x) for kv in REASON_BY_EVENT.items() for x in kv])
    acq = per_user.join(F.broadcast(cut), "conn_id", "left")
    acq = acq.select(
        "conn_id",
        "acq_no",
        "user_id",
        "n",
        "t0",
        F.when(F.col("conn_id") % 2 == 0, F.lit("Raw")).otherwise(F.lit("Scaled")).alias("process"),
        (F.col("user_id") % 5).alias("missed"),
        _iso(F.col("t0"), F.col("user_id") % 1000).alias("start_time"),
        _iso(F.col("t0") - F.expr("INTERVAL 1 SECOND"), F.col("user_id") % 1000).alias("arm_time"),
        F.when(F.col("user_id") % 3 == 1, (F.col("user_id") * 1001).cast("string"))
        .when(F.col("user_id") % 3 == 2, F.lit(""))
        .alias("offset_attr"),
        (F.col("n") + F.when(F.col("user_id") % 7 == 0, 1).otherwise(0)).alias("samples"),
        F.when(F.col("user_id") == F.col("cut_user"), F.lit(None).cast("string"))
        .otherwise(reason_map[F.col("last_type")])
        .alias("reason"),
    )
    acq = acq.withColumn("header", header_column(acq))

    samples = position_within(ev, ["user_id"], ["ts", "event_id"], out="sample_idx")
    t0 = acq.select("user_id", "conn_id", "acq_no", "t0")
    samples = samples.join(t0, "user_id").select(
        "conn_id",
        "acq_no",
        "user_id",
        "event_id",
        "sample_idx",
        (1 + F.col("event_id") % 125).alias("PCAP.SAMPLES.Value"),
        (1 + F.col("event_id") % 125).alias("PCAP.GATE_DURATION.Value"),
        F.col("event_id").bitwiseAND(F.lit(0xFFFFFFFF)).alias("PCAP.BITS0.Value"),
        F.col("event_id").alias("EVENT.ID.Value"),
        F.col("value").alias("COUNTER1.OUT.Mean"),
        F.col("value").alias("COUNTER1.OUT.Min"),
        F.col("value").alias("COUNTER1.OUT.Max"),
        (
            F.timestamp_diff("MICROSECOND", F.col("t0"), F.col("ts")) * 125
        ).alias("PCAP.TS_START.Value"),
    )
    # one encoder per record layout (a plan per layout, as on the decode side)
    layout_b = is_layout_b(F.col("user_id"))
    records = encode_records(samples.where(~layout_b), RECORD).unionByName(
        encode_records(samples.where(layout_b), RECORD_B)
    )
    frames = frame_records(records, frame_rows)
    messages = stream_messages(acq, frames)
    return StandinCapture(acq, samples, frames, messages)


def archive(spark: SparkSession, cap: StandinCapture, chunk_bytes: int = 4096, placed: DataFrame | None = None) -> str:
    """Write the stand-in streams as chunk files under the shared folder."""
    root = shared_dir(spark, "capture-archive")
    source = placed if placed is not None else cap.messages
    write_chunks(cut_chunks(source, chunk_bytes), root).write.mode("overwrite").parquet(root + "/_listing")
    return root


def index_archive(spark: SparkSession, root: str) -> DataFrame:
    """Frame index of an archive, built once and kept as a table."""
    from strobe.sources.parallel_index import index_archive_files

    return materialize_index(index_archive_files(list_chunks(spark, root)), root + "/_index")


@dataclass
class Prepared:
    """A stand-in archive written once: acquisitions table, chunk files and
    frame index, all as tables under the shared folder."""

    acquisitions: DataFrame
    index: DataFrame
    root: str
    messages: DataFrame  # (conn_id, acq_no, part, seq, data, n_bytes, offset)


_PREPARED: dict[tuple, Prepared] = {}


def prepared(spark: SparkSession, sf_dir: str, chunk_bytes: int = 65536) -> Prepared:
    """Build (once per application and table folder) the archive of ``events``
    and return its tables; later queries read them instead of re-encoding."""
    import os

    ev_path = f"{sf_dir.rstrip('/')}/events.parquet"
    stamp = os.stat(ev_path).st_mtime_ns if os.path.exists(ev_path) else 0
    key = (spark.sparkContext.applicationId, sf_dir, chunk_bytes, stamp)
    hit = _PREPARED.get(key)
    if hit is not None:
        return hit
    cap = build(spark, sf_dir)
    # the stream layout (messages with byte offsets) is kept as a table too, so
    # the same streams can be re-cut at other sizes without re-encoding
    messages_path = shared_dir(spark, "capture-messages")
    stream_offsets(cap.messages).write.mode("overwrite").parquet(messages_path)
    placed = spark.read.parquet(messages_path)
    root = archive(spark, cap, chunk_bytes, placed=placed)
    cap.acquisitions.drop("t0").write.mode("overwrite").parquet(root + "/_acquisitions")
    index = index_archive(spark, root)
    prep = Prepared(spark.read.parquet(root + "/_acquisitions"), index, root, placed)
    _PREPARED[key] = prep
    return prep
