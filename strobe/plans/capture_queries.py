"""Check queries for capture decoding, calibration, sinks, reductions, quality
and time (SURVEY §2.1-2.7, 2.11, 2.12), each with a DuckDB oracle.

The Spark side does the real work -- encode ``events`` into capture streams,
cut them into chunk files, walk the frame index, decode and calibrate -- and
the oracle states the expected relation directly over ``events``/``part``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strobe.functions.columns import c, rounded
from strobe.operators.calibrate import (
    calibrate_long,
    choose_gate,
    renamed,
    with_field_rules,
)
from strobe.operators.ordering import ordered_scan, position_within
from strobe.operators.reduce import capture_modes
from strobe.operators.reduce import throughput as reduce_throughput
from strobe.operators.sinks import DataOverrunError, guard_overruns, write_acquisitions
from strobe.operators.timebase import iso_to_epoch_ns, offset_ns, system_start_ns
from strobe.plans import capture_standin as cs
from strobe.plans.registry import register
from strobe.plans.tables import table
from strobe.session import shared_dir
from strobe.sources.capture_format import DEVICE_END_REASONS, END_REASONS, GATE_DURATION_FIELD, SAMPLES_FIELD
from strobe.sources.captures import cut_chunks
from strobe.sources.dumps import coalesce_frames as coalesced
from strobe.sources.dumps import concat_binary_in_order, list_chunks, materialize_index, publish_index, write_chunks
from strobe.sources.parallel_index import index_archive_files, index_chunks_parallel

# ----------------------------------------------------------------------------- shared SQL

_U = """u AS (SELECT user_id, count(*) AS n, min(ts) AS t0, max(ts) AS t1,
           arg_max(event_type, ts) AS last_type
         FROM events GROUP BY user_id),
a AS (SELECT *, user_id % 4 AS conn_id,
        row_number() OVER (PARTITION BY user_id % 4 ORDER BY user_id) AS acq_no,
        CASE WHEN user_id % 4 = 3 AND user_id = max(user_id) OVER (PARTITION BY user_id % 4)
             THEN NULL
             ELSE CASE last_type WHEN 'view' THEN 'Ok' WHEN 'signup' THEN 'Disarmed'
                  WHEN 'error' THEN 'Data overrun' WHEN 'click' THEN 'Manually stopped'
                  WHEN 'purchase' THEN 'Early disconnect' END END AS reason,
        n + CASE WHEN user_id % 7 = 0 THEN 1 ELSE 0 END AS declared
      FROM u)"""
_S = """s AS (SELECT e.*, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i
      FROM events e)"""

HEADER_SCHEMA = (
    "data struct<_missed: bigint, _process: string, _format: string, _sample_bytes: bigint, "
    "_arm_time: string, _start_time: string, _hw_time_offset_ns: string>, "
    "fields struct<field: array<struct<_name: string, _type: string, _capture: string, "
    "_scale: double, _offset: double, _units: string>>>"
)
ITEMSIZE = {"int8": 1, "uint8": 1, "int16": 2, "uint16": 2, "int32": 4, "uint32": 4,
            "int64": 8, "uint64": 8, "float32": 4, "float64": 8, "double": 8}


# ----------------------------------------------------------------------------- helpers


def _archive_index(spark: SparkSession, sf_dir: str, chunk_bytes: int = 65536):
    prep = cs.prepared(spark, sf_dir, chunk_bytes)
    return prep, prep.index


def _users(prep) -> DataFrame:
    """(conn_id, acq_no) -> user_id: the acquisitions table (one row per
    acquisition); joins to it are sized by AQE at run time."""
    return prep.acquisitions.select("conn_id", "acq_no", "user_id")


def _decoded(spark, sf_dir, calibrated=False, select=None) -> tuple[cs.Prepared, DataFrame]:
    cap, index = _archive_index(spark, sf_dir)
    dec = cs.decode_index(index, select=select, calibrated=calibrated)
    return cap, dec.join(_users(cap), ["conn_id", "acq_no"])


def gate_of(df: DataFrame):
    """The gate word of each sample whatever its layout: the explicit
    ``PCAP.GATE_DURATION`` where captured, else the ``PCAP.SAMPLES`` word."""
    cols = [x for x in (GATE_DURATION_FIELD, SAMPLES_FIELD) if x in df.columns]
    return F.coalesce(*[c(x) for x in cols]) if len(cols) > 1 else c(cols[0])


def parsed_headers(index: DataFrame) -> DataFrame:
    """Header rows of an index parsed in the JVM with ``from_xml``."""
    h = index.where(F.col("kind") == "header").select(
        "conn_id", "acq_no", "header",
        F.from_xml("header", HEADER_SCHEMA, {"attributePrefix": "_"}).alias("x"),
    )
    return h


def header_field_rows(index: DataFrame) -> DataFrame:
    """One row per declared field: (conn_id, acq_no, pos, name, type, capture, scale, offset, units)."""
    h = parsed_headers(index)
    return h.select("conn_id", "acq_no", F.posexplode("x.fields.field").alias("pos", "f"), "x.data").select(
        "conn_id", "acq_no", F.col("pos").cast("long").alias("pos"),
        F.col("f._name").alias("name"), F.col("f._type").alias("type"), F.col("f._capture").alias("capture"),
        F.col("f._scale").alias("scale"), F.col("f._offset").alias("offset"), F.col("f._units").alias("units"),
        F.col("data._process").alias("process"), F.col("data._sample_bytes").alias("sample_bytes"),
    )


def _itemsize(col):
    return F.create_map(*[F.lit(x) for kv in ITEMSIZE.items() for x in kv])[col]


def record_fields(index: DataFrame) -> DataFrame:
    """Fields in record order after the implicit-gate rule, with byte offsets."""
    fr = header_field_rows(index).withColumn("itemsize", _itemsize(F.col("type")).cast("long"))
    per_acq = fr.groupBy("conn_id", "acq_no").agg(
        F.sum("itemsize").alias("declared_bytes"), F.first("sample_bytes").alias("sample_bytes"),
        F.first("process").alias("process"),
    )
    gate = per_acq.where(F.col("sample_bytes") - F.col("declared_bytes") == 4).select(
        "conn_id", "acq_no", F.lit(-1).cast("long").alias("pos"), F.lit("PCAP.SAMPLES").alias("name"),
        F.lit("uint32").alias("type"), F.lit("Value").alias("capture"),
        F.lit(None).cast("double").alias("scale"), F.lit(None).cast("double").alias("offset"),
        F.lit(None).cast("string").alias("units"), "process", "sample_bytes", F.lit(4).cast("long").alias("itemsize"),
    )
    allf = fr.unionByName(gate)
    # small table (fields per acquisition): a plain window is bounded by the field count
    from pyspark.sql import Window

    w = Window.partitionBy("conn_id", "acq_no").orderBy("pos")
    return allf.select(
        "*",
        (F.row_number().over(w) - 1).cast("long").alias("record_pos"),
        F.coalesce(F.sum("itemsize").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long").alias("byte_offset"),
    )


# ----------------------------------------------------------------------------- §2.1 sources


@register("dump_roundtrip", f"""
WITH {_U}, {_S}
SELECT event_id, i AS sample_idx, 1 + event_id % 125 AS gate, event_id AS bits,
       round(value, 6) AS raw_value, (epoch_us(ts) - epoch_us(t0)) * 125 AS ticks
FROM s JOIN u USING (user_id)""")
def dump_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dec = _decoded(spark, sf_dir)
    return dec.select(
        c("EVENT.ID.Value").alias("event_id"), "sample_idx",
        gate_of(dec).alias("gate"), c("PCAP.BITS0.Value").alias("bits"),
        rounded(c("COUNTER1.OUT.Mean")).alias("raw_value"), c("PCAP.TS_START.Value").alias("ticks"),
    )


@register("frame_index", f"""
WITH {_U}
SELECT user_id, CAST(ceil(n / 10.0) AS BIGINT) AS n_frames, n * 48 AS payload_bytes, n AS n_samples
FROM u""")
def frame_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The frame index built in parallel over the archive's chunk files (the
    other capture queries use the routed index; both give the same rows)."""
    cap, _ = _archive_index(spark, sf_dir)
    index = index_chunks_parallel(list_chunks(spark, cap.root))
    frames = index.where(F.col("kind") == "frame").groupBy("conn_id", "acq_no").agg(
        F.count(F.lit(1)).alias("n_frames"), F.sum("n_bytes").alias("payload_bytes"),
        F.sum("n_rows").alias("n_samples"),
    )
    return frames.join(_users(cap), ["conn_id", "acq_no"]).select("user_id", "n_frames", "payload_bytes", "n_samples")


#: Block size of the index over unequal chunks, and junk that one connection has.
SMALL_BLOCK = 16384
JUNK_LINES = 4000


@register("index_any_cut", f"""
WITH {_U}
SELECT user_id, CASE WHEN bad THEN 0 ELSE CAST(ceil(n / 10.0) AS BIGINT) END AS n_frames, CASE WHEN bad THEN 0 ELSE n END AS n_samples,
  NOT bad AND reason IS NOT NULL AS ended, CAST(bad AS BIGINT) AS n_rejects
FROM (SELECT *, conn_id = 1 AND acq_no = 2 AS bad FROM a)""")
def index_any_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive cut into files of ever larger size, with 100 KB of text after
    the first acquisition of connection 0 and a corrupt frame in connection 1."""
    prep = cs.prepared(spark, sf_dir)
    first = (F.col("acq_no") == 1) & (F.col("part") == 3) & (F.col("conn_id") == 0)
    bad = (F.col("conn_id") == 1) & (F.col("acq_no") == 2) & (F.col("part") == 2) & (F.col("seq") == 0)
    junk = F.encode(F.repeat(F.lit("BIN and <header> in a line of text\n"), JUNK_LINES), "UTF-8")
    data = F.when(first, F.concat("data", junk)).when(bad, F.concat(F.lit(b"BAD ").cast("binary"), F.expr("substring(data, 5)"))).otherwise(F.col("data"))
    small = cut_chunks(prep.messages.drop("offset", "n_bytes").withColumn("data", data), 997)
    cut = small.groupBy("conn_id", F.floor(F.sqrt(F.col("chunk_no") * 2)).cast("long").alias("new_no")).agg(
        concat_binary_in_order(F.array_sort(F.collect_list(F.struct("chunk_no", "data")))).alias("data")
    )
    root = shared_dir(spark, "unequal-archive")
    write_chunks(cut.withColumnRenamed("new_no", "chunk_no"), root).write.mode("overwrite").parquet(root + "/_listing")
    index = materialize_index(index_archive_files(list_chunks(spark, root), walk_bytes=0, block_bytes=SMALL_BLOCK))
    kind = F.col("kind")
    per = index.groupBy("conn_id", "acq_no").agg(
        F.count(F.when(kind == "frame", 1)).alias("n_frames"), F.coalesce(F.sum(F.when(kind == "frame", F.col("n_rows"))), F.lit(0)).alias("n_samples"),
        F.max(kind == "end").alias("ended"), F.count(F.when(kind == "reject", 1)).alias("n_rejects"),
    )
    return per.join(_users(prep), ["conn_id", "acq_no"]).select("user_id", "n_frames", "n_samples", "ended", "n_rejects")


_DECLARED_VALUES = """(VALUES (0, 'PCAP.BITS0', 'uint32', 'Value', NULL, NULL, NULL),
 (1, 'EVENT.ID', 'int64', 'Value', NULL, NULL, NULL),
 (2, 'COUNTER1.OUT', 'float64', 'Mean', 0.5, 3.0, 'mm'),
 (3, 'COUNTER1.OUT', 'float64', 'Min', 0.5, 3.0, 'mm'),
 (4, 'COUNTER1.OUT', 'float64', 'Max', 1.0, 0.0, ''),
 (5, 'PCAP.TS_START', 'int64', 'Value', 8e-09, 0.0, 's'))
 f(pos, name, type, capture, scale, "offset", units)"""


@register("header_fields", f"""
WITH {_U}
SELECT user_id, CAST(pos AS BIGINT) AS pos, name, type, capture, CAST(scale AS DOUBLE) AS scale,
       CAST("offset" AS DOUBLE) AS "offset", units,
       CASE WHEN user_id % 2 = 0 THEN 'Raw' ELSE 'Scaled' END AS process,
       user_id % 5 AS missed,
       CASE WHEN user_id % 3 = 1 THEN user_id * 1001 END AS hw_time_offset_ns
FROM u, {_DECLARED_VALUES}
UNION ALL
SELECT user_id, CAST(6 AS BIGINT), 'PCAP.GATE_DURATION', 'uint32', 'Value', NULL, NULL, NULL,
       CASE WHEN user_id % 2 = 0 THEN 'Raw' ELSE 'Scaled' END, user_id % 5,
       CASE WHEN user_id % 3 = 1 THEN user_id * 1001 END
FROM u WHERE user_id % 5 = 0""")
def header_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    h = parsed_headers(index).select(
        "conn_id", "acq_no", F.col("x.data._process").alias("process"),
        F.col("x.data._missed").alias("missed"),
        offset_ns(F.col("x.data._hw_time_offset_ns")).alias("hw_time_offset_ns"),
    )
    fields = header_field_rows(index).drop("process", "sample_bytes")
    return fields.join(h, ["conn_id", "acq_no"]).join(_users(cap), ["conn_id", "acq_no"]).select(
        "user_id", "pos", "name", "type", "capture", "scale", "offset", "units", "process", "missed",
        "hw_time_offset_ns",
    )


@register("implicit_gate", """
SELECT DISTINCT user_id, CAST(CASE WHEN user_id % 5 = 0 THEN 48 ELSE 44 END AS BIGINT) AS declared_bytes,
       CAST(48 AS BIGINT) AS sample_bytes, user_id % 5 <> 0 AS gate_inserted, CAST(7 AS BIGINT) AS n_fields
FROM events""")
def implicit_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    rf = record_fields(index)
    per = rf.groupBy("conn_id", "acq_no").agg(
        F.sum(F.when(F.col("pos") >= 0, F.col("itemsize"))).alias("declared_bytes"),
        F.first("sample_bytes").alias("sample_bytes"),
        F.max(F.col("pos") < 0).alias("gate_inserted"),
        F.count(F.lit(1)).alias("n_fields"),
    )
    return per.join(_users(cap), ["conn_id", "acq_no"]).select(
        "user_id", F.col("declared_bytes").cast("long").alias("declared_bytes"),
        F.col("sample_bytes").cast("long").alias("sample_bytes"), "gate_inserted", "n_fields",
    )


@register("record_layout", """
WITH f(layout, record_pos, col, size) AS (VALUES ('A', 0, 'PCAP.SAMPLES.Value', 4), ('A', 1, 'PCAP.BITS0.Value', 4),
  ('A', 2, 'EVENT.ID.Value', 8), ('A', 3, 'COUNTER1.OUT.Mean', 8), ('A', 4, 'COUNTER1.OUT.Min', 8),
  ('A', 5, 'COUNTER1.OUT.Max', 8), ('A', 6, 'PCAP.TS_START.Value', 8),
  ('B', 0, 'PCAP.BITS0.Value', 4), ('B', 1, 'EVENT.ID.Value', 8), ('B', 2, 'COUNTER1.OUT.Mean', 8),
  ('B', 3, 'COUNTER1.OUT.Min', 8), ('B', 4, 'COUNTER1.OUT.Max', 8), ('B', 5, 'PCAP.TS_START.Value', 8),
  ('B', 6, 'PCAP.GATE_DURATION.Value', 4)),
o AS (SELECT layout, record_pos, col, CAST(coalesce(sum(size) OVER (PARTITION BY layout ORDER BY record_pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS byte_offset FROM f)
SELECT user_id, CAST(record_pos AS BIGINT) AS record_pos, col AS "column", byte_offset
FROM (SELECT DISTINCT user_id, CASE WHEN user_id % 5 = 0 THEN 'B' ELSE 'A' END AS layout FROM events) u
JOIN o USING (layout)""")
def record_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    rf = record_fields(index)
    return rf.join(_users(cap), ["conn_id", "acq_no"]).select(
        "user_id", "record_pos", F.concat_ws(".", "name", "capture").alias("column"), "byte_offset"
    )


_REASONS_SQL = "(VALUES " + ", ".join(
    f"('{r}', '{'device' if r in DEVICE_END_REASONS else 'software'}')" for r in END_REASONS
) + ") d(reason, origin)"


@register("end_reasons", f"""
WITH {_U}
SELECT d.reason, d.origin, coalesce(c.n, 0) AS n_acquisitions
FROM {_REASONS_SQL}
LEFT JOIN (SELECT reason, count(*) AS n FROM a WHERE reason IS NOT NULL GROUP BY reason) c
  ON c.reason = d.reason""")
def end_reasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, index = _archive_index(spark, sf_dir)
    dim = spark.createDataFrame(
        [(r, "device" if r in DEVICE_END_REASONS else "software") for r in END_REASONS], "reason string, origin string"
    )
    counts = index.where(F.col("kind") == "end").groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    return dim.join(counts, "reason", "left").select(
        "reason", "origin", F.coalesce("n", F.lit(0)).cast("long").alias("n_acquisitions")
    )


@register("sample_positions", """
SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS sample_idx FROM events""")
def sample_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "ts")
    return position_within(ev, ["user_id"], ["ts", "event_id"], out="sample_idx").select("event_id", "sample_idx")


@register("chunk_reassembly", """
SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS sample_idx,
       CAST(3 AS BIGINT) AS n_cuts, round(value, 6) AS least, round(value, 6) AS most FROM events""")
def chunk_reassembly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same streams cut three ways and indexed as independent streams in one
    job (the cut variant is folded into the connection key); every sample must
    decode identically from all three."""
    prep = cs.prepared(spark, sf_dir)
    sizes = (61, 997, 8192)
    cuts = None
    for k, size in enumerate(sizes):
        part = cut_chunks(prep.messages, size).withColumn("conn_id", F.col("conn_id") * len(sizes) + k)
        cuts = part if cuts is None else cuts.unionByName(part)
    index = materialize_index(index_archive_files(cuts))
    dec = cs.decode_index(index, from_files=False, select=["EVENT.ID.Value", "COUNTER1.OUT.Mean"])
    out = dec.select(
        c("EVENT.ID.Value").alias("event_id"), "sample_idx", c("COUNTER1.OUT.Mean").alias("v"),
        (F.col("conn_id") % len(sizes)).alias("cut"),
    )
    # the three cuts of a sample are one bit each: no second shuffle for a distinct count
    seen = F.bit_count(F.bit_or(F.expr("shiftleft(1, CAST(cut AS INT))"))).cast("long")
    return out.groupBy("event_id", "sample_idx").agg(
        seen.alias("n_cuts"), rounded(F.min("v")).alias("least"), rounded(F.max("v")).alias("most")
    )


@register("first_n_acquisitions", f"""
WITH {_U}
SELECT user_id, conn_id, acq_no, n AS n_samples FROM a WHERE acq_no <= 3""")
def first_n_acquisitions(spark: SparkSession, sf_dir: str, num: int = 3) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    kept = index.where((F.col("acq_no") <= num) | F.lit(num == 0))
    n = kept.where(F.col("kind") == "frame").groupBy("conn_id", "acq_no").agg(F.sum("n_rows").alias("n_samples"))
    heads = kept.where(F.col("kind") == "header").select("conn_id", "acq_no")
    return heads.join(n, ["conn_id", "acq_no"], "left").join(_users(cap), ["conn_id", "acq_no"]).select(
        "user_id", "conn_id", "acq_no", F.coalesce("n_samples", F.lit(0)).alias("n_samples")
    )


# ----------------------------------------------------------------------------- §2.2 calibration


@register("calibrate_linear", """
SELECT event_id, CASE WHEN user_id % 2 = 0 THEN round(value * 0.5 + 3.0, 6) ELSE round(value, 6) END AS v
FROM events""")
def calibrate_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dec = _decoded(spark, sf_dir, calibrated=True, select=["EVENT.ID.Value", "COUNTER1.OUT.Min"])
    return dec.select(c("EVENT.ID.Value").alias("event_id"), rounded(c("COUNTER1.OUT.Min")).alias("v"))


@register("calibrate_gated_mean", """
SELECT event_id, CASE WHEN user_id % 2 = 0 THEN round(value * 0.5 / (1 + event_id % 125) + 3.0, 6)
                      ELSE round(value, 6) END AS v
FROM events""")
def calibrate_gated_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dec = _decoded(spark, sf_dir, calibrated=True, select=["EVENT.ID.Value", "COUNTER1.OUT.Mean"])
    return dec.select(c("EVENT.ID.Value").alias("event_id"), rounded(c("COUNTER1.OUT.Mean")).alias("v"))


@register("calibrate_passthrough", """
SELECT event_id, round(value, 6) AS v, event_id AS bits, 1 + event_id % 125 AS gate FROM events""")
def calibrate_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dec = _decoded(spark, sf_dir, calibrated=True)
    return dec.select(
        c("EVENT.ID.Value").alias("event_id"), rounded(c("COUNTER1.OUT.Max")).alias("v"),
        c("PCAP.BITS0.Value").alias("bits"), gate_of(dec).alias("gate"),
    )


@register("raw_or_scaled", f"""
WITH {_U}
SELECT event_id, CASE WHEN user_id % 2 = 0 THEN 'Raw' ELSE 'Scaled' END AS process,
       CASE WHEN user_id % 2 = 0 THEN round(((epoch_us(ts) - epoch_us(t0)) * 125) * 8e-09, 6)
            ELSE CAST((epoch_us(ts) - epoch_us(t0)) * 125 AS DOUBLE) END AS ts_value
FROM events JOIN u USING (user_id)""")
def raw_or_scaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dec = _decoded(spark, sf_dir, calibrated=True, select=["EVENT.ID.Value", "PCAP.TS_START.Value"])
    return dec.select(
        c("EVENT.ID.Value").alias("event_id"), "process",
        rounded(c("PCAP.TS_START.Value")).alias("ts_value"),
    )


_PART_FIELDS = """pf AS (SELECT p_partkey AS field_id, p_brand, p_type, p_size,
  CASE WHEN p_size = 1 THEN 'PCAP.GATE_DURATION' WHEN p_size = 2 THEN 'PCAP.SAMPLES'
       ELSE upper(replace(p_name, ' ', '_')) || '.OUT' END AS name,
  CASE WHEN p_size <= 2 THEN 'Value' ELSE ['Value', 'Min', 'Max', 'Mean'][p_partkey % 4 + 1] END AS capture,
  CASE p_size % 3 WHEN 0 THEN 'uint32' WHEN 1 THEN 'int32' ELSE 'float64' END AS type,
  CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_size % 10 = 0 THEN 1.0 ELSE p_size / 10.0 END AS scale,
  CASE WHEN p_partkey % 3 = 0 THEN NULL WHEN p_size % 5 = 0 THEN 0.0 ELSE round(p_retailprice / 100, 2) END AS "offset",
  CASE WHEN p_partkey % 3 = 0 OR p_partkey % 11 = 0 THEN NULL ELSE 'mm' END AS units
FROM part)"""


def part_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Field metadata stand-in derived from ``part`` (same rules as the oracle)."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    captures = F.array(*[F.lit(x) for x in ("Value", "Min", "Max", "Mean")])
    no_meta = F.col("p_partkey") % 3 == 0
    return p.select(
        F.col("p_partkey").alias("field_id"), "p_brand", "p_type", "p_size",
        F.when(F.col("p_size") == 1, F.lit("PCAP.GATE_DURATION"))
        .when(F.col("p_size") == 2, F.lit("PCAP.SAMPLES"))
        .otherwise(F.concat(F.upper(F.regexp_replace("p_name", " ", "_")), F.lit(".OUT"))).alias("name"),
        F.when(F.col("p_size") <= 2, F.lit("Value")).otherwise(
            F.element_at(captures, (F.col("p_partkey") % 4 + 1).cast("int"))
        ).alias("capture"),
        F.when(F.col("p_size") % 3 == 0, F.lit("uint32")).when(F.col("p_size") % 3 == 1, F.lit("int32"))
        .otherwise(F.lit("float64")).alias("type"),
        F.when(no_meta, F.lit(None).cast("double")).when(F.col("p_size") % 10 == 0, F.lit(1.0))
        .otherwise(F.col("p_size") / 10.0).alias("scale"),
        F.when(no_meta, F.lit(None).cast("double")).when(F.col("p_size") % 5 == 0, F.lit(0.0))
        .otherwise(F.round(F.col("p_retailprice") / 100, 2)).alias("offset"),
        F.when(no_meta | (F.col("p_partkey") % 11 == 0), F.lit(None).cast("string")).otherwise(F.lit("mm")).alias("units"),
    )


@register("needs_calibration", f"""
WITH {_PART_FIELDS}
SELECT field_id, coalesce(scale IS NOT NULL AND "offset" IS NOT NULL AND (scale <> 1 OR "offset" <> 0), false)
       AS needs_calibration FROM pf""")
def needs_calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = with_field_rules(part_fields(spark, sf_dir))
    return f.select("field_id", F.coalesce("needs_calibration", F.lit(False)).alias("needs_calibration"))


@register("output_types", f"""
WITH {_PART_FIELDS}
SELECT field_id, CASE WHEN scale IS NOT NULL AND "offset" IS NOT NULL THEN 'float64' ELSE type END AS raw_type,
       type AS scaled_type FROM pf""")
def output_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = with_field_rules(part_fields(spark, sf_dir))
    return f.select("field_id", "raw_type", F.col("type").alias("scaled_type"))


@register("metadata_valid", f"""
WITH {_PART_FIELDS}
SELECT field_id, (scale IS NULL AND "offset" IS NULL AND units IS NULL)
       OR (scale IS NOT NULL AND "offset" IS NOT NULL AND units IS NOT NULL) AS metadata_valid FROM pf""")
def metadata_valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = with_field_rules(part_fields(spark, sf_dir))
    return f.select("field_id", "metadata_valid")


@register("gate_choice", f"""
WITH {_PART_FIELDS}
SELECT p_brand, p_type,
       coalesce(max(CASE WHEN name || '.' || capture = 'PCAP.GATE_DURATION.Value' THEN 'PCAP.GATE_DURATION.Value' END),
                max(CASE WHEN name || '.' || capture = 'PCAP.SAMPLES.Value' THEN 'PCAP.SAMPLES.Value' END)) AS gate_column
FROM pf GROUP BY p_brand, p_type""")
def gate_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return choose_gate(part_fields(spark, sf_dir), ["p_brand", "p_type"])


@register("rename_columns", f"""
WITH {_PART_FIELDS},
r AS (SELECT DISTINCT name, capture, lower(name) || '_' || lower(capture) AS new_name FROM pf WHERE p_size > 45)
SELECT field_id, coalesce(r.new_name, pf.name || '.' || pf.capture) AS stored_name
FROM pf LEFT JOIN r USING (name, capture)""")
def rename_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = part_fields(spark, sf_dir)
    renames = f.where(F.col("p_size") > 45).select(
        "name", "capture", F.concat(F.lower("name"), F.lit("_"), F.lower("capture")).alias("new_name")
    ).distinct()
    return renamed(f, renames).select("field_id", "stored_name")


@register("acq_gate_choice", """
SELECT DISTINCT user_id,
  CASE WHEN user_id % 5 = 0 THEN 'PCAP.GATE_DURATION.Value' ELSE 'PCAP.SAMPLES.Value' END AS gate_column
FROM events""")
def acq_gate_choice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per acquisition, the gate a gated mean divides by, from its header
    fields after the implicit-gate rule."""
    prep, index = _archive_index(spark, sf_dir)
    gates = choose_gate(record_fields(index), ["conn_id", "acq_no"])
    return gates.join(_users(prep), ["conn_id", "acq_no"]).select("user_id", "gate_column")


@register("select_columns", """SELECT event_id, round(value, 6) AS v FROM events""")
def select_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, dec = _decoded(spark, sf_dir, select=["EVENT.ID.Value", "COUNTER1.OUT.Max"])
    return dec.select(c("EVENT.ID.Value").alias("event_id"), rounded(c("COUNTER1.OUT.Max")).alias("v"))


# ----------------------------------------------------------------------------- §2.3 sinks


@register("write_read_back", f"""
WITH {_S}
SELECT event_id, i AS sample_idx,
       CASE WHEN user_id % 2 = 0 THEN round(value * 0.5 / (1 + event_id % 125) + 3.0, 6) ELSE round(value, 6) END AS v
FROM s""")
def write_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strobe.operators.sinks import read_acquisitions, write_acquisitions

    _, dec = _decoded(spark, sf_dir, calibrated=True)
    path = shared_dir(spark, "acquisitions")
    write_acquisitions(dec.drop("user_id"), path)
    back = read_acquisitions(spark, path, ["EVENT.ID.Value", "sample_idx", "COUNTER1.OUT.Mean"])
    return back.select(c("EVENT.ID.Value").alias("event_id"), "sample_idx", rounded(c("COUNTER1.OUT.Mean")).alias("v"))


@register("acquisition_attrs", f"""
WITH {_U}
SELECT user_id,
  strftime(t0 - INTERVAL 1 SECOND, '%Y-%m-%dT%H:%M:%S.%f') || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') || 'Z' AS arm_time,
  strftime(t0, '%Y-%m-%dT%H:%M:%S.%f') || lpad(CAST(user_id % 1000 AS VARCHAR), 3, '0') || 'Z' AS start_time,
  CASE WHEN user_id % 3 = 1 THEN user_id * 1001 END AS hw_time_offset_ns
FROM u""")
def acquisition_attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    h = parsed_headers(index).select(
        "conn_id", "acq_no", F.col("x.data._arm_time").alias("arm_time"),
        F.col("x.data._start_time").alias("start_time"),
        offset_ns(F.col("x.data._hw_time_offset_ns")).alias("hw_time_offset_ns"),
    )
    return h.join(_users(cap), ["conn_id", "acq_no"]).select("user_id", "arm_time", "start_time", "hw_time_offset_ns")


@register("rows_written", f"""
WITH {_U}, f AS (SELECT user_id, n, unnest(generate_series(0, (n - 1) // 10)) AS frame_no FROM u)
SELECT user_id, frame_no, least((frame_no + 1) * 10, n) AS rows_written FROM f""")
def rows_written(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    fr = index.where(F.col("kind") == "frame").select(
        "conn_id", "acq_no", "frame_no", (F.col("first_sample") + F.col("n_rows")).alias("rows_written")
    )
    return fr.join(_users(cap), ["conn_id", "acq_no"]).select("user_id", "frame_no", "rows_written")


@register("output_names", f"""
WITH {_U}
SELECT user_id, printf('/data/capture_%d.parquet', acq_no) AS file_name FROM a""")
def output_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    heads = index.where(F.col("kind") == "header").select("conn_id", "acq_no")
    return heads.join(_users(cap), ["conn_id", "acq_no"]).select(
        "user_id", F.format_string("/data/capture_%d.parquet", F.col("acq_no")).alias("file_name")
    )


@register("coalesce_frames", f"""
WITH {_S}
SELECT user_id, i // 40 AS batch_no, count(*) AS n_rows, min(i) AS first_sample FROM s GROUP BY ALL""")
def coalesce_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    fr = index.where(F.col("kind") == "frame").withColumn("batch_no", F.floor(F.col("frame_no") / 4).cast("long"))
    batches = fr.groupBy("conn_id", "acq_no", "batch_no").agg(
        F.sum("n_rows").alias("n_rows"), F.min("first_sample").alias("first_sample")
    )
    return batches.join(_users(cap), ["conn_id", "acq_no"]).select("user_id", "batch_no", "n_rows", "first_sample")


def _published(spark: SparkSession, sf_dir: str) -> tuple[cs.Prepared, str]:
    from strobe.sources.datasource import register as register_sources

    prep, index = _archive_index(spark, sf_dir)
    register_sources(spark)
    return prep, publish_index(index, shared_dir(spark, "published-index"), partition_bytes=1 << 18)


@register("dump_source_all", f"""
WITH {_U}, {_S}
SELECT user_id, event_id, i AS sample_idx, CASE WHEN user_id % 2 = 0 THEN 'Raw' ELSE 'Scaled' END AS process,
  1 + event_id % 125 AS gate, round(value, 6) AS v, (epoch_us(ts) - epoch_us(t0)) * 125 AS ticks,
  user_id % 5 = 0 AS declares_gate
FROM s JOIN u USING (user_id)""")
def dump_source_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every sample of the archive, of all its layouts, through the data source."""
    from strobe.sources.datasource import as_variant

    prep, index = _published(spark, sf_dir)
    mixed = as_variant(spark.read.format("capture_dump").option("index", index).load()).join(_users(prep), ["conn_id", "acq_no"])

    def of(name: str, kind: str):
        return F.try_variant_get("sample", f"$['{name}']", kind)

    return mixed.select(
        "user_id", of("EVENT.ID.Value", "long").alias("event_id"), "sample_idx", "process",
        F.coalesce(of(GATE_DURATION_FIELD, "long"), of(SAMPLES_FIELD, "long")).alias("gate"),
        rounded(of("COUNTER1.OUT.Mean", "double")).alias("v"), of("PCAP.TS_START.Value", "long").alias("ticks"),
        of(GATE_DURATION_FIELD, "long").isNotNull().alias("declares_gate"),
    )


def moved_id(event_id):
    """``event_id * 2^45 + 1``. From 2^18 on 64 bits do not hold that: the bits
    that leave at the top come back at the bottom, so that no two ids meet."""
    turned = F.shiftleft(event_id, 45).bitwiseOR(F.shiftrightunsigned(event_id, 19)).bitwiseXOR(F.lit(1).cast("long"))
    return F.coalesce(F.try_multiply(event_id, F.lit(1 << 45)) + 1, turned)


@register("write_typed", f"""
WITH {_U}, {_S}
SELECT event_id * 35184372088832 + 1 AS big, i AS sample_idx, 1 + event_id % 125 AS gate,
  CASE WHEN user_id % 2 = 0 THEN round((epoch_us(ts) - epoch_us(t0)) * 125 * 8e-09, 6) END AS seconds,
  CASE WHEN user_id % 2 = 1 THEN (epoch_us(ts) - epoch_us(t0)) * 125 END AS ticks,
  CASE WHEN user_id % 2 = 0 THEN 'double' ELSE 'bigint' END AS time_type
FROM s JOIN u USING (user_id)""")
def write_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each layout calibrated and written in its own types through the sink with
    a commit protocol, then read back; ids are moved above 2^53 on the way (see
    ``moved_id`` for those that the SQL's product has no room for)."""
    from strobe.operators.calibrate import calibrate_layouts
    from strobe.sources.datasource import read_layouts, read_registry

    _, index = _published(spark, sf_dir)
    layouts = read_registry(index)
    samples = calibrate_layouts(
        spark.read.format("capture_dump").option("index", index).load(), {x.column: (list(x.fields), x.process) for x in layouts}
    )
    big = "`EVENT.ID.Value`"
    for x in layouts:
        samples = samples.withColumn(x.column, F.col(x.column).withField(big, moved_id(F.col(x.column).getField("EVENT.ID.Value"))))
    path = shared_dir(spark, "typed-samples")
    samples.drop("process").write.format("capture_layouts").option("path", path).option("index", index).mode("append").save()
    out = None
    for x in layouts:
        own = read_layouts(spark, path).get(x.column)
        if own is None:
            continue
        time = c("PCAP.TS_START.Value")
        scaled = F.lit(x.process == "Raw")
        rows = own.select(
            c("EVENT.ID.Value").alias("big"), "sample_idx", gate_of(own).cast("long").alias("gate"),
            F.when(scaled, rounded(time)).alias("seconds"), F.when(~scaled, time.cast("long")).alias("ticks"), F.typeof(time).alias("time_type"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@register("stream_equals_batch", f"""
WITH {_U}, {_S}
SELECT user_id, event_id, i AS sample_idx, round(value, 6) AS v FROM s JOIN u USING (user_id)""")
def stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The archive read as a stream while it grows: the first files of each
    connection, then, from the checkpoint, all of them."""
    from strobe.streaming.reassembly import reassemble_stream
    from strobe.streaming.source import register as register_stream

    prep = cs.prepared(spark, sf_dir)
    register_stream(spark)
    root, out, checkpoint = (shared_dir(spark, f"stream-{x}") for x in ("archive", "rows", "checkpoint"))
    chunks = cut_chunks(prep.messages, 65000)
    for part in (F.col("chunk_no") < 2, F.col("chunk_no") >= 2):
        write_chunks(chunks.where(part), root).write.format("noop").mode("overwrite").save()
        rows = reassemble_stream(spark.readStream.format("capture_archive").option("path", root).load(), watch=False)
        query = rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        query.awaitTermination()
    frames = spark.read.parquet(out).withColumn("n_bytes", F.length("payload").cast("long"))
    dec = cs.decode_index(frames, from_files=False, select=["EVENT.ID.Value", "COUNTER1.OUT.Mean"]).join(_users(prep), ["conn_id", "acq_no"])
    return dec.select("user_id", c("EVENT.ID.Value").alias("event_id"), "sample_idx", rounded(c("COUNTER1.OUT.Mean")).alias("v"))


#: Payload bytes of a frame that splits records, and records of a batch.
ODD_BYTES = 101
BATCH_ROWS = 40


@register("coalesced_samples", f"""
WITH {_S}
SELECT event_id, i AS sample_idx, i // 40 AS batch_no, round(value, 6) AS v, 1 + event_id % 125 AS gate FROM s""")
def coalesced_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frame sent as frames of 101 bytes, which split the 48-byte records,
    and coalesced to batches of 40 records as content."""
    prep = cs.prepared(spark, sf_dir)
    whole = prep.messages.select("conn_id", "acq_no", "part", "seq", "data")
    split = whole.where("part = 2").withColumn("i", F.explode(F.expr(f"sequence(0, cast(ceil((length(data) - 8) / {ODD_BYTES}) as int) - 1)")))
    payload = F.expr(f"substring(data, 9 + i * {ODD_BYTES}, {ODD_BYTES})")
    size = F.unhex(F.concat(F.lpad(F.hex(F.length(payload) + 8), 2, "0"), F.lit("000000")))
    odd = split.select("conn_id", "acq_no", "part", (F.col("seq") * 64 + F.col("i")).alias("seq"), F.concat(F.lit(b"BIN ").cast("binary"), size, payload).alias("data"))
    chunks = cut_chunks(whole.where("part <> 2").unionByName(odd), 4096)
    index = materialize_index(index_archive_files(chunks, whole_frames=False))
    dec = cs.decode_index(materialize_index(coalesced(index, BATCH_ROWS)), from_files=False, select=["EVENT.ID.Value", "COUNTER1.OUT.Mean", GATE_DURATION_FIELD, SAMPLES_FIELD])
    return dec.select(
        c("EVENT.ID.Value").alias("event_id"), "sample_idx", F.col("frame_no").alias("batch_no"), rounded(c("COUNTER1.OUT.Mean")).alias("v"),
        gate_of(dec).alias("gate"),
    )


# ----------------------------------------------------------------------------- §2.5 aggregates


@register("capture_reduce", """
WITH s AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i,
                  1 + event_id % 125 AS g FROM events)
SELECT user_id, i // 10 AS bucket, round(arg_max(value, i), 6) AS v_value, round(min(value), 6) AS v_min,
       round(max(value), 6) AS v_max, round(sum(value * g) / sum(g), 6) AS v_mean
FROM s GROUP BY ALL""")
def capture_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    prep, index = _archive_index(spark, sf_dir)
    dec = cs.decode_index(index, select=["COUNTER1.OUT.Min", SAMPLES_FIELD, GATE_DURATION_FIELD])
    return reduce_decoded(dec, _users(prep))


def reduce_decoded(dec: DataFrame, users: DataFrame) -> DataFrame:
    """Reduce per (acquisition, 10-sample bucket) first -- partial aggregates
    map-side -- and attach user ids to the aggregates only."""
    s = dec.withColumn("bucket", F.floor(F.col("sample_idx") / 10).cast("long"))
    r = capture_modes(s, ["conn_id", "acq_no", "bucket"], "COUNTER1.OUT.Min", gate_of(dec), "sample_idx")
    r = r.join(users, ["conn_id", "acq_no"])
    return r.select("user_id", "bucket", *[rounded(F.col(x)).alias(x) for x in ("v_value", "v_min", "v_max", "v_mean")])


@register("acq_summary", f"""
WITH {_U}
SELECT user_id, CAST(48 AS BIGINT) AS sample_bytes, CAST(7 AS BIGINT) AS n_datasets, n AS samples, reason AS end_reason
FROM a""")
def acq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    rf = record_fields(index).groupBy("conn_id", "acq_no").agg(
        F.first("sample_bytes").cast("long").alias("sample_bytes"), F.count(F.lit(1)).alias("n_datasets")
    )
    n = index.where(F.col("kind") == "frame").groupBy("conn_id", "acq_no").agg(F.sum("n_rows").alias("samples"))
    ends = index.where(F.col("kind") == "end").select("conn_id", "acq_no", F.col("reason").alias("end_reason"))
    return (
        rf.join(n, ["conn_id", "acq_no"], "left").join(ends, ["conn_id", "acq_no"], "left")
        .join(_users(cap), ["conn_id", "acq_no"])
        .select("user_id", "sample_bytes", "n_datasets", F.coalesce("samples", F.lit(0)).alias("samples"), "end_reason")
    )


@register("throughput", f"""
WITH {_U}, d AS (SELECT user_id, n, ((epoch_us(t1) - epoch_us(t0)) * 125) * 8e-09 AS secs FROM u)
SELECT user_id, round(n * 48 / nullif(secs, 0), 3) AS bytes_per_s, round(n / nullif(secs, 0), 6) AS samples_per_s
FROM d""")
def throughput(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Record size and the scale of the time stamps come from the headers."""
    prep, index = _archive_index(spark, sf_dir)
    times = header_field_rows(index).where("name = 'PCAP.TS_START'").select("conn_id", "acq_no", "scale", "sample_bytes")
    dec = cs.decode_index(index, select=["PCAP.TS_START.Value"])
    per = dec.groupBy("conn_id", "acq_no").agg(F.count(F.lit(1)).alias("samples"), F.max(c("PCAP.TS_START.Value")).alias("last"))
    per = per.join(times, ["conn_id", "acq_no"]).join(_users(prep), ["conn_id", "acq_no"])
    rates = reduce_throughput(per.withColumn("duration_s", F.nullif(F.col("last") * F.col("scale"), F.lit(0.0))))
    return rates.select("user_id", F.round("bytes_per_s", 3).alias("bytes_per_s"), F.round("samples_per_s", 6).alias("samples_per_s"))


# ----------------------------------------------------------------------------- §2.6 windows


@register("progress", f"""
WITH {_U}, {_S}
SELECT event_id, CASE WHEN a.reason IS NULL THEN NULL ELSE round((i + 1) / a.declared, 6) END AS progress
FROM s JOIN a USING (user_id)""")
def progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    dec = cs.decode_index(index, select=["EVENT.ID.Value"])
    total = index.where(F.col("kind") == "end").select("conn_id", "acq_no", "samples")
    j = dec.join(total, ["conn_id", "acq_no"], "left")
    return j.select(
        c("EVENT.ID.Value").alias("event_id"), F.round((F.col("sample_idx") + 1) / F.col("samples"), 6).alias("progress")
    )


@register("idle_gaps", """
SELECT event_id, user_id FROM (SELECT *, ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS gap
FROM events) WHERE gap > INTERVAL 24 HOUR""")
def idle_gaps(spark: SparkSession, sf_dir: str, hours: int = 24) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "ts")
    scanned = ordered_scan(ev, ["user_id"], ["ts", "event_id"], out="pos", lag=["ts"])
    gap = F.col("ts") - F.col("prev_ts")
    return scanned.where(gap > F.expr(f"INTERVAL {hours} HOURS")).select("event_id", "user_id")


@register("schema_mismatch", f"""
WITH {_U}, m AS (SELECT user_id, acq_no, (user_id % 5 = 0) IS DISTINCT FROM
    lag(user_id % 5 = 0) OVER (PARTITION BY conn_id ORDER BY acq_no) AS mismatch FROM a)
SELECT user_id, mismatch FROM m WHERE acq_no > 1""")
def schema_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    sig = index.where(F.col("kind") == "header").select(
        "conn_id", "acq_no",
        F.concat_ws("|", F.regexp_extract("header", r'process="([^"]*)"', 1), F.regexp_extract("header", r"(?s)<fields>(.*)</fields>", 1)).alias("sig"),
    )
    scanned = ordered_scan(sig, ["conn_id"], ["acq_no"], out="k", lag=["sig"])
    return scanned.where(F.col("acq_no") > 1).join(_users(cap), ["conn_id", "acq_no"]).select(
        "user_id", (~F.col("prev_sig").eqNullSafe(F.col("sig"))).alias("mismatch")
    )


@register("overrun_quarantine", """
WITH s AS (SELECT *, (row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1) // 10 AS f FROM events),
e AS (SELECT user_id, max(f) AS lf, arg_max(event_type, ts) AS last_type, max(user_id % 4 = 3 AND user_id = (SELECT max(user_id) FROM events WHERE user_id % 4 = 3)) AS cut FROM s GROUP BY user_id)
SELECT event_id, (last_type = 'error' AND NOT cut AND user_id % 2 = 0 AND f = lf) AS suspect FROM s JOIN e USING (user_id)""")
def overrun_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    frames = index.where(F.col("kind") == "frame")
    last = frames.groupBy("conn_id", "acq_no").agg(F.max("frame_no").alias("last_frame"))
    ends = index.where(F.col("kind") == "end").select("conn_id", "acq_no", "reason")
    dec = cs.decode_index(index, select=["EVENT.ID.Value"])
    j = dec.join(last, ["conn_id", "acq_no"]).join(ends, ["conn_id", "acq_no"], "left")
    suspect = (
        F.coalesce(F.col("reason") == "Data overrun", F.lit(False))
        & (F.col("process") == "Raw")
        & (F.col("frame_no") == F.col("last_frame"))
    )
    return j.select(c("EVENT.ID.Value").alias("event_id"), suspect.alias("suspect"))


# ----------------------------------------------------------------------------- §2.12 quality


@register("overrun_guard", f"""
WITH {_U}
SELECT user_id, n AS rows_stored FROM a WHERE reason = 'Data overrun'""")
def overrun_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The guard fails after the rows are stored; what is stored of the
    acquisitions that overran is counted from the files."""
    cap, index = _archive_index(spark, sf_dir)
    path = shared_dir(spark, "guarded-samples")
    write_acquisitions(cs.decode_index(index, calibrated=True).drop("process", "frame_no"), path, presorted=True, layout="clustered")
    ends = index.where(F.col("kind") == "end")
    overrun = ends.where(F.col("reason") == "Data overrun").select("conn_id", "acq_no")
    try:
        guard_overruns(ends)
        raised = False
    except DataOverrunError:
        raised = True
    if raised == overrun.isEmpty():
        raise RuntimeError("the overrun guard does not agree with the end records")
    stored = spark.read.parquet(path).groupBy("conn_id", "acq_no").agg(F.count(F.lit(1)).alias("rows_stored"))
    return overrun.join(stored, ["conn_id", "acq_no"]).join(_users(cap), ["conn_id", "acq_no"]).select("user_id", "rows_stored")


@register("count_reconcile", f"""
WITH {_U}
SELECT user_id, declared, n AS decoded, declared - n AS diff FROM a WHERE reason IS NOT NULL AND declared <> n""")
def count_reconcile(spark: SparkSession, sf_dir: str) -> DataFrame:
    prep, index = _archive_index(spark, sf_dir)
    dec = cs.decode_index(index, select=["EVENT.ID.Value"])
    ends = index.where(F.col("kind") == "end").select("conn_id", "acq_no", F.col("samples").alias("declared"))
    got = dec.groupBy("conn_id", "acq_no").agg(F.count(F.lit(1)).alias("decoded"))
    j = got.join(ends, ["conn_id", "acq_no"]).join(_users(prep), ["conn_id", "acq_no"])
    return j.where(F.col("declared") != F.col("decoded")).select(
        "user_id", "declared", "decoded", (F.col("declared") - F.col("decoded")).alias("diff")
    )


@register("missed_samples", """
SELECT DISTINCT user_id, user_id % 5 AS missed FROM events WHERE user_id % 5 > 0""")
def missed_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    h = parsed_headers(index).select("conn_id", "acq_no", F.col("x.data._missed").alias("missed"))
    return h.where(F.col("missed") > 0).join(_users(cap), ["conn_id", "acq_no"]).select("user_id", "missed")


@register("unterminated", """
SELECT max(user_id) AS user_id FROM events WHERE user_id % 4 = 3""")
def unterminated(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    heads = index.where(F.col("kind") == "header").select("conn_id", "acq_no")
    ends = index.where(F.col("kind") == "end").select("conn_id", "acq_no")
    return heads.join(ends, ["conn_id", "acq_no"], "left_anti").join(_users(cap), ["conn_id", "acq_no"]).select("user_id")


@register("rejects", """
SELECT DISTINCT CAST(2 AS BIGINT) AS conn_id, CAST(2 AS BIGINT) AS acq_no, 'bad marker b''BAD ''' AS message,
       CAST(2 AS BIGINT) AS headers_before
FROM events WHERE user_id % 4 = 2""")
def rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    prep = cs.prepared(spark, sf_dir)
    bad = (F.col("conn_id") == 2) & (F.col("acq_no") == 2) & (F.col("part") == 2) & (F.col("seq") == 0)
    # same length, so the stream layout (offsets) is unchanged
    corrupted = prep.messages.withColumn(
        "data",
        F.when(bad, F.concat(F.lit(b"BAD ").cast("binary"), F.expr("substring(data, 5)"))).otherwise(F.col("data")),
    )
    index = materialize_index(index_archive_files(cut_chunks(corrupted, 997)))
    rej = index.where(F.col("kind") == "reject").select("conn_id", "acq_no", "message", F.col("pos").alias("at"))
    heads = index.where(F.col("kind") == "header").select("conn_id", F.col("pos").alias("head"))
    before = rej.join(heads, "conn_id").where("head < at")
    return before.groupBy("conn_id", "acq_no", "message").agg(F.count(F.lit(1)).alias("headers_before"))


# ----------------------------------------------------------------------------- §2.4 joins


@register("capture_diff", """
SELECT event_id, round(value, 6) AS before, round(value + 1, 6) AS after FROM events WHERE event_id % 50 = 0""")
def capture_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    changed = ev.withColumn("value", F.when(F.col("event_id") % 50 == 0, F.col("value") + 1).otherwise(F.col("value")))
    out = []
    for events in (ev, changed):
        cap = cs.build(spark, sf_dir, events=events)
        index = materialize_index(index_archive_files(cut_chunks(cap.messages, 4096)))
        out.append(cs.decode_index(index, from_files=False, select=["EVENT.ID.Value", "COUNTER1.OUT.Mean"]))
    key = ["conn_id", "acq_no", "sample_idx"]
    a = out[0].select(*key, c("EVENT.ID.Value").alias("event_id"), c("COUNTER1.OUT.Mean").alias("before"))
    b = out[1].select(*key, c("EVENT.ID.Value").alias("event_id_b"), c("COUNTER1.OUT.Mean").alias("after"))
    j = a.join(b, key, "full_outer")
    diff = ~(F.col("before").eqNullSafe(F.col("after")) & F.col("event_id").eqNullSafe(F.col("event_id_b")))
    return j.where(diff).select(
        F.coalesce("event_id", "event_id_b").alias("event_id"), rounded(F.col("before")).alias("before"),
        rounded(F.col("after")).alias("after"),
    )


#: Samples of a fingerprinted block.
DIFF_BLOCK = 16


@register("capture_diff_blocks", """
SELECT event_id, round(value, 6) AS before, round(value + 1, 6) AS after FROM events WHERE user_id % 10 = 3 AND event_id % 5 = 0""")
def capture_diff_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored captures compared by their block fingerprints; frames of
    equal blocks are not decoded again."""
    from strobe.operators.compare import compare_blocks, differing_blocks, fingerprints, frames_of

    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    moved = (F.col("user_id") % 10 == 3) & (F.col("event_id") % 5 == 0)
    changed = ev.withColumn("value", F.when(moved, F.col("value") + 1).otherwise(F.col("value")))
    columns = ["EVENT.ID.Value", "COUNTER1.OUT.Mean", "PCAP.TS_START.Value"]
    marks, indexes = [], []
    for events in (None, changed):
        if events is None:
            index, files = _archive_index(spark, sf_dir)[1], True
        else:
            index, files = materialize_index(index_archive_files(cut_chunks(cs.build(spark, sf_dir, events=events).messages, 4096))), False
        indexes.append((index, files))
        path = shared_dir(spark, "fingerprints")
        fingerprints(cs.decode_index(index, select=columns, from_files=files), columns, DIFF_BLOCK).write.parquet(path)
        marks.append(spark.read.parquet(path))
    blocks = materialize_index(differing_blocks(*marks))
    sides = [cs.decode_index(frames_of(index, blocks, DIFF_BLOCK), select=columns, from_files=files) for index, files in indexes]
    diff = compare_blocks(*sides, blocks, columns, DIFF_BLOCK)

    def of(side: str, name: str):
        return F.col(side).getField(name)

    return diff.select(
        F.coalesce(of("before", columns[0]), of("after", columns[0])).alias("event_id"),
        rounded(of("before", columns[1])).alias("before"), rounded(of("after", columns[1])).alias("after"),
    )


@register("calibrate_long", """
SELECT event_id, 'COUNTER1.OUT.Mean' AS "column",
       CASE WHEN user_id % 2 = 0 THEN round(value * 0.5 / (1 + event_id % 125) + 3.0, 6) ELSE round(value, 6) END AS v FROM events
UNION ALL
SELECT event_id, 'COUNTER1.OUT.Min', CASE WHEN user_id % 2 = 0 THEN round(value * 0.5 + 3.0, 6) ELSE round(value, 6) END FROM events
UNION ALL
SELECT event_id, 'COUNTER1.OUT.Max', round(value, 6) FROM events
UNION ALL
SELECT event_id, 'PCAP.BITS0.Value', CAST(event_id AS DOUBLE) FROM events
UNION ALL
SELECT event_id, 'EVENT.ID.Value', CAST(event_id AS DOUBLE) FROM events
UNION ALL
SELECT event_id, 'PCAP.TS_START.Value', CASE WHEN user_id % 2 = 0 THEN round(ticks * 8e-09, 6) ELSE CAST(ticks AS DOUBLE) END
FROM (SELECT event_id, user_id, (epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY user_id)) * 125 AS ticks FROM events)
UNION ALL
SELECT event_id, 'PCAP.GATE_DURATION.Value', CAST(1 + event_id % 125 AS DOUBLE) FROM events WHERE user_id % 5 = 0""")
def calibrate_long_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    dec = cs.decode_index(index)
    cols = [f.column for f in cs.DECLARED_B]  # all that a header declares in any layout
    stacked = dec.select(
        "conn_id", "acq_no", "sample_idx", c("EVENT.ID.Value").alias("event_id"),
        gate_of(dec).alias("gate"),
        F.explode(F.array(*[F.struct(F.lit(x).alias("column"), c(x).cast("double").alias("value")) for x in cols])).alias("kv"),
    ).select("*", "kv.column", "kv.value").drop("kv").where("value IS NOT NULL")
    fields = header_field_rows(index).withColumn("column", F.concat_ws(".", "name", "capture"))
    out = calibrate_long(stacked, fields, ["conn_id", "acq_no"])
    return out.select("event_id", "column", rounded(F.col("calibrated")).alias("v"))


@register("named_bits", """
SELECT event_id, CAST(b AS BIGINT) AS bit, ((event_id >> b) & 1) = 1 AS is_set FROM events, range(0, 32) r(b)""")
def named_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strobe.operators.packed import bits_to_rows

    _, dec = _decoded(spark, sf_dir, select=["EVENT.ID.Value", "PCAP.BITS0.Value"])
    labels = spark.range(0, 32).select(F.col("id").alias("bit"), F.format_string("BIT%d", F.col("id")).alias("label"))
    rows = bits_to_rows(dec.select(c("EVENT.ID.Value").alias("event_id"), c("PCAP.BITS0.Value").alias("word")), "word", labels)
    return rows.select("event_id", "bit", "is_set")


# ----------------------------------------------------------------------------- §2.11 time


@register("system_start", f"""
WITH {_U}
SELECT user_id, epoch_us(t0) * 1000 + user_id % 1000 + CASE WHEN user_id % 3 = 1 THEN user_id * 1001 ELSE 0 END
       AS system_start_ns FROM u""")
def system_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    cap, index = _archive_index(spark, sf_dir)
    h = parsed_headers(index).select(
        "conn_id", "acq_no",
        system_start_ns(F.col("x.data._start_time"), offset_ns(F.col("x.data._hw_time_offset_ns"))).alias("system_start_ns"),
    )
    return h.join(_users(cap), ["conn_id", "acq_no"]).select("user_id", "system_start_ns")


@register("absolute_times", f"""
WITH {_U}
SELECT event_id, epoch_us(t0) * 1000 + user_id % 1000
       + CAST(round(((((epoch_us(ts) - epoch_us(t0)) * 125) * 8e-09) + 0.0) * 1e9) AS BIGINT) AS abs_ns
FROM events JOIN u USING (user_id) WHERE user_id % 2 = 0""")
def absolute_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strobe.operators.timebase import absolute_ns

    cap, index = _archive_index(spark, sf_dir)
    dec = cs.decode_index(index, calibrated=True, select=["EVENT.ID.Value", "PCAP.TS_START.Value"])
    starts = parsed_headers(index).select("conn_id", "acq_no", iso_to_epoch_ns(F.col("x.data._start_time")).alias("start_ns"))
    j = dec.where(F.col("process") == "Raw").join(starts, ["conn_id", "acq_no"])
    return j.select(c("EVENT.ID.Value").alias("event_id"), absolute_ns(F.col("start_ns"), c("PCAP.TS_START.Value")).alias("abs_ns"))
