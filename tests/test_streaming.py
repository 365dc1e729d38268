"""Structured Streaming: stream results equal batch results for any cut."""

import datetime
import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from dumpkit import SCALED_FIELDS, acquisition, fast_values, stream
from strobe.functions.columns import c
from strobe.sources.dumps import decode_index, index_chunks
from strobe.streaming.changes import latest_values_stream
from strobe.streaming.reassembly import PushParser, Reassembler, decode_stream, reassemble_stream
from strobe.streaming.windows import windowed_capture_modes

CHUNK_SCHEMA = "conn_id long, chunk_no long, data binary"


def _data():
    return stream(
        acquisition(SCALED_FIELDS, fast_values(), [10, 11, 10, 10, 10, 7], end=("Ok", 58)),
        acquisition(SCALED_FIELDS, fast_values(20), [20], end=("Disarmed", 20)),
        acquisition(SCALED_FIELDS, fast_values(5), [5], end=None),
    )


def _write_chunk_files(spark, folder, data, size, conns=(0, 1), files=5):
    rows = []
    for conn in conns:
        rows += [(conn, i, data[o : o + size]) for i, o in enumerate(range(0, len(data), size))]
    rows.sort(key=lambda r: (r[1], r[0]))
    per = max(1, len(rows) // files)
    for k in range(0, len(rows), per):
        spark.createDataFrame(rows[k : k + per], CHUNK_SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _run_stream(spark, src, out, ckpt, max_files, **kw):
    s = spark.readStream.schema(CHUNK_SCHEMA).option("maxFilesPerTrigger", max_files).parquet(src)
    q = (
        reassemble_stream(s, watch=False, **kw).writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", ckpt).trigger(availableNow=True).start()
    )
    q.awaitTermination(300)
    return spark.read.parquet(out)


def test_push_parser_any_cut():
    data = _data()
    whole = PushParser().feed(data)
    for size in (1, 7, 64, 1000):
        p, rows = PushParser(), []
        for o in range(0, len(data), size):
            rows += p.feed(data[o : o + size])
        assert [(r["kind"], r["acq_no"], r.get("frame_no")) for r in rows] == [
            (r["kind"], r["acq_no"], r.get("frame_no")) for r in whole]
    assert sum(r.get("n_rows") or 0 for r in whole if r["kind"] == "frame") == 83


def test_push_parser_goes_on_behind_rejects():
    data = _data()
    bad = data.replace(b"BIN ", b"BAD ", 2)
    for size in (5, 64, 1 << 20):
        p, rows = PushParser(), []
        for o in range(0, len(bad), size):
            rows += p.feed(bad[o : o + size])
        kinds = [r["kind"] for r in rows]
        assert kinds.count("header") == 3 and kinds.count("reject") == 1
        assert sum(r["n_rows"] for r in rows if r["kind"] == "frame" and r["acq_no"] > 1) == 25


def test_push_parser_keeps_nothing_after_the_stop():
    p = PushParser(max_acquisitions=1)
    p.feed(_data())
    assert p.phase == "stopped" and p.pending == b""
    assert p.feed(b"x" * 5000) == [] and p.pending == b""


def test_push_parser_is_linear_in_a_large_chunk():
    data = stream(acquisition(SCALED_FIELDS, fast_values(), [58], end=None))
    head = data[: data.find(b"BIN ")]
    record = (data[data.find(b"BIN ") :])[8:60]
    frame = b"BIN " + (8 + 2 * len(record)).to_bytes(4, "little") + record * 2
    big = head + frame * ((8 << 20) // len(frame))
    t = time.time()
    rows = PushParser().feed(big)
    assert len(rows) == 1 + (8 << 20) // len(frame)
    assert time.time() - t < 5


class _Value:
    def __init__(self):
        self.value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value


class _Map:
    def __init__(self):
        self.held = {}

    def containsKey(self, key):
        return key in self.held

    def getValue(self, key):
        return self.held.get(key)

    def updateValue(self, key, value):
        self.held[key] = value

    def removeKey(self, key):
        self.held.pop(key)

    def keys(self):
        return iter(list(self.held))

    def clear(self):
        self.held.clear()


class _Handle:
    """State, timers and a clock as a stateful processor sees them."""

    def __init__(self):
        self.now, self.timers = 1000, set()

    def getValueState(self, name, schema):
        return _Value()

    def getMapState(self, name, key, value, ttl=None):
        return _Map()

    def registerTimer(self, at):
        self.timers.add(at)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def getCurrentProcessingTimeInMs(self):
        return self.now

    def getExpiryTimeInMs(self):
        return self.now


def _processor(**kw):
    given = {"by_position": False, "max_acquisitions": 0, "idle_timeout_ms": 0, "retention_ms": 500, "remember_ms": 10_000}
    handle, p = _Handle(), Reassembler(**given | kw)
    p.init(handle)
    order = "start" if p.by_position else "chunk_no"

    def feed(*chunks):
        pdf = pd.DataFrame({order: [c[0] for c in chunks], "data": [c[1] for c in chunks]})
        return [r for f in p.handleInputRows((7,), iter([pdf]), handle) for r in f.to_dict("records")]

    def wait(ms):
        """Time passes; timers that are due fire at their time."""
        until, rows = handle.now + ms, []
        while due := [t for t in handle.timers if t <= until]:
            handle.now = min(due)
            handle.timers.discard(handle.now)
            rows += [r for f in p.handleExpiredTimer((7,), handle, handle) for r in f.to_dict("records")]
        handle.now = until
        return rows

    return p, handle, feed, wait


def _plain(rows):
    return [(r["kind"], r["acq_no"], None if pd.isna(r.get("frame_no")) else r.get("frame_no")) for r in rows]


def test_idle_event_keeps_the_state():
    data = _data()
    _, handle, feed, wait = _processor(idle_timeout_ms=500)
    rows = feed((0, data[:700]))
    idle = wait(1200)
    assert [r["kind"] for r in idle] == ["idle", "idle"] and len(handle.timers) == 1
    rows += feed((1, data[700:]))
    assert _plain(rows) == _plain(PushParser().feed(data))


def test_early_chunks_wait_however_many_there_are():
    data = _data()
    parts = [data[o : o + 60] for o in range(0, len(data), 60)]
    p, handle, feed, wait = _processor()
    rows = feed((0, parts[0]), *[(i, x) for i, x in reversed(list(enumerate(parts))) if i > 1])
    assert len(p.early.held) == len(parts) - 2 and wait(400) == []
    rows += feed((1, parts[1]))  # late, but within the retention
    assert _plain(rows) == _plain(PushParser().feed(data)) and not p.early.held
    wait(1000)
    assert feed((1, parts[1])) == []  # a copy of what has been read


def test_gap_is_given_up_after_the_retention_and_late_bytes_are_kept():
    data = _data()
    parts = [data[o : o + 600] for o in range(0, len(data), 600)]
    p, handle, feed, wait = _processor()
    rows = feed(*[(i, x) for i, x in enumerate(parts) if i != 1])
    after = wait(600)
    (reject,) = [r for r in after if r["kind"] == "reject"]
    assert reject["message"] == "chunks 1 to 1 are missing"
    assert {r["acq_no"] for r in rows + after if r["kind"] == "header"} >= {1, 2}
    (late,) = feed((1, parts[1]))
    assert late["kind"] == "late" and late["payload"] == parts[1] and not p.early.held


def test_chunks_by_position_for_any_cut_and_order():
    data = _data()
    cuts = [0, 5, 700, 701, 1500, 2900, len(data)]
    parts = [(a, data[a:b]) for a, b in zip(cuts, cuts[1:])]
    _, _, feed, _ = _processor(by_position=True)
    rows = [r for x in [*parts[3:], *parts[:3], parts[1]] for r in feed(x)]
    assert _plain(rows) == _plain(PushParser().feed(data))


def test_stop_clears_what_waits():
    data = _data()
    p, _, feed, _ = _processor(max_acquisitions=1)
    feed((5, b"x" * 100), (0, data))
    assert p.parser.get()[0] == "stopped" and not p.early.held


def test_header_without_an_end_is_searched_once():
    p, t = PushParser(), time.time()
    p.feed(b"OK\n<header>\n")
    for _ in range(256):
        p.feed(b"<x />\n" * 3000)
    assert time.time() - t < 20 and p.searched > 4_000_000
    rows = p.feed(b"</header>\n\n")
    assert [r["kind"] for r in rows] == ["reject"]


@pytest.mark.parametrize("max_files,size", [(1, 97), (3, 1000)])
def test_stream_equals_batch(spark, tmp_path, max_files, size):
    data = _data()
    src = str(tmp_path / "src")
    _write_chunk_files(spark, src, data, size)
    out = _run_stream(spark, src, str(tmp_path / "out"), str(tmp_path / "ckpt"), max_files)
    dec = decode_stream(out, SCALED_FIELDS, "Scaled")
    got = sorted(tuple(r) for r in dec.select("conn_id", "acq_no", "sample_idx", c("COUNTER3.OUT.Value")).collect())
    chunks = spark.read.parquet(src)
    batch = decode_index(index_chunks(chunks), from_files=False)
    want = sorted(tuple(r) for r in batch.select("conn_id", "acq_no", "sample_idx", c("COUNTER3.OUT.Value")).collect())
    assert got == want and len(got) == 2 * 83
    ends = out.where("kind = 'end'").count()
    assert ends == 4  # the third acquisition of each connection has no end record


def test_archive_stream_goes_on_from_its_checkpoint(spark, tmp_path):
    """Files are added, and the last one grows, between two runs."""
    from strobe.streaming.source import register

    register(spark)
    data, root = _data(), tmp_path / "arch"
    for conn in (0, 3):
        (root / f"conn={conn}").mkdir(parents=True)
        (root / f"conn={conn}" / "chunk-000000000.bin").write_bytes(data[:900])
    (root / "conn=0" / "chunk-000000001.bin").write_bytes(data[900:1300])
    (root / "conn=0" / "chunk-000000003.bin").write_bytes(data[2500:])  # behind a hole

    def run():
        s = spark.readStream.format("capture_archive").option("path", str(root)).option("partitionBytes", 256).load()
        q = (reassemble_stream(s, watch=False).writeStream.format("parquet").option("path", str(tmp_path / "out"))
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination(300)
        return spark.read.parquet(str(tmp_path / "out")).collect()

    first = run()
    (root / "conn=0" / "chunk-000000001.bin").write_bytes(data[900:1400])
    (root / "conn=0" / "chunk-000000002.bin").write_bytes(data[1400:2500])
    (root / "conn=3" / "chunk-000000001.bin").write_bytes(data[900:])
    rows = run()
    want = sorted(map(str, _plain(PushParser().feed(data))))
    for conn in (0, 3):
        assert sorted(str((r.kind, r.acq_no, r.frame_no)) for r in rows if r.conn_id == conn) == want
    assert 0 < len(first) < len(rows)


def test_stream_stops_after_n_acquisitions(spark, tmp_path):
    src = str(tmp_path / "src")
    _write_chunk_files(spark, src, _data(), 500, conns=(0,))
    out = _run_stream(spark, src, str(tmp_path / "out"), str(tmp_path / "ckpt"), 2, max_acquisitions=1)
    assert {r[0] for r in out.select("acq_no").distinct().collect()} == {1}


def test_idle_timeout_emits_idle_row(spark, tmp_path):
    src = str(tmp_path / "src")
    data = _data()
    spark.createDataFrame([(0, 0, data[:300])], CHUNK_SCHEMA).write.parquet(src)
    s = spark.readStream.schema(CHUNK_SCHEMA).parquet(src)
    name = f"idle_{os.getpid()}"
    q = (
        reassemble_stream(s, idle_timeout_ms=500).writeStream.format("memory").queryName(name)
        .option("checkpointLocation", str(tmp_path / "ckpt")).outputMode("append")
        .trigger(processingTime="300 milliseconds").start()
    )
    try:
        deadline = time.time() + 60
        idle = 0
        while time.time() < deadline and idle == 0:
            time.sleep(1)
            idle = spark.sql(f"SELECT count(*) FROM {name} WHERE kind = 'idle'").collect()[0][0]
        assert idle == 1
    finally:
        q.stop()


def test_streaming_latest_values_match_batch(spark, tmp_path):
    from strobe.operators.state import latest_values

    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    lines = ev.select(
        "user_id", F.col("event_id").alias("seq"),
        F.concat(F.col("event_type"), F.lit("="), F.format_string("%.2f", "value")).alias("line"),
    )
    src = str(tmp_path / "lines")
    lines.repartition(6).write.parquet(src)
    seen = {}

    def upsert(batch, _id):
        for r in batch.collect():
            seen[(r["user_id"], r["field"])] = r["latest"]

    s = spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (
        latest_values_stream(s, ["user_id"], "seq").writeStream.outputMode("update").foreachBatch(upsert)
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    )
    q.awaitTermination(300)
    parsed = lines.select("user_id", "seq", F.split("line", "=")[0].alias("field"), F.split("line", "=")[1].alias("value"))
    want = {(r["user_id"], r["field"]): r["latest"] for r in latest_values(parsed, ["user_id", "field"], "seq").collect()}
    assert seen == want


def test_windowed_reduction_matches_batch(spark, tmp_path):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select(
        "user_id", F.col("ts").cast("timestamp").alias("ts"), "value", (1 + F.col("event_id") % 125).alias("g"), "event_id"
    )
    src = str(tmp_path / "samples")
    # files arrive in event-time order: nothing falls behind the watermark
    ordered = ev.withColumn("part", F.when(F.col("ts") < F.lit("2024-01-08"), 0).when(F.col("ts") < F.lit("2024-01-16"), 1)
                            .when(F.col("ts") < F.lit("2024-01-24"), 2).otherwise(3))
    for k in range(4):
        ordered.where(F.col("part") == k).drop("part").coalesce(1).write.mode("append").parquet(src)
    seen = {}

    def upsert(batch, _id):
        for r in batch.collect():
            seen[(r["user_id"], r["window"]["start"])] = (r["v_value"], r["v_min"], r["v_max"], round(r["v_mean"], 9))

    schema = ev.schema
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
    agg = windowed_capture_modes(s, ["user_id"], "ts", "value", "g", "1 day", "1 hour", order="ts")
    q = (
        agg.writeStream.outputMode("update").foreachBatch(upsert)
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    )
    q.awaitTermination(300)
    batch = ev.groupBy("user_id", F.window("ts", "1 day").alias("window")).agg(
        F.max_by("value", "ts").alias("v_value"), F.min("value").alias("v_min"), F.max("value").alias("v_max"),
        (F.sum(F.col("value") * F.col("g")) / F.sum("g")).alias("v_mean"),
    )
    want = {(r["user_id"], r["window"]["start"]): (r["v_value"], r["v_min"], r["v_max"], round(r["v_mean"], 9))
            for r in batch.collect()}
    assert seen == want


def test_windowed_reduction_drops_late_rows(spark, tmp_path):
    schema = "user_id long, ts timestamp, value double, g long, event_id long"
    src = str(tmp_path / "late")
    rows = []

    def run_once():
        s = spark.readStream.schema(schema).parquet(src)
        agg = windowed_capture_modes(s, ["user_id"], "ts", "value", "g", "1 day", "1 hour", order="ts")
        q = (agg.writeStream.outputMode("update").foreachBatch(lambda b, i: rows.extend(b.collect()))
             .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start())
        q.awaitTermination(300)

    spark.createDataFrame([(1, datetime.datetime(2024, 1, 10, 12), 5.0, 1, 1)], schema).write.parquet(src)
    run_once()
    # a row nine days behind the watermark, arriving after it advanced
    spark.createDataFrame([(1, datetime.datetime(2024, 1, 1, 12), 99.0, 1, 2)], schema).write.mode("append").parquet(src)
    run_once()
    assert [r["v_max"] for r in rows] == [5.0]


def test_streaming_capture_job_appends_calibrated_samples(spark, tmp_path):
    from strobe.streaming.capture_job import read_samples, start_capture_stream

    data = _data()
    src = str(tmp_path / "src")
    _write_chunk_files(spark, src, data, 211)
    out = str(tmp_path / "out")
    q = start_capture_stream(spark, src, out, str(tmp_path / "ckpt"), available_now=True, max_files_per_trigger=2)
    q.awaitTermination(300)
    got = read_samples(spark, out)
    assert got.count() == 2 * 83
    assert got.select("batch").distinct().count() > 1  # appended over several micro-batches
    want = sorted(tuple(r) for r in decode_index(index_chunks(spark.read.parquet(src)), from_files=False, calibrated=True)
                  .select("conn_id", "acq_no", "sample_idx", c("COUNTER1.OUT.Mean")).collect())
    assert sorted(tuple(r) for r in got.select("conn_id", "acq_no", "sample_idx", c("COUNTER1.OUT.Mean")).collect()) == want
