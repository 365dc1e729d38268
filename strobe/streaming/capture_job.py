"""Streaming capture job: chunk files arriving in a folder -> calibrated
samples appended to Parquet, one commit per micro-batch.

The trigger interval is the flush period: frames that completed during the
interval are decoded and appended together, so readers see each acquisition
grow batch by batch (incremental append). Each micro-batch writes under its
own ``batch=<id>`` folder in overwrite mode, so a retried batch replaces its
own output instead of duplicating it.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strobe.operators.calibrate import calibrate
from strobe.sources.capture_format import fields_from_json
from strobe.sources.captures import decode_payloads
from strobe.streaming.reassembly import reassemble_stream

CHUNK_SCHEMA = "conn_id long, chunk_no long, data binary"


def _write_batch(out: str):
    def run(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            frames = batch.where(F.col("kind") == "frame")
            # one write for each layout of the batch
            for row in frames.select("layout", "process").distinct().toLocalIterator():
                layout, process = row["layout"], row["process"]
                fields = fields_from_json(layout)
                sig = hashlib.sha1(f"{process}|{layout}".encode()).hexdigest()[:12]
                part = frames.where((F.col("layout") == layout) & (F.col("process") == process))
                dec = decode_payloads(
                    part.select("conn_id", "acq_no", "frame_no", "process", "first_sample", "payload"),
                    fields, keep=["conn_id", "acq_no", "frame_no", "process"],
                )
                calibrate(dec, fields, process).write.mode("overwrite").parquet(
                    f"{out}/samples/sig={sig}/batch={batch_id}"
                )
            batch.where(F.col("kind") != "frame").drop("payload").write.mode("overwrite").parquet(
                f"{out}/messages/batch={batch_id}"
            )
        finally:
            batch.unpersist()

    return run


def start_capture_stream(
    spark: SparkSession,
    source: str,
    out: str,
    checkpoint: str,
    flush_period: str | None = "1 second",
    available_now: bool = False,
    max_files_per_trigger: int | None = None,
    max_acquisitions: int = 0,
    idle_timeout_ms: int = 0,
):
    """Start the stream; returns the StreamingQuery.

    Per-connection state lives in the RocksDB state store (off the JVM heap,
    so many connections do not pressure executor memory).
    """
    reader = spark.readStream.schema(CHUNK_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reassemble_stream(reader.parquet(source), max_acquisitions, idle_timeout_ms, watch=not available_now)
    writer = rows.writeStream.foreachBatch(_write_batch(out)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=flush_period)
    return writer.start()


def read_samples(spark: SparkSession, out: str, sig: str | None = None) -> DataFrame:
    """Samples written so far (one signature folder, or all with merged schema)."""
    path = f"{out}/samples" + (f"/sig={sig}" if sig else "")
    return spark.read.option("mergeSchema", "true").parquet(path)
