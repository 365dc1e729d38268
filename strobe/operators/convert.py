"""Archive conversion: capture archive -> calibrated per-acquisition datasets.

The batch form of the capture-to-file job: list chunk files, build the frame
index (sequential walk for small connections, parallel over blocks for
large ones; kept as a table), decode and calibrate every layout, write the
samples in (acquisition, sample) order -- clustered by acquisition by default,
or one directory per acquisition -- write the acquisitions table (header
attributes and end records), then fail if any acquisition ended by data
overrun, after its rows are stored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strobe.operators.sinks import guard_overruns, write_acquisitions
from strobe.operators.timebase import offset_ns
from strobe.sources.dumps import decode_index, list_chunks, materialize_index
from strobe.sources.parallel_index import index_archive_files

HEADER_ATTRS = (
    "data struct<_missed: bigint, _process: string, _format: string, _sample_bytes: bigint, "
    "_arm_time: string, _start_time: string, _hw_time_offset_ns: string>"
)


@dataclass
class Converted:
    index: DataFrame
    acquisitions: DataFrame
    samples_path: str
    samples: int
    rejects: DataFrame
    lost_bytes: int


def acquisitions_table(index: DataFrame) -> DataFrame:
    """One row per acquisition: header attributes, frame totals, end record."""
    heads = index.where(F.col("kind") == "header").select(
        "conn_id", "acq_no", F.from_xml("header", HEADER_ATTRS, {"attributePrefix": "_"}).alias("x")
    ).select(
        "conn_id", "acq_no",
        F.col("x.data._process").alias("process"), F.col("x.data._missed").alias("missed"),
        F.col("x.data._sample_bytes").alias("sample_bytes"), F.col("x.data._arm_time").alias("arm_time"),
        F.col("x.data._start_time").alias("start_time"),
        offset_ns(F.col("x.data._hw_time_offset_ns")).alias("hw_time_offset_ns"),
    )
    frames = index.where(F.col("kind") == "frame").groupBy("conn_id", "acq_no").agg(
        F.count(F.lit(1)).alias("frames"), F.sum("n_rows").alias("rows")
    )
    ends = index.where(F.col("kind") == "end").select(
        "conn_id", "acq_no", F.col("samples").alias("end_samples"), F.col("reason").alias("end_reason")
    )
    return heads.join(frames, ["conn_id", "acq_no"], "left").join(ends, ["conn_id", "acq_no"], "left")


def convert_archive(
    spark: SparkSession,
    root: str,
    out: str,
    check_overrun: bool = True,
    partitions: int | None = None,
    layout: str = "clustered",
    fail_on_rejects: bool = False,
) -> Converted:
    """Convert an archive. Bytes that could not be read are listed in the
    ``rejects`` table (connection, acquisition, position, length, message);
    ``fail_on_rejects`` raises on them after everything readable is stored."""
    index = materialize_index(index_archive_files(list_chunks(spark, root)), out.rstrip("/") + "/_index")
    acq = acquisitions_table(index)
    acq.write.mode("overwrite").parquet(out.rstrip("/") + "/acquisitions")
    samples = decode_index(index, calibrated=True, partitions=partitions).drop("process", "frame_no")
    path = out.rstrip("/") + "/samples"
    write_acquisitions(samples, path, presorted=True, layout=layout)
    total = index.where(F.col("kind") == "frame").agg(F.sum("n_rows")).collect()[0][0] or 0
    rejects_path = out.rstrip("/") + "/rejects"
    index.where(F.col("kind") == "reject").select(
        "conn_id", "acq_no", "pos", F.col("n_bytes").alias("lost_bytes"), "message"
    ).write.mode("overwrite").parquet(rejects_path)
    rejects = spark.read.parquet(rejects_path)
    n_rejects, lost = rejects.agg(F.count(F.lit(1)), F.coalesce(F.sum("lost_bytes"), F.lit(0))).collect()[0]
    if check_overrun:
        guard_overruns(index.where(F.col("kind") == "end"))
    if fail_on_rejects and n_rejects:
        raise ValueError(f"{n_rejects} unreadable stretches of {lost} bytes, listed in {rejects_path}")
    return Converted(index, spark.read.parquet(out.rstrip("/") + "/acquisitions"), path, int(total), rejects, int(lost))
