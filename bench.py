"""Benchmark: capture archive decode throughput and headline queries.

Runs on local[$BENCH_CPUS] against $BENCH_SF_DIR (default /root/testdata/sf0.1)
and prints one JSON line. The throughput figure comparable to the reference's
published live-link rates (0.83-1.0 million 60-byte samples/s on one client)
is archive index + decode + calibrate + Parquet write, in samples/s, over a
capture archive of about $BENCH_SAMPLES samples that Spark derives from the
``events`` table (each event replicated into several acquisitions).
"""

from __future__ import annotations

import json
import math
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

HEADLINE = [
    "capture_reduce",
    "calibrate_gated_mean",
    "dump_roundtrip",
    "chunk_reassembly",
    "sample_positions",
    "idle_gaps",
    "unpack_table",
    "pack_table",
    "base64_words",
    "state_lines",
    "statements",
    "reply_values",
    "pair_requests",
    "latest_values",
    "snapshot_changes",
    "typed_fields",
]


def session(cpus: int) -> SparkSession:
    scratch = tempfile.mkdtemp(prefix="strobe-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("strobe-bench")
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "20000")
        .config("spark.checkpoint.dir", scratch + "/ckpt")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(scratch + "/ckpt")
    from strobe.session import ship_package

    ship_package(spark)
    return spark


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def archive_throughput(spark: SparkSession, sf_dir: str, target: int) -> dict:
    from strobe.operators.convert import convert_archive
    from strobe.plans import capture_standin as cs
    from strobe.plans.tables import table
    from strobe.session import shared_dir

    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    n_events = ev.count()
    copies = max(1, math.ceil(target / n_events))
    # each acquisition (user) is extended in time by its copies, so acquisitions
    # grow with the target rather than multiply
    rep = ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        (F.col("event_id") * copies + F.col("copy")).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(days=F.col("copy") * 40)).alias("ts"),
        "user_id",
        "event_type",
        "value",
    )
    t0 = time.time()
    cap = cs.build(spark, sf_dir, events=rep, frame_rows=1000)
    root = cs.archive(spark, cap, chunk_bytes=8 << 20)
    t_build = time.time() - t0

    t1 = time.time()
    out = shared_dir(spark, "bench-converted")
    converted = convert_archive(spark, root, out, check_overrun=False)
    t_decode = time.time() - t1
    assert converted.samples == n_events * copies
    frames = converted.index.where("kind = 'frame'").count()
    samples = n_events * copies
    return {
        "parallel_index_sec": index_in_parallel(spark, root, frames),
        "samples": samples,
        "sample_bytes": cs.SAMPLE_BYTES,
        "archive_build_sec": round(t_build, 3),
        "archive_convert_sec": round(t_decode, 3),
        "samples_per_s": round(samples / t_decode, 1),
        "bytes_per_s": round(samples * cs.SAMPLE_BYTES / t_decode, 1),
    }


def index_in_parallel(spark: SparkSession, root: str, frames: int) -> float:
    """Seconds of the parallel index over the files of an archive."""
    from strobe.sources.dumps import list_chunks
    from strobe.sources.parallel_index import index_archive_files

    t = time.time()
    index = index_archive_files(list_chunks(spark, root), walk_bytes=0)
    assert index.where("kind = 'frame'").count() == frames
    return round(time.time() - t, 3)


def small_acquisitions(spark: SparkSession, sf_dir: str) -> float:
    """Seconds to convert an archive of many acquisitions of ten samples."""
    from strobe.operators.convert import convert_archive
    from strobe.plans import capture_standin as cs
    from strobe.plans.tables import table
    from strobe.session import shared_dir

    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value")
    cap = cs.build(spark, sf_dir, events=ev.withColumn("user_id", F.expr("event_id div 10")))
    root = cs.archive(spark, cap, chunk_bytes=8 << 20)
    t = time.time()
    convert_archive(spark, root, shared_dir(spark, "bench-small"), check_overrun=False)
    return round(time.time() - t, 3)


def skew_check(spark: SparkSession, sf_dir: str, copies: int = 20) -> dict:
    """Positions within a key when one key holds a third of all rows: the
    split ordered scan against a plain key-wide window (both exact)."""
    from pyspark.sql import Window

    from strobe.operators.ordering import ordered_scan
    from strobe.plans.tables import table

    ev = table(spark, sf_dir, "events", "event_id", "ts", "user_id")
    rep = ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))).select(
        (F.col("event_id") * copies + F.col("copy")).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(days=F.col("copy") * 40)).alias("ts"),
        F.when(F.col("event_id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")).alias("user_id"),
    )
    rows = rep.count()
    t = time.time()
    run(ordered_scan(rep, ["user_id"], ["ts", "event_id"], out="pos", bucket_rows=max(1000, rows // 64)))
    split = time.time() - t
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    t = time.time()
    run(rep.withColumn("pos", F.row_number().over(w) - 1))
    window = time.time() - t
    return {"rows": rows, "hot_key_share": 1 / 3, "split_scan_sec": round(split, 3), "key_window_sec": round(window, 3)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    target = int(os.environ.get("BENCH_SAMPLES", "10000000"))
    spark = session(cpus)
    from strobe.plans.registry import QUERIES, load_all

    load_all()
    times: dict[str, float] = {}
    arch = archive_throughput(spark, sf_dir, target)
    times["archive_convert"] = arch["archive_convert_sec"]
    times["parallel_index"] = arch.pop("parallel_index_sec")
    times["small_acquisitions"] = small_acquisitions(spark, sf_dir)
    for name in HEADLINE:
        t = time.time()
        run(QUERIES[name](spark, sf_dir))
        times[name] = round(time.time() - t, 3)
    skew = skew_check(spark, sf_dir)
    times["skewed_positions"] = skew["split_scan_sec"]
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "archive": arch,
        "skew": skew,
        "samples_per_s_per_core": round(arch["samples_per_s"] / cpus, 1),
    }))


if __name__ == "__main__":
    main()
