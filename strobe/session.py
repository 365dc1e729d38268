"""Session construction and shared-storage helpers.

The engine never hard-codes a cluster layout: it reads what the session
already has (``spark.checkpoint.dir``, shuffle partitions) and only fills
in defaults when they are unset, as happens in local tests.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

LOCAL_DEFAULTS = {
    "spark.sql.shuffle.partitions": "8",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.driver.memory": "16g",
}


def get_session(master: str | None = None, app: str = "strobe") -> SparkSession:
    """Return the active session, or build a local one for tests/bench."""
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    elif "SPARK_MASTER" not in os.environ and "spark.master" not in os.environ.get(
        "PYSPARK_SUBMIT_ARGS", ""
    ):
        builder = builder.master("local[*]")
    for key, value in LOCAL_DEFAULTS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _local_scratch(spark: SparkSession) -> str:
    """A folder of this machine, for local masters alone: on a cluster other
    executors could not read it."""
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return tempfile.mkdtemp(prefix="strobe-ckpt-")


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder under the cluster's shared checkpoint location.

    ``spark.checkpoint.dir`` is read from the session; only when it is unset
    (local tests) is a local scratch folder chosen and recorded back.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        base = _local_scratch(spark)
        spark.conf.set("spark.checkpoint.dir", base)
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{purpose}-{uuid.uuid4().hex[:12]}"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable; honours a configured directory."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = _local_scratch(spark)
        spark.conf.set("spark.checkpoint.dir", base)
    spark.sparkContext.setCheckpointDir(base)
    return spark.sparkContext.getCheckpointDir()


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``strobe`` importable by Python workers: zip the package once per
    application and register it with ``SparkContext.addPyFile``, which copies it
    to every executor (as ``--py-files`` would)."""
    import zipfile
    from pathlib import Path

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    pkg = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="strobe-pkg-")) / "strobe.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for path in pkg.rglob("*.py"):
            zf.write(path, path.relative_to(pkg.parent).as_posix())
    sc.addPyFile(str(target))
    _SHIPPED.add(app)
