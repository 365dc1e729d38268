"""Stored snapshots of the latest value per field.

A snapshot is a table bucketed and sorted by field. Merging a change feed into
it joins bucket by bucket: the feed, reduced to its last value per field, is
dealt to the snapshot's buckets, and the snapshot itself is neither shuffled
nor sorted. The merged rows are written as the next snapshot, bucketed alike.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strobe.session import shared_dir


def buckets_for(spark: SparkSession, least: int = 0) -> int:
    """Buckets of a snapshot: at least the session's shuffle partitions, below
    which Spark would rather shuffle a bucketed table than use it."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


def write_snapshot(rows: DataFrame, key: str, value: str, buckets: int | None = None, name: str | None = None) -> str:
    """Store (key, value) rows, one a key, as a new snapshot; returns its table.
    The files lie in the shared folder."""
    spark = rows.sparkSession
    name = name or f"snapshot_{uuid.uuid4().hex[:12]}"
    n = buckets or buckets_for(spark)
    out = rows.select(F.col(key).alias("key"), F.col(value).alias("value"))
    # one file a bucket, so that a bucket is read in its order
    out.repartition(n, "key").write.bucketBy(n, "key").sortBy("key").option("path", shared_dir(spark, name)).saveAsTable(name)
    return name


def last_changes(changes: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """The last change of each field; a null value removes the field."""
    return changes.groupBy(F.col(key).alias("key")).agg(F.max_by(F.struct(F.col(value).alias("value")), F.col(seq)).alias("change"))


def merged(spark: SparkSession, snapshot: str, changes: DataFrame, key: str, value: str, seq: str) -> DataFrame:
    """(key, value, before): the snapshot with the changes applied."""
    last = last_changes(changes, key, value, seq)
    both = spark.table(snapshot).join(last.hint("merge"), "key", "full_outer")
    new = F.when(F.col("change").isNotNull(), F.col("change.value")).otherwise(F.col("value"))
    return both.select("key", new.alias("value"), F.col("value").alias("before")).where("value IS NOT NULL")


def merge_snapshot(spark: SparkSession, snapshot: str, changes: DataFrame, key: str, value: str, seq: str) -> str:
    """Store the snapshot that follows; returns its table."""
    n = int(spark.sql(f"DESCRIBE EXTENDED {snapshot}").where("col_name = 'Num Buckets'").collect()[0]["data_type"])
    return write_snapshot(merged(spark, snapshot, changes, key, value, seq), "key", "value", n)
