"""Tables, lineage cuts and connected components for the llm operators."""

from __future__ import annotations

import contextlib
import zlib
from collections.abc import Iterator

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from strobe.plans.tables import table
from strobe.session import shared_dir


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text")


BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 8 << 20


def small_batches(spark: SparkSession) -> None:
    """Hand Python tasks Arrow batches of a few MB, for rows that are large:
    the JVM and the worker each hold a batch twice."""
    spark.conf.set(BATCH_CONF, str(BATCH_BYTES))


BROADCAST_CONF = "spark.sql.autoBroadcastJoinThreshold"


@contextlib.contextmanager
def shuffled_joins(spark: SparkSession) -> Iterator[None]:
    """Joins of what is written inside meet by shuffles alone: rounds of many
    small joins would else leave a table of each in the driver."""
    before = spark.conf.get(BROADCAST_CONF)
    spark.conf.set(BROADCAST_CONF, "-1")
    try:
        yield
    finally:
        spark.conf.set(BROADCAST_CONF, before)


def materialise(df: DataFrame, purpose: str) -> DataFrame:
    """Write a table in the shared folder and read it again: the lineage is cut
    and any executor can read the result."""
    path = shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def crc32_text(n: int) -> int:
    return zlib.crc32(str(n).encode())


def held_out_column(doc_id: str = "doc_id", folds: int = 5):
    """crc32(doc_id as text) mod folds = 0; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % folds == 0, F.lit(False))


#: Rows of one file of a table whose size is known before it is written.
FILE_ROWS = 1 << 18


def counted(df: DataFrame, purpose: str, rows: int | None = None) -> tuple[DataFrame, int, int]:
    """``materialise`` that also returns how many rows were written and a
    checksum of them, both gathered while writing.  rows: about how many there
    will be, if known; small tables then go to few files."""
    seen = Observation()
    if rows is not None:
        # no more tasks than files that are worth having
        most = df.sparkSession.conf.get("spark.sql.shuffle.partitions")
        files = 1 + rows // FILE_ROWS
        df = df.coalesce(files) if files < int(most) else df
    watched = df.observe(seen, F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64(*df.columns)).alias("mark"))
    out = materialise(watched, purpose)
    return out, int(seen.get["n"] or 0), int(seen.get["mark"] or 0)


def nearest_roots(edges: DataFrame, purpose: str, rows: int | None = None) -> DataFrame:
    """(node, root): the smallest node within two (a, b) edges of each node
    that has a smaller one so near.  A step towards components, for what needs
    no more than that nodes with one root belong together."""
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    one = both.groupBy(F.col("u").alias("v")).agg(F.least(F.first("u"), F.min("v")).alias("m"))
    two = both.join(one, "v").groupBy(F.col("u").alias("node")).agg(F.min("m").alias("root"))
    return counted(two.where("root < node"), purpose, rows)[0]


def connected_components(edges: DataFrame, purpose: str = "components") -> DataFrame:
    """Smallest node reachable from each node of (a, b) edges: (node, root).

    Each round every node hangs its larger neighbours, then its smaller ones,
    on the smallest node it sees; rounds end when the edges stay the same,
    which only stars do.  Every step is a grouped minimum and a join, both
    spilling; each round is one job that writes a table in the shared folder
    and counts it on the way.  Rounds grow with the logarithm of the longest
    chain.
    """
    now, n, mark = counted(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), purpose)
    while n:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # larger neighbours of each node hang on its smallest neighbour
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # the node and its smaller neighbours hang on the smallest of these
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        before = (n, mark)
        now, n, mark = counted(small, purpose, n)
        if (n, mark) == before:
            break
    pair = F.array(F.struct(F.col("u").alias("node"), F.col("v").alias("root")), F.struct(F.col("v").alias("node"), F.col("v").alias("root")))
    return now.select(F.explode(pair).alias("e")).select("e.node", "e.root").distinct()
