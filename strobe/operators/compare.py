"""Comparing two captures by a tree of block fingerprints.

A fingerprint of a block of samples of one column is the exclusive or of a hash
of each (position, value), so it does not depend on the order of the rows and
is pre-aggregated where they are. Blocks of an acquisition's column combine to
one fingerprint in the same way. Fingerprints are written when a capture is
stored; a comparison then goes top-down over two small tables and reads only
the frames of blocks that differ.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strobe.functions.columns import q

ACQ = ["conn_id", "acq_no"]
DEFAULT_BLOCK_ROWS = 65_536


def fingerprints(samples: DataFrame, columns: list[str], block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """(conn_id, acq_no, column, block, n, mark) of a capture's samples
    (conn_id, acq_no, sample_idx, columns), in one aggregation."""
    block = F.floor(F.col("sample_idx") / block_rows).cast("long")
    marks = [F.bit_xor(F.xxhash64("sample_idx", F.col(q(c)))).alias(f"__m{i}") for i, c in enumerate(columns)]
    counted = samples.groupBy(*ACQ, block.alias("block")).agg(F.count(F.lit(1)).alias("n"), *marks)
    each = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"__m{i}").alias("mark")) for i, c in enumerate(columns)])
    return counted.select(*ACQ, "block", "n", F.explode(each).alias("m")).select(*ACQ, "m.column", "block", "n", "m.mark")


def differing_blocks(a: DataFrame, b: DataFrame) -> DataFrame:
    """(conn_id, acq_no, column, block) whose fingerprints differ, or that one
    side alone has. Acquisition columns with equal totals are left out before
    blocks are compared."""
    column = [*ACQ, "column"]

    def totals(x: DataFrame) -> DataFrame:
        return x.groupBy(*column).agg(F.sum("n").alias("n"), F.bit_xor("mark").alias("mark"))

    def unequal(x: DataFrame, y: DataFrame, key: list[str]) -> DataFrame:
        x, y = x.select(*key, F.struct("n", "mark").alias("x")), y.select(*key, F.struct("n", "mark").alias("y"))
        return x.join(y, key, "full_outer").where(~F.col("x").eqNullSafe(F.col("y"))).select(*key)

    open_ = unequal(totals(a), totals(b), column)
    return unequal(a.join(open_, column, "left_semi"), b.join(open_, column, "left_semi"), [*column, "block"])


def frames_of(index: DataFrame, blocks: DataFrame, block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """The frames of an index that hold samples of the blocks, in any column."""
    frames = index.where("kind = 'frame' AND n_rows > 0")
    touched = frames.select(*ACQ, "frame_no", F.explode(F.sequence(
        F.floor(F.col("first_sample") / block_rows).cast("long"), F.floor((F.col("first_sample") + F.col("n_rows") - 1) / block_rows).cast("long")
    )).alias("block"))
    wanted = touched.join(blocks.select(*ACQ, "block").distinct(), [*ACQ, "block"], "left_semi").select(*ACQ, "frame_no").distinct()
    return frames.join(wanted, [*ACQ, "frame_no"], "left_semi")


def compare_blocks(a: DataFrame, b: DataFrame, blocks: DataFrame, columns: list[str], block_rows: int = DEFAULT_BLOCK_ROWS) -> DataFrame:
    """(conn_id, acq_no, sample_idx, before, after) of the samples of the given
    blocks that differ in any column; before and after are structs of the
    columns, null where a side has no such sample."""
    key = [*ACQ, "sample_idx"]
    chosen = blocks.select(*ACQ, "block").distinct()
    block = F.floor(F.col("sample_idx") / block_rows).cast("long")

    def side(x: DataFrame, name: str) -> DataFrame:
        own = x.withColumn("block", block).join(chosen, [*ACQ, "block"], "left_semi")
        return own.select(*key, F.struct(*[F.col(q(c)).alias(c) for c in columns]).alias(name))

    return side(a, "before").join(side(b, "after"), key, "full_outer").where(~F.col("before").eqNullSafe(F.col("after")))
