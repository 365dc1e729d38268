"""Skew-safe ordered scans: position, running sums, lag and last value within a key.

``Window.partitionBy(key).orderBy(...)`` puts every row of a key into one
task. One acquisition can hold a third of all samples, so sample positions,
running frame bases and gaps are computed without a key-wide window:

1. keys with more than ``bucket_rows`` rows are *hot*; there are at most
   ``total / bucket_rows`` of them, so that list has a proven size bound;
2. each hot key is cut into ``ceil(n / bucket_rows)`` contiguous blocks at
   boundaries that are whole order tuples -- strings and ties in the leading
   columns split like anything else -- taken from a sample by hash of the
   order tuple (the boundaries only balance work: results are exact whatever
   they are).  A block that would need more than ``FAN`` boundaries is cut
   again, level by level;
3. the ordinary window runs per ``(key, block)``, so no task holds more than
   about ``bucket_rows`` rows of one key;
4. per-(key, block) totals, last rows and last values -- at most
   ``2 * total / bucket_rows`` rows -- are scanned once more and joined back
   as what enters each block.

``bucket_rows`` grows with the input beyond ``MOST_BLOCKS`` blocks, so the
tables of boundaries and totals that are broadcast have a fixed bound.
Everything stays in the JVM and is deterministic, so a recomputed stage after
an executor loss produces the same blocks.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strobe.functions.columns import q
from strobe.session import shared_dir

DEFAULT_BUCKET_ROWS = 2_000_000
#: Blocks of all hot keys together, about; boundaries of one cut; sampled
#: rows for each block.
MOST_BLOCKS = 1 << 18
FAN = 1024
SAMPLED = 64
BLOCK = "__sub"
HOT = "__hot"


def _bucket_rows(df: DataFrame, bucket_rows: int | None) -> int:
    if bucket_rows:
        return int(bucket_rows)
    conf = df.sparkSession.conf.get("strobe.scan.bucketRows", None)
    return int(conf) if conf else DEFAULT_BUCKET_ROWS


def _order_tuple(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(q(o)).alias(f"o{i}") for i, o in enumerate(order)])


def _matches(names: Sequence[str]) -> list[Column]:
    return [F.col(q(k)).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(names)]


def _cut(df: DataFrame, groups: list[str], order: Sequence[str], limit: int, out: str) -> tuple[DataFrame, int]:
    """Number the blocks of each group of more than ``limit`` rows in ``out``
    (0 elsewhere) and mark their rows; also the rows of the largest group
    after that, about (0: nothing was cut)."""
    gcols = [q(g) for g in groups]
    counts = df.groupBy(*gcols).agg(F.count(F.lit(1)).alias("__n"))
    # two numbers: how large the largest group is, and all of them together
    size = counts.agg(F.max("__n").alias("top"), F.sum("__n").alias("total")).collect()[0]
    limit = max(limit, (size["total"] or 0) // MOST_BLOCKS)
    if (size["top"] or 0) <= limit:
        return df.withColumn(out, F.lit(0).cast("long")).withColumn(HOT, F.lit(False)), 0
    most = min(FAN, math.ceil(size["top"] / limit))
    hot = counts.where(F.col("__n") > limit).select(
        *[F.col(g).alias(f"__k{i}") for i, g in enumerate(gcols)], "__n", F.least(F.ceil(F.col("__n") / limit), F.lit(FAN)).alias("__parts")
    )
    ordered = _order_tuple(order)
    every = F.ceil(F.col("__n") / (SAMPLED * F.col("__parts")))
    sampled = (
        df.select(*gcols, *[F.col(q(o)) for o in order if o not in groups])
        .join(F.broadcast(hot), _matches(groups))
        .where(F.pmod(F.xxhash64(ordered), every) == 0)
        .groupBy(*[f"__k{i}" for i in range(len(groups))], "__parts")
        .agg(F.array_sort(F.collect_list(ordered)).alias("__of"))
    )
    place = F.transform(F.sequence(F.lit(1), F.col("__parts").cast("int") - 1), lambda i: F.get("__of", F.floor(i * F.size("__of") / F.col("__parts")).cast("int")))
    cuts = sampled.select(*[f"__k{i}" for i in range(len(groups))], place.alias("__cuts"))
    # one row per hot group: written once, so that every later branch reads it
    # instead of recounting and sampling the input again
    path = shared_dir(df.sparkSession, "block-boundaries")
    cuts.write.parquet(path)
    cuts = F.broadcast(df.sparkSession.read.schema(cuts.schema).parquet(path))
    tagged = df.join(cuts, _matches(groups), "left").withColumn("__tuple", ordered).withColumn("__rank", F.lit(0))
    # boundaries <= the row's tuple, by binary search: chained projections
    step = 1 << max(0, (most - 1).bit_length() - 1)
    while step >= 1:
        cand = F.col("__rank") + F.lit(step)
        tagged = tagged.withColumn("__rank", F.when(F.get(F.col("__cuts"), cand - 1) <= F.col("__tuple"), cand).otherwise(F.col("__rank")))
        step //= 2
    keep = [F.col(q(x)) for x in df.columns]
    return tagged.select(*keep, F.col("__rank").cast("long").alias(out), F.col("__cuts").isNotNull().alias(HOT)), math.ceil(size["top"] / most)


def split_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket_rows: int | None = None) -> tuple[DataFrame, bool]:
    """Tag rows with ``__sub``, the number of their block in the order of the
    key (0 for ordinary keys), and ``__hot``; also whether any key was cut."""
    limit = _bucket_rows(df, bucket_rows)
    names = df.columns
    tagged, top = _cut(df, list(keys), order, limit, BLOCK)
    any_hot = top > 0
    while top > 2 * limit:
        before = top
        again, top = _cut(tagged.withColumnRenamed(HOT, "__hot0"), [*keys, BLOCK], order, limit, "__finer")
        tagged = again.select(*[F.col(q(x)) for x in names], (F.col(BLOCK) * FAN + F.col("__finer")).alias(BLOCK), (F.col("__hot0") | F.col(HOT)).alias(HOT))
        if top >= before:  # equal order tuples cannot be parted
            break
    return tagged, any_hot


def ordered_scan(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    out: str = "pos",
    weight: str | None = None,
    lag: Sequence[str] = (),
    fill: Sequence[str] = (),
    bucket_rows: int | None = None,
) -> DataFrame:
    """Add ``out`` = exclusive running sum of ``weight`` (1 when None, i.e. the
    0-based position) within ``keys`` in ``order``; for each column in ``lag``
    add ``prev_<col>`` = that column on the previous row of the same key, and
    for each in ``fill`` ``last_<col>`` = its last non-null value on the rows
    before.

    Same result as ``sum(weight) OVER (PARTITION BY keys ORDER BY order ROWS
    BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)``, ``lag(col)`` and
    ``last(col, true)``; the order columns (nulls first) must make rows unique
    within a key.
    """
    keys, order, lag, fill = list(keys), list(order), list(lag), list(fill)
    tagged, any_hot = split_blocks(df, keys, order, bucket_rows)
    kcols = [q(k) for k in keys]
    w_expr = F.lit(1).cast("long") if weight is None else F.col(q(weight)).cast("long")

    part = Window.partitionBy(*kcols, BLOCK).orderBy(*[F.col(q(o)).asc_nulls_first() for o in order])
    before = part.rowsBetween(Window.unboundedPreceding, -1)
    if weight is None:
        local = F.row_number().over(part).cast("long") - F.lit(1)
    else:
        local = F.coalesce(F.sum(w_expr).over(before), F.lit(0).cast("long"))
    scanned = tagged.withColumn("__local", local)
    if any_hot and lag:
        scanned = scanned.withColumn("__rn", F.row_number().over(part))
    for col in lag:
        scanned = scanned.withColumn(f"prev_{col}", F.lag(F.col(q(col))).over(part))
    for col in fill:
        scanned = scanned.withColumn(f"last_{col}", F.last(F.col(q(col)), ignorenulls=True).over(before))

    if not any_hot:
        return scanned.withColumnRenamed("__local", out).drop(BLOCK, HOT)

    # What enters each block of a hot key: at most 2 * total / bucket_rows
    # rows, so the broadcast is bounded. It is aggregated from the windowed
    # rows, which are already partitioned by (key, block): no second pass.
    at = _order_tuple(order)
    per_block = (
        scanned.where(F.col(HOT))
        .groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(kcols)], F.col(BLOCK).alias("__kblock"))
        .agg(
            F.sum(w_expr).alias("__tot"),
            F.max_by(F.struct(F.lit(1).alias("__one"), *[F.col(q(x)).alias(x) for x in lag]), at).alias("__end"),
            *[F.max_by(F.col(q(x)), F.when(F.col(q(x)).isNotNull(), at)).alias(f"__fill{i}") for i, x in enumerate(fill)],
        )
    )
    by_key = Window.partitionBy(*[f"__k{i}" for i in range(len(keys))]).orderBy("__kblock")
    earlier = by_key.rowsBetween(Window.unboundedPreceding, -1)
    entering = per_block.select(
        *[f"__k{i}" for i in range(len(keys))],
        "__kblock",
        F.coalesce(F.sum("__tot").over(earlier), F.lit(0).cast("long")).alias("__off"),
        F.lag("__end").over(by_key).alias("__prev_end"),
        *[F.last(f"__fill{i}", ignorenulls=True).over(earlier).alias(f"__enter{i}") for i in range(len(fill))],
    )
    joined = scanned.join(F.broadcast(entering), [*_matches(keys), F.col(BLOCK) == F.col("__kblock")], "left")
    result = joined.withColumn(out, F.col("__local") + F.coalesce(F.col("__off"), F.lit(0).cast("long")))
    for col in lag:
        result = result.withColumn(
            f"prev_{col}", F.when(F.col("__rn") == 1, F.col("__prev_end").getField(col)).otherwise(F.col(q(f"prev_{col}")))
        )
    for i, col in enumerate(fill):
        result = result.withColumn(f"last_{col}", F.coalesce(F.col(q(f"last_{col}")), F.col(f"__enter{i}")))
    added = [out, *[f"prev_{c}" for c in lag], *[f"last_{c}" for c in fill]]
    return result.select(*[F.col(q(x)) for x in df.columns if x not in added], *[F.col(q(x)) for x in added])


def position_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], out: str = "pos", **kw) -> DataFrame:
    """0-based position of each row within its key (``row_number() - 1``)."""
    return ordered_scan(df, keys, order, out=out, **kw)
