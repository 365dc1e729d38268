"""Saved configuration states, change feeds and table write logs as tables.

Inputs are ordered text lines: ``(file/snapshot keys, line_no, line)``. All
ordering work is done with skew-safe ordered scans, so one huge save file or
change feed never lands whole in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strobe.operators.ordering import BLOCK, HOT, ordered_scan, split_blocks

# A statement is multi-line when a '<' comes before any '?' or '='.
MULTILINE_PATTERN = r"^[^?=]*<"
# Change groups of the *CHANGES command (fixed protocol values).
CHANGE_GROUPS = ["CONFIG", "BITS", "POSN", "READ", "ATTR", "TABLE", "METADATA"]


def is_multiline(line: Column) -> Column:
    return line.rlike(MULTILINE_PATTERN)


def segment_statements(lines: DataFrame, keys: list[str], order: str = "line_no", bucket_rows: int | None = None) -> DataFrame:
    """Group state-file lines into statements.

    A line closes a statement if it is blank, or if it is the first line of
    the statement and not multi-line; so between two blank lines the first
    multi-line opener starts a body that runs to the next blank line, lines
    before it are single statements, and a blank in a run without an opener
    is a statement of its own. A trailing statement without its closing blank
    is dropped.

    Adds ``stmt_no`` (line number of the statement's first line) and keeps
    only lines of complete statements.

    The state before a line is the opener of the body it is in, or none. What
    a stretch of lines does to the state is a blank in it or none, and the
    first opener after its last blank; these compose, so blocks of bounded
    size are read on their own and what enters each is scanned over one row a
    block. However long a run between blanks is, no task holds it whole.
    """
    marked = lines.withColumn("__blank", (F.col("line") == "").cast("long")).withColumn("__ml", is_multiline(F.col("line")))
    tagged, any_hot = split_blocks(marked, keys, [order], bucket_rows)
    block = [*keys, BLOCK]
    in_order = Window.partitionBy(*block).orderBy(order)
    blanks = F.coalesce(F.sum("__blank").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    read = tagged.withColumn("__run", blanks).withColumn("__last", F.max(F.when(F.col("__blank") == 1, F.col(order))).over(Window.partitionBy(*block)))
    so_far = Window.partitionBy(*block, "__run").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    read = read.withColumn("__opener", F.first(F.when(F.col("__ml"), F.col(order)), ignorenulls=True).over(so_far))
    closed = F.coalesce(F.col(order) <= F.col("__last"), F.lit(False))
    opener = F.col("__opener")
    if any_hot:
        # one row for each block of a hot key: bounded by the total over the bucket size
        k = [f"__k{i}" for i in range(len(keys))]
        per_block = (
            read.where(F.col(HOT))
            .groupBy(*[F.col(x).alias(n) for x, n in zip(keys, k, strict=True)], F.col(BLOCK).alias("__kblock"))
            .agg(F.max("__blank").alias("blank"), F.max_by(F.when(F.col("__blank") == 0, opener), order).alias("open"))
        )
        by_key = Window.partitionBy(*k).orderBy("__kblock")
        grouped = per_block.withColumn("g", F.sum("blank").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
        after = F.first("open", ignorenulls=True).over(Window.partitionBy(*k, "g").orderBy("__kblock").rowsBetween(Window.unboundedPreceding, 0))
        entering = grouped.withColumn("after", after).select(
            *k, "__kblock", F.lag("after").over(by_key).alias("__enters"),
            F.max("blank").over(by_key.rowsBetween(1, Window.unboundedFollowing)).alias("__later"),
        )
        match = [F.col(x).eqNullSafe(F.col(n)) for x, n in zip(keys, k, strict=True)]
        read = read.join(F.broadcast(entering), [*match, F.col(BLOCK) == F.col("__kblock")], "left")
        opener = F.when(F.col("__run") == 0, F.coalesce("__enters", "__opener")).otherwise(F.col("__opener"))
        closed = closed | F.coalesce(F.col("__later") == 1, F.lit(False))
    found = read.withColumn("__from", opener)
    return found.where(F.col("__from").isNull() | closed).select(
        *[x for x in lines.columns if x != "stmt_no"], F.coalesce("__from", order).alias("stmt_no")
    )


def statement_rows(segmented: DataFrame, keys: list[str], order: str = "line_no") -> DataFrame:
    """One row per statement: key, kind, single value, body lines (in order).

    kinds: ``value`` (``k=v``), ``table_b64`` (``k<B``), ``append_last``
    (``k<<|``), ``append`` (``k<<``), ``multiline`` (``k<``), ``raw``.
    Statements have a bounded number of lines (one table or text value).
    """
    grouped = segmented.groupBy(*keys, "stmt_no").agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("n"), F.col("line").alias("line")))).alias("__lines")
    )
    first = F.col("__lines")[0]["line"]
    body = F.transform(
        F.filter(F.slice(F.col("__lines"), 2, 1 << 30), lambda x: x["line"] != ""), lambda x: x["line"]
    )
    head = F.regexp_extract(first, r"^([^<]*)<", 1)
    suffix = F.regexp_extract(first, r"^[^<]*(<.*)$", 1)
    ml = is_multiline(first)
    kind = (
        F.when(ml & (suffix == "<B"), F.lit("table_b64"))
        .when(ml & (suffix == "<<|"), F.lit("append_last"))
        .when(ml & (suffix == "<<"), F.lit("append"))
        .when(ml, F.lit("multiline"))
        .when(first.contains("="), F.lit("value"))
        .otherwise(F.lit("raw"))
    )
    key = F.when(ml, head).when(first.contains("="), F.substring_index(first, "=", 1)).otherwise(first)
    value = F.when(~ml & first.contains("="), F.regexp_extract(first, "^[^=]*=(.*)$", 1))
    return grouped.select(
        *keys, "stmt_no", kind.alias("kind"), key.alias("key"), value.alias("value"),
        F.when(ml, body).otherwise(F.array().cast("array<string>")).alias("body"),
        F.size("__lines").cast("long").alias("n_lines"),
    )


def classify_change(line: Column) -> dict[str, Column]:
    """``*CHANGES`` reply line -> kind/key/value, checked in this order:
    ends with ``<`` (no value: multi-line), ends with ``(error)`` (key is the
    text before the first space), else ``key=value`` split on the first ``=``
    (a line without ``=`` is invalid)."""
    no_value = line.endswith("<")
    error = line.endswith("(error)")
    has_eq = line.contains("=")
    kind = (
        F.when(no_value, F.lit("no_value"))
        .when(error, F.lit("error"))
        .when(has_eq, F.lit("value"))
        .otherwise(F.lit("invalid"))
    )
    key = (
        F.when(no_value, F.regexp_replace(line, "<$", ""))
        .when(error, F.substring_index(line, " ", 1))
        .when(has_eq, F.substring_index(line, "=", 1))
    )
    value = F.when(~no_value & ~error & has_eq, F.regexp_extract(line, "^[^=]*=(.*)$", 1))
    return {"kind": kind, "key": key, "value": value}


def latest_values(changes: DataFrame, keys: list[str], seq: str, value: str = "value") -> DataFrame:
    """Latest value per key: a later line replaces an earlier one. ``max_by`` is
    partial-aggregated, so a hot key is reduced map-side."""
    return changes.groupBy(*keys).agg(F.max_by(F.col(value), F.col(seq)).alias("latest"))


def fold_table_writes(writes: DataFrame, keys: list[str], order: list[str], op: str, rows: str) -> DataFrame:
    """Final table content from a write log: ``replace`` (``<``) starts over,
    ``append`` (``<<``) and ``append_last`` (``<<|``) add rows in order.

    Returns (keys, row_no, row, last_marked). The last replace is found with a
    partial aggregate; row numbers come from an ordered scan weighted by the
    rows of each write, so no table's history is gathered in one task.
    """
    pos = F.struct(*[F.col(x) for x in order])
    last = writes.where(F.col(op) == "replace").groupBy(*keys).agg(F.max(pos).alias("__from"))
    kept = writes.join(last, keys, "left").where(F.col("__from").isNull() | (pos >= F.col("__from")))
    kept = kept.withColumn("__n", F.size(rows).cast("long"))
    placed = ordered_scan(kept, keys, order, out="__base", weight="__n")
    return placed.select(
        *keys, "__base", F.posexplode(rows).alias("__i", "row"), (F.col(op) == "append_last").alias("last_marked")
    ).select(*keys, (F.col("__base") + F.col("__i")).alias("row_no"), "row", "last_marked")


def snapshot_diff(a: DataFrame, b: DataFrame, key: str, value: str) -> DataFrame:
    """Fields whose value differs between two snapshots (added, removed or
    changed): full outer join on the key, null-safe comparison."""
    j = a.select(F.col(key).alias("k"), F.col(value).alias("before")).join(
        b.select(F.col(key).alias("k"), F.col(value).alias("after")), "k", "full_outer"
    )
    return j.where(~F.col("before").eqNullSafe(F.col("after")))


def state_entries(changes: DataFrame, multiline: DataFrame, keys: list[str]) -> DataFrame:
    """Build state entries from four ``*CHANGES`` groups.

    ``changes``: (keys, group, seq, line) replies of the ATTR, CONFIG, TABLE
    and METADATA groups; ``multiline``: (keys, field, values ARRAY<STRING>)
    for the multi-line fields (tables as base64 lines). Single values come
    first in the order ATTR, CONFIG, METADATA, then tables as ``k<B``, then
    multi-line metadata as ``k<``, each multi-line entry closed by a blank
    line. Fields in error are left out.
    Returns (keys, rank, lines ARRAY<STRING>) ordered by ``rank``.
    """
    cls = classify_change(F.col("line"))
    c = changes.select(*keys, "group", "seq", cls["kind"].alias("kind"), cls["key"].alias("field"), cls["value"].alias("value"))
    group_rank = F.when(F.col("group") == "ATTR", 0).when(F.col("group") == "CONFIG", 1).otherwise(2)
    singles = c.where((F.col("kind") == "value") & F.col("group").isin("ATTR", "CONFIG", "METADATA")).select(
        *keys, F.struct(F.lit(0).alias("r0"), group_rank.alias("r1"), F.col("seq").alias("r2")).alias("rank"),
        F.array(F.concat(F.col("field"), F.lit("="), F.col("value"))).alias("lines"),
    )
    multi = c.where((F.col("kind") == "no_value") & F.col("group").isin("TABLE", "METADATA"))
    multi = multi.join(multiline, [*keys, "field"], "left")
    suffix = F.when(F.col("group") == "TABLE", F.lit("<B")).otherwise(F.lit("<"))
    block = F.concat(
        F.array(F.concat(F.col("field"), suffix)),
        F.coalesce(F.col("values"), F.array().cast("array<string>")),
        F.array(F.lit("")),
    )
    multis = multi.select(
        *keys,
        F.struct(
            F.when(F.col("group") == "TABLE", 1).otherwise(2).alias("r0"), F.lit(0).alias("r1"), F.col("seq").alias("r2")
        ).alias("rank"),
        block.alias("lines"),
    )
    return singles.unionByName(multis)


def duplicate_keys(changes: DataFrame, keys: list[str]) -> DataFrame:
    """Fields reported with a value in more than one group (an error for GetState)."""
    cls = classify_change(F.col("line"))
    c = changes.where(F.col("group").isin("ATTR", "CONFIG", "METADATA")).select(
        *keys, "group", cls["kind"].alias("kind"), cls["key"].alias("field")
    )
    return c.where(F.col("kind") == "value").groupBy(*keys, "field").agg(
        F.countDistinct("group").alias("n_groups")
    ).where(F.col("n_groups") > 1)


def entries_to_lines(entries: DataFrame, keys: list[str]) -> DataFrame:
    """Ordered state lines (keys, line_no, line) from ranked entries (K7)."""
    sized = entries.withColumn("__n", F.size("lines").cast("long")).select(
        "*", F.col("rank.r0").alias("__r0"), F.col("rank.r1").alias("__r1"), F.col("rank.r2").alias("__r2")
    )
    placed = ordered_scan(sized, keys, ["__r0", "__r1", "__r2"], out="__base", weight="__n")
    return placed.select(*keys, "__base", F.posexplode("lines").alias("__i", "line")).select(
        *keys, (F.col("__base") + F.col("__i")).alias("line_no"), "line"
    )


class StateError(ValueError):
    """A saved state cannot be built from the change groups given."""


def build_state(changes: DataFrame, multiline: DataFrame, keys: list[str]) -> DataFrame:
    """Ordered state lines (keys, line_no, line); a field reported with a
    value in two groups is an error, as is a change set with a malformed line."""
    dup = duplicate_keys(changes, keys).limit(1).collect()
    if dup:
        raise StateError(f"field {dup[0]['field']!r} has values in {dup[0]['n_groups']} groups")
    bad = invalid_change_sets(changes, [*keys, "group"]).limit(1).collect()
    if bad:
        raise StateError(f"change set {tuple(bad[0])} has a line that is not key=value, key< or key (error)")
    return entries_to_lines(state_entries(changes, multiline, keys), keys)


def invalid_change_sets(lines: DataFrame, keys: list[str]) -> DataFrame:
    """Change sets (one ``*CHANGES`` reply per key tuple) holding a line that
    parses as none of the three forms; such a set fails as a whole."""
    cls = classify_change(F.col("line"))
    return (
        lines.select(*keys, cls["kind"].alias("kind"))
        .where(F.col("kind") == "invalid")
        .select(*keys)
        .distinct()
    )
