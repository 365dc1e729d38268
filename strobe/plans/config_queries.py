"""Check queries for packed tables (§2.9, A3, G7) and for saved states, change
feeds and table write logs (§2.7-2.8), each with a DuckDB oracle.

Stand-ins: packed-table rows are ``lineitem`` rows (one table per order);
table layouts are built from ``part``; state files are ``events`` lines per
user; change feeds and saved states come from ``events`` and ``orders``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strobe.operators.ordering import ordered_scan, position_within
from strobe.operators.packed import (
    TableColumn,
    base64_to_words,
    enum_index,
    pack_row,
    unpack_rows,
    words_to_base64,
)
from strobe.operators.state import (
    CHANGE_GROUPS,
    classify_change,
    entries_to_lines,
    fold_table_writes,
    is_multiline,
    latest_values,
    segment_statements,
    snapshot_diff,
    state_entries,
    statement_rows,
)
from strobe.plans.registry import register
from strobe.plans.tables import table

# ----------------------------------------------------------------------------- packed tables

FLAG_LABELS = ("A", "N", "R")
LINEITEM_LAYOUT = [
    TableColumn("QUANTITY", "uint", 0, 15),
    TableColumn("FLAG", "enum", 16, 19, FLAG_LABELS),
    TableColumn("LINE", "uint", 20, 22),
    TableColumn("POSITION", "int", 32, 63),
    TableColumn("PART", "uint", 64, 95),
]
ROW_ORDER = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag"]
_ORDER_SQL = ", ".join(ROW_ORDER)

_WORDS_SQL = f"""li AS (SELECT *, CAST(l_quantity AS BIGINT)
    | (CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END << 16)
    | (CAST(l_linenumber AS BIGINT) << 20) AS w0,
    (l_suppkey - 50) & 4294967295 AS w1, l_partkey AS w2,
    row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER_SQL}) - 1 AS row_idx
  FROM lineitem)"""


def packed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem rows with their packed words (ARRAY<BIGINT>)."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", *ROW_ORDER)
    flag = LINEITEM_LAYOUT[1]
    values = {
        "QUANTITY": F.col("l_quantity").cast("long"),
        "FLAG": enum_index(F.col("l_returnflag"), flag),
        "LINE": F.col("l_linenumber"),
        "POSITION": F.col("l_suppkey") - 50,
        "PART": F.col("l_partkey"),
    }
    return li.withColumn("words", pack_row(LINEITEM_LAYOUT, values))


def packed_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One packed table per order: (l_orderkey, words ARRAY<BIGINT>), rows in
    ROW_ORDER. A table is one order's lines, so each group is small."""
    rows = packed_rows(spark, sf_dir)
    grouped = rows.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list(F.struct(*[F.col(x) for x in ROW_ORDER], F.col("words")))).alias("__rows")
    )
    return grouped.select("l_orderkey", F.flatten(F.transform("__rows", lambda r: r["words"])).alias("words"))


def _unpacked(spark, sf_dir, enum_labels=False) -> DataFrame:
    return unpack_rows(packed_tables(spark, sf_dir), "words", LINEITEM_LAYOUT, ["l_orderkey"], enum_labels)


@register("unpack_table", f"""
SELECT l_orderkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER_SQL}) - 1 AS BIGINT) AS row_idx,
  CAST(l_quantity AS BIGINT) AS quantity,
  CAST(CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS BIGINT) AS flag,
  CAST(l_linenumber AS BIGINT) AS line, CAST(l_suppkey - 50 AS BIGINT) AS position, l_partkey AS part
FROM lineitem""")
def unpack_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _unpacked(spark, sf_dir)
    return u.select(
        "l_orderkey", F.col("row").cast("long").alias("row_idx"),
        *[F.col(c.name).cast("long").alias(c.name.lower()) for c in LINEITEM_LAYOUT],
    ).withColumnRenamed("part", "part")


@register("unpack_signed", """
SELECT l_orderkey, l_linenumber, l_suppkey, CAST(l_suppkey - 50 AS INTEGER) AS position FROM lineitem""")
def unpack_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _unpacked(spark, sf_dir)
    return u.select(
        "l_orderkey", F.col("LINE").cast("int").alias("l_linenumber"),
        (F.col("POSITION").cast("long") + 50).alias("l_suppkey"), F.col("POSITION").alias("position"),
    )


@register("unpack_enum", """
SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS flag FROM lineitem""")
def unpack_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _unpacked(spark, sf_dir, enum_labels=True)
    return u.select(
        "l_orderkey", F.col("LINE").cast("int").alias("l_linenumber"), F.col("PART").alias("l_partkey"),
        F.col("FLAG").alias("flag"),
    )


@register("pack_table", f"""
WITH {_WORDS_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CAST(w0 AS VARCHAR) || ' ' || CAST(w1 AS VARCHAR) || ' ' || CAST(w2 AS VARCHAR) AS words
FROM li""")
def pack_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = packed_rows(spark, sf_dir)
    return p.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.array_join(F.transform("words", lambda w: w.cast("string")), " ").alias("words"),
    )


@register("pack_enum", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 WHEN 'R' THEN 2 END AS flag_index FROM lineitem""")
def pack_enum(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_returnflag")
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        enum_index(F.col("l_returnflag"), LINEITEM_LAYOUT[1]).alias("flag_index"),
    )


@register("length_mismatch", """
SELECT DISTINCT l_orderkey, l_orderkey % 5 <> 0 AS lengths_ok FROM lineitem""")
def length_mismatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column-array input (one array per column per table); the QUANTITY column
    of every fifth order is one value short and must be rejected."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", *ROW_ORDER)
    cols = li.groupBy("l_orderkey").agg(
        *[F.collect_list(x).alias(x) for x in ("l_quantity", "l_returnflag", "l_linenumber", "l_suppkey", "l_partkey")]
    )
    short = F.when(F.col("l_orderkey") % 5 == 0, F.slice("l_quantity", 1, F.size("l_quantity") - 1)).otherwise(
        F.col("l_quantity")
    )
    cols = cols.withColumn("l_quantity", short)
    sizes = [F.size(x) for x in ("l_quantity", "l_returnflag", "l_linenumber", "l_suppkey", "l_partkey")]
    ok = F.lit(True)
    for s in sizes[1:]:
        ok = ok & (s == sizes[0])
    return cols.select("l_orderkey", ok.alias("lengths_ok"))


@register("base64_words", f"""
WITH {_WORDS_SQL}
SELECT l_orderkey, CAST(3 * count(*) AS BIGINT) AS n_words,
  string_agg(CAST(w0 AS VARCHAR) || ' ' || CAST(w1 AS VARCHAR) || ' ' || CAST(w2 AS VARCHAR), ' ' ORDER BY row_idx) AS words
FROM li GROUP BY l_orderkey""")
def base64_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = packed_tables(spark, sf_dir).withColumn("b64", words_to_base64(F.col("words")))
    back = t.select("l_orderkey", base64_to_words(F.col("b64")).alias("w"))
    return back.select(
        "l_orderkey", F.size("w").cast("long").alias("n_words"),
        F.array_join(F.transform("w", lambda x: x.cast("string")), " ").alias("words"),
    )


@register("pack_unpack_roundtrip", """
SELECT l_orderkey, count(*) AS n_rows, true AS roundtrip_ok FROM lineitem GROUP BY l_orderkey""")
def pack_unpack_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = _unpacked(spark, sf_dir)
    li = table(spark, sf_dir, "lineitem", "l_orderkey", *ROW_ORDER)
    orig = position_within(li, ["l_orderkey"], ROW_ORDER, out="row")
    j = orig.join(u, ["l_orderkey", "row"], "full_outer")
    same = (
        (F.col("QUANTITY").cast("double") == F.col("l_quantity"))
        & (F.get(F.array(*[F.lit(x) for x in FLAG_LABELS]), F.col("FLAG").cast("int")) == F.col("l_returnflag"))
        & (F.col("LINE") == F.col("l_linenumber"))
        & (F.col("POSITION") == F.col("l_suppkey") - 50)
        & (F.col("PART") == F.col("l_partkey"))
    )
    return j.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_rows"), F.bool_and(F.coalesce(same, F.lit(False))).alias("roundtrip_ok")
    )


# ----------------------------------------------------------------------------- table layouts from part

_LAYOUT_SQL = """tl AS (SELECT p_brand AS table_name, 'C' || p_partkey AS column_name,
    CASE p_size % 3 WHEN 0 THEN 'uint' WHEN 1 THEN 'int' ELSE 'enum' END AS subtype,
    CAST((p_partkey * 7) % 96 AS BIGINT) AS bit_low,
    CAST((p_partkey * 7) % 96 + p_size % 16 AS BIGINT) AS bit_high
  FROM part)"""


def table_field_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``<table>.FIELDS`` reply lines ``HIGH:LOW NAME SUBTYPE`` built from part."""
    p = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_size")
    low = (F.col("p_partkey") * 7) % 96
    high = low + F.col("p_size") % 16
    subtype = F.when(F.col("p_size") % 3 == 0, "uint").when(F.col("p_size") % 3 == 1, "int").otherwise("enum")
    return p.select(
        F.col("p_brand").alias("table_name"),
        F.format_string("%d:%d C%d %s", high, low, F.col("p_partkey"), subtype).alias("line"),
    )


def parse_table_fields(lines: DataFrame) -> DataFrame:
    """G7: ``HIGH:LOW NAME SUBTYPE`` -> (column_name, subtype, bit_low, bit_high)."""
    parts = F.split(F.col("line"), r"\s+")
    rng = F.split(parts[0], ":")
    return lines.select(
        "table_name", parts[1].alias("column_name"), parts[2].alias("subtype"),
        rng[1].cast("long").alias("bit_low"), rng[0].cast("long").alias("bit_high"),
    )


@register("table_layout", f"""
WITH {_LAYOUT_SQL} SELECT table_name, column_name, subtype, bit_low, bit_high FROM tl""")
def table_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_table_fields(table_field_lines(spark, sf_dir))


@register("row_words", f"""
WITH {_LAYOUT_SQL} SELECT table_name, max(bit_high) // 32 + 1 AS row_words FROM tl GROUP BY table_name""")
def row_words_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    layout = parse_table_fields(table_field_lines(spark, sf_dir))
    return layout.groupBy("table_name").agg((F.floor(F.max("bit_high") / 32) + 1).cast("long").alias("row_words"))


# ----------------------------------------------------------------------------- state files (events per user)

_LINE_SQL = """CASE event_id % 5
    WHEN 0 THEN 'SEQ' || event_id || '.TABLE<' || CASE WHEN event_id % 10 = 0 THEN 'B' ELSE '' END
    WHEN 1 THEN ''
    WHEN 2 THEN 'F' || event_id || '.VAL=' || printf('%.2f', value)
    WHEN 3 THEN 'A' || event_id || '=x<y'
    ELSE CASE WHEN event_id % 20 = 4 THEN 'T' || event_id || '.TABLE<<' || CASE WHEN event_id % 40 = 4 THEN '|' ELSE '' END
              ELSE 'L' || event_id END END"""
_LINES_SQL = f"""l AS (SELECT user_id, event_id,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS line_no, {_LINE_SQL} AS line FROM events),
m AS (SELECT *, regexp_matches(line, '^[^?=]*<') AS ml,
    coalesce(sum(CASE WHEN line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY line_no
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS run FROM l),
r AS (SELECT *, min(CASE WHEN ml THEN line_no END) OVER (PARTITION BY user_id, run) AS opener,
    max(CASE WHEN line = '' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, run) AS closed FROM m),
k AS (SELECT *, coalesce(opener IS NOT NULL AND line_no >= opener, false) AS in_body FROM r),
st AS (SELECT user_id, CASE WHEN in_body THEN opener ELSE line_no END AS stmt_no, line_no, line
    FROM k WHERE NOT in_body OR closed = 1)"""


def state_file_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "ts", "value")
    eid = F.col("event_id").cast("string")
    line = (
        F.when(F.col("event_id") % 5 == 0, F.concat(F.lit("SEQ"), eid, F.lit(".TABLE<"),
                                                      F.when(F.col("event_id") % 10 == 0, "B").otherwise("")))
        .when(F.col("event_id") % 5 == 1, F.lit(""))
        .when(F.col("event_id") % 5 == 2, F.concat(F.lit("F"), eid, F.lit(".VAL="), F.format_string("%.2f", "value")))
        .when(F.col("event_id") % 5 == 3, F.concat(F.lit("A"), eid, F.lit("=x<y")))
        .when(F.col("event_id") % 20 == 4, F.concat(F.lit("T"), eid, F.lit(".TABLE<<"),
                                                     F.when(F.col("event_id") % 40 == 4, "|").otherwise("")))
        .otherwise(F.concat(F.lit("L"), eid))
    )
    lines = position_within(ev, ["user_id"], ["ts", "event_id"], out="line_no")
    return lines.select("user_id", "event_id", "line_no", line.alias("line"))


@register("is_multiline", f"""
SELECT event_id, regexp_matches({_LINE_SQL}, '^[^?=]*<') AS is_multiline FROM events""")
def is_multiline_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return state_file_lines(spark, sf_dir).select("event_id", is_multiline(F.col("line")).alias("is_multiline"))


@register("statements", f"""
WITH {_LINES_SQL}
SELECT user_id, stmt_no, count(*) AS n_lines FROM st GROUP BY ALL""")
def statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = segment_statements(state_file_lines(spark, sf_dir), ["user_id"])
    return seg.groupBy("user_id", "stmt_no").agg(F.count(F.lit(1)).alias("n_lines"))


#: Rows of a block in the queries over one hot key.
SPLIT_ROWS = 2000


@register("statements_long_run", """
WITH l AS (SELECT event_id, CASE WHEN event_id % 1009 = 3 THEN 'S' || event_id || '.TABLE<' ELSE 'L' || event_id END AS line FROM events),
o AS (SELECT min(event_id) AS opener FROM l WHERE line LIKE '%<'),
s AS (SELECT CASE WHEN event_id >= opener THEN opener ELSE event_id END AS stmt_no FROM l, o
      UNION ALL SELECT coalesce(opener, 1 << 62) FROM o)
SELECT stmt_no, count(*) AS n_lines FROM s GROUP BY stmt_no""")
def statements_long_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file of one run: every event is a line, and the only blank is the last."""
    ev = table(spark, sf_dir, "events", "event_id")
    name = F.col("event_id").cast("string")
    line = F.when(F.col("event_id") % 1009 == 3, F.concat(F.lit("S"), name, F.lit(".TABLE<"))).otherwise(F.concat(F.lit("L"), name))
    last = spark.range(1).select(F.lit(0).alias("file"), F.lit(1 << 62).alias("line_no"), F.lit("").alias("line"))
    lines = ev.select(F.lit(0).alias("file"), F.col("event_id").alias("line_no"), line.alias("line")).unionByName(last)
    seg = segment_statements(lines, ["file"], bucket_rows=SPLIT_ROWS)
    return seg.groupBy("stmt_no").agg(F.count(F.lit(1)).alias("n_lines"))


@register("positions_tied", """
SELECT event_id, row_number() OVER w - 1 AS pos, lag(event_id) OVER w AS before,
  last_value(CASE WHEN event_id % 50 = 7 THEN event_id END IGNORE NULLS) OVER (ORDER BY event_type, user_id, event_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS marked
FROM events WINDOW w AS (ORDER BY event_type, user_id, event_id)""")
def positions_tied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One key whose leading order column, a string, has a handful of values."""
    ev = table(spark, sf_dir, "events", "event_id", "event_type", "user_id").select(
        F.lit(0).alias("key"), "event_type", "user_id", "event_id", F.col("event_id").alias("e"),
        F.when(F.col("event_id") % 50 == 7, F.col("event_id")).alias("mark"),
    )
    scanned = ordered_scan(ev, ["key"], ["event_type", "user_id", "event_id"], out="pos", lag=["e"], fill=["mark"], bucket_rows=SPLIT_ROWS)
    return scanned.select("event_id", "pos", F.col("prev_e").alias("before"), F.col("last_mark").alias("marked"))


@register("state_rows", f"""
WITH {_LINES_SQL},
g AS (SELECT user_id, stmt_no, arg_min(line, line_no) AS first, count(*) AS n_lines,
        count(*) FILTER (WHERE line <> '' AND line_no > stmt_no) AS n_body FROM st GROUP BY ALL)
SELECT user_id, stmt_no,
  CASE WHEN regexp_matches(first, '^[^?=]*<') THEN
         CASE regexp_extract(first, '^[^<]*(<.*)$', 1) WHEN '<B' THEN 'table_b64' WHEN '<<|' THEN 'append_last'
              WHEN '<<' THEN 'append' ELSE 'multiline' END
       WHEN contains(first, '=') THEN 'value' ELSE 'raw' END AS kind,
  CASE WHEN regexp_matches(first, '^[^?=]*<') THEN regexp_extract(first, '^([^<]*)<', 1)
       WHEN contains(first, '=') THEN split_part(first, '=', 1) ELSE first END AS key,
  CASE WHEN NOT regexp_matches(first, '^[^?=]*<') AND contains(first, '=')
       THEN regexp_extract(first, '^[^=]*=(.*)$', 1) END AS value,
  CASE WHEN regexp_matches(first, '^[^?=]*<') THEN n_body ELSE 0 END AS n_body,
  n_lines
FROM g""")
def state_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    seg = segment_statements(state_file_lines(spark, sf_dir), ["user_id"])
    rows = statement_rows(seg, ["user_id"])
    return rows.select("user_id", "stmt_no", "kind", "key", "value", F.size("body").cast("long").alias("n_body"), "n_lines")


# ----------------------------------------------------------------------------- change feeds (events)

_CHANGE_SQL = """CASE event_id % 3 WHEN 0 THEN event_type || '.E' || event_id || '=' || printf('%.2f', value)
    WHEN 1 THEN event_type || '.E' || event_id || '<' ELSE event_type || '.E' || event_id || ' (error)' END"""


def change_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value")
    key = F.concat(F.col("event_type"), F.lit(".E"), F.col("event_id").cast("string"))
    line = (
        F.when(F.col("event_id") % 3 == 0, F.concat(key, F.lit("="), F.format_string("%.2f", "value")))
        .when(F.col("event_id") % 3 == 1, F.concat(key, F.lit("<")))
        .otherwise(F.concat(key, F.lit(" (error)")))
    )
    groups = F.array(*[F.lit(g) for g in CHANGE_GROUPS])
    return ev.select(
        "event_id", "user_id", "event_type", line.alias("line"),
        F.element_at(groups, (F.col("event_id") % 7 + 1).cast("int")).alias("group"),
    )


@register("classify_changes", f"""
SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'value' WHEN 1 THEN 'no_value' ELSE 'error' END AS kind,
  event_type || '.E' || event_id AS key,
  CASE WHEN event_id % 3 = 0 THEN printf('%.2f', value) END AS value FROM events""")
def classify_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = change_lines(spark, sf_dir)
    cls = classify_change(F.col("line"))
    return lines.select("event_id", cls["kind"].alias("kind"), cls["key"].alias("key"), cls["value"].alias("value"))


@register("change_groups", """
SELECT event_id, 'POSN' AS "group" FROM events WHERE event_id % 7 = 2""")
def change_groups(spark: SparkSession, sf_dir: str, group: str = "POSN") -> DataFrame:
    lines = change_lines(spark, sf_dir)
    return lines.where(F.col("group") == group).select("event_id", "group")


@register("latest_values", """
SELECT user_id, event_type, arg_max(value, event_id) AS latest FROM events GROUP BY ALL""")
def latest_values_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value")
    feed = ev.select(
        "event_id",
        F.concat(F.lit("U"), F.col("user_id").cast("string"), F.lit("."), F.col("event_type"), F.lit("="),
                 F.col("value").cast("string")).alias("line"),
    )
    cls = classify_change(F.col("line"))
    parsed = feed.select("event_id", cls["key"].alias("key"), cls["value"].cast("double").alias("value"))
    latest = latest_values(parsed, ["key"], "event_id")
    return latest.select(
        F.regexp_extract("key", r"^U(\d+)\.", 1).cast("long").alias("user_id"),
        F.regexp_extract("key", r"^U\d+\.(.*)$", 1).alias("event_type"),
        "latest",
    )


@register("fold_table_writes", """
WITH w AS (SELECT user_id, ts, event_id, printf('%.2f', value) AS row,
             CASE event_id % 4 WHEN 0 THEN 'replace' WHEN 3 THEN 'append_last' ELSE 'append' END AS op FROM events),
lr AS (SELECT user_id, max(ts) AS from_ts FROM w WHERE op = 'replace' GROUP BY user_id)
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS row_no, row
FROM w LEFT JOIN lr USING (user_id) WHERE lr.from_ts IS NULL OR w.ts >= lr.from_ts""")
def fold_table_writes_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "ts", "value")
    op = F.when(F.col("event_id") % 4 == 0, "replace").when(F.col("event_id") % 4 == 3, "append_last").otherwise("append")
    writes = ev.select("user_id", "ts", "event_id", op.alias("op"), F.array(F.format_string("%.2f", "value")).alias("rows"))
    folded = fold_table_writes(writes, ["user_id"], ["ts", "event_id"], "op", "rows")
    return folded.select("user_id", "row_no", "row")


@register("snapshot_changes", """
WITH b AS (SELECT o_orderkey k, CASE WHEN o_orderkey % 7 = 1 THEN 'X' ELSE o_orderstatus END v FROM orders
           WHERE o_orderkey % 7 <> 2)
SELECT coalesce(a.o_orderkey, b.k) AS k, a.o_orderstatus AS before, b.v AS after
FROM orders a FULL JOIN b ON a.o_orderkey = b.k WHERE a.o_orderstatus IS DISTINCT FROM b.v""")
def snapshot_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    b = a.where(F.col("o_orderkey") % 7 != 2).withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 7 == 1, F.lit("X")).otherwise(F.col("o_orderstatus"))
    )
    return snapshot_diff(a, b, "o_orderkey", "o_orderstatus")


@register("snapshot_merge", """
SELECT CASE WHEN o_orderkey % 11 = 4 THEN o_orderkey + 100000000 ELSE o_orderkey END AS key,
  CASE WHEN o_orderkey % 7 = 1 THEN 'second' WHEN o_orderkey % 11 = 4 THEN 'new' ELSE o_orderstatus END AS value,
  CASE WHEN o_orderkey % 11 <> 4 THEN o_orderstatus END AS before
FROM orders WHERE o_orderkey % 13 <> 5 OR o_orderkey % 7 = 1
UNION ALL SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 1 THEN 'second' ELSE o_orderstatus END, o_orderstatus
FROM orders WHERE o_orderkey % 11 = 4 AND (o_orderkey % 13 <> 5 OR o_orderkey % 7 = 1)""")
def snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a stored snapshot; a feed changes some fields twice, removes
    some and brings new ones."""
    from strobe.operators.snapshots import merged, write_snapshot

    o = table(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    snapshot = write_snapshot(o, "o_orderkey", "o_orderstatus")
    k = F.col("o_orderkey")
    twice = F.array(F.struct(F.lit(1).alias("seq"), F.lit("first").alias("v")), F.struct(F.lit(3).alias("seq"), F.lit("second").alias("v")))
    feed = o.where(k % 7 == 1).select(k.alias("field"), F.explode(twice).alias("c")).select("field", "c.seq", "c.v")
    gone = o.where(k % 13 == 5).select(k.alias("field"), F.lit(2).alias("seq"), F.lit(None).cast("string").alias("v"))
    kept = (k % 13 != 5) | (k % 7 == 1)
    new = o.where((k % 11 == 4) & kept).select((k + 100000000).alias("field"), F.lit(1).alias("seq"), F.when(k % 7 == 1, "second").otherwise("new").alias("v"))
    return merged(spark, snapshot, feed.unionByName(gone).unionByName(new), "field", "v", "seq").select("key", "value", "before")


# ----------------------------------------------------------------------------- saved state (orders)

_STATE_SQL = f"""{_WORDS_SQL},
tb AS (SELECT l_orderkey, to_base64(unhex(string_agg(
          printf('%02x%02x%02x%02x', w0 & 255, (w0 >> 8) & 255, (w0 >> 16) & 255, (w0 >> 24) & 255) ||
          printf('%02x%02x%02x%02x', w1 & 255, (w1 >> 8) & 255, (w1 >> 16) & 255, (w1 >> 24) & 255) ||
          printf('%02x%02x%02x%02x', w2 & 255, (w2 >> 8) & 255, (w2 >> 16) & 255, (w2 >> 24) & 255),
          '' ORDER BY row_idx))) AS b64 FROM li GROUP BY l_orderkey),
o AS (SELECT o_orderpriority AS snapshot, o_orderkey AS k, o_orderkey % 4 AS g, * FROM orders),
e AS (
  SELECT snapshot, 0 AS r0, 0 AS r1, k AS r2, ['ORD' || k || '.STATUS=' || o_orderstatus] AS lines
    FROM o WHERE g = 0 AND o_orderstatus <> 'P'
  UNION ALL SELECT snapshot, 0, 1, k, ['ORD' || k || '.CUST=' || o_custkey] FROM o WHERE g = 1
  UNION ALL SELECT snapshot, 0, 2, k, ['*METADATA.ORD' || k || '=' || o_orderstatus] FROM o WHERE g = 2 AND k % 8 <> 2
  UNION ALL SELECT snapshot, 1, 0, k, list_concat(['ORD' || k || '.TABLE<B'], CASE WHEN b64 IS NULL THEN [] ELSE [b64] END, [''])
    FROM o LEFT JOIN tb ON tb.l_orderkey = o.k WHERE g = 3
  UNION ALL SELECT snapshot, 2, 0, k, ['*METADATA.ORD' || k || '<', strftime(o_orderdate, '%Y-%m-%d'), printf('%.2f', o_totalprice), '']
    FROM o WHERE g = 2 AND k % 8 = 2),
n AS (SELECT *, coalesce(sum(len(lines)) OVER (PARTITION BY snapshot ORDER BY r0, r1, r2
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS base FROM e)"""


def state_feeds(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``*CHANGES`` replies of the ATTR/CONFIG/METADATA/TABLE groups per device
    (snapshot = order priority) and the multi-line values they point to."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
              "o_orderpriority")
    k = F.col("o_orderkey").cast("string")
    g = F.col("o_orderkey") % 4
    group = F.element_at(F.array(*[F.lit(x) for x in ("ATTR", "CONFIG", "METADATA", "TABLE")]), (g + 1).cast("int"))
    line = (
        F.when((g == 0) & (F.col("o_orderstatus") == "P"), F.concat(F.lit("ORD"), k, F.lit(".STATUS (error)")))
        .when(g == 0, F.concat(F.lit("ORD"), k, F.lit(".STATUS="), F.col("o_orderstatus")))
        .when(g == 1, F.concat(F.lit("ORD"), k, F.lit(".CUST="), F.col("o_custkey").cast("string")))
        .when((g == 2) & (F.col("o_orderkey") % 8 == 2), F.concat(F.lit("*METADATA.ORD"), k, F.lit("<")))
        .when(g == 2, F.concat(F.lit("*METADATA.ORD"), k, F.lit("="), F.col("o_orderstatus")))
        .otherwise(F.concat(F.lit("ORD"), k, F.lit(".TABLE<")))
    )
    changes = o.select(F.col("o_orderpriority").alias("snapshot"), group.alias("group"),
                       F.col("o_orderkey").alias("seq"), line.alias("line"))
    tables = packed_tables(spark, sf_dir).select(
        F.concat(F.lit("ORD"), F.col("l_orderkey").cast("string"), F.lit(".TABLE")).alias("field"),
        F.array(words_to_base64(F.col("words"))).alias("values"), F.col("l_orderkey"),
    )
    table_vals = o.where(g == 3).select(F.col("o_orderpriority").alias("snapshot"), "o_orderkey").join(
        tables, F.col("o_orderkey") == F.col("l_orderkey")
    ).select("snapshot", "field", "values")
    meta_vals = o.where((g == 2) & (F.col("o_orderkey") % 8 == 2)).select(
        F.col("o_orderpriority").alias("snapshot"),
        F.concat(F.lit("*METADATA.ORD"), k).alias("field"),
        F.array(F.date_format("o_orderdate", "yyyy-MM-dd"), F.format_string("%.2f", "o_totalprice")).alias("values"),
    )
    return changes, table_vals.unionByName(meta_vals)


@register("state_lines", f"""
WITH {_STATE_SQL}
SELECT snapshot, CAST(base + i - 1 AS BIGINT) AS line_no, lines[i] AS line
FROM (SELECT *, unnest(generate_series(1, len(lines))) AS i FROM n)""")
def state_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes, multiline = state_feeds(spark, sf_dir)
    entries = state_entries(changes, multiline, ["snapshot"])
    return entries_to_lines(entries, ["snapshot"])
