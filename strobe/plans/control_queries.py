"""Check queries for control transcripts (§2.8 C9-C15, §2.4 J2-J6) and the
device catalogue (§2.10, A5, O1, O2), each with a DuckDB oracle.

Stand-ins: requests/replies are ``conversations`` turns; reply lines and
statements are built from ``events`` per user; identity replies from
``supplier``; blocks from ``nation``/``region``; fields from ``part``; bit
labels from ``customer``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strobe.operators.catalogue import (
    FIELD_TYPES,
    bit_word_fields,
    expand_instances,
    instance_block,
    ordered_labels,
    parse_block_lines,
    parse_field_lines,
    with_shape,
)
from strobe.operators.ordering import position_within
from strobe.operators.state import segment_statements
from strobe.operators.transcript import (
    MODE_MIN_VERSION,
    api_version,
    frame_replies,
    identity,
    pair_fifo,
    replies,
    reply_value,
    version_at_least,
)
from strobe.plans.config_queries import _LINES_SQL, state_file_lines
from strobe.plans.registry import register
from strobe.plans.tables import table

# ----------------------------------------------------------------------------- FIFO pairing


@register("pair_requests", """
WITH q AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) n FROM conversations WHERE role='user'),
a AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) n FROM conversations WHERE role='assistant')
SELECT coalesce(q.conv_id, a.conv_id) AS conv_id, coalesce(q.n, a.n) AS n, q.turn AS request_turn, a.turn AS reply_turn
FROM q FULL JOIN a ON q.conv_id = a.conv_id AND q.n = a.n""")
def pair_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations", "conv_id", "turn", "role")
    rq = conv.where(F.col("role") == "user").select("conv_id", "turn")
    rp = conv.where(F.col("role") == "assistant").select("conv_id", "turn")
    paired = pair_fifo(rq, rp, ["conv_id"], "turn")
    return paired.select("conv_id", (F.col("n") + 1).alias("n"), "request_turn", "reply_turn")


@register("regroup_replies", """
WITH q AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) n FROM conversations WHERE role='user'),
a AS (SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) n FROM conversations WHERE role='assistant'),
p AS (SELECT q.conv_id, q.n, a.turn AS reply_turn FROM q LEFT JOIN a ON q.conv_id = a.conv_id AND q.n = a.n)
SELECT conv_id, string_agg(coalesce(CAST(reply_turn AS VARCHAR), '-'), ',' ORDER BY n) AS replies FROM p GROUP BY conv_id""")
def regroup_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies of one command's sub-requests, returned in request order (a
    command's fan-out is bounded, so the per-command list is small)."""
    conv = table(spark, sf_dir, "conversations", "conv_id", "turn", "role")
    rq = conv.where(F.col("role") == "user").select("conv_id", "turn")
    rp = conv.where(F.col("role") == "assistant").select("conv_id", "turn")
    paired = pair_fifo(rq, rp, ["conv_id"], "turn").where(F.col("request_turn").isNotNull())
    grouped = paired.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("n", "reply_turn"))).alias("r")
    )
    return grouped.select(
        "conv_id",
        F.array_join(F.transform("r", lambda x: F.coalesce(x["reply_turn"].cast("string"), F.lit("-"))), ",").alias("replies"),
    )


# ----------------------------------------------------------------------------- reply framing (events per user)

_REPLY_LINE_SQL = """CASE WHEN seq = n - 1 THEN '.' ELSE CASE event_id % 5
    WHEN 0 THEN '!' || printf('%.2f', value) WHEN 1 THEN '!' || event_type WHEN 2 THEN '.'
    WHEN 3 THEN 'OK =' || printf('%.2f', value)
    ELSE CASE WHEN event_id % 10 = 9 THEN 'ERR No such field' ELSE 'OK' END END END"""
_REPLIES_SQL = f"""rl0 AS (SELECT user_id, event_id, value, event_type,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS seq, count(*) OVER (PARTITION BY user_id) AS n
  FROM events),
rl AS (SELECT user_id, seq, {_REPLY_LINE_SQL} AS line FROM rl0),
rf AS (SELECT *, coalesce(sum(CASE WHEN line = '.' OR NOT starts_with(line, '!') THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS reply_no FROM rl),
rg AS (SELECT user_id, reply_no, count(*) AS n_lines, arg_max(line, seq) AS last, arg_min(line, seq) AS first,
    string_agg(substr(line, 2), '|' ORDER BY seq) FILTER (WHERE starts_with(line, '!')) AS items,
    count(*) FILTER (WHERE starts_with(line, '!')) AS n_items
  FROM rf GROUP BY ALL),
rk AS (SELECT *, CASE WHEN NOT (last = '.' OR NOT starts_with(last, '!')) THEN 'open' WHEN last = '.' THEN 'multiline'
    WHEN n_lines = 1 THEN 'single' ELSE 'error' END AS kind FROM rg)"""


def reply_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events", "event_id", "user_id", "ts", "event_type", "value")
    ev = position_within(ev, ["user_id"], ["ts", "event_id"], out="seq")
    n = ev.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    ev = ev.join(n, "user_id")
    m = F.col("event_id") % 5
    line = (
        F.when(F.col("seq") == F.col("n") - 1, F.lit("."))
        .when(m == 0, F.concat(F.lit("!"), F.format_string("%.2f", "value")))
        .when(m == 1, F.concat(F.lit("!"), F.col("event_type")))
        .when(m == 2, F.lit("."))
        .when(m == 3, F.concat(F.lit("OK ="), F.format_string("%.2f", "value")))
        .when(F.col("event_id") % 10 == 9, F.lit("ERR No such field"))
        .otherwise(F.lit("OK"))
    )
    return ev.select("user_id", "seq", line.alias("line"))


def _replies(spark, sf_dir) -> DataFrame:
    return replies(frame_replies(reply_lines(spark, sf_dir), ["user_id"]), ["user_id"])


@register("reply_frames", f"""
WITH {_REPLIES_SQL}
SELECT user_id, reply_no, n_lines, kind FROM rk""")
def reply_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _replies(spark, sf_dir)
    return r.select("user_id", "reply_no", F.size("lines").cast("long").alias("n_lines"), "kind")


@register("reply_values", f"""
WITH {_REPLIES_SQL}
SELECT user_id, reply_no,
  CASE WHEN kind = 'multiline' THEN 'multiline' WHEN kind = 'single' AND first = 'OK' THEN 'ok'
       WHEN kind = 'single' AND starts_with(first, 'OK =') THEN 'value' ELSE 'error' END AS status,
  CASE WHEN kind = 'single' AND starts_with(first, 'OK =') THEN substr(first, 5) END AS value,
  CASE WHEN kind = 'multiline' THEN coalesce(items, '') END AS items,
  CASE WHEN kind = 'multiline' THEN n_items END AS n_items
FROM rk""")
def reply_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _replies(spark, sf_dir)
    v = reply_value(F.col("lines"), F.col("kind"))
    return r.select(
        "user_id", "reply_no", v["status"].alias("status"), v["value"].alias("value"),
        F.array_join(v["items"], "|").alias("items"), F.size(v["items"]).cast("long").alias("n_items"),
    ).withColumn("n_items", F.when(F.col("status") == "multiline", F.col("n_items")))


@register("failed_statements", f"""
WITH {_LINES_SQL}, {_REPLIES_SQL},
sn AS (SELECT user_id, stmt_no, row_number() OVER (PARTITION BY user_id ORDER BY stmt_no) AS n
       FROM (SELECT DISTINCT user_id, stmt_no FROM st)),
rn AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY reply_no) AS n FROM rk WHERE kind <> 'open')
SELECT sn.user_id, sn.stmt_no FROM sn JOIN rn ON sn.user_id = rn.user_id AND sn.n = rn.n
WHERE NOT (rn.kind = 'single' AND rn.first = 'OK')""")
def failed_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statements sent from a state file whose reply is not exactly ``OK``:
    FIFO pairing of statements with replies, then a semi-join on the bad
    replies."""
    seg = segment_statements(state_file_lines(spark, sf_dir), ["user_id"])
    stmts = seg.select("user_id", "stmt_no").distinct()
    reps = _replies(spark, sf_dir).where(F.col("kind") != "open")
    sn = position_within(stmts, ["user_id"], ["stmt_no"], out="n")
    rn = position_within(reps, ["user_id"], ["reply_no"], out="n")
    bad = rn.where(~((F.col("kind") == "single") & (F.get(F.col("lines"), 0) == "OK"))).select("user_id", "n")
    return sn.join(bad, ["user_id", "n"], "left_semi").select("user_id", "stmt_no")


# ----------------------------------------------------------------------------- identity and versions (supplier)

_IDN_SQL = """idn AS (SELECT s_suppkey, CASE WHEN s_suppkey % 9 = 0 THEN 'garbage ' || s_name
  ELSE 'DEV SW: ' || (CASE s_suppkey % 4 WHEN 0 THEN (s_suppkey % 5) || '.' || (s_suppkey % 3) WHEN 1 THEN '10'
        WHEN 2 THEN (s_suppkey % 7) || 'x' || (s_suppkey % 9) ELSE (s_suppkey % 6) || '.' || (s_suppkey % 11) || '.2' END)
    || ' FPGA: ' || s_nationkey || '.0.' || s_suppkey || ' build ' || s_suppkey || ' rootfs: DEV ' || (s_suppkey % 4) || '.' || s_nationkey
  END AS line FROM supplier),
idp AS (SELECT s_suppkey,
  CASE WHEN regexp_matches(line, '^\\S+ SW: (.*) FPGA: (.*) rootfs: (.*)') THEN regexp_extract(line, '^\\S+ SW: (.*) FPGA: (.*) rootfs: (.*)', 1) END AS software,
  CASE WHEN regexp_matches(line, '^\\S+ SW: (.*) FPGA: (.*) rootfs: (.*)') THEN regexp_extract(line, '^\\S+ SW: (.*) FPGA: (.*) rootfs: (.*)', 2) END AS fpga,
  CASE WHEN regexp_matches(line, '^\\S+ SW: (.*) FPGA: (.*) rootfs: (.*)') THEN regexp_extract(line, '^\\S+ SW: (.*) FPGA: (.*) rootfs: (.*)', 3) END AS rootfs
  FROM idn),
apv AS (SELECT s_suppkey, software,
  CASE WHEN regexp_matches(software, '^(\\d+).(\\d+)') THEN CAST(regexp_extract(software, '^(\\d+).(\\d+)', 1) AS INTEGER) END AS major,
  CASE WHEN regexp_matches(software, '^(\\d+).(\\d+)') THEN CAST(regexp_extract(software, '^(\\d+).(\\d+)', 2) AS INTEGER) END AS minor
  FROM idp)"""


def identity_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier", "s_suppkey", "s_name", "s_nationkey")
    k = F.col("s_suppkey")
    sw = (
        F.when(k % 4 == 0, F.format_string("%d.%d", k % 5, k % 3))
        .when(k % 4 == 1, F.lit("10"))
        .when(k % 4 == 2, F.format_string("%dx%d", k % 7, k % 9))
        .otherwise(F.format_string("%d.%d.2", k % 6, k % 11))
    )
    line = F.when(k % 9 == 0, F.concat(F.lit("garbage "), F.col("s_name"))).otherwise(
        F.format_string("DEV SW: %s FPGA: %d.0.%d build %d rootfs: DEV %d.%d", sw, F.col("s_nationkey"), k, k, k % 4, F.col("s_nationkey"))
    )
    return s.select("s_suppkey", line.alias("line"))


def _identities(spark, sf_dir) -> DataFrame:
    idn = identity_lines(spark, sf_dir)
    parts = identity(F.col("line"))
    return idn.select("s_suppkey", *[v.alias(k) for k, v in parts.items()])


@register("identity", f"""
WITH {_IDN_SQL} SELECT s_suppkey, software, fpga, rootfs FROM idp""")
def identity_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _identities(spark, sf_dir)


@register("api_version", f"""
WITH {_IDN_SQL} SELECT s_suppkey, major, minor FROM apv""")
def api_version_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _identities(spark, sf_dir)
    v = api_version(F.col("software"))
    return ids.select("s_suppkey", v["major"].alias("major"), v["minor"].alias("minor"))


@register("version_gate", f"""
WITH {_IDN_SQL}
SELECT s_suppkey, (major > 4 OR (major = 4 AND minor >= 0)) AS has_mode,
       (major > 4 OR (major = 4 AND minor >= 0)) AS append_last_allowed FROM apv WHERE major IS NOT NULL""")
def version_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = _identities(spark, sf_dir)
    v = api_version(F.col("software"))
    ok = version_at_least(v["major"], v["minor"], MODE_MIN_VERSION)
    return ids.where(v["major"].isNotNull()).select(
        "s_suppkey", ok.alias("has_mode"), ok.alias("append_last_allowed")
    )


# ----------------------------------------------------------------------------- blocks (nation, region)


def block_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation", "n_nationkey", "n_name", "n_regionkey")
    return n.select("n_regionkey", F.format_string("%s %d", F.col("n_name"), F.col("n_regionkey") + 1).alias("line"))


def block_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    return r.where(F.col("r_regionkey") < 4).select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("description"))


@register("blocks_sorted", """
SELECT n_name AS block, n_regionkey + 1 AS number, r_name AS description,
       row_number() OVER (ORDER BY n_name, n_regionkey + 1, r_name) - 1 AS position
FROM nation LEFT JOIN region ON r_regionkey = n_regionkey AND r_regionkey < 4""")
def blocks_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = parse_block_lines(block_lines(spark, sf_dir))
    described = blocks.join(F.broadcast(block_descriptions(spark, sf_dir)), "n_regionkey", "left")
    # a device catalogue has a bounded number of blocks: one ordered window
    w = Window.orderBy("block", "number", "description")
    return described.select(
        "block", "number", "description", (F.row_number().over(w) - 1).cast("long").alias("position")
    )


@register("expand_instances", """
SELECT n_name AS block, CASE WHEN n_regionkey = 0 THEN n_name ELSE n_name || i END AS instance
FROM nation, range(1, 6) r(i) WHERE i <= n_regionkey + 1""")
def expand_instances_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = parse_block_lines(block_lines(spark, sf_dir))
    return expand_instances(blocks).select("block", "instance")


@register("instance_block", """
SELECT instance, regexp_replace(instance, '[0-9]+$', '') AS block FROM (
  SELECT CASE WHEN n_regionkey = 0 THEN n_name ELSE n_name || i END AS instance
  FROM nation, range(1, 6) r(i) WHERE i <= n_regionkey + 1)""")
def instance_block_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    inst = expand_instances(parse_block_lines(block_lines(spark, sf_dir)))
    return inst.select("instance", instance_block(F.col("instance")).alias("block"))


# ----------------------------------------------------------------------------- fields (part)

_UNKNOWN_PAIRS = ["foo", "flibble bibble", "param unknown"]
_PAIR_TEXT = [t if s is None else f"{t} {s}" for t, s, _ in FIELD_TYPES] + _UNKNOWN_PAIRS
_PAIRS_SQL = "(VALUES " + ", ".join(
    f"({i}, '{txt}', '{txt.split()[0]}', {repr(txt.split()[1]) if len(txt.split()) > 1 else 'NULL'}, "
    f"'{FIELD_TYPES[i][2] if i < len(FIELD_TYPES) else 'unknown'}')"
    for i, txt in enumerate(_PAIR_TEXT)
) + ") tp(k, txt, type, subtype, shape)"
_FIELDS_SQL = f"""fl AS (SELECT p_brand AS block, 'F' || p_partkey AS field, p_partkey, p_name, p_size, p_retailprice,
    CAST(p_size * 100000 + p_partkey AS BIGINT) AS field_index, tp.type, tp.subtype, tp.shape
  FROM part JOIN {_PAIRS_SQL} ON tp.k = p_partkey % {len(_PAIR_TEXT)})"""


def field_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_name", "p_size", "p_retailprice")
    pairs = F.array(*[F.lit(x) for x in _PAIR_TEXT])
    ts = F.element_at(pairs, (F.col("p_partkey") % len(_PAIR_TEXT) + 1).cast("int"))
    line = F.format_string("F%d %d %s", F.col("p_partkey"), F.col("p_size") * 100000 + F.col("p_partkey"), ts)
    return p.select(F.col("p_brand").alias("block"), "p_partkey", "p_name", "p_size", "p_retailprice", line.alias("line"))


def _fields(spark, sf_dir) -> DataFrame:
    return with_shape(parse_field_lines(field_lines(spark, sf_dir)), spark)


@register("fields_ordered", f"""
WITH {_FIELDS_SQL}
SELECT block, field, field_index, type, subtype,
       row_number() OVER (PARTITION BY block ORDER BY field_index) - 1 AS position FROM fl""")
def fields_ordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = parse_field_lines(field_lines(spark, sf_dir))
    # fields of one block are bounded by the block definition
    w = Window.partitionBy("block").orderBy("field_index")
    return f.select(
        "block", "field", "field_index", "type", "subtype", (F.row_number().over(w) - 1).cast("long").alias("position")
    )


@register("unknown_types", f"""
WITH {_FIELDS_SQL} SELECT block, field, type, subtype FROM fl WHERE shape = 'unknown'""")
def unknown_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = parse_field_lines(field_lines(spark, sf_dir))
    from strobe.operators.catalogue import dispatch_table

    d = dispatch_table(spark).select(F.col("type").alias("__t"), F.col("subtype").alias("__s"))
    unknown = f.join(d, (f["type"] == d["__t"]) & f["subtype"].eqNullSafe(d["__s"]), "left_anti")
    return unknown.select("block", "field", "type", "subtype")


_LABELS_BY_SHAPE = {
    "time": ["min", "s", "ms", "us"],
    "subtype_time": ["min", "s", "ms", "us"],
    "bit_mux": ["ZERO", "ONE"],
    "pos_out": ["No", "Value", "Diff", "Sum", "Min", "Max"],
    "ext_out": ["No", "Value"],
    "ext_out_bits": ["No", "Value"],
}


def field_attributes(fields: DataFrame) -> DataFrame:
    """Attribute replies per field as rows (block, field, attr, pos, value),
    by shape, generated in one pass: each field explodes the attribute array
    its shape calls for."""

    def kv(attr, values):
        return F.transform(
            F.array(*values) if isinstance(values, list) else values,
            lambda v, i: F.struct(F.lit(attr).alias("attr"), i.alias("pos"), v.alias("value")),
        )

    def labels(xs):
        return kv("LABEL", [F.lit(x) for x in xs])

    shape = F.col("shape")
    empty = F.array().cast("array<struct<attr:string,pos:int,value:string>>")
    attrs = F.when(shape == "uint", kv("MAX", [(F.col("p_size") * 1000).cast("string")]))
    attrs = attrs.when(shape == "scalar", F.concat(
        kv("UNITS", [F.lit("mm")]), kv("SCALE", [(F.col("p_retailprice") / 1000).cast("string")]),
        kv("OFFSET", [F.col("p_size").cast("string")]),
    ))
    attrs = attrs.when(shape == "enum", kv("LABEL", F.split(F.col("p_name"), " ")))
    attrs = attrs.when(shape == "pos_mux", kv("LABEL", [F.lit("ZERO"), F.upper("p_name")]))
    for name, xs in _LABELS_BY_SHAPE.items():
        attrs = attrs.when(shape == name, labels(xs))
    attrs = attrs.otherwise(empty)
    return fields.select("block", "field", F.explode(attrs).alias("a")).select(
        "block", "field", "a.attr", "a.pos", "a.value"
    )


@register("typed_fields", f"""
WITH {_FIELDS_SQL}
SELECT block, field, shape,
  CASE WHEN shape = 'uint' THEN CAST(p_size * 1000 AS BIGINT) END AS max_val,
  CASE WHEN shape = 'scalar' THEN 'mm' END AS units,
  CASE WHEN shape = 'scalar' THEN round(p_retailprice / 1000, 6) END AS scale,
  CASE WHEN shape = 'scalar' THEN CAST(p_size AS BIGINT) END AS "offset",
  CASE WHEN shape IN ('enum', 'pos_mux', 'bit_mux', 'ext_out', 'ext_out_bits') THEN CAST(2 AS BIGINT)
       WHEN shape IN ('time', 'subtype_time') THEN CAST(4 AS BIGINT) WHEN shape = 'pos_out' THEN CAST(6 AS BIGINT) END AS n_labels
FROM fl""")
def typed_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed metadata per field: attribute rows joined back and pivoted into
    one nullable column per attribute; the shape comes from the 33-row
    dispatch table."""
    f = _fields(spark, sf_dir)
    attrs = field_attributes(f)
    singles = attrs.where(F.col("attr") != "LABEL").groupBy("block", "field").pivot("attr", ["MAX", "UNITS", "SCALE", "OFFSET"]).agg(F.first("value"))
    labels = ordered_labels(attrs.where(F.col("attr") == "LABEL"), ["block", "field"], "pos", "value")
    j = f.select("block", "field", "shape").join(singles, ["block", "field"], "left").join(labels, ["block", "field"], "left")
    return j.select(
        "block", "field", "shape",
        F.col("MAX").cast("long").alias("max_val"), F.col("UNITS").alias("units"),
        F.round(F.col("SCALE").cast("double"), 6).alias("scale"),
        F.col("OFFSET").cast("long").alias("offset"),
        F.size("labels").cast("long").alias("n_labels"),
    ).withColumn("n_labels", F.when(F.col("n_labels") >= 0, F.col("n_labels")))


@register("label_lists", f"""
WITH {_FIELDS_SQL} SELECT block, field, replace(p_name, ' ', ',') AS labels FROM fl WHERE shape = 'enum'""")
def label_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _fields(spark, sf_dir)
    attrs = field_attributes(f.where(F.col("shape") == "enum"))
    lists = ordered_labels(attrs.where(F.col("attr") == "LABEL"), ["block", "field"], "pos", "value")
    return lists.select("block", "field", F.array_join("labels", ",").alias("labels"))


@register("catalogue_join", f"""
WITH {_FIELDS_SQL}
SELECT block, field, CASE WHEN p_partkey % 4 <> 0 THEN 'Field ' || p_name END AS description FROM fl""")
def catalogue_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _fields(spark, sf_dir)
    p = table(spark, sf_dir, "part", "p_partkey", "p_brand", "p_name")
    desc = p.where(F.col("p_partkey") % 4 != 0).select(
        F.col("p_brand").alias("block"), F.format_string("F%d", "p_partkey").alias("field"),
        F.concat(F.lit("Field "), F.col("p_name")).alias("description"),
    )
    return f.select("block", "field").join(desc, ["block", "field"], "left")


# ----------------------------------------------------------------------------- bit words (nation, customer)

_BITS_SQL = """pl AS (SELECT n_nationkey, CASE n_nationkey % 3
    WHEN 0 THEN 'BITS' || n_nationkey || ' ' || n_nationkey || ' ext_out bits'
    WHEN 1 THEN 'VAL' || n_nationkey || ' ' || n_nationkey || ' param uint'
    ELSE 'OUT' || n_nationkey || ' ' || n_nationkey || ' bit_out' END AS line FROM nation),
bl AS (SELECT c_nationkey, c_name, row_number() OVER (PARTITION BY c_nationkey ORDER BY c_custkey) - 1 AS bit FROM customer)"""


def pcap_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation", "n_nationkey")
    k = F.col("n_nationkey")
    line = (
        F.when(k % 3 == 0, F.format_string("BITS%d %d ext_out bits", k, k))
        .when(k % 3 == 1, F.format_string("VAL%d %d param uint", k, k))
        .otherwise(F.format_string("OUT%d %d bit_out", k, k))
    )
    return n.select(line.alias("line"))


def bit_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(word, bit, label): the labels of word ``PCAP.BITS<k>`` are the customers
    of nation k in key order."""
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_nationkey")
    ranked = position_within(c, ["c_nationkey"], ["c_custkey"], out="bit")
    return ranked.select(F.format_string("PCAP.BITS%d", "c_nationkey").alias("word"), "bit", F.col("c_name").alias("label"))


@register("bit_fields", f"""
WITH {_BITS_SQL}
SELECT 'PCAP.BITS' || n_nationkey AS word, count(c_name) AS n_labels, string_agg(c_name, '|' ORDER BY bit) AS labels
FROM pl JOIN bl ON bl.c_nationkey = pl.n_nationkey WHERE n_nationkey % 3 = 0 GROUP BY n_nationkey""")
def bit_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = bit_word_fields(pcap_lines(spark, sf_dir)).select("word")
    labels = ordered_labels(bit_labels(spark, sf_dir), ["word"], "bit", "label")
    j = words.join(labels, "word")
    return j.select("word", F.size("labels").cast("long").alias("n_labels"), F.array_join("labels", "|").alias("labels"))


@register("signal_bits", f"""
WITH {_FIELDS_SQL}, {_BITS_SQL}
SELECT fl.field, 'PCAP.BITS' || ((p_partkey % 8) * 3) AS capture_word, CAST(p_partkey % 32 AS BIGINT) AS bit_offset,
       bl.c_name AS label
FROM fl LEFT JOIN bl ON bl.c_nationkey = (p_partkey % 8) * 3 AND bl.bit = p_partkey % 32
WHERE fl.shape = 'bit_out'""")
def signal_bits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """bit_out signals -> (capture word, bit offset) -> the label at that bit."""
    f = _fields(spark, sf_dir).where(F.col("shape") == "bit_out")
    sig = f.select(
        "field", F.format_string("PCAP.BITS%d", (F.col("p_partkey") % 8) * 3).alias("capture_word"),
        (F.col("p_partkey") % 32).cast("long").alias("bit_offset"),
    )
    labels = bit_labels(spark, sf_dir).select(F.col("word").alias("capture_word"), F.col("bit").alias("bit_offset"), "label")
    return sig.join(labels, ["capture_word", "bit_offset"], "left").select("field", "capture_word", "bit_offset", "label")


# ----------------------------------------------------------------------------- change feed values (events)


@register("attach_values", """
SELECT event_id, CASE WHEN event_id % 2 = 0 THEN CAST(2 AS BIGINT) ELSE CAST(0 AS BIGINT) END AS n_values,
  CASE WHEN event_id % 2 = 0 THEN printf('%.2f', value) || '|' || event_type ELSE '' END AS "values"
FROM events WHERE event_id % 3 = 1""")
def attach_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changed multi-line fields joined to their value lines (left join, an
    empty list when the field's reply has no lines)."""
    from strobe.operators.state import classify_change
    from strobe.plans.config_queries import change_lines

    lines = change_lines(spark, sf_dir)
    cls = classify_change(F.col("line"))
    multi = lines.select("event_id", cls["kind"].alias("kind"), cls["key"].alias("field")).where(F.col("kind") == "no_value")
    ev = table(spark, sf_dir, "events", "event_id", "event_type", "value")
    value_lines = ev.where(F.col("event_id") % 2 == 0).select(
        F.concat(F.col("event_type"), F.lit(".E"), F.col("event_id").cast("string")).alias("field"),
        F.posexplode(F.array(F.format_string("%.2f", "value"), F.col("event_type"))).alias("pos", "line"),
    )
    vals = ordered_labels(value_lines, ["field"], "pos", "line").withColumnRenamed("labels", "values")
    j = multi.join(vals, "field", "left").withColumn("values", F.coalesce("values", F.array().cast("array<string>")))
    return j.select("event_id", F.size("values").cast("long").alias("n_values"), F.array_join("values", "|").alias("values"))
