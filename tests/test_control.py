"""Transcripts, identity/version rules and the device catalogue."""

import pytest
from pyspark.sql import functions as F

from strobe.operators.catalogue import (
    bit_word_fields,
    expand_instances,
    instance_block,
    ordered_labels,
    parse_block_lines,
    parse_field_lines,
    with_shape,
)
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


def _lines(spark, lines):
    return spark.createDataFrame([(0, i, x) for i, x in enumerate(lines)], "conn long, seq long, line string")


def test_reply_framing_and_values(spark):
    lines = ["OK =1", "!1048576", "!0", "!1000", "!1000", ".", "OK", ".", "ERR No such field", "!a", "b", "!open"]
    r = replies(frame_replies(_lines(spark, lines), ["conn"]), ["conn"])
    v = reply_value(F.col("lines"), F.col("kind"))
    got = r.select("reply_no", "kind", v["status"].alias("s"), v["value"].alias("v"), v["items"].alias("i")).orderBy("reply_no").collect()
    assert [(x["kind"], x["s"], x["v"], x["i"]) for x in got] == [
        ("single", "value", "1", None),
        ("multiline", "multiline", None, ["1048576", "0", "1000", "1000"]),
        ("single", "ok", None, None),
        ("multiline", "multiline", None, []),
        ("single", "error", None, None),
        ("error", "error", None, None),  # a non-! line inside a multi-line reply
        ("open", "error", None, None),
    ]


def test_fifo_pairing(spark):
    rq = spark.createDataFrame([(0, 1), (0, 3), (0, 5)], "conn long, turn long")
    rp = spark.createDataFrame([(0, 2), (0, 4), (1, 9)], "conn long, turn long")
    got = sorted(tuple(r) for r in pair_fifo(rq, rp, ["conn"], "turn").collect())
    assert got == [(0, 0, 1, 2), (0, 1, 3, 4), (0, 2, 5, None), (1, 0, None, 9)]


def test_identity_and_versions(spark):
    df = spark.createDataFrame([("DEV SW: 4.1 FPGA: 4.1.0 816147d6 00000000 rootfs: DEV 4.1",), ("garbage",)], "line string")
    idn = identity(F.col("line"))
    rows = df.select(idn["software"].alias("sw"), idn["fpga"].alias("fpga"), idn["rootfs"].alias("rootfs")).collect()
    assert tuple(rows[0]) == ("4.1", "4.1.0 816147d6 00000000", "DEV 4.1")
    assert tuple(rows[1]) == (None, None, None)
    sw = spark.createDataFrame([("4.1",), ("10",), ("3x9",), ("4.0",), ("3.9",)], "s string")
    v = api_version(F.col("s"))
    out = sw.select(v["major"], v["minor"], version_at_least(v["major"], v["minor"], MODE_MIN_VERSION)).collect()
    assert [tuple(r) for r in out] == [(4, 1, True), (None, None, None), (3, 9, False), (4, 0, True), (3, 9, False)]


def test_blocks_and_instances(spark):
    blocks = parse_block_lines(spark.createDataFrame([("PCAP 1",), ("LUT 8",)], "line string"))
    assert [tuple(r) for r in blocks.orderBy("block").select("block", "number").collect()] == [("LUT", 8), ("PCAP", 1)]
    inst = expand_instances(blocks).select("instance", instance_block(F.col("instance")).alias("b")).collect()
    assert sorted(r[0] for r in inst) == sorted([f"LUT{i}" for i in range(1, 9)] + ["PCAP"])
    assert {r[1] for r in inst} == {"LUT", "PCAP"}


def test_fields_order_and_unknown_pairs(spark):
    lines = ["TYPEA 5 param enum", "INPA 1 bit_mux", "FOO 2 foo", "BAR 3 flibble bibble", "BAZ 4 param unknown",
             "FISH 6 fish uint", "T 7 table"]
    f = with_shape(parse_field_lines(spark.createDataFrame([(x,) for x in lines], "line string")), spark)
    got = f.orderBy("field_index").select("field", "type", "subtype", "shape").collect()
    assert got[0]["field"] == "INPA" and got[0]["shape"] == "bit_mux"
    shapes = {r["field"]: r["shape"] for r in got}
    assert shapes["TYPEA"] == "enum" and shapes["T"] == "table"
    assert {k for k, v in shapes.items() if v == "unknown"} == {"FOO", "BAR", "BAZ", "FISH"}
    assert {r["field"]: r["subtype"] for r in got}["FOO"] is None


def test_bit_word_fields(spark):
    lines = ["BITS2 12 ext_out bits", "SHIFT_SUM 4 param uint", "BITS0 10 ext_out bits", "TS 3 ext_out timestamp"]
    words = bit_word_fields(spark.createDataFrame([(x,) for x in lines], "line string")).select("word").collect()
    assert sorted(r[0] for r in words) == ["PCAP.BITS0", "PCAP.BITS2"]
    labels = spark.createDataFrame([("PCAP.BITS0", 1, "b"), ("PCAP.BITS0", 0, "a"), ("PCAP.BITS0", 2, "c")],
                                   "word string, pos long, label string")
    assert ordered_labels(labels, ["word"]).collect()[0]["labels"] == ["a", "b", "c"]
