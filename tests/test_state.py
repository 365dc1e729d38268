"""State files, change feeds, saved-state build."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strobe.operators.state import (
    classify_change,
    entries_to_lines,
    fold_table_writes,
    is_multiline,
    segment_statements,
    state_entries,
    statement_rows,
)


def reference_statements(lines):
    """Direct statement-by-statement reading of a state file (test oracle)."""
    import re

    out, cur, start = [], [], None
    for no, line in enumerate(lines):
        if not cur:
            start = no
        cur.append(line)
        first = len(cur) == 1
        if (first and not re.match(r"^[^?=]*<", line)) or not line:
            out.append((start, len(cur)))
            cur = []
    return out


@pytest.mark.parametrize("line,expected", [
    ("SEQ.TABLE<", True), ("SEQ.TABLE<B", True), ("*METADATA.DESIGN<", True),
    ("SEQ.TABLE?", False), ("*METADATA.DESIGN?", False), ("*METADATA.DESIGN=B<B<B<B?", False),
])
def test_is_multiline(spark, line, expected):
    df = spark.createDataFrame([(line,)], "line string")
    assert df.select(is_multiline(F.col("line"))).collect()[0][0] is expected


_WORDS = ["A=1", "B<", "C<B", "", "x", "D=2<", "E<<", "F<<|", "G?", "body"]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.sampled_from(_WORDS), min_size=1, max_size=40))
def test_segmentation_matches_sequential_reading(spark, lines):
    df = spark.createDataFrame([(0, i, x) for i, x in enumerate(lines)], "f int, line_no long, line string")
    seg = segment_statements(df, ["f"])
    got = sorted((r["stmt_no"], r["n"]) for r in seg.groupBy("stmt_no").agg(F.count("*").alias("n")).collect())
    assert got == reference_statements(lines)


def test_segmentation_with_hot_file_split(spark):
    random.seed(3)
    lines = [random.choice(_WORDS) for _ in range(3000)]
    df = spark.createDataFrame([(0, i, x) for i, x in enumerate(lines)], "f int, line_no long, line string")
    spark.conf.set("strobe.scan.bucketRows", "100")
    try:
        seg = segment_statements(df, ["f"])
        got = sorted((r["stmt_no"], r["n"]) for r in seg.groupBy("stmt_no").agg(F.count("*").alias("n")).collect())
    finally:
        spark.conf.unset("strobe.scan.bucketRows")
    assert got == reference_statements(lines)


@pytest.mark.parametrize("rare", ["", "E<<"])
def test_segmentation_of_runs_over_many_blocks(spark, rare):
    """Runs, and bodies, that are many times as long as a block."""
    random.seed(4)
    lines = [rare if random.random() < 0.004 else random.choice(["A=1", "x", "G?"]) for _ in range(2000)]
    for at in (0, 3, 1400):
        lines[at] = "B<" if at % 2 else ""
    df = spark.createDataFrame([(0, i, x) for i, x in enumerate(lines)] + [(1, 0, "B<"), (1, 1, ""), (None, 5, "y")], "f int, line_no long, line string")
    seg = segment_statements(df, ["f"], bucket_rows=50).where("f = 0")
    got = sorted((r["stmt_no"], r["n"]) for r in seg.groupBy("stmt_no").agg(F.count("*").alias("n")).collect())
    assert got == reference_statements(lines)


def test_statement_rows_kinds(spark):
    lines = ["Attr=0", "Table<B", "AQAQAAAAAAABAAAAAQAAAA==", "", "Meta<", "l1", "l2", "", "raw", "T<<|", "1", ""]
    df = spark.createDataFrame([(0, i, x) for i, x in enumerate(lines)], "f int, line_no long, line string")
    rows = statement_rows(segment_statements(df, ["f"]), ["f"]).orderBy("stmt_no").collect()
    assert [(r["kind"], r["key"], r["value"], r["body"]) for r in rows] == [
        ("value", "Attr", "0", []),
        ("table_b64", "Table", None, ["AQAQAAAAAAABAAAAAQAAAA=="]),
        ("multiline", "Meta", None, ["l1", "l2"]),
        ("raw", "raw", None, []),
        ("append_last", "T", None, ["1"]),
    ]


@pytest.mark.parametrize("line,kind,key,value", [
    ("Field 1=Value1", "value", "Field 1", "Value1"),
    ("Field 1=", "value", "Field 1", ""),
    ("Field 1<", "no_value", "Field 1", None),
    ("Field1 (error)", "error", "Field1", None),
    ("a=b<", "no_value", "a=b", None),
    ("nothing", "invalid", None, None),
])
def test_change_lines(spark, line, kind, key, value):
    df = spark.createDataFrame([(line,)], "line string")
    cls = classify_change(F.col("line"))
    r = df.select(cls["kind"], cls["key"], cls["value"]).collect()[0]
    assert tuple(r) == (kind, key, value)


def test_state_build_golden(spark):
    changes = spark.createDataFrame([
        ("d", "ATTR", 0, "Attr=0"), ("d", "CONFIG", 0, "Config=0"), ("d", "TABLE", 0, "Table<"),
        ("d", "METADATA", 0, "SingleLineMeta1=0"), ("d", "METADATA", 1, "MultiLineMeta1<"),
        ("d", "METADATA", 2, "SingleLineMeta2=0"), ("d", "METADATA", 3, "MultiLineMeta2<"),
        ("d", "ATTR", 1, "Bad (error)"),
    ], "snapshot string, group string, seq long, line string")
    multi = spark.createDataFrame([
        ("d", "Table", ["tabledata"]), ("d", "MultiLineMeta1", ["multimetadata1"]), ("d", "MultiLineMeta2", ["multimetadata2"]),
    ], "snapshot string, field string, values array<string>")
    lines = entries_to_lines(state_entries(changes, multi, ["snapshot"]), ["snapshot"]).orderBy("line_no").collect()
    assert [r["line"] for r in lines] == [
        "Attr=0", "Config=0", "SingleLineMeta1=0", "SingleLineMeta2=0", "Table<B", "tabledata", "",
        "MultiLineMeta1<", "multimetadata1", "", "MultiLineMeta2<", "multimetadata2", "",
    ]
    assert [r["line_no"] for r in lines] == list(range(13))


def test_fold_table_writes(spark):
    writes = spark.createDataFrame([
        ("t", 1, "append", ["a"]), ("t", 2, "replace", ["b", "c"]), ("t", 3, "append", ["d"]),
        ("t", 4, "append_last", ["e"]), ("u", 1, "append", ["x"]),
    ], "t string, seq long, op string, rows array<string>")
    got = fold_table_writes(writes, ["t"], ["seq"], "op", "rows").orderBy("t", "row_no").collect()
    assert [(r["t"], r["row_no"], r["row"]) for r in got] == [
        ("t", 0, "b"), ("t", 1, "c"), ("t", 2, "d"), ("t", 3, "e"), ("u", 0, "x")]


def test_duplicate_keys_across_groups(spark):
    from strobe.operators.state import duplicate_keys

    changes = spark.createDataFrame([
        ("d", "ATTR", 0, "A=1"), ("d", "CONFIG", 0, "A=2"), ("d", "CONFIG", 1, "B=1"), ("d", "METADATA", 0, "C<"),
    ], "snapshot string, group string, seq long, line string")
    dup = duplicate_keys(changes, ["snapshot"]).collect()
    assert [(r["field"], r["n_groups"]) for r in dup] == [("A", 2)]


def test_build_state_rejects_duplicates_and_bad_lines(spark):
    from strobe.operators.state import StateError, build_state

    schema = "snapshot string, group string, seq long, line string"
    multi = spark.createDataFrame([], "snapshot string, field string, values array<string>")
    ok = spark.createDataFrame([("d", "ATTR", 0, "A=1"), ("d", "CONFIG", 0, "B=2")], schema)
    assert [r["line"] for r in build_state(ok, multi, ["snapshot"]).orderBy("line_no").collect()] == ["A=1", "B=2"]
    dup = spark.createDataFrame([("d", "ATTR", 0, "A=1"), ("d", "CONFIG", 0, "A=2")], schema)
    with pytest.raises(StateError):
        build_state(dup, multi, ["snapshot"])
    bad = spark.createDataFrame([("d", "ATTR", 0, "A=1"), ("d", "CONFIG", 0, "garbage")], schema)
    with pytest.raises(StateError):
        build_state(bad, multi, ["snapshot"])
