"""Packed tables: golden words of the sequencer layout, round trips, base64."""

import pytest
from pyspark.sql import functions as F

from strobe.operators.packed import (
    TableColumn,
    base64_to_words,
    enum_index,
    over_wide,
    pack_row,
    row_words,
    unpack_rows,
    words_to_base64,
)

TRIGGER_LABELS = (
    "Immediate", "BITA=0", "BITA=1", "BITB=0", "BITB=1", "BITC=0", "BITC=1",
    "POSA>=POSITION", "POSA<=POSITION", "POSB>=POSITION", "POSB<=POSITION", "POSC>=POSITION", "POSC<=POSITION",
)
LAYOUT = (
    [TableColumn("REPEATS", "uint", 0, 15), TableColumn("TRIGGER", "enum", 16, 19, TRIGGER_LABELS),
     TableColumn("POSITION", "int", 32, 63), TableColumn("TIME1", "uint", 64, 95)]
    + [TableColumn(f"OUT{x}1", "uint", 20 + i, 20 + i) for i, x in enumerate("ABCDEF")]
    + [TableColumn("TIME2", "uint", 96, 127)]
    + [TableColumn(f"OUT{x}2", "uint", 26 + i, 26 + i) for i, x in enumerate("ABCDEF")]
)
CASE1 = {
    "REPEATS": [5, 0, 50000], "TRIGGER": ["Immediate", "BITC=1", "Immediate"], "POSITION": [-5, 678, 0],
    "TIME1": [100, 0, 9], "OUTA1": [0, 1, 1], "OUTB1": [0, 0, 1], "OUTD1": [1, 0, 1], "OUTE1": [0, 0, 1],
    "OUTC1": [0, 0, 1], "OUTF1": [1, 0, 1], "TIME2": [0, 55, 9999], "OUTA2": [0, 0, 1], "OUTB2": [0, 0, 1],
    "OUTC2": [1, 1, 1], "OUTD2": [0, 0, 1], "OUTE2": [0, 0, 1], "OUTF2": [1, 0, 1],
}
WORDS1 = [2457862149, 4294967291, 100, 0, 269877248, 678, 0, 55, 4293968720, 0, 9, 9999]
CASE2 = {"REPEATS": [1, 0], "TRIGGER": ["Immediate", "Immediate"], "POSITION": [-20, 2**31 - 1],
         "TIME1": [12, 2**32 - 1], "TIME2": [32, 1], "OUTA1": [0, 1], "OUTA2": [1, 0]}
WORDS2 = [67108865, 4294967276, 12, 32, 1048576, 2147483647, 4294967295, 1]


def _rows_df(spark, table):
    names = list(table)
    n = len(table[names[0]])
    rows = [tuple([i] + [table[k][i] for k in names]) for i in range(n)]
    schema = "row int, " + ", ".join(f"{k} {'string' if k == 'TRIGGER' else 'long'}" for k in names)
    return spark.createDataFrame(rows, schema)


def _pack(spark, table):
    df = _rows_df(spark, table)
    values = {k: (enum_index(F.col(k), LAYOUT[1]) if k == "TRIGGER" else F.col(k)) for k in table}
    packed = df.select("row", pack_row(LAYOUT, values).alias("w")).orderBy("row").collect()
    return [w for r in packed for w in r["w"]]


def test_row_words():
    assert row_words(LAYOUT) == 4


@pytest.mark.parametrize("table,words", [(CASE1, WORDS1), (CASE2, WORDS2)])
def test_pack_golden(spark, table, words):
    assert _pack(spark, table) == words


@pytest.mark.parametrize("table,words", [(CASE1, WORDS1), (CASE2, WORDS2)])
def test_unpack_golden(spark, table, words):
    df = spark.createDataFrame([(1, words)], "t int, words array<bigint>")
    got = unpack_rows(df, "words", LAYOUT, ["t"], enum_labels=True).orderBy("row").collect()
    for k, col in table.items():
        assert [r[k] for r in got] == col, k
    # columns not given unpack as zero; integer enum indices without labels
    ints = unpack_rows(df, "words", LAYOUT, ["t"]).orderBy("row").collect()
    assert [r["TRIGGER"] for r in ints] == [TRIGGER_LABELS.index(x) for x in table["TRIGGER"]]
    assert list(ints[0].asDict()) == ["t", "row"] + [c.name for c in LAYOUT]  # layout order, not input order


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, WORDS1)], "t int, words array<bigint>")
    schema = unpack_rows(df, "words", LAYOUT, ["t"]).schema
    assert schema["OUTA1"].dataType.typeName() == "short"
    assert schema["REPEATS"].dataType.typeName() == "integer"
    assert schema["TIME1"].dataType.typeName() == "long"
    assert schema["POSITION"].dataType.typeName() == "integer"


def test_unknown_label_and_over_wide_are_flagged(spark):
    df = spark.createDataFrame([("Nope", 70000)], "t string, r long")
    row = df.select(enum_index(F.col("t"), LAYOUT[1]).alias("i"),
                    over_wide(LAYOUT, {"REPEATS": F.col("r")}).alias("wide")).collect()[0]
    assert row["i"] is None and row["wide"] is True


def test_base64_golden(spark):
    df = spark.createDataFrame([("AQAQAAAAAAABAAAAAQAAAA==",)], "b string")
    words = df.select(base64_to_words(F.col("b")).alias("w")).collect()[0]["w"]
    assert words == [1048577, 0, 1, 1]
    back = df.select(words_to_base64(base64_to_words(F.col("b"))).alias("b")).collect()[0]["b"]
    assert back == "AQAQAAAAAAABAAAAAQAAAA=="


def test_roundtrip_layout_order(spark):
    words = _pack(spark, CASE1)
    df = spark.createDataFrame([(1, words)], "t int, words array<bigint>")
    again = unpack_rows(df, "words", LAYOUT, ["t"], enum_labels=True).orderBy("row").collect()
    for k, col in CASE1.items():
        assert [r[k] for r in again] == col


def test_word_count_check_and_wide_bits(spark):
    from strobe.operators.packed import named_bit_columns, valid_word_count

    df = spark.createDataFrame([(1, WORDS1), (2, WORDS1[:-1])], "t int, words array<bigint>")
    assert [r[0] for r in df.orderBy("t").select(valid_word_count("words", LAYOUT)).collect()] == [True, False]
    w = spark.createDataFrame([(0b1010,)], "w long")
    row = named_bit_columns(w, "w", ["TTLIN1.VAL", "TTLIN2.VAL", "TTLIN3.VAL", "TTLIN4.VAL"]).collect()[0]
    assert [row["TTLIN1.VAL"], row["TTLIN2.VAL"], row["TTLIN3.VAL"], row["TTLIN4.VAL"]] == [False, True, False, True]


def test_pack_without_columns_is_an_error():
    with pytest.raises(ValueError):
        pack_row(LAYOUT, {})


def test_packed_table_rejects(spark):
    from strobe.operators import packed as pk

    layout = [pk.TableColumn("a", "uint", 0, 15), pk.TableColumn("e", "enum", 16, 19, ("x", "y")), pk.TableColumn("b", "uint", 32, 63)]
    rows = [(1, [1 | 1 << 16, 2]), (2, [1, 2, 3]), (3, [1 | 5 << 16, 2]), (4, []), (5, None)]
    got = pk.table_rejects(spark.createDataFrame(rows, "k long, words array<bigint>"), "words", layout, ["k"]).collect()
    assert sorted((r.k, r.column, r.message) for r in got if r.column is None or True) == sorted(
        [(2, None, "3 words are no rows of 2"), (3, "e", "index 5 of 2 labels"), (5, None, "no whole words")], key=lambda r: r[0])
    labels = pk.label_rejects(spark.createDataFrame([(1, "x"), (2, "z"), (3, None)], "k long, e string"), layout, ["k"]).collect()
    assert [tuple(r) for r in labels] == [(2, "e", "unknown label z")]
    lengths = spark.createDataFrame([(1, "a", 3), (1, "b", 3), (2, "a", 3), (2, "b", 2)], "k long, name string, n long")
    assert [tuple(r) for r in pk.length_rejects(lengths, ["k"], "name", "n").collect()] == [(2, 2, 3, ["b"])]
    texts = spark.createDataFrame([("",), ("AQAAAA==",), ("AQAA",), (None,)], "t string")
    assert [r[0] for r in texts.select(pk.base64_to_words(texts.t)).collect()] == [[], [1], None, None]
