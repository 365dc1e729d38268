"""Typed metadata of fields against values of the protocol's documentation."""

from pyspark.sql import functions as F

from strobe.operators.catalogue import typed_fields, with_shape

FIELDS = "block string, field string, type string, subtype string, api_major int, api_minor int"
REPLIES = "block string, field string, attr string, part string, pos int, value string"


def _typed(spark, fields, replies):
    f = with_shape(spark.createDataFrame(fields, FIELDS), spark)
    rows = typed_fields(f, spark.createDataFrame(replies, REPLIES), ["block"]).collect()
    return {r["field"]: r.asDict(True) for r in rows}


def test_every_shape_has_its_struct(spark):
    fields = [
        ("SEQ", "TABLE", "table", None, 4, 0), ("SEQ", "OLD", "table", None, 3, 9), ("SEQ", "N", "param", "uint", 4, 0),
        ("SEQ", "D", "param", "scalar", 4, 0), ("SEQ", "T", "write", "time", 4, 0), ("SEQ", "U", "time", None, 4, 0),
        ("SEQ", "OUT", "bit_out", None, 4, 0), ("SEQ", "IN", "bit_mux", None, 4, 0), ("SEQ", "P", "ext_out", "bits", 4, 0),
        ("SEQ", "ACT", "write", "action", 4, 0), ("SEQ", "WHAT", "foo", "bar", 4, 0), ("SEQ", "BAD", "read", "uint", 4, 0),
    ]
    replies = [
        ("SEQ", "TABLE", "MAX_LENGTH", None, None, "16384"), ("SEQ", "TABLE", "FIELDS", None, 1, "19:16 TRIGGER enum"),
        ("SEQ", "TABLE", "FIELDS", None, 0, "15:0 REPEATS uint"), ("SEQ", "TABLE", "FIELDS", None, 2, "127:96 TIME2 uint"),
        ("SEQ", "TABLE", "COLUMN_LABELS", "TRIGGER", 1, "BITA=0"), ("SEQ", "TABLE", "COLUMN_LABELS", "TRIGGER", 0, "Immediate"),
        ("SEQ", "TABLE", "COLUMN_DESC", "REPEATS", None, "Times"), ("SEQ", "OLD", "FIELDS", None, 0, "nonsense"),
        ("SEQ", "N", "MAX", None, None, "4294967295"), ("SEQ", "N", "DESC", None, None, "A number"),
        ("SEQ", "D", "UNITS", None, None, "V"), ("SEQ", "D", "SCALE", None, None, "1e-3"), ("SEQ", "D", "OFFSET", None, None, "-7"),
        ("SEQ", "T", "UNIT_LABELS", None, 1, "ms"), ("SEQ", "T", "UNIT_LABELS", None, 0, "s"), ("SEQ", "U", "UNIT_LABELS", None, 0, "min"),
        ("SEQ", "OUT", "CAPTURE_WORD", None, None, "PCAP.BITS1"), ("SEQ", "OUT", "OFFSET", None, None, "12"),
        ("SEQ", "IN", "MAX_DELAY", None, None, "31"), ("SEQ", "IN", "LABELS", None, 0, "ZERO"),
        ("SEQ", "P", "BITS", None, 0, "TTLIN1.VAL"), ("SEQ", "P", "BITS", None, 1, ""), ("SEQ", "P", "CAPTURE_LABELS", None, 0, "No"),
        ("SEQ", "BAD", "MAX", None, None, "many"), ("SEQ", "GONE", "MAX", None, None, "1"),
    ]
    got = _typed(spark, fields, replies)
    assert set(got) == {f[1] for f in fields}
    table = got["TABLE"]["table"]
    assert (table["max_length"], table["row_words"], table["has_mode"]) == (16384, 4, True)
    assert [(c["name"], c["subtype"], c["bit_low"], c["bit_high"], c["description"], c["labels"]) for c in table["fields"]] == [
        ("REPEATS", "uint", 0, 15, "Times", None), ("TRIGGER", "enum", 16, 19, None, ["Immediate", "BITA=0"]), ("TIME2", "uint", 96, 127, None, None)
    ]
    assert got["OLD"]["table"] == {"max_length": None, "fields": [], "row_words": 1, "has_mode": False} and got["OLD"]["unreadable"] == ["FIELDS"]
    assert got["N"]["uint"] == {"max_val": 4294967295} and got["N"]["description"] == "A number" and got["N"]["scalar"] is None
    assert got["D"]["scalar"] == {"units": "V", "scale": 0.001, "offset": -7}
    assert got["T"]["subtype_time"] == {"units_labels": ["s", "ms"]} and got["U"]["time"] == {"units_labels": ["min"]}
    assert got["OUT"]["bit_out"] == {"capture_word": "PCAP.BITS1", "offset": 12}
    assert got["IN"]["bit_mux"] == {"max_delay": 31, "labels": ["ZERO"]}
    assert got["P"]["ext_out_bits"] == {"bits": ["TTLIN1.VAL", ""], "capture_labels": ["No"]}
    assert got["ACT"]["shape"] == "none" and got["WHAT"]["shape"] == "unknown" and got["WHAT"]["type"] == "foo"
    assert got["BAD"]["uint"] == {"max_val": None} and got["BAD"]["unreadable"] == ["MAX"]


def test_no_fields_and_no_replies(spark):
    assert _typed(spark, [], [("B", "F", "MAX", None, None, "1")]) == {}
    got = _typed(spark, [("B", "F", "param", "enum", None, None)], [])
    assert got["F"]["enum"] == {"labels": []} and got["F"]["description"] is None


def test_one_aggregation_without_joins(spark):
    f = spark.createDataFrame([("B", "F", "param", "uint", 4, 0)], FIELDS).withColumn("shape", F.lit("uint"))
    plan = typed_fields(f, spark.createDataFrame([], REPLIES), ["block"])._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate [") == 1
