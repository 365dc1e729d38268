"""Nanosecond time, calibration rules and the skew-safe ordered scan."""

import math

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from strobe.functions.columns import np_divide
from strobe.operators.calibrate import calibrate, renamed, with_field_rules
from strobe.operators.ordering import ordered_scan
from strobe.operators.timebase import epoch_ns_to_iso, iso_to_epoch_ns, offset_ns, system_start_ns
from strobe.sources.capture_format import FieldSpec


def test_system_start_golden(spark):
    df = spark.createDataFrame([("2024-03-05T20:27:12.605729480Z", "2155797"), ("2024-03-05T20:27:12.605729480Z", "0"),
                                (None, "5"), ("2024-03-05T20:27:12.605729480Z", "")], "s string, o string")
    out = df.select(epoch_ns_to_iso(system_start_ns(F.col("s"), offset_ns(F.col("o")))).alias("t")).collect()
    assert out[0]["t"] == "2024-03-05T20:27:12.607885277Z"
    assert out[1]["t"] == "2024-03-05T20:27:12.605729480Z"
    assert out[2]["t"] is None
    assert out[3]["t"] == "2024-03-05T20:27:12.605729480Z"  # blank offset -> NULL -> no shift
    ns = df.select(iso_to_epoch_ns(F.col("s"))).collect()[0][0]
    assert ns % 1_000_000_000 == 605729480


@pytest.mark.parametrize("scale,offset,units,valid,needs,raw_type", [
    (None, None, None, True, False, "uint32"),
    (1.0, 0.0, "", True, False, "float64"),
    (1.0, 1.0, "", True, True, "float64"),
    (1.1, 0.0, "", True, True, "float64"),
    (None, 0.0, "", False, False, "uint32"),
])
def test_field_rules(spark, scale, offset, units, valid, needs, raw_type):
    df = spark.createDataFrame([("X", "Value", "uint32", scale, offset, units)],
                               "name string, capture string, type string, scale double, offset double, units string")
    r = with_field_rules(df).collect()[0]
    assert r["metadata_valid"] is valid
    assert r["needs_calibration"] is needs
    assert r["raw_type"] == raw_type


def test_gated_mean_zero_gate_is_ieee(spark):
    df = spark.createDataFrame([(5.0, 0), (-5.0, 0), (0.0, 0), (10.0, 4)], "x double, g long")
    out = [r[0] for r in df.select(np_divide(F.col("x"), F.col("g"))).collect()]
    assert out[0] == math.inf and out[1] == -math.inf and math.isnan(out[2]) and out[3] == 2.5


def test_calibrate_wide_and_rename(spark):
    fields = [FieldSpec("PCAP.SAMPLES", "uint32", "Value"), FieldSpec("C1.OUT", "int64", "Mean", 2.0, 1.0, "mm"),
              FieldSpec("C1.OUT", "int32", "Min", 0.5, 0.0, ""), FieldSpec("C2.OUT", "int32", "Max", 1.0, 0.0, "")]
    df = spark.createDataFrame([(4, 40, 6, 7)], "`PCAP.SAMPLES.Value` long, `C1.OUT.Mean` long, `C1.OUT.Min` int, `C2.OUT.Max` int")
    raw = calibrate(df, fields, "Raw", rename={"C1.OUT": {"Min": "low"}}).collect()[0].asDict()
    assert raw == {"PCAP.SAMPLES.Value": 4, "C1.OUT.Mean": 21.0, "low": 3.0, "C2.OUT.Max": 7.0}
    scaled = calibrate(df, fields, "Scaled").collect()[0].asDict()
    assert scaled["C1.OUT.Mean"] == 40 and scaled["C2.OUT.Max"] == 7


def test_rename_table(spark):
    fields = spark.createDataFrame([("A", "Min"), ("A", "Max"), ("B", "Value")], "name string, capture string")
    ren = spark.createDataFrame([("A", "Max", "a_high")], "name string, capture string, new_name string")
    got = {tuple(r) for r in renamed(fields, ren).select("name", "capture", "stored_name").collect()}
    assert got == {("A", "Min", "A.Min"), ("A", "Max", "a_high"), ("B", "Value", "B.Value")}


@pytest.mark.parametrize("bucket_rows", [None, 500, 40])
def test_ordered_scan_matches_window_with_hot_key(spark, bucket_rows):
    ev = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(7)).when(F.col("event_id") % 11 == 0, F.lit(None)).otherwise(F.col("user_id")))
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    ref = hot.select("event_id", (F.row_number().over(w) - 1).alias("pos"), F.lag("ts").over(w).alias("prev_ts"),
                     F.coalesce(F.sum("event_id").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("run"))
    a = ordered_scan(hot, ["user_id"], ["ts", "event_id"], out="pos", lag=["ts"], bucket_rows=bucket_rows)
    b = ordered_scan(hot, ["user_id"], ["ts", "event_id"], out="run", weight="event_id", bucket_rows=bucket_rows)
    got = a.select("event_id", "pos", "prev_ts").join(b.select("event_id", "run"), "event_id")
    assert got.count() == ref.count()
    assert got.exceptAll(ref.select("event_id", "pos", "prev_ts", "run")).count() == 0


@pytest.mark.parametrize(("bucket_rows", "fan"), [(200, 1024), (30, 4), (7, 2)])
def test_ordered_scan_of_ties_and_strings(spark, monkeypatch, bucket_rows, fan):
    """One key whose leading order values are equal, then strings: blocks are
    cut on the whole tuple, level by level, and none exceeds the limit much."""
    from strobe.operators import ordering

    monkeypatch.setattr(ordering, "FAN", fan)
    ev = spark.range(3000).select(
        F.lit("k").alias("key"), F.lit(5).alias("same"), F.concat(F.lit("s"), (F.col("id") % 7).cast("string")).alias("name"), "id",
        F.when(F.col("id") % 5 == 0, F.col("id")).alias("mark"),
    ).unionByName(spark.createDataFrame([(None, None, None, 1, 4), ("k", None, None, -1, None)], "key string, same int, name string, id long, mark long"))
    order = ["same", "name", "id"]
    w = Window.partitionBy("key").orderBy(*[F.col(o).asc_nulls_first() for o in order])
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    ref = ev.select("key", "id", (F.row_number().over(w) - 1).cast("long").alias("pos"), F.lag("name").over(w).alias("prev_name"), F.last("mark", True).over(before).alias("last_mark"))
    got = ordered_scan(ev, ["key"], order, out="pos", lag=["name"], fill=["mark"], bucket_rows=bucket_rows)
    assert got.select(ref.columns).exceptAll(ref).count() == 0 and got.count() == 3002
    tagged, cut = ordering.split_blocks(ev, ["key"], order, bucket_rows)
    sizes = [r["count"] for r in tagged.groupBy("key", "__sub").count().collect()]
    assert cut and max(sizes) <= 4 * bucket_rows + 8
