"""Capture streams: decoding golden dumps, chunk invariance, headers, rejects."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dumpkit import SCALED_FIELDS, acquisition, chunks_df, fast_values, raw_fields, raw_values, stream
from strobe.functions.columns import c
from strobe.sources.capture_format import FieldSpec, parse_header, header_text
from strobe.sources.dumps import decode_index, index_chunks


def _decode(spark, data, size, calibrated=True):
    index = index_chunks(chunks_df(spark, data, size))
    return index, decode_index(index, calibrated=calibrated, from_files=False)


def _frame_sizes(index):
    rows = index.where("kind = 'frame'").orderBy("acq_no", "frame_no").select("n_rows").collect()
    return [r[0] for r in rows]


@pytest.mark.parametrize("size", [44, 500, 200000])
def test_fast_dump_any_chunking(spark, size):
    data = stream(acquisition(SCALED_FIELDS, fast_values(), [10, 11, 10, 10, 10, 7], end=("Disarmed", 58)))
    index, dec = _decode(spark, data, size)
    assert _frame_sizes(index) == [10, 11, 10, 10, 10, 7]
    end = index.where("kind = 'end'").select("samples", "reason").collect()
    assert [tuple(r) for r in end] == [(58, "Disarmed")]
    got = dec.orderBy("sample_idx").toPandas()
    exp = fast_values()
    assert list(got["sample_idx"]) == list(range(58))
    for name, col in exp.items():
        np.testing.assert_allclose(got[name].to_numpy(dtype=float), col.astype(float))


def test_slow_dump_one_frame_per_sample(spark):
    vals = fast_values(5)
    vals["PCAP.TS_START.Value"] = np.arange(5) * 1.0 + 5.6e-08
    vals["PCAP.BITS2.Value"] = np.array([0, 8, 0, 8, 0], dtype=np.uint32)
    data = stream(acquisition(SCALED_FIELDS, vals, [1] * 5, end=("Disarmed", 5)))
    index, dec = _decode(spark, data, 44)
    assert _frame_sizes(index) == [1] * 5
    got = dec.orderBy("sample_idx").toPandas()
    np.testing.assert_allclose(got["PCAP.TS_START.Value"], vals["PCAP.TS_START.Value"])
    assert list(got["PCAP.BITS2.Value"]) == [0, 8, 0, 8, 0]


@pytest.mark.parametrize("with_duration", [True, False])
def test_raw_dump_calibrated_series(spark, with_duration):
    fields = raw_fields(with_duration)
    gate = "PCAP.GATE_DURATION.Value" if with_duration else "PCAP.SAMPLES.Value"
    vals = raw_values(gate_name=gate)
    record = fields if with_duration else [FieldSpec("PCAP.SAMPLES", "uint32", "Value")] + fields
    data = stream(acquisition(fields, vals, [10000], process="Raw", record_fields=record,
                              sample_bytes=sum(f.itemsize for f in record)))
    index, dec = _decode(spark, data, 200000)
    got = dec.orderBy("sample_idx").toPandas()
    i = np.arange(1, 10001, dtype=float)
    assert gate in got.columns
    assert ("PCAP.GATE_DURATION.Value" in got.columns) == with_duration
    np.testing.assert_allclose(got["COUNTER1.OUT.Mean"], i)
    np.testing.assert_allclose(got["COUNTER2.OUT.Mean"], 2 * i)
    np.testing.assert_allclose(got["COUNTER1.OUT.Min"], i)
    np.testing.assert_allclose(got["COUNTER3.OUT.Value"], 3 * i)
    np.testing.assert_allclose(got["PCAP.TS_START.Value"], i * 2e-6 + 7.2e-8 - 2e-6, rtol=1e-9)
    assert (got[gate] == 125).all()
    assert str(got["COUNTER1.OUT.Min"].dtype) == "float64"  # raw mode with scale/offset stores doubles
    assert (got["PCAP.BITS2.Value"] == 0).all()


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(min_value=1, max_value=900), min_size=1, max_size=12))
def test_decoding_does_not_depend_on_cut_points(spark, cuts):
    data = stream(
        acquisition(SCALED_FIELDS, fast_values(), [10, 11, 10, 10, 10, 7], end=("Ok", 58)),
        acquisition(SCALED_FIELDS, fast_values(20), [20], end=("Data overrun", 20)),
    )
    pieces, pos = [], 0
    for k in cuts:
        if pos >= len(data):
            break
        pieces.append(data[pos : pos + k])
        pos += k
    if pos < len(data):
        pieces.append(data[pos:])
    rows = [(0, i, p) for i, p in enumerate(pieces)]
    index = index_chunks(spark.createDataFrame(rows, "conn_id long, chunk_no long, data binary"))
    dec = decode_index(index, from_files=False)
    got = sorted(tuple(r) for r in dec.select("acq_no", "sample_idx", c("COUNTER3.OUT.Value")).collect())
    assert len(got) == 78
    assert got[0] == (1, 0, 3.0) and got[-1] == (2, 19, 60.0)


def test_stream_cut_before_end_is_unterminated(spark):
    full = stream(acquisition(SCALED_FIELDS, fast_values(), [10, 11, 10, 10, 10, 7], end=None))
    index, dec = _decode(spark, full, 500)
    kinds = {r[0]: r[1] for r in index.groupBy("kind").count().collect()}
    assert kinds.get("end") is None and kinds["frame"] == 6
    assert dec.count() == 58


def test_bad_marker_and_missing_ok_are_rejects(spark):
    good = acquisition(SCALED_FIELDS, fast_values(), [58], end=("Ok", 58))
    bad = stream(good).replace(b"BIN ", b"BAD ", 1)
    index = index_chunks(chunks_df(spark, bad, 97))
    rej = index.where("kind = 'reject'").select("message").collect()
    assert len(rej) == 1 and "bad marker" in rej[0][0]
    index2 = index_chunks(chunks_df(spark, b"NO\n" + good, 97))
    assert index2.where("kind = 'reject'").count() == 1


def test_unknown_end_reason_rejected(spark):
    data = stream(acquisition(SCALED_FIELDS, fast_values(), [58], end=("Exploded", 58)))
    index = index_chunks(chunks_df(spark, data, 4096))
    assert index.where("kind = 'reject'").count() == 1


def test_header_rules():
    fields = [FieldSpec("COUNTER1.OUT", "float64", "Mean", 1.0, 0.0, "")]
    h = parse_header(header_text(fields, sample_bytes=12, start_time="2024-03-05T20:27:12.608875498Z",
                                 arm_time="2024-03-05T20:27:12.607841574Z", hw_time_offset_ns="100555").replace("\n", ""))
    assert [f.column for f in h.fields] == ["PCAP.SAMPLES.Value", "COUNTER1.OUT.Mean"]
    assert h.hw_time_offset_ns == 100555 and h.arm_time.endswith("574Z")
    h2 = parse_header(header_text(fields, hw_time_offset_ns="").replace("\n", ""))
    assert h2.hw_time_offset_ns is None and h2.start_time is None
    with pytest.raises(ValueError):
        parse_header(header_text(fields, sample_bytes=14).replace("\n", ""))
    bad = header_text(fields).replace(' units=""', "")
    with pytest.raises(ValueError):
        parse_header(bad.replace("\n", ""))


def test_overrun_guard_raises_after_store(spark, tmp_path):
    from strobe.operators.sinks import DataOverrunError, guard_overruns, write_acquisitions

    data = stream(acquisition(SCALED_FIELDS, fast_values(), [58], end=("Data overrun", 58)))
    index, dec = _decode(spark, data, 1000)
    out = str(tmp_path / "acq")
    write_acquisitions(dec, out)
    assert spark.read.parquet(out).count() == 58
    with pytest.raises(DataOverrunError):
        guard_overruns(index.where("kind = 'end'"))


def test_files_roundtrip_matches_memory(spark, tmp_path):
    from strobe.sources.captures import cut_chunks  # noqa: F401
    from strobe.sources.dumps import list_chunks, write_chunks

    data = stream(acquisition(SCALED_FIELDS, fast_values(), [10, 11, 10, 10, 10, 7], end=("Ok", 58)))
    root = str(tmp_path / "arch")
    write_chunks(chunks_df(spark, data, 333), root).collect()
    index = index_chunks(list_chunks(spark, root))
    assert index.where("kind='frame'").where(F.col("payload").isNotNull()).count() == 0
    dec = decode_index(index, from_files=True)
    assert dec.count() == 58
    assert sorted(r[0] for r in dec.select(c("COUNTER2.OUT.Mean")).collect()) == [2.0 * i for i in range(1, 59)]


def test_capture_dump_data_source(spark, tmp_path):
    from strobe.sources.datasource import register
    from strobe.sources.dumps import list_chunks, publish_index, write_chunks

    data = stream(acquisition(SCALED_FIELDS, fast_values(), [10, 11, 10, 10, 10, 7], end=("Ok", 58)),
                  acquisition(SCALED_FIELDS, fast_values(20), [20], end=("Ok", 20)))
    root = str(tmp_path / "arch")
    write_chunks(chunks_df(spark, data, 257), root).collect()
    idx_path = str(tmp_path / "index")
    publish_index(index_chunks(list_chunks(spark, root)), idx_path)
    register(spark)
    df = spark.read.format("capture_dump").option("index", idx_path).load()
    assert df.count() == 78
    assert sorted(r[0] for r in df.where("acq_no = 2").select(c("COUNTER2.OUT.Mean")).collect()) == [2.0 * i for i in range(1, 21)]
    pruned = spark.read.format("capture_dump").option("index", idx_path).option("fields", "COUNTER3.OUT.Value").load()
    assert pruned.columns == ["conn_id", "acq_no", "frame_no", "sample_idx", "COUNTER3.OUT.Value"]
    assert pruned.agg(F.sum(c("COUNTER3.OUT.Value"))).collect()[0][0] == 3 * (58 * 59 / 2 + 20 * 21 / 2)


def test_convert_archive_end_to_end(spark, tmp_path):
    from strobe.operators.convert import convert_archive
    from strobe.operators.sinks import DataOverrunError
    from strobe.sources.dumps import write_chunks

    data = stream(acquisition(SCALED_FIELDS, fast_values(), [10, 11, 10, 10, 10, 7], end=("Ok", 58)),
                  acquisition(SCALED_FIELDS, fast_values(20), [20], end=("Data overrun", 20)))
    root = str(tmp_path / "captures")
    write_chunks(chunks_df(spark, data, 700), root).collect()
    out = str(tmp_path / "converted")
    with pytest.raises(DataOverrunError):
        convert_archive(spark, root, out)
    # the rows were stored before the job failed
    assert spark.read.parquet(out + "/samples").count() == 78
    done = convert_archive(spark, root, str(tmp_path / "again"), check_overrun=False, layout="per_acquisition")
    assert done.samples == 78
    acq = sorted(tuple(r) for r in done.acquisitions.select("acq_no", "rows", "end_reason").collect())
    assert acq == [(1, 58, "Ok"), (2, 20, "Data overrun")]
    assert spark.read.parquet(done.samples_path).where("acq_no = 2").count() == 20


def test_decode_partitions_follow_payload_bytes(spark):
    from strobe.sources.dumps import decode_partitions

    floor = int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.conf.set("strobe.decode.bytesPerPartition", str(1 << 20))
    try:
        assert decode_partitions(spark, 0) == floor
        assert decode_partitions(spark, (floor + 5) << 20) == floor + 5
        assert decode_partitions(spark, ((floor + 5) << 20) + 1) == floor + 6
    finally:
        spark.conf.unset("strobe.decode.bytesPerPartition")


def test_capture_dump_pushes_acquisition_filters(spark, tmp_path):
    from strobe.sources.datasource import register
    from strobe.sources.dumps import list_chunks, publish_index, write_chunks

    data = stream(acquisition(SCALED_FIELDS, fast_values(), [10, 11, 10, 10, 10, 7], end=("Ok", 58)),
                  acquisition(SCALED_FIELDS, fast_values(20), [20], end=("Ok", 20)))
    root = str(tmp_path / "arch")
    write_chunks(chunks_df(spark, data, 257), root).collect()
    idx = str(tmp_path / "index")
    publish_index(index_chunks(list_chunks(spark, root)), idx)
    register(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    try:
        df = (spark.read.format("capture_dump").option("index", idx).option("pushdown", "true").load()
              .where("acq_no = 2 AND frame_no >= 0"))
        assert df.count() == 20
        assert df.where("sample_idx < 5").count() == 5
    finally:
        spark.conf.unset("spark.sql.python.filterPushdown.enabled")
