"""One file per acquisition, found again by the listing."""

import os

import pytest
from dumpkit import SCALED_FIELDS, acquisition, chunks_df, fast_values, stream

from strobe.functions.columns import c
from strobe.sources.dumps import decode_index, index_chunks


def _decoded(spark, rows=(58, 20)):
    data = stream(*(acquisition(SCALED_FIELDS, fast_values(n), [n], end=("Ok", n)) for n in rows))
    return decode_index(index_chunks(chunks_df(spark, data, 700)), from_files=False)


def test_acquisitions_are_read_by_their_listing(spark, tmp_path):
    from strobe.operators.sinks import read_acquisitions, write_acquisitions

    dec, out = _decoded(spark), str(tmp_path / "acq")
    write_acquisitions(dec, out)
    folders = {os.path.relpath(d, out) for d, _, files in os.walk(out) if any(f.endswith(".parquet") for f in files)}
    assert {"conn_id=0/acq_no=1", "conn_id=0/acq_no=2"} <= folders
    assert not [f for _, _, files in os.walk(out) for f in files if f.startswith(".tmp")]
    names = dec.columns
    want = sorted(map(str, dec.collect()))
    assert sorted(map(str, read_acquisitions(spark, out).select(*[c(n) for n in names]).collect())) == want
    # Spark's own reader finds the same rows; the files are in sample order
    assert spark.read.parquet(out).count() == len(want) == 78
    some = read_acquisitions(spark, out, ["acq_no", "COUNTER2.OUT.Mean"])
    assert some.columns == ["acq_no", "COUNTER2.OUT.Mean"] and some.where("acq_no = 2").count() == 20
    # a file that no commit listed is not read
    folder = os.path.join(out, "conn_id=0/acq_no=1")
    own = next(f for f in os.listdir(folder) if f.endswith(".parquet"))
    with open(os.path.join(folder, own), "rb") as a, open(os.path.join(folder, "part-of-a-failed-job.parquet"), "wb") as b:
        b.write(a.read())
    assert read_acquisitions(spark, out).count() == 78


def test_acquisitions_keep_the_save_modes(spark, tmp_path):
    from strobe.operators.sinks import read_acquisitions, write_acquisitions

    dec, out = _decoded(spark), str(tmp_path / "acq")
    write_acquisitions(dec, out)
    write_acquisitions(dec.where("acq_no = 1"), out, mode="append")
    assert read_acquisitions(spark, out).count() == 78 + 58
    with pytest.raises(FileExistsError):
        write_acquisitions(dec, out, mode="error")
    write_acquisitions(dec.where("acq_no = 2"), out)
    assert read_acquisitions(spark, out).count() == spark.read.parquet(out).count() == 20
    write_acquisitions(dec.where("acq_no = 3"), out)
    assert read_acquisitions(spark, out).count() == 0
