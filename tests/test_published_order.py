"""The order of a published index is found on narrow rows."""

from dumpkit import SCALED_FIELDS, acquisition, chunks_df, fast_values, stream
from pyspark.sql import functions as F

from strobe.sources import dumps
from strobe.sources.dumps import index_chunks, list_chunks, publish_index, write_chunks


def test_published_order_is_found_on_narrow_rows(spark, tmp_path, monkeypatch):
    seen = []

    def scan(df, *args, **kw):
        seen.append(set(df.columns))
        return ordered(df, *args, **kw)

    ordered = dumps.ordered_scan
    monkeypatch.setattr(dumps, "ordered_scan", scan)
    data = stream(acquisition(SCALED_FIELDS, fast_values(), [10, 11, 10, 10, 10, 7], end=("Ok", 58)))
    root = str(tmp_path / "arch")
    write_chunks(chunks_df(spark, data, 257), root).collect()
    index = index_chunks(list_chunks(spark, root))
    publish_index(index, str(tmp_path / "index"), partition_bytes=600)
    assert seen == [{"all", "conn_id", "acq_no", "frame_no", "n_bytes"}]
    frames = spark.read.parquet(str(tmp_path / "index/frames"))
    want = index.where("kind = 'frame'")
    assert sorted(map(str, frames.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert frames.select(F.input_file_name()).distinct().count() > 1
