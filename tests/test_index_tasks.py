"""Blocks of the parallel index: tasks by bytes of the streams, frames of many blocks."""

from test_parallel_index import _archive, _even, _streams

from strobe.sources import parallel_index


def test_scanned_blocks_are_not_merged_into_one_task(spark, tmp_path):
    chunks = _archive(spark, str(tmp_path), _streams(), _even(333))
    made = parallel_index.Stream(chunks, 64).blocks()
    assert made.rdd.getNumPartitions() >= int(spark.conf.get("spark.sql.shuffle.partitions")) > 1


def test_many_blocks_share_a_frame(spark, tmp_path):
    chunks = _archive(spark, str(tmp_path), _streams(), _even(333))
    blocks = parallel_index.Stream(chunks, 64).blocks().toPandas()
    frames = list(parallel_index._scan(64)(iter([blocks])))
    assert len(blocks) > 100 and len(frames) == 1
