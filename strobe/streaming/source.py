"""``spark.readStream.format("capture_archive")``: a growing archive of chunk
files as a stream.

Option ``path``: the archive (``conn=<id>/chunk-<n>.bin``). An offset says for
each connection which chunk file has been read up to which byte, and where that
lies in the stream, so files may be added and the last one may grow. A file
counts once all files before it are there; a hole waits. Rows: conn_id, start
(byte position in the connection's stream), data -- what
``reassembly.reassemble_stream`` takes. Planning lists the archive on the
driver; each partition is a byte range of at most ``partitionBytes`` of one file
(default 32 MiB). After a restart the query goes on from the checkpoint's
offsets, and reads the same ranges again for an unfinished batch.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from strobe.sources.dumps import _filesystem

CHUNK = re.compile(r"conn=(-?\d+)/chunk-(\d+)\.bin$")
DEFAULT_PARTITION_BYTES = 32 << 20


class ByteRange(InputPartition):
    def __init__(self, conn_id: int, path: str, lo: int, hi: int, start: int):
        self.conn_id, self.path, self.lo, self.hi, self.start = conn_id, path, lo, hi, start


class CaptureArchiveSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "capture_archive"

    def schema(self) -> T.StructType:
        return T.StructType([T.StructField("conn_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("data", T.BinaryType())])

    def streamReader(self, schema: T.StructType) -> DataSourceStreamReader:
        return ArchiveReader(self.options["path"].rstrip("/"), int(self.options.get("partitionBytes", DEFAULT_PARTITION_BYTES)))


class ArchiveReader(DataSourceStreamReader):
    def __init__(self, root: str, partition_bytes: int):
        self.root = root
        self.partition_bytes = partition_bytes

    def _chunks(self) -> dict[int, list[tuple[int, str, int]]]:
        """(number, path, bytes) of each connection's files up to the first hole."""
        from pyarrow import fs

        filesystem, inner = _filesystem(self.root)
        prefix = self.root[: len(self.root) - len(inner.rstrip("/"))] if self.root.endswith(inner.rstrip("/")) else ""
        found: dict[int, dict[int, tuple[str, int]]] = {}
        for info in filesystem.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True)):
            hit = CHUNK.search(info.path) if info.is_file else None
            if hit:
                found.setdefault(int(hit[1]), {})[int(hit[2])] = (prefix + info.path, info.size)
        out = {}
        for conn, files in found.items():
            whole = []
            while len(whole) in files:
                whole.append((len(whole), *files[len(whole)]))
            out[conn] = whole
        return out

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        """connection -> [chunk, bytes of it, position of its first byte]."""
        out = {}
        for conn, files in self._chunks().items():
            if files:
                no, _, size = files[-1]
                out[str(conn)] = [no, size, sum(n for *_, n in files[:-1])]
        return out

    def partitions(self, start: dict, end: dict) -> Sequence[InputPartition]:
        files = self._chunks()
        out = []
        for conn, (last, upto, _) in sorted(end.items()):
            chunk, byte, at = start.get(conn, [0, 0, 0])
            for no, path, size in files[int(conn)][chunk : last + 1]:
                lo = byte if no == chunk else 0
                # a file that is not the last one of a batch is whole by then
                hi = upto if no == last else size
                out += [ByteRange(int(conn), path, a, min(a + self.partition_bytes, hi), at + a) for a in range(lo, hi, self.partition_bytes)]
                at += size
        return out

    def read(self, partition: ByteRange) -> Iterator[pa.RecordBatch]:
        filesystem, inner = _filesystem(partition.path)
        with filesystem.open_input_file(inner) as f:
            data = f.read_at(partition.hi - partition.lo, partition.lo)
        yield pa.RecordBatch.from_arrays(
            [pa.array([partition.conn_id], pa.int64()), pa.array([partition.start], pa.int64()), pa.array([data], pa.binary())], names=["conn_id", "start", "data"]
        )

    def commit(self, end: dict) -> None:
        pass


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CaptureArchiveSource)
