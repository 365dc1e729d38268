"""Sinks: one dataset per acquisition, overrun guard, state text lines."""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strobe.functions.columns import q
from strobe.sources.dumps import _filesystem

#: Under the folder of acquisitions: the files that were written, and the
#: columns; Spark's own reader passes over both names.
LISTING, SCHEMA = "_listing", "_schema.json"
#: Rows of a row group, or of a batch read back; files and bytes of a reading task.
GROUP_ROWS = 1 << 16
TASK_FILES = 1 << 12
TASK_BYTES = 128 << 20


class DataOverrunError(RuntimeError):
    """An acquisition ended with ``Data overrun``; its rows were stored first."""


def write_acquisitions(
    samples: DataFrame,
    path: str,
    keys: tuple[str, ...] = ("conn_id", "acq_no"),
    order: str = "sample_idx",
    partitions: int | None = None,
    mode: str = "overwrite",
    presorted: bool = False,
    layout: str = "per_acquisition",
) -> None:
    """Write calibrated samples as Parquet with rows in sample order.

    ``layout="per_acquisition"``: one directory per acquisition (the original
    one-file-per-acquisition shape), with a listing of the files, which
    ``read_acquisitions`` reads instead of the folders (see ``_write_files``).
    ``layout="clustered"``: one dataset whose
    files hold contiguous (acquisition, sample) ranges, so an acquisition is
    read back by row-group statistics on ``keys``; at scale this avoids one
    small file per acquisition per task.

    Range partitioning on (keys, order) gives each task a contiguous run of
    samples: a huge acquisition is written by many tasks and small ones share
    tasks. With ``presorted`` the partitions already hold such runs (decoded
    from a range-partitioned frame index) and are only sorted in place.
    """
    if presorted:
        ordered = samples.sortWithinPartitions(*keys, order)
    elif partitions:
        ordered = samples.repartitionByRange(partitions, *keys, order).sortWithinPartitions(*keys, order)
    else:
        # no fixed count: AQE sizes the range partitions from the data
        ordered = samples.repartitionByRange(*keys, order).sortWithinPartitions(*keys, order)
    if layout == "per_acquisition":
        _write_files(ordered, path.rstrip("/"), list(keys), mode)
    elif layout == "clustered":
        ordered.write.mode(mode).parquet(path)
    else:
        raise ValueError(f"unknown layout {layout!r}")


def _make_room(path: str, mode: str) -> bool:
    """What the save modes ask of a folder; False: nothing is to be written."""
    from pyarrow import fs

    if mode not in ("overwrite", "append", "ignore", "error", "errorifexists"):
        raise ValueError(f"unknown mode {mode!r}")
    filesystem, inner = _filesystem(path)
    if filesystem.get_file_info(inner).type == fs.FileType.NotFound:
        filesystem.create_dir(inner, recursive=True)
    elif mode == "overwrite":
        filesystem.delete_dir_contents(inner)
    elif mode != "append":
        if mode != "ignore":
            raise FileExistsError(path)
        return False
    return True


def _write_files(ordered: DataFrame, path: str, keys: list[str], mode: str) -> None:
    """One Parquet file per acquisition and task, under ``key=value`` folders.

    Spark's dynamic partitions cost tens of milliseconds a folder, and finding
    the files again lists every folder; with an acquisition of a few rows that
    is nearly all of the time. So tasks cut their ordered rows where the keys
    change and write the runs themselves. A file moves into place when it is
    whole, under a name that its task has in every attempt, and the listing
    (keys, path, rows, bytes) is a table that Spark commits behind them all.
    """
    if not _make_room(path, mode):
        return
    names = ordered.columns
    place = [names.index(k) for k in keys]
    kept = [i for i in range(len(names)) if i not in place]
    job = uuid.uuid4().hex[:12]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        task = TaskContext.get()
        number = task.partitionId() if task else 0
        filesystem, root = _filesystem(path)
        now, writer, tmp, target = None, None, None, None
        held: list[pa.RecordBatch] = []
        rows, waiting = 0, 0
        done: list[tuple] = []

        def flush() -> None:
            nonlocal writer, waiting
            table = pa.Table.from_batches(held)
            if writer is None:
                writer = pq.ParquetWriter(tmp, table.schema, filesystem=filesystem)
            writer.write_table(table)
            held.clear()
            waiting = 0

        def finish() -> None:
            nonlocal writer, rows
            if held:
                flush()
            writer.close()
            filesystem.move(tmp, target)
            done.append((*now, f"{path}{target[len(root):]}", rows, filesystem.get_file_info(target).size))
            writer, rows = None, 0

        def listed() -> pa.RecordBatch:
            columns = [pa.array([d[i] for d in done], kinds[i]) for i in range(len(keys) + 3)]
            done.clear()
            return pa.RecordBatch.from_arrays(columns, [f"__k{i}" for i in range(len(keys))] + ["path", "rows", "bytes"])

        kinds: list = []
        for batch in batches:
            if not batch.num_rows:
                continue
            kinds = [batch.column(i).type for i in place] + [pa.string(), pa.int64(), pa.int64()]
            values = [batch.column(i).to_pylist() for i in place]
            own = pa.RecordBatch.from_arrays([batch.column(i) for i in kept], [names[i] for i in kept])
            of = list(zip(*values, strict=True))
            cuts = [0, *(i for i in range(1, len(of)) if of[i] != of[i - 1]), len(of)]
            for lo, hi in zip(cuts, cuts[1:]):
                if of[lo] != now:
                    if now is not None:
                        finish()
                    now = of[lo]
                    folders = "/".join(f"{k}={'__HIVE_DEFAULT_PARTITION__' if v is None else quote(str(v), safe='')}" for k, v in zip(keys, now, strict=True))
                    filesystem.create_dir(f"{root}/{folders}", recursive=True)
                    target = f"{root}/{folders}/part-{number:05d}-{job}.parquet"
                    tmp = f"{root}/{folders}/.tmp-{uuid.uuid4().hex}"
                held.append(own.slice(lo, hi - lo))
                rows, waiting = rows + hi - lo, waiting + hi - lo
                if waiting >= GROUP_ROWS:
                    flush()
            if len(done) >= TASK_FILES:
                yield listed()
        if now is not None:
            finish()
        if done:
            yield listed()

    # mapInArrow resolves its inputs by name: hide the dots of capture names
    safe = ordered.select(*[F.col(q(n)).alias(f"__c{i}") for i, n in enumerate(names)])
    listing = T.StructType([T.StructField(f"__k{i}", ordered.schema[k].dataType) for i, k in enumerate(keys)])
    listing = listing.add("path", T.StringType()).add("rows", T.LongType()).add("bytes", T.LongType())
    files = safe.mapInArrow(run, listing)
    files.toDF(*keys, "path", "rows", "bytes").write.mode("append").parquet(f"{path}/{LISTING}")
    filesystem, inner = _filesystem(f"{path}/{SCHEMA}")
    with filesystem.open_output_stream(inner) as out:
        out.write(json.dumps({"keys": keys, "schema": ordered.schema.jsonValue()}).encode())


def read_acquisitions(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Rows that ``write_acquisitions`` stored per acquisition: the files of
    the listing, each read whole by one task, many small ones by each.
    ``columns``: those to read, of the files or keys; default all."""
    path = path.rstrip("/")
    filesystem, inner = _filesystem(f"{path}/{SCHEMA}")
    with filesystem.open_input_stream(inner) as f:
        made = json.loads(f.read())
    schema, keys = T.StructType.fromJson(made["schema"]), made["keys"]
    wanted = [n for n in schema.names if columns is None or n in columns]
    if columns is not None and len(wanted) < len(set(columns)):
        raise ValueError(f"unknown columns {sorted(set(columns) - set(wanted))}")
    listing = spark.read.parquet(f"{path}/{LISTING}")
    n, size = listing.agg(F.count(F.lit(1)), F.coalesce(F.sum("bytes"), F.lit(0))).collect()[0]
    # a file is a few bytes in the shuffle: a given number, which AQE does not merge
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n // TASK_FILES), -(-size // TASK_BYTES))
    files = listing.select("path", *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).repartition(tasks, "path")
    stored = [x for x in wanted if x not in keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.parquet as pq

        held: list[pa.RecordBatch] = []

        def joined() -> pa.RecordBatch:
            out = pa.Table.from_batches(held).combine_chunks().to_batches()
            held.clear()
            return out[0]

        for listed in batches:
            for i, at in enumerate(listed.column(0).to_pylist()):
                filesystem, inner = _filesystem(at)
                with filesystem.open_input_file(inner) as f:
                    file = pq.ParquetFile(f, pre_buffer=False)
                    for batch in file.iter_batches(GROUP_ROWS, columns=stored, use_threads=False):
                        own = {x: batch.column(j) for j, x in enumerate(batch.schema.names)}
                        for j, k in enumerate(keys):
                            if k in wanted:
                                value = listed.column(1 + j).slice(i, 1)
                                own[k] = value.take(pa.array([0] * batch.num_rows, pa.int32()))
                        held.append(pa.RecordBatch.from_arrays([own[x] for x in wanted], [f"__c{j}" for j in range(len(wanted))]))
                        if sum(b.num_rows for b in held[-64:]) >= GROUP_ROWS or len(held) >= TASK_FILES:
                            yield joined()
        if held:
            yield joined()

    out = T.StructType([T.StructField(f"__c{j}", schema[x].dataType) for j, x in enumerate(wanted)])
    return files.mapInArrow(run, out).toDF(*wanted)


def guard_overruns(ends: DataFrame) -> None:
    """Raise after the data is stored if any acquisition ended by overrun.

    Every acquisition is checked, not only the last one seen.
    """
    bad = ends.where(F.col("reason") == "Data overrun").select("conn_id", "acq_no").limit(1).collect()
    if bad:
        row = bad[0]
        raise DataOverrunError(
            f"Data overrun in acquisition {row['acq_no']} of connection {row['conn_id']}: "
            "streaming aborted, last frame may be corrupt"
        )
