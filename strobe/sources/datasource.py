"""Python Data Sources of captures.

``spark.read.format("capture_dump")``: the samples of an archive over its
published frame index (``dumps.publish_index``, or ``open_dump`` for both).

Options:
  * ``index``  -- folder of the published index; required. Planning lists its
    files and reads the registry of record layouts, one row each; every file is
    one input partition, sized in payload bytes when the index was written.
  * ``layout`` -- ``all`` (default) or the number of one layout in the registry.
  * ``fields`` -- comma-separated capture columns to decode (column pruning
    into the binary records); default all.
  * ``pushdown`` -- ``true`` to push comparisons on conn_id / acq_no /
    frame_no into the index read (needs
    ``spark.sql.python.filterPushdown.enabled``).

Rows: conn_id, acq_no, frame_no, sample_idx, then the columns of the layout if
one is read, or the archive has one only; else ``process``, ``sig`` and one
nullable struct column ``s<sig>`` for each layout, with the types of that
layout, so that nothing is widened. ``as_variant`` makes one VARIANT of them.

``df.write.format("capture_layouts")``: such rows, each layout to Parquet files
of its own in the types of the wire, in one pass. Tasks write files that nobody
reads until the job's commit names them in a manifest; files of failed or
repeated tasks stay unnamed. ``read_layouts`` reads what was committed.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from strobe.sources.capture_format import FieldSpec, fields_from_json, record_dtype
from strobe.sources.dumps import REGISTRY, PieceReader, _filesystem

KEYS = ("conn_id", "acq_no", "frame_no", "sample_idx")


class IndexFile(InputPartition):
    def __init__(self, path: str):
        self.path = path


@dataclass(frozen=True)
class Layout:
    """One row of the registry."""

    sig: int
    fields: tuple[FieldSpec, ...]
    process: str

    @property
    def column(self) -> str:
        return f"s{self.sig}"

    def chosen(self, names: list[str] | None) -> list[FieldSpec]:
        return [f for f in self.fields if names is None or f.column in names]


def _parquet_files(folder: str) -> list[str]:
    """Paths of the Parquet files under a folder, in the folder's scheme."""
    from pyarrow import fs

    filesystem, inner = _filesystem(folder)
    infos = filesystem.get_file_info(fs.FileSelector(inner, recursive=True, allow_not_found=True))
    found = sorted(i.path for i in infos if i.is_file and i.path.endswith(".parquet"))
    url = urlparse(folder)
    if not url.scheme or url.scheme == "file":
        return found
    host = url.netloc if inner.startswith("/") else ""  # other stores have the bucket in the path
    return [f"{url.scheme}://{host}{p}" for p in found]


def _read_parquet(path: str, **options) -> pa.Table:
    import pyarrow.parquet as pq

    filesystem, inner = _filesystem(path)
    return pq.read_table(inner, filesystem=filesystem, **options)


def read_registry(index: str) -> list[Layout]:
    """Layouts of a published index, by number."""
    rows = [r for p in _parquet_files(f"{index.rstrip('/')}/{REGISTRY}") for r in _read_parquet(p, columns=["sig", "layout", "process"]).to_pylist()]
    return [Layout(r["sig"], tuple(fields_from_json(r["layout"])), r["process"]) for r in sorted(rows, key=lambda r: r["sig"])]


def _names(option: str | None, layouts: list[Layout]) -> list[str] | None:
    if not option:
        return None
    wanted = [x.strip() for x in option.split(",") if x.strip()]
    missing = [w for w in wanted if not any(f.column == w for x in layouts for f in x.fields)]
    if missing:
        raise ValueError(f"unknown capture columns {missing}")
    return wanted


class CaptureDumpDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "capture_dump"

    def _plan(self) -> tuple[list[Layout], bool, list[str] | None]:
        """Layouts to read, whether they are the columns themselves, and fields."""
        layouts = read_registry(self.options["index"])
        one = self.options.get("layout", "all")
        if one != "all":
            layouts = [x for x in layouts if x.sig == int(one)]
            if not layouts:
                raise ValueError(f"the archive has no layout {one}")
        return layouts, len(layouts) == 1, _names(self.options.get("fields"), layouts)

    def schema(self) -> T.StructType:
        from strobe.sources.captures import spark_schema

        layouts, flat, names = self._plan()
        base = [T.StructField(n, T.LongType(), False) for n in KEYS]
        if flat:
            return T.StructType(base + spark_schema(layouts[0].chosen(names)))
        base += [T.StructField("process", T.StringType()), T.StructField("sig", T.IntegerType())]
        return T.StructType(base + [T.StructField(x.column, T.StructType(spark_schema(x.chosen(names)))) for x in layouts if x.chosen(names)])

    def reader(self, schema: T.StructType) -> DataSourceReader:
        cls = CaptureDumpFilteringReader if self.options.get("pushdown", "false").lower() == "true" else CaptureDumpReader
        return cls(self.options["index"], *self._plan())


_PUSHABLE = ("conn_id", "acq_no", "frame_no")


class CaptureDumpReader(DataSourceReader):
    def __init__(self, index: str, layouts: list[Layout], flat: bool, names: list[str] | None):
        self.index = index
        self.layouts = layouts
        self.flat = flat
        self.names = names
        self.pushed: list[tuple] = []  # pyarrow filter triples on index columns

    def partitions(self) -> list[InputPartition]:
        return [IndexFile(p) for p in _parquet_files(f"{self.index.rstrip('/')}/frames")] or [IndexFile("")]

    def read(self, partition: IndexFile) -> Iterator[pa.RecordBatch]:
        return _read_frames(self, partition)


class CaptureDumpFilteringReader(CaptureDumpReader):
    """The reader with filter pushdown; PySpark only accepts it when
    ``spark.sql.python.filterPushdown.enabled`` is on, so it is chosen by the
    ``pushdown`` option."""

    def pushFilters(self, filters):
        """Comparisons on conn_id / acq_no / frame_no select frames from the
        index before any payload is read (when
        ``spark.sql.python.filterPushdown.enabled`` is on); Spark still
        re-applies every filter, so pushing is only an optimisation."""
        from pyspark.sql.datasource import (
            EqualTo,
            GreaterThan,
            GreaterThanOrEqual,
            In,
            LessThan,
            LessThanOrEqual,
        )

        ops = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}
        for f in filters:
            name = f.attribute[0] if len(f.attribute) == 1 else None
            if name in _PUSHABLE and type(f) in ops:
                self.pushed.append((name, ops[type(f)], f.value))
            elif name in _PUSHABLE and isinstance(f, In):
                self.pushed.append((name, "in", list(f.value)))
            else:
                yield f


#: Samples of an output batch, about.
BATCH_RECORDS = 1 << 17


def _read_frames(src: CaptureDumpReader, partition: IndexFile) -> Iterator[pa.RecordBatch]:
    """Samples of one index file; frames of a layout follow each other in
    batches, and their bytes are read in merged ranges."""
    if not partition.path:
        return
    from strobe.sources.captures import _column_array

    reader = PieceReader()
    columns = ["conn_id", "acq_no", "frame_no", "first_sample", "n_bytes", "sig", "pieces", "payload"]
    table = _read_parquet(partition.path, columns=columns, filters=src.pushed or None)
    wanted = {x.sig: x.chosen(src.names) for x in src.layouts}
    for layout in src.layouts:
        dtype = record_dtype(list(layout.fields))
        own = table.filter(pc.equal(table.column("sig"), layout.sig)).combine_chunks()
        done = np.cumsum(own.column("n_bytes").to_numpy()) // (BATCH_RECORDS * dtype.itemsize)
        cuts = np.flatnonzero(np.diff(done, prepend=0)).tolist()
        for lo, hi in zip([0, *cuts], [*cuts, own.num_rows], strict=True):
            batch = own.slice(lo, hi - lo)
            if not batch.num_rows:
                continue
            payload, pieces = batch.column("payload").to_pylist(), batch.column("pieces").to_pylist()
            read = reader.read_many([p if b is None else [] for p, b in zip(pieces, payload, strict=True)])
            blobs = [b if b is not None else r for b, r in zip(payload, read, strict=True)]
            counts = np.array([len(b) // dtype.itemsize for b in blobs], dtype=np.int64)
            records = np.frombuffer(b"".join(blobs), dtype=dtype)
            row_of = np.repeat(np.arange(len(blobs)), counts)
            local = np.arange(len(records)) - np.repeat(np.cumsum(counts) - counts, counts)
            first = batch.column("first_sample").to_numpy()
            out = [batch.column(k).combine_chunks().take(pa.array(row_of)) for k in KEYS[:3]]
            out.append(pa.array((first[row_of] + local).astype(np.int64)))
            names = list(KEYS)
            fields = {f.column: _column_array(records[f.column], np.dtype(f.type).name) for f in wanted[layout.sig]}
            if src.flat:
                out += fields.values()
                names += fields
            else:
                n = len(records)
                out += [pa.array([layout.process] * n, pa.string()), pa.array(np.full(n, layout.sig, dtype=np.int32))]
                names += ["process", "sig"]
                for other in src.layouts:
                    if not wanted[other.sig]:
                        continue
                    if other.sig == layout.sig:
                        out.append(pa.StructArray.from_arrays(list(fields.values()), list(fields)))
                    else:
                        kinds = [pa.field(f.column, _column_array(np.zeros(0, dtype=f.type), np.dtype(f.type).name).type) for f in wanted[other.sig]]
                        out.append(pa.nulls(n, pa.struct(kinds)))
                    names.append(other.column)
            yield pa.RecordBatch.from_arrays(out, names=names)


# --------------------------------------------------------------------------- typed sink

MANIFESTS = "_manifest"


@dataclass
class Written(WriterCommitMessage):
    files: list[tuple[str, str, int]]  # layout column, path, rows


class CaptureLayoutsDataSource(DataSource):
    """Option ``path``: the folder; ``index``: a published index whose
    registry says the wire types (without it the types of the columns stay)."""

    @classmethod
    def name(cls) -> str:
        return "capture_layouts"

    def schema(self) -> T.StructType:
        return T.StructType([])

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        index = self.options.get("index")
        return LayoutWriter(self.options["path"].rstrip("/"), overwrite, read_registry(index) if index else [])


class LayoutWriter(DataSourceArrowWriter):
    def __init__(self, path: str, overwrite: bool, layouts: list[Layout]):
        self.path = path
        self.overwrite = overwrite
        self.wire = {x.column: {f.column: f.type for f in x.fields} for x in layouts}

    def _typed(self, name: str, values: pa.Array, layout: str) -> pa.Array:
        """In the type of the wire, where that only narrows what Spark widened."""
        kind = self.wire.get(layout, {}).get(name, "")
        return values.cast(pa.from_numpy_dtype(np.dtype(kind))) if kind.startswith("uint") and not pa.types.is_floating(values.type) else values

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        import pyarrow.parquet as pq

        writers: dict[str, tuple] = {}
        rows: dict[str, int] = {}
        for batch in iterator:
            flat = [n for n in batch.schema.names if not pa.types.is_struct(batch.schema.field(n).type)]
            for name in (n for n in batch.schema.names if n not in flat):
                own = batch.filter(batch.column(name).is_valid())
                if not own.num_rows:
                    continue
                struct = own.column(name)
                fields = {struct.type.field(i).name: struct.field(i) for i in range(struct.type.num_fields)}
                out = pa.Table.from_arrays(
                    [*(own.column(n) for n in flat), *(self._typed(k, v, name) for k, v in fields.items())], names=[*flat, *fields]
                )
                if name not in writers:
                    path = f"{self.path}/{name}/part-{uuid.uuid4().hex}.parquet"
                    filesystem, inner = _filesystem(path)
                    filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                    writers[name] = path, pq.ParquetWriter(inner, out.schema, filesystem=filesystem)
                writers[name][1].write_table(out)
                rows[name] = rows.get(name, 0) + out.num_rows
        for _, writer in writers.values():
            writer.close()
        return Written([(name, path, rows[name]) for name, (path, _) in writers.items()])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        files = [{"layout": a, "path": b, "rows": c} for m in messages if m is not None for a, b, c in m.files]
        path = f"{self.path}/{MANIFESTS}/{time.time_ns():020d}-{uuid.uuid4().hex}.json"
        filesystem, inner = _filesystem(path)
        filesystem.create_dir(inner.rsplit("/", 1)[0], recursive=True)
        with filesystem.open_output_stream(inner + ".tmp") as out:
            out.write(json.dumps({"overwrite": self.overwrite, "files": files}).encode())
        filesystem.move(inner + ".tmp", inner)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        for m in messages:
            for _, path, _ in m.files if m is not None else []:
                filesystem, inner = _filesystem(path)
                filesystem.delete_file(inner)


def read_layouts(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """What was committed to a folder, by layout column: the files of the
    manifests from the last overwriting one on."""
    from pyarrow import fs

    filesystem, inner = _filesystem(f"{path.rstrip('/')}/{MANIFESTS}")
    names = sorted(i.path for i in filesystem.get_file_info(fs.FileSelector(inner, allow_not_found=True)) if i.path.endswith(".json"))
    files: dict[str, list[str]] = {}
    for name in names:
        with filesystem.open_input_stream(name) as f:
            manifest = json.loads(f.read())
        if manifest["overwrite"]:
            files = {}
        for x in manifest["files"]:
            files.setdefault(x["layout"], []).append(x["path"])
    return {layout: spark.read.parquet(*paths) for layout, paths in sorted(files.items())}


# --------------------------------------------------------------------------- helpers


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CaptureDumpDataSource)
    spark.dataSource.register(CaptureLayoutsDataSource)


def open_dump(spark: SparkSession, root: str, index: str, **options: str) -> DataFrame:
    """All samples of an archive without an index: the index of its files is
    built and published under ``index``, then read."""
    from strobe.sources.dumps import list_chunks, materialize_index, publish_index
    from strobe.sources.parallel_index import index_archive_files

    register(spark)
    publish_index(materialize_index(index_archive_files(list_chunks(spark, root))), index)
    return spark.read.format("capture_dump").options(index=index, **options).load()


def as_variant(samples: DataFrame, out: str = "sample") -> DataFrame:
    """The structs of a mixed read as one VARIANT column."""
    structs = [f.name for f in samples.schema.fields if isinstance(f.dataType, T.StructType)]
    parts: list[Column] = [F.to_variant_object(F.col(s)) for s in structs]
    rest = [F.col(n) for n in samples.columns if n not in structs]
    return samples.select(*rest, F.coalesce(*parts).alias(out) if len(parts) > 1 else parts[0].alias(out))
