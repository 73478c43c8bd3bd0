"""Arrow IPC (feather) files as a table.

A first job reads the files' footers and plans: a row for every run of record batches of about `RUN` bytes.
Those are dealt over tasks, and each task reads the batches of its runs only, and of them only the
columns of the schema asked for. So a file of any size is read by many tasks, a batch at a time. Stores
that pyarrow can't open are read through Spark's own reader, file by file."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

RUN = 32 << 20  # bytes of a file that one task reads


def _open(uri: str) -> pa.NativeFile:
    if uri.startswith("file:"):
        return pa.memory_map("/" + uri[5:].lstrip("/"))
    files, path = fs.FileSystem.from_uri(uri)
    return files.open_input_file(path)


def _typed(batch: pa.RecordBatch, schema: pa.Schema) -> pa.RecordBatch:
    """A batch with the schema's columns, null where it has none."""
    there = set(batch.schema.names)
    columns = [batch.column(f.name).cast(f.type) if f.name in there else pa.nulls(batch.num_rows, f.type) for f in schema]
    return pa.RecordBatch.from_arrays(columns, schema=schema)


def plan(spark: SparkSession, path: str) -> DataFrame:
    """(path, first, last): runs of record batches of the files at `path`."""
    listed = spark.read.format("binaryFile").load(path).select("path", "length")  # names only, no contents

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for uri, size in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                with _open(uri) as data:
                    n = pa.ipc.open_file(data).num_record_batches
                step = max(1, RUN * n // max(size, 1))
                rows += [(uri, a, min(a + step, n)) for a in range(0, n, step)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int32()))], names=["path", "first", "last"])

    return listed.mapInArrow(run, "path string, first int, last int")


def read(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """The rows of the files at `path` (a file, a folder or a pattern), with the schema's columns."""
    kinds = schema if isinstance(schema, StructType) else _parse_datatype_string(schema)
    arrow = to_arrow_schema(kinds)

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for uri, first, last in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                with _open(uri) as data:
                    named = pa.ipc.open_file(data).schema.names
                    file = pa.ipc.open_file(data, options=pa.ipc.IpcReadOptions(included_fields=[k for k, n in enumerate(named) if n in arrow.names]))
                    for k in range(first, last):
                        yield _typed(file.get_batch(k), arrow)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data in b.column(0):
                file = pa.ipc.open_file(pa.BufferReader(data.as_buffer()))
                for k in range(file.num_record_batches):
                    yield _typed(file.get_batch(k), arrow)

    if not _known(spark, path):
        return spark.read.format("binaryFile").load(path).select("content").mapInArrow(whole, kinds)
    return plan(spark, path).repartition("path", "first").mapInArrow(runs, kinds)


def _known(spark: SparkSession, path: str) -> bool:
    """Whether pyarrow can open the store."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme() in ("file", "s3", "gs")
