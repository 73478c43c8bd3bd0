"""Tables, shared scratch folders and files for the corpus operators."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from functools import cache

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

_MADE: list[str] = []  # folders asked for


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@cache
def _own_folder() -> str:
    return f"file://{tempfile.mkdtemp(prefix='tracewell-')}"


def shared_dir(spark: SparkSession, kind: str) -> str:
    """A new folder below the cluster's spark.checkpoint.dir. Only in a local session without that
    setting a temporary folder of this machine stands in; elsewhere executors wouldn't share it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _own_folder()
    _MADE.append(f"{root.rstrip('/')}/{kind}-{uuid.uuid4().hex}")
    return _MADE[-1]


def clear() -> int:
    """Delete the folders that this process has asked for so far, and say how many were there. Tables
    read from them are gone then, so it is for the end of a job."""
    gone = 0
    while _MADE:
        files, folder = store(_MADE.pop())
        if files.get_file_info(folder).type == fs.FileType.Directory:
            files.delete_dir(folder)
            gone += 1
    return gone


def saved(df: DataFrame, kind: str) -> DataFrame:
    """Write `df` as Parquet in the shared folder and read it back: cuts the lineage, and any
    executor can reread it after another is lost."""
    path = shared_dir(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a folder; a bare path is a local or mounted one."""
    if "://" not in uri and not uri.startswith("file:"):
        return fs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def put(uri: str, name: str, data: bytes) -> str:
    """Write a file under a temporary name, then move it in place: a task that runs twice leaves
    one whole file."""
    files, folder = store(uri)
    files.create_dir(folder, recursive=True)
    part = f"{folder}/.{name}.{uuid.uuid4().hex}"
    with files.open_output_stream(part) as out:
        out.write(data)
    files.move(part, f"{folder}/{name}")
    return name


def get(uri: str, name: str) -> bytes:
    files, folder = store(uri)
    with files.open_input_file(f"{folder}/{name}") as f:
        return f.read()


def release() -> None:
    """Hand memory that is free in this worker back to the system: it lives on, with what it once took, while
    tasks of other kinds run beside it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only the GNU C library has it
        ctypes.CDLL(None).malloc_trim(0)
