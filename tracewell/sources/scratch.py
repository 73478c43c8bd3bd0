"""Folders for tables that a job writes and reads again."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession

_MADE: list[tuple[SparkSession, str]] = []  # folders asked for

@cache
def _own() -> str:
    return f"file://{tempfile.mkdtemp(prefix='tracewell-')}"


def folder(spark: SparkSession, kind: str) -> str:
    """A new folder in the shared one that the cluster names in spark.checkpoint.dir. Only a local
    session without that setting gets a temporary folder of this machine; elsewhere executors
    wouldn't share it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.conf.get("spark.master", "")):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        root = _own()
    _MADE.append((spark, f"{root.rstrip('/')}/{kind}-{uuid.uuid4().hex}"))
    return _MADE[-1][1]


def clear() -> int:
    """Delete the folders that this process has asked for so far, through the cluster's own file systems,
    and say how many were there. Tables read from them are gone then, so it is for the end of a job."""
    gone = 0
    while _MADE:
        spark, where = _MADE.pop()
        path = spark._jvm.org.apache.hadoop.fs.Path(where)
        gone += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return gone


def saved(df: DataFrame, kind: str) -> DataFrame:
    """Write a table in the shared folder and read it back, so that what follows reads it as often as
    it needs without working it out anew."""
    path = folder(df.sparkSession, kind)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
