"""Datasets that grow by whole commits.

Each commit writes its rows in a folder of its own below the dataset, then adds a small record of it
(`_commits/<number>`): its number, folder, schema, and what it was asked for by (`token`, the number of a
stream's batch or a run's name). The record is made in one step that fails where the number is taken, so a
commit is there as a whole or not at all: readers take the folders that records name, what a job left behind
when it died is never seen, and a job that runs again under its token adds nothing twice.

With a key (a session, say), the rows of a later commit stand in for those that earlier ones have of
the same keys. `compact` folds all commits in one."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

RECORDS, BATCH = "_commits", "_batch"


def _files(spark: SparkSession, where: str) -> tuple:
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def records(spark: SparkSession, path: str) -> list[dict]:
    """The commits that readers see, in order: those from the last one on that began the dataset anew."""
    files, folder = _files(spark, f"{path}/{RECORDS}")
    if not files.exists(folder):
        return []
    names = sorted(s.getPath().getName() for s in files.listStatus(folder))
    read = lambda n: spark._jvm.org.apache.commons.io.IOUtils.toString(files.open(_files(spark, f"{path}/{RECORDS}/{n}")[1]), "UTF-8")
    out: list[dict] = []
    for name in names:
        one = json.loads(read(name)) | {"number": int(name)}
        out = [one] if one["anew"] else [*out, one]
    return out


def commit(df: DataFrame, path: str, token: str | None = None, anew: bool = False) -> bool:
    """Add the rows of `df` as one commit, unless there is one of this token; `anew` hides all earlier
    ones. Says whether it has added one."""
    spark, there = df.sparkSession, records(df.sparkSession, path)
    if token is not None and any(r["token"] == token for r in there):
        return False
    number = there[-1]["number"] + 1 if there else 0
    folder = f"{BATCH}={number:08d}-{uuid.uuid4().hex}"
    df.write.parquet(f"{path}/{folder}")
    files, record = _files(spark, f"{path}/{RECORDS}/{number:08d}")
    _, draft = _files(spark, f"{path}/{RECORDS}-draft-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps({"folder": folder, "token": token, "anew": anew, "schema": df.schema.jsonValue()}).encode()))
    out.close()
    files.mkdirs(record.getParent())
    if files.exists(record) or not files.rename(draft, record):  # a rename doesn't replace a file
        files.delete(draft, False)
        raise RuntimeError(f"commit {number} of {path} was taken by another writer; run again")
    return True


def read(spark: SparkSession, path: str, key: str | None = None) -> DataFrame:
    """The dataset; with `key`, each key's rows of the latest commit that has any."""
    there = records(spark, path)
    if not there:
        raise FileNotFoundError(f"no commit in {path}")
    schema = StructType.fromJson(there[-1]["schema"])
    df = spark.read.schema(StructType([*schema.fields]).add(BATCH, StringType())).option("basePath", path).parquet(*[f"{path}/{r['folder']}" for r in there])
    if key is not None and len(there) > 1:
        latest = df.groupBy(F.col(key).alias("_key")).agg(F.max(BATCH).alias("_latest"))
        df = df.join(latest, F.col(key).eqNullSafe(F.col("_key")) & (F.col(BATCH) == F.col("_latest"))).drop("_key", "_latest")
    return df.drop(BATCH)


def compact(spark: SparkSession, path: str, key: str | None = None) -> None:
    """Write what readers see as one commit that stands for all before it."""
    there = records(spark, path)
    if len(there) > 1:
        commit(read(spark, path, key), path, f"compact-{there[-1]['number']}", anew=True)
