"""Reading, uniting and writing many session files; work lists."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NullType, StructType

from tracewell.sources import arrow, commits

#: Known tables; others are read with inferred types.
STREAMS = "blockname string, start_date string, channel string, raw_au double, sample_idx bigint"
EPOCHS = "blockname string, start_date string, name string, onset double, offset double"
MANUAL_EVENTS = "blockname string, event_id_char string, event_ts double"


def load(spark: SparkSession, path: str, schema: str | StructType | None = None) -> DataFrame:
    """A table in Parquet, Arrow (feather) or CSV, by what its folder or name holds; columnar first.
    NaN and `NA` are null."""
    if path.endswith(".parquet") or schema is None and not path.endswith((".csv", ".feather", ".arrow")):
        df = spark.read.parquet(path)
    elif path.endswith((".feather", ".arrow")):
        df = arrow.read(spark, path, schema)
    else:
        df = spark.read.csv(path, schema=schema, header=True, nullValue="NA")
    doubles = [c for c, t in df.dtypes if t in ("double", "float")]
    return df.withColumns({c: F.nanvl(c, F.lit(None)) for c in doubles}) if doubles else df


def wanted(name: Column, holds: list[str] | None = None, starts: list[str] | None = None, ends: str | None = None) -> Column:
    """Whether a file's name holds one of the strings, starts with one of the prefixes and has the
    suffix; an empty list asks for nothing."""
    quoted = lambda xs: "|".join(re.escape(x) for x in xs)
    out = F.lit(True)
    if holds:
        out = out & name.rlike(quoted(holds))
    if starts:
        out = out & name.rlike(f"^(?:{quoted(starts)})")
    return out & name.endswith(ends) if ends else out


def with_file_name(df: DataFrame, out: str = "fn") -> DataFrame:
    return df.withColumn(out, F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1))


def coerced(a: DataFrame, b: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both tables with shared columns cast to string where their types clash and one is a string;
    other clashes go to the wider number, or to string."""
    mine, theirs = dict(a.dtypes), dict(b.dtypes)
    numbers = ["int", "bigint", "float", "double"]
    for c in mine.keys() & theirs.keys():
        x, y = mine[c], theirs[c]
        if x == y or isinstance(a.schema[c].dataType, NullType) or isinstance(b.schema[c].dataType, NullType):
            continue
        to = numbers[max(numbers.index(x), numbers.index(y))] if x in numbers and y in numbers else "string"
        a, b = a.withColumn(c, F.col(c).cast(to)), b.withColumn(c, F.col(c).cast(to))
    return a, b


def united(tables: Iterable[DataFrame]) -> DataFrame:
    """Union by name of tables of one kind, types reconciled, missing columns null."""
    return reduce(lambda a, b: (lambda p: p[0].unionByName(p[1], allowMissingColumns=True))(coerced(a, b)), tables)


def read_united(spark: SparkSession, path: str, holds: list[str] | None = None, starts: list[str] | None = None, ends: str = "", out: str = "fn") -> DataFrame:
    """All Parquet files below `path` whose names hold, start with and end with what is asked for, as one table
    with their name (without the suffix and `.parquet`) in `out`. A first job reads the files' schemas; files
    of one schema are one scan, and only the schemas, which are few, are reconciled and united."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path).select("path")
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"\.parquet$", "")
    listed = listed.where(wanted(name, holds, starts, ends or None))

    def schemas(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = []
            for uri in b.column(0).to_pylist():
                with arrow._open(uri) as data:
                    kept = pq.read_schema(data)
                    found.append((kept.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"").decode() or str(kept.remove_metadata()))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string())], names=["path", "kind"])

    if arrow._known(spark, path):
        kinds = listed.mapInArrow(schemas, "path string, kind string").groupBy("kind").agg(F.collect_list("path").alias("paths")).collect()  # names of files, which a scan lists too
    else:
        kinds = [{"paths": [r["path"]]} for r in listed.collect()]
    tables = []
    for kind in sorted(kinds, key=lambda r: min(r["paths"])):
        one = with_file_name(spark.read.parquet(*sorted(kind["paths"])), out)
        tables.append(one.withColumn(out, stem(F.regexp_replace(out, r"\.parquet$", ""), [ends]) if ends else F.regexp_replace(out, r"\.parquet$", "")))
    if not tables:
        raise FileNotFoundError(f"no file of these names in {path}")
    return united(tables)


def not_in(new: DataFrame, old: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `new` whose keys `old` hasn't."""
    return new.join(old.select(keys).distinct(), keys, "left_anti")


def combine(new: DataFrame, path: str, key: str = "med_file_name", append: bool = True, token: str | None = None) -> DataFrame:
    """Add to the dataset at `path` the files that it hasn't, or begin it anew, as one commit; returns the
    dataset. What a job that died has left is never seen; the same `token` adds nothing twice."""
    spark = new.sparkSession
    if append and commits.records(spark, path):
        commits.commit(not_in(new, commits.read(spark, path), [key]).select(new.columns), path, token)
    else:
        commits.commit(new, path, token, anew=True)
    return commits.read(spark, path)


def exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def of_log(df: DataFrame, log: DataFrame, variables: list[str], values: list, key: str = "blockname") -> DataFrame:
    """Rows of the files that the log lists with these values."""
    met = F.lit(True)
    for v, x in zip(variables, values, strict=True):
        met = met & (F.col(v) == x)
    return df.join(log.where(met).select(key).distinct(), key, "left_semi")


def stem(name: Column, suffixes: list[str]) -> Column:
    """A file's name without the first suffix that it ends with."""
    return F.regexp_replace(name, "(?:" + "|".join(re.escape(s) for s in sorted(suffixes, key=len, reverse=True)) + ")$", "")


def work_list(inputs: DataFrame, outputs: DataFrame, suffixes: list[str], ignored: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Stems of inputs without an output, and of outputs without an input (to warn of); both tables
    have a column fn."""
    keep = ~wanted(F.col("fn"), holds=ignored) if ignored else F.lit(True)
    a = inputs.where(keep).select(stem(F.col("fn"), suffixes).alias("stem")).distinct()
    b = outputs.where(keep).select(stem(F.col("fn"), suffixes).alias("stem")).distinct()
    return a.join(b, "stem", "left_anti"), b.join(a, "stem", "left_anti")


def session_work_list(log: DataFrame, inputs: DataFrame, outputs: DataFrame, suffixes: list[str]) -> DataFrame:
    """Sessions with a block whose output is missing."""
    done = outputs.select(stem(F.col("fn"), suffixes).alias("blockname")).distinct()
    there = inputs.select(stem(F.col("fn"), suffixes).alias("session_name")).distinct()
    return log.join(there, "session_name", "left_semi").join(done, "blockname", "left_anti").select("session_name").distinct()


def write_sessions(df: DataFrame, path: str, overwrite: bool = True, key: str = "blockname", token: str | None = None) -> None:
    """Add a table of sessions as one commit: sessions in `df` stand in for their old rows, or with
    `overwrite` false only those not yet there are added. `read_sessions` reads whole sessions only."""
    spark = df.sparkSession
    if not overwrite and commits.records(spark, path):
        df = not_in(df, commits.read(spark, path).select(key), [key]).select(df.columns)
    commits.commit(df.repartition(key).sortWithinPartitions(key), path, token)


def read_sessions(spark: SparkSession, path: str, key: str = "blockname") -> DataFrame:
    return commits.read(spark, path, key)
