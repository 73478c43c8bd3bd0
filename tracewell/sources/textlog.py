"""Text logs of devices: operant boxes, serial lines, video tracking.

A file is one row (file, text), as `spark.read.text(wholetext=True)` gives it, so its lines have sure
numbers; files are small, and work is dealt by file.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewell.operators.shape import clean_name


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(file, text) of every file."""
    rows = spark.read.text(path, wholetext=True)
    return rows.select(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"), F.col("value").alias("text"))


def box_values(texts: DataFrame) -> DataFrame:
    """Long table (file, n_sbj, med_var, index, value) of operant-box logs: a subject begins at each
    `Start Date:`; a key holds until the next; the values of an array's rows follow each other, the
    row's own number before the colon left out. What comes before the first subject is skipped."""
    lines = texts.select("file", F.posexplode(F.split("text", "\r?\n")).alias("line", "s")).withColumn("s", F.rtrim(F.regexp_replace("s", "\r", "")))
    order = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    own = F.when((F.length("s") >= 2) & ~F.col("s").startswith(" ") & F.col("s").contains(":"), F.substring_index("s", ":", 1))
    held = lines.withColumns({"n_sbj": F.sum(F.col("s").contains("Start Date:").cast("int")).over(order), "med_var": F.last(own, ignorenulls=True).over(order)})
    body = F.when(F.col("s").contains(":"), F.expr("substring(s, instr(s, ':') + 1)")).otherwise(F.col("s"))
    words = held.where("n_sbj > 0").select("file", "n_sbj", "med_var", "line", F.posexplode(F.filter(F.split(F.trim(body), " +"), lambda x: x != "")).alias("at", "value"))
    index = F.row_number().over(Window.partitionBy("file", "n_sbj", "med_var").orderBy("line", "at"))
    return words.select("file", F.col("n_sbj").cast("int").alias("n_sbj"), "med_var", index.alias("index"), "value")


ID_KEYS = {"Experiment": "experiment", "Start Date": "start_date", "Subject": "subject", "Group": "group"}


def box_ids(values: DataFrame) -> DataFrame:
    return values.where(F.col("med_var").isin(list(ID_KEYS))).groupBy("file", "n_sbj").pivot("med_var", list(ID_KEYS)).agg(F.first("value")).withColumnsRenamed(ID_KEYS)


def box_univariate(values: DataFrame, key: DataFrame, ids: list[str]) -> DataFrame:
    """One row a subject and session: each id of the key (id, med_var, index) picks one value."""
    picked = values.join(F.broadcast(key.where("index <> 'vector'").select("id", "med_var", F.col("index").cast("int").alias("index"))), ["med_var", "index"])
    wide = picked.groupBy("file", "n_sbj").pivot("id", ids).agg(F.first("value"))
    return wide.withColumns({i: F.col(i).try_cast("double") for i in ids}).join(box_ids(values), ["file", "n_sbj"])


def box_events(values: DataFrame, key: DataFrame, names: DataFrame, ids: list[str]) -> DataFrame:
    """One row an event: the vector variables zipped by position, event ids decoded by `names`."""
    vectors = values.join(F.broadcast(key.where("index = 'vector'").select("id", "med_var")), "med_var")
    wide = vectors.groupBy("file", "n_sbj", F.col("index").alias("event_num")).pivot("id", ids).agg(F.first("value"))
    wide = wide.withColumns({i: F.col(i).try_cast("double") for i in ids}).withColumn("event_id", F.col("event_id").cast("int"))
    return wide.join(F.broadcast(names.select("event_id", "event_id_char")), "event_id", "left")


def serial_rows(texts: DataFrame) -> DataFrame:
    """(file, line, event_id, value) of serial logs with a number, a space and a value a line."""
    lines = texts.select("file", F.posexplode(F.split("text", "[\r\n]+")).alias("line", "s"))
    parts = F.split(F.trim("s"), " +")
    rows = lines.select("file", "line", F.try_element_at(parts, F.lit(1)).try_cast("int").alias("event_id"), F.try_element_at(parts, F.lit(2)).try_cast("double").alias("value"))
    return rows.where("event_id IS NOT NULL")


def serial_tables(rows: DataFrame, key: DataFrame) -> dict[str, DataFrame]:
    """Events (value in milliseconds), parameters and dynamic parameters of serial logs; a dynamic
    parameter has the time of the last event before it."""
    kind = F.when(F.col("id_type") == "parm", "param").otherwise(F.col("id_type"))
    met = rows.join(F.broadcast(key.select("event_id", "event_id_char", kind.alias("id_type"))), "event_id")
    before = Window.partitionBy("file").orderBy("line").rowsBetween(Window.unboundedPreceding, 0)
    met = met.withColumn("_ts", F.last(F.when(F.col("id_type") == "event", F.col("value") / 1000), ignorenulls=True).over(before))
    return {
        "event": met.where("id_type = 'event'").select("file", "event_id_char", (F.col("value") / 1000).alias("event_ts")),
        "param": met.where("id_type = 'param'").select("file", F.col("event_id_char").alias("param"), F.col("value").alias("param_value")),
        "param_dynamic": met.where("id_type = 'param_dynamic'").select("file", F.col("event_id_char").alias("param_dynamic"), F.col("_ts").alias("param_ts"), F.col("value").alias("param_value")),
    }


def tracking_parameters(texts: DataFrame, names: list[str]) -> DataFrame:
    """One row a tracking file, the named header values as columns; files of subject NA are left out."""
    rows = texts.mapInPandas(_tracking_headers, "file string, name string, value string").where(F.col("name").isin([*names, "subject", "video_start_time"]))
    wide = rows.groupBy("file").pivot("name", list(dict.fromkeys([*names, "subject", "video_start_time"]))).agg(F.first("value"))
    start = F.split("video_start_time", " ", 2)
    return wide.where(F.coalesce("subject", F.lit("")) != "NA").withColumn("date", start[0]).withColumn("video_start_time", F.try_element_at(start, F.lit(2)))


def tracking_samples(texts: DataFrame, columns: list[str]) -> DataFrame:
    """(file, the named columns as doubles) of each sample; `-` is null; files with one sample or none
    are left out, as nothing was tracked."""
    schema = "file string, " + ", ".join(f"`{c}` double" for c in columns)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for file, text in zip(b["file"], b["text"], strict=True):
                rows = list(csv.reader(io.StringIO(text or "")))
                at = _header_rows(rows)
                if at is None or len(rows) - at < 2:
                    continue
                names = [clean_name(c) for c in rows[at - 2]]
                out = {"file": [file] * (len(rows) - at)}
                for c in columns:
                    k = names.index(c) if c in names else None
                    out[c] = [_number(r[k]) if k is not None and k < len(r) else None for r in rows[at:]]
                yield pd.DataFrame(out).astype({c: float for c in columns})

    return texts.select("file", "text").mapInPandas(run, schema)


def _header_rows(rows: list[list[str]]) -> int | None:
    """The first row tells how many rows the header has, its last two being names and units."""
    try:
        return int(float(rows[0][1]))
    except (IndexError, ValueError):
        return None


def _number(value: str) -> float | None:
    try:
        return float(value)
    except ValueError:
        return None


def _tracking_headers(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for file, text in zip(b["file"], b["text"], strict=True):
            rows = list(csv.reader(io.StringIO(text or "")))
            at = _header_rows(rows)
            out += [(file, clean_name(r[0]), r[1]) for r in rows[: (at or 2) - 2] if len(r) > 1]
        yield pd.DataFrame(out, columns=["file", "name", "value"], dtype=object)
