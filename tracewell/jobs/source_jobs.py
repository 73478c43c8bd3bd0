"""Queries for sources and sinks. Files and logs are derived from the tables by Spark first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.jobs.registry import query
from tracewell.operators import bins
from tracewell.sources import files, scratch, textlog
from tracewell.sources.adapters import EVENTS_SQL, STREAMS_SQL, events, streams
from tracewell.streaming import incremental


@query("s1_load", f"WITH {STREAMS_SQL} SELECT blockname, channel, raw_au, sample_idx FROM streams")
def s1_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch.folder(spark, 'streams')}.csv"
    streams(spark, sf_dir).select("blockname", F.lit("2024-01-01").alias("start_date"), "channel", "raw_au", "sample_idx").write.option("header", True).csv(path)
    return files.load(spark, path, files.STREAMS).drop("start_date")


@query("s2_combined_import", f"WITH {EVENTS_SQL} SELECT blockname, event_id, event_id_char FROM ev WHERE event_id_char IN ('view', 'click')")
def s2_combined_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch.folder(spark, "kinds")
    e = events(spark, sf_dir).select("blockname", "event_id", "event_id_char")
    kinds = ("view", "click", "error")
    for k, kind in enumerate(kinds):  # one number is kept as text in one of the files
        one = e.where(F.col("event_id_char") == kind)
        (one.withColumn("event_id", F.col("event_id").cast("string")) if k == 1 else one).coalesce(1).write.parquet(f"{path}/{kind}")
    rows = files.read_united(spark, path, starts=["part-"]).withColumn("event_id", F.col("event_id").cast("bigint"))
    return rows.where(F.col("event_id_char").isin("view", "click")).select("blockname", "event_id", "event_id_char")


@query("s3_coerced", "SELECT CAST(s_suppkey AS VARCHAR) AS k, s_acctbal AS v FROM supplier UNION ALL SELECT c_name, CAST(c_nationkey AS DOUBLE) FROM customer")
def s3_coerced(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, c = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("supplier", "customer"))
    return files.united([s.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v")), c.select(F.col("c_name").alias("k"), F.col("c_nationkey").alias("v"))])


@query("s4_combine", f"WITH {EVENTS_SQL} SELECT blockname AS med_file_name, event_id FROM ev WHERE blockname <> 'u7'")
def s4_combine(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select(F.col("blockname").alias("med_file_name"), "event_id").where("med_file_name <> 'u7'")
    path = scratch.folder(spark, "combined")
    files.combine(e.where(F.crc32("med_file_name") % 2 == 0), path)
    return files.combine(e, path)


@query("s5_combine_by_name", f"WITH {EVENTS_SQL} SELECT blockname, event_id FROM ev WHERE contains(blockname, 'u1') OR contains(blockname, '9')")
def s5_combine_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select("blockname", "event_id")
    return files.combine(e.where(files.wanted(F.col("blockname"), holds=["u1", "9"])), scratch.folder(spark, "by-name"), "blockname")


@query("s6_combine_by_log", f"WITH {STREAMS_SQL} SELECT blockname, channel, sample_idx FROM streams WHERE blockname IN (SELECT 'b' || s_suppkey FROM supplier WHERE s_nationkey % 4 = 1 AND s_suppkey % 2 = 0)")
def s6_combine_by_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    log = s.select(F.concat(F.lit("b"), "s_suppkey").alias("blockname"), (F.col("s_nationkey") % 4).alias("experiment"), (F.col("s_suppkey") % 2).alias("procedure"))
    return files.of_log(streams(spark, sf_dir), log, ["experiment", "procedure"], [1, 0]).select("blockname", "channel", "sample_idx")


NAMES_SQL = "i AS (SELECT 'ses' || c_custkey AS s FROM customer), o AS (SELECT DISTINCT 'ses' || o_custkey AS s FROM orders WHERE o_orderstatus = 'P')"


def _names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    c, o = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "orders"))
    inputs = c.select(F.concat(F.lit("ses"), "c_custkey", F.lit("_streams_data.feather")).alias("fn"))
    outputs = o.where("o_orderstatus = 'P'").select(F.concat(F.lit("ses"), "o_custkey", F.lit("_streams_session.feather")).alias("fn"))
    return inputs, outputs


@query("s7_work_list", f"WITH {NAMES_SQL} SELECT s AS stem FROM i EXCEPT SELECT s FROM o")
def s7_work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return files.work_list(*_names(spark, sf_dir), ["_streams_data.feather", "_streams_session.feather"])[0]


@query("s8_session_work_list", f"WITH {NAMES_SQL}, l AS (SELECT DISTINCT 'ses' || o_custkey AS session_name, 'ses' || (o_custkey + 1) AS blockname FROM orders) SELECT DISTINCT session_name FROM l WHERE session_name IN (SELECT s FROM i) AND blockname NOT IN (SELECT s FROM o)")
def s8_session_work_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    log = o.select(F.concat(F.lit("ses"), "o_custkey").alias("session_name"), F.concat(F.lit("ses"), F.col("o_custkey") + 1).alias("blockname")).distinct()
    return files.session_work_list(log, *_names(spark, sf_dir), ["_streams_data.feather", "_streams_session.feather"])


BOX_SQL = """o AS (SELECT 'f' || o_custkey % 40 AS file, o_custkey AS c, list(CAST(floor(o_totalprice) AS BIGINT) ORDER BY o_orderkey) AS v, list(o_orderkey % 3 ORDER BY o_orderkey) AS e FROM orders GROUP BY ALL),
b AS (SELECT *, row_number() OVER (PARTITION BY file ORDER BY c) AS n_sbj FROM o)"""


def box_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logs of an operant box, one file for every forty customers: amounts in C, codes in E."""
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    per = o.groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct("o_orderkey", F.floor("o_totalprice").alias("p")))).alias("r"))

    def rows(values):
        return F.concat_ws("\r\n", F.transform(F.sequence(F.lit(0), F.floor((F.size(values) - 1) / 5).cast("int")), lambda i: F.concat(F.lpad((i * 5).cast("string"), 6, " "), F.lit(":  "), F.concat_ws("     ", F.transform(F.slice(values, i * 5 + 1, 5), lambda v: F.concat(v.cast("string"), F.lit(".000")))))))

    text = F.concat(F.lit("Start Date: 08/18/20\r\nSubject: c"), "o_custkey", F.lit("\r\nExperiment: x\r\nGroup: 0\r\nStart Time:  9:23:01\r\nV:      33.000\r\nC:\r\n"), rows(F.transform("r", lambda x: x["p"])), F.lit("\r\nE:\r\n"), rows(F.transform("r", lambda x: x["o_orderkey"] % 3)), F.lit("\r\n\r\n"))
    subjects = per.select(F.concat(F.lit("f"), F.col("o_custkey") % 40).alias("file"), F.struct("o_custkey", text.alias("t")).alias("s"))
    return subjects.groupBy("file").agg(F.concat(F.lit("File: C:\\x\r\n\r\n"), F.concat_ws("", F.transform(F.sort_array(F.collect_list("s")), lambda x: x["t"]))).alias("text"))


@query("s9_box_values", f"WITH {BOX_SQL} SELECT file, CAST(n_sbj AS INTEGER) AS n_sbj, med_var, i AS index, x AS value FROM (SELECT file, n_sbj, 'C' AS med_var, unnest(range(1, len(v) + 1)) AS i, unnest(v) || '.000' AS x FROM b UNION ALL SELECT file, n_sbj, 'E', unnest(range(1, len(e) + 1)), unnest(e) || '.000' FROM b UNION ALL SELECT file, n_sbj, unnest(['Start Date', 'Subject', 'Experiment', 'Group', 'Start Time', 'V']), 1, unnest(['08/18/20', 'c' || c, 'x', '0', '9:23:01', '33.000']) FROM b)")
def s9_box_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textlog.box_values(box_texts(spark, sf_dir))


def _box_key(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("first", "C", "1"), ("third", "C", "3"), ("volume", "V", "1"), ("event_ts", "C", "vector"), ("event_id", "E", "vector")], "id string, med_var string, index string")


@query("s10_box_univariate", f"WITH {BOX_SQL} SELECT file, CAST(n_sbj AS INTEGER) AS n_sbj, CAST(v[1] AS DOUBLE) AS first, CAST(v[3] AS DOUBLE) AS third, 33.0::DOUBLE AS volume, 'x' AS experiment, '08/18/20' AS start_date, 'c' || c AS subject, '0' AS \"group\" FROM b")
def s10_box_univariate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textlog.box_univariate(textlog.box_values(box_texts(spark, sf_dir)), _box_key(spark), ["first", "third", "volume"])


@query("s11_box_events", f"WITH {BOX_SQL}, u AS (SELECT file, CAST(n_sbj AS INTEGER) AS n_sbj, unnest(range(1, len(v) + 1)) AS event_num, CAST(unnest(v) AS DOUBLE) AS event_ts, CAST(unnest(e) AS INTEGER) AS event_id FROM b) SELECT *, CASE event_id WHEN 0 THEN 'lick' WHEN 1 THEN 'sol' END AS event_id_char FROM u")
def s11_box_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = spark.createDataFrame([(0, "lick"), (1, "sol")], "event_id int, event_id_char string")
    return textlog.box_events(textlog.box_values(box_texts(spark, sf_dir)), _box_key(spark), names, ["event_ts", "event_id"])


@query("s12_tracking_samples", f"WITH {EVENTS_SQL} SELECT blockname AS file, (event_us // 1000) / 1000.0::DOUBLE AS trial_time, CASE WHEN event_id % 4 <> 0 THEN value END AS x_center FROM ev")
def s12_tracking_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textlog.tracking_samples(_tracking(spark, sf_dir), ["trial_time", "x_center"])


def _tracking(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    line = F.concat_ws(",", (F.expr("event_us div 1000") / 1000).cast("decimal(20,3)").cast("string"), F.when(F.col("event_id") % 4 == 0, "-").otherwise(F.col("value").cast("string")), F.lit(""))
    per = e.groupBy("blockname").agg(F.sort_array(F.collect_list(F.struct("event_us", line.alias("l")))).alias("r"))
    head = F.concat(F.lit('"Number of header lines:",7,\n"Subject",s'), "blockname", F.lit(',\n"Day",d01,\n"Video start time",01/02/2024 10:00:00,\n"",,\n"Trial time","X center","R"\n"(s)","(cm)",\n'))
    return per.select(F.col("blockname").alias("file"), F.concat(head, F.concat_ws("\n", F.transform("r", lambda x: x["l"]))).alias("text"))


@query("s12_tracking_parameters", f"WITH {EVENTS_SQL} SELECT DISTINCT blockname AS file, 's' || blockname AS subject, 'd01' AS day, '10:00:00' AS video_start_time, '01/02/2024' AS date FROM ev")
def s12_tracking_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return textlog.tracking_parameters(_tracking(spark, sf_dir), ["subject", "day"])


SERIAL_SQL = f"{EVENTS_SQL}, se AS (SELECT blockname AS file, row_number() OVER (PARTITION BY blockname ORDER BY event_us, event_id) AS line, CASE event_id_char WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'error' THEN 3 WHEN 'signup' THEN 4 ELSE 5 END AS id, event_id AS v FROM ev)"


def _serial(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    kind = F.col("event_id_char")
    code = F.when(kind == "view", 1).when(kind == "click", 2).when(kind == "error", 3).when(kind == "signup", 4).otherwise(5)
    e = events(spark, sf_dir).select("blockname", F.struct("event_us", "event_id", F.concat_ws(" ", code, "event_id").alias("l")).alias("s"))
    texts = e.groupBy(F.col("blockname").alias("file")).agg(F.concat_ws("\r\r\n", F.transform(F.sort_array(F.collect_list("s")), lambda x: x["l"])).alias("text"))
    key = spark.createDataFrame([(1, "lick", "event"), (2, "sol", "event"), (3, "p1", "parm"), (4, "trial_x", "param_dynamic")], "event_id int, event_id_char string, id_type string")
    return textlog.serial_tables(textlog.serial_rows(texts), key)


@query("s13_serial_events", f"WITH {SERIAL_SQL} SELECT file, CASE id WHEN 1 THEN 'lick' ELSE 'sol' END AS event_id_char, v / 1000.0::DOUBLE AS event_ts FROM se WHERE id IN (1, 2)")
def s13_serial_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _serial(spark, sf_dir)["event"]


@query("s13_serial_params", f"WITH {SERIAL_SQL} SELECT file, 'p1' AS param, CAST(v AS DOUBLE) AS param_value FROM se WHERE id = 3")
def s13_serial_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _serial(spark, sf_dir)["param"]


@query("s13_serial_dynamic", f"WITH {SERIAL_SQL}, f AS (SELECT *, last_value(CASE WHEN id IN (1, 2) THEN v / 1000.0::DOUBLE END IGNORE NULLS) OVER (PARTITION BY file ORDER BY line ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS ts FROM se WHERE id < 5) SELECT file, 'trial_x' AS param_dynamic, ts AS param_ts, CAST(v AS DOUBLE) AS param_value FROM f WHERE id = 4")
def s13_serial_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _serial(spark, sf_dir)["param_dynamic"]


@query("s14_write_sessions", f"WITH {EVENTS_SQL} SELECT blockname, event_id, event_us FROM ev")
def s14_write_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select("blockname", "event_id", "event_us")
    path = scratch.folder(spark, "sessions")
    files.write_sessions(e.where("length(blockname) < 4").repartition("blockname"), path)
    files.write_sessions(e.repartition("blockname"), path, overwrite=False)
    return files.read_sessions(spark, path).select("blockname", "event_id", "event_us")


@query("r1_incremental", f"WITH {EVENTS_SQL} SELECT blockname, CAST(ceil(event_us / 21600000000.0::DOUBLE) AS BIGINT) * 21600000000 AS event_us, round(avg(round(value * 100)), 6) AS value FROM ev WHERE event_us > 0 GROUP BY ALL")
def r1_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs over a growing folder: the second sees the new files only."""
    e = events(spark, sf_dir).select("blockname", "event_us", F.round(F.col("value") * 100).alias("value"))
    source, target, seen = (scratch.folder(spark, k) for k in ("arrivals", "processed", "seen"))
    process = lambda rows: bins.resample(rows, ["blockname"], "event_us", "value", 21_600_000_000)
    for part in (0, 1):
        e.where(F.crc32("blockname") % 2 == part).write.mode("append").parquet(source)
        incremental.process_new_files(spark, source, e.schema, process, target, seen)
    return files.read_sessions(spark, target).select("blockname", "event_us", F.round("value", 6).alias("value"))
