"""Queries for selections, reshapes, lookups, set operations and colours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.jobs.registry import query
from tracewell.operators import shape
from tracewell.operators.events import numbered
from tracewell.operators.signal import fiber_id
from tracewell.sources.adapters import EVENTS_SQL, STREAMS_SQL, events, streams

LOG_SQL = """log AS (SELECT 'b' || s_suppkey AS blockname, s_suppkey AS k, CASE WHEN s_suppkey % 3 = 0 THEN 0 ELSE 1 END AS include, 'exp' || s_nationkey % 4 AS experiment,
  CASE WHEN s_suppkey % 2 = 0 THEN 'fib' || s_suppkey END AS fiber_id01, CASE WHEN s_suppkey % 5 = 0 OR s_suppkey % 2 = 1 THEN 'fib' || (s_suppkey + 1) END AS fiber_id02,
  CASE WHEN s_suppkey % 4 = 0 THEN 'multi' || s_suppkey END AS blockname_multi_subject, '465' AS signal_id01, CASE WHEN s_suppkey % 2 = 0 THEN '560' END AS signal_id02, '405' AS control_id FROM supplier)"""


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet")
    k = F.col("s_suppkey")
    return s.select(
        F.concat(F.lit("b"), k).alias("blockname"), k.alias("k"), F.when(k % 3 == 0, 0).otherwise(1).alias("include"), F.concat(F.lit("exp"), F.col("s_nationkey") % 4).alias("experiment"),
        F.when(k % 2 == 0, F.concat(F.lit("fib"), k)).alias("fiber_id01"), F.when((k % 5 == 0) | (k % 2 == 1), F.concat(F.lit("fib"), k + 1)).alias("fiber_id02"),
        F.when(k % 4 == 0, F.concat(F.lit("multi"), k)).alias("blockname_multi_subject"), F.lit("465").alias("signal_id01"), F.when(k % 2 == 0, "560").alias("signal_id02"), F.lit("405").alias("control_id"),
    )


@query("p1_select_sessions", f"WITH {STREAMS_SQL}, {LOG_SQL} SELECT * FROM streams WHERE blockname IN (SELECT blockname FROM log WHERE include = 1 AND experiment IN ('exp1', 'exp2'))")
def p1_select_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.select_sessions(streams(spark, sf_dir), log(spark, sf_dir), experiments=["exp1", "exp2"])


@query("p2_session_signals", f"WITH {LOG_SQL} SELECT blockname, control_id, 'signal_id01' AS signal, signal_id01 AS signal_id FROM log UNION ALL SELECT blockname, control_id, 'signal_id02', signal_id02 FROM log WHERE signal_id02 IS NOT NULL")
def p2_session_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.session_signals(log(spark, sf_dir))


@query("p3_fiber_id", f"WITH {STREAMS_SQL} SELECT blockname, channel, CASE WHEN regexp_matches(channel, '[CD]') THEN '2' WHEN regexp_matches(channel, '[AB]') THEN '1' END AS fiber_id, count(*) AS n FROM streams GROUP BY ALL")
def p3_fiber_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams(spark, sf_dir).withColumn("fiber_id", fiber_id()).groupBy("blockname", "channel", "fiber_id").agg(F.count("*").alias("n"))


@query("p4_bank_filter", f"WITH {STREAMS_SQL}, {LOG_SQL} SELECT s.* FROM streams s JOIN log l USING (blockname) WHERE (l.fiber_id01 IS NOT NULL AND s.channel LIKE '%A') OR (l.fiber_id02 IS NOT NULL AND s.channel LIKE '%C')")
def p4_bank_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.bank_filter(streams(spark, sf_dir), log(spark, sf_dir))


@query("p4_bank_faults", f"WITH {LOG_SQL} SELECT blockname, (fiber_id01 IS NOT NULL)::INT + (fiber_id02 IS NOT NULL)::INT AS banks FROM log WHERE blockname_multi_subject IS NOT NULL AND (fiber_id01 IS NOT NULL)::INT + (fiber_id02 IS NOT NULL)::INT <> 1")
def p4_bank_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.bank_faults(log(spark, sf_dir))


@query("p5_multi_subject_name", f"WITH {LOG_SQL} SELECT k, coalesce(blockname_multi_subject, blockname) AS blockname FROM log")
def p5_multi_subject_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log(spark, sf_dir).select("k", shape.multi_subject_name().alias("blockname"))


@query("p6_without", f"WITH {EVENTS_SQL} SELECT blockname AS subject, event_id_char AS channel_id, event_id FROM ev WHERE blockname NOT IN ('u1', 'u3') AND NOT (blockname = 'u5' AND event_id_char = 'view')")
def p6_without(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select(F.col("blockname").alias("subject"), F.col("event_id_char").alias("channel_id"), "event_id")
    return shape.without(e, ["u1", "u3"], spark.createDataFrame([("u5", "view")], "subject string, channel_id string"))


@query("p7_lookup", "SELECT event_id, CASE event_type WHEN 'view' THEN '405A' WHEN 'click' THEN '465A' ELSE event_type END AS channel FROM events")
def p7_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", shape.looked_up("event_type", {"view": "405A", "click": "465A"}).alias("channel"))


@query("p8_stream_channels", f"WITH {STREAMS_SQL} SELECT blockname, channel AS name, count(*) AS n FROM (SELECT blockname, sample_idx, CASE WHEN sample_idx % 4 = 0 THEN channel WHEN sample_idx % 4 = 1 THEN 'Fi1r' ELSE 'x' END AS channel FROM streams) WHERE channel LIKE '\\_%' ESCAPE '\\' OR channel = 'Fi1r' GROUP BY ALL")
def p8_stream_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("sample_idx") % 4
    s = streams(spark, sf_dir).select("blockname", F.when(k == 0, F.col("channel")).when(k == 1, "Fi1r").otherwise("x").alias("name"))
    return shape.stream_channels(s, ["Fi1r"]).groupBy("blockname", "name").agg(F.count("*").alias("n"))


@query("p11_traces", f"WITH {STREAMS_SQL}, t AS (SELECT blockname, channel, CAST(sample_idx AS DOUBLE) AS time, raw_au AS signal, raw_au * 2 AS control FROM streams WHERE sample_idx BETWEEN 2 AND 9) SELECT blockname, channel, time, 'signal' AS measure, signal AS value FROM t UNION ALL SELECT blockname, channel, time, 'control', control FROM t")
def p11_traces(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = streams(spark, sf_dir).select("blockname", "channel", F.col("sample_idx").cast("double").alias("time"), F.col("raw_au").alias("signal"), (F.col("raw_au") * 2).alias("control"))
    return shape.traces(s, ["blockname", "channel"], ["signal", "control"], 2, 9)


@query("p12_unique_values", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def p12_unique_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.unique_values(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), ["l_returnflag", "l_linestatus", "l_suppkey"])


@query("p13_day_number", "SELECT o_orderkey, o_custkey AS subject, o_orderkey % 60 + 1 - min(o_orderkey % 60 + 1) OVER (PARTITION BY o_custkey) + 1 AS day FROM orders")
def p13_day_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("subject"), F.format_string("d%02d", F.col("o_orderkey") % 60 + 1).alias("day"))
    return shape.day_number(o)


@query("p14_trim", f"WITH {STREAMS_SQL} SELECT blockname, channel, sample_idx FROM streams WHERE (sample_idx + 1) / 10.0::DOUBLE > 2")
def p14_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams(spark, sf_dir).where((F.col("sample_idx") + 1) / 10.0 > 2).select("blockname", "channel", "sample_idx")


@query("w15_day_from_dates", "SELECT o_orderkey, d.day FROM orders o JOIN (SELECT o_custkey, dt, row_number() OVER (PARTITION BY o_custkey ORDER BY dt) AS day FROM (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS dt FROM orders)) d ON d.o_custkey = o.o_custkey AND d.dt = CAST(o.o_orderdate AS DATE)")
def w15_day_from_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("subject"), F.to_date("o_orderdate").alias("date"))
    return shape.day_from_dates(o).select("o_orderkey", "day")


@query("k1_first_rows", f"WITH {STREAMS_SQL} SELECT * FROM streams WHERE sample_idx < 20")
def k1_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.first_rows(streams(spark, sf_dir), ["blockname", "channel"], ["sample_idx"], 20)


@query("k2_last_rows", f"WITH {STREAMS_SQL} SELECT * FROM streams QUALIFY row_number() OVER (PARTITION BY blockname, channel ORDER BY sample_idx DESC) <= 7")
def k2_last_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.last_rows(streams(spark, sf_dir), ["blockname", "channel"], ["sample_idx"], 7)


@query("k3_sorted_numbering", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS n FROM orders")
def k3_sorted_numbering(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return numbered(o, ["o_custkey"], ["o_orderdate", "o_orderkey"], "n").select("o_orderkey", "n")


@query("k4_sample_rows", "SELECT * FROM events WHERE CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) % 10000 < 1000")
def k4_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.sample_rows(spark.read.parquet(f"{sf_dir}/events.parquet"), ["event_id"], 0.1)


@query("u1_united", "SELECT s_suppkey AS k, s_name AS name, CAST(NULL AS VARCHAR) AS segment FROM supplier UNION ALL SELECT c_custkey, NULL, c_mktsegment FROM customer")
def u1_united(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, c = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("supplier", "customer"))
    return shape.united([s.select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("name")), c.select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("segment"))])


@query("u2_difference", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def u2_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "orders"))
    return shape.difference(c.select(F.col("c_custkey").alias("k")), o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")), ["k"])


@query("u3_distinct", "SELECT DISTINCT o_custkey, o_orderpriority FROM orders")
def u3_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shape.unique_values(spark.read.parquet(f"{sf_dir}/orders.parquet"), ["o_custkey", "o_orderpriority"])


@query("u4_intersection", "SELECT c_custkey AS k FROM customer INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def u4_intersection(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, o = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("customer", "orders"))
    return shape.intersection(c.select(F.col("c_custkey").alias("k")), o.where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("k")), ["k"])


@query("j11_fiber_site", f"WITH {STREAMS_SQL}, {LOG_SQL} SELECT s.blockname, s.channel, CASE WHEN s.channel LIKE '%C' THEN l.fiber_id02 ELSE l.fiber_id01 END AS channel_id, count(*) AS n FROM streams s JOIN log l USING (blockname) GROUP BY ALL")
def j11_fiber_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = streams(spark, sf_dir).withColumn("fiber_id", fiber_id())
    return shape.fiber_site(s, log(spark, sf_dir)).groupBy("blockname", "channel", "channel_id").agg(F.count("*").alias("n"))


COLOUR_SQL = """w AS (SELECT DISTINCT 370 + l_quantity * 8 AS w FROM lineitem), a AS (SELECT w, 0.3 + 0.7 * (w - 380) / 60 AS v, 0.3 + 0.7 * (750 - w) / 105 AS r FROM w),
c AS (SELECT w, CASE WHEN w < 380 OR w > 750 THEN 0 WHEN w <= 440 THEN power((440 - w) / 60 * v, 0.8) WHEN w <= 510 THEN 0 WHEN w <= 580 THEN power((w - 510) / 70, 0.8) WHEN w <= 645 THEN 1 ELSE power(r, 0.8) END AS red,
 CASE WHEN w < 380 OR w > 750 OR w <= 440 THEN 0 WHEN w <= 490 THEN power((w - 440) / 50, 0.8) WHEN w <= 580 THEN 1 WHEN w <= 645 THEN power((645 - w) / 65, 0.8) ELSE 0 END AS green,
 CASE WHEN w < 380 OR w > 750 THEN 0 WHEN w <= 440 THEN power(v, 0.8) WHEN w <= 490 THEN 1 WHEN w <= 510 THEN power((510 - w) / 20, 0.8) ELSE 0 END AS blue FROM a)"""


@query("c1_wavelength_colour", f"WITH {COLOUR_SQL} SELECT w AS wavelength, '#' || printf('%02X%02X%02X', CAST(floor(red * 255) AS INTEGER), CAST(floor(green * 255) AS INTEGER), CAST(floor(blue * 255) AS INTEGER)) AS colour FROM c")
def c1_wavelength_colour(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select((370 + F.col("l_quantity") * 8).alias("wavelength")).distinct()
    return w.withColumn("colour", shape.wavelength_colour(F.col("wavelength")))
