"""Queries for the summaries, over orders, customers, streams and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.jobs.registry import query
from tracewell.jobs.stats_jobs import TRIALS_SQL, trials
from tracewell.operators import summaries
from tracewell.operators.signal import fiber_id
from tracewell.sources.adapters import EVENTS_SQL, STREAMS_SQL, events, streams

HOUR = 3_600_000_000


@query("a13_channel_config", f"WITH {STREAMS_SQL}, n AS (SELECT blockname, count(DISTINCT CASE WHEN channel LIKE '%C' THEN '2' ELSE '1' END) AS f, count(DISTINCT substr(channel, 2, 3)) AS s FROM streams WHERE channel NOT LIKE '%560%' GROUP BY 1) SELECT blockname, (['one', 'two'])[f] || '_fiber_' || (['one', 'two'])[s] || '_signal' AS channel_config FROM n")
def a13_channel_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = streams(spark, sf_dir).where("channel NOT LIKE '%560%'").withColumns({"fiber_id": fiber_id(), "signal_wavelength": F.substring("channel", 2, 3)})
    return summaries.channel_config(s)


@query("a14_session_contents", f"WITH {EVENTS_SQL} SELECT blockname AS session_name, event_id_char AS blockname, string_agg(DISTINCT CAST(event_id % 7 AS VARCHAR), ';' ORDER BY CAST(event_id % 7 AS VARCHAR)) AS branches, min(event_us) AS start, max(event_us) AS \"end\" FROM ev GROUP BY ALL")
def a14_session_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select(F.col("blockname").alias("session_name"), F.col("event_id_char").alias("blockname"), (F.col("event_id") % 7).alias("branch_id"), F.col("event_us").alias("ts_comp"))
    return summaries.session_contents(e)


@query("a15_files_per_subject", "SELECT o_custkey AS subject, o_orderpriority AS procedure, count(DISTINCT o_orderkey) AS n_files FROM orders GROUP BY ALL")
def a15_files_per_subject(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_custkey").alias("subject"), F.col("o_orderpriority").alias("procedure"), F.col("o_orderkey").alias("blockname"))
    return summaries.files_per_subject(o)


@query("a15_most_days", "SELECT max(n) AS max_days FROM (SELECT count(DISTINCT o_orderdate) AS n FROM orders GROUP BY o_custkey)")
def a15_most_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.most_days(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_custkey", "o_orderdate")


@query("a16_lick_summary", f"WITH {TRIALS_SQL}, d AS (SELECT DISTINCT subject, pri, k, CAST(price AS BIGINT) % 5 AS licks FROM tr) SELECT subject, pri, round(avg(licks), 9) AS mean_count, round(avg(CASE WHEN licks > 0 THEN 1.0::DOUBLE ELSE 0 END), 9) AS share_any FROM d GROUP BY ALL")
def a16_lick_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trials(spark, sf_dir).withColumn("licks", F.col("price").cast("long") % 5)
    return summaries.lick_summary(t, ["subject", "pri"], ["k"], "licks").withColumns({c: F.round(c, 9) for c in ("mean_count", "share_any")})


@query("a17_trial_bins", f"WITH {TRIALS_SQL}, b AS (SELECT grp, price, k % 100 AS t FROM tr) SELECT grp, CASE WHEN t <= 20 THEN 0 WHEN t <= 50 THEN 20 ELSE 50 END + 10.0::DOUBLE AS trial_bin, round(avg(price), 6) AS price FROM b WHERE t > 0 AND t <= 90 GROUP BY ALL")
def a17_trial_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trials(spark, sf_dir).withColumn("t", F.col("k") % 100)
    return summaries.trial_bins(t, ["grp"], "t", [0, 20, 50, 90], "price").withColumn("price", F.round("price", 6))


@query("a18_trial_bins_over_subjects", f"WITH {TRIALS_SQL}, b AS (SELECT grp, subject, CASE WHEN k % 100 <= 20 THEN 0 WHEN k % 100 <= 50 THEN 20 ELSE 50 END + 10.0::DOUBLE AS trial_bin, avg(price) AS price FROM tr WHERE k % 100 > 0 AND k % 100 <= 90 GROUP BY ALL) SELECT grp, trial_bin, round(avg(price), 5) AS mean, round(stddev_samp(price) / sqrt(count(*)), 5) AS se, count(*) AS n FROM b GROUP BY ALL")
def a18_trial_bins_over_subjects(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trials(spark, sf_dir).withColumn("t", F.col("k") % 100)
    per = summaries.trial_bins(t, ["grp", "subject"], "t", [0, 20, 50, 90], "price")
    return summaries.mean_se_over_subjects(per, ["grp", "trial_bin"], "subject", "price").withColumns({c: F.round(c, 5) for c in ("mean", "se")})


@query("a19_mean_se", f"WITH {TRIALS_SQL} SELECT grp, pri, round(avg(price), 6) AS mean, round(stddev_samp(price) / sqrt(count(price)), 6) AS se, count(price) AS n FROM tr GROUP BY ALL")
def a19_mean_se(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.mean_se(trials(spark, sf_dir), ["grp", "pri"], "price").withColumns({c: F.round(c, 6) for c in ("mean", "se")})


@query("a20_window_means", f"WITH {TRIALS_SQL} SELECT subject, round(avg(price), 6) AS price FROM tr WHERE k % 50 > 0 AND k % 50 < 30 AND grp <> 'BUILDING' GROUP BY 1")
def a20_window_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trials(spark, sf_dir).where("grp <> 'BUILDING'").withColumn("rel", F.col("k") % 50)
    return summaries.window_means(t, ["subject"], "rel", 0, 30, "price").withColumn("price", F.round("price", 6))


@query("a21_last_days", f"WITH {TRIALS_SQL}, d AS (SELECT subject, price, k % 20 AS day FROM tr) SELECT subject, round(avg(price), 6) AS price FROM (SELECT * FROM d QUALIFY day > max(day) OVER (PARTITION BY subject) - 5) GROUP BY 1")
def a21_last_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = trials(spark, sf_dir).withColumn("day", F.col("k") % 20)
    return summaries.last_days(t, "subject", "day", 5, "price").withColumn("price", F.round("price", 6))


@query("a22_active_bias", f"WITH {EVENTS_SQL}, c AS (SELECT blockname, coalesce(sum(CASE WHEN event_id_char = 'view' THEN 1 END), 0) AS a, coalesce(sum(CASE WHEN event_id_char = 'click' THEN 1 END), 0) AS i FROM ev GROUP BY 1) SELECT blockname, round(a / nullif(CAST(a + i AS DOUBLE), 0), 9) AS bias FROM c")
def a22_active_bias(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("n", F.lit(1))
    return summaries.active_bias(e, ["blockname"], "event_id_char", "n", "view", "click").withColumn("bias", F.round("bias", 9))


@query("a23_present", f"WITH {EVENTS_SQL} SELECT *, row_number() OVER (PARTITION BY blockname ORDER BY event_id_char) AS n FROM (SELECT DISTINCT blockname, event_id_char FROM ev)")
def a23_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    return summaries.present(events(spark, sf_dir), "blockname", "event_id_char")


@query("a24_first_of_trials", f"WITH {EVENTS_SQL}, t AS (SELECT *, event_us // {24 * HOUR} AS trial FROM ev), f AS (SELECT * FROM t QUALIFY event_us = min(event_us) OVER (PARTITION BY blockname, trial)) SELECT blockname, event_id_char, round(avg(round(value * 100)), 6) AS value FROM f GROUP BY ALL")
def a24_first_of_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = events(spark, sf_dir).withColumns({"trial": F.expr(f"event_us div {24 * HOUR}"), "value": F.round(F.col("value") * 100)})
    first = summaries.first_of_trials(t, ["blockname", "trial"], "event_us")
    return first.groupBy("blockname", "event_id_char").agg(F.round(F.avg("value"), 6).alias("value"))
