"""The whole chain of operant-box logs: parse, tidy, combine, number the days, compare.

A log file is the orders of one date by six customers: a subject's scalar is the sum of its order
prices, its vector the prices in order of key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.jobs.registry import query
from tracewell.operators import shape, stats
from tracewell.sources import files, scratch, textlog

DAYS_SQL = """b AS (SELECT o_orderdate AS d, 'm' || o_custkey % 60 AS subject, floor(o_totalprice) AS p, o_orderkey AS k FROM orders),
s AS (SELECT d, subject, sum(p) AS total, arg_min(p, k) AS first FROM b GROUP BY ALL), n AS (SELECT *, row_number() OVER (PARTITION BY subject ORDER BY d) AS day FROM s)"""


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.date_format("o_orderdate", "yyyy_MM_dd").alias("d"), F.concat(F.lit("m"), F.col("o_custkey") % 60).alias("subject"), F.floor("o_totalprice").alias("p"), F.col("o_orderkey").alias("k"))
    prices = F.transform(F.sort_array(F.collect_list(F.struct("k", "p"))), lambda r: r["p"])
    one = o.groupBy("d", "subject").agg(F.sum("p").alias("total"), prices.alias("v"))
    body = F.concat(F.lit("Start Date: "), F.col("d"), F.lit("\r\nSubject: "), F.col("subject"), F.lit("\r\nV:   "), F.col("total").cast("string"), F.lit(".000\r\nC:\r\n     0:    "), F.array_join(F.transform("v", lambda x: F.concat(x.cast("string"), F.lit(".000"))), "   "), F.lit("\r\n"))
    return one.select("d", "subject", body.alias("t")).groupBy("d").agg(F.concat(F.lit("File: box\r\n"), F.array_join(F.sort_array(F.collect_list("t")), "\r\n")).alias("text")).withColumnRenamed("d", "file")


def _days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a subject and day, combined in two runs of which the second adds only new files."""
    key = spark.createDataFrame([("total", "V", "1"), ("first", "C", "1")], "id string, med_var string, index string")
    texts, path = _texts(spark, sf_dir), scratch.folder(spark, "operant")

    def tidy(some: DataFrame) -> DataFrame:
        return textlog.box_univariate(textlog.box_values(some), key, ["total", "first"]).withColumnRenamed("file", "med_file_name")

    files.combine(tidy(texts.where(F.col("file") < "1995")), path)
    return shape.day_from_dates(files.combine(tidy(texts), path), "start_date")


@query("r4_operant_days", f"WITH {DAYS_SQL} SELECT subject, strftime(d, '%Y_%m_%d') AS start_date, day, CAST(total AS DOUBLE) AS total, CAST(first AS DOUBLE) AS first FROM n")
def r4_operant_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _days(spark, sf_dir).select("subject", "start_date", F.col("day").cast("long").alias("day"), "total", "first")


@query("r4_operant_change", f"WITH {DAYS_SQL}, p AS (SELECT subject, max(total) FILTER (day = 1) AS a, max(total) FILTER (day = 2) AS z FROM n GROUP BY 1) SELECT round(avg(z - a), 6) AS estimate, count(z - a) AS n, round(avg(z - a) / (stddev_samp(z - a) / sqrt(count(z - a))), 6) AS statistic, CAST(count(z - a) - 1 AS DOUBLE) AS parameter FROM p")
def r4_operant_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paired test of the second day against the first."""
    wide = _days(spark, sf_dir).where("day <= 2").groupBy("subject").pivot("day", [1, 2]).agg(F.max("total"))
    out = stats.t_paired(wide.select(F.col("2").alias("z"), F.col("1").alias("a")), [], "z", "a")
    return out.select(F.round("estimate", 6).alias("estimate"), "n", F.round("statistic", 6).alias("statistic"), "parameter")
