"""Views of the benchmark tables in the shapes that the operators take.

Streams: one row a sample of a channel of a session. A session (`blockname`) is a supplier, a channel
a pair of return flag and line status; the sample's number follows all columns, as line items have
no unique key. Amplitudes are whole numbers, so sums don't depend on their order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

FS = 10.0
STREAM_ORDER = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity", "l_discount", "l_tax"]

STREAMS_SQL = f"""streams AS (
  SELECT 'b' || l_suppkey AS blockname,
         '_' || CASE l_returnflag WHEN 'A' THEN '405' WHEN 'R' THEN '465' ELSE '560' END || CASE l_linestatus WHEN 'F' THEN 'A' ELSE 'C' END AS channel,
         CAST(floor(l_extendedprice) AS DOUBLE) AS raw_au,
         row_number() OVER (PARTITION BY l_suppkey, l_returnflag, l_linestatus ORDER BY {', '.join(STREAM_ORDER)}) - 1 AS sample_idx
  FROM lineitem)"""

EVENTS_SQL = """ev AS (
  SELECT 'u' || user_id AS blockname, event_type AS event_id_char, epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01') AS event_us, event_id, value
  FROM events)"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """blockname, channel, raw_au, sample_idx (from 0 in each channel)."""
    flag = F.when(F.col("l_returnflag") == "A", "405").when(F.col("l_returnflag") == "R", "465").otherwise("560")
    letter = F.when(F.col("l_linestatus") == "F", "A").otherwise("C")
    order = Window.partitionBy("l_suppkey", "l_returnflag", "l_linestatus").orderBy(*STREAM_ORDER)
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("b"), F.col("l_suppkey")).alias("blockname"),
        F.concat(F.lit("_"), flag, letter).alias("channel"),
        F.floor("l_extendedprice").cast("double").alias("raw_au"),
        (F.row_number().over(order) - 1).cast("long").alias("sample_idx"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """blockname, event_id_char, event_us (microseconds since 2024), event_id, value."""
    us = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', CAST(ts AS TIMESTAMP_NTZ))")
    return table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id")).alias("blockname"), F.col("event_type").alias("event_id_char"), us.alias("event_us"), "event_id", "value")
