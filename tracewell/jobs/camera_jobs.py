"""Queries for camera systems. A session is a supplier; a frame is a line item."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tracewell.jobs.orthogonal import fit_sql
from tracewell.jobs.registry import query
from tracewell.operators import camera
from tracewell.sources.adapters import STREAM_ORDER
from tracewell.sources.scratch import saved

FRAMES_SQL = f"""fr AS (SELECT 's' || l_suppkey AS session_name, row_number() OVER (PARTITION BY l_suppkey ORDER BY {', '.join(STREAM_ORDER)}) AS frame_counter, floor(l_extendedprice) AS region0r, floor(l_extendedprice) + l_quantity AS region1g, floor(l_extendedprice) * 2 AS region2r FROM lineitem),
frames AS (SELECT *, frame_counter * 25.0::DOUBLE AS timestamp, CAST(frame_counter % 3 + 1 AS INTEGER) AS led_state, CAST(frame_counter // 10 % 2 AS INTEGER) AS input0 FROM fr),
clock AS (SELECT session_name, frame_counter, timestamp + 1000 AS ts_comp FROM frames WHERE frame_counter % 50 <> 7),
log AS (SELECT 's' || s_suppkey AS session_name, 'b' || s_suppkey || '_' || b AS blockname, CAST(b AS INTEGER) AS branch_id, CAST(b AS INTEGER) AS clock_pin, 1.0::DOUBLE AS tm_baseline, 2.0::DOUBLE AS tm_post, 1.0::DOUBLE AS tm_trim_start, 3.0::DOUBLE AS tm_trim_end FROM supplier CROSS JOIN (SELECT unnest([1, 2]) AS b))"""


def frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = F.row_number().over(Window.partitionBy("l_suppkey").orderBy(*STREAM_ORDER))
    price = F.floor("l_extendedprice").cast("double")
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(F.concat(F.lit("s"), "l_suppkey").alias("session_name"), n.cast("long").alias("frame_counter"), price.alias("region0r"), (price + F.col("l_quantity")).alias("region1g"), (price * 2).alias("region2r"))
    k = F.col("frame_counter")
    return rows.withColumns({"timestamp": k * 25.0, "led_state": (k % 3 + 1).cast("int"), "input0": (F.floor(k / 10) % 2).cast("int")})


def clock(f: DataFrame) -> DataFrame:
    return f.where("frame_counter % 50 <> 7").select("session_name", "frame_counter", (F.col("timestamp") + 1000).alias("ts_comp"))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = spark.read.parquet(f"{sf_dir}/supplier.parquet").select("s_suppkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("b"))
    return s.select(F.concat(F.lit("s"), "s_suppkey").alias("session_name"), F.concat(F.lit("b"), "s_suppkey", F.lit("_"), "b").alias("blockname"), F.col("b").alias("branch_id"), F.col("b").alias("clock_pin"), *[F.lit(v).alias(k) for k, v in (("tm_baseline", 1.0), ("tm_post", 2.0), ("tm_trim_start", 1.0), ("tm_trim_end", 3.0))])


@query("p9_region_rows", f"WITH {FRAMES_SQL} SELECT session_name, frame_counter, 0 AS roi, 'r' AS channel_color, region0r AS raw_au FROM frames UNION ALL SELECT session_name, frame_counter, 1, 'g', region1g FROM frames UNION ALL SELECT session_name, frame_counter, 2, 'r', region2r FROM frames")
def p9_region_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return camera.region_rows(frames(spark, sf_dir), ["session_name", "frame_counter"])


def channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = log(spark, sf_dir).select("session_name", "blockname", "branch_id", F.lit("560;465;405").alias("channel_wavelength"), F.lit("1;2;3").alias("led_state"), F.lit("r;g;g").alias("channel_color"))
    return camera.log_channels(packed, ["channel_wavelength", "led_state", "channel_color"], ["session_name", "blockname", "branch_id"])


CHANNELS_SQL = "channels AS (SELECT session_name, blockname, branch_id, 'ch0' || i AS channel_number, ['560', '465', '405'][i] AS channel_wavelength, CAST(i AS INTEGER) AS led_state, ['r', 'g', 'g'][i] AS channel_color, CAST(CASE WHEN i = 1 THEN (branch_id - 1) * 2 ELSE branch_id * 2 - 1 END AS INTEGER) AS roi FROM log CROSS JOIN (SELECT unnest([1, 2, 3]) AS i))"


@query("p10_log_channels", f"WITH {FRAMES_SQL}, {CHANNELS_SQL} SELECT * FROM channels")
def p10_log_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return channels(spark, sf_dir)


LONG_SQL = f"""{FRAMES_SQL}, {CHANNELS_SQL}, timed AS (SELECT f.*, c.ts_comp FROM frames f LEFT JOIN clock c USING (session_name, frame_counter)),
regions AS (SELECT session_name, frame_counter, led_state, ts_comp, 0 AS roi, 'r' AS channel_color, region0r AS raw_au FROM timed UNION ALL SELECT session_name, frame_counter, led_state, ts_comp, 1, 'g', region1g FROM timed UNION ALL SELECT session_name, frame_counter, led_state, ts_comp, 2, 'r', region2r FROM timed),
long AS (SELECT * FROM regions JOIN channels USING (session_name, led_state, roi, channel_color))"""


def long(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = saved(frames(spark, sf_dir), "frames")
    rows = camera.region_rows(camera.with_clock(f, clock(f)), ["session_name", "frame_counter", "led_state", "ts_comp"])
    return camera.of_channels(rows, channels(spark, sf_dir))


@query("j12_frames_of_channels", f"WITH {LONG_SQL} SELECT * FROM long")
def j12_frames_of_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(spark, sf_dir)


@query("j13_clip_by_clock", f"WITH {LONG_SQL}, ticks AS (SELECT session_name, CAST(frame_counter % 2 + 1 AS INTEGER) AS clock_pin, ts_comp FROM clock WHERE frame_counter % 40 IN (20, 21)), sp AS (SELECT l.session_name, l.blockname, min(ts_comp) - 1000.0 AS a, max(ts_comp) + 2000.0 AS z FROM ticks t JOIN log l ON l.session_name = t.session_name AND l.clock_pin = t.clock_pin GROUP BY ALL) SELECT long.session_name, long.blockname, frame_counter, roi FROM long JOIN sp USING (session_name, blockname) WHERE ts_comp > a AND ts_comp < z")
def j13_clip_by_clock(spark: SparkSession, sf_dir: str) -> DataFrame:
    return camera.clip_by_clock(long(spark, sf_dir), _ticks(spark, sf_dir), log(spark, sf_dir)).select("session_name", "blockname", "frame_counter", "roi")


def _ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    serial = clock(frames(spark, sf_dir)).where("frame_counter % 40 IN (20, 21)").select("session_name", (F.col("frame_counter") % 2 + 1).cast("int").alias("clock_pin"), "ts_comp")
    return camera.clock_ticks(serial, log(spark, sf_dir))


@query("j13_clip_by_trim", f"WITH {LONG_SQL}, sp AS (SELECT session_name, blockname, min(ts_comp) + 1000.0 AS a, max(ts_comp) - 3000.0 AS z FROM long GROUP BY ALL) SELECT session_name, blockname, frame_counter, roi FROM long JOIN sp USING (session_name, blockname) WHERE ts_comp > a AND ts_comp < z")
def j13_clip_by_trim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return camera.clip_by_trim(long(spark, sf_dir), log(spark, sf_dir)).select("session_name", "blockname", "frame_counter", "roi")


@query("w16_clock_ticks", f"WITH {FRAMES_SQL}, s AS (SELECT DISTINCT session_name, CAST(frame_counter % 2 + 1 AS INTEGER) AS clock_pin, ts_comp FROM clock WHERE frame_counter % 40 IN (20, 21)), n AS (SELECT *, row_number() OVER (PARTITION BY session_name, clock_pin ORDER BY ts_comp) AS tick_number FROM s) SELECT n.*, l.blockname FROM n JOIN log l USING (session_name, clock_pin)")
def w16_clock_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _ticks(spark, sf_dir)


@query("j14_stamps", f"WITH {FRAMES_SQL} SELECT DISTINCT session_name, frame_counter, timestamp AS ts_npm, ts_comp FROM frames LEFT JOIN clock USING (session_name, frame_counter)")
def j14_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = saved(frames(spark, sf_dir).select("session_name", "frame_counter", "timestamp"), "frames")
    return camera.stamps(camera.with_clock(f, clock(f)))


@query("a11_without_artefacts", f"WITH {FRAMES_SQL}, m AS (SELECT session_name, frame_counter, (region0r + region2r) / 2 AS red FROM frames), l AS (SELECT session_name, avg(red) + 1.5::DOUBLE * stddev_samp(red) AS lim FROM m GROUP BY 1) SELECT session_name, frame_counter FROM m JOIN l USING (session_name) WHERE red <= lim")
def a11_without_artefacts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return camera.without_artefacts(frames(spark, sf_dir), 1.5).select("session_name", "frame_counter")


CYCLES_SQL = f"""{LONG_SQL}, cyc AS (SELECT session_name, blockname, branch_id, channel_wavelength, raw_au, ts_comp, frame_counter, row_number() OVER (PARTITION BY session_name, blockname, branch_id, channel_wavelength ORDER BY ts_comp) AS cycle_number FROM long WHERE ts_comp IS NOT NULL),
cycles AS (SELECT *, avg(ts_comp) OVER (PARTITION BY session_name, blockname, branch_id, cycle_number) AS time FROM cyc)"""
BRANCH = ["session_name", "blockname", "branch_id"]


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return long(spark, sf_dir).where("ts_comp IS NOT NULL").select(*BRANCH, "channel_wavelength", "frame_counter", F.col("ts_comp").alias("time"), F.col("raw_au").alias("au_smooth_ma"))


@query("w17_cycles", f"WITH {CYCLES_SQL} SELECT session_name, blockname, branch_id, channel_wavelength, frame_counter, cycle_number, round(time, 6) AS time FROM cycles")
def w17_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return camera.with_cycles(_timed(spark, sf_dir), BRANCH).drop("au_smooth_ma").withColumn("time", F.round("time", 6))


@query("a9_cycles_paired", f"WITH {CYCLES_SQL}, c AS (SELECT session_name, blockname, branch_id, cycle_number, avg(raw_au) AS control FROM cycles WHERE channel_wavelength = '405' GROUP BY ALL) SELECT s.session_name, s.blockname, s.branch_id, s.channel_wavelength, s.cycle_number, s.raw_au AS signal, control FROM cycles s LEFT JOIN c USING (session_name, blockname, branch_id, cycle_number) WHERE s.channel_wavelength <> '405'")
def a9_cycles_paired(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pairs(spark, sf_dir).select(*BRANCH, "channel_wavelength", "cycle_number", "signal", "control")


def _pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = channels(spark, sf_dir).select(*BRANCH, "channel_wavelength", F.when(F.col("channel_wavelength") == "405", "control").otherwise("signal").alias("channel_id"))
    return camera.cycles_paired(_timed(spark, sf_dir), ids, BRANCH)


def fits_sql(cycles: str, control: int, time: int) -> str:
    """Common table expressions from `cycles` to `fits`."""
    keys = [*BRANCH, "channel_wavelength"]
    return f"""cc AS (SELECT session_name, blockname, branch_id, cycle_number, avg(raw_au) AS control FROM {cycles} WHERE channel_wavelength = '405' GROUP BY ALL),
cp AS (SELECT s.session_name, s.blockname, s.branch_id, s.channel_wavelength, s.cycle_number, s.time, s.raw_au AS signal, control FROM {cycles} s JOIN cc USING (session_name, blockname, branch_id, cycle_number) WHERE s.channel_wavelength <> '405'),
{fit_sql('fc', 'cp', keys, 'control', {'control_fitted': 'signal'}, control)}, {fit_sql('fits', 'fc', keys, 'time', {'poly_signal': 'signal', 'poly_control': 'control'}, time)}"""


@query("a9_normalised_cycles", f"WITH {CYCLES_SQL}, {fits_sql('cycles', 3, 4)} SELECT session_name, blockname, branch_id, channel_wavelength, cycle_number, round(signal - control_fitted, 2) AS delta_signal_fitted_control, round(signal - poly_signal, 2) AS delta_signal_poly, round(control - poly_control, 2) AS delta_control_poly FROM fits")
def a9_normalised_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = camera.normalise_cycles(_pairs(spark, sf_dir).where("control IS NOT NULL"), BRANCH, 3, 4)
    return out.select(*BRANCH, "channel_wavelength", "cycle_number", *[F.round(d, 2).alias(d) for d in camera.DELTAS])


@query(
    "r3_camera_peth",
    f"""WITH {CYCLES_SQL.replace('FROM long WHERE ts_comp IS NOT NULL', 'FROM clipped').replace(', cyc AS', ', sp AS (SELECT session_name, blockname, min(ts_comp) + 1000.0 AS a, max(ts_comp) - 3000.0 AS z FROM long GROUP BY ALL), clipped AS (SELECT long.* FROM long JOIN sp USING (session_name, blockname) WHERE ts_comp > a AND ts_comp < z), cyc AS')}, {fits_sql('cycles', 1, 2)},
asked AS (SELECT session_name, frame_counter * 25.0::DOUBLE + 990 AS t, frame_counter AS event_number FROM frames WHERE frame_counter % 60 = 30), seen AS (SELECT a.session_name, event_number, min(ts_comp) AS ts FROM asked a JOIN clock c ON c.session_name = a.session_name AND c.ts_comp >= a.t GROUP BY ALL),
near AS (SELECT f.*, event_number, CAST(round(f.time * 1000) AS BIGINT) - CAST(round(s.ts * 1000) AS BIGINT) AS rel FROM fits f JOIN seen s USING (session_name)),
m AS (SELECT session_name, blockname, branch_id, channel_wavelength, event_number, CAST(ceil((rel + 500000) / 250000.0::DOUBLE) AS BIGINT) AS bin, round(avg(signal - control_fitted), 2) AS delta_signal_fitted_control FROM near WHERE rel > -500000 AND rel < 1000000 GROUP BY ALL)
SELECT * EXCLUDE (bin), bin * 250000 - 500000 AS time_rel FROM m QUALIFY bin < max(bin) OVER (PARTITION BY session_name, blockname, branch_id, event_number)""",
)
def r3_camera_peth(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, ids = saved(frames(spark, sf_dir), "frames"), channels(spark, sf_dir)
    marks = f.where("frame_counter % 60 = 30").select("session_name", (F.col("timestamp") + 990).alias("event_ms"), F.col("frame_counter").alias("event_number"))
    kinds = ids.select(*BRANCH, "channel_wavelength", F.when(F.col("channel_wavelength") == "405", "control").otherwise("signal").alias("channel_id"))
    out = camera.processed(f, clock(f), ids, kinds, log(spark, sf_dir), marks, 1, 2, 0.5, 1.0, 0.25)["streams_peth"]
    return out.select(*BRANCH, "channel_wavelength", "event_number", "time_rel", F.round(camera.DELTAS[0], 2).alias(camera.DELTAS[0]))
