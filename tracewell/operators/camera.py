"""Frames of camera systems: regions, channels, clocks and clips."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.operators.align import next_frame
from tracewell.operators.peri import histogram
from tracewell.operators.scan import ranges, scan, tasks_of
from tracewell.operators.signal import DELTAS, fitted_deltas
from tracewell.sources.scratch import saved


def region_rows(frames: DataFrame, keys: list[str]) -> DataFrame:
    """One row a frame and region column `region<k><colour>`: roi, channel_color, raw_au."""
    regions = [c for c in frames.columns if c.startswith("region")]
    told = [(c, re.search(r"\d+", c)) for c in regions]  # names are read once, not with each row
    cells = [F.struct(F.col(c).alias("raw_au"), F.lit(int(n[0]) if n else None).cast("int").alias("roi"), F.lit(c[-1]).alias("channel_color")) for c, n in told]
    return frames.select(*keys, F.inline(F.array(*cells)))


def log_channels(log: DataFrame, packed: list[str], keys: list[str], separator: str = r"[^0-9A-Za-z.]+") -> DataFrame:
    """One row a channel of a log whose cells pack up to three values; its roi follows colour and
    branch: (branch - 1) * 2 for red, else branch * 2 - 1."""
    parts = F.arrays_zip(*[F.split(F.col(c).cast("string"), separator).alias(c) for c in packed])
    rows = log.select(*keys, F.posexplode(parts).alias("_i", "_c")).where("_i < 3")
    rows = rows.select(*keys, F.concat(F.lit("ch0"), F.col("_i") + 1).alias("channel_number"), *[F.col(f"_c.{c}").alias(c) for c in packed])
    roi = F.when(F.col("channel_color") == "r", (F.col("branch_id") - 1) * 2).otherwise(F.col("branch_id") * 2 - 1)
    return rows.withColumns({"roi": roi.cast("int"), "led_state": F.col("led_state").try_cast("int")})


def with_clock(frames: DataFrame, clock: DataFrame) -> DataFrame:
    """Frames with the computer's time, by session and frame number, in as many tasks as the frames need."""
    by = ["session_name", "frame_counter"]
    tasks = tasks_of(frames)
    if tasks:
        frames, clock = frames.repartition(tasks, *by), clock.repartition(tasks, *by)
    return frames.join(clock.hint("merge"), by, "left")  # as long as the frames


def of_channels(rows: DataFrame, channels: DataFrame) -> DataFrame:
    """Region rows of the channels that the log lists; others go."""
    return rows.join(channels, ["session_name", "led_state", "roi", "channel_color"])


def clock_ticks(serial: DataFrame, log: DataFrame) -> DataFrame:
    """Distinct ticks of the serial clock, numbered per pin in time, with their block."""
    one = serial.distinct().withColumn("tick_number", F.row_number().over(Window.partitionBy("session_name", "clock_pin").orderBy("ts_comp")))
    return one.join(log.select("session_name", "blockname", "clock_pin").distinct(), ["session_name", "clock_pin"])


def clip_by_clock(rows: DataFrame, ticks: DataFrame, log: DataFrame, time: str = "ts_comp") -> DataFrame:
    """Rows between the block's first tick less its baseline and its last tick and what follows."""
    span = ticks.groupBy("session_name", "blockname").agg(F.min(time).alias("_a"), F.max(time).alias("_z"))
    span = span.join(log.select("session_name", "blockname", "tm_baseline", "tm_post").distinct(), ["session_name", "blockname"])
    span = span.select("session_name", "blockname", (F.col("_a") - F.col("tm_baseline") * 1000).alias("_a"), (F.col("_z") + F.col("tm_post") * 1000).alias("_z"))
    return rows.join(span, ["session_name", "blockname"]).where((F.col(time) > F.col("_a")) & (F.col(time) < F.col("_z"))).drop("_a", "_z")


def clip_by_trim(rows: DataFrame, log: DataFrame, time: str = "ts_comp") -> DataFrame:
    """Rows that are later than the trimmed start and earlier than the trimmed end of their block."""
    rows = saved(rows, "block-rows")
    span = rows.groupBy("session_name", "blockname").agg(F.min(time).alias("_a"), F.max(time).alias("_z"))
    span = span.join(log.select("session_name", "blockname", "tm_trim_start", "tm_trim_end").distinct(), ["session_name", "blockname"])
    span = span.select("session_name", "blockname", (F.col("_a") + F.col("tm_trim_start") * 1000).alias("_a"), (F.col("_z") - F.col("tm_trim_end") * 1000).alias("_z"))
    return rows.join(span, ["session_name", "blockname"]).where((F.col(time) > F.col("_a")) & (F.col(time) < F.col("_z"))).drop("_a", "_z")


def stamps(frames: DataFrame) -> DataFrame:
    """Key of frame numbers, the camera's and the computer's time."""
    return frames.select("session_name", "frame_counter", F.col("timestamp").alias("ts_npm"), "ts_comp").distinct()


def without_artefacts(frames: DataFrame, sds: float, key: str = "session_name") -> DataFrame:
    """Frames whose mean over the red regions isn't above the session's mean by `sds` deviations."""
    red = [c for c in frames.columns if c.startswith("region") and c.endswith("r")]
    mean = sum((F.col(c) for c in red[1:]), F.col(red[0])) / len(red)
    rows = frames.withColumn("_red", mean)
    limit = rows.groupBy(key).agg((F.avg("_red") + sds * F.stddev_samp("_red")).alias("_limit"))
    return rows.join(limit, key).where(F.col("_limit").isNull() | F.isnan("_limit") | (F.col("_red") <= F.col("_limit"))).drop("_red", "_limit")


def with_cycles(rows: DataFrame, keys: list[str], channel: str = "channel_wavelength", time: str = "time", also: dict[str, Column] | None = None) -> DataFrame:
    """Number of each sample of a channel, and the mean time of the samples of one number; `also` names
    other aggregates of those samples."""
    rows, many = ranges(saved(rows, "channels"), [*keys, channel], time)
    numbered = scan(rows, [*keys, channel], [time], many, number="cycle_number")
    cycle = Window.partitionBy(*keys, "cycle_number")  # a row a channel
    return numbered.withColumns({time: F.avg(time).over(cycle)} | {c: v.over(cycle) for c, v in (also or {}).items()})


def cycles_paired(rows: DataFrame, channels: DataFrame, keys: list[str], value: str = "au_smooth_ma") -> DataFrame:
    """Signal samples with the mean of the control samples of their cycle; `channels` tells by
    channel_wavelength which channel_id ('signal' or 'control') it is."""
    control = F.avg(F.when(F.col("channel_id") == "control", F.col(value)))
    met = with_cycles(rows.join(channels, [*keys, "channel_wavelength"], "left"), keys, also={"control": control})
    signal = met.where("channel_id = 'signal'").withColumnRenamed(value, "signal").drop("channel_id")
    return signal.where(F.col("signal").isNotNull())


def normalise_cycles(pairs: DataFrame, keys: list[str], degree_control: int | str, degree_time: int | str) -> DataFrame:
    """Fits, residuals, z-scores and dF/F by session, branch and wavelength."""
    by, pairs = [*keys, "channel_wavelength"], saved(pairs, "cycles")
    return fitted_deltas(pairs, by, [("control", "signal", degree_control, "control_fitted"), ("time", "signal", degree_time, "poly_signal"), ("time", "control", degree_time, "poly_control")])


def processed(frames: DataFrame, clock: DataFrame, channels: DataFrame, kinds: DataFrame, log: DataFrame, events: DataFrame, degree_control: int | str, degree_time: int | str, before: float, after: float, width: float) -> dict[str, DataFrame]:
    """The whole job of a camera system, all sessions and branches at once: frames on the computer's
    clock, the log's channels, the block without its trimmed ends, signals beside the controls of their
    cycle, fits (streams_session), events on the first frame after them (events), and the series around
    them (streams_peth). `kinds` names signal and control channels of a branch, `events` has
    (session_name, event_ms, event_number); windows are in seconds."""
    branch = ["session_name", "blockname", "branch_id"]
    timed = saved(with_clock(frames, clock), "timed-frames")
    rows = of_channels(region_rows(timed, ["session_name", "frame_counter", "led_state", "ts_comp"]), channels)
    rows = clip_by_trim(rows.where("ts_comp IS NOT NULL"), log)
    rows = rows.select(*branch, "channel_wavelength", F.col("ts_comp").alias("time"), F.col("raw_au").alias("au_smooth_ma"))
    fits = saved(normalise_cycles(cycles_paired(rows, kinds, branch).where("control IS NOT NULL"), branch, degree_control, degree_time), "camera-fits")
    seen = next_frame(events, timed.where("ts_comp IS NOT NULL").select("session_name", F.col("ts_comp").alias("_frame_ms"), "ts_comp"), "session_name", "event_ms", "_frame_ms", "ts_comp")
    on_clock = seen.select("session_name", "event_number", F.round(F.col("ts_comp") * 1000).cast("long").alias("event_us"))
    series = fits.withColumn("time_us", F.round(F.col("time") * 1000).cast("long"))
    us = [round(x * 1_000_000) for x in (before, after, width)]
    wanted = on_clock.join(log.select(*branch).distinct(), "session_name")
    measures = ["signal", "control", "control_fitted", *DELTAS]
    around = histogram(series, wanted, branch, "time_us", "event_us", ["event_number"], *us, measures, more=["channel_wavelength"])
    return {"streams_session": fits, "events": on_clock, "streams_peth": around}
