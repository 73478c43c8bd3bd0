"""Edges of digital states, threshold peaks, response sets, trials."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewell.operators.events import bouts
from tracewell.operators.scan import ranges, scan
from tracewell.sources.scratch import saved


def edges(states: DataFrame, keys: list[str], time: str, state: str, last_high: bool = False) -> DataFrame:
    """Onset and offset of each high stretch of a sampled state, numbered. The offset is the first
    low sample after it, or with `last_high` its last high sample; a stretch that doesn't end has a
    null offset (or its last sample). A recording that starts high has its onset there."""
    rows, many = ranges(states.select(*keys, time, state).distinct(), keys, time, of=states)
    rows = scan(rows.withColumn("_at", F.col("_cut")), keys, [time, state], many, previous={"_p": F.col(state)})
    rows = rows.withColumn("_on", ((F.col(state) == 1) & (F.coalesce("_p", F.lit(0)) == 0)).cast("long")).withColumnRenamed("_at", "_cut")
    rows = scan(saved(rows, "edges") if many else rows, keys, [time, state], many, sums={"event_number": F.col("_on")}).where("event_number > 0")
    end = F.max(F.when(F.col(state) == 1, F.col(time))) if last_high else F.min(F.when((F.col(state) == 0), F.col(time)))
    return rows.groupBy(*keys, "event_number").agg(F.min(time).alias("onset"), end.alias("offset"))


def peaks(streams: DataFrame, keys: list[str], time: str, value: str, step: int, threshold: float, apart: int) -> DataFrame:
    """Peaks above a threshold: samples at or above it that follow each other within 1.1 `step` make a
    run, its largest sample (the earliest of equals) is its peak, and peaks with another less than
    `apart` ahead are dropped. Numbered a stream."""
    above, many = ranges(streams.where(F.col(value) >= threshold), keys, time)
    above = scan(above.withColumn("_at", F.col("_cut")), keys, [time, value], many, previous={"_p": F.col(time)})
    fresh = F.coalesce(F.col(time) - F.col("_p") > step * 1.1, F.lit(True)).cast("long")
    above = above.withColumn("_new", fresh).withColumnRenamed("_at", "_cut")
    above = scan(saved(above, "peaks") if many else above, keys, [time, value], many, sums={"_run": F.col("_new")})
    top = above.groupBy(*keys, "_run").agg(F.max(F.struct(F.col(value), (-F.col(time)).alias("_t"))).alias("_top"))
    found = top.select(*keys, (-F.col("_top._t")).alias("event_time"), F.col(f"_top.{value}").alias(value), F.lit("peak").alias("event_id_char"), F.concat_ws("\0", *keys).alias("_stream"))
    kept = bouts(found, ["peak"], (apart, apart), (0, 9999), ("==", "<"), "filtered_peak", "event_time", "_stream") if apart else found
    return kept.drop("_stream", "event_id_char").withColumn("peak_num", F.row_number().over(Window.partitionBy(*keys).orderBy("event_time")))


def response_sets(events: DataFrame, closing: str, time: str = "event_ts", key: str = "blockname") -> DataFrame:
    """Numbers the closing events of a session and gives each number to the events that lead up to
    it; what no closing event follows is dropped."""
    rows = events.distinct().where(F.col(time).isNotNull())
    rows, many = ranges(rows, [key], time, of=events)
    closed = F.col("event_id_char") == closing
    # A closing event's number is that of its kind so far, and those before it up to the last one are its own.
    rows = scan(rows, [key], [time, "event_id_char"], many, sums={"_n": closed.cast("long")}, nexts={"_closing": F.when(closed, F.col(time))})
    rows = rows.where(F.col("_closing").isNotNull())
    return rows.withColumn("response_set", (F.col("_n") + F.when(closed, 0).otherwise(1)).cast("int")).drop("_n", "_closing")


def periods(sets: DataFrame, before: int, after: int, time: str = "event_ts", key: str = "blockname") -> DataFrame:
    """Periods of each response set for warping: one ahead of its first event, one from each event to
    the next, one after the last. Sets of a single event have no period between and go."""
    whole = Window.partitionBy(key, "response_set")
    ordered = whole.orderBy(time)
    rows = sets.withColumns({"_k": F.row_number().over(ordered), "_next": F.lead(time).over(ordered), "_n": F.count("*").over(whole)}).where("_n > 1")
    own = F.struct(F.col("_k").alias("period"), F.col(time).alias("start"), F.coalesce("_next", F.col(time) + after).alias("end"))
    ahead = F.struct((F.col("_k") - 1).alias("period"), (F.col(time) - before + 1).alias("start"), F.col(time).alias("end"))
    parts = F.explode(F.when(F.col("_k") == 1, F.array(ahead, own)).otherwise(F.array(own))).alias("_p")
    return rows.select(key, "response_set", parts).select(key, "response_set", "_p.*")


def trials(params: DataFrame, names: list[str] | None = None, key: str = "blockname") -> DataFrame:
    """Parameters named trial_*, the n-th value of each to trial n, one column a name; the last trial
    of a session is dropped. Naming the columns spares the pass that finds them."""
    rows = params.where(F.col("param_dynamic").contains("trial_"))
    nth = Window.partitionBy(key, "param_dynamic").orderBy("param_ts")
    rows = rows.withColumn("trial_num", F.row_number().over(nth))
    wide = rows.groupBy(key, "trial_num").pivot("param_dynamic", names).agg(F.first("param_value"))
    return wide.withColumn("_last", F.max("trial_num").over(Window.partitionBy(key))).where("trial_num < _last").drop("_last")


def stimulations(params: DataFrame, names: list[str], key: str = "blockname") -> DataFrame:
    """Stimulation parameters, one row a time, one column a name, numbered a session."""
    wide = params.where(F.col("param_dynamic").isin(names)).groupBy(key, "param_ts").pivot("param_dynamic", names).agg(F.first("param_value"))
    return wide.withColumn("stim_num", F.row_number().over(Window.partitionBy(key).orderBy("param_ts")))
