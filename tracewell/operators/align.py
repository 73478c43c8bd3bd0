"""Alignment of clocks: ticks, fills, local deltas and session scales."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.operators.scan import ranges, scan
from tracewell.sources.scratch import saved


def by_ticks(received: DataFrame, events: DataFrame, tick: str = "tick_clock_out", key: str = "blockname", order: tuple[str, ...] = ()) -> DataFrame:
    """Times of events on the recorder's clock: the k-th tick sent is the k-th received, other events
    keep their distance from the last tick sent; those before the first tick are dropped. `received`
    has (key, ts), `events` (key, event_id_char, ts)."""
    got, many = ranges(received.select(key, "ts"), [key], "ts")
    got = scan(got, [key], ["ts"], many, number="_k").select(key, F.col("ts").alias("_at"), "_k")
    sent, many = ranges(events.withColumn("_late", (F.col("event_id_char") != tick).cast("int")), [key], "ts")
    # A tick stands before the other events of its time. The number of ticks up to an event names its last one.
    sent = saved(scan(sent, [key], ["ts", "_late", *order], many, sums={"_k": 1 - F.col("_late")}).where("_k > 0"), "ticks")
    ticks = sent.where("_late = 0").select(key, "_k", F.col("ts").alias("_from"))
    most = received.groupBy(key).agg(F.count("*").alias("_most"))
    rows = sent.join(ticks, [key, "_k"]).join(most, key).withColumn("_k", F.least("_k", "_most"))  # the last one received stands for those after it
    out = rows.join(got, [key, "_k"])
    return out.withColumn("ts_rec_system", F.col("_at") + F.col("ts") - F.col("_from")).drop("_late", "_k", "_from", "_at", "_most")


def next_frame(events: DataFrame, frames: DataFrame, key: str, event_time: str, frame_time: str, frame_value: str) -> DataFrame:
    """The value of the first frame at or after each event; events beyond the recording go. One scan
    over frames and events in time order, read backwards; a frame stands behind the events of its time."""
    kind = dict(frames.dtypes)[frame_value]
    e = events.withColumns({"_t": F.col(event_time), "_f": F.lit(1), "_v": F.lit(None).cast(kind)})
    f = frames.select(key, F.col(frame_time).alias("_t"), F.lit(2).alias("_f"), F.col(frame_value).alias("_v"))
    both, many = ranges(e.unionByName(f, allowMissingColumns=True), [key], "_t")
    filled = scan(both, [key], ["_t", "_f"], many, nexts={"_next": F.col("_v")}).where("_f = 1 AND _next IS NOT NULL")
    return filled.withColumn(frame_value, F.col("_next")).drop("_t", "_f", "_v", "_next")


def local_delta(reference: DataFrame, external: DataFrame, names: list[str], key: str = "blockname", time: str = "event_ts") -> DataFrame:
    """External events on the reference clock: both sides start at their first shared event, the k-th
    shared events of a name are matched, and the step between them is carried on to the events that
    follow."""

    def shared(df: DataFrame, name: str) -> DataFrame:
        rows = df.where(F.col("event_id_char").isin(names) & (F.col(time) > 0 if name == "x" else F.lit(True)))
        first = rows.groupBy(key).agg(F.min(time).alias(f"_trim_{name}"))
        rows, many = ranges(rows.select(key, "event_id_char", time), [key, "event_id_char"], time)
        rows = scan(rows, [key, "event_id_char"], [time], many, number="_k").join(first, key)
        return rows.select(key, "event_id_char", "_k", f"_trim_{name}", F.col(time).alias(f"_t_{name}"))

    met = shared(reference, "r").join(shared(external, "x"), [key, "event_id_char", "_k"])
    met = met.withColumn("_step", (F.col("_t_r") - F.col("_trim_r")) - (F.col("_t_x") - F.col("_trim_x")))
    trims = met.groupBy(key).agg(F.min("_trim_r").alias("_trim_r"), F.min("_trim_x").alias("_trim_x"))
    steps = met.groupBy(key, "event_id_char", F.col("_t_x").alias(time)).agg(F.min("_step").alias("_step"))
    rows = external.join(trims, key).join(steps, [key, "event_id_char", time], "left")
    rows, many = ranges(rows, [key], time)
    rows = scan(rows, [key], [time, "event_id_char"], many, lasts={"step_factor": F.col("_step")})
    return rows.withColumn(f"{time}_tdt", F.col(time) - F.col("_trim_x") + F.col("_trim_r") + F.col("step_factor")).drop("_trim_r", "_trim_x", "_step")


def session_scale(reference: DataFrame, external: DataFrame, names: list[str], key: str = "blockname", time: str = "event_ts") -> DataFrame:
    """External events scaled by the spans between the first and last shared events of both sides:
    factor (external - reference) / reference."""
    r = reference.where(F.col("event_id_char").isin(names)).groupBy(key).agg(F.min(time).alias("_r0"), F.max(time).alias("_r1"))
    x = external.where(F.col("event_id_char").isin(names) & (F.col(time) > 0)).groupBy(key).agg(F.min(time).alias("_x0"), F.max(time).alias("_x1"))
    spans = r.join(x, key).withColumn("scale_factor", F.try_divide((F.col("_x1") - F.col("_x0")) - (F.col("_r1") - F.col("_r0")), F.col("_r1") - F.col("_r0")))
    rows = external.join(spans, key)
    at = F.col(time) - F.col("_x0")
    return rows.withColumn(f"{time}_tdt", at - at * F.col("scale_factor") + F.col("_r0")).drop("_r0", "_r1", "_x0", "_x1")
