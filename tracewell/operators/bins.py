"""Binning, resampling, interpolation and time warping.

Bins are right-closed and named by their right edge, as `ceil((t - t0) * rate)`; a value on the first
edge belongs to no bin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.operators.scan import met, ranges, scan
from tracewell.sources.scratch import saved


def right_bin(t: Column, origin: Column, rate: float | Column) -> Column:
    """Number of the right-closed bin of `t`, from 1; 0 or less lies outside."""
    return F.ceil((t - origin) * F.lit(rate)).cast("long")


def downsample(streams: DataFrame, rate: float | str, keys: list[str], time: str = "time", measures: list[str] | None = None, session: list[str] | None = None) -> DataFrame:
    """Means of the measures by bin of 1 / `rate`, a number or a column of the session; bins start at the session's least time, rounded to
    hundredths (half to even). The last bin of each session is dropped, as it is seldom full."""
    session = session or keys[:2]
    own = [rate] if isinstance(rate, str) else []
    per = F.col(rate) if own else F.lit(rate)
    measures = measures or [c for c, t in streams.dtypes if c not in (*keys, *own, time) and t in ("double", "float", "bigint", "int")]
    # Every bin starts at the session's first sample, so one small aggregate is joined back.
    origin = streams.groupBy(session[0]).agg(F.bround(F.min(time), 2).alias("_t0"))
    rows = met(streams, origin, session[:1]).withColumn("_bin", right_bin(F.col(time), F.col("_t0"), per)).where("_bin > 0")
    means = rows.groupBy(*keys, *own, "_t0", "_bin").agg(*[F.avg(m).alias(m) for m in measures])
    last = means.groupBy(*session).agg(F.max("_bin").alias("_last"))
    out = met(means, last, session).where(F.col("_bin") < F.col("_last"))
    return out.select(*keys, (F.col("_t0") + F.col("_bin") / per).alias(time), *measures)


def resample(df: DataFrame, keys: list[str], time: str, value: str, width: int) -> DataFrame:
    """Means by right-closed bins of `width` from 0 on; times are whole numbers of the same unit."""
    edge = F.ceil(F.col(time) / F.lit(width)).cast("long") * width
    return df.withColumn(time, edge).where(F.col(time) > 0).groupBy(*keys, time).agg(F.avg(value).alias(value))


def rebin(df: DataFrame, keys: list[str], time: str, before: int, after: int, width: int, measures: list[str]) -> DataFrame:
    """A peri-event series in other bins: right-closed bins of `width` from -`before` to `after`,
    means of the measures, without the last bin of all."""
    at = F.ceil((F.col(time) + before) / F.lit(width)).cast("long")
    rows = df.withColumn("_bin", at).where((F.col("_bin") > 0) & (F.col("_bin") * width <= before + after))
    means = rows.groupBy(*keys, "_bin").agg(*[F.avg(m).alias(m) for m in measures])
    last = means.agg(F.max("_bin").alias("_last"))
    return means.join(F.broadcast(last), F.col("_bin") < F.col("_last")).select(*keys, (F.col("_bin") * width - before).alias("rel_time_bin"), *measures)


def binned_counts(df: DataFrame, keys: list[str], time: str, start: int, end: int, width: int) -> DataFrame:
    """Counts by right-closed bins named by their left edge, with zero for the empty ones. Every
    combination of the values of the grouping columns gets all bins: that table is the result's, so the
    levels are crossed as asked for, and no row of `df` takes part in it."""
    n = (end - start) // width
    at = F.ceil((F.col(time) - start) / F.lit(width)).cast("long")
    counted = df.withColumn("_bin", at).where(F.col("_bin").between(1, n)).groupBy(*keys, "_bin").agg(F.count("*").alias("event_count"))
    levels = None
    for k in keys:
        one = df.select(k).distinct()
        levels = one if levels is None else levels.join(one)
    full = levels.withColumn("_bin", F.explode(F.sequence(F.lit(1).cast("long"), F.lit(n).cast("long"))))
    out = full.join(counted, [*keys, "_bin"], "left")
    return out.select(*keys, (start + (F.col("_bin") - 1) * width).alias("event_bin"), F.coalesce("event_count", F.lit(0)).alias("event_count"))


def interpolate(df: DataFrame, keys: list[str], time: str, value: str, step: int) -> DataFrame:
    """Linear interpolation on the grid from the first time of each group in steps of `step`. Each
    stretch between two rows makes its own grid points, so a group is never expanded in one place.
    Rows at equal times are averaged first."""
    one, many = ranges(df.groupBy(*keys, time).agg(F.avg(value).alias(value)), keys, time, of=df)
    rows = scan(one, keys, [time], many, following={"_next": F.col(time), "_to": F.col(value)})
    rows = met(rows, df.groupBy(*keys).agg(F.min(time).alias("_t0")), keys)
    a = F.ceil((F.col(time) - F.col("_t0")) / F.lit(step)).cast("long")
    z = F.when(F.col("_next").isNull(), F.floor((F.col(time) - F.col("_t0")) / F.lit(step))).otherwise(F.ceil((F.col("_next") - F.col("_t0")) / F.lit(step)) - 1).cast("long")
    rows = rows.withColumns({"_a": a, "_z": z}).where("_a <= _z").withColumn("_k", F.explode(F.sequence("_a", "_z")))
    at = F.col("_t0") + F.col("_k") * step
    between = F.col(value) + (F.col("_to") - F.col(value)) * (at - F.col(time)) / (F.col("_next") - F.col(time))
    return rows.select(*keys, at.alias("_at"), F.when(F.col("_next").isNull(), F.col(value)).otherwise(between).alias("_v")).select(*keys, F.col("_at").alias(time), F.col("_v").alias(value))


def warp(streams: DataFrame, periods: DataFrame, keys: list[str], time: str, measures: list[str], per_period: int) -> DataFrame:
    """Time warping: `periods` has (session, response_set, period, start, end); the samples of each
    period are scaled to the unit stretch [period, period + 1), binned in `per_period` right-closed
    bins from -1 on, and averaged. The last bin of each set is dropped. Sample times and period ends
    are whole numbers. Samples meet periods in an equi-join on session and a time bucket as wide as the
    session's mean period: a period goes to the buckets that it touches, some two on average."""
    session = keys[0]
    widths = saved(periods.groupBy(session).agg(F.greatest(F.lit(1), F.ceil(F.avg(F.col("end") - F.col("start")))).alias("_width")), "period-widths")
    touched = F.sequence(F.floor(F.col("start") / F.col("_width")), F.floor((F.col("end") - 1) / F.col("_width")))
    spread = periods.where("start < end").join(widths, session).withColumn("_bucket", F.explode(touched)).drop("_width")
    rows = streams.join(widths, session).withColumn("_bucket", F.floor(F.col(time) / F.col("_width"))).drop("_width")
    at = rows.join(spread, [session, "_bucket"]).where((F.col(time) >= F.col("start")) & (F.col(time) < F.col("end"))).drop("_bucket")
    whole = Window.partitionBy(*keys, "response_set", "period")
    span = at.withColumns({"_a": F.min(time).over(whole), "_z": F.max(time).over(whole)})
    part = F.try_divide((F.col(time) - F.col("_a")).cast("double"), F.col("_z") - F.col("_a"))
    rows = span.withColumn("_u", part + F.col("period")).where(F.col("_u").isNotNull())
    rows = rows.withColumn("_bin", F.ceil((F.col("_u") + 1) * per_period).cast("long"))
    means = rows.groupBy(*keys, "response_set", "_bin").agg(*[F.avg(m).alias(m) for m in measures])
    last = means.groupBy(session, "response_set").agg(F.max("_bin").alias("_last"))
    out = means.join(last, [session, "response_set"]).where(F.col("_bin") < F.col("_last"))
    return out.select(*keys, "response_set", (F.col("_bin") / F.lit(per_period) - 1).alias("time_rel"), *measures)
