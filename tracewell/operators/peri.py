"""Series around events: range joins by time buckets, histograms, baselines.

Times of samples and events are whole microseconds; windows are open on both sides.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.operators.scan import ROWS, by_size, met, ranges, scan, together
from tracewell.sources.scratch import saved


WALK = 1 << 16  # events of a run that are walked in one task


def keep_apart(events: DataFrame, keys: list[str], time: str, gap: int) -> DataFrame:
    """Without events that start less than `gap` after the last kept event of their group. Events at
    the same time as it stay.

    What is kept depends on what was kept before. Events that follow each other closely are a run, whose
    first is kept; runs of up to WALK events are walked in order. In longer ones each time is linked to the
    first one at least `gap` later, and the times that can be reached from the first are marked by doubling:
    a round joins the marked times with links twice as long as the round before."""
    cut, many = ranges(events.withColumn("_tie", F.monotonically_increasing_id()), keys, time)
    cut = scan(cut.withColumn("_at", F.col("_cut")), keys, [time, "_tie"], many, previous={"_p": F.col(time)})
    fresh = F.coalesce(F.col(time) - F.col("_p") >= gap, F.lit(True)).cast("long")
    run = cut.withColumn("_new", fresh).withColumnRenamed("_at", "_cut")
    run = saved(scan(saved(run, "runs") if many else run, keys, [time, "_tie"], many, sums={"_run": F.col("_new")}).drop("_new", "_p", "_tie"), "runs")
    by = [*keys, "_run"]

    def walk(table: pa.Table, firsts: np.ndarray) -> pa.Table:
        times = table.column(time).to_numpy()
        kept = np.zeros(len(times), bool)
        kept[firsts] = True  # most runs have one event
        for a, z in zip(firsts, np.append(firsts[1:], len(times)), strict=True):
            last = times[a]
            for i in range(a + 1, z):
                kept[i] = not 0 < times[i] - last < gap
                last = times[i] if kept[i] else last
        return table.filter(pa.array(kept))

    def long(rows: DataFrame) -> DataFrame:
        return met(rows, _reached(rows, by, time, gap), [*by, time], "left_semi")

    return by_size(run, by, WALK, lambda rows: together(rows, by, walk, rows.schema, [time]), long).drop("_run")


def _reached(rows: DataFrame, by: list[str], time: str, gap: int) -> DataFrame:
    """(by, time): the first time of each group, the first one at least `gap` after it, and so on."""
    times = saved(rows.select(*by, time).distinct(), "run-times")
    probes = times.select(*by, (F.col(time) + gap).alias("_t"), F.lit(0).alias("_kind"), F.col(time).alias("_from"))
    both = probes.unionByName(times.select(*by, F.col(time).alias("_t"), F.lit(1).alias("_kind")), allowMissingColumns=True)
    both, many = ranges(both, by, "_t")
    links = scan(both, by, ["_t", "_kind"], many, nexts={"_to": F.when(F.col("_kind") == 1, F.col("_t"))})
    links = saved(links.where("_kind = 0 AND _to IS NOT NULL").select(*by, F.col("_from").alias(time), "_to"), "links")
    marked = saved(times.groupBy(*by).agg(F.min(time).alias(time)), "marked")
    while not links.isEmpty():
        more = met(links, marked, [*by, time], "left_semi").select(*by, F.col("_to").alias(time))
        marked = saved(marked.unionByName(more).distinct(), "marked")
        onward = links.select(*by, F.col(time).alias("_to"), F.col("_to").alias("_far"))
        links = saved(met(links, onward, [*by, "_to"]).select(*by, time, F.col("_far").alias("_to")), "links")
    return marked


def _of(x: int | str) -> Column:
    return F.col(x) if isinstance(x, str) else F.lit(x)


def around(series: DataFrame, events: DataFrame, keys: list[str], series_time: str, event_time: str, before: int | str, after: int | str, apart: bool = False) -> DataFrame:
    """Samples strictly inside (event - before, event + after) of the same group, with `rel_time`.
    `before` and `after` are numbers, or name columns that series and events both have, with one value
    a group.

    An equi-join on group and time bucket: an event goes to the buckets that its window touches (two
    or three, as a bucket is as wide as a window), a sample to its own one."""
    if apart:
        events = keep_apart(events, keys, event_time, after)
    width = _of(before) + _of(after)
    low, high = F.floor((F.col(event_time) - _of(before)) / width), F.floor((F.col(event_time) + _of(after)) / width)
    spread = events.withColumn("_bucket", F.explode(F.sequence(low, high)))
    told = [x for x in (before, after) if isinstance(x, str)]
    rows = series.withColumn("_bucket", F.floor(F.col(series_time) / width)).drop(*told).join(spread, [*keys, "_bucket"])
    inside = (F.col(series_time) > F.col(event_time) - _of(before)) & (F.col(series_time) < F.col(event_time) + _of(after))
    return rows.where(inside).withColumn("rel_time", F.col(series_time) - F.col(event_time)).drop("_bucket")


def histogram(series: DataFrame, events: DataFrame, keys: list[str], series_time: str, event_time: str, event_keys: list[str], before: int | str, after: int | str, width: int | str, measures: list[str], more: list[str] | None = None) -> DataFrame:
    """Peri-event time histogram: means of the measures by event and right-closed bin named by its
    right edge, over samples strictly inside the event's window; the last bin of each event is dropped.
    `before`, `after` and `width` are numbers or name columns of the events. Nulls and NaNs don't count.

    Samples are summed up once in time order, and the edges of all events' bins look up what has been
    summed up to them: a bin is the difference of its edges. So an event costs its bins, not its samples,
    however much the windows overlap. Sums are kept in two parts, the first of which is exact."""
    more, told = more or [], list(dict.fromkeys(x for x in (before, after, width) if isinstance(x, str)))
    event, group = [*keys, *event_keys, event_time], [*keys, *more]
    by = [*event, *more]
    one = saved(events.select(*keys, *event_keys, event_time, *told).distinct(), "peri-events")
    groups = saved(series.groupBy(*group).agg(F.count("*").alias("_n")), "peri-groups")
    span = _of(before) + _of(after)
    # Rows of a group, edges among them, are told without making them.
    asked = one.groupBy(*keys).agg(F.sum(F.ceil(span / _of(width)) + 1).alias("_e"))
    large = not met(groups, asked, keys, "left").where(F.col("_n") + F.coalesce("_e", F.lit(0)) > ROWS).isEmpty()
    one = met(one, groups.drop("_n"), keys) if more else one
    edges = one.withColumn("_b", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(span / _of(width)))))
    edges = edges.withColumns({"_t": F.col(event_time) - _of(before) + F.least(F.col("_b") * _of(width), span - 1), "_kind": F.lit(1)})  # the window is open: up to the microsecond before its end
    values = {m: F.when(~F.isnan(F.col(m).cast("double")), F.col(m).cast("double")) for m in measures}
    samples = series.select(*group, F.col(series_time).cast("long").alias("_t"), F.lit(0).alias("_kind"), *[v.alias(f"_v_{m}") for m, v in values.items()])
    both = samples.unionByName(edges, allowMissingColumns=True)
    both, many = ranges(both, group, "_t") if large else (both.withColumn("_cut", F.lit(0).cast("long")), False)
    high = lambda m: F.floor(F.col(f"_v_{m}") * 1024) / 1024
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    sums = {"_rows": (1 - F.col("_kind")).cast("long")}
    for m in measures:
        sums |= {f"_h_{m}": zero(high(m)), f"_l_{m}": zero(F.col(f"_v_{m}") - high(m)), f"_n_{m}": F.when(F.col(f"_v_{m}").isNotNull(), 1).otherwise(0).cast("long")}
    seen = scan(both, group, ["_t", "_kind"], many, sums=sums).where("_kind = 1")
    ordered = Window.partitionBy(*by).orderBy("_b")  # a row a bin
    bins = seen.repartition(*event).select(*by, *told, "_b", *[(F.col(c) - F.lag(c).over(ordered)).alias(c) for c in sums]).where("_b > 0 AND _rows > 0")
    last = Window.partitionBy(*event)  # dealt and sorted for both
    kept = bins.withColumn("_last", F.max("_b").over(last)).where("_b < _last")
    means = [F.try_divide(F.col(f"_h_{m}") + F.col(f"_l_{m}"), F.col(f"_n_{m}")).alias(m) for m in measures]
    return kept.select(*by, (F.col("_b") * _of(width) - _of(before)).alias("time_rel"), *means)


def local_zscore(peth: DataFrame, keys: list[str], start: int, end: int, measures: list[str], time: str = "time_rel") -> DataFrame:
    """Adds `<measure>_zscore_local`: against mean and deviation of the group in the open window."""
    base = peth.where((F.col(time) > start) & (F.col(time) < end)).groupBy(*keys)
    base = base.agg(*[f(m).alias(f"_{n}_{m}") for m in measures for n, f in (("m", F.avg), ("s", F.stddev_samp))])
    out = peth.join(base, keys, "left")
    for m in measures:
        out = out.withColumn(f"{m}_zscore_local", F.try_divide(F.col(m) - F.col(f"_m_{m}"), F.col(f"_s_{m}")))
    return out.drop(*[f"_{n}_{m}" for m in measures for n in "ms"])
