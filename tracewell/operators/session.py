"""The whole job of a recording: from streams, events and the session log to fitted signals, their
downsampled form, the events of interest and the series around them, for all sessions at once.

Every setting is a column of the log and may differ by session; sessions are never looped over. Only
the distinct lists of events of interest are, which are settings.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewell.operators import bins, peri, shape, signal
from tracewell.operators import events as ev
from tracewell.sources.scratch import saved

SECOND = 1_000_000
MEASURES = ["signal", "control", "control_fitted", *signal.DELTAS, *[f"{d}_{k}" for d in signal.DELTAS for k in ("zscore", "dff")]]
#: Columns of the log that set how a session is worked on, and what a missing value stands for.
DEFAULTS = {"smoothing_window": 0.1, "poly_degree_fitted_control": 3, "poly_degree_polyfit": 4, "trim_time_start": 20.0, "down_sampled_freq": 20.0, "peth_pre": 10.0, "peth_post": 20.0, "fit_model": "polynomial", "events_of_interest": ""}


def settings(log: DataFrame) -> DataFrame:
    """One row an included session, with its settings and no nulls among them."""
    kept = log.where(F.col("include") == 1)
    there = set(log.columns)
    return kept.select("blockname", *[(F.coalesce(F.col(c), F.lit(v)) if c in there else F.lit(v)).alias(c) for c, v in DEFAULTS.items()])


def fitted(streams: DataFrame, info: DataFrame, log: DataFrame, edges: str = "partial") -> DataFrame:
    """Signals of the included sessions, smoothed over the log's window, beside their fitted controls
    from the log's trim time on. `streams` has (blockname, channel, sample_idx, raw_au), `info`
    (blockname, channel, fs), `log` also signal_id.. and control_id."""
    own = settings(log)
    windows = info.join(own, "blockname").select("blockname", "channel", F.round(F.col("smoothing_window") * F.col("fs")).alias("k"))
    rows = shape.select_sessions(streams, log)
    timed = signal.sample_time(signal.moving_average(rows, windows, edges), info)
    timed = timed.join(own.select("blockname", "trim_time_start"), "blockname").where(F.col("time") > F.col("trim_time_start")).drop("trim_time_start")
    ids = shape.session_signals(log.where(F.col("include") == 1)).select("blockname", F.col("signal_id").alias("signal_wavelength"), F.col("control_id").alias("control_wavelength"))
    pairs = signal.paired(timed, ids).join(own.select("blockname", "poly_degree_fitted_control", "poly_degree_polyfit", "fit_model"), "blockname")
    pairs = saved(pairs, "session-pairs")
    models = [r[0] for r in own.select("fit_model").distinct().collect()]  # settings, not data
    parts = [signal.fitted(pairs.where(F.col("fit_model") == m), "poly_degree_fitted_control", "poly_degree_polyfit", m) for m in sorted(models)]
    out = parts[0] if parts else signal.fitted(pairs)
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("poly_degree_fitted_control", "poly_degree_polyfit", "fit_model")


def downsampled(fits: DataFrame, log: DataFrame) -> DataFrame:
    """Means of the fitted signals by bins of the log's rate."""
    rows = fits.drop("sample_idx").join(settings(log).select("blockname", "down_sampled_freq"), "blockname")
    return bins.downsample(rows, "down_sampled_freq", signal.FIT_KEYS, measures=MEASURES)


def events_of_interest(events: DataFrame, log: DataFrame) -> DataFrame:
    """The events that each session's log asks for, numbered by name. `events` has (blockname,
    event_id_char, event_us, ...)."""
    own = settings(log).select("blockname", "events_of_interest")
    out = None
    for (asked,) in sorted(tuple(r) for r in own.select("events_of_interest").distinct().collect()):
        some = events.join(own.where(F.col("events_of_interest") == asked).select("blockname"), "blockname", "left_semi")
        found = ev.catalogue(some, [x.strip() for x in asked.split(";") if x.strip()])
        out = found if out is None else out.unionByName(found)
    out = events.limit(0) if out is None else out
    return ev.numbered(out, ["blockname", "event_id_char"], ["event_us"])


def around_events(fits: DataFrame, wanted: DataFrame, log: DataFrame) -> DataFrame:
    """Histogram of the fitted signals around the wanted events, with the log's windows and rate."""
    own = settings(log)
    own = own.select("blockname", *[F.round(F.col(c) * SECOND).cast("long").alias(c) for c in ("peth_pre", "peth_post")], F.round(SECOND / F.col("down_sampled_freq")).cast("long").alias("_bin_us"))
    series = fits.withColumn("time_us", F.round(F.col("time") * SECOND).cast("long")).join(own.drop("_bin_us"), "blockname")
    rows = wanted.select("blockname", "event_id_char", "event_number", "event_us").join(own, "blockname")
    return peri.histogram(series, rows, ["blockname"], "time_us", "event_us", ["event_id_char", "event_number"], "peth_pre", "peth_post", "_bin_us", MEASURES, more=signal.FIT_KEYS[1:])


class Recording:
    """The results of a recording, each worked out when it is first asked for: `streams_session`, `events`,
    `events_peth`, `streams_peth`. The fitted samples (`fits`) and the wanted events, which several of them
    need, are written once."""

    def __init__(self, streams: DataFrame, info: DataFrame, log: DataFrame, events: DataFrame) -> None:
        self.streams, self.info, self.log, self.all_events = streams, info, log, events

    @cached_property
    def fits(self) -> DataFrame:
        return saved(fitted(self.streams, self.info, self.log), "session-fits")

    @cached_property
    def events_peth(self) -> DataFrame:
        return saved(events_of_interest(self.all_events, self.log), "session-events")

    @cached_property
    def events(self) -> DataFrame:
        return ev.numbered(shape.select_sessions(self.all_events, self.log), ["blockname", "event_id_char"], ["event_us"])

    @cached_property
    def streams_session(self) -> DataFrame:
        return downsampled(self.fits, self.log)

    @cached_property
    def streams_peth(self) -> DataFrame:
        return around_events(self.fits, self.events_peth, self.log)

    def tables(self) -> dict[str, DataFrame]:
        return {name: getattr(self, name) for name in ("streams_session", "events", "events_peth", "streams_peth")}


def processed(streams: DataFrame, info: DataFrame, log: DataFrame, events: DataFrame) -> Recording:
    """The whole job over all included sessions of the log."""
    return Recording(streams, info, log, events)
