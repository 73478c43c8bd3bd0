"""Operators on event tables: labels, bouts, catalogue of rules, numbering, start-up filter.

Times of events are whole microseconds, so open windows are exact range frames.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECOND = 1_000_000


def label_pulses(pulses: DataFrame, log: DataFrame) -> DataFrame:
    """Names of input lines from the session log: columns `PC*` / `PtC*` are unpivoted to
    (blockname, name, event_id_char), pulse names lose `/` and have `Pt` for `P`; camera and tick
    lines go; pulses of unnamed lines stay with a null name."""
    lines = [c for c in log.columns if c.startswith(("PC", "PtC"))]
    names = log.unpivot("blockname", lines, "name", "event_id_char").where(F.col("event_id_char").isNotNull())
    names = names.select("blockname", F.regexp_replace("name", "^Pt", "P").alias("event_id_ttl"), "event_id_char")
    clean = F.regexp_replace(F.regexp_replace("name", "/", ""), "^Pt", "P")
    rows = pulses.where(~F.col("name").rlike("Cam|Tick")).withColumn("event_id_ttl", clean).drop("name")
    return rows.join(names, ["blockname", "event_id_ttl"], "left").withColumnsRenamed({"onset": "event_ts", "offset": "event_ts_offset"})


def label_inputs(inputs: DataFrame, log: DataFrame, line: str = "input_id") -> DataFrame:
    """Names of a camera system's inputs, times from milliseconds to seconds, without repeats."""
    names = log.select("blockname", line, "event_id_char").distinct()
    out = inputs.join(names, ["blockname", line], "left")
    return out.select("blockname", F.col(line).alias("event_id_ttl"), "event_id_char", (F.col("onset") / 1000).alias("event_ts"), (F.col("offset") / 1000).alias("event_ts_offset")).distinct()


def drop_startup(events: DataFrame, time: str = "event_us", unit: int = 10) -> DataFrame:
    """Without the earliest events of a session (times rounded to `unit`) where several coincide."""
    kinds = events.select("blockname", "event_id_char", time).distinct().withColumn("_r", F.round(F.col(time) / F.lit(unit)))
    least = Window.partitionBy("blockname")
    first = kinds.withColumn("_m", F.min("_r").over(least)).where("_r = _m")
    many = first.withColumn("_n", F.count("*").over(least)).where("_n > 1").select("blockname", "event_id_char", time)
    return events.join(many, ["blockname", "event_id_char", time], "left_anti")


def compare(value: Column, test: str, n: int) -> Column:
    return {"<": value < n, ">": value > n, "==": value == n}[test]


def bouts(events: DataFrame, names: list[str], windows: tuple[int, int], counts: tuple[int, int], tests: tuple[str, str], label: str, time: str = "event_us", key: str = "blockname") -> DataFrame:
    """Events of the set `names` with so many others of the set inside the open windows before and
    after them, renamed to `label`. Events at the same time are in neither window."""
    own = events.where(F.col("event_id_char").isin(names))
    ordered = Window.partitionBy(key).orderBy(time)
    before = F.count("*").over(ordered.rangeBetween(-windows[0] + 1, -1))
    after = F.count("*").over(ordered.rangeBetween(1, windows[1] - 1))
    counted = own.withColumns({"_before": before, "_after": after})
    kept = counted.where(compare(F.col("_before"), tests[0], counts[0]) & compare(F.col("_after"), tests[1], counts[1]))
    return kept.withColumn("event_id_char", F.lit(label)).drop("_before", "_after")


@dataclass(frozen=True)
class Rule:
    """An event of the catalogue: its sources, and windows with tests if it's a bout's edge."""

    name: str
    sources: tuple[str, ...]
    windows: tuple[int, int] | None = None
    counts: tuple[int, int] = (0, 0)
    tests: tuple[str, str] = ("==", ">")


def _onset(name: str, sources: tuple[str, ...], seconds: int, n: int) -> Rule:
    return Rule(name, sources, (seconds * SECOND, seconds * SECOND), (0, n))


# The catalogue of events of interest.
LICKS = ("lick", "lick01", "lick02", "lick03", "lick04", "lick05")
RULES = (
    _onset("lick_onset", LICKS, 1, 0),
    Rule("lick_offset", LICKS, (SECOND, SECOND), (0, 0), (">", "==")),
    _onset("active_rotation_onset", ("active_rotation",), 3, 8),
    _onset("inactive_rotation_onset", ("inactive_rotation",), 3, 8),
    _onset("sol_onset", ("sol",), 1, 0),
    Rule("pump_onset", ("sol_onset",)),
    Rule("active_criteria", ("active_criteria",)),
    Rule("inactive_criteria", ("inactive_criteria",)),
    Rule("active_rotation_criteria", ("active_rotation_criteria",)),
    Rule("inactive_rotation_criteria", ("inactive_rotation_criteria",)),
    Rule("active_rotation_criteria_increment", ("active_rotation_criteria_increment",)),
    Rule("inactive_rotation_criteria_increment", ("inactive_rotation_criteria_increment",)),
    Rule("airpuff_onset", ("airpuff_onset",)),
    Rule("cue_led", ("cue_led",)),
    Rule("led_onset", ("led_onset",)),
    Rule("access_period", ("access_period",)),
    Rule("spout_extended", ("spout_extended",)),
    Rule("shock_onset", ("shock_onset",)),
    Rule("opto_stim", ("opto_stim",)),
)


def catalogue(events: DataFrame, wanted: list[str], rules: tuple[Rule, ...] = RULES, time: str = "event_us") -> DataFrame:
    """The wanted events of the catalogue, united. Names are matched whole. `all` is every event,
    `tone_onset` both of its spellings with names kept, `bout` a row for the onset and one for the
    offset of every event whose name contains bout. Nothing wanted gives an empty table."""
    parts = []
    by_name = {r.name: r for r in rules}
    for name in dict.fromkeys(wanted):
        if name == "all":
            parts.append(events)
        elif name == "tone_onset":
            parts.append(events.where(F.col("event_id_char").isin("tone_onset", "tone")))
        elif name == "bout":
            own = events.where(F.col("event_id_char").contains("bout"))
            parts.append(own.withColumn("event_id_char", F.concat("event_id_char", F.lit("_onset"))))
            if "event_ts_offset" in events.columns:
                parts.append(own.withColumn(time, F.col("event_ts_offset")).withColumn("event_id_char", F.concat("event_id_char", F.lit("_offset"))))
        elif (r := by_name.get(name)) is not None:
            if r.windows:
                parts.append(bouts(events, list(r.sources), r.windows, r.counts, r.tests, name, time))
            else:
                parts.append(events.where(F.col("event_id_char").isin(list(r.sources))).withColumn("event_id_char", F.lit(name)))
    out = events.limit(0)
    for p in parts:
        out = out.unionByName(p)
    return out


def numbered(events: DataFrame, keys: list[str], order: list[str], out: str = "event_number") -> DataFrame:
    return events.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))


def last_ticks(ticks: DataFrame, sent: DataFrame, time: str = "ts") -> DataFrame:
    """The last n recorded ticks of a session, n being how many were sent (blockname, n)."""
    late = Window.partitionBy("blockname").orderBy(F.desc(time))
    return ticks.join(sent, "blockname").withColumn("_k", F.row_number().over(late)).where("_k <= n").drop("_k", "n")


def without_first_tick(ticks: DataFrame, keys: list[str], time: str = "ts") -> DataFrame:
    return ticks.withColumn("_m", F.min(time).over(Window.partitionBy(*keys))).where(F.col(time) > F.col("_m")).drop("_m")
