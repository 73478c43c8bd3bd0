"""Queries over events: labels, bouts, numbering, peri-event series, clocks, edges, sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.jobs.registry import query
from tracewell.operators import align, bins, edges, peri
from tracewell.operators import events as ev
from tracewell.sources.adapters import EVENTS_SQL, events

HOUR = 3_600_000_000


@query("j1_label_pulses", f"WITH {EVENTS_SQL}, p AS (SELECT blockname, CASE event_id_char WHEN 'view' THEN 'PtC0' WHEN 'click' THEN 'PC1/' WHEN 'error' THEN 'Cam1' ELSE 'PC3' END AS name, event_us AS onset FROM ev), c AS (SELECT blockname, CASE name WHEN 'PtC0' THEN 'PC0' ELSE replace(name, '/', '') END AS event_id_ttl, onset FROM p WHERE name <> 'Cam1') SELECT blockname, event_id_ttl, onset AS event_ts, CASE event_id_ttl WHEN 'PC0' THEN 'lick' WHEN 'PC1' THEN 'sol' END AS event_id_char FROM c")
def j1_label_pulses(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    kind = F.col("event_id_char")
    pulses = e.select("blockname", F.when(kind == "view", "PtC0").when(kind == "click", "PC1/").when(kind == "error", "Cam1").otherwise("PC3").alias("name"), F.col("event_us").alias("onset"))
    log = e.select("blockname").distinct().select("blockname", F.lit("lick").alias("PtC0"), F.lit("sol").alias("PC1"), F.lit(None).cast("string").alias("PC3"))
    return ev.label_pulses(pulses, log)


@query("j2_label_inputs", f"WITH {EVENTS_SQL} SELECT DISTINCT blockname, 'input' || event_id % 2 AS event_id_ttl, CASE event_id % 2 WHEN 0 THEN 'lick' END AS event_id_char, (event_us // 1000) / 1000.0::DOUBLE AS event_ts, (event_us // 1000 + 50) / 1000.0::DOUBLE AS event_ts_offset FROM ev")
def j2_label_inputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    ms = F.expr("event_us div 1000")
    inputs = e.select("blockname", F.concat(F.lit("input"), F.col("event_id") % 2).alias("input_id"), ms.alias("onset"), (ms + 50).alias("offset"))
    log = e.select("blockname").distinct().select("blockname", F.lit("input0").alias("input_id"), F.lit("lick").alias("event_id_char"))
    return ev.label_inputs(inputs, log)


@query("j3_drop_startup", f"WITH {EVENTS_SQL}, h AS (SELECT *, event_us // {6 * HOUR} * {6 * HOUR} AS t FROM ev), k AS (SELECT DISTINCT blockname, event_id_char, t FROM h), f AS (SELECT * FROM k QUALIFY t = min(t) OVER (PARTITION BY blockname)), m AS (SELECT * FROM f QUALIFY count(*) OVER (PARTITION BY blockname) > 1) SELECT h.event_id, h.blockname, h.event_id_char, h.t FROM h WHERE NOT EXISTS (SELECT 1 FROM m WHERE m.blockname = h.blockname AND m.event_id_char = h.event_id_char AND m.t = h.t)")
def j3_drop_startup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("t", F.expr(f"event_us div {6 * HOUR}") * (6 * HOUR))
    return ev.drop_startup(e, "t").select("event_id", "blockname", "event_id_char", "t")


@query("w5_bouts", f"WITH {EVENTS_SQL}, s AS (SELECT *, count(*) OVER (w RANGE BETWEEN {6 * HOUR - 1} PRECEDING AND 1 PRECEDING) AS b, count(*) OVER (w RANGE BETWEEN 1 FOLLOWING AND {12 * HOUR - 1} FOLLOWING) AS a FROM ev WHERE event_id_char IN ('view', 'click') WINDOW w AS (PARTITION BY blockname ORDER BY event_us)) SELECT blockname, event_id, event_us, 'view_onset' AS event_id_char FROM s WHERE b = 0 AND a > 1")
def w5_bouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ev.bouts(events(spark, sf_dir), ["view", "click"], (6 * HOUR, 12 * HOUR), (0, 1), ("==", ">"), "view_onset")
    return out.select("blockname", "event_id", "event_us", "event_id_char")


@query("w6_catalogue", f"WITH {EVENTS_SQL}, n AS (SELECT blockname, event_id, event_us // 20000 AS event_us, CASE event_id_char WHEN 'view' THEN 'lick' WHEN 'click' THEN 'sol' WHEN 'error' THEN 'tone' ELSE 'led_onset' END AS event_id_char FROM ev), s AS (SELECT *, count(*) OVER (w RANGE BETWEEN 999999 PRECEDING AND 1 PRECEDING) AS b, count(*) OVER (w RANGE BETWEEN 1 FOLLOWING AND 999999 FOLLOWING) AS a FROM n WINDOW w AS (PARTITION BY blockname, event_id_char ORDER BY event_us)) SELECT blockname, event_id, event_us, 'lick_onset' AS event_id_char FROM s WHERE event_id_char = 'lick' AND b = 0 AND a > 0 UNION ALL SELECT blockname, event_id, event_us, 'lick_offset' FROM s WHERE event_id_char = 'lick' AND b > 0 AND a = 0 UNION ALL SELECT blockname, event_id, event_us, 'sol_onset' FROM s WHERE event_id_char = 'sol' AND b = 0 AND a > 0 UNION ALL SELECT blockname, event_id, event_us, event_id_char FROM s WHERE event_id_char IN ('tone', 'led_onset')")
def w6_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id_char")
    name = F.when(kind == "view", "lick").when(kind == "click", "sol").when(kind == "error", "tone").otherwise("led_onset")
    e = events(spark, sf_dir).select("blockname", "event_id", F.expr("event_us div 20000").alias("event_us"), name.alias("event_id_char"))
    return ev.catalogue(e, ["lick_onset", "lick_offset", "sol_onset", "tone_onset", "led_onset", "shock_onset"])


@query("w7_event_number", f"WITH {EVENTS_SQL} SELECT event_id, row_number() OVER (PARTITION BY blockname, event_id_char ORDER BY event_us, event_id) AS event_number FROM ev")
def w7_event_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ev.numbered(events(spark, sf_dir), ["blockname", "event_id_char"], ["event_us", "event_id"]).select("event_id", "event_number")


@query("j7_last_ticks", f"WITH {EVENTS_SQL}, n AS (SELECT blockname, count(*) AS n FROM ev WHERE event_id_char = 'click' GROUP BY 1) SELECT blockname, event_us AS ts FROM ev JOIN n USING (blockname) WHERE event_id_char = 'view' QUALIFY row_number() OVER (PARTITION BY blockname ORDER BY event_us DESC) <= n")
def j7_last_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    sent = e.where("event_id_char = 'click'").groupBy("blockname").agg(F.count("*").alias("n"))
    return ev.last_ticks(e.where("event_id_char = 'view'").select("blockname", F.col("event_us").alias("ts")), sent)


@query("j7_without_first_tick", f"WITH {EVENTS_SQL} SELECT blockname, event_us AS ts FROM ev WHERE event_id_char = 'view' QUALIFY event_us > min(event_us) OVER (PARTITION BY blockname)")
def j7_without_first_tick(spark: SparkSession, sf_dir: str) -> DataFrame:
    ticks = events(spark, sf_dir).where("event_id_char = 'view'").select("blockname", F.col("event_us").alias("ts"))
    return ev.without_first_tick(ticks, ["blockname"])


AROUND_SQL = f"""{EVENTS_SQL}, e AS (SELECT blockname, event_us AS event_ts, event_id AS event_number FROM ev WHERE event_id_char = 'error'),
near AS (SELECT s.blockname, s.event_us, round(s.value * 100) AS value, e.event_ts, e.event_number, s.event_us - e.event_ts AS rel_time FROM ev s JOIN e ON s.blockname = e.blockname AND s.event_us > e.event_ts - {12 * HOUR} AND s.event_us < e.event_ts + {24 * HOUR})"""


def _series(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = events(spark, sf_dir)
    return e.select("blockname", "event_us", F.round(F.col("value") * 100).alias("value")), e.where("event_id_char = 'error'").select("blockname", F.col("event_us").alias("event_ts"), F.col("event_id").alias("event_number"))


@query("j4_peri_event_series", f"WITH {AROUND_SQL} SELECT * FROM near")
def j4_peri_event_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, e = _series(spark, sf_dir)
    return peri.around(s, e, ["blockname"], "event_us", "event_ts", 12 * HOUR, 24 * HOUR)


@query(
    "j4_peri_event_apart",
    f"""WITH RECURSIVE {AROUND_SQL}, kept AS (SELECT blockname, min(event_ts) AS t FROM e GROUP BY 1 UNION ALL SELECT k.blockname, (SELECT min(e.event_ts) FROM e WHERE e.blockname = k.blockname AND e.event_ts >= k.t + {24 * HOUR}) AS t FROM kept k WHERE k.t IS NOT NULL)
SELECT near.* FROM near JOIN kept ON near.blockname = kept.blockname AND near.event_ts = kept.t""",
)
def j4_peri_event_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, e = _series(spark, sf_dir)
    return peri.around(s, e, ["blockname"], "event_us", "event_ts", 12 * HOUR, 24 * HOUR, apart=True)


@query("j5_peri_event_histogram", f"WITH {AROUND_SQL}, m AS (SELECT blockname, event_ts, event_number, CAST(ceil((rel_time + {12 * HOUR}) / {HOUR * 3}.0::DOUBLE) AS BIGINT) AS bin, avg(value) AS value FROM near GROUP BY ALL) SELECT blockname, event_ts, event_number, bin * {HOUR * 3} - {12 * HOUR} AS time_rel, round(value, 6) AS value FROM m QUALIFY bin < max(bin) OVER (PARTITION BY blockname, event_ts, event_number)")
def j5_peri_event_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, e = _series(spark, sf_dir)
    out = peri.histogram(s, e, ["blockname"], "event_us", "event_ts", ["event_number"], 12 * HOUR, 24 * HOUR, 3 * HOUR, ["value"])
    return out.withColumn("value", F.round("value", 6))


@query("a10_local_zscore", f"WITH {AROUND_SQL}, b AS (SELECT blockname, avg(value) AS m, nullif(stddev_samp(value), 0) AS s FROM near WHERE rel_time > {-12 * HOUR} AND rel_time < 0 GROUP BY 1) SELECT near.blockname, event_number, event_us, round((value - m) / s, 6) AS value_zscore_local FROM near LEFT JOIN b USING (blockname)")
def a10_local_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, e = _series(spark, sf_dir)
    near = peri.around(s, e, ["blockname"], "event_us", "event_ts", 12 * HOUR, 24 * HOUR)
    out = peri.local_zscore(near, ["blockname"], -12 * HOUR, 0, ["value"], "rel_time")
    return out.select("blockname", "event_number", "event_us", F.round("value_zscore_local", 6).alias("value_zscore_local"))


@query(
    "j6_ticks_alignment",
    f"""WITH {EVENTS_SQL}, r AS (SELECT blockname, event_us AS got, row_number() OVER (PARTITION BY blockname ORDER BY event_us) AS k FROM ev WHERE event_id_char = 'view'),
s AS (SELECT blockname, event_id, event_us AS ts, event_id_char = 'click' AS tick FROM ev WHERE event_id_char <> 'view'),
n AS (SELECT *, CASE WHEN tick THEN row_number() OVER (PARTITION BY blockname, tick ORDER BY ts, event_id) END AS k FROM s),
j AS (SELECT n.*, r.got FROM n LEFT JOIN r ON r.blockname = n.blockname AND r.k = n.k),
f AS (SELECT *, last_value(CASE WHEN tick THEN ts END IGNORE NULLS) OVER w AS fr, last_value(CASE WHEN tick THEN got END IGNORE NULLS) OVER w AS seen FROM j WINDOW w AS (PARTITION BY blockname ORDER BY ts, tick DESC, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT blockname, event_id, ts, seen + ts - fr AS ts_rec_system FROM f WHERE seen IS NOT NULL""",
)
def j6_ticks_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    received = e.where("event_id_char = 'view'").select("blockname", F.col("event_us").alias("ts"))
    sent = e.where("event_id_char <> 'view'").select("blockname", "event_id", F.col("event_us").alias("ts"), "event_id_char")
    return align.by_ticks(received, sent, "click", order=("event_id",)).select("blockname", "event_id", "ts", "ts_rec_system")


@query("j8_next_frame", f"WITH {EVENTS_SQL} SELECT e.blockname, e.event_id, min(f.event_us) AS ts_comp FROM ev e JOIN ev f ON f.blockname = e.blockname AND f.event_id_char = 'view' AND f.event_us >= e.event_us WHERE e.event_id_char = 'error' GROUP BY ALL")
def j8_next_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir)
    frames = e.where("event_id_char = 'view'").select("blockname", F.col("event_us").alias("t"), F.col("event_us").alias("ts_comp"))
    out = align.next_frame(e.where("event_id_char = 'error'").select("blockname", "event_id", "event_us"), frames, "blockname", "event_us", "t", "ts_comp")
    return out.select("blockname", "event_id", "ts_comp")


SIDES_SQL = f"""{EVENTS_SQL}, ref AS (SELECT blockname, event_id_char, event_us * 2 + 7 AS event_ts FROM ev WHERE event_id % 5 <> 0), ext AS (SELECT blockname, event_id, event_id_char, event_us AS event_ts FROM ev)"""


def _sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    e = events(spark, sf_dir)
    return e.where("event_id % 5 <> 0").select("blockname", "event_id_char", (F.col("event_us") * 2 + 7).alias("event_ts")), e.select("blockname", "event_id", "event_id_char", F.col("event_us").alias("event_ts"))


@query(
    "j9_local_delta",
    f"""WITH {SIDES_SQL}, r AS (SELECT blockname, event_id_char, event_ts, min(event_ts) OVER (PARTITION BY blockname) AS tr, row_number() OVER (PARTITION BY blockname, event_id_char ORDER BY event_ts) AS k FROM ref WHERE event_id_char IN ('view', 'click')),
x AS (SELECT blockname, event_id_char, event_ts, min(event_ts) OVER (PARTITION BY blockname) AS tx, row_number() OVER (PARTITION BY blockname, event_id_char ORDER BY event_ts) AS k FROM ext WHERE event_id_char IN ('view', 'click') AND event_ts > 0),
m AS (SELECT r.blockname, r.event_id_char, r.tr, x.tx, x.event_ts, (r.event_ts - r.tr) - (x.event_ts - x.tx) AS step FROM r JOIN x USING (blockname, event_id_char, k)),
t AS (SELECT blockname, min(tr) AS tr, min(tx) AS tx FROM m GROUP BY 1), st AS (SELECT blockname, event_id_char, event_ts, min(step) AS step FROM m GROUP BY ALL),
f AS (SELECT e.*, t.tr, t.tx, last_value(st.step IGNORE NULLS) OVER (PARTITION BY e.blockname ORDER BY e.event_ts, e.event_id_char ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS step_factor FROM ext e JOIN t USING (blockname) LEFT JOIN st ON st.blockname = e.blockname AND st.event_id_char = e.event_id_char AND st.event_ts = e.event_ts)
SELECT blockname, event_id, step_factor, event_ts - tx + tr + step_factor AS event_ts_tdt FROM f""",
)
def j9_local_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, x = _sides(spark, sf_dir)
    return align.local_delta(r, x, ["view", "click"]).select("blockname", "event_id", "step_factor", "event_ts_tdt")


@query(
    "j10_session_scale",
    f"""WITH {SIDES_SQL}, r AS (SELECT blockname, min(event_ts) AS r0, max(event_ts) AS r1 FROM ref WHERE event_id_char = 'view' GROUP BY 1), x AS (SELECT blockname, min(event_ts) AS x0, max(event_ts) AS x1 FROM ext WHERE event_id_char = 'view' AND event_ts > 0 GROUP BY 1),
s AS (SELECT blockname, r0, x0, ((x1 - x0) - (r1 - r0)) / nullif(CAST(r1 - r0 AS DOUBLE), 0) AS f FROM r JOIN x USING (blockname))
SELECT e.blockname, e.event_id, round((event_ts - x0) - (event_ts - x0) * f + r0, 0) AS event_ts_tdt FROM ext e JOIN s USING (blockname)""",
)
def j10_session_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    r, x = _sides(spark, sf_dir)
    return align.session_scale(r, x, ["view"]).select("blockname", "event_id", F.round("event_ts_tdt", 0).alias("event_ts_tdt"))


@query(
    "w8_edges",
    f"""WITH {EVENTS_SQL}, s AS (SELECT DISTINCT blockname, event_us, CAST(event_id_char IN ('view', 'click') AS INTEGER) AS state FROM ev),
p AS (SELECT *, lag(state, 1, 0) OVER (PARTITION BY blockname ORDER BY event_us) AS pr FROM s), n AS (SELECT *, sum(CASE WHEN state = 1 AND pr = 0 THEN 1 ELSE 0 END) OVER (PARTITION BY blockname ORDER BY event_us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS event_number FROM p)
SELECT blockname, CAST(event_number AS BIGINT) AS event_number, min(event_us) AS onset, min(CASE WHEN state = 0 THEN event_us END) AS "offset" FROM n WHERE event_number > 0 GROUP BY ALL""",
)
def w8_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("state", F.col("event_id_char").isin("view", "click").cast("int"))
    return edges.edges(e, ["blockname"], "event_us", "state")


@query(
    "w9_peaks",
    f"""WITH {EVENTS_SQL}, a AS (SELECT blockname, event_us, value, CASE WHEN event_us - lag(event_us) OVER w <= {10 * HOUR} * 1.1 THEN 0 ELSE 1 END AS nw FROM ev WHERE value >= 30 WINDOW w AS (PARTITION BY blockname ORDER BY event_us)),
r AS (SELECT *, sum(nw) OVER (PARTITION BY blockname ORDER BY event_us ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS run FROM a),
t AS (SELECT blockname, event_us, value FROM r QUALIFY row_number() OVER (PARTITION BY blockname, run ORDER BY value DESC, event_us) = 1),
f AS (SELECT *, count(*) OVER (PARTITION BY blockname ORDER BY event_us RANGE BETWEEN {24 * HOUR - 1} PRECEDING AND 1 PRECEDING) AS b FROM t)
SELECT blockname, event_us AS event_time, value, row_number() OVER (PARTITION BY blockname ORDER BY event_us) AS peak_num FROM f WHERE b = 0""",
)
def w9_peaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges.peaks(events(spark, sf_dir), ["blockname"], "event_us", "value", 10 * HOUR, 30.0, 24 * HOUR)


SETS_SQL = f"""{EVENTS_SQL}, one AS (SELECT DISTINCT blockname, event_id_char, event_us AS event_ts FROM ev WHERE event_id_char IN ('view', 'error')),
nn AS (SELECT *, CASE WHEN event_id_char = 'error' THEN row_number() OVER (PARTITION BY blockname, event_id_char ORDER BY event_ts) END AS n FROM one),
sets AS (SELECT blockname, event_id_char, event_ts, first_value(n IGNORE NULLS) OVER (PARTITION BY blockname ORDER BY event_ts, event_id_char ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS response_set FROM nn QUALIFY response_set IS NOT NULL)"""


def _sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).where("event_id_char IN ('view', 'error')").select("blockname", "event_id_char", F.col("event_us").alias("event_ts"))
    return edges.response_sets(e, "error")


@query("w11_response_sets", f"WITH {SETS_SQL} SELECT * FROM sets")
def w11_response_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sets(spark, sf_dir)


@query(
    "w12_time_warp",
    f"""WITH {SETS_SQL}, o AS (SELECT *, row_number() OVER w AS k, lead(event_ts) OVER w AS nx, count(*) OVER (PARTITION BY blockname, response_set) AS c, FROM sets WINDOW w AS (PARTITION BY blockname, response_set ORDER BY event_ts)),
p AS (SELECT blockname, response_set, k AS period, event_ts AS st, coalesce(nx, event_ts + {12 * HOUR}) AS en FROM o WHERE c > 1 UNION ALL SELECT blockname, response_set, 0, event_ts - {12 * HOUR} + 1, event_ts FROM o WHERE c > 1 AND k = 1),
a AS (SELECT e.blockname, p.response_set, p.period, e.event_us, round(e.value * 100) AS v FROM ev e JOIN p ON p.blockname = e.blockname AND e.event_us >= p.st AND e.event_us < p.en),
u AS (SELECT *, (event_us - min(event_us) OVER g) / nullif(CAST(max(event_us) OVER g - min(event_us) OVER g AS DOUBLE), 0) + period AS u FROM a WINDOW g AS (PARTITION BY blockname, response_set, period)),
m AS (SELECT blockname, response_set, CAST(ceil((u + 1) * 4) AS BIGINT) AS bin, avg(v) AS value FROM u WHERE u IS NOT NULL GROUP BY ALL)
SELECT blockname, response_set, bin / 4.0::DOUBLE - 1 AS time_rel, round(value, 6) AS value FROM m QUALIFY bin < max(bin) OVER (PARTITION BY blockname, response_set)""",
)
def w12_time_warp(spark: SparkSession, sf_dir: str) -> DataFrame:
    periods = edges.periods(_sets(spark, sf_dir), 12 * HOUR, 12 * HOUR)
    s = events(spark, sf_dir).select("blockname", "event_us", F.round(F.col("value") * 100).alias("value"))
    return bins.warp(s, periods, ["blockname"], "event_us", ["value"], 4).withColumn("value", F.round("value", 6))


PARAMS_SQL = f"{EVENTS_SQL}, params AS (SELECT blockname, 'trial_' || event_id_char AS param_dynamic, event_us AS param_ts, CAST(event_id AS VARCHAR) AS param_value FROM ev)"


def _params(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("blockname", F.concat(F.lit("trial_"), "event_id_char").alias("param_dynamic"), F.col("event_us").alias("param_ts"), F.col("event_id").cast("string").alias("param_value"))


@query("w13_trials", f"WITH {PARAMS_SQL}, n AS (SELECT *, row_number() OVER (PARTITION BY blockname, param_dynamic ORDER BY param_ts) AS trial_num FROM params WHERE param_dynamic IN ('trial_view', 'trial_click')) SELECT blockname, trial_num, max(CASE WHEN param_dynamic = 'trial_view' THEN param_value END) AS trial_view, max(CASE WHEN param_dynamic = 'trial_click' THEN param_value END) AS trial_click FROM n WHERE trial_num < (SELECT max(trial_num) FROM n z WHERE z.blockname = n.blockname) GROUP BY blockname, trial_num")
def w13_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edges.trials(_params(spark, sf_dir).where("param_dynamic IN ('trial_view', 'trial_click')"), ["trial_view", "trial_click"])


@query("w14_stimulations", f"WITH {PARAMS_SQL}, d AS (SELECT blockname, param_ts // {HOUR} AS param_ts, param_dynamic, min(param_value) AS v FROM params WHERE param_dynamic IN ('trial_view', 'trial_click') GROUP BY ALL) SELECT *, row_number() OVER (PARTITION BY blockname ORDER BY param_ts) AS stim_num FROM (SELECT blockname, param_ts, max(CASE WHEN param_dynamic = 'trial_view' THEN v END) AS trial_view, max(CASE WHEN param_dynamic = 'trial_click' THEN v END) AS trial_click FROM d GROUP BY blockname, param_ts)")
def w14_stimulations(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _params(spark, sf_dir).groupBy("blockname", F.expr(f"param_ts div {HOUR}").alias("param_ts"), "param_dynamic").agg(F.min("param_value").alias("param_value"))
    return edges.stimulations(p, ["trial_view", "trial_click"])
