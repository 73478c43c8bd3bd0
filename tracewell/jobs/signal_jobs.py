"""Queries over streams: smoothing, time, fits, normalisation, bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.jobs.orthogonal import fit_sql
from tracewell.jobs.registry import query
from tracewell.operators import bins, signal
from tracewell.operators.scan import met
from tracewell.sources.adapters import EVENTS_SQL, FS, STREAMS_SQL, events, streams
from tracewell.sources.scratch import saved

K_SQL = "CASE WHEN channel LIKE '_405%' THEN 4 WHEN channel LIKE '_465%' THEN 5 ELSE 0 END"


def _windows(s: DataFrame) -> DataFrame:
    k = F.when(F.col("channel").like("_405%"), 4).when(F.col("channel").like("_465%"), 5).otherwise(0)
    return s.select("blockname", "channel").distinct().withColumn("k", k)


def _averaged(before: tuple[int, int], after: tuple[int, int]) -> str:
    w = lambda b, a: f"avg(raw_au) OVER (PARTITION BY blockname, channel ORDER BY sample_idx ROWS BETWEEN {b} PRECEDING AND {a} FOLLOWING)"
    n = lambda b, a: f"count(*) OVER (PARTITION BY blockname, channel ORDER BY sample_idx ROWS BETWEEN {b} PRECEDING AND {a} FOLLOWING)"
    return f"""CASE k WHEN 4 THEN {w(before[0], after[0])} WHEN 5 THEN {w(before[1], after[1])} ELSE raw_au END AS au_smooth_ma,
       CASE k WHEN 4 THEN {n(before[0], after[0])} WHEN 5 THEN {n(before[1], after[1])} ELSE 0 END AS n"""


@query("w1_moving_average", f"WITH {STREAMS_SQL} SELECT blockname, channel, sample_idx, round(au_smooth_ma, 6) AS au_smooth_ma FROM (SELECT *, {_averaged((2, 2), (1, 2))} FROM (SELECT *, {K_SQL} AS k FROM streams))")
def w1_moving_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = streams(spark, sf_dir)
    return signal.moving_average(s, _windows(s)).select("blockname", "channel", "sample_idx", F.round("au_smooth_ma", 6).alias("au_smooth_ma"))


@query("w1_moving_average_drop", f"WITH {STREAMS_SQL} SELECT blockname, channel, sample_idx, round(au_smooth_ma, 6) AS au_smooth_ma FROM (SELECT *, {_averaged((1, 2), (2, 2))} FROM (SELECT *, {K_SQL} AS k FROM streams)) WHERE n = k")
def w1_moving_average_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = streams(spark, sf_dir)
    return signal.moving_average(s, _windows(s), edges="drop").select("blockname", "channel", "sample_idx", F.round("au_smooth_ma", 6).alias("au_smooth_ma"))


@query("w2_moving_average_log", f"WITH {STREAMS_SQL}, log AS (SELECT 'b' || s_suppkey AS blockname, CAST(2 + s_nationkey % 3 AS DOUBLE) AS freq FROM supplier), k AS (SELECT s.*, CAST(round(freq * 1.5) AS INTEGER) AS k FROM streams s JOIN log USING (blockname)) SELECT blockname, channel, sample_idx, round(CASE k WHEN 3 THEN avg(raw_au) OVER (w ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) WHEN 5 THEN avg(raw_au) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) WHEN 6 THEN avg(raw_au) OVER (w ROWS BETWEEN 3 PRECEDING AND 2 FOLLOWING) END, 6) AS au_smooth_ma FROM k WINDOW w AS (PARTITION BY blockname, channel ORDER BY sample_idx)")
def w2_moving_average_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = streams(spark, sf_dir)
    log = spark.read.parquet(f"{sf_dir}/supplier.parquet").select(F.concat(F.lit("b"), "s_suppkey").alias("blockname"), (2 + F.col("s_nationkey") % 3).cast("double").alias("freq"))
    windows = s.select("blockname", "channel").distinct().join(log, "blockname").select("blockname", "channel", F.round(F.col("freq") * 1.5).alias("k"))
    return signal.moving_average(s, windows).select("blockname", "channel", "sample_idx", F.round("au_smooth_ma", 6).alias("au_smooth_ma"))


@query("w3_moving_zscore", f"WITH {STREAMS_SQL} SELECT blockname, channel, sample_idx, round(CASE WHEN n = 12 AND sd > 0 THEN (raw_au - mu) / sd END, 6) AS raw_au_moving FROM (SELECT *, avg(raw_au) OVER w AS mu, stddev_samp(raw_au) OVER w AS sd, count(*) OVER w AS n FROM streams WINDOW w AS (PARTITION BY blockname, channel ORDER BY sample_idx ROWS BETWEEN 12 PRECEDING AND 1 PRECEDING))")
def w3_moving_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    z = signal.moving_zscore(streams(spark, sf_dir), 12, "raw_au", signal.SESSION)
    return z.select("blockname", "channel", "sample_idx", F.round("raw_au_moving", 6).alias("raw_au_moving"))


TIMED_SQL = f"{STREAMS_SQL}, timed AS (SELECT *, (sample_idx + 1) / 10.0::DOUBLE AS time FROM streams)"


def timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = streams(spark, sf_dir)
    return signal.sample_time(s, s.select("blockname", "channel").distinct().withColumn("fs", F.lit(FS)))


@query("w4_sample_time", f"WITH {TIMED_SQL} SELECT blockname, channel, sample_idx, round(time, 6) AS time FROM timed")
def w4_sample_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timed(spark, sf_dir).select("blockname", "channel", "sample_idx", F.round("time", 6).alias("time"))


PAIRED_SQL = f"""{TIMED_SQL}, parts AS (SELECT *, CASE WHEN channel LIKE '%C' THEN '2' ELSE '1' END AS fiber_id, substr(channel, 2, 3) AS wave FROM timed WHERE time > 0.5),
paired AS (SELECT blockname, fiber_id, sample_idx, time, '465' AS signal_wavelength, '405' AS control_wavelength, max(raw_au) FILTER (wave = '465') AS signal, max(raw_au) FILTER (wave = '405') AS control
  FROM parts WHERE wave IN ('465', '405') GROUP BY blockname, fiber_id, sample_idx, time HAVING count(DISTINCT wave) = 2)"""


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = timed(spark, sf_dir)
    signals = s.select("blockname").distinct().select("blockname", F.lit("465").alias("signal_wavelength"), F.lit("405").alias("control_wavelength"))
    return signal.paired(s, signals, "raw_au", F.lit(0.5))


@query("a8_paired_signals", f"WITH {PAIRED_SQL} SELECT * FROM paired")
def a8_paired_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pairs(spark, sf_dir)


@query("a5_linear_fit", f"WITH {PAIRED_SQL}, f AS (SELECT blockname, fiber_id, regr_slope(signal, control) AS b, regr_intercept(signal, control) AS a FROM paired GROUP BY ALL) SELECT blockname, fiber_id, sample_idx, round(a + b * control, 3) AS control_fitted FROM paired JOIN f USING (blockname, fiber_id)")
def a5_linear_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = signal.polynomial_fit(saved(pairs(spark, sf_dir), "pairs"), ["blockname", "fiber_id"], "control", "signal", 1, "control_fitted")
    return out.select("blockname", "fiber_id", "sample_idx", F.round("control_fitted", 3).alias("control_fitted"))


@query("a6_huber_fit")
def a6_huber_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signal.huber_fit(saved(pairs(spark, sf_dir), "pairs"), signal.FIT_KEYS, "control", "signal", "control_fitted")


def stationary(rows: DataFrame, keys: list[str], rest: Column) -> DataFrame:
    """(keys, n, stationary): whether the residuals `rest` of a robust fit, with its state beside them, leave
    Huber's joint loss no slope, neither in the coefficients nor in the scale."""
    t, bound = (F.col("control") - F.col("_m")) / F.col("_s"), signal.EPSILON * F.col("_sigma")
    rows = rows.withColumn("_r", rest).withColumn("_psi", F.greatest(-bound, F.least(bound, F.col("_r"))) / F.col("_sigma")).withColumn("_t", t)
    slopes = [F.sum(F.col("_psi") * F.col("_t") ** k).alias(f"_g{k}") for k in range(5)] + [F.sum(F.abs(F.col("_psi") * F.col("_t") ** k)).alias(f"_w{k}") for k in range(5)]
    scale = F.sum(F.when(F.abs("_r") <= bound, (F.col("_r") / F.col("_sigma")) ** 2).otherwise(signal.EPSILON**2))
    told = rows.groupBy(*keys, "_c", "_sigma").agg(F.count("*").alias("n"), *slopes, scale.alias("_scale"))
    flat = F.lit(True)
    for k in range(5):
        flat = flat & (F.abs(F.col(f"_g{k}") - (signal.ALPHA * F.element_at("_c", k + 1) if k else 0)) <= 1e-5 * (1 + F.col(f"_w{k}")))
    # A scale at its floor belongs to points that the curve meets exactly.
    return told.select(*keys, "n", (flat & ((F.col("_sigma") <= 1e-9) | (F.abs(F.col("_scale") - F.col("n")) <= 1e-5 * F.col("n")))).alias("stationary"))


@query("a6_huber_optimum", f"WITH {PAIRED_SQL} SELECT blockname, fiber_id, count(*) AS n, true AS stationary FROM paired GROUP BY ALL")
def a6_huber_optimum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether every group's robust fit is where its loss is least."""
    own, keys = saved(pairs(spark, sf_dir), "pairs"), ["blockname", "fiber_id"]
    return stationary(met(own, signal.huber_states(own, keys, "control", "signal"), keys), keys, F.col("signal") - signal.polynomial("_c", 4, (F.col("control") - F.col("_m")) / F.col("_s")))


A7_SQL = "round((signal - m) / s, 6) AS signal_zscore, round((signal - m) / (100 + m), 9) AS signal_dff"


@query("a7_normalised", f"WITH {PAIRED_SQL}, st AS (SELECT blockname, fiber_id, avg(signal) AS m, nullif(stddev_samp(signal), 0) AS s FROM paired GROUP BY ALL) SELECT blockname, fiber_id, sample_idx, {A7_SQL} FROM paired JOIN st USING (blockname, fiber_id)")
def a7_normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = signal.normalised(saved(pairs(spark, sf_dir), "pairs"), ["blockname", "fiber_id"], ["signal"])
    return out.select("blockname", "fiber_id", "sample_idx", F.round("signal_zscore", 6).alias("signal_zscore"), F.round("signal_dff", 9).alias("signal_dff"))


def _scores(delta: str, value: str) -> str:
    w = "OVER (PARTITION BY blockname, fiber_id)"
    return f"round({value}, 2) AS {delta}, round(({value} - avg({value}) {w}) / nullif(stddev_samp({value}) {w}, 0), 5) AS {delta}_zscore, round(({value} - avg({value}) {w}) / (100 + avg({value}) {w}), 3) AS {delta}_dff"


@query("a8_streams_fitted", f"WITH {PAIRED_SQL}, {fit_sql('fc', 'paired', ['blockname', 'fiber_id'], 'control', {'control_fitted': 'signal'}, 3)}, {fit_sql('fits', 'fc', ['blockname', 'fiber_id'], 'time', {'poly_signal': 'signal', 'poly_control': 'control'}, 4)} SELECT blockname, fiber_id, sample_idx, {_scores('delta_signal_fitted_control', '(signal - control_fitted)')}, {_scores('delta_signal_poly', '(signal - poly_signal)')}, {_scores('delta_control_poly', '(control - poly_control)')} FROM fits")
def a8_streams_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = signal.fitted(saved(pairs(spark, sf_dir), "pairs"))
    digits = {"": 2, "_zscore": 5, "_dff": 3}
    return out.select("blockname", "fiber_id", "sample_idx", *[F.round(f"{d}{k}", n).alias(f"{d}{k}") for d in signal.DELTAS for k, n in digits.items()])


@query("a12_stream_info", f"WITH {TIMED_SQL} SELECT blockname, channel, count(*) AS size, round(min(time), 6) AS start_time, round(max(time), 6) AS end_time, round((count(*) - 1) / nullif(max(time) - min(time), 0), 6) AS fs FROM timed GROUP BY ALL")
def a12_stream_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = signal.stream_info(timed(spark, sf_dir))
    return out.select("blockname", "channel", "size", *[F.round(c, 6).alias(c) for c in ("start_time", "end_time", "fs")])


@query(
    "a1_downsample",
    f"""WITH {TIMED_SQL}, t0 AS (SELECT blockname, round_even(min(time), 2) AS t0 FROM timed GROUP BY 1),
m AS (SELECT blockname, channel, t0, CAST(ceil((time - t0) * 4.0) AS BIGINT) AS bin, avg(raw_au) AS raw_au FROM timed JOIN t0 USING (blockname) WHERE ceil((time - t0) * 4.0) > 0 GROUP BY ALL),
l AS (SELECT blockname, channel, max(bin) AS last FROM m GROUP BY ALL)
SELECT blockname, channel, round(t0 + bin / 4.0::DOUBLE, 6) AS time, round(raw_au, 6) AS raw_au FROM m JOIN l USING (blockname, channel) WHERE bin < last""",
)
def a1_downsample(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bins.downsample(timed(spark, sf_dir).drop("sample_idx"), 4.0, ["blockname", "channel"])
    return out.select("blockname", "channel", F.round("time", 6).alias("time"), F.round("raw_au", 6).alias("raw_au"))


HOUR = 3_600_000_000


@query("a2_resample", f"WITH {EVENTS_SQL} SELECT blockname, CAST(ceil(event_us / {6 * HOUR}.0::DOUBLE) AS BIGINT) * {6 * HOUR} AS event_us, round(avg(round(value * 100)), 6) AS value FROM ev WHERE event_us > 0 GROUP BY ALL")
def a2_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("value", F.round(F.col("value") * 100))
    return bins.resample(e, ["blockname"], "event_us", "value", 6 * HOUR).withColumn("value", F.round("value", 6))


@query(
    "a3_rebin",
    f"""WITH {EVENTS_SQL}, rel AS (SELECT event_id_char, event_us - {24 * HOUR} AS rel, round(value * 100) AS v FROM ev),
b AS (SELECT event_id_char, CAST(ceil((rel + {6 * HOUR}) / {2 * HOUR}.0::DOUBLE) AS BIGINT) AS bin, avg(v) AS value FROM rel GROUP BY ALL)
SELECT event_id_char, bin * {2 * HOUR} - {6 * HOUR} AS rel_time_bin, round(value, 6) AS value FROM b WHERE bin > 0 AND bin * {2 * HOUR} <= {18 * HOUR} AND bin < (SELECT max(bin) FROM b WHERE bin > 0 AND bin * {2 * HOUR} <= {18 * HOUR})""",
)
def a3_rebin(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).select("event_id_char", (F.col("event_us") - 24 * HOUR).alias("rel"), F.round(F.col("value") * 100).alias("value"))
    return bins.rebin(e, ["event_id_char"], "rel", 6 * HOUR, 12 * HOUR, 2 * HOUR, ["value"]).withColumn("value", F.round("value", 6))


@query(
    "a4_binned_counts",
    f"""WITH {EVENTS_SQL}, c AS (SELECT blockname, event_id_char, CAST(ceil(event_us / {HOUR * 12}.0::DOUBLE) AS BIGINT) AS bin, count(*) AS n FROM ev GROUP BY ALL)
SELECT g.blockname, t.event_id_char, (k.bin - 1) * {HOUR * 12} AS event_bin, coalesce(n, 0) AS event_count
FROM (SELECT DISTINCT blockname FROM ev) g CROSS JOIN (SELECT DISTINCT event_id_char FROM ev) t CROSS JOIN (SELECT unnest(range(1, 15)) AS bin) k LEFT JOIN c ON c.blockname = g.blockname AND c.event_id_char = t.event_id_char AND c.bin = k.bin""",
)
def a4_binned_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bins.binned_counts(events(spark, sf_dir), ["blockname", "event_id_char"], "event_us", 0, 14 * 12 * HOUR, 12 * HOUR)


@query(
    "w10_interpolate",
    f"""WITH {EVENTS_SQL}, one AS (SELECT blockname, event_us, avg(round(value * 100)) AS v FROM ev GROUP BY ALL),
seg AS (SELECT *, lead(event_us) OVER w AS nx, lead(v) OVER w AS nv, min(event_us) OVER (PARTITION BY blockname) AS t0 FROM one WINDOW w AS (PARTITION BY blockname ORDER BY event_us)),
grid AS (SELECT blockname, t0, unnest(range(0, CAST(floor((max(event_us) - t0) / {6 * HOUR}.0::DOUBLE) AS BIGINT) + 1)) * {6 * HOUR} + t0 AS at FROM seg GROUP BY blockname, t0)
SELECT g.blockname, g.at AS event_us, round(CASE WHEN s.nx IS NULL THEN s.v ELSE s.v + (s.nv - s.v) * (g.at - s.event_us) / (s.nx - s.event_us) END, 4) AS value
FROM grid g JOIN seg s ON s.blockname = g.blockname AND g.at >= s.event_us AND (s.nx IS NULL OR g.at < s.nx)""",
)
def w10_interpolate(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = events(spark, sf_dir).withColumn("value", F.round(F.col("value") * 100))
    return bins.interpolate(e, ["blockname"], "event_us", "value", 6 * HOUR).withColumn("value", F.round("value", 4))
