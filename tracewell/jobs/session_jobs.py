"""The whole job of a recording as queries, with settings that differ by session.

A session is a supplier; its settings follow from the supplier's key. An event's session is the user
of the same number, its time the time of day in the first ten seconds.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.jobs.orthogonal import fit_sql
from tracewell.jobs.registry import query
from tracewell.jobs.signal_jobs import stationary
from tracewell.operators import session, signal
from tracewell.operators.scan import met
from tracewell.sources.adapters import EVENTS_SQL, FS, STREAMS_SQL, events, streams


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(
        F.concat(F.lit("b"), k).alias("blockname"), (k % 5 != 0).cast("int").alias("include"), ((2 + k % 3) / FS).alias("smoothing_window"), F.lit("465").alias("signal_id01"),
        F.when(k % 2 == 1, "560").alias("signal_id02"), F.lit("405").alias("control_id"), (1 + k % 2).cast("int").alias("poly_degree_fitted_control"), (1 + k % 3).cast("int").alias("poly_degree_polyfit"),
        (k % 3 * 0.5).cast("double").alias("trim_time_start"), F.when(k % 2 == 1, 4.0).otherwise(2.0).alias("down_sampled_freq"), F.lit(1.0).alias("peth_pre"), (1.0 + k % 2).alias("peth_post"),
        F.when(k % 2 == 1, "airpuff_onset; cue_led").otherwise("shock_onset").alias("events_of_interest"),
    )


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_id_char")
    name = F.when(kind == "view", "airpuff_onset").when(kind == "click", "cue_led").when(kind == "error", "shock_onset").otherwise("opto_stim")
    return events(spark, sf_dir).select(F.regexp_replace("blockname", "^u", "b").alias("blockname"), name.alias("event_id_char"), (F.col("event_us") % 10_000_000).alias("event_us"), "event_id")


def _recording(spark: SparkSession, sf_dir: str, log: DataFrame | None = None) -> session.Recording:
    s = streams(spark, sf_dir)
    info = s.select("blockname", "channel").distinct().withColumn("fs", F.lit(FS))
    return session.processed(s, info, log if log is not None else _log(spark, sf_dir), _events(spark, sf_dir))


KEYS = ["blockname", "fiber_id", "signal_wavelength", "control_wavelength"]
LOG_SQL = """log AS (SELECT 'b' || s_suppkey AS blockname, 2 + s_suppkey % 3 AS k, s_suppkey % 2 = 1 AS odd, 1 + s_suppkey % 2 AS dc, 1 + s_suppkey % 3 AS dt, (s_suppkey % 3) * 0.5::DOUBLE AS trim, CASE WHEN s_suppkey % 2 = 1 THEN 4 ELSE 2 END AS rate,
  1000000 AS pre, 1000000 * (1 + s_suppkey % 2) AS post FROM supplier WHERE s_suppkey % 5 <> 0)"""
_AVG = "avg(raw_au) OVER (PARTITION BY blockname, channel ORDER BY sample_idx ROWS BETWEEN {} PRECEDING AND {} FOLLOWING)"
FITS_SQL = f"""{STREAMS_SQL}, {LOG_SQL},
smooth AS (SELECT streams.*, log.* EXCLUDE (blockname), (sample_idx + 1) / 10.0::DOUBLE AS time, CASE k WHEN 2 THEN {_AVG.format(1, 0)} WHEN 3 THEN {_AVG.format(1, 1)} ELSE {_AVG.format(2, 1)} END AS au FROM streams JOIN log USING (blockname)),
parts AS (SELECT *, CASE WHEN channel LIKE '%C' THEN '2' ELSE '1' END AS fiber_id, substr(channel, 2, 3) AS wave FROM smooth WHERE time > trim),
pairs AS (SELECT s.blockname, s.fiber_id, s.sample_idx, s.time, s.wave AS signal_wavelength, '405' AS control_wavelength, s.au AS signal, c.au AS control, s.dc, s.dt, s.rate, s.pre, s.post
  FROM parts s JOIN parts c ON s.blockname = c.blockname AND s.fiber_id = c.fiber_id AND s.sample_idx = c.sample_idx AND c.wave = '405' WHERE s.wave = '465' OR (s.wave = '560' AND s.odd)),
{fit_sql('fc', 'pairs', KEYS, 'control', {'control_fitted': 'signal'}, 2, 'dc')}, {fit_sql('fits', 'fc', KEYS, 'time', {'poly_signal': 'signal', 'poly_control': 'control'}, 3, 'dt')}"""


def _shown(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, F.round("signal", 4).alias("signal"), *[F.round(F.round(c, 6), 2).alias(c) for c in ("delta_signal_fitted_control", "delta_control_poly")])


# Means of few residuals often end in a half hundredth; the first rounding makes that half the same on both sides.
_SHOWN_SQL = "round(avg(signal), 4) AS signal, round(round(avg(signal - control_fitted), 6), 2) AS delta_signal_fitted_control, round(round(avg(control - poly_control), 6), 2) AS delta_control_poly"


@query(
    "r2_session_streams",
    f"""WITH {FITS_SQL}, t0 AS (SELECT blockname, round_even(min(time), 2) AS t0 FROM fits GROUP BY 1),
m AS (SELECT {', '.join(KEYS)}, t0, rate, CAST(ceil((time - t0) * CAST(rate AS DOUBLE)) AS BIGINT) AS bin, {_SHOWN_SQL} FROM fits JOIN t0 USING (blockname) WHERE ceil((time - t0) * CAST(rate AS DOUBLE)) > 0 GROUP BY ALL)
SELECT * EXCLUDE (t0, rate, bin), round(t0 + bin / CAST(rate AS DOUBLE), 6) AS time FROM m QUALIFY bin < max(bin) OVER (PARTITION BY blockname, fiber_id)""",
)
def r2_session_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _recording(spark, sf_dir).streams_session
    return _shown(out.withColumn("time", F.round("time", 6)), [*KEYS, "time"])


WANTED_SQL = f"""{EVENTS_SQL}, named AS (SELECT 'b' || substr(blockname, 2) AS blockname, CASE event_id_char WHEN 'view' THEN 'airpuff_onset' WHEN 'click' THEN 'cue_led' WHEN 'error' THEN 'shock_onset' ELSE 'opto_stim' END AS event_id_char, event_us % 10000000 AS event_us, event_id FROM ev),
wanted AS (SELECT n.*, row_number() OVER (PARTITION BY blockname, event_id_char ORDER BY event_us) AS event_number FROM named n JOIN log USING (blockname) WHERE CASE WHEN odd THEN event_id_char IN ('airpuff_onset', 'cue_led') ELSE event_id_char = 'shock_onset' END)"""


@query("r2_session_events", f"WITH {LOG_SQL}, {WANTED_SQL} SELECT blockname, event_id_char, event_us, event_number FROM wanted")
def r2_session_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recording(spark, sf_dir).events_peth.select("blockname", "event_id_char", "event_us", "event_number")


@query("r2_session_all_events", f"WITH {LOG_SQL}, {WANTED_SQL} SELECT blockname, event_id_char, event_us, row_number() OVER (PARTITION BY blockname, event_id_char ORDER BY event_us) AS event_number FROM named JOIN log USING (blockname)")
def r2_session_all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _recording(spark, sf_dir).events.select("blockname", "event_id_char", "event_us", "event_number")


@query(
    "r2_session_peth",
    f"""WITH {FITS_SQL}, {WANTED_SQL}, near AS (SELECT f.*, event_id_char, event_number, event_us, CAST(round(time * 1000000) AS BIGINT) - event_us AS rel FROM fits f JOIN wanted USING (blockname)),
m AS (SELECT {', '.join(KEYS)}, event_id_char, event_number, event_us, pre, rate, CAST(ceil((rel + pre) / (1000000.0::DOUBLE / rate)) AS BIGINT) AS bin, {_SHOWN_SQL} FROM near WHERE rel > -pre AND rel < post GROUP BY ALL)
SELECT * EXCLUDE (pre, rate, bin), CAST(bin * (1000000 // rate) - pre AS BIGINT) AS time_rel FROM m QUALIFY bin < max(bin) OVER (PARTITION BY blockname, event_id_char, event_number, event_us)""",
)
def r2_session_peth(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _recording(spark, sf_dir).streams_peth
    return _shown(out, [*KEYS, "event_id_char", "event_number", "event_us", "time_rel"])


@query(
    "r2_session_models",
    f"""WITH {FITS_SQL}, models AS (SELECT *, CASE WHEN CAST(substr(blockname, 2) AS BIGINT) % 4 = 1 THEN 'huber' ELSE 'polynomial' END AS fit_model FROM fits)
SELECT {', '.join(KEYS)}, fit_model, count(*) AS n, CASE WHEN fit_model = 'polynomial' THEN round(round(sqrt(sum((signal - control_fitted) ** 2) / count(*)), 6), 3) END AS spread, true AS stationary FROM models GROUP BY {', '.join(KEYS)}, fit_model""",
)
def r2_session_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions whose logs ask for the robust fit beside others: the spread of a polynomial's residuals,
    and whether each fit is where its own model's loss is least."""
    model = F.when(F.substring("blockname", 2, 20).cast("bigint") % 4 == 1, "huber").otherwise("polynomial")
    fits = _recording(spark, sf_dir, _log(spark, sf_dir).withColumn("fit_model", model)).fits.withColumn("fit_model", model)
    least = signal.huber_states(fits.where("fit_model = 'huber'"), KEYS, "control", "signal").select(*KEYS, "_m", "_s", "_c", "_sigma", "_n")
    rest, square = F.col("delta_signal_fitted_control"), F.col("delta_signal_fitted_control") ** 2
    both = met(fits.where("fit_model = 'huber'"), least.drop("_n"), KEYS)
    robust = stationary(both, KEYS, rest).withColumns({"fit_model": F.lit("huber"), "spread": F.lit(None).cast("double")})
    told = fits.where("fit_model = 'polynomial'").groupBy(*KEYS).agg(F.count("*").alias("n"), F.sqrt(F.sum(square) / F.count("*")).alias("_rms"), F.sum(rest).alias("_r"), F.sum(rest * F.col("control")).alias("_rc"), F.sum(F.abs(rest * F.col("control"))).alias("_all"))
    plain = told.select(*KEYS, F.lit("polynomial").alias("fit_model"), "n", F.round(F.round("_rms", 6), 3).alias("spread"), ((F.abs("_r") <= 1e-7 * (1 + F.col("_rms") * F.col("n"))) & (F.abs("_rc") <= 1e-6 * (1 + F.col("_all")))).alias("stationary"))
    return plain.unionByName(robust.select(plain.columns))
