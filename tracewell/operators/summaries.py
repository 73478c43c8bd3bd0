"""Summaries by session, subject, day and trial."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def channel_config(streams: DataFrame, key: str = "blockname") -> DataFrame:
    """Label of a session's fibres and signal wavelengths."""
    n = streams.groupBy(key).agg(F.count_distinct("fiber_id").alias("_f"), F.count_distinct("signal_wavelength").alias("_s"))
    word = lambda c: F.when(F.col(c) == 1, "one").when(F.col(c) == 2, "two")
    return n.select(key, F.concat(word("_f"), F.lit("_fiber_"), word("_s"), F.lit("_signal")).alias("channel_config"))


def session_contents(rows: DataFrame, session: str = "session_name", block: str = "blockname", branch: str = "branch_id", time: str = "ts_comp") -> DataFrame:
    """Blocks of a session with their branches joined by `;`, first and last time."""
    return rows.groupBy(session, block).agg(F.concat_ws(";", F.sort_array(F.collect_set(F.col(branch).cast("string")))).alias("branches"), F.min(time).alias("start"), F.max(time).alias("end"))


def files_per_subject(log: DataFrame, subject: str = "subject", procedure: str = "procedure", file: str = "blockname") -> DataFrame:
    return log.select(subject, procedure, file).distinct().groupBy(subject, procedure).agg(F.count("*").alias("n_files"))


def most_days(log: DataFrame, subject: str = "subject", day: str = "day") -> DataFrame:
    return log.select(subject, day).distinct().groupBy(subject).agg(F.count("*").alias("n_days")).agg(F.max("n_days").alias("max_days"))


def lick_summary(trials: DataFrame, keys: list[str], trial: list[str], count: str) -> DataFrame:
    """Mean count and share of trials with any, over distinct trials."""
    one = trials.select(*keys, *trial, count).distinct()
    return one.groupBy(*keys).agg(F.avg(count).alias("mean_count"), F.avg(F.when(F.col(count) > 0, 1.0).otherwise(0.0)).alias("share_any"))


def trial_bins(df: DataFrame, keys: list[str], trial: str, edges: list[int], value: str) -> DataFrame:
    """Means by bins of the trial's number, right-closed between `edges`; a bin is named by its left
    edge and half the second edge."""
    at = F.when(F.lit(False), 0.0)
    for low, high in zip(edges, edges[1:], strict=False):
        at = at.when((F.col(trial) > low) & (F.col(trial) <= high), float(low))
    return df.withColumn("trial_bin", at + edges[1] / 2).where(F.col("trial_bin").isNotNull()).groupBy(*keys, "trial_bin").agg(F.avg(value).alias(value))


def mean_se(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Mean, standard error and count by group."""
    return df.groupBy(*keys).agg(F.avg(value).alias("mean"), (F.stddev_samp(value) / F.sqrt(F.count(value))).alias("se"), F.count(value).alias("n"))


def mean_se_over_subjects(df: DataFrame, keys: list[str], subject: str, value: str) -> DataFrame:
    """Mean and standard error over subjects of the subjects' means."""
    return mean_se(df.groupBy(*keys, subject).agg(F.avg(value).alias(value)), keys, value)


def window_means(df: DataFrame, keys: list[str], time: str, low: float, high: float, value: str) -> DataFrame:
    """Mean of a measure in an open window of relative time."""
    return df.where((F.col(time) > low) & (F.col(time) < high)).groupBy(*keys).agg(F.avg(value).alias(value))


def last_days(df: DataFrame, subject: str, day: str, n: int, value: str, keys: list[str] | None = None) -> DataFrame:
    """Mean over a subject's last `n` days."""
    rows = df.withColumn("_last", F.max(day).over(Window.partitionBy(subject))).where(F.col(day) > F.col("_last") - n)
    return rows.groupBy(subject, *(keys or [])).agg(F.avg(value).alias(value))


def active_bias(counts: DataFrame, keys: list[str], event: str, count: str, active: str, inactive: str) -> DataFrame:
    """Share of the active among both; a missing one counts as none."""
    wide = counts.groupBy(*keys).pivot(event, [active, inactive]).agg(F.sum(count))
    a, i = (F.coalesce(F.col(c), F.lit(0)) for c in (active, inactive))
    return wide.select(*keys, F.try_divide(a, a + i).alias("bias"))


def present(df: DataFrame, key: str, value: str) -> DataFrame:
    """Distinct values of each session, numbered."""
    return df.select(key, value).distinct().withColumn("n", F.row_number().over(Window.partitionBy(key).orderBy(value)))


def first_of_trials(df: DataFrame, trial: list[str], time: str) -> DataFrame:
    return df.withColumn("_m", F.min(time).over(Window.partitionBy(*trial))).where(F.col(time) == F.col("_m")).drop("_m")
