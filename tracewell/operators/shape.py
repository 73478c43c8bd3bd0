"""Selections, reshapes, lookups and set operations on tidy tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def select_sessions(rows: DataFrame, log: DataFrame, names: list[str] | None = None, experiments: list[str] | None = None) -> DataFrame:
    """Rows of the sessions that the log includes, or of those among `names` / `experiments`."""
    kept = log.where(F.col("include") == 1)
    if names is not None:
        kept = kept.where(F.col("blockname").isin(names))
    if experiments is not None:
        kept = kept.where(F.col("experiment").isin(experiments))
    return rows.join(kept.select("blockname").distinct(), "blockname", "left_semi")


def session_signals(log: DataFrame) -> DataFrame:
    """One row a signal of a session, with the session's control."""
    ids = [c for c in log.columns if c.startswith("signal_id")]
    return log.unpivot(["blockname", "control_id"], ids, "signal", "signal_id").where(F.col("signal_id").isNotNull())


def bank_filter(rows: DataFrame, log: DataFrame, channel: str = "channel") -> DataFrame:
    """Channels of the bank that a multi-subject session uses: A/B where fiber_id01 is set, C/D where
    fiber_id02 is."""
    banks = log.select("blockname", F.col("fiber_id01").isNotNull().alias("_one"), F.col("fiber_id02").isNotNull().alias("_two"))
    met = rows.join(banks, "blockname").where((F.col("_one") & F.col(channel).rlike("[AB]")) | (F.col("_two") & F.col(channel).rlike("[CD]")))
    return met.drop("_one", "_two")


def bank_faults(log: DataFrame) -> DataFrame:
    """Multi-subject sessions with both banks set, or none."""
    both = F.col("fiber_id01").isNotNull().cast("int") + F.col("fiber_id02").isNotNull().cast("int")
    return log.where(F.col("blockname_multi_subject").isNotNull() & (both != 1)).select("blockname", both.alias("banks"))


def multi_subject_name() -> Column:
    return F.coalesce("blockname_multi_subject", "blockname")


def without(df: DataFrame, subjects: list[str], pairs: DataFrame | None = None) -> DataFrame:
    """Without some subjects, and without the (subject, channel_id) pairs of a table."""
    out = df.where(~F.col("subject").isin(subjects)) if subjects else df
    return out.join(pairs, ["subject", "channel_id"], "left_anti") if pairs is not None else out


def looked_up(column: str, names: dict[str, str]) -> Column:
    """A name's translation; unknown names stay."""
    table = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    return F.coalesce(F.try_element_at(table, F.col(column)), F.col(column))


def stream_channels(df: DataFrame, listed: list[str], name: str = "name") -> DataFrame:
    """Streams named with an underscore, three digits and a letter, or listed."""
    return df.where(F.col(name).rlike(r"_\d{3}[A-Za-z]") | F.col(name).isin(listed))


def traces(df: DataFrame, keys: list[str], measures: list[str], start: float | None = None, end: float | None = None, time: str = "time") -> DataFrame:
    """All measures in one long table, for a time range."""
    rows = df
    rows = rows.where(F.col(time) >= start) if start is not None else rows
    rows = rows.where(F.col(time) <= end) if end is not None else rows
    return rows.unpivot([*keys, time], measures, "measure", "value")


def unique_values(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.select(columns).distinct()


def day_number(df: DataFrame, day: str = "day", subject: str = "subject") -> DataFrame:
    """Days d01, d02, ... as numbers from the subject's first day on."""
    n = F.regexp_replace(day, "^d", "").try_cast("int")
    return df.withColumn(day, n - F.min(n).over(Window.partitionBy(subject)) + 1)


def day_from_dates(df: DataFrame, date: str = "date", subject: str = "subject") -> DataFrame:
    """Number of each date among the subject's dates; one small aggregate is numbered, not the rows."""
    dates = df.select(subject, date).distinct()
    dates = dates.withColumn("day", F.row_number().over(Window.partitionBy(subject).orderBy(date)))
    return df.join(dates, [subject, date], "left")


def first_rows(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    return df.withColumn("_k", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_k") <= n).drop("_k")


def last_rows(df: DataFrame, keys: list[str], order: list[str], n: int) -> DataFrame:
    return first_rows(df, keys, [F.desc(o) for o in order], n)


def sample_rows(df: DataFrame, keys: list[str], share: float) -> DataFrame:
    """A repeatable sample by a hash of the keys, whatever the partitions."""
    number = F.conv(F.substring(F.md5(F.concat_ws("|", *keys).cast("binary")), 1, 8), 16, 10).cast("long")
    return df.where(number % 10_000 < round(share * 10_000))


def united(tables: list[DataFrame]) -> DataFrame:
    """Union of differently shaped tables; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def difference(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(keys).distinct().join(b.select(keys).distinct(), keys, "left_anti")


def intersection(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    return a.select(keys).distinct().join(b.select(keys).distinct(), keys, "left_semi")


def fiber_site(df: DataFrame, log: DataFrame) -> DataFrame:
    """The site's name of a fibre, from the log's columns fiber_id01, fiber_id02, ..."""
    ids = [c for c in log.columns if c.startswith("fiber_id")]
    sites = log.unpivot("blockname", ids, "_fiber", "channel_id")
    return df.withColumn("_fiber", F.concat(F.lit("fiber_id0"), "fiber_id")).join(sites, ["blockname", "_fiber"], "left").drop("_fiber")


def clean_name(name: str) -> str:
    """A column's name in snake case."""
    import re

    spaced = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", name)
    return re.sub(r"_+", "_", re.sub(r"[^0-9A-Za-z]+", "_", spaced)).strip("_").lower()


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def wavelength_colour(wavelength: Column, gamma: float = 0.8) -> Column:
    """RGB hex code of a wavelength in nanometres; black outside 380 to 750."""
    w = wavelength.cast("double")
    violet, red = 0.3 + 0.7 * (w - 380) / 60, 0.3 + 0.7 * (750 - w) / 105
    bands = [
        (440, F.pow((440 - w) / 60 * violet, F.lit(gamma)), F.lit(0.0), F.pow(violet, F.lit(gamma))),
        (490, F.lit(0.0), F.pow((w - 440) / 50, F.lit(gamma)), F.lit(1.0)),
        (510, F.lit(0.0), F.lit(1.0), F.pow((510 - w) / 20, F.lit(gamma))),
        (580, F.pow((w - 510) / 70, F.lit(gamma)), F.lit(1.0), F.lit(0.0)),
        (645, F.lit(1.0), F.pow((645 - w) / 65, F.lit(gamma)), F.lit(0.0)),
        (750, F.pow(red, F.lit(gamma)), F.lit(0.0), F.lit(0.0)),
    ]
    parts = []
    for k in (1, 2, 3):
        value = F.when((w < 380) | (w > 750) | w.isNull(), 0.0)
        for band in bands:
            value = value.when(w <= band[0], band[k])
        parts.append(F.lpad(F.hex(F.floor(value * 255)), 2, "0"))
    return F.concat(F.lit("#"), *parts)
