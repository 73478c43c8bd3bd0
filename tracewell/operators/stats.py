"""Grouped statistics: one row a group and test.

Statistics, degrees of freedom and estimates are Spark aggregates over all groups at once; only
p-values and confidence limits, which need a distribution, come from a helper on the one-row-a-group
result. Rows with a null in a tested column don't count.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, StructField, StructType

from tracewell.functions import dist
from tracewell.operators.scan import met, ranges
from tracewell.sources.scratch import saved

CHUNK = 1 << 20  # rows of a series in one window partition


def with_values(df: DataFrame, columns: dict[str, Callable[[pd.Series], float]]) -> DataFrame:
    """Adds double columns worked out row by row on a result of one row a group."""
    schema = StructType([*df.schema.fields, *[StructField(c, DoubleType()) for c in columns]])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = b.to_dict("records")
            for name, f in columns.items():
                values = [_or_none(f, r) for r in rows]
                b[name] = pd.Series(values, dtype=float)
            yield b

    return df.mapInPandas(run, schema)


def _or_none(f: Callable, row: dict) -> float | None:
    try:
        value = f(row)
        return None if value is None or value != value else float(value)
    except (TypeError, ValueError, ZeroDivisionError, OverflowError):
        return None


def t_paired(df: DataFrame, keys: list[str], a: str, b: str, p_value: bool = True) -> DataFrame:
    """Paired t test of a - b: estimate, statistic, parameter (df), limits, p."""
    d = (F.col(a) - F.col(b)).alias("_d")
    out = df.select(*keys, d).where("_d IS NOT NULL").groupBy(*keys).agg(F.avg("_d").alias("estimate"), F.stddev_samp("_d").alias("_s"), F.count("*").alias("n"))
    out = out.withColumn("_e", F.col("_s") / F.sqrt("n")).withColumn("statistic", F.try_divide("estimate", "_e")).withColumn("parameter", (F.col("n") - 1).cast("double"))
    return _t_finish(out, p_value)


def _t_finish(out: DataFrame, p_value: bool) -> DataFrame:
    if p_value:
        out = with_values(out, {"p_value": lambda r: dist.t_two_sided(r["statistic"], r["parameter"]), "conf_low": lambda r: r["estimate"] - dist.t_quantile(0.975, r["parameter"]) * r["_e"], "conf_high": lambda r: r["estimate"] + dist.t_quantile(0.975, r["parameter"]) * r["_e"]})
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def _welch(out: DataFrame, p_value: bool) -> DataFrame:
    va, vb = F.col("_va") / F.col("n1"), F.col("_vb") / F.col("n2")
    out = out.withColumns({"estimate": F.col("estimate1") - F.col("estimate2"), "_e": F.sqrt(va + vb)})
    out = out.withColumns({"statistic": F.try_divide("estimate", "_e"), "parameter": F.try_divide((va + vb) * (va + vb), va * va / (F.col("n1") - 1) + vb * vb / (F.col("n2") - 1))})
    return _t_finish(out, p_value)


def t_welch(df: DataFrame, keys: list[str], a: str, b: str, p_value: bool = True) -> DataFrame:
    """Welch's t test of two columns."""
    sides = [g(c).alias(n) for c, n1, n2, n3 in ((a, "estimate1", "_va", "n1"), (b, "estimate2", "_vb", "n2")) for g, n in ((F.avg, n1), (F.var_samp, n2), (F.count, n3))]
    return _welch(df.groupBy(*keys).agg(*sides), p_value)


def t_grouped(df: DataFrame, keys: list[str], factor: str, value: str, p_value: bool = True) -> DataFrame:
    """Welch's t test of a value between the two levels of a factor; the first level in order is
    estimate1. Groups without exactly two levels have null statistics and `levels` tells why."""
    known = df.where(F.col(factor).isNotNull() & F.col(value).isNotNull())
    ends = known.groupBy(*keys).agg(F.min(factor).alias("_a"), F.max(factor).alias("_b"), F.count_distinct(factor).alias("levels"))
    rows = met(known, ends, keys)
    first, second = F.when(F.col(factor) == F.col("_a"), F.col(value)), F.when((F.col(factor) == F.col("_b")) & (F.col("levels") == 2), F.col(value))
    out = rows.groupBy(*keys, "levels").agg(F.avg(first).alias("estimate1"), F.var_samp(first).alias("_va"), F.count(first).alias("n1"), F.avg(second).alias("estimate2"), F.var_samp(second).alias("_vb"), F.count(second).alias("n2"))
    return _welch(out, p_value)


def correlation(df: DataFrame, keys: list[str], x: str, y: str, p_value: bool = True) -> DataFrame:
    """Pearson's r with its limits, and slope and intercept of y on x."""
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    out = known.groupBy(*keys).agg(F.corr(x, y).alias("estimate"), F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.count("*").alias("n"))
    out = out.withColumn("parameter", (F.col("n") - 2).cast("double"))
    out = out.withColumn("statistic", F.when((F.col("n") > 2) & (F.abs("estimate") < 1), F.col("estimate") * F.sqrt(F.col("parameter") / (1 - F.col("estimate") * F.col("estimate")))))
    z, se = F.atanh("estimate"), 1.959963984540054 / F.sqrt(F.when(F.col("n") > 3, F.col("n") - 3))
    out = out.withColumns({"conf_low": F.tanh(z - se), "conf_high": F.tanh(z + se)})
    return with_values(out, {"p_value": lambda r: dist.t_two_sided(r["statistic"], r["parameter"])}) if p_value else out


def cumulated(rows: DataFrame, keys: list[str], value: str, sums: list[str]) -> DataFrame:
    """Adds `_before_<c>`, the sum of c over the rows ahead of each in its group's order by value, and
    `_whole_<c>`, that of the group. Large groups are cut in ranges of their values; sums run within a
    range, and a small table of the ranges' sums adds the rest, so no task sorts one. Null keys are a group.
    """
    if not keys:
        return cumulated(rows.withColumn("_one_group", F.lit(0)), ["_one_group"], value, sums).drop("_one_group")
    placed, many = ranges(rows, keys, value)
    inside = Window.partitionBy(*keys, "_cut").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    own = placed.withColumns({f"_before_{c}": F.coalesce(F.sum(c).over(inside), F.lit(0)) for c in sums})
    if not many:
        whole = Window.partitionBy(*keys, "_cut").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        return own.withColumns({f"_whole_{c}": F.sum(c).over(whole) for c in sums}).drop("_cut")
    totals = placed.groupBy(*keys, "_cut").agg(*[F.sum(c).alias(c) for c in sums])
    ahead, all_ = Window.partitionBy(*keys).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy(*keys)
    totals = saved(totals.select(*keys, "_cut", *[F.coalesce(F.sum(c).over(ahead), F.lit(0)).alias(f"_ahead_{c}") for c in sums], *[F.sum(c).over(all_).alias(f"_whole_{c}") for c in sums]), "range-sums")
    out = met(own, totals, [*keys, "_cut"])
    return out.withColumns({f"_before_{c}": F.col(f"_before_{c}") + F.col(f"_ahead_{c}") for c in sums}).drop("_cut", *[f"_ahead_{c}" for c in sums])


def cross_correlation(df: DataFrame, keys: list[str], order: str, x: str, y: str, lags: int) -> DataFrame:
    """Correlation of x at t + lag with y at t for lags from -`lags` to `lags`: products are divided
    by the whole length and by the deviations of the whole series. `order` numbers the rows, which
    lags need; rows with a null don't count. Numbered rows are cut in chunks with the rows just outside
    as a halo, and all lags come from one sort."""
    known = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).withColumn("_n", F.lit(1))
    at = cumulated(known.select(*keys, F.col(order).alias("_o"), F.col(x).alias("_x"), F.col(y).alias("_y"), "_n"), keys, "_o", ["_n"])
    at = at.select(*keys, "_x", "_y", F.col("_before__n").alias("_i"))
    stats = at.groupBy(*keys).agg(F.avg("_x").alias("_mx"), F.avg("_y").alias("_my"), F.stddev_pop("_x").alias("_sx"), F.stddev_pop("_y").alias("_sy"), F.count("*").alias("_n"))
    chunk = max(CHUNK, lags)
    own = F.floor(F.col("_i") / chunk)
    halo = at.withColumn("_own", own).withColumn("_chunk", F.explode(F.array_distinct(F.array(own, F.floor((F.col("_i") - lags) / chunk), F.floor((F.col("_i") + lags) / chunk)))))
    on = Window.partitionBy(*keys, "_chunk").orderBy("_i")
    steps = range(-lags, lags + 1)
    near = met(halo.withColumns({f"_x{k + lags}": F.lead("_x", k).over(on) for k in steps}).where("_chunk = _own"), stats, keys)
    sums = near.groupBy(*keys, "_n", "_sx", "_sy").agg(*[F.sum((F.col(f"_x{k + lags}") - F.col("_mx")) * (F.col("_y") - F.col("_my"))).alias(f"_s{k + lags}") for k in steps])
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"_s{k + lags}").alias("_s")) for k in steps]))
    out = sums.select(*keys, "_n", "_sx", "_sy", pairs.alias("_p")).select(*keys, "_n", "_sx", "_sy", "_p.*").where("_s IS NOT NULL")
    return out.select(*keys, "lag", F.try_divide(F.col("_s"), F.col("_n") * F.col("_sx") * F.col("_sy")).alias("acf"))


def ks(df: DataFrame, keys: list[str], a: str, b: str, p_value: bool = True) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov statistic of two columns, from running counts over distinct
    values, so ties cost one row."""
    both = df.select(*keys, F.explode(F.array(F.struct(F.col(a).cast("double").alias("v"), F.lit(1).alias("one")), F.struct(F.col(b).cast("double").alias("v"), F.lit(0).alias("one")))).alias("_s")).select(*keys, "_s.*").where("v IS NOT NULL")
    counts = both.groupBy(*keys, "v").agg(F.sum("one").alias("_a"), F.sum(1 - F.col("one")).alias("_b"))
    run = cumulated(counts, keys, "v", ["_a", "_b"])
    run = run.select(*keys, (F.col("_before__a") + F.col("_a")).alias("_ca"), (F.col("_before__b") + F.col("_b")).alias("_cb"), F.col("_whole__a").alias("_na"), F.col("_whole__b").alias("_nb"))
    out = run.groupBy(*keys).agg(F.max(F.abs(F.try_divide("_ca", "_na") - F.try_divide("_cb", "_nb"))).alias("statistic"), F.max("_na").alias("n1"), F.max("_nb").alias("n2"))
    return with_values(out, {"p_value": lambda r: dist.kolmogorov_upper(r["statistic"], r["n1"] * r["n2"] / (r["n1"] + r["n2"]))}) if p_value else out


def ranked(df: DataFrame, keys: list[str], value: str, mark: str) -> DataFrame:
    """(keys, mark, _n, _ties, _rank): for each value of a group and each mark (a column of few values)
    the number of its rows, that of all rows with the value, and their average rank. Equal values are
    counted before they are ordered."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value, mark).agg(F.count("*").alias("_n"))
    values = counts.groupBy(*keys, value).agg(F.sum("_n").alias("_ties"), F.collect_list(F.struct(F.col(mark).alias("mark"), F.col("_n").alias("n"))).alias("_marks"))
    run = cumulated(values, keys, value, ["_ties"])
    out = run.select(*keys, "_ties", (F.col("_before__ties") + (F.col("_ties") + 1) / 2).alias("_rank"), F.explode("_marks").alias("_m"))
    return out.select(*keys, F.col("_m.mark").alias(mark), F.col("_m.n").alias("_n"), "_ties", "_rank")


def kruskal(df: DataFrame, keys: list[str], value: str, group: str, p_value: bool = True) -> DataFrame:
    """Kruskal-Wallis statistic, corrected for ties."""
    rows = ranked(df.where(F.col(group).isNotNull()), keys, value, group)
    per = rows.groupBy(*keys, group).agg(F.sum(F.col("_rank") * F.col("_n")).alias("_r"), F.sum("_n").alias("_n"), F.sum(F.col("_n") * (F.col("_ties") * F.col("_ties") - 1)).alias("_t"))
    out = per.groupBy(*keys).agg(F.sum(F.col("_r") * F.col("_r") / F.col("_n")).alias("_q"), F.sum("_n").alias("n"), F.count("*").alias("_g"), F.sum("_t").alias("_t"))
    n = F.col("n").cast("double")
    h = F.try_divide(12 * F.col("_q") / (n * (n + 1)) - 3 * (n + 1), 1 - F.try_divide(F.col("_t"), n * n * n - n))
    out = out.select(*keys, h.alias("statistic"), (F.col("_g") - 1).cast("double").alias("parameter"), "n")
    return with_values(out, {"p_value": lambda r: dist.chi2_upper(r["statistic"], r["parameter"])}) if p_value else out


def rank_sum(df: DataFrame, keys: list[str], a: str, b: str, p_value: bool = True, exact: bool = True) -> DataFrame:
    """Wilcoxon's rank-sum W of two columns; p is exact below 50 rows a side without ties, else normal
    with continuity correction."""
    both = df.select(*keys, F.explode(F.array(F.struct(F.col(a).cast("double").alias("v"), F.lit(1).alias("one")), F.struct(F.col(b).cast("double").alias("v"), F.lit(0).alias("one")))).alias("_s")).select(*keys, "_s.*")
    return _rank_sum(both.where("v IS NOT NULL"), keys, p_value, exact)


def _rank_sum(both: DataFrame, keys: list[str], p_value: bool, exact: bool) -> DataFrame:
    rows = ranked(both, keys, "v", "one")
    of = lambda one: F.sum(F.when(F.col("one") == one, F.col("_n")).otherwise(0))
    out = rows.groupBy(*keys).agg(F.sum(F.when(F.col("one") == 1, F.col("_rank") * F.col("_n"))).alias("_r"), of(1).alias("n1"), of(0).alias("n2"), F.sum((F.col("_n") * (F.col("_ties") * F.col("_ties") - 1)).cast("double")).alias("_t"))
    out = out.select(*keys, (F.col("_r") - F.col("n1") * (F.col("n1") + 1) / 2).alias("statistic"), "n1", "n2", F.col("_t").alias("ties"))

    def p(r: dict) -> float:
        if exact and r["n1"] < 50 and r["n2"] < 50 and r["ties"] == 0:
            return dist.rank_sum_exact(r["statistic"], int(r["n1"]), int(r["n2"]))
        return dist.rank_sum_normal(r["statistic"], r["n1"], r["n2"], r["ties"])

    return with_values(out, {"p_value": p}) if p_value else out


def signed_rank(df: DataFrame, keys: list[str], a: str, b: str, p_value: bool = True) -> DataFrame:
    """Wilcoxon's signed-rank V of a - b, zeros dropped."""
    d = df.select(*keys, (F.col(a) - F.col(b)).alias("_d")).where("_d IS NOT NULL AND _d <> 0").withColumns({"_abs": F.abs("_d"), "_up": F.col("_d") > 0})
    rows = ranked(d, keys, "_abs", "_up")
    out = rows.groupBy(*keys).agg(F.sum(F.when(F.col("_up"), F.col("_rank") * F.col("_n")).otherwise(0)).alias("statistic"), F.sum("_n").alias("n"), F.sum((F.col("_n") * (F.col("_ties") * F.col("_ties") - 1)).cast("double")).alias("ties"))

    def p(r: dict) -> float:
        if r["n"] < 50 and r["ties"] == 0:
            return dist.signed_rank_exact(r["statistic"], int(r["n"]))
        return dist.signed_rank_normal(r["statistic"], r["n"], r["ties"])

    return with_values(out, {"p_value": p}) if p_value else out


def pairwise_rank_sum(df: DataFrame, keys: list[str], value: str, group: str, p_value: bool = True) -> DataFrame:
    """Rank-sum tests of all pairs of a factor's levels, ranked anew for each pair, normal p without
    adjustment. Levels are few; rows meet their level's pairs in an equi-join."""
    known = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    levels = known.select(*keys, F.col(group).alias("_l")).distinct()
    pairs = met(levels.withColumnRenamed("_l", "group1"), levels.withColumnRenamed("_l", "group2"), keys).where("group1 < group2")
    sides = pairs.select(*keys, "group1", "group2", F.explode(F.array(F.struct(F.col("group1").alias("_l"), F.lit(1).alias("one")), F.struct(F.col("group2").alias("_l"), F.lit(0).alias("one")))).alias("_s")).select(*keys, "group1", "group2", "_s.*")
    both = met(known.select(*keys, F.col(group).alias("_l"), F.col(value).cast("double").alias("v")), sides, [*keys, "_l"])
    return _rank_sum(both, [*keys, "group1", "group2"], p_value, exact=False)


CURVE = 1 << 16  # distinct x of a group whose curve is fitted in one task


def sigmoid(df: DataFrame, keys: list[str], x: str, y: str, points: int = 100, low: float = 0.0, high: float = 30.0, rounds: int = 200) -> DataFrame:
    """Logistic curve asym / (1 + exp((xmid - x) / scal)) fitted a group by damped Gauss-Newton: its
    coefficients and predictions on a grid; nulls where it doesn't converge.

    Means of y by x are taken first. Groups of up to CURVE distinct x are fitted each in one task. For larger
    ones every round is one aggregate of the normal equations at the groups' next coefficients, and a small
    table of a row a group, written each round, holds what is known of them. Both ways take the same steps."""
    means = df.where(F.col(x).isNotNull() & F.col(y).isNotNull()).groupBy(*keys, F.col(x).cast("double").alias("_x")).agg(F.avg(y).cast("double").alias("_y"), F.count("*").cast("double").alias("_w"))
    means = saved(means, "curve-means")
    sizes = saved(means.groupBy(*keys).agg(F.count("*").alias("_n")), "curve-sizes")
    kinds = dict(df.dtypes)
    named = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + ", " * bool(keys)

    def alone(rows: pa.Table) -> pa.Table:
        found = _logistic(*(rows.column(c).to_numpy() for c in ("_x", "_y", "_w")), rounds)
        return rows.slice(0, 1).select(keys).append_column("_b", pa.array([found], pa.list_(pa.float64())))

    fits = met(means, sizes.where(F.col("_n") <= CURVE), keys, "left_semi").groupBy(*keys).applyInArrow(alone, f"{named}_b array<double>")
    large = sizes.where(F.col("_n") > CURVE)
    if not large.isEmpty():
        fits = fits.unionByName(_large_curves(met(means, large, keys, "left_semi"), keys, rounds))
    b = [F.element_at("_b", k) for k in (1, 2, 3)]
    grid = F.explode(F.array(*[F.lit(float(v)) for v in np.linspace(low, high, points)])).alias("x")
    out = fits.select(*keys, *[v.alias(n) for v, n in zip(b, ("asym", "xmid", "scal"), strict=True)], grid)
    power = F.greatest(F.lit(-700.0), F.least(F.lit(700.0), (F.col("xmid") - F.col("x")) / F.col("scal")))
    return out.withColumn("y", F.when(F.col("asym").isNotNull(), F.col("asym") / (1 + F.exp(power))))


def _large_curves(means: DataFrame, keys: list[str], rounds: int) -> DataFrame:
    """(keys, _b) of groups of any size, a round of all of them at a time."""
    top = F.when(F.max("_y") > 0, F.max("_y") * 1.05).otherwise(1.0)
    tops = saved(means.groupBy(*keys).agg(top.alias("_top"), (F.max("_y") > F.min("_y")).alias("_varies"), F.count("*").alias("_n")), "curve-tops")
    inside = met(means, tops, keys).where((F.col("_y") > 0) & (F.col("_y") < F.col("_top"))).withColumn("_z", F.log(F.col("_y") / (F.col("_top") - F.col("_y"))))
    lines = inside.groupBy(*keys, "_top", "_varies", "_n").agg(F.regr_slope("_z", "_x").alias("_m"), F.regr_intercept("_z", "_x").alias("_c"), F.count("*").alias("_in"))
    begin = F.when((F.col("_n") >= 4) & F.col("_varies") & (F.col("_in") >= 2) & (F.col("_m") != 0), F.array(F.col("_top"), -F.col("_c") / F.col("_m"), 1 / F.col("_m")))
    none = {"_b": "array<double>", "_held": "array<double>", "_loss": "double"}
    state = lines.select(*keys, begin.alias("_new")).withColumns({c: F.lit(None).cast(t) for c, t in none.items()} | {"_damp": F.lit(1e-3)}).where("_new IS NOT NULL")
    state = saved(state, "curve")
    done = met(tops.select(*keys), state, keys, "left_anti").withColumn("_b", F.lit(None).cast("array<double>"))
    schema = StructType([*state.schema.fields, StructField("_done", BooleanType())])

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [r | _logistic_step(r) for r in b.to_pylist()]
            columns = [b.column(k) if k in keys else pa.array([r[k] for r in rows], pa.list_(pa.float64()) if k in ("_new", "_b", "_held") else pa.bool_() if k == "_done" else pa.float64()) for k in schema.names]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    for _ in range(rounds):
        if state.isEmpty():
            break
        rows = met(means, state, keys)
        a, mid, scale = (F.element_at("_new", k) for k in (1, 2, 3))
        rows = rows.withColumn("_g", 1 / (1 + F.exp(F.greatest(F.lit(-700.0), F.least(F.lit(700.0), (mid - F.col("_x")) / scale)))))
        rows = rows.withColumns({"_d": a * F.col("_g") * (1 - F.col("_g")), "_r": F.col("_y") - a * F.col("_g")})
        rows = rows.withColumns({"_j0": F.col("_g"), "_j1": -F.col("_d") / scale, "_j2": F.col("_d") * (mid - F.col("_x")) / (scale * scale)})
        products = [F.col(f"_j{i}") * F.col(f"_j{j}") for i in range(3) for j in range(i, 3)] + [F.col(f"_j{i}") * F.col("_r") for i in range(3)] + [F.col("_r") * F.col("_r")]
        sums = rows.groupBy(*keys, *[c for c in state.columns if c not in keys]).agg(F.array(*[F.sum(F.col("_w") * p) for p in products]).alias("_sums"))
        moved = saved(sums.mapInArrow(step, schema), "curve")
        done, state = done.unionByName(moved.where("_done").select(*keys, "_b")), moved.where("not _done").drop("_done")
    return done.unionByName(state.select(*keys, F.lit(None).cast("array<double>").alias("_b")))


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, rounds: int) -> list[float] | None:
    if len(x) < 4 or np.ptp(y) == 0:
        return None
    top = y.max() * 1.05 if y.max() > 0 else 1.0
    inside = (y > 0) & (y < top)
    if inside.sum() < 2:
        return None
    slope, cut = np.polyfit(x[inside], np.log(y[inside] / (top - y[inside])), 1)
    if slope == 0:
        return None
    state = {"_new": [top, -cut / slope, 1 / slope], "_b": None, "_held": None, "_loss": None, "_damp": 1e-3}
    for _ in range(rounds):
        a, mid, scale = state["_new"]
        g = 1 / (1 + np.exp(np.clip((mid - x) / scale, -700, 700)))
        d, rest = a * g * (1 - g), y - a * g
        jac = np.stack([g, -d / scale, d * (mid - x) / scale**2])
        grid, slopes = (jac * w) @ jac.T, (jac * w) @ rest
        state |= _logistic_step(state | {"_sums": [*grid[np.triu_indices(3)], *slopes, float((w * rest**2).sum())]})
        if state["_done"]:
            return state["_b"]
    return None


def _logistic_step(r: dict) -> dict:
    """What is known of a group after the normal equations at its next coefficients `_new` have been summed
    up: they are taken if the loss is no larger, else the damping grows; and the coefficients to try then."""
    b, held, loss, damp, done = r["_b"], r["_held"], r["_loss"], r["_damp"], False
    now = r["_sums"][9] if r["_sums"][9] == r["_sums"][9] else math.inf
    if b is None or now <= loss:
        if b is not None:
            step = np.abs(np.subtract(r["_new"], b)).max()
            done = loss - now <= 1e-12 * (loss + 1e-300) and step <= 1e-6 * (1 + np.abs(b).max())
            damp /= 5
        b, held, loss = list(map(float, r["_new"])), list(map(float, r["_sums"])), float(now)
    else:
        damp *= 5
        done = damp > 1e12
    grid = np.zeros((3, 3))
    grid[np.triu_indices(3)] = held[:6]
    grid += np.triu(grid, 1).T
    finite = bool(np.isfinite(held).all() and np.isfinite(b).all())
    new = b
    if finite and not done:
        new = (b + np.linalg.lstsq(grid + damp * np.diag(np.maximum(np.diag(grid), 1e-12)), np.array(held[6:9]), rcond=None)[0]).tolist()
    if not finite or new[2] == 0:
        b, done = None, True
    return {"_new": new, "_b": b, "_held": held, "_loss": loss, "_damp": damp, "_done": bool(done)}


def stars(p: str = "p_value") -> Column:
    """Label of a p-value: three stars to none."""
    return F.when(F.col(p) < 0.001, "***").when(F.col(p) < 0.01, "**").when(F.col(p) < 0.05, "*").when(F.col(p).isNotNull(), "n.s.")


def significant(df: DataFrame, p: str = "p_value") -> DataFrame:
    return df.withColumn("sig_label", stars(p)).withColumn("sig", F.col(p) < 0.05)


def anova_between(df: DataFrame, keys: list[str], value: str, group: str, p_value: bool = True) -> DataFrame:
    """One-way analysis between groups: sums of squares, F and p."""
    known = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    per = known.groupBy(*keys, group).agg(F.avg(value).alias("_m"), F.var_pop(value).alias("_v"), F.count("*").alias("_n"))
    whole = Window.partitionBy(*keys)
    per = per.withColumn("_all", F.sum(F.col("_m") * F.col("_n")).over(whole) / F.sum("_n").over(whole))
    out = per.groupBy(*keys).agg(F.sum(F.col("_n") * (F.col("_m") - F.col("_all")) * (F.col("_m") - F.col("_all"))).alias("ss_effect"), F.sum(F.col("_v") * F.col("_n")).alias("ss_error"), (F.count("*") - 1).cast("double").alias("df_effect"), (F.sum("_n") - F.count("*")).cast("double").alias("df_error"))
    return _f_test(out, p_value)


def _f_test(out: DataFrame, p_value: bool) -> DataFrame:
    out = out.withColumn("statistic", F.try_divide(F.try_divide("ss_effect", "df_effect"), F.try_divide("ss_error", "df_error")))
    return with_values(out, {"p_value": lambda r: dist.f_upper(r["statistic"], r["df_effect"], r["df_error"])}) if p_value else out


def tukey_between(df: DataFrame, keys: list[str], value: str, group: str, p_value: bool = True) -> DataFrame:
    """Tukey's pairs of a one-way analysis, with the pooled error."""
    known = df.where(F.col(value).isNotNull() & F.col(group).isNotNull())
    per = known.groupBy(*keys, F.col(group).alias("_g")).agg(F.avg(value).alias("_m"), F.var_pop(value).alias("_v"), F.count("*").alias("_n"))
    pool = per.groupBy(*keys).agg(F.sum(F.col("_v") * F.col("_n")).alias("_ss"), (F.sum("_n") - F.count("*")).cast("double").alias("parameter"), F.count("*").alias("levels"))
    a = per.select(*keys, F.col("_g").alias("group1"), F.col("_m").alias("_m1"), F.col("_n").alias("_n1"))
    b = per.select(*keys, F.col("_g").alias("group2"), F.col("_m").alias("_m2"), F.col("_n").alias("_n2"))
    out = met(met(a, b, keys).where("group1 < group2"), pool, keys)
    error = F.sqrt(F.col("_ss") / F.col("parameter") * (1 / F.col("_n1") + 1 / F.col("_n2")))
    out = out.select(*keys, "group1", "group2", (F.col("_m1") - F.col("_m2")).alias("estimate"), error.alias("std_error"), "parameter", "levels").withColumn("statistic", F.try_divide("estimate", "std_error"))
    return with_values(out, {"p_value": lambda r: dist.studentised_range_upper(abs(r["statistic"]) * math.sqrt(2), int(r["levels"]), r["parameter"])}) if p_value else out


def _helmert(n: int) -> np.ndarray:
    """Orthonormal contrasts of n cells, one a row."""
    out = np.zeros((n - 1, n))
    for i in range(1, n):
        out[i - 1, :i], out[i - 1, i] = 1, -i
        out[i - 1] /= math.sqrt(i * (i + 1))
    return out


def contrasts(levels: dict[str, list[str]]) -> list[tuple[str, int, tuple[str, ...], float]]:
    """(effect, contrast, cell, weight) over the crossed within factors: for each set of factors the
    products of their orthonormal contrasts and the means over the other factors; `(intercept)` is the
    mean over all."""
    names = list(levels)
    out = []
    for mask in range(1 << len(names)):
        effect = ":".join(n for k, n in enumerate(names) if mask >> k & 1) or "(intercept)"
        grids = [_helmert(len(levels[n])) if mask >> k & 1 else np.full((1, len(levels[n])), 1 / math.sqrt(len(levels[n]))) for k, n in enumerate(names)]
        table = grids[0]
        for g in grids[1:]:
            table = np.kron(table, g)
        cells = [()]
        for n in names:
            cells = [c + (x,) for c in cells for x in levels[n]]
        out += [(effect, i, c, float(w)) for i, row in enumerate(table) for c, w in zip(cells, row, strict=True)]
    return out


def anova_within(df: DataFrame, keys: list[str], subject: str, within: list[str], value: str, between: str | None = None, p_value: bool = True) -> DataFrame:
    """Repeated-measures and mixed analyses by contrast scores, Type III, no sphericity correction.

    Cell means a subject are summed with orthonormal contrasts over the within cells (a small table
    from the factors' levels). For each contrast, over subjects: the intercept takes the unweighted
    mean of group means, the group effect the one-way sum of squares, the error what is left within
    groups; an effect sums its contrasts. Only subjects with every cell count."""
    known = df.where(F.col(value).isNotNull())
    cells = known.groupBy(*keys, subject, *within, *([between] if between else [])).agg(F.avg(value).alias("_y"))
    levels = {w: sorted(r[0] for r in known.select(w).where(F.col(w).isNotNull()).distinct().collect()) for w in within}  # levels of factors, not data
    kinds = dict(df.dtypes)
    table = df.sparkSession.createDataFrame([(e, i, *c, w) for e, i, c, w in contrasts(levels)], "effect string, contrast int, " + ", ".join(f"`{w}` {kinds[w]}" for w in within) + ", _w double")
    n_cells = math.prod(len(v) for v in levels.values())
    group = F.col(between) if between else F.lit("all")
    scores = cells.join(F.broadcast(table), within).groupBy(*keys, subject, group.alias("_g"), "effect", "contrast").agg(F.sum(F.col("_y") * F.col("_w")).alias("_s"), F.count("*").alias("_c"))
    per = scores.where(F.col("_c") == n_cells).groupBy(*keys, "effect", "contrast", "_g").agg(F.avg("_s").alias("_m"), F.var_pop("_s").alias("_v"), F.count("*").alias("_n"))
    one = per.groupBy(*keys, "effect", "contrast").agg(F.avg("_m").alias("_u"), F.count("*").alias("_k"), F.sum(1 / F.col("_n")).alias("_h"), F.sum(F.col("_m") * F.col("_n")).alias("_sum"), F.sum(F.col("_m") * F.col("_m") * F.col("_n")).alias("_sq"), F.sum("_n").alias("_all"), F.sum(F.col("_v") * F.col("_n")).alias("_err"))
    own = F.col("_u") * F.col("_u") * F.col("_k") * F.col("_k") / F.col("_h")
    group_ss = F.col("_sq") - F.col("_sum") * F.col("_sum") / F.col("_all")
    tests = [F.struct(F.col("effect").alias("effect"), own.alias("ss"), F.lit(1.0).alias("df"))]
    if between:
        name = F.when(F.col("effect") == "(intercept)", F.lit(between)).otherwise(F.concat(F.lit(f"{between}:"), F.col("effect")))
        tests.append(F.struct(name.alias("effect"), group_ss.alias("ss"), (F.col("_k") - 1).cast("double").alias("df")))
    rows = one.select(*keys, F.explode(F.array(*tests)).alias("_t"), "_err", (F.col("_all") - F.col("_k")).cast("double").alias("_dfe")).where("_t.df > 0")
    out = rows.groupBy(*keys, F.col("_t.effect").alias("effect")).agg(F.sum("_t.ss").alias("ss_effect"), F.sum("_err").alias("ss_error"), F.sum("_t.df").alias("df_effect"), F.sum("_dfe").alias("df_error"))
    return _f_test(out, p_value)


def save_results(tables: dict[str, DataFrame], folder: str, kind: str = "parquet") -> None:
    """Write each table below `folder` under its name, as Parquet or as CSV with a header."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        writer.parquet(f"{folder}/{name}") if kind == "parquet" else writer.option("header", True).csv(f"{folder}/{name}")
