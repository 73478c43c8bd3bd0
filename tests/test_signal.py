import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.operators import bins, signal


def one(spark, values, block="b", channel="_405A"):
    return spark.createDataFrame([(block, channel, i, float(v)) for i, v in enumerate(values)], "blockname string, channel string, sample_idx bigint, raw_au double")


def smoothed(spark, values, k, edges, chunk=1 << 20):
    s = one(spark, values)
    windows = spark.createDataFrame([("b", "_405A", k)], "blockname string, channel string, k int")
    return {r.sample_idx: r.au_smooth_ma for r in signal.moving_average(s, windows, edges, chunk=chunk).collect()}


def test_even_and_odd_windows(spark):
    assert smoothed(spark, [1, 2, 3, 4], 3, "partial") == {0: 1.5, 1: 2.0, 2: 3.0, 3: 3.5}
    assert smoothed(spark, [1, 2, 3, 4], 2, "partial") == {0: 1.0, 1: 1.5, 2: 2.5, 3: 3.5}
    assert smoothed(spark, [1, 2, 3, 4], 2, "drop") == {0: 1.5, 1: 2.5, 2: 3.5}
    assert smoothed(spark, [1, 2, 3, 4], 3, "drop") == {1: 2.0, 2: 3.0}
    assert smoothed(spark, [1, 2], 0, "partial") == {0: 1.0, 1: 2.0}


@pytest.mark.parametrize("chunk", [3, 7, 100])
def test_chunks_with_halo_equal_whole_windows(spark, chunk):
    values = np.random.default_rng(1).integers(0, 100, 60)
    assert smoothed(spark, values, 6, "partial", chunk) == smoothed(spark, values, 6, "partial")
    s = one(spark, values)
    a = {r.sample_idx: r.raw_au_moving for r in signal.moving_zscore(s, 5, "raw_au", signal.SESSION, chunk=chunk).collect()}
    for i, z in a.items():
        w = values[i - 5 : i]
        assert (z is None) if i < 5 or w.std() == 0 else z == pytest.approx((values[i] - w.mean()) / w.std(ddof=1))


@pytest.mark.parametrize("degree", [1, 3, 4])
def test_moment_fit_equals_polyfit(spark, degree):
    g = np.random.default_rng(2)
    x = np.linspace(2000, 2100, 300)
    y = 3 + 0.1 * x + 5 * np.sin(x / 9) + g.normal(size=300)
    df = spark.createDataFrame([("a", float(p), float(q)) for p, q in zip(x, y)] + [("b", 1.0, 2.0)], "g string, x double, y double").repartition(3)
    got = {(r.g, r.x): r.f for r in signal.polynomial_fit(df, ["g"], "x", "y", degree, "f").collect()}
    want = np.polyval(np.polyfit(x - x.mean(), y, degree), x - x.mean())
    assert [got["a", float(p)] for p in x] == pytest.approx(want, rel=1e-8)
    assert got["b", 1.0] == pytest.approx(2.0)


def test_huber_resists_outliers(spark):
    x = np.linspace(0, 10, 80)
    y = 2 * x + 1
    y[::13] += 300
    df = spark.createDataFrame([("a", float(p), float(q)) for p, q in zip(x, y)], "g string, x double, y double")
    got = {r.x: r.f for r in signal.huber_fit(df, ["g"], "x", "y", "f", degree=1).collect()}
    assert [got[float(p)] for p in x] == pytest.approx(2 * x + 1, abs=0.5)


def test_flat_signal_has_no_zscore(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 1.0)], "g string, d double")
    assert [r.d_zscore for r in signal.normalised(df, ["g"], ["d"]).collect()] == [None, None]


def test_bins_are_right_closed_and_the_last_goes(spark):
    df = spark.createDataFrame([("b", "c", t, 1.0) for t in (0.0, 0.5, 1.0, 1.5)], "blockname string, channel string, time double, v double")
    got = sorted((r.time, r.v) for r in bins.downsample(df, 1.0, ["blockname", "channel"]).collect())
    assert got == [(1.0, 1.0)]  # 0.0 lies on the first edge, 1.5 in the last bin


def test_interpolation(spark):
    df = spark.createDataFrame([("a", 0, 0.0), ("a", 10, 10.0), ("a", 25, 40.0), ("b", 5, 1.0)], "g string, t bigint, v double")
    got = sorted((r.g, r.t, r.v) for r in bins.interpolate(df, ["g"], "t", "v", 5).collect())
    assert got == [("a", 0, 0.0), ("a", 5, 5.0), ("a", 10, 10.0), ("a", 15, 20.0), ("a", 20, 30.0), ("a", 25, 40.0), ("b", 5, 1.0)]


def test_fibre_letters(spark):
    df = spark.createDataFrame([("_405A",), ("_405C",), ("AC",), ("x",)], "channel string")
    assert [r.f for r in df.select(signal.fiber_id().alias("f")).collect()] == ["1", "2", "2", None]


def test_partitions_do_not_matter(spark):
    df = spark.range(500).select(F.lit("b").alias("blockname"), F.lit("c").alias("channel"), (F.col("id") / 10).alias("time"), (F.col("id") % 17).cast("double").alias("v"))
    a, b = (sorted(map(tuple, bins.downsample(df.repartition(n), 2.0, ["blockname", "channel"]).collect())) for n in (1, 5))
    assert a == b


def huber_by_hand(x, y, degree, epsilon=1.35, alpha=1e-4):
    """The same optimum by plain reweighting in memory."""
    t = (x - x.mean()) / (x.std() or 1.0)
    design, ridge = np.vander(t, degree + 1, increasing=True), alpha * np.eye(degree + 1)
    ridge[0, 0] = 0
    sigma, beta = 1.4826 * np.median(np.abs(y - np.median(y))), np.linalg.lstsq(design, y, rcond=None)[0]
    for _ in range(3000):
        r = np.abs(y - design @ beta)
        w = np.where(r <= epsilon * sigma, 1.0, epsilon * sigma / np.maximum(r, 1e-300))
        beta = np.linalg.solve(design.T @ (design * w[:, None]) / sigma + ridge, design.T @ (w * y) / sigma)
        r = np.abs(y - design @ beta)
        inside = r <= epsilon * sigma
        sigma = np.sqrt((r[inside] ** 2).sum() / (len(y) - epsilon**2 * (~inside).sum()))
    return design @ beta


def test_huber_equals_the_fit_in_memory(spark):
    g = np.random.default_rng(5)
    rows, want = [], {}
    for k, n in (("a", 200), ("b", 60)):
        x = g.uniform(0, 50, n)
        y = 3 + 0.5 * x + 0.01 * x**2 + g.standard_t(2, n) * 4
        rows += [(k, float(p), float(q)) for p, q in zip(x, y)]
        want |= {(k, float(p)): v for p, v in zip(x, huber_by_hand(x, y, 2))}
    df = spark.createDataFrame(rows + [("b", None, 1.0), ("b", 2.0, None), ("c", None, None)], "g string, x double, y double").repartition(4)
    got = signal.huber_fit(df, ["g"], "x", "y", "f", degree=2).collect()
    assert len(got) == len(rows) + 3 and {r.f for r in got if r.x is None or r.y is None} == {None}
    assert [r.f for r in got if r.x is not None and r.y is not None] == pytest.approx([want[r.g, r.x] for r in got if r.x is not None and r.y is not None], abs=1e-4)


def test_degree_may_differ_by_group(spark):
    x = np.linspace(0, 9, 30)
    rows = [(k, d, float(p), float(p**2)) for k, d in (("a", 1), ("b", 2)) for p in x]
    df = spark.createDataFrame(rows, "g string, d int, x double, y double").repartition(3)
    got = {(r.g, r.x): r.f for r in signal.polynomial_fits(df, ["g"], [("x", "y", "d", "f")]).collect()}
    line = np.polyval(np.polyfit(x, x**2, 1), x)
    assert [got["a", float(p)] for p in x] == pytest.approx(line) and [got["b", float(p)] for p in x] == pytest.approx(x**2)


def test_rates_and_windows_may_differ_by_session(spark):
    from tracewell.operators import peri

    rows = [(b, "c", k / 10, float(k), r) for b, r in (("p", 1.0), ("q", 2.0)) for k in range(41)]
    df = spark.createDataFrame(rows, "blockname string, channel string, time double, v double, rate double")
    got = bins.downsample(df, "rate", ["blockname", "channel"]).collect()
    for b, rate in (("p", 1.0), ("q", 2.0)):
        one = bins.downsample(df.where(F.col("blockname") == b).drop("rate"), rate, ["blockname", "channel"]).collect()
        assert sorted((r.time, r.v) for r in got if r.blockname == b) == sorted((r.time, r.v) for r in one) and one
    s = df.select("blockname", (F.col("time") * 10).cast("long").alias("t"), "v", F.when(F.col("blockname") == "p", 5).otherwise(9).alias("pre"), F.lit(4).alias("post"))
    e = spark.createDataFrame([("p", 20, 5, 4), ("q", 20, 9, 4)], "blockname string, e long, pre int, post int")
    near = sorted((r.blockname, r.rel_time) for r in peri.around(s, e, ["blockname"], "t", "e", "pre", "post").collect())
    assert near == [("p", k) for k in range(-4, 4)] + [("q", k) for k in range(-8, 4)]
