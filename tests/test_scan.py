"""Scans within ranges of a group give what whole groups give, whatever the size of the ranges."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.operators import align, bins, camera, edges, peri, scan, signal


@pytest.fixture(params=[None, 7])
def rows(request, monkeypatch):
    """Ranges of the usual size, or of seven rows."""
    if request.param:
        monkeypatch.setattr(scan, "ROWS", request.param)
    return request.param


def table(spark, n=120, seed=1):
    r = random.Random(seed)
    data = [(r.choice(["a", "a", "a", "a", "b", None]), k, r.choice([None, None, r.randint(0, 9)])) for k in r.sample(range(10 * n), n)]
    return data, spark.createDataFrame(data, "g string, t bigint, v int").repartition(5)


def test_scan_equals_brute_force(spark, rows):
    data, df = table(spark)
    cut, many = scan.ranges(df, ["g"], "t")
    assert many == bool(rows)
    v = F.col("v")
    got = scan.scan(cut, ["g"], ["t"], many, number="n", sums={"s": v}, lasts={"l": v}, nexts={"x": v}, previous={"p": v}, following={"f": v})
    got = {(r.g, r.t): (r.n, r.s, r.l, r.x, r.p, r.f) for r in got.collect()}
    assert len(got) == len(data)
    for g in ("a", "b", None):
        own = sorted((t, v) for k, t, v in data if k == g)
        vs = [v for _, v in own]
        first = lambda xs: next((x for x in xs if x is not None), None)
        for i, (t, v) in enumerate(own):
            want = (i + 1, sum(x or 0 for x in vs[: i + 1]), first(vs[i::-1]), first(vs[i:]), vs[i - 1] if i else None, vs[i + 1] if i + 1 < len(vs) else None)
            assert got[g, t] == want


def test_one_session_with_most_rows_is_cut(spark):
    g = np.random.default_rng(3)
    steps = np.cumsum(np.where(g.random(9000) < 0.01, 5000, 1))  # clustered times
    df = spark.createDataFrame([("hot", int(t)) for t in steps] + [(f"s{k % 9}", k) for k in range(1000)], "g string, t bigint")
    cut, many = scan.ranges(df, ["g"], "t", 500)
    sizes = {(r["g"], r["_cut"]): r["count"] for r in cut.groupBy("g", "_cut").count().collect()}
    assert many and sum(sizes.values()) == 10_000 and max(sizes.values()) <= 2 * 500
    assert [c for g_, c in sizes if g_ == "s1"] == [0]


def collected(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def states(spark):
    r = random.Random(5)
    data = [(k % 3 and "a" or "b", t, r.randint(0, 1)) for k, t in enumerate(r.sample(range(2000), 300))]
    return data, spark.createDataFrame(data, "g string, t bigint, s int")


def test_edges(spark, rows):
    data, df = states(spark)
    got = collected(edges.edges(df, ["g"], "t", "s").select("g", "event_number", "onset", "offset"))
    want = []
    for g in "ab":
        own, n, high = sorted((t, s) for k, t, s in data if k == g), 0, None
        for t, s in own:
            if s and high is None:
                n, high = n + 1, t
            elif not s and high is not None:
                want.append((g, n, high, t))
                high = None
        if high is not None:
            want.append((g, n, high, None))
    assert got == sorted(want, key=repr)


def test_peaks(spark, rows):
    r = random.Random(6)
    data = [("a" if t % 900 else "b", t * 10, float(r.randint(0, 9))) for t in range(400) if r.random() < 0.9]
    df = spark.createDataFrame(data, "g string, t bigint, v double")
    got = collected(edges.peaks(df, ["g"], "t", "v", 10, 4.0, 0).select("g", "event_time", "v", "peak_num"))
    runs, last = [], {}
    for g, t, v in sorted(data):
        if v >= 4:
            if g not in last or t - last[g] > 11:
                runs.append([])
            runs[-1].append((v, -t, g))
            last[g] = t
    tops = sorted((max(r)[2], -max(r)[1], max(r)[0]) for r in runs)
    count = {}
    want = []
    for g, t, v in tops:
        count[g] = count.get(g, 0) + 1
        want.append((g, t, v, count[g]))
    assert got == sorted(want, key=repr)


def test_interpolate(spark, rows):
    r = random.Random(7)
    data = {("a" if k % 5 else None): [] for k in range(5)}
    for t in sorted(r.sample(range(1000), 80)):
        data["a" if t % 7 else None].append((t, float(r.randint(0, 99))))
    df = spark.createDataFrame([(g, t, v) for g, own in data.items() for t, v in own], "g string, t bigint, v double")
    got = {(x.g, x.t): x.v for x in bins.interpolate(df, ["g"], "t", "v", 13).collect()}
    for g, own in data.items():
        t, v = zip(*own)
        grid = range(t[0], t[-1] + 1, 13)
        assert [got.pop((g, k)) for k in grid] == pytest.approx(np.interp(list(grid), t, v))
    assert not got


def test_cycles(spark, rows):
    data = [("a", c, float(k) + c / 10) for c in (1, 2) for k in range(40)]
    df = spark.createDataFrame(data, "g string, channel_wavelength int, time double")
    got = collected(camera.with_cycles(df, ["g"]).select("channel_wavelength", "cycle_number", F.round("time", 6)))
    assert got == sorted(((c, k + 1, round(k + 0.15, 6)) for c in (1, 2) for k in range(40)), key=repr)


def test_ticks_frames_and_sets(spark, rows):
    r = random.Random(8)
    data = [("b", r.choice(["tick", "x", "y"]), t) for t in r.sample(range(1000), 90)]
    sent = spark.createDataFrame(data, "blockname string, event_id_char string, ts bigint")
    got_ticks = sorted(r.sample(range(5000, 9000), 20))
    received = spark.createDataFrame([("b", t) for t in got_ticks], "blockname string, ts bigint")
    ticks = sorted(t for _, n, t in data if n == "tick")
    want = []
    for _, n, t in data:
        before = [x for x in ticks if x <= t]
        if before:
            want.append((n, t, got_ticks[min(len(before), 20) - 1] + t - before[-1]))
    assert collected(align.by_ticks(received, sent, "tick").select("event_id_char", "ts", "ts_rec_system")) == sorted(want, key=repr)

    frames = sorted(r.sample(range(900), 60))
    f = spark.createDataFrame([("b", t, t * 2) for t in frames], "blockname string, t bigint, v bigint")
    got = collected(align.next_frame(sent, f, "blockname", "ts", "t", "v").select("ts", "v"))
    assert got == sorted(((t, 2 * min(x for x in frames if x >= t)) for _, _, t in data if t <= frames[-1]), key=repr)

    sets = collected(edges.response_sets(sent, "tick", "ts").select("ts", "response_set"))
    assert sets == sorted(((t, 1 + sum(x < t for x in ticks)) for _, _, t in data if t <= ticks[-1]), key=repr)


def test_local_delta(spark, rows):
    shared = [("b", "k", 100 * k + 7) for k in range(30)]
    reference = spark.createDataFrame([(b, n, 2 * t) for b, n, t in shared], "blockname string, event_id_char string, event_ts bigint")
    external = spark.createDataFrame(shared + [("b", "other", 100 * k + 31) for k in range(30)], "blockname string, event_id_char string, event_ts bigint")
    got = {(x.event_id_char, x.event_ts): x.event_ts_tdt for x in align.local_delta(reference, external, ["k"]).collect()}
    for k in range(30):
        assert got["k", 100 * k + 7] == 2 * (100 * k + 7) and got["other", 100 * k + 31] == 2 * (100 * k + 7) + 24


def test_histogram_of_overlapping_events(spark, rows):
    g = np.random.default_rng(9)
    times = np.sort(g.choice(20_000, 400, replace=False))
    data = [("b", f, int(t), float(v) if v > 1 else None, float("nan") if v < 0.5 else float(v) * 1e-6) for f in ("1", None) for t, v in zip(times, g.random(400) * 100)]
    series = spark.createDataFrame(data, "blockname string, fiber_id string, t bigint, m double, d double")
    events = [(n, int(t)) for n, t in enumerate(g.choice(20_000, 25))]
    ev = spark.createDataFrame([("b", n, t) for n, t in events] + [("b", *events[0]), ("c", 99, 5)], "blockname string, event_number int, at bigint")
    got = {(x.fiber_id, x.event_number, x.time_rel): (x.m, x.d) for x in peri.histogram(series, ev, ["blockname"], "t", "at", ["event_number"], 700, 1500, 300, ["m", "d"], ["fiber_id"]).collect()}
    want = {}
    for n, at in events:
        held = {}
        for _, f, t, m, d in data:
            if -700 < t - at < 1500:
                held.setdefault((f, -(-(t - at + 700) // 300)), []).append((m, d))
        last = max((b for _, b in held), default=0)
        for (f, b), vs in held.items():
            if b < last:
                known = lambda k: [v[k] for v in vs if v[k] is not None and v[k] == v[k]]
                want[f, n, b * 300 - 700] = tuple(pytest.approx(np.mean(known(k)), rel=1e-12) if known(k) else None for k in (0, 1))
    assert got == want


def test_smoothing_of_every_length_at_once(spark):
    g = np.random.default_rng(10)
    values = {f"_{k:03}A": g.normal(1e6 if k == 5 else 0, 10, 90) for k in range(0, 40, 5)} | {"_001A": g.normal(size=90), "_002A": g.normal(size=90)}
    values["_010A"][30] = np.nan
    lengths = {c: int(c[1:4]) for c in values}
    s = spark.createDataFrame([("b", c, i, float(v)) for c, own in values.items() for i, v in enumerate(own)], "blockname string, channel string, sample_idx bigint, raw_au double")
    w = spark.createDataFrame([("b", c, k) for c, k in lengths.items()], "blockname string, channel string, k int")
    for edge in ("partial", "drop"):
        for chunk in (8, 1 << 16):
            got = {(r.channel, r.sample_idx): r.au_smooth_ma for r in signal.moving_average(s, w, edge, chunk=chunk).collect()}
            for c, own in values.items():
                k = lengths[c]
                before, after = (k // 2, (k - 1) // 2) if edge == "partial" else ((k - 1) // 2, k // 2)
                for i in range(90):
                    if k == 0:
                        want = own[i]
                    elif edge == "drop" and (i < before or i + after >= 90):
                        assert (c, i) not in got
                        continue
                    else:
                        want = np.mean(own[max(0, i - before) : i + after + 1])
                    assert got[c, i] is None if k and np.isnan(want) else got[c, i] == pytest.approx(want, rel=1e-12, nan_ok=True)


def test_smoothing_has_one_window(spark):
    s = spark.range(10).selectExpr("'b' AS blockname", "concat('_', id % 5) AS channel", "id AS sample_idx", "id * 1.0D AS raw_au")
    w = s.select("blockname", "channel").distinct().withColumn("k", F.substring("channel", 2, 1).cast("int"))
    plan = signal.moving_average(s, w)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 1 and "Union" not in plan


@pytest.mark.parametrize("chunk", [6, 50, 1 << 16])
def test_moving_zscore_keeps_its_digits_under_drift(spark, chunk, monkeypatch):
    monkeypatch.setattr(signal, "SLIDE", 1)
    g = np.random.default_rng(11)
    values = np.arange(200) * 1e7 + g.normal(size=200)
    values[100:120] = 0.1
    s = spark.createDataFrame([("b", "c", i, float(v)) for i, v in enumerate(values)], "blockname string, channel string, sample_idx bigint, v double")
    for n in (1, 5, 12):
        got = {r.sample_idx: r.v_moving for r in signal.moving_zscore(s, n, "v", signal.SESSION, chunk=chunk).collect()}
        for i in range(200):
            w = values[i - n : i]
            if i < n or n == 1 or w.min() == w.max():
                assert got[i] is None
            else:
                assert got[i] == pytest.approx((values[i] - w.mean()) / w.std(ddof=1), rel=1e-9)


@pytest.mark.parametrize("shift, scale", [(0, 1), (1e9, 1e-3), (-5e4, 1e6)])
def test_fits_equal_numpy_on_badly_scaled_x(spark, shift, scale):
    g = np.random.default_rng(12)
    z = np.concatenate([g.normal(size=400), [9.0]])
    x = shift + scale * z
    y = 1e3 + 3 * z - z**2 + 0.1 * z**4 + g.normal(size=401)
    df = spark.createDataFrame([(None, float(p), float(q)) for p, q in zip(x, y)] + [("few", float(k % 2), float(k)) for k in range(6)], "g string, x double, y double").repartition(7)
    for degree in (1, 4):
        got = {(r.g, r.x): r.f for r in signal.polynomial_fit(df, ["g"], "x", "y", degree, "f").collect()}
        z2 = (x - np.mean(x)) / np.std(x)
        q, _ = np.linalg.qr(np.vander(z2, degree + 1))
        assert [got[None, float(p)] for p in x] == pytest.approx(q @ (q.T @ y), rel=1e-10)
        assert (got["few", 0.0], got["few", 1.0]) == pytest.approx((2.0, 3.0))


def test_null_groups_stay(spark):
    df = spark.createDataFrame([("b", None, float(t), float(t)) for t in range(8)], "blockname string, fiber_id string, time double, v double")
    assert signal.normalised(df, ["blockname", "fiber_id"], ["v"]).count() == 8
    assert bins.downsample(df, 1.0, ["blockname", "fiber_id"]).count() == 6


def test_robust_fits_of_large_and_small_groups_agree(spark, monkeypatch):
    g = np.random.default_rng(13)
    data = [(k or None, float(x), float(3 * x - x**2 + g.standard_t(2))) for k in ("a", "") for x in g.normal(size=150)]
    df = spark.createDataFrame(data, "g string, x double, y double").repartition(3)
    fits = {}
    for limit in (1000, 10):
        monkeypatch.setattr(signal, "TOGETHER", limit)
        fits[limit] = {(r.g, r.x): r.f for r in signal.huber_fit(df, ["g"], "x", "y", "f").collect()}
    assert len(fits[10]) == 300 and all(v == pytest.approx(fits[1000][k], rel=1e-5, abs=1e-5) for k, v in fits[10].items())


def test_long_runs_are_marked_by_doubling(spark, rows, monkeypatch):
    g = np.random.default_rng(14)
    data = [(k, int(t)) for k in ("a", None) for t in [*np.cumsum(g.integers(0, 6, 200)), 5000, 5003, 5011]]
    df = spark.createDataFrame(data, "g string, at bigint").repartition(4)
    kept = {}
    for k, t in sorted(data, key=lambda x: (x[0] or "", x[1])):
        own = kept.setdefault(k, [])
        if not own or not 0 < t - own[-1] < 10:
            own.append(t)
    for limit in (1000, 8):
        monkeypatch.setattr(peri, "WALK", limit)
        got = collected(peri.keep_apart(df, ["g"], "at", 10))
        assert got == sorted([(k, t) for k, own in kept.items() for t in own], key=repr)
