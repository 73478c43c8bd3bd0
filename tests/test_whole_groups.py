"""Steps on whole groups, many in one task, beside those that spread a group over tasks."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tracewell.operators import camera, peri, scan, signal

PAIRS = "blockname string, fiber_id string, signal_wavelength string, control_wavelength string, time double, signal double, control double"


def pairs(spark):
    """Groups of 1 to 90 rows, two of them with null keys, one flat, one that a line meets exactly."""
    g, rows = np.random.default_rng(3), []
    for b, f, n in (("a", "1", 90), ("a", "2", 17), ("b", "1", 1), (None, "1", 40), ("a", None, 60), ("c", "1", 30), ("d", "1", 25)):
        t, c = np.arange(n) / 10 + 500, g.uniform(100, 900, n)
        s = {"c": np.full(n, 7.0), "d": 3 * c + 1}.get(b, 2 * c + 50 * np.sin(t) + 9 * g.standard_t(2, n))
        rows += [(b, f, "465", "405", *map(float, r)) for r in zip(t, s, c)]
    rows += [("a", "1", "465", "405", 509.5, None, 300.0), ("a", "1", "465", "405", 509.6, 4.0, None)]
    return spark.createDataFrame(rows, PAIRS).repartition(4)


@pytest.mark.parametrize("at_once", [1, 50])
def test_whole_groups_equal_spread_ones(spark, monkeypatch, at_once):
    monkeypatch.setattr(scan, "AT_ONCE", at_once)  # groups that end within, at and after a batch

    def rows(together):
        monkeypatch.setattr(signal, "TOGETHER", together)
        out = signal.fitted(pairs(spark), 1, 2)
        return out.columns, {tuple(r[:7]): tuple(r[7:]) for r in out.collect()}

    (names, whole), (other, spread), (_, mixed) = rows(1 << 18), rows(0), rows(50)
    assert names == other and set(whole) == set(spread) == set(mixed) and len(whole) == 265
    for k, v in whole.items():
        for name, x, y, z in zip(names[7:], v, spread[k], mixed[k], strict=True):
            if name.endswith("_zscore") and k[0] in ("b", "c", "d"):
                continue  # what rounding leaves of an exact fit, over its own deviation
            assert (x is None) == (y is None) == (z is None), (k, name)
            assert x is None or [x, x] == pytest.approx([y, z], rel=1e-6, abs=1e-6), (k, name)


def test_fits_of_small_groups_shuffle_their_rows_once(spark):
    plan = signal.fitted(pairs(spark).localCheckpoint())._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1 and plan.count("MapInArrow") == 1


def test_robust_fits_of_small_groups_take_no_call_each(spark):
    plan = signal.huber_fit(pairs(spark).localCheckpoint(), signal.FIT_KEYS, "control", "signal", "f")._jdf.queryExecution().executedPlan().toString()
    assert "FlatMapGroups" not in plan and "Join" not in plan and plan.count("MapInArrow") == 1


def test_short_runs_take_no_call_each(spark):
    e = spark.createDataFrame([("a", t) for t in (0, 4, 5, 5, 9, 30, 31, 50)] + [(None, 3), (None, 4)], "k string, t bigint")
    kept = peri.keep_apart(e, ["k"], "t", 5)
    assert sorted((r.k or "", r.t) for r in kept.collect()) == [("", 3), ("a", 0), ("a", 5), ("a", 5), ("a", 30), ("a", 50)]
    assert "FlatMapGroups" not in kept._jdf.queryExecution().executedPlan().toString()


def test_cycles_meet_their_control_without_a_join(spark):
    rows = spark.createDataFrame([("s", w, float(10 * i + k), float(i)) for i in range(5) for k, w in enumerate(("405", "465"))] + [("s", "465", 99.0, 8.0)], "session string, channel_wavelength string, time double, au_smooth_ma double")
    kinds = spark.createDataFrame([("s", "405", "control"), ("s", "465", "signal")], "session string, channel_wavelength string, channel_id string")
    out = camera.cycles_paired(rows, kinds, ["session"])
    assert sorted((r.cycle_number, r.signal, r.control) for r in out.collect()) == [(1, 0.0, 0.0), (2, 1.0, 1.0), (3, 2.0, 2.0), (4, 3.0, 3.0), (5, 4.0, 4.0), (6, 8.0, None)]
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_tasks_of_frames_follow_their_number(spark, monkeypatch):
    monkeypatch.setattr(scan, "TASK", 10)
    f = spark.range(200).select(F.concat(F.lit("s"), F.col("id") % 3).alias("session_name"), F.col("id").alias("frame_counter"), (F.col("id") * 1.0).alias("timestamp"))
    out = camera.stamps(camera.with_clock(f, f.where("id % 7 > 0").select("session_name", "frame_counter", (F.col("timestamp") + 1).alias("ts_comp"))))
    assert out._jdf.queryExecution().executedPlan().toString().count(", 20), REPARTITION_BY_NUM") == 2
    assert out.count() == 200 and out.where("ts_comp IS NULL").count() == 29


def test_channels_of_one_wave_meet_each_other(spark):
    s = spark.createDataFrame([("b", c, 0, 0.1, v) for c, v in (("_405A", 1.0), ("x405A", 2.0), ("_465A", 3.0), ("_465C", 4.0), ("_560", 5.0), ("_405", 6.0))], "blockname string, channel string, sample_idx bigint, time double, au_smooth_ma double")
    asked = spark.createDataFrame([("b", "465", "405"), ("b", "560", "405"), ("b", None, "405")], "blockname string, signal_wavelength string, control_wavelength string")
    got = sorted((r.fiber_id or "", r.signal, r.control) for r in signal.paired(s, asked).collect())
    assert got == [("", 5.0, 6.0), ("1", 3.0, 1.0), ("1", 3.0, 2.0)]
