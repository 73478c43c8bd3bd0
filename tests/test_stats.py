import itertools
import math

import numpy as np
import pytest

from tracewell.functions import dist
from tracewell.operators import scan
from tracewell.operators import stats


def test_distributions():
    assert dist.t_two_sided(2.228138851964939, 10) == pytest.approx(0.05, abs=1e-9)
    assert dist.t_quantile(0.975, 10) == pytest.approx(2.228138851964939, abs=1e-8)
    assert dist.f_upper(4.964602743730711, 1, 10) == pytest.approx(0.05, abs=1e-9)
    assert dist.chi2_upper(3.841458820694124, 1) == pytest.approx(0.05, abs=1e-9)
    assert dist.normal_upper(1.959963984540054) == pytest.approx(0.025, abs=1e-12)
    assert dist.kolmogorov_upper(1.358, 1) == pytest.approx(0.05, abs=2e-4)
    assert dist.studentised_range_upper(3.877676, 3, 10) == pytest.approx(0.05, abs=1e-4)
    assert dist.studentised_range_upper(3.314493, 3, math.inf) == pytest.approx(0.05, abs=1e-4)


def test_exact_rank_tests_count_all_orders():
    n1, n2 = 3, 4
    sums = [sum(c) - n1 * (n1 + 1) // 2 for c in itertools.combinations(range(1, 8), n1)]
    for w in range(n1 * n2 + 1):
        tail = sum(s >= w for s in sums) if w > n1 * n2 / 2 else sum(s <= w for s in sums)
        assert dist.rank_sum_exact(w, n1, n2) == pytest.approx(min(1, 2 * tail / len(sums)))
    signs = [sum(k + 1 for k in range(4) if m >> k & 1) for m in range(16)]
    for v in range(11):
        tail = sum(s >= v for s in signs) if v > 5 else sum(s <= v for s in signs)
        assert dist.signed_rank_exact(v, 4) == pytest.approx(min(1, 2 * tail / 16))


def test_paired_t_and_one_row_groups(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 2.0, 2.5), ("a", 4.0, 3.0), ("b", 1.0, 1.0)], "g string, x double, y double")
    got = {r.g: r for r in stats.t_paired(df, ["g"], "x", "y").collect()}
    d = np.array([-1.0, -0.5, 1.0])
    assert got["a"].statistic == pytest.approx(d.mean() / (d.std(ddof=1) / math.sqrt(3)))
    assert got["b"].statistic is None and got["b"].p_value is None


def test_grouped_t_needs_two_levels(spark):
    df = spark.createDataFrame([("a", "x", 1.0), ("a", "y", 2.0), ("a", "z", 3.0), ("b", "x", 1.0), ("b", "x", 2.0), ("b", "y", 4.0), ("b", "y", 6.0)], "g string, f string, v double")
    got = {r.g: r for r in stats.t_grouped(df, ["g"], "f", "v").collect()}
    assert got["a"].levels == 3 and got["a"].statistic is None
    assert got["b"].estimate == pytest.approx(-3.5)


def test_tied_ranks_in_kruskal(spark):
    df = spark.createDataFrame([(g, float(v)) for g, v in zip("aabbcc", [1, 1, 1, 2, 2, 3])], "f string, v double")
    r = stats.kruskal(df, [], "v", "f").first()
    ranks = np.array([2, 2, 2, 4.5, 4.5, 6])
    h = 12 / (6 * 7) * sum(ranks[k : k + 2].sum() ** 2 / 2 for k in (0, 2, 4)) - 3 * 7
    assert r.statistic == pytest.approx(h / (1 - (24 + 6) / (216 - 6)))


def mixed_by_hand(y, groups):
    """Between and within sums of squares of a balanced design, subjects by cells."""
    grand, subj, cell = y.mean(), y.mean(1), y.mean(0)
    k, out = y.shape[1], {}
    names = sorted(set(groups))
    gm = {g: y[[i for i, x in enumerate(groups) if x == g]].mean(0) for g in names}
    n = {g: groups.count(g) for g in names}
    out["grp"] = sum(n[g] * k * (gm[g].mean() - grand) ** 2 for g in names), sum(k * (subj[i] - gm[g].mean()) ** 2 for i, g in enumerate(groups))
    error = sum(((y[i] - subj[i] - gm[g] + gm[g].mean()) ** 2).sum() for i, g in enumerate(groups))
    out["w"] = len(groups) * ((cell - grand) ** 2).sum(), error
    out["grp:w"] = sum(n[g] * ((gm[g] - gm[g].mean() - cell + grand) ** 2).sum() for g in names), error
    return out


def test_mixed_design_equals_sums_by_hand(spark):
    g = np.random.default_rng(5)
    groups = ["a"] * 4 + ["b"] * 4
    y = g.normal(size=(8, 3)) + np.array([0, 1, 2])
    rows = [(f"s{i}", groups[i], f"c{j}", float(y[i, j])) for i in range(8) for j in range(3)] + [("s9", "a", "c0", 5.0)]
    df = spark.createDataFrame(rows, "s string, grp string, w string, v double")
    got = {r.effect: r for r in stats.anova_within(df, [], "s", ["w"], "v", between="grp").collect()}
    for effect, (ss, error) in mixed_by_hand(y, groups).items():
        assert (got[effect].ss_effect, got[effect].ss_error) == (pytest.approx(ss), pytest.approx(error))
    assert (got["w"].df_effect, got["w"].df_error, got["grp"].df_error) == (2, 12, 6)


def test_two_within_factors(spark):
    g = np.random.default_rng(6)
    y = g.normal(size=(6, 2, 3))
    rows = [(f"s{i}", f"a{j}", f"b{k}", float(y[i, j, k])) for i in range(6) for j in range(2) for k in range(3)]
    got = {r.effect: r for r in stats.anova_within(spark.createDataFrame(rows, "s string, a string, b string, v double"), [], "s", ["a", "b"], "v").collect()}
    m = y.mean(2)
    assert got["a"].ss_effect == pytest.approx(6 * 3 * ((m.mean(0) - y.mean()) ** 2).sum())
    assert got["a"].ss_error == pytest.approx(3 * ((m - m.mean(0) - m.mean(1)[:, None] + y.mean()) ** 2).sum())
    assert (got["a:b"].df_effect, got["a:b"].df_error) == (2, 10)


def test_sigmoid_finds_its_curve_or_says_so(spark):
    rows = [("a", float(x), 10 / (1 + math.exp((12 - x) / 2))) for x in range(31)] + [("b", float(x), 1.0) for x in range(31)]
    got = stats.sigmoid(spark.createDataFrame(rows, "g string, x double, y double"), ["g"], "x", "y").collect()
    a = [r for r in got if r.g == "a"]
    assert len(a) == 100 and (a[0].asym, a[0].xmid, a[0].scal) == (pytest.approx(10, abs=1e-4), pytest.approx(12, abs=1e-4), pytest.approx(2, abs=1e-4))
    assert all(r.asym is None for r in got if r.g == "b")


def test_labels(spark):
    df = spark.createDataFrame([(0.0001,), (0.005,), (0.04,), (0.5,), (None,)], "p_value double")
    assert [r.sig_label for r in stats.significant(df).collect()] == ["***", "**", "*", "n.s.", None]


def test_cumulated_in_ranges_equals_one_sort(spark):
    import numpy as np

    g = np.random.default_rng(3)
    rows = [(int(k), float(v), int(n)) for k, v, n in zip(g.integers(0, 3, 3000), g.normal(size=3000), g.integers(1, 5, 3000))] + [(9, 1.0, 2)]
    df = spark.createDataFrame(rows, "k int, v double, n int").repartition(5)
    got = {(r.k, r.v): (r._before_n, r._whole_n) for r in stats.cumulated(df, ["k"], "v", ["n"]).collect()}
    for k in (0, 1, 2, 9):
        own = sorted(r for r in rows if r[0] == k)
        before = 0
        for _, v, n in own:
            assert got[k, v] == (before, sum(r[2] for r in own))
            before += n
    whole = {r.v: r._before_n for r in stats.cumulated(df.drop("k"), [], "v", ["n"]).collect()}
    assert max(whole.values()) == sum(r[2] for r in rows) - max(rows, key=lambda r: r[1])[2]


def test_null_groups_are_groups(spark):
    g = np.random.default_rng(21)
    data = [(k, j, "ab"[j % 2], float(g.normal()), float(g.normal())) for k in ("x", None) for j in range(24)]
    df = spark.createDataFrame(data, "g string, i int, f string, a double, b double")
    tests = [stats.ks(df, ["g"], "a", "b"), stats.kruskal(df, ["g"], "a", "f"), stats.rank_sum(df, ["g"], "a", "b"), stats.signed_rank(df, ["g"], "a", "b"), stats.t_grouped(df, ["g"], "f", "a"), stats.pairwise_rank_sum(df, ["g"], "a", "f")]
    assert [sorted((r.g or "" for r in t.collect())) for t in tests] == [["", "x"]] * 6
    assert {r.g for r in stats.cross_correlation(df, ["g"], "i", "a", "b", 2).collect()} == {"x", None}


def test_ranges_of_large_groups_change_no_statistic(spark, monkeypatch):
    g = np.random.default_rng(22)
    df = spark.createDataFrame([(k, "abc"[j % 3], float(g.integers(0, 40)), float(g.normal())) for k in ("x", None) for j in range(90)], "g string, f string, a double, b double")
    run = lambda: [sorted(map(tuple, t.collect()), key=repr) for t in (stats.ks(df, ["g"], "a", "b"), stats.kruskal(df, ["g"], "a", "f"), stats.pairwise_rank_sum(df, ["g"], "a", "f"))]
    whole = run()
    monkeypatch.setattr(scan, "ROWS", 10)
    assert repr(run()) == repr(whole)


def test_curves_of_large_and_small_groups_agree(spark, monkeypatch):
    g = np.random.default_rng(23)
    x = np.linspace(0, 30, 60)
    rows = [(k or None, float(p), float(12 / (1 + np.exp((15 - p) / s)) + g.normal() * 0.2)) for k, s in (("a", 2.0), ("", 4.0)) for p in x for _ in range(2)]
    rows += [("flat", float(p), 1.0) for p in x] + [("few", 1.0, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double").repartition(3)
    fits = {}
    for limit in (1000, 1):
        monkeypatch.setattr(stats, "CURVE", limit)
        got = stats.sigmoid(df, ["g"], "x", "y", points=3).collect()
        fits[limit] = {(r.g, r.x): (r.asym, r.xmid, r.scal, r.y) for r in got}
        assert len(got) == len(fits[limit]) == 12
    for k, v in fits[1000].items():
        assert fits[1][k] == (pytest.approx(v, rel=1e-6) if v[0] is not None else v)
    assert fits[1]["a", 0.0][:3] == pytest.approx((12, 15, 2), rel=0.1) and fits[1]["flat", 0.0][0] is None and fits[1]["few", 0.0][0] is None
