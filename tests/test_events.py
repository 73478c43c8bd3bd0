import random

from pyspark.sql import functions as F

from tracewell.operators import align, edges, events, peri


def table(spark, rows):
    return spark.createDataFrame(rows, "blockname string, event_id_char string, event_us bigint")


def test_bout_windows_are_open(spark):
    rows = [("b", "lick", t) for t in (0, 1_000_000, 1_500_000, 9_000_000)]
    got = events.bouts(table(spark, rows), ["lick"], (1_000_000, 1_000_000), (0, 0), ("==", ">"), "on").collect()
    assert [(r.event_us, r.event_id_char) for r in got] == [(1_000_000, "on")]  # the one a second before lies on the border


def test_catalogue_matches_whole_names(spark):
    rows = [("b", "inactive_rotation", t * 100_000) for t in range(12)]
    assert events.catalogue(table(spark, rows), ["active_rotation_onset"]).count() == 0
    assert events.catalogue(table(spark, rows), ["inactive_rotation_onset"]).count() == 1
    empty = events.catalogue(table(spark, rows), [])
    assert empty.count() == 0 and empty.columns == ["blockname", "event_id_char", "event_us"]
    assert events.catalogue(table(spark, rows), ["all"]).count() == 12


def test_startup_rows_go_only_where_several_coincide(spark):
    rows = [("a", "x", 0), ("a", "y", 3), ("a", "x", 90), ("b", "x", 0), ("b", "x", 70)]
    got = events.drop_startup(table(spark, rows), "event_us", 10).collect()
    assert sorted((r.blockname, r.event_us) for r in got) == [("a", 90), ("b", 0), ("b", 70)]


def test_bucketed_range_join_equals_cross_join(spark):
    r = random.Random(3)
    s = spark.createDataFrame([(r.choice("ab"), r.randint(-500, 500)) for _ in range(300)], "g string, t bigint")
    e = spark.createDataFrame([(r.choice("ab"), r.randint(-500, 500)) for _ in range(40)], "g string, at bigint")
    got = peri.around(s, e, ["g"], "t", "at", 30, 50).select("g", "t", "at")
    want = s.alias("s").join(e.alias("e"), F.expr("s.g = e.g AND t > at - 30 AND t < at + 50")).select("s.g", "t", "at")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_events_kept_apart_depend_on_the_last_kept(spark):
    e = spark.createDataFrame([("a", t) for t in (0, 4, 8, 12, 12, 30)], "g string, at bigint")
    assert sorted(r.at for r in peri.keep_apart(e, ["g"], "at", 10).collect()) == [0, 12, 12, 30]


def test_ticks_carry_events(spark):
    got = spark.createDataFrame([("b", 100), ("b", 200)], "blockname string, ts bigint")
    sent = spark.createDataFrame([("b", "x", 1), ("b", "tick_clock_out", 5), ("b", "x", 7), ("b", "tick_clock_out", 15), ("b", "x", 18)], "blockname string, event_id_char string, ts bigint")
    out = align.by_ticks(got, sent).collect()
    assert sorted((r.ts, r.ts_rec_system) for r in out) == [(5, 100), (7, 102), (15, 200), (18, 203)]


def test_edges_and_peaks(spark):
    s = spark.createDataFrame([("b", t, v) for t, v in enumerate([0, 1, 1, 0, 0, 1])], "k string, t bigint, s int")
    assert sorted((r.onset, r.offset) for r in edges.edges(s, ["k"], "t", "s").collect()) == [(1, 3), (5, None)]
    assert sorted((r.onset, r.offset) for r in edges.edges(s, ["k"], "t", "s", last_high=True).collect()) == [(1, 2), (5, 5)]
    p = spark.createDataFrame([("b", t, float(v)) for t, v in enumerate([0, 5, 7, 7, 0, 0, 0, 9, 0])], "k string, t bigint, v double")
    assert [(r.event_time, r.v) for r in edges.peaks(p, ["k"], "t", "v", 1, 5.0, 0).orderBy("event_time").collect()] == [(2, 7.0), (7, 9.0)]


def test_response_sets_drop_the_open_tail(spark):
    e = spark.createDataFrame([("b", n, t) for n, t in (("x", 1), ("end", 2), ("x", 3), ("x", 4), ("end", 5), ("x", 6))], "blockname string, event_id_char string, event_ts bigint")
    assert sorted((r.event_ts, r.response_set) for r in edges.response_sets(e, "end").collect()) == [(1, 1), (2, 1), (3, 2), (4, 2), (5, 2)]
