import pyarrow as pa
from pyspark.sql import functions as F

from tracewell.operators import shape
from tracewell.sources import files, textlog

BOX = "File: C:\\x\r\n\r\n\r\nStart Date: 08/18/20\r\nSubject: m1\r\nExperiment: e\r\nGroup: 0\r\nStart Time:  9:23:01\r\nV:      33.000\r\nC:\r\n     0:        0.000        5.000\r\n     5:        7.000\r\n\r\nStart Date: 08/19/20\r\nSubject: m2\r\nC:\r\n     0:        1.000\r\n"


def test_box_log(spark):
    texts = spark.createDataFrame([("f", BOX), ("empty", ""), ("none", None)], "file string, text string")
    got = [(r.n_sbj, r.med_var, r["index"], r.value) for r in textlog.box_values(texts).orderBy("n_sbj", "med_var", "index").collect()]
    assert [x for x in got if x[1] == "C"] == [(1, "C", 1, "0.000"), (1, "C", 2, "5.000"), (1, "C", 3, "7.000"), (2, "C", 1, "1.000")]
    assert (1, "Start Time", 1, "9:23:01") in got and (2, "Subject", 1, "m2") in got and not any(x[1] == "File" for x in got)


def test_tracking_files(spark):
    head = '"Number of header lines:",6,\n"Subject",{s},\n"Video start time",01/02/2024 10:00:00,\n"",,\n"Trial time","X center","R"\n"(s)","(cm)",\n'
    texts = spark.createDataFrame([("a", head.format(s="m1") + "0.0,1.5,\n0.1,-,\n"), ("b", head.format(s="NA") + "0.0,1,\n"), ("c", "junk")], "file string, text string")
    assert [(r.file, r.trial_time, r.x_center) for r in textlog.tracking_samples(texts, ["trial_time", "x_center"]).orderBy("trial_time").collect()] == [("a", 0.0, 1.5), ("a", 0.1, None)]
    assert [(r.file, r.date) for r in textlog.tracking_parameters(texts, ["subject"]).collect()] == [("a", "01/02/2024")]


def test_serial_lines_with_odd_ends(spark):
    texts = spark.createDataFrame([("f", "1 1000\r\r\n3 1.25\r\r\n9 7\r\r\n\r\r\n4 5\r\r\n")], "file string, text string")
    key = spark.createDataFrame([(1, "lick", "event"), (3, "ratio", "parm"), (4, "trial_x", "param_dynamic")], "event_id int, event_id_char string, id_type string")
    tables = textlog.serial_tables(textlog.serial_rows(texts), key)
    assert [tuple(r) for r in tables["event"].collect()] == [("f", "lick", 1.0)]
    assert [tuple(r) for r in tables["param"].collect()] == [("f", "ratio", 1.25)]
    assert [tuple(r) for r in tables["param_dynamic"].collect()] == [("f", "trial_x", 1.0, 5.0)]


def test_arrow_files_and_nan(spark, tmp_path):
    t = pa.table({"blockname": ["b", "b"], "v": [1.0, float("nan")]})
    with pa.OSFile(str(tmp_path / "x.feather"), "wb") as out, pa.ipc.new_file(out, t.schema) as w:
        w.write_table(t)
    assert [r.v for r in files.load(spark, f"{tmp_path}/x.feather", "blockname string, v double").collect()] == [1.0, None]


def test_combine_appends_only_new_files(spark, tmp_path):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "med_file_name string, v int")
    files.combine(df.where("v = 1"), f"{tmp_path}/c")
    assert sorted(map(tuple, files.combine(df, f"{tmp_path}/c").collect())) == [("a", 1), ("b", 2)]
    assert sorted(map(tuple, files.combine(df.where("v = 2"), f"{tmp_path}/c", append=False).collect())) == [("b", 2)]


def test_work_list_tells_both_differences(spark):
    i = spark.createDataFrame([("x_a.csv",), ("y_a.csv",)], "fn string")
    o = spark.createDataFrame([("y_b.csv",), ("z_b.csv",)], "fn string")
    a, b = files.work_list(i, o, ["_a.csv", "_b.csv"])
    assert [r.stem for r in a.collect()] == ["x"] and [r.stem for r in b.collect()] == ["z"]


def test_names_and_types(spark):
    assert shape.clean_name("Trial time (s)") == "trial_time_s" and shape.clean_name("xCenter") == "x_center"
    a, b = spark.createDataFrame([(1,)], "k int"), spark.createDataFrame([("x",)], "k string")
    assert sorted(r.k for r in files.united([a, b]).collect()) == ["1", "x"]


def test_colours(spark):
    df = spark.createDataFrame([(100,), (490,), (600,), (None,)], "w int")
    assert [r.c for r in df.select(shape.wavelength_colour(F.col("w")).alias("c")).collect()] == ["#000000", "#00FFFF", "#FFBE00", "#000000"]


def test_a_large_arrow_file_is_read_by_runs_and_columns(spark, tmp_path, monkeypatch):
    from tracewell.sources import arrow

    t = pa.table({"k": list(range(1000)), "s": [f"n{k}" for k in range(1000)], "unused": ["x" * 50] * 1000})
    for name in ("a", "b"):
        with pa.OSFile(f"{tmp_path}/{name}.arrow", "wb") as out, pa.ipc.new_file(out, t.schema) as w:
            for k in range(0, 1000, 100):
                w.write_batch(t.slice(k, 100).to_batches()[0])
    monkeypatch.setattr(arrow, "RUN", 20_000)
    assert arrow.plan(spark, str(tmp_path)).count() > 4
    got = files.load(spark, f"{tmp_path}/*.arrow", "s string, k int, missing double")
    assert got.columns == ["s", "k", "missing"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(f"n{k}", k, None) for k in range(1000)] * 2, key=str)


def test_files_of_one_schema_are_one_scan(spark, tmp_path):
    for k in range(6):
        value = F.lit(k) if k % 2 else F.lit(f"v{k}")
        spark.range(2).select("id", value.alias("v")).coalesce(1).write.parquet(f"{tmp_path}/in{k}")
        (next((tmp_path / f"in{k}").glob("part-*.parquet"))).rename(tmp_path / f"in{k}" / f"ses_{k}_events.parquet")
    spark.range(9).coalesce(1).write.parquet(f"{tmp_path}/other")
    df = files.read_united(spark, str(tmp_path), holds=["ses"], starts=["ses_"], ends="_events")
    assert sorted((r.fn, r.v) for r in df.select("fn", "v").distinct().collect()) == [(f"ses_{k}", str(k) if k % 2 else f"v{k}") for k in range(6)]
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2


def test_commits_are_whole_and_added_once(spark, tmp_path):
    import pytest

    from tracewell.sources import commits

    path = f"{tmp_path}/d"
    one, two = (spark.createDataFrame([("a", k), ("b" if k == 1 else "c", k)], "blockname string, v int") for k in (1, 2))
    rows = lambda key="blockname": sorted(map(tuple, commits.read(spark, path, key).collect()))
    with pytest.raises(FileNotFoundError):
        commits.read(spark, path)
    files.write_sessions(one, path, token="b0")
    assert rows() == [("a", 1), ("b", 1)]
    two.write.parquet(f"{path}/_batch=00000001-dead")  # a job that died before its commit
    assert rows() == [("a", 1), ("b", 1)]
    files.write_sessions(two, path, token="b1")
    files.write_sessions(two, path, token="b1")  # and ran again, twice
    assert rows() == [("a", 2), ("b", 1), ("c", 2)]
    files.write_sessions(one, path, overwrite=False)
    assert rows() == [("a", 2), ("b", 1), ("c", 2)]
    commits.compact(spark, path, "blockname")
    assert rows() == [("a", 2), ("b", 1), ("c", 2)] and len(commits.records(spark, path)) == 1


def test_a_batch_that_runs_again_is_there_once(spark, tmp_path):
    from tracewell.streaming import incremental

    source, target, seen = (f"{tmp_path}/{k}" for k in ("in", "out", "seen"))
    df = spark.createDataFrame([("a", 1), ("b", 2)], "blockname string, v int")
    df.where("v = 1").write.parquet(source)

    def dies(batch):
        raise ValueError("lost")

    for process, more in ((dies, None), (lambda b: b, None), (lambda b: b, df.where("v = 2"))):
        if more is not None:
            more.write.mode("append").parquet(source)
        try:
            incremental.process_new_files(spark, source, df.schema, process, target, seen)
        except Exception as e:  # the stream reports what its batch raised
            assert "lost" in str(e)
    assert sorted(map(tuple, files.read_sessions(spark, target).collect())) == [("a", 1), ("b", 2)]


def test_scratch_is_cleared(spark):
    from tracewell.sources import scratch

    scratch._MADE.clear()
    kept = scratch.saved(spark.range(3), "x")
    assert kept.count() == 3 and scratch.clear() == 1 and scratch.clear() == 0


def box_subject(name, group, scalars, arrays, day="03/05/24"):
    """A subject of an operant-box file, as the boxes write it: rows of five values, each after its number."""
    lines = ["\r", "\r", f"Start Date: {day}", f"End Date: {day}", f"Subject: {name}", "Experiment: xy", f"Group: {group}", "Box: 2", "Start Time:  8:05:09", "End Time:  9:05:11", "MSN: own_program"]
    lines += [f"{k}:{v:12.3f}" for k, v in scalars.items()]
    for k, values in arrays.items():
        lines.append(f"{k}:")
        lines += [f"{a:6d}:" + "".join(f"{v:13.3f}" for v in values[a : a + 5]) for a in range(0, len(values), 5)]
    return lines


def test_box_file_to_tidy_tables(spark):
    counts = [0.0] * 21
    counts[9], counts[12] = 7.0, 4.0
    one = box_subject("xy01", "1", {"T": 3600, "V": 33}, {"A": [0.0, 60.0] + [0.0] * 19, "C": counts, "E": [1, 3, 4, 9, 1, 2, 77], "F": [0.5, 1.25, 2, 3, 4, 5, 6.125]})
    two = box_subject("xy02", "0", {"T": 1800}, {"C": [0.0] * 12 + [2.0], "E": [3.0], "F": [12.5]})
    text = "\r\n".join(["File: C:\\boxes\\xy_2024_03_05", "", *one, *two]) + "\r\n"
    texts = spark.createDataFrame([("2024_03_05_xy", text)], "file string, text string")
    variables = spark.createDataFrame([("right", "C", "10"), ("left", "C", "13"), ("event_id", "E", "vector"), ("event_ts", "F", "vector")], "id string, med_var string, index string")
    names = spark.createDataFrame([(1, "lick"), (3, "cue_on"), (4, "cue_off"), (9, "pump")], "event_id int, event_id_char string")
    values = textlog.box_values(texts)
    tidy = textlog.box_univariate(values, variables, ["right", "left"]).select("file", "n_sbj", "right", "left", "experiment", "group", "start_date", "subject")
    assert sorted(map(tuple, tidy.collect())) == [("2024_03_05_xy", 1, 7.0, 4.0, "xy", "1", "03/05/24", "xy01"), ("2024_03_05_xy", 2, 0.0, 2.0, "xy", "0", "03/05/24", "xy02")]
    events = textlog.box_events(values, variables, names, ["event_id", "event_ts"]).select("n_sbj", "event_num", "event_id", "event_ts", "event_id_char")
    told = {1: "lick", 3: "cue_on", 4: "cue_off", 9: "pump"}
    want = [(1, k + 1, e, t, told.get(e)) for k, (e, t) in enumerate(zip([1, 3, 4, 9, 1, 2, 77], [0.5, 1.25, 2.0, 3.0, 4.0, 5.0, 6.125]))] + [(2, 1, 3, 12.5, "cue_on")]
    assert sorted(map(tuple, events.collect()), key=lambda r: r[:2]) == want
    assert sorted((r.n_sbj, r.value) for r in values.where("med_var = 'T'").collect()) == [(1, "3600.000"), (2, "1800.000")]
    assert values.where("n_sbj = 1 AND med_var = 'A'").count() == 21
