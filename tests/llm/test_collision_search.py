import math

import numpy as np
import pyarrow as pa
import pytest

from tracewell.llm import collision_search

SCHEMA = "vec_id bigint, embedding array<float>, score string, rank int"


def run(spark, rows, **how):
    df = spark.createDataFrame([(k, v, "x", 1) for k, v in rows], SCHEMA).repartition(3)
    out = {}
    for r in collision_search.search(df, **how).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    return out


@pytest.mark.parametrize("block, n, d", [(400, 1500, 24), (8192, 1500, 64)])
def test_recall_against_brute_force(spark, monkeypatch, block, n, d):
    monkeypatch.setattr(collision_search, "BLOCK", block)
    g = np.random.default_rng(1)
    x = (g.standard_normal((n, d)) * g.uniform(0.5, 2, (n, 1))).astype(np.float32)
    got = run(spark, [(k, v.tolist()) for k, v in enumerate(x)])
    exact = x.astype(float)
    hits = 0
    for q in range(0, n, 20):
        scores = exact @ exact[q]
        scores[q] = -np.inf
        best = np.lexsort((np.arange(n), -scores))[:20]
        hits += len(set(best.tolist()) & {k for _, k, _ in got[q]})
        assert [r for r, _, _ in got[q]] == list(range(1, 21))
        assert all(s == pytest.approx(scores[k], rel=1e-12) for _, k, s in got[q])
        assert got[q] == sorted(got[q], key=lambda t: (-t[2], t[1]))
    assert hits >= 0.9 * 20 * len(got) and len(got) == len(range(0, n, 20))


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, np.array(r.embedding, float)) for r in table.collect()]
    ids, x = np.array([k for k, _ in rows]), np.stack([v for _, v in rows])
    hits = asked = 0
    found = {}
    for r in collision_search.search(table).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    for i in np.flatnonzero(ids % 20 == 0):
        scores = x @ x[i]
        scores[i] = -np.inf
        hits += len(found[ids[i]] & set(ids[np.argsort(-scores)[:20]].tolist()))
        asked += 20
    print("recall", hits / asked)
    assert hits >= 0.9 * asked


def test_copies_go_by_the_smaller_id(spark):
    rows = [(k, [1.0, 2.0, 3.0]) for k in range(200)] + [(k, [3.0, -1.0, 0.5]) for k in range(200, 260)]
    got = run(spark, rows, k=5)
    assert [k for _, k, _ in got[40]] == [0, 1, 2, 3, 4] and [k for _, k, _ in got[0]] == [1, 2, 3, 4, 5]


def test_unusable_vectors_take_no_part(spark):
    bad = [None, [], [0.0, 0.0], [1.0, None], [1.0, math.nan], [math.inf, 1.0]]
    rows = [(20 * k, v) for k, v in enumerate(bad)] + [(200, [1.0, 1.0]), (201, [2.0, 0.0]), (220, [1.0, 2.0, 3.0]), (None, [5.0, 5.0])]
    got = run(spark, rows)
    assert got == {200: [(1, 201, 2.0)]}


def test_few_rows_and_none(spark):
    assert run(spark, [(0, [1.0, 0.0]), (1, [-1.0, 0.0]), (2, [0.5, 0.5])]) == {0: [(1, 2, 0.5), (2, 1, -1.0)]}
    assert run(spark, []) == {}
    assert run(spark, [(0, [1.0])]) == {}


def test_repeated_ids_keep_their_answers(spark, monkeypatch):
    monkeypatch.setattr(collision_search, "MOST", 7)
    others = [(k, [float(k), 1.0]) for k in range(1, 13)]
    got = run(spark, others + [(20, [1.0, 0.0])] * 30, k=5)
    assert [(r, k) for r, k, _ in got[20]] == [(1, 12), (2, 11), (3, 10), (4, 9), (5, 8)]
    got = run(spark, others + [(20, [1.0, 0.0]), (20, [0.0, 2.0]), (20, [1.0, 0.0])], k=2)
    assert sorted(got[20]) == [(1, 1, 2.0), (1, 12, 12.0), (2, 2, 2.0), (2, 11, 11.0)]
    got = run(spark, [(0, [1.0, 0.0]), (1, [0.5, 0.0])] + [(2, [2.0, 0.0])] * 3, k=4)
    assert got == {0: [(1, 2, 2.0), (2, 2, 2.0), (3, 2, 2.0), (4, 1, 0.5)]}


def test_blocks_are_cut_inside_a_batch():
    n = 20
    batch = pa.RecordBatch.from_arrays([pa.array([2] * n, pa.int32()), pa.array([0] * n, pa.int32()), pa.array(range(n), pa.int64()), pa.array([[float(k), 1.0] for k in range(n)], pa.list_(pa.float32())), pa.array([1] * n, pa.int64())], names=["dimension", "block", "id", "v", "copies"])
    cut = [np.frombuffer(b.column(2)[0].as_py(), "<i8").tolist() for b in collision_search._packed("block", 7)(iter([batch, batch]))]
    assert [len(x) for x in cut] == [7, 7, 7, 7, 7, 5] and sum(cut, []) == [*range(n), *range(n)]
    assert collision_search.MOST < 65536
