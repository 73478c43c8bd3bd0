import random
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from tracewell.llm import ngram_join, wordhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def gram_set(text, size):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else frozenset()


def brute(docs, size, percent):
    sets = {k: gram_set(t, size) for k, t in docs}
    up = {k: k for k in sets}

    def root(k):
        while up[k] != k:
            k = up[k]
        return k

    keys = sorted(sets)
    for a in keys:
        for b in keys:
            both = len(sets[a] & sets[b])
            if a < b and sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = root(a), root(b)
                up[max(x, y)] = min(x, y)
    return {k: (len(sets[k]), root(k)) for k in sets}


def corpus(seed, n=220):
    r = random.Random(seed)
    vocabulary = [f"W{i}" for i in range(400)]
    passage = " ".join(r.choice(vocabulary) for _ in range(60))
    docs, texts = [], []
    for k in range(n):
        kind = r.random()
        if kind < 0.35 and texts:  # a near copy
            words = r.choice(texts).split(" ")
            for _ in range(r.randint(0, 1 + len(words) // 20)):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            text = " ".join(words)
        elif kind < 0.45 and texts:  # an exact copy, in other case and spacing
            text = r.choice(texts).upper().replace(" ", "\t\n")
        elif kind < 0.6:
            text = " ".join(r.choice(vocabulary) for _ in range(r.randint(0, 60))) + " " + passage
        else:
            text = " ".join(r.choice(vocabulary) for _ in range(r.choice([0, 1, 2, 3, 4, 30, 200])))
        texts.append(text)
        docs.append((k, text))
    return docs + [(n, None), (n + 1, ""), (n + 2, " \t\n"), (n + 3, "é x Ünder"), (n + 4, "É x Ünder")]


def found(spark, docs, **how):
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    return {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.joined(df, **how).collect()}


def test_components_equal_brute_force(spark):
    docs = corpus(1)
    assert found(spark, docs, size=4, percent=85) == brute(docs, 4, 85)


def test_many_blocks_and_frequent_grams_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 4)
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    docs = corpus(2)
    assert found(spark, docs, size=5, percent=80) == brute(docs, 5, 80)


def all_links(spark, docs, **how):
    """Links by pairs of texts' sets and by document, of the operator and by brute force."""
    size, percent = how["size"], how["percent"]
    sets = {k: gram_set(t, size) for k, t in docs}
    want, common = dict.fromkeys(sets, 0), {}
    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a != b and sets[a] and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                want[a] += 1
                if sets[a] != sets[b]:
                    common[frozenset([sets[a], sets[b]])] = both
    rows, pairs = ngram_join.links(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5), **how)
    rows = rows.collect()
    of = {r["class"]: sets[r.doc_id] for r in rows if r["class"] is not None}
    assert len(rows) == len(docs) and len(of) == len({s for s in sets.values() if s})
    assert all((r["class"] is None) == (not sets[r.doc_id]) and r.n_shingles == len(sets[r.doc_id]) for r in rows)
    found = [(frozenset([of[p.u], of[p.v]]), p.common) for p in pairs.collect()]
    assert len(found) == len({f for f, _ in found})
    components = brute(docs, size, percent)
    assert all(components[r.doc_id] == (r.n_shingles, r.component_id) for r in rows)
    return ({r.doc_id: r.n_links for r in rows}, dict(found)), (want, common)


def test_links_equal_brute_force(spark):
    got, want = all_links(spark, corpus(21), size=4, percent=85)
    assert got == want and want[1]


def test_links_between_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 4)
    monkeypatch.setattr(ngram_join, "FREQUENT", 3)
    words = [f"w{i}" for i in range(400)]
    chain = [(2000 + k, " ".join(words[k : k + 100])) for k in range(0, 60, 2)]
    got, want = all_links(spark, corpus(22, 120) + chain, size=5, percent=80)
    assert got == want and len(want[1]) > 100


def test_links_of_repeated_rows_nulls_and_an_empty_table(spark):
    rows = [(1, "a b c d e", 9), (1, "a b c d e", 9), (None, "a b c d e", 9), (2, None, 9), (None, "", 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, u int")
    of, pairs = ngram_join.links(df)
    assert sorted(((r.doc_id, r.n_shingles, r.n_links) for r in of.collect()), key=repr) == sorted([(1, 2, 2), (1, 2, 2), (None, 2, 2), (2, 0, 0), (None, 0, 0)], key=repr)
    assert pairs.collect() == []
    of, pairs = ngram_join.links(df.limit(0))
    assert of.collect() == [] and pairs.collect() == []


def test_repeated_rows_nulls_and_extra_columns(spark):
    rows = [(1, "a b c d e", "x", 9), (1, "a b c d e", "y", 9), (None, "a b c d e", "z", 9), (2, None, None, 9)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, cls string, n int")
    got = sorted(map(tuple, ngram_join.joined(df).collect()), key=repr)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (2, 0, 2)], key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert ngram_join.joined(df).collect() == []


def test_hashes_equal_for_equal_words_only():
    texts = ["Ab cd  ef", "ab\tCD\nEF", "abc def", "", None, "é ab", "x" * 5000 + " y"]
    data, offsets = wordhash.text_bytes(pa.array(texts))
    docs, (h,) = wordhash.word_hashes(data, offsets)
    words = [w.lower() if w.isascii() else w for t in texts for w in WORD.findall(t or "")]
    assert len(h) == len(words) and docs.tolist() == [0, 0, 0, 1, 1, 1, 2, 2, 5, 5, 6, 6]
    by = defaultdict(set)
    for w, x in zip(words, h.tolist()):
        by[w].add(x)
    assert all(len(v) == 1 for v in by.values()) and len({x for v in by.values() for x in v}) == len(by)


def test_long_texts_are_cut_between_words(monkeypatch):
    text = " ".join(f"word{i % 97}" for i in range(3000))
    data, offsets = wordhash.text_bytes(pa.array([text, "tail word1"]))
    whole = wordhash.word_hashes(data, offsets)[1][0]
    monkeypatch.setattr(wordhash, "CHUNK", 100)
    assert np.array_equal(wordhash.word_hashes(data, offsets)[1][0], whole)


@pytest.mark.parametrize("percent", [80, 85])
def test_bitmap_bound_is_never_below_the_overlap(percent):
    g = np.random.default_rng(4)
    for _ in range(50):
        n, m = g.integers(5, 400, 2)
        pool = g.integers(0, 2**63, 500, dtype=np.uint64)
        a, b = np.unique(g.choice(pool, n)), np.unique(g.choice(pool, m))
        rows = [(1, len(a), ngram_join.bitmap(a, ngram_join.width(len(a))), True), (2, len(b), ngram_join.bitmap(b, ngram_join.width(len(b))), True)]
        both = len(np.intersect1d(a, b))
        if 100 * both >= percent * (len(a) + len(b) - both):
            assert ngram_join._tile(rows, percent)


def test_no_group_meets_in_one_task(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 4)
    sizes, once = spark.sparkContext.accumulator(0), ngram_join._against

    def watched(size, percent):
        run = once(size, percent)

        def counted(pdf):
            sizes.add(len(pdf) > 40)
            return run(pdf)

        return counted

    monkeypatch.setattr(ngram_join, "_against", watched)
    shared = " ".join(f"s{i}" for i in range(60))  # with 14 words of their own: Jaccard 0.67
    docs = [(k, shared + " " + " ".join(f"own{k}x{i}" for i in range(14))) for k in range(120)] + [(200, shared + " end")]
    monkeypatch.setattr(ngram_join, "_tile", lambda rows, percent: [(rows[0][0], r[0]) for r in rows[1:]])
    assert found(spark, docs) == brute(docs, 4, 85)
    assert sizes.value == 0


def test_null_ids_find_their_own_text_only(spark, monkeypatch):
    seen = []
    saved = ngram_join.saved
    monkeypatch.setattr(ngram_join, "saved", lambda df, kind: seen.append((kind, out := saved(df, kind))) or out)
    base = [" ".join(f"w{k}x{i}" for i in range(40)) for k in range(12)]
    rows = [(None, t) for t in base] + [(None, t + " more") for t in base] + [(None, base[0])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert sorted((r.n_shingles, r.component_id) for r in ngram_join.joined(df).collect()) == [(37, None)] * 13 + [(38, None)] * 12
    assert dict(seen)["members"].count() == 24


def test_large_tiles_are_cut_in_cells(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "TILE", 6)
    monkeypatch.setattr(ngram_join, "SAMPLED", 1)
    cut, once = [], ngram_join._celled
    monkeypatch.setattr(ngram_join, "_celled", lambda rows, sig: cut.append(once(rows, sig)) or cut[-1])
    docs = corpus(11, 150)
    assert found(spark, docs, size=4, percent=85) == brute(docs, 4, 85)
    assert cut[0].select("cell").distinct().count() > 3


def test_many_clusters_in_one_possible_component(spark, monkeypatch):
    """A chain of near copies, none of which is close to most others: tasks stay at a block and a batch."""
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 4)
    most, once = spark.sparkContext.accumulator(0), ngram_join._against

    def watched(size, percent):
        run = once(size, percent)

        def counted(pdf):
            most.add(len(pdf) > 24)
            return run(pdf)

        return counted

    monkeypatch.setattr(ngram_join, "_against", watched)
    words = [f"w{i}" for i in range(400)]
    docs = [(k, " ".join(words[2 * k : 2 * k + 100])) for k in range(0, 140, 3)] + [(1000 + k, " ".join(words[2 * k : 2 * k + 100])) for k in range(1, 140, 50)]
    assert found(spark, docs) == brute(docs, 4, 85)
    assert most.value == 0


def test_sets_with_half_a_hash_in_common_stay_apart(spark):
    rows = [(1, 11, 3, 5, 70), (2, 12, 3, 5, 70), (3, 13, 3, 5, 71), (4, 14, 4, 5, 72), (5, 15, 0, 0, 0)]
    sig = spark.createDataFrame(rows, "key bigint, hash bigint, n bigint, cls bigint, check bigint")
    told, classes = ngram_join._classes(sig)
    by = {r.key: r.cls for r in told.collect()}
    assert by[1] == by[2] and len({by[1], by[3], by[4]}) == 3
    assert sorted((r.first, r.copies) for r in classes.collect()) == [(1, 2), (3, 1), (4, 1)]
    whole, again = ngram_join._classes(sig.where("key in (1, 2)"))
    assert whole.count() == 2 and [(r.cls, r.copies) for r in again.collect()] == [(5, 2)]


def test_blocks_of_far_sizes_never_meet(spark, monkeypatch):
    """A possible component of many sizes: a class visits only blocks that hold sizes within the bound."""
    monkeypatch.setattr(ngram_join, "BLOCK_CLASSES", 4)
    members = spark.createDataFrame([(1, c, n) for c, n in enumerate([10] * 9 + list(range(11, 60)) + [200, 201, 202] + list(range(300, 320)))], "comp bigint, cls bigint, n bigint")
    rows = {r.n: r for r in ngram_join._by_size(members, 80).collect()}
    for n, r in rows.items():
        near = [x for m, x in rows.items() if 100 * min(n, m) >= 80 * max(n, m)]
        assert r.low <= min(x["at"] for x in near) and r.high >= max(x["at"] + x.parts - 1 for x in near)
        far = [x for m, x in rows.items() if 100 * min(n, m) < 78 * max(n, m)]
        assert all(x["at"] + x.parts - 1 <= r.low or x["at"] >= r.high for x in far)
    assert rows[10].parts == 3 and rows[10].high < rows[200].low and rows[200].high <= rows[300].low
    sizes = [r.n for r in members.collect()]
    assert max(r.blocks for r in rows.values()) <= len(sizes) // 4 + 3


def test_bit_counts_come_before_intersections():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (50, 55, 60, 300, 310)]
    sets += [np.unique(np.concatenate([sets[0][:48], rng.integers(0, 2**63, 3).astype(np.uint64)])), sets[4][:300]]
    held = ngram_join._Sets(sets)
    for grams in sets:
        near = np.array([k for k, s in enumerate(sets) if 100 * min(len(s), len(grams)) >= 80 * max(len(s), len(grams))])
        want = [k for k in near if 100 * len(np.intersect1d(grams, sets[k])) >= 80 * len(np.union1d(grams, sets[k]))]
        left = held._possible(grams, near, 80)
        assert set(want) <= set(left.tolist()) < set(near.tolist()) | {-1}
        assert held.linked(grams, np.arange(len(sets)), 80).tolist() == want
