import math
import random
import re
from collections import Counter

import pytest

from tracewell.llm import queries, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    bags = [Counter(terms(t)) for _, t in docs]
    sizes = [sum(b.values()) for b in bags]
    rows, total = sum(n > 0 for n in sizes), sum(sizes)
    holding = Counter(t for b in bags for t in b)
    out = []
    for item, text in items:
        scores = []
        for (key, _), bag, n in zip(docs, bags, sizes):
            score = 0
            for t in terms(text):
                if bag[t]:
                    w = math.floor(1000 * math.log((2 * rows + 2) / (2 * holding[t] + 1)))
                    score += w * (1000000000 * bag[t] // (1000 * bag[t] + 12 * (75 + 25 * n * rows // total)))
            if score > 0:
                scores.append((-score, key is not None, key or 0, key))
        out += [(item, rank, e[3], -e[0]) for rank, e in enumerate(sorted(scores, key=lambda e: e[:3])[:k], 1)]
    return sorted(out, key=repr)


def found(spark, docs, items, k=20, **settings):
    d = spark.createDataFrame([(a, b, 1, "x") for a, b in docs], "doc_id bigint, text string, rank int, query string").repartition(3)
    i = spark.createDataFrame([(a, b, "k") for a, b in items], "item_id bigint, text string, key string")
    return sorted((tuple(r) for r in ranked_search.search(d, i, k, **settings).select("item_id", "rank", "doc_id", "score").collect()), key=repr)


ODD = [(None, "alpha beta"), (None, None), (5, ""), (5, "alpha"), (5, "alpha"), (6, "ALPHA\x00alpha_beta É é Σ漢字 x"), (7, "...")]
ITEMS = [(1, "Alpha alpha beta"), (1, "Alpha alpha beta"), (None, "É 漢字"), (2, None), (3, ""), (4, "nothing-here zzz"), (9, "é w1 w2 w3 w1")]


def crowd(seed, n):
    r = random.Random(seed)
    return [(k, " ".join(f"w{int(r.expovariate(0.2))}" for _ in range(r.randint(0, 40)))) for k in range(n)]


@pytest.mark.parametrize("k, settings", [(20, {}), (3, {"window": 16}), (20, {"window": 64, "block": 12}), (1, {"window": 8})])
def test_equals_brute_force(spark, k, settings):
    docs = ODD + crowd(1, 150)
    assert found(spark, docs, ITEMS, k, **settings) == brute(docs, ITEMS, k)


def test_ties_go_to_the_smallest_key(spark):
    docs = [(k, "same words here") for k in range(200, 0, -1)] + [(1000 + k, "other") for k in range(50)]
    got = found(spark, docs, [(1, "words")], 20, window=32)
    assert [r[2] for r in sorted(got, key=lambda r: r[1])] == list(range(1, 21)) and got == brute(docs, [(1, "words")], 20)


def test_very_long_texts_and_few_counts_at_once(spark, monkeypatch):
    docs = [(1, "a b c " * 40_000), (2, "a"), (3, "b " * 3)]
    assert found(spark, docs, [(1, "a b")]) == brute(docs, [(1, "a b")], 20)


def test_empty_tables(spark):
    assert found(spark, [], ITEMS) == [] and found(spark, ODD, []) == [] and found(spark, [(1, None)], ITEMS) == []


def test_common_terms_can_weigh_nothing(spark):
    docs = [(k, "a") for k in range(2000)]
    assert found(spark, docs, [(1, "a")]) == brute(docs, [(1, "a")], 20) == []


def test_the_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    read = lambda name, key: [(r[key], r.text) for r in spark.read.parquet(f"{sf}/{name}.parquet").collect()]
    got = queries.op12_ranked_search(spark, sf).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got), key=repr) == brute(read("documents", "doc_id"), read("benchmark", "item_id"), 20)
