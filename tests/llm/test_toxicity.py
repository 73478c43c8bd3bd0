import random
import zlib

import numpy as np
import pyarrow as pa

from tracewell.llm import toxicity

WORDS = [f"w{i}" for i in range(300)]


def corpus(seed, n=900, biased=False):
    """Toxic texts hold a slur; with `biased` they also name one group far more often than others do."""
    r = random.Random(seed)
    docs, labels = [], []
    for k in range(n):
        toxic = k % 4 == 0
        words = [r.choice(WORDS) for _ in range(r.randint(5, 60))]
        if toxic:
            words.insert(r.randrange(len(words)), r.choice(["vilestuff", "Badword,", "slurring"]))
        if r.random() < (0.9 if toxic and biased else 0.1):
            words.insert(0, "women")
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    return docs, labels


def model(spark, docs, labels, **how):
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    return d, toxicity.fit(d, spark.createDataFrame(labels, "doc_id bigint, toxic int"), **how)


def test_held_out_accuracy(spark):
    docs, labels = corpus(1)
    d, m = model(spark, docs, labels)
    got = {r.doc_id: r.predicted for r in toxicity.scored(d, m).collect()}
    right = [got[k] == y for k, y in labels if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean(right) > 0.95


def test_labels_of_the_held_out_fold_are_never_used(spark):
    docs, labels = corpus(2)
    held = [(k, 1 - y) if zlib.crc32(str(k).encode()) % 5 == 0 else (k, y) for k, y in labels]
    _, a = model(spark, docs, labels)
    _, b = model(spark, docs, held)
    assert np.array_equal(a.weights, b.weights) and a.bias == b.bias


def test_counterfactuals_take_the_weight_off_a_group(spark):
    docs, labels = corpus(3, biased=True)
    slots = next(toxicity.features(pa.array(["women"])))
    plain, fair = (model(spark, docs, labels, counterfactual=c)[1].weights[slots].sum() for c in (0.0, 30.0))
    assert plain > 1 and abs(fair) < 0.5 * plain


def test_counterfactuals_spare_neutral_mentions(spark):
    """Held-out clean texts that name the group: fewer are taken for toxic, and no toxic one is lost."""
    docs, labels = corpus(6, n=1600, biased=True)
    y = dict(labels)
    found = {}
    for c in (0.0, 100.0):
        d, m = model(spark, docs, labels, counterfactual=c)
        got = {r.doc_id: r for r in toxicity.scored(d, m).collect()}
        held = [k for k, _ in docs if zlib.crc32(str(k).encode()) % 5 == 0]
        neutral = [k for k in held if not y[k] and dict(docs)[k].startswith("women")]
        assert len(neutral) > 10
        found[c] = np.mean([got[k].score for k in neutral]), np.mean([got[k].predicted for k in held if y[k]])
    assert found[100.0][0] < 0.7 * found[0.0][0] and found[100.0][1] >= 0.97


def test_counterfactuals_make_fewer_false_positives(spark):
    """Half of the toxic texts hold no slur, only the group's name: a plain classifier takes the name for the
    cause. On held-out texts the penalty takes fewer clean mentions for toxic and still finds the slurs."""
    docs, labels = corpus(8, n=2400, biased=True)
    r, y = random.Random(9), dict(labels)
    slurs = ("vilestuff", "Badword,", "slurring")
    docs = [(k, " ".join(w for w in t.split() if w not in slurs) if y[k] and r.random() < 0.5 else t) for k, t in docs]
    held = [k for k, _ in docs if zlib.crc32(str(k).encode()) % 5 == 0]
    texts, wrong, right = dict(docs), {}, {}
    for c in (0.0, 100.0):
        d, m = model(spark, docs, labels, counterfactual=c)
        got = {r.doc_id: r.predicted for r in toxicity.scored(d, m).collect()}
        wrong[c] = sum(got[k] for k in held if not y[k] and texts[k].startswith("women"))
        right[c] = np.mean([got[k] for k in held if y[k] and any(w in texts[k].split() for w in slurs)])
    assert wrong[0.0] >= 10 and wrong[100.0] <= 0.3 * wrong[0.0], wrong
    assert right[100.0] >= 0.97, right


def test_swaps_look_at_the_words_of_a_sentence(spark):
    names = toxicity._names((("Aa", "bb", "cc"),))
    assert toxicity._swapped("x (aa) y. Aa!\nz bb, q", names) == {("x (aa) y.", "x (bb) y."), ("x (aa) y.", "x (cc) y."), ("Aa!", "bb!"), ("Aa!", "cc!"), ("z bb, q", "z Aa, q"), ("z bb, q", "z cc, q")}
    far = toxicity._swapped("w " * 500 + "aa" + " v" * 500, names)
    assert {len(a.split()) for a, _ in far} == {2 * toxicity.NEAR + 1} and len(far) == 2
    assert toxicity._swaps("none here", names) == []
    docs, labels = corpus(3, biased=True)
    slots = next(toxicity.features(pa.array(["women"])))
    other, own = (model(spark, docs, labels, counterfactual=30.0, identities=i)[1].weights[slots].sum() for i in ((("aa", "bb"),), (("women", "people"),)))
    assert abs(own) < 0.5 * other


def test_defined_cases(spark):
    docs, labels = corpus(4, n=300)
    odd = [(1000, None), (1001, ""), (1002, "badword " * 200_000), (5, "w1"), (5, "w1")]
    d, m = model(spark, docs, labels + [(7, None), (8, 0), (8, 1), (None, 1)])
    d2 = spark.createDataFrame([(k, t, "x", 0.0) for k, t in odd], "doc_id bigint, text string, y string, score double")
    got = [(r.doc_id, r.score) for r in toxicity.scored(d2, m).collect()]
    assert len(got) == 5 and all(0 <= s <= 1 for _, s in got)
    assert got[0][1] == got[1][1] and got[3] == got[4] and got[2][1] > 0.5


def test_no_labels_or_one_class(spark):
    docs, labels = corpus(5, n=40)
    for rows in ([], [(k, 0) for k, _ in labels]):
        d, m = model(spark, docs, rows)
        assert {r.predicted for r in toxicity.scored(d, m).collect()} == {0}
    assert toxicity.scored(spark.createDataFrame([], "doc_id bigint, text string"), m).collect() == []
