import random
import re
from collections import Counter

from tracewell.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    text = text or ""
    words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(grams)
    covered = {k for i, g in enumerate(grams) if seen[g] > 1 for k in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def texts(seed):
    r = random.Random(seed)
    words = ["a", "b", "cé", "#x", "|", "漢字", "😀", " ", "\u0085d", "e<f>"]
    made = ["".join(r.choice(words) + r.choice([" ", " ", "\n", "\t", "\r\n", "  ", "\x0b"]) for _ in range(r.choice([0, 3, 5, 6, 12, 60, 300]))) for _ in range(120)]
    return made + [None, "", " ", "\n\n", "x " * 50_000, "a b c d e", "a b c d e a b c d e", "same\nsame\n same"]


def test_counts_equal_plain_python(spark):
    rows = list(enumerate(texts(1)))
    df = spark.createDataFrame([(k, t, 5) for k, t in rows], "doc_id bigint, text string, n_words int")
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality_rules.statistics(df).collect()}
    assert got == {k: by_hand(t) for k, t in rows}


def labelled(spark, n=600):
    r = random.Random(2)
    docs, labels = [], []
    for k in range(n):
        words = [f"w{r.randrange(4000)}" for _ in range(r.randint(20, 80))]
        kind = k % 10
        if kind == 0:
            words = [w + "|" for w in words]
        elif kind == 1:
            words = [w * 12 for w in words]
        docs.append((k, " ".join(words)))
        labels.append((k, int(kind > 1)))
    return spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels + [(5, None), (6, 0)], "doc_id bigint, quality int"), labels


def test_rules_are_learned_and_native(spark):
    docs, labels, known = labelled(spark)
    stats = quality_rules.statistics(docs)
    rules = quality_rules.learn(stats, labels)
    assert 1 <= len(rules) <= 6 and all("->" in str(r) for r in rules)
    judged = quality_rules.judged(stats, rules)
    kept = {r.doc_id: r.kept for r in judged.collect()}
    assert sum(kept[k] == bool(y) for k, y in known) > 0.97 * len(known)
    plan = judged._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_conjunctions_are_grown_and_held_out_documents_follow(spark):
    """Bad: short words and few to a line, both; either alone is good. A third of the labels is held out."""
    r = random.Random(4)
    docs, labels = [], []
    for k in range(1500):
        short, thin = r.random() < 0.4, r.random() < 0.4
        words = [("ab" if short else "longwordhere") + str(r.randrange(90000)) for _ in range(60)]
        docs.append((k, ("\n" if thin else " ").join(words)))
        labels.append((k, int(not (short and thin))))
    stats = quality_rules.statistics(spark.createDataFrame(docs, "doc_id bigint, text string"))
    rules = quality_rules.learn(stats, spark.createDataFrame([x for x in labels if x[0] % 3], "doc_id bigint, quality int"))
    assert max(len(x.tests) for x in rules) >= 2
    kept = {x.doc_id: x.kept for x in quality_rules.judged(stats, rules).collect()}
    held = [(k, y) for k, y in labels if k % 3 == 0]
    assert sum(kept[k] == bool(y) for k, y in held) > 0.97 * len(held)


def test_the_first_rule_met_decides(spark):
    rules = [quality_rules.Rule((quality_rules.Test("words", True, 30.0),), keep=True), quality_rules.Rule((quality_rules.Test("words", True, 20.0),))]
    rows = spark.createDataFrame([(n, " ".join(f"w{i}" for i in range(n))) for n in (15, 25, 35)], "doc_id bigint, text string")
    assert {r.doc_id: r.kept for r in quality_rules.judged(quality_rules.statistics(rows), rules).collect()} == {15: True, 25: False, 35: True}


def test_without_labels_only_the_base_decides(spark):
    docs, labels, _ = labelled(spark, 60)
    stats = quality_rules.statistics(docs)
    assert quality_rules.learn(stats, labels.limit(0)) == []
    assert quality_rules.learn(stats, labels.where("quality = 1")) == []
    rows = spark.createDataFrame([(1, "few words"), (2, " ".join(f"w{i}" for i in range(10))), (3, "a b c d e " * 4), (4, None)], "doc_id bigint, text string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in quality_rules.judged(quality_rules.statistics(rows), []).collect()}
    assert got == {1: (True, False), 2: (False, True), 3: (True, False), 4: (True, False)}
    assert quality_rules.judged(quality_rules.statistics(rows.limit(0)), []).collect() == []
