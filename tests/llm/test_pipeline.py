import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).resolve().parent))
import test_ngram_join  # noqa: E402
import test_quality_rules  # noqa: E402
import test_toxicity  # noqa: E402

import corpus_pipeline  # noqa: E402
from tracewell.llm import quality_rules, tokens, toxicity  # noqa: E402


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents of all kinds: toxic and clean, good and bad, copies and near copies."""
    path = str(tmp_path_factory.mktemp("sf"))
    docs, toxic = test_toxicity.corpus(7, 400)
    rows, labels = list(docs), [(k, 1, y) for k, y in toxic]
    for k, t in test_ngram_join.corpus(8, 200):
        rows.append((1000 + k, t))
    for k in range(60):
        rows.append((2000 + k, " ".join(f"s{k}x{i} |" for i in range(30))))
        labels.append((2000 + k, 0, 0))
    rows += [(10, docs[10][1]), (10, docs[10][1]), (None, "one two three four five six seven eight nine ten eleven")]
    df = spark.createDataFrame([(k, t, "en", "src", len(t or "")) for k, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    df.repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def by_hand(spark, path):
    """Documents that stay, worked out row by row from the two fitted models."""
    docs, labels = (spark.read.parquet(f"{path}/{t}.parquet") for t in ("documents", "labels"))
    m = toxicity.fit(docs, labels)
    left = []
    for r in docs.collect():
        slots = next(toxicity.features(test_toxicity.pa.array([r.text], test_toxicity.pa.string())))
        if 1 / (1 + np.exp(-(m.bias + m.weights[slots].sum()))) < 0.5:
            left.append(r)
    clean = spark.createDataFrame(left, docs.schema)
    rules = quality_rules.learn(quality_rules.statistics(clean), labels)
    kept = []
    for r in left:
        n, chars, symbols, dup, repeat = test_quality_rules.by_hand(r.text)
        words, lines = test_quality_rules.WORD.findall(r.text or ""), [x for x in (r.text or "").split("\n") if x.split()]
        if n < 10 or 100 * repeat > 20 * n:
            continue
        value = {"words": n, "mean_word": chars / n, "symbol_share": symbols / n, "dup_line_share": dup / len(lines), "repeat_share": repeat / n, "words_a_line": n / len(lines), "distinct_share": len(set(words)) / n}
        if not any(all(value[t.stat] >= t.at if t.above else value[t.stat] < t.at for t in rule.tests) for rule in rules):
            kept.append(r)
    parts = test_ngram_join.brute([(r.doc_id, r.text) for r in kept if r.doc_id is not None], 5, 80)
    stay = {k: next(r.text for r in kept if r.doc_id == k) for k, (_, root) in parts.items() if k == root}
    return stay | {r.doc_id: r.text for r in kept if r.doc_id is None}


def test_pipeline_equals_stages_by_hand(spark, folder):
    got = corpus_pipeline.run(spark, folder).collect()
    library = Tokenizer.from_file(public_tokenizers.path(tokens.WORD_FILE))
    want = by_hand(spark, folder)
    assert 100 < len(want) < 600
    pieces = {}
    for p in got:
        pieces.setdefault(p.doc_id, []).append(p.length)
    assert {k: sum(v) for k, v in pieces.items()} == {k: len(library.encode(t, add_special_tokens=False).ids) + 1 for k, t in want.items()}


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality rules", "n-gram Jaccard join", "best-fit packing"]


def test_columns_that_clash_with_the_stages_own(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").where("doc_id < 150")
    names = ["n_words", "_bad", "_w", "_nth", "kept", "cls", "score", "_row", "key", "root", "length", "words"]
    more = docs.selectExpr("*", *[f"concat('x', doc_id) AS {c}" for c in names])
    for _, stage in corpus_pipeline.STAGES:
        plain, odd = stage(spark, docs, folder), stage(spark, more, folder)
        assert sorted(r.doc_id for r in odd.collect()) == sorted(r.doc_id for r in plain.collect())
        assert stage is corpus_pipeline.pack or {(r.doc_id, r.n_words, r["_nth"]) for r in odd.collect()} == {(r.doc_id, f"x{r.doc_id}", f"x{r.doc_id}") for r in plain.collect()}


def test_empty_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, folder).count() == 0
