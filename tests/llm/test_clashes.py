"""Extra columns, whatever they are called, change no operator's result; null ids are defined."""

import pytest
from pyspark.sql import functions as F

from tracewell.llm import byte_bpe, chat, collision_search, html_wrappers, packing, quality_rules, queries, token_files, toxicity
from tracewell.llm.common import table

SF = "/root/testdata/sf0.001"
NAMES = ["y", "n", "_turn", "turn_", "id", "v", "host", "salt", "wrapper", "_w", "n_words", "_row", "length", "piece", "start", "key", "_hash", "block", "score", "ids", "rank", "_n", "k", "words", "kept", "ids_crc32"]


def more(df):
    taken = set(df.columns)
    return df.withColumns({c: F.lit(f"extra {c}") for c in NAMES if c not in taken})


def rows(df, drop=()):
    return sorted((tuple(r) for r in df.drop(*drop).collect()), key=repr)


def scores(spark, docs):
    labels = more(table(spark, SF, "labels"))
    return toxicity.scored(docs, toxicity.fit(docs, labels)).select("doc_id", F.round("score", 9), "predicted")


CASES = {
    "op1": ("documents", scores, ()),
    "op4": ("documents", lambda spark, d: byte_bpe.round_trip(d), ()),
    "op6": ("embeddings", lambda spark, d: collision_search.search(d, every=20, k=5), ()),
    "op7": ("pages", lambda spark, d: html_wrappers.extracted(d), ()),
    "op8": ("documents", lambda spark, d: quality_rules.statistics(d).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"), ()),
    "op9": ("documents", lambda spark, d: token_files.read(token_files.write(d), "bigint"), ()),
    "op10": ("documents", lambda spark, d: packing.pack(d), ("sequence_id", "offset")),
}


@pytest.mark.parametrize("name", CASES)
def test_extra_columns_change_nothing(spark, name):
    source, run, free = CASES[name]
    df = table(spark, SF, source).limit(60)
    df = spark.createDataFrame(df.collect(), df.schema)
    assert rows(run(spark, more(df)), free) == rows(run(spark, df), free)


def test_extra_columns_of_conversations(spark):
    df = table(spark, SF, "conversations").select("conv_id", "turn", "role", "text")
    read = lambda turns: rows(chat.read_back(chat.formatted(turns), in_order=True))
    assert read(more(df)) == read(df)


def test_null_ids_of_scored_documents(spark, monkeypatch):
    docs = table(spark, SF, "documents")
    one = spark.createDataFrame([(None, "some words here", "en", "s", 15)], docs.schema)
    monkeypatch.setattr(queries, "table", lambda spark, sf, name: docs.unionByName(one) if name == "documents" else table(spark, sf, name))
    (r,) = queries.op1_toxicity(spark, SF).where("doc_id IS NULL").collect()
    assert r.held_out is False and 0 <= r.score <= 1
