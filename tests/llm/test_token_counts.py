import random

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tracewell.llm import queries, token_counts
from tracewell.llm.common import table

ODD = list("aàÉßΣσ 　\t\n\r\x0b\x0c\x1c\x85\xa0 ́'sS<|>endoftext0٣½🙂👨‍👩‍👧한글漢字​.,!#՘౜\U00010940")
TEXTS = ["", None, "Hello, wörld. It's 42!", "<|endoftext|> x", "a <|endoftext|><|endoftext|>b", "a" * 3000, "ab" * 700, " " * 500, "'S 's don't", "a\U00010940b"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))


@pytest.fixture(scope="module")
def coder():
    return token_counts.MergeRanks()


def want(library, text):
    return len(library.encode(text or "", add_special_tokens=False).ids)


def noise(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 60))) for _ in range(n)]


def test_counts_equal_the_library(library, coder):
    texts = TEXTS + noise(1, 600)
    assert coder.count(texts).tolist() == [want(library, t) for t in texts]


@settings(max_examples=150, deadline=None)
@given(text=st.text(max_size=80) | st.text("ab 'st\n", max_size=300))
def test_any_text_equals_the_library(library, coder, text):
    assert coder.count([text]).tolist() == [want(library, text)]


def test_long_sequences_and_short_ones_agree(library, monkeypatch):
    r = random.Random(2)
    texts = ["".join(r.choice("aabcde") for _ in range(n)) for n in (1, 2, 3, 97, 400, 2000)] + ["ha" * 333, "a" * 77, "oooo" * 50]
    words = [t.encode() for t in texts]
    for long in (2, 96, 10_000):
        monkeypatch.setattr(token_counts, "LONG", long)
        assert token_counts.MergeRanks().symbols(words).tolist() == [want(library, t) for t in texts]


def test_runs_and_a_full_memo_change_nothing(library, monkeypatch):
    monkeypatch.setattr(token_counts, "PARTS", 7)
    monkeypatch.setattr(token_counts, "MEMO", 20)
    texts = noise(3, 80)
    assert token_counts.MergeRanks().count(texts).tolist() == [want(library, t) for t in texts]


def test_every_second_of_a_row():
    assert token_counts.every_second(np.array([1, 2, 3, 7, 8, 9, 10, 20])).tolist() == [1, 3, 7, 9, 20]
    assert token_counts.every_second(np.array([], int)).tolist() == []


def test_known_characters_are_cut_as_the_library_does(coder):
    import regex

    known = regex.compile(f"[{token_counts.KNOWN}]")
    found = [c for c in map(chr, range(0xD800)) if known.match(c)]
    for a in range(0, len(found), 997):
        text = "\n".join(f"a{c}a 1{c}1 !{c}! {c} x" for c in found[a : a + 60])
        assert coder.pattern.findall(text) == [text[i:j] for _, (i, j) in coder.library.pre_tokenize_str(text)]


def test_a_vocabulary_of_another_kind_is_refused():
    with pytest.raises(ValueError, match="plain byte-level"):
        token_counts.MergeRanks("word_bpe_49k.json")


def test_rows_of_all_kinds(spark, library):
    rows = [(k, t, "x", 1) for k, t in enumerate(TEXTS)] + [(3, "again", None, 2), (3, "again", None, 2), (None, "none", "y", 3), (99, "word " * 1025, "", 4), (98, "word" + " word" * 1023, "", 5)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, n_tokens string, over_limit int")
    got = token_counts.counted(docs).collect()
    assert sorted((str(r[0]), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted((str(k), len((t or "").encode()), want(library, t), want(library, t) > 1024) for k, t, *_ in rows)
    assert token_counts.counted(docs.where("doc_id = 5000")).collect() == []
    assert {r[0]: r.over_limit for r in got if r[0] in (98, 99)} == {98: False, 99: True}


def test_the_query_equals_the_library_on_the_table(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents").collect()
    got = {r.doc_id: r for r in queries.op13_token_counts(spark, sf).collect()}
    assert len(got) == len(docs)
    for d in docs:
        n = want(library, d.text)
        assert (got[d.doc_id].n_bytes, got[d.doc_id].n_tokens, got[d.doc_id].over_limit) == (len((d.text or "").encode()), n, n > 1024)
