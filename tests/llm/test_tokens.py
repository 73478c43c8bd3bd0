import bisect
import collections
import hashlib
import random
import shutil
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tracewell.llm import byte_bpe, packing, token_files, tokens
from tracewell.llm.common import get, store

ODD = list("aàÉßΣσ 　\t\n\r\x0b\x0c\x1c\x85\xa0 ́'sS<|>endoftext0٣½🙂👨‍👩‍👧한글漢字​.,!#")
TEXTS = ["", None, "Hello, wörld. It's 42!", "<|endoftext|> x", "a <|endoftext|> b<|startoftext|>c <|ENDOFTEXT|>", "a" * 3000, "ÀÉ straße; naïve"]


def noise(seed, n=300):
    r = random.Random(seed)
    return ["".join(r.choice(ODD) for _ in range(r.randint(0, 40))) for _ in range(n)]


@pytest.fixture(scope="module")
def word_library():
    return Tokenizer.from_file(public_tokenizers.path(tokens.WORD_FILE))


def word_ids(library, text, tail):
    return [*library.encode(text or "", add_special_tokens=False).ids, *tail]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_word_parts_equal_whole_texts(word_library):
    texts = TEXTS + noise(1)
    for text, got in zip(texts, tokens.word_tokens().encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == word_ids(word_library, text, [])


def test_a_full_memo_changes_nothing(word_library, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", 20)
    texts = noise(2, 60)
    for text, got in zip(texts, tokens.WordTokens(tokens.WORD_FILE).encode(texts, group=7)):
        assert np.frombuffer(got, "<u4").tolist() == word_ids(word_library, text, [])


def test_byte_ids_equal_the_reference_and_decode(spark):
    texts = TEXTS + noise(3)
    e = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tokens.read_ranks(tokens.BYTE_FILE), special_tokens={})
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in byte_bpe.round_trip(df).collect()}
    for k, text in enumerate(texts):
        ids = e.encode_ordinary(text or "")
        assert got[k].n_tokens == len(ids)
        assert got[k].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[k].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest() and got[k].n_chars == len(text or "")
    back = byte_bpe.decoded(byte_bpe.encoded(df)).collect()
    assert {r.doc_id: r.text for r in back} == {k: t or "" for k, t in enumerate(texts)}


def test_offsets_and_split_characters():
    coder = tokens.byte_tokens()
    text = "naïve 👨‍👩‍👧 漢字"
    ids = np.frombuffer(next(coder.encode([text])), "<u4")
    starts, chars = coder.offsets(ids)
    assert starts[-1] == len(text.encode()) and chars[-1] == len(text)
    for k in range(len(ids)):
        assert chars[k] == len(text.encode()[: starts[k]].decode(errors="ignore"))
    assert "".join(coder.texts(iter([ids[k : k + 1] for k in range(len(ids))]))) == text
    assert "".join(coder.texts(iter([ids[:0]]))) == ""


def test_token_files_hold_every_document(spark, word_library, tmp_path):
    rows = [(k, t) for k, t in enumerate(TEXTS + noise(4, 80))] + [(3, "again"), (None, "none")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    shards = token_files.write(df, folder=f"file://{tmp_path}/t", shards=5)
    got = sorted(token_files.read(shards, "bigint", with_ids=True).collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    at, by_key = 0, {}
    for k, t in rows:
        by_key.setdefault(k, []).append(word_ids(word_library, t, [2]))
    assert [r.doc_id for r in got] == sorted((k for k, _ in rows), key=lambda k: (k is not None, k or 0))
    for r in got:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.start == at and r.n_tokens == len(ids) and r.ids_crc32 == crc(ids) and ids in by_key[r.doc_id]
        at += len(ids)


def test_perfect_hash_is_minimal_and_knows_strangers():
    keys = list(range(3000))
    index = token_files.Index.from_bytes(token_files.Index.build(keys, np.arange(1, 3001)).to_bytes())
    hashes = np.array([token_files.key_hash(k) for k in keys], np.uint64)
    assert sorted(index.perfect.slots(hashes).tolist()) == keys
    offsets, counts = index.find([(k, 0) for k in keys])
    assert counts.tolist() == list(range(1, 3001)) and offsets.tolist() == np.concatenate([[0], np.cumsum(np.arange(1, 3000))]).tolist()
    assert (index.find([(k, 0) for k in range(10_000, 12_000)])[1] == -1).all()
    empty = token_files.Index.from_bytes(token_files.Index.build([], np.zeros(0, np.int64)).to_bytes())
    assert empty.find([(1, 0)])[0].tolist() == [-1]


def test_a_short_payload_is_an_error(spark, tmp_path):
    df = spark.createDataFrame([(1, "some words here")], "doc_id bigint, text string")
    shards = token_files.write(df, folder=f"file://{tmp_path}/t", shards=1)
    name = f"tokens-{shards.first().shard}.bin"
    files, root = store(f"file://{tmp_path}/t")
    data = get(f"file://{tmp_path}/t", name)
    with files.open_output_stream(f"{root}/{name}") as out:
        out.write(data[:-2])
    with pytest.raises(Exception, match="payload of"):
        token_files.read(shards, "bigint").collect()


def test_packing_places_every_piece_without_gaps(spark, word_library):
    r = random.Random(5)
    texts = [" ".join("word" for _ in range(r.choice([0, 1, 5, 30, 70, 200]))) for _ in range(300)] + [None, "", "x y"]
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)] + [(0, texts[0])], "doc_id bigint, text string").repartition(7)
    got = packing.pack(df, capacity=64).collect()
    by_sequence, by_doc = {}, {}
    for p in got:
        by_sequence.setdefault(p.sequence_id, []).append((p.offset, p.length))
        by_doc.setdefault(p.doc_id, []).append(p)
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    for k, t in enumerate(texts[1:], 1):
        ids = word_ids(word_library, t, [0])
        parts = sorted(by_doc[k], key=lambda p: p.piece)
        assert [(p.start, p.length, p.ids_crc32) for p in parts] == [(a, len(ids[a : a + 64]), crc(ids[a : a + 64])) for a in range(0, len(ids), 64)]
    total = sum(p.length for p in got)
    assert len(by_sequence) <= -(-total // 64) * 1.02 + 1


def best_fit_decreasing(sizes, capacity):
    gaps, opened = [], 0
    for n in sorted(sizes, reverse=True):
        k = bisect.bisect_left(gaps, n)
        gap = gaps.pop(k) if k < len(gaps) else capacity
        opened += gap == capacity
        if gap > n:
            bisect.insort(gaps, gap - n)
    return opened


@pytest.mark.parametrize("draw", [lambda r: r.randint(1, 2048), lambda r: r.randint(1, 300), lambda r: min(2048, int(r.lognormvariate(6, 1.2)) + 1)])
def test_packing_plan_is_as_good_as_best_fit_decreasing(draw):
    r = random.Random(6)
    sizes = [draw(r) for _ in range(20_000)]
    steps = packing.plan(dict(collections.Counter(sizes)))
    assert collections.Counter(sizes) == sum((collections.Counter({s[0]: s[2]}) for s in steps), collections.Counter())
    used = max(s[4] + -(-s[2] // s[3]) for s in steps)
    assert used <= best_fit_decreasing(sizes, 2048) * 1.001 + 1


def test_packing_plan_is_bounded_by_the_capacity():
    r = random.Random(6)
    sizes = [len(packing.plan({n: r.randint(0, most) for n in range(1, 2049)})) for most in (10**3, 10**9)]
    assert max(sizes) < 20_000


def test_empty_tables(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert packing.pack(df).collect() == [] and byte_bpe.round_trip(df).collect() == []
    assert token_files.read(token_files.write(df), "bigint").collect() == []


def test_special_strings_are_tokens_as_in_the_plain_call(word_library):
    (got,) = tokens.word_tokens().encode(["a <|endoftext|> b"])
    assert np.frombuffer(got, "<u4").tolist() == word_ids(word_library, "a <|endoftext|> b", []) == [320, 49407, 321]


def test_another_chain_gets_whole_texts(tmp_path):
    from tokenizers import models, pre_tokenizers

    t = Tokenizer(models.BPE(vocab={"a": 0, " ": 1, "a ": 2, "b": 3}, merges=[("a", " ")]))
    t.save(str(tmp_path / "own.json"))
    coder = tokens.WordTokens(str(tmp_path / "own.json"))
    assert not coder.by_blanks and tokens.word_tokens().by_blanks
    assert np.frombuffer(next(coder.encode(["a b"])), "<u4").tolist() == t.encode("a b").ids == [2, 3]


def test_memo_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO", 50_000)
    coder = tokens.WordTokens(tokens.WORD_FILE)
    for k in range(40):
        list(coder.encode([" ".join(f"w{k}x{i}" for i in range(300)) + " " + "y" * 5000], group=1))
        assert sum(200 + 4 * len(p) + len(x) for p, x in coder.known.items()) < 250_000 and not any(len(p) > tokens.LONG for p in coder.known)


def test_packing_with_a_bound_forgets_what_its_tasks_remembered(spark, tmp_path):
    own = str(tmp_path / "own.json")  # a memo of its own in each worker
    shutil.copy(public_tokenizers.path(tokens.WORD_FILE), own)
    rows = [(k, " ".join(f"w{k}x{i}" for i in range(300)) + "\nthe same, always") for k in range(200)] + [(200, None), (201, "")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    bound = 50_000

    def held(batches):
        for b in batches:
            coder = tokens._LOADED.get(("word", own))
            yield pa.RecordBatch.from_arrays([pa.array([-1 if coder is None else coder.held])], names=["held"])

    got = packing.pieces(df, vocabulary=own, memo=bound).collect()
    kept = [r.held for r in spark.range(64).repartition(16).mapInArrow(held, "held bigint").collect()]
    assert 0 in kept and max(kept) == 0
    coder = tokens.WordTokens(own)
    for _, t in rows:
        list(coder.encode([t], group=1, most=bound))
        assert coder.held < 4 * bound
    assert sorted(got) == sorted(packing.pieces(df, vocabulary=own).collect())


def test_lookup_reads_only_what_is_asked(spark, word_library, tmp_path):
    rows = [(k, t) for k, t in enumerate(TEXTS + noise(9, 120))] + [(5, "again")] * 3 + [(None, "none")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    shards = token_files.write(df, folder=f"file://{tmp_path}/l", shards=6)
    asked = spark.createDataFrame([(k,) for k in [3, 5, 77, 77, 100, -4, 10**9, None]], "doc_id bigint")
    whole = {r.start: (r.doc_id, r.ids) for r in token_files.read(shards, "bigint", with_ids=True).collect()}
    got = {r.doc_id: r for r in token_files.lookup(shards, asked).collect()}
    assert set(got) == {3, 5, 77, 100}
    for k, r in got.items():
        assert whole[r.start] == (k, r.ids) and r.n_tokens == len(r.ids) // 4
        assert r.start == min(s for s, (d, _) in whole.items() if d == k)
    assert token_files.lookup(shards, asked.where("doc_id < 0")).collect() == []


def test_lengths_are_ranked_in_bounded_buckets(spark, monkeypatch):
    monkeypatch.setattr(packing, "LEAST", 50)
    rows = [(7, "word " * 3)] * 400 + [(8, "word " * 63)] * 30 + [(k, "word " * 200) for k in range(9, 20)]
    df = spark.createDataFrame([(k, t, 1, 2) for k, t in rows], "doc_id bigint, text string, _row int, length int").repartition(5)
    got = packing.pack(df, capacity=64).collect()
    places = collections.defaultdict(list)
    for p in got:
        places[p.sequence_id].append((p.offset, p.length))
    assert len(got) == 400 + 30 + 11 * 4
    for v in places.values():
        v.sort()
        assert [o for o, _ in v] == np.concatenate([[0], np.cumsum([n for _, n in v])[:-1]]).tolist() and sum(n for _, n in v) <= 64
    assert len(places) <= -(-sum(p.length for p in got) // 64) + 1


def test_runs_of_one_read():
    offsets, counts = np.array([0, 3, 5, 9, 20]), np.array([3, 2, 4, 1, 2])
    assert list(token_files._spans(offsets, counts, 2)) == [(0, 4), (4, 5)]
    assert list(token_files._spans(offsets, counts, 2, gap=10)) == [(0, 5)]
    assert list(token_files._spans(offsets[:0], counts[:0], 2)) == []


def test_small_reads_and_small_shards_change_nothing(spark, word_library, tmp_path, monkeypatch):
    rows = [(k, t) for k, t in enumerate(TEXTS + noise(6, 60))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(token_files, "SHARD_ROWS", 9)
    assert token_files.shard_count(df, "text") == -(-len(rows) // 9)
    shards = token_files.write(df, folder=f"file://{tmp_path}/s")
    assert shards.count() > 4
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in token_files.read(shards, "bigint").collect()}
    start = 0
    for k, t in rows:
        ids = word_ids(word_library, t, [2])
        assert got[k] == (start, len(ids), crc(ids))
        start += len(ids)
    found = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in token_files.lookup(shards, df.where("doc_id % 3 = 0").select("doc_id")).collect()}
    assert found == {k: word_ids(word_library, t, [2]) for k, t in rows if k % 3 == 0}
