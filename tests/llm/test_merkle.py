import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tracewell.llm import merkle, queries

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint, digest string, tree int, place string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(r):
    return h(*("-" if r[c] is None else f"{len(str(r[c]).encode())}:{r[c]}" for c in FIELDS))


def tree(nodes, fanout):
    """Levels of a tree, and the siblings (before, after) of each node of the first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][a : a + fanout]) for a in range(0, len(levels[-1]), fanout)])
    paths = []
    for i in range(len(nodes)):
        path = []
        for level in levels[:-1]:
            a = i // fanout * fanout
            path.append((level[a:i], level[i + 1 : a + fanout]))
            i //= fanout
        paths.append(path)
    return levels[-1][0], paths


def brute(rows, fanout):
    key = lambda v: (v is not None, v if v is not None else 0)
    groups = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append(r)
    names = sorted(groups, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda r: (key(r["doc_id"]), leaf(r)))
        trees[name] = tree([leaf(r) for r in groups[name]], fanout)
    root, upper = tree([trees[n][0] for n in names], fanout)
    out = []
    for name, above in zip(names, upper):
        for r, path in zip(groups[name], trees[name][1]):
            path = path + above
            other = dict(r)
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and r["text"] is not None:
                other["text"] = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r["text"])
            folded = leaf(other)
            for a, b in path:
                folded = h(*a, folded, *b)
            out.append((r["doc_id"], leaf(r), trees[name][0], root, h(*(x for a, b in path for x in a + b)), folded))
    return sorted(out, key=repr)


def found(spark, rows, fanout=8, steps=4):
    docs = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], "x", 1, "y") for r in rows], COLUMNS).repartition(3)
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    leaves = merkle.leaves(docs, "lang", "doc_id", FIELDS, F.crc32(F.col("doc_id").cast("string")) % 3 == 0, {"text": F.translate("text", capitals, capitals.lower())})
    return merkle.manifest(leaves, fanout, steps, with_paths=True).collect()


def row(doc_id, text="Some Text", lang="en", source="s", n=9):
    return {"doc_id": doc_id, "text": text, "lang": lang, "source": source, "n_chars": n}


ODD = [row(None), row(None, None, None, None, None), row(3, "É Ünï", "de"), row(3, "É Ünï", "de"), row(3, "Other", "de"), row(-4, "", ""), row(12, None, "fr"), row(10**15, "X" * 50_000, "fr"), row(11, "a:b-", "z\U0001f642"), row(12, "a", "￮")]


@pytest.mark.parametrize("n, fanout, steps", [(1, 8, 4), (8, 8, 4), (65, 8, 1), (40, 3, 2), (100, 2, 1)])
def test_equals_brute_force(spark, n, fanout, steps):
    rows = [row(k, f"Text {k}", "en" if k % 3 else "de") for k in range(n)] + ODD
    got = found(spark, rows, fanout, steps)
    assert sorted(((r.key, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got), key=repr) == brute(rows, fanout)
    for r in got:
        path = merkle.read_path(r.path)
        assert merkle.proof(path) == r.proof_sha256 and merkle.fold(r.leaf, path) == r.root


def test_one_group_and_one_leaf(spark):
    (r,) = found(spark, [row(7, "small")])
    assert r.leaf == r.subroot == r.root == r.folded_root and r.proof_sha256 == h("")


def test_many_groups(spark):
    rows = [row(k, lang=f"l{k:03}") for k in range(30)]
    got = found(spark, rows, 3, 1)
    assert sorted(((r.key, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got), key=repr) == brute(rows, 3)


def test_empty_table(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert merkle.manifest(merkle.leaves(docs, "lang", "doc_id", FIELDS)).collect() == []


def test_one_key_with_most_rows_is_dealt_out(spark):
    rows = [row(5, "same", "en")] * 300 + [row(k) for k in range(60)]
    got = found(spark, rows, 4, 2)
    assert sorted(((r.key, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root) for r in got), key=repr) == brute(rows, 4)


def test_only_tampered_rows_with_capitals_fail(spark):
    got = queries.op11_merkle(spark, "/root/testdata/sf0.001").collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    for r in got:
        touched = zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and any("A" <= c <= "Z" for c in texts[r.doc_id] or "")
        assert r.verified == (not touched)
    assert len({r.root for r in got}) == 1 and len(got) == len(texts)
