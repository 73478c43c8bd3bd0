"""Exact Jaccard join of documents on word n-grams: `joined` gives its connected components, skipping
pairs already connected; `links` gives every link between classes and the number of links a document has.

1. A pass over the texts hashes each document's distinct n-grams. Documents of equal sets (by 128 bits
   of hash) form one class; only classes take part from here on.
2. Similar sets share an n-gram among their first ones in any fixed order (prefix filter). The order
   is by hash below a bound, first the n-grams few classes have, then the frequent ones, then the
   rest, so that a passage common to many documents seldom serves as a key.
3. Classes that share such an n-gram meet in a tile; the tile of a frequent n-gram is cut in bands of
   size, each meeting the next, and a tile of more than `TILE` classes in sides that meet pair by pair
   in cells, so a task holds two sides at most. Inside a tile classes are sorted by size, and for sizes
   close enough the bit counts of hashed bitmap signatures bound the overlap from above. A pair that
   passes is a possible link; a tile emits possible links that connect what its pairs connect.
4. Components of possible links are cut in blocks of bounded size, in order of the sets' sizes, so only blocks
   of near sizes meet. In a block, where bit counts leave a link possible, the sorted arrays of the n-grams
   are intersected exactly, skipping only pairs already connected. Between blocks of
   one component, all classes are held against the root of its largest cluster. What stays outside
   that cluster meets the blocks in batches of a block's size, first by larger signatures only; the
   text of a class goes only to the blocks where the bit counts leave a link possible. So no link
   between two clusters is missed, and a task holds the texts of one block and one batch at a time.
   The work is quadratic only in classes of one component and of near sizes that stay outside its
   largest cluster: by signatures in all, by texts in those whose similarity is just below the bound.

Equality of n-grams is equality of 64-bit hashes. Defined cases: null and empty texts, and texts
without a word, have no n-gram and are linked with nothing; fewer words than n make one n-gram of
the whole sequence; a repeated row is one more document of its class; a null id is kept, and is
larger than any other when a component's smallest id is taken. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tracewell.llm import wordhash
from tracewell.llm.common import release, saved
from tracewell.llm.components import components

BELOW = np.uint64(int(0.22 * 2**64))  # hashes whose frequency is counted
FREQUENT = 400  # classes that make an n-gram a frequent one
HOT = 10_000  # classes with more than one in so many documents are called common
TILE, SAMPLED = 20_000, 16  # classes of a side; one class in SAMPLED is counted to find the large tiles
BLOCK_CLASSES, BLOCK_GRAMS = 200, 400_000
FINE = 8  # bits an n-gram of the larger signatures


def _least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def prefix_length(n: int, percent: int) -> int:
    return n - _least_overlap(n, percent) + 1


def width(n: int) -> int:
    """Bits of a set's signature: a power of two, once to twice its size, 128 at least."""
    return max(128, 1 << (n - 1).bit_length()) if n else 128


def bitmap(grams: np.ndarray, bits: int) -> bytes:
    at = (grams & np.uint64(bits - 1)).astype(np.int64)
    out = np.zeros(bits, np.uint8)
    out[at] = 1
    return np.packbits(out, bitorder="little").tobytes()


def _set_hash(grams: np.ndarray) -> tuple[int, int]:
    """128 bits of a set: the number of its class, and the other half."""
    if not len(grams):
        return 0, 0
    h = wordhash.mix(grams * np.uint64(0xD6E8FEB86659FD93) + np.uint64(len(grams)))
    total = int(h.sum(dtype=np.uint64))
    both = int(np.bitwise_xor.reduce(h)) + total * 0x9E3779B97F4A7C15
    return _signed(both), _signed(total)


def _signed(x: int) -> int:
    return (x & (2**64 - 1)) - (x & 2**63) * 2


def gram_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Sorted distinct n-gram hashes of each text."""
    data, offsets = wordhash.text_bytes(texts)
    step = 256
    for a in range(0, len(texts), step):
        part = offsets[a : a + step + 1]
        docs, (words,) = wordhash.word_hashes(data, part)
        cut = np.searchsorted(docs, np.arange(len(part)))
        for i in range(len(part) - 1):
            yield wordhash.shingles(words[cut[i] : cut[i + 1]], size)


def signatures(docs: DataFrame, key: str, text: str, size: int, percent: int) -> DataFrame:
    """(key, hash, n, cls, check, tokens, bits): hash is that of the text, cls and check are halves of
    the hash of the whole set; tokens are its hashes below BELOW, filled up to the prefix length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, cls, check, toks, bits = [], [], [], [], []
            for grams in gram_sets(b.column(2), size):
                n.append(len(grams))
                one, other = _set_hash(grams)
                cls.append(one)
                check.append(other)
                cut = max(int(np.searchsorted(grams, BELOW)), prefix_length(len(grams), percent) if len(grams) else 0)
                toks.append(grams[:cut].view(np.int64))
                bits.append(bitmap(grams, width(len(grams))) if len(grams) else b"")
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.int64()), pa.array(check, pa.int64()), pa.array(toks, pa.list_(pa.int64())), pa.array(bits, pa.binary())], names=["key", "hash", "n", "cls", "check", "tokens", "bits"])
        release()

    return docs.select(key, F.xxhash64(text), text).mapInArrow(run, f"key {dict(docs.dtypes)[key]}, hash bigint, n bigint, cls bigint, check bigint, tokens array<bigint>, bits binary")


def _classes(sig: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`sig`, and one row a class. Sets that differ in the second half of their hash only, of which ten
    billion documents have a few, get a class of their own."""

    def counted(rows: DataFrame) -> DataFrame:
        named = F.min(F.struct(F.col("key").isNull().alias("none"), "key", "hash"))["hash"]
        return rows.where("n > 0").groupBy("cls").agg(F.min("key").alias("first"), named.alias("hash"), F.max("n").alias("n"), F.count("*").alias("copies"), F.min("check").alias("low"), F.max("check").alias("high"))

    classes = saved(counted(sig), "classes")
    mixed = classes.where("low <> high").select("cls", "low")
    if not mixed.isEmpty():
        apart = F.when(F.col("check") != F.col("low"), F.xxhash64("cls", "check")).otherwise(F.col("cls"))
        sig = saved(sig.join(mixed, "cls", "left").withColumn("cls", apart).select(sig.columns), "signatures-apart")
        classes = saved(counted(sig), "classes-apart")
    return sig, classes.drop("low", "high")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by token: those of tokens that two or more classes have, and whether more
    than FREQUENT have it. Holds FREQUENT rows back at most."""
    last, held, many = None, [], False

    def out(tokens: np.ndarray, classes: np.ndarray, frequent: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(tokens, pa.int64()), pa.array(classes, pa.int64()), pa.array(frequent, pa.bool_())], names=["token", "cls", "frequent"])

    def settle() -> pa.RecordBatch | None:
        if len(held) < 2 and not many:
            return None
        return out(np.full(len(held), last, np.int64), np.array(held, np.int64), np.full(len(held), many))

    for b in batches:
        token, cls = b.column(0).to_numpy(), b.column(1).to_numpy()
        if not len(token):
            continue
        starts = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        ends = np.append(starts[1:], len(token))
        if last is not None and token[0] == last:  # goes on from the batch before
            held += cls[: ends[0]].tolist()
            starts, ends = starts[1:], ends[1:]
            if len(held) > FREQUENT or many:
                many = True
                yield settle()
                held = []
        if len(starts):
            if last is not None and (x := settle()) is not None:
                yield x
            inner_s, inner_e = starts[:-1], ends[:-1]
            counts = inner_e - inner_s
            keep = np.repeat(counts >= 2, counts)
            at = np.arange(inner_s[0], inner_e[-1])[keep] if len(inner_s) else np.zeros(0, np.int64)
            if len(at):
                yield out(token[at], cls[at], np.repeat(counts > FREQUENT, counts)[keep])
            last, held, many = int(token[-1]), cls[starts[-1] :].tolist(), False
            if len(held) > FREQUENT:
                many = True
                yield settle()
                held = []
    if last is not None and held and (x := settle()) is not None:
        yield x


def _band(n: int, percent: int) -> int:
    return int(math.log(n) / math.log(100 / percent) + 1e-9)


def _prefixes(percent: int):
    """Rows of tiles: for each class the shared tokens among its first ones."""
    below = BELOW.astype(np.int64) if BELOW < np.uint64(1 << 63) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for cls, n, tokens, bits, shared in zip(*(b.column(k).to_pylist() for k in range(5)), strict=True):
                frequent = {s["token"]: s["frequent"] for s in shared}
                p = prefix_length(n, percent)
                low = [t for t in tokens if 0 <= t < below]
                rest = tokens[len(low) :]
                order = [t for t in low if not frequent.get(t)] + [t for t in low if frequent.get(t)] + rest
                for t in order[:p]:
                    if t in frequent:
                        if frequent[t]:
                            band = _band(n, percent)
                            out += [(t, band, cls, n, bits, True), (t, band - 1, cls, n, bits, False)]
                        else:
                            out.append((t, -9, cls, n, bits, True))
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], t) for k, t in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.bool_()))], names=["token", "band", "cls", "n", "bits", "home"])
        release()

    return run


class _Union:
    def __init__(self) -> None:
        self.parent: dict = {}

    def root(self, x):
        while (up := self.parent.get(x, x)) != x:
            self.parent[x] = self.parent.get(up, up)
            x = up
        return x

    def join(self, a, b) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


def _fold(bits: np.ndarray, words: int) -> np.ndarray:
    """Signatures (rows of 64-bit words) folded to `words` words each."""
    while bits.shape[1] > words:
        half = bits.shape[1] // 2
        bits = bits[:, :half] | bits[:, half:]
    return bits


def _tile(rows: list[tuple[int, int, bytes, bool]], percent: int) -> list[tuple[int, int]]:
    """Possible links of a tile's (cls, n, bits, home): enough of them to connect all classes that
    its passing pairs connect."""
    rows.sort(key=lambda r: (r[1], r[0]))
    n = np.array([r[1] for r in rows], np.int64)
    home = np.array([r[3] for r in rows])
    free = np.ones(len(rows), bool)
    words = np.array([len(r[2]) // 8 for r in rows])
    stacks = {w: np.stack([np.frombuffer(r[2], np.uint64) for r, x in zip(rows, words, strict=True) if x == w]) for w in set(words.tolist())}
    of = np.zeros(len(rows), np.int64)
    for w in stacks:
        of[words == w] = np.arange(int((words == w).sum()))
    out = []
    while (left := np.flatnonzero(free)).size:
        queue = [int(left[0])]
        free[queue[0]] = False
        while queue:
            i = queue.pop()
            a, z = np.searchsorted(n, [-(-percent * n[i] // 100), n[i] * 100 // percent + 1])
            near = a + np.flatnonzero(free[a:z] & (home[a:z] | home[i]))
            for w in set(words[near].tolist()):
                some = near[words[near] == w]
                most = _most(n[some], stacks[w][of[some]], n[i], np.frombuffer(rows[i][2], np.uint64))
                hit = some[(100 + percent) * most >= percent * (n[i] + n[some])]
                free[hit] = False
                queue += hit.tolist()
                out += [(rows[i][0], rows[j][0]) for j in hit.tolist()]
    return out


def _tiles(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, last, rows = _Union(), None, []  # a task's own possible links need no repeats

        def edges(found: list[tuple[int, int]]) -> list[tuple[int, int]]:
            return [e for e in found if seen.join(*e)]

        for b in batches:
            out = []
            for token, band, cell, *row in zip(*(b.column(k).to_pylist() for k in range(7)), strict=True):
                if (token, band, cell) != last:
                    if len(rows) > 1:
                        out += edges(_tile(rows, percent))
                    last, rows = (token, band, cell), []
                    if len(seen.parent) > 1_000_000:
                        seen = _Union()
                rows.append(tuple(row))
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in out], pa.int64()) for k in (0, 1)], names=["u", "v"])
        if len(rows) > 1:
            out = edges(_tile(rows, percent))
            yield pa.RecordBatch.from_arrays([pa.array([e[k] for e in out], pa.int64()) for k in (0, 1)], names=["u", "v"])
        seen.parent.clear()
        release()

    return run


def _celled(rows: DataFrame, sig: DataFrame) -> DataFrame:
    """Rows of tiles with their cell: the classes of a large tile are dealt over sides, and each goes
    to the cells of its side with every side. How many sides there are is estimated from one class in
    SAMPLED, which changes the work's cut only."""
    some = sig.where((F.col("n") > 0) & (F.pmod(F.xxhash64(F.lit("tiles"), "cls"), F.lit(SAMPLED)) == 0)).select("cls", "tokens").dropDuplicates(["cls"])
    often = some.select(F.explode("tokens").alias("token")).groupBy("token").agg((F.count("*") * SAMPLED).alias("n")).where(F.col("n") > TILE)
    often = saved(often.select("token", F.ceil(F.col("n") / TILE).cast("int").alias("sides")), "large-tiles")
    columns = ["token", "band", "cell", "cls", "n", "bits", "home"]
    if often.isEmpty():
        return rows.withColumn("cell", F.lit(0)).select(columns)
    sides = rows.join(often, "token", "left").withColumn("sides", F.coalesce("sides", F.lit(1)))
    sides = sides.withColumn("_side", F.pmod(F.xxhash64("cls"), F.col("sides")).cast("int")).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("sides") - 1)))
    return sides.withColumn("cell", F.least("_side", "_other") * F.col("sides") + F.greatest("_side", "_other")).select(columns)


class _Sets:
    """The n-gram sets of a block over dense numbers, to intersect one set with many exactly, those that
    the bit counts of their signatures leave a chance."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sizes = np.array([len(s) for s in sets], np.int64)
        every = np.concatenate(sets)
        self.values, at = np.unique(every, return_inverse=True)
        self.at, self.starts = at, np.concatenate([[0], np.cumsum(self.sizes)])
        self.mark = np.zeros(len(self.values), np.int32)
        bits = np.array([width(n) for n in self.sizes.tolist()])
        self.stacks: list[tuple[np.ndarray, np.ndarray]] = []  # rows of one width, and their signatures
        self.stack_of, self.place = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64)
        for k, w in enumerate(sorted(set(bits.tolist()))):
            rows = np.flatnonzero(bits == w)
            self.stacks.append((rows, np.stack([np.frombuffer(bitmap(sets[r], w), np.uint64) for r in rows])))
            self.stack_of[rows], self.place[rows] = k, np.arange(len(rows))

    def _possible(self, grams: np.ndarray, rows: np.ndarray, percent: int) -> np.ndarray:
        """Those of `rows` whose overlap with the set `grams` may be large enough by the bit counts."""
        mine, m, kept = np.frombuffer(bitmap(grams, width(len(grams))), np.uint64), len(grams), []
        for k in np.unique(self.stack_of[rows]).tolist():
            some = rows[self.stack_of[rows] == k]
            n = self.sizes[some]
            most = _most(n, self.stacks[k][1][self.place[some]], m, mine)
            kept.append(some[(100 + percent) * most >= percent * (m + n)])
        return np.sort(np.concatenate(kept)) if kept else rows

    def linked(self, grams: np.ndarray, rows: np.ndarray, percent: int) -> np.ndarray:
        """Which of `rows` link with the set `grams`."""
        return self.common(grams, rows, percent)[0]

    def common(self, grams: np.ndarray, rows: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
        """Which of `rows` link with the set `grams`, and the sizes of their intersections."""
        near = rows[(100 * self.sizes[rows] >= percent * len(grams)) & (100 * len(grams) >= percent * self.sizes[rows])]
        near = self._possible(grams, near, percent) if len(near) else near
        if not len(near):
            return near, near
        where = np.searchsorted(self.values, grams)
        where = where[(where < len(self.values)) & (self.values[np.minimum(where, len(self.values) - 1)] == grams)]
        self.mark[where] = 1
        both = np.array([int(self.mark[self.at[self.starts[r] : self.starts[r + 1]]].sum()) for r in near])
        self.mark[where] = 0
        hit = 100 * both >= percent * (self.sizes[near] + len(grams) - both)
        return near[hit], both[hit]


def _sets_of(pdf: pd.DataFrame, size: int) -> tuple[pd.DataFrame, list[np.ndarray]]:
    """Rows by class, and the sets of their texts."""
    pdf = pdf.sort_values("cls")
    return pdf, list(gram_sets(pa.array(pdf["text"], pa.string()), size))


def _block(size: int, percent: int):
    """Clusters of one block: (cls, root) with root the smallest class of its cluster; in components of
    several blocks also n and the larger signature."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, sets = _sets_of(pdf, size)
        cls = pdf["cls"].to_numpy()
        held = _Sets(sets)
        root = np.full(len(cls), -1)
        for first in range(len(cls)):
            if root[first] >= 0:
                continue
            root[first], queue = first, [first]
            while queue:
                hit = held.linked(sets[queue.pop()], np.flatnonzero(root < 0), percent)
                root[hit] = first
                queue += hit.tolist()
        bits = [bitmap(s, width(FINE * len(s))) if several else None for s, several in zip(sets, pdf["blocks"] > 1, strict=True)]
        return pd.DataFrame({"cls": cls, "root": cls[root], "comp": pdf["comp"].to_numpy(), "block": pdf["block"].to_numpy(), "n": pdf["n"].to_numpy(), "bits": pd.Series(bits, dtype=object)})

    return run


def _most(n: np.ndarray, stack: np.ndarray, m: int, mine: np.ndarray) -> np.ndarray:
    """Upper bounds of the overlap of sets of `n` n-grams, their signatures stacked, with a set of `m`."""
    k = min(stack.shape[1], len(mine))
    mine, theirs = _fold(mine[None, :], k), _fold(stack, k)
    return np.minimum(m - np.bitwise_count(mine & ~theirs).sum(1, dtype=np.int64), n - np.bitwise_count(theirs & ~mine).sum(1, dtype=np.int64))


def _possible(percent: int):
    """Guests, and the block, for which the larger signatures leave a link with another cluster possible."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        guests, own = pdf[pdf["guest"]], pdf[~pdf["guest"]]
        n, root = own["n"].to_numpy(), own["root"].to_numpy()
        words = np.array([len(b) // 8 for b in own["bits"]])
        stacks = {w: (np.flatnonzero(words == w), np.stack([np.frombuffer(b, np.uint64) for b, x in zip(own["bits"], words, strict=True) if x == w])) for w in set(words.tolist())}

        def near(m: int, its_root: int, bits: bytes) -> bool:
            mine = np.frombuffer(bits, np.uint64)
            for rows, stack in stacks.values():
                some = (root[rows] != its_root) & (100 * n[rows] >= percent * m) & (100 * m >= percent * n[rows])
                if some.any() and ((100 + percent) * _most(n[rows][some], stack[some], m, mine) >= percent * (m + n[rows][some])).any():
                    return True
            return False

        hit = [near(m, r, b) for m, r, b in zip(guests["n"], guests["root"], guests["bits"], strict=True)]
        return guests[np.array(hit, bool)][["comp", "block", "batch", "cls"]]

    return run


def _against(size: int, percent: int):
    """Links of a block's classes with visitors of the same component, in other clusters."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        guests, own = pdf[pdf["guest"]], pdf[~pdf["guest"]]
        guests, guest_sets = _sets_of(guests, size)
        own, own_sets = _sets_of(own, size)
        u, v = [], []
        if len(own) and len(guests):
            held, cluster, cls = _Sets(own_sets), own["root"].to_numpy(), own["cls"].to_numpy()
            joined = _Union()
            for g, root, grams in zip(guests["cls"], guests["root"], guest_sets, strict=True):
                other = np.flatnonzero(np.array([joined.root(c) != joined.root(root) for c in cluster.tolist()]))
                for i in held.linked(grams, other, percent).tolist():
                    joined.join(root, int(cluster[i]))
                    u.append(root)
                    v.append(int(cluster[i]))
        return pd.DataFrame({"u": np.array(u, np.int64), "v": np.array(v, np.int64)})

    return run


def _pairs(size: int, percent: int, within: bool, counts: bool):
    """Links of a block's classes, `within` it or with its guests: all as (u, v, common), or, if `counts`,
    (u, u, rows of the classes that u links with) and (u, v, 0) for enough links to connect what all
    connect, so a task emits a few rows a class however many links there are."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        own, own_sets = _sets_of(pdf if within else pdf[~pdf["guest"]], size)
        others, sets = (own, own_sets) if within else _sets_of(pdf[pdf["guest"]], size)
        out, told, met = [], _Union(), defaultdict(int)
        if len(own) and len(others):
            held, cls, copies = _Sets(own_sets), own["cls"].to_numpy(), own["copies"].to_numpy()
            for i, (u, mine, grams) in enumerate(zip(others["cls"].tolist(), others["copies"].tolist(), sets, strict=True)):
                at, both = held.common(grams, np.arange(i + 1 if within else 0, len(cls)), percent)
                for v, theirs, n in zip(cls[at].tolist(), copies[at].tolist(), both.tolist(), strict=True):
                    if not counts:
                        out.append((min(u, v), max(u, v), n))
                        continue
                    met[u] += theirs
                    met[v] += mine
                    if told.join(u, v):
                        out.append((u, v, 0))
        out += [(u, u, n) for u, n in met.items()]
        u, v, common = zip(*out, strict=True) if out else ((), (), ())
        return pd.DataFrame({"u": np.array(u, np.int64), "v": np.array(v, np.int64), "common": np.array(common, np.int64)})

    return run


def _signed_block(size: int):
    """The larger signatures of a block's classes, each a cluster of its own."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, sets = _sets_of(pdf, size)
        bits = pd.Series([bitmap(s, width(FINE * len(s))) for s in sets], dtype=object, index=pdf.index)
        return pdf.assign(root=pdf["cls"], bits=bits)[["cls", "root", "comp", "block", "n", "bits"]]

    return run


def joined(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, percent: int = 85) -> DataFrame:
    """(key, n_shingles, component_id) of every row of `docs`, linking sets whose Jaccard similarity
    is `percent` / 100 or more."""
    sig, classes, possible = _candidates(docs, key, text, size, percent)
    clusters = saved(_verified(_members(docs, classes, possible, key, text, percent), size, percent), "clusters")
    return _named(sig, classes, clusters, key).drop("class")


def links(docs: DataFrame, key: str = "doc_id", text: str = "text", size: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """Every link. First, for each row of `docs`, (key, n_shingles, component_id, class, n_links): as
    `joined`, with the number of its class, null without an n-gram, and the number of other rows it links
    with, those of its own class included. Second, for every two linked classes, (u, v, common), u < v,
    with the size of their intersection.

    Nothing is skipped: a component of G classes costs G * G / 2 signature compares, and an intersection
    for each pair whose signatures leave a link possible. Tasks hold a block and a batch, as in `joined`,
    and sum the links of a class before they are shuffled. The second table is worked out only when it is
    read."""
    sig, classes, possible = _candidates(docs, key, text, size, percent)
    held = _members(docs, classes, possible, key, text, percent)
    wide = held.where("blocks > 1").withColumn("root", F.col("cls"))
    signed = wide.repartition("comp", "block").groupBy("comp", "block").applyInPandas(_signed_block(size), "cls bigint, root bigint, comp bigint, block int, n bigint, bits binary")
    signed = saved(signed, "block-signatures")
    visits = saved(_visits(signed, signed, held.select("cls", "low", "high"), percent, later=True), "visits")
    guests = visits.join(wide.drop("block", "comp"), "cls")

    def found(counts: bool) -> DataFrame:
        schema = "u bigint, v bigint, common bigint"
        inner = held.repartition("comp", "block").groupBy("comp", "block").applyInPandas(_pairs(size, percent, True, counts), schema)
        outer = _meeting(wide, guests).groupBy("comp", "block", "batch").applyInPandas(_pairs(size, percent, False, counts), schema)
        return inner.unionByName(outer)

    told = saved(found(counts=True), "links")
    met = told.where("u = v").groupBy(F.col("u").alias("cls")).agg(F.sum("common").alias("_met"))
    counts = classes.select("cls", "copies").join(met, "cls", "left").select("cls", (F.col("copies") - 1 + F.coalesce("_met", F.lit(0))).alias("n_links"))
    clusters = components(told).select(F.col("node").alias("cls"), "root")
    return _named(sig, classes, clusters, key, counts), found(counts=False)


def _named(sig: DataFrame, classes: DataFrame, clusters: DataFrame, key: str, counts: DataFrame | None = None) -> DataFrame:
    """(key, n_shingles, component_id, class[, n_links]) of every row of `sig`."""
    named = classes.select("cls", "first").join(clusters, "cls", "left").withColumn("root", F.coalesce("root", "cls"))
    least = saved(named.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("_n")), "roots")
    # The largest components, HOT at most, are broadcast, so that no task gets all classes of one.
    count = least.agg(F.sum("_n")).first()[0] or 0
    large = F.broadcast(least.where(F.col("_n") > count / HOT).select("root", "component_id"))
    known = named.join(large, "root", "left").select("cls", "root", "component_id", F.col("component_id").isNull().alias("_open"))
    small = known.where("_open").select("cls", "root").join(least.where(F.col("_n") <= count / HOT).select("root", "component_id"), "root", "left")
    of_class = known.where("not _open").select("cls", "component_id").union(small.select("cls", "component_id"))
    if counts is not None:
        of_class = of_class.join(counts, "cls")
    out = sig.select("key", "n", "cls").join(of_class, "cls", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("key")).cast(dict(sig.dtypes)["key"])
    more = [] if counts is None else [F.coalesce("n_links", F.lit(0)).alias("n_links")]
    return out.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), own.alias("component_id"), F.when(F.col("n") > 0, F.col("cls")).alias("class"), *more)


def _candidates(docs: DataFrame, key: str, text: str, size: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signatures of all rows, their classes, and the components of possible links."""
    sig, classes = _classes(saved(signatures(docs, key, text, size, percent), "signatures"))

    # One row a class, with its tokens: the row of its first key (several, where that key repeats).
    # Copies of the most common classes, of which there are HOT at most, go before the shuffle.
    total = classes.agg(F.sum("copies")).first()[0] or 0
    hot = classes.where(F.col("copies") > total / HOT).select("cls", F.col("first").alias("_hot"), F.lit(True).alias("_is_hot"))
    rows = sig.where("n > 0").join(F.broadcast(hot), "cls", "left").where(F.col("_is_hot").isNull() | F.col("key").eqNullSafe(F.col("_hot"))).drop("_hot", "_is_hot")
    is_first = F.coalesce(F.col("key") == F.col("first"), F.col("key").isNull() & F.col("first").isNull())
    one = rows.join(classes.select("cls", "first"), "cls").where(is_first).select("cls", "n", "tokens", "bits").dropDuplicates(["cls"])
    postings = one.select(F.explode("tokens").alias("token"), "cls").repartition("token").sortWithinPartitions("token")
    shared = postings.mapInArrow(_runs, "token bigint, cls bigint, frequent boolean")
    shared = shared.groupBy("cls").agg(F.collect_list(F.struct("token", "frequent")).alias("shared"))  # at most a class's own tokens
    rows = one.join(shared, "cls").select("cls", "n", "tokens", "bits", "shared").mapInArrow(_prefixes(percent), "token bigint, band int, cls bigint, n bigint, bits binary, home boolean")
    rows = _celled(rows, sig).repartition("token", "band", "cell").sortWithinPartitions("token", "band", "cell")
    return sig, classes, components(rows.mapInArrow(_tiles(percent), "u bigint, v bigint"))


def _verified(held: DataFrame, size: int, percent: int) -> DataFrame:
    """(cls, root): the clusters that exact links make of the possible components."""
    local = held.groupBy("comp", "block").applyInPandas(_block(size, percent), "cls bigint, root bigint, comp bigint, block int, n bigint, bits binary")
    local = saved(local, "block-clusters")

    # Components of several blocks: first every block against the root of the largest cluster.
    wide = held.where("blocks > 1").join(local.select("cls", "root"), "cls")
    counted = local.groupBy("comp", "root").agg(F.count("*").alias("c"))
    largest = saved(counted.groupBy("comp").agg(F.max_by("root", F.struct("c", "root")).alias("lead")), "largest")
    lead = wide.join(largest, "comp").where("cls = lead").select("comp", "cls", "root", "copies", "text", "blocks")
    spread = lead.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))).withColumn("batch", F.lit(0))
    merged = components(_meet(wide, spread, size, percent))
    now = local.join(merged.select(F.col("node").alias("root"), F.col("root").alias("up")), "root", "left").withColumn("root", F.coalesce("up", "root")).drop("up")
    now = saved(now, "lead-clusters")
    # Then the classes outside that cluster against the blocks where a link is possible.
    lead_root = saved(now.join(largest, "comp").where("cls = lead").select("comp", F.col("root").alias("lead_root")), "lead-roots")
    several = now.where(F.col("bits").isNotNull())
    outside = several.join(lead_root, "comp").where("root <> lead_root").drop("lead_root")
    visits = saved(_visits(several, outside, held.select("cls", "low", "high"), percent), "visits")
    guests = visits.join(wide.drop("root", "block", "comp"), "cls").join(now.select("cls", "root"), "cls")
    second = _meet(wide.drop("root").join(now.select("cls", "root"), "cls"), guests, size, percent)
    merged = components(second)
    final = now.join(merged.select(F.col("node").alias("root"), F.col("root").alias("top")), "root", "left")
    return final.select("cls", F.coalesce("top", "root").alias("root"))

def _members(docs: DataFrame, classes: DataFrame, possible: DataFrame, key: str, text: str, percent: int) -> DataFrame:
    """(comp, block, blocks, low, high, cls, n, copies, text): the classes of possible components, dealt over
    blocks by size; those that a class may link with are in the blocks from low to high.

    What is known of a component is written before it is joined, and groups are dealt anew before they
    are worked on: else Spark would keep the join's dealing by component, and so a component in a task."""
    members = saved(possible.select(F.col("node").alias("cls"), F.col("root").alias("comp")).join(classes, "cls"), "possible")
    sizes = saved(_by_size(members, percent), "component-sizes")
    members = members.join(sizes, ["comp", "n"]).withColumn("block", (F.col("at") + F.pmod(F.xxhash64("cls"), F.col("parts"))).cast("int"))
    # A class's text is found by key and hash, as null and repeated keys do not tell texts apart.
    texts = docs.select(F.col(key).alias("_key"), F.xxhash64(text).alias("_hash"), F.col(text).alias("text"))
    held = texts.join(members, F.col("_key").eqNullSafe(F.col("first")) & (F.col("_hash") == F.col("hash")))
    return saved(held.select("comp", "block", "blocks", "low", "high", "cls", "n", "copies", "text").dropDuplicates(["cls"]), "members")


def _by_size(members: DataFrame, percent: int) -> DataFrame:
    """(comp, n, at, parts, blocks, low, high): the blocks of the classes of each size `n` of a component, from
    `at` on, `parts` of them; how many blocks the component has; and the first and last block that may
    hold a class of a size near enough to link. A component's sizes in order fill its blocks, a block with
    one size or some that follow each other; a row a size, so a component's rows are few."""
    share = F.greatest(F.count("*") / BLOCK_CLASSES, F.sum("n") / BLOCK_GRAMS)
    rows = members.groupBy("comp", "n").agg(share.alias("_share"))
    ordered = Window.partitionBy("comp").orderBy("n")
    rows = rows.withColumn("_before", F.coalesce(F.sum("_share").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    rows = rows.withColumns({"at": F.floor("_before").cast("int"), "parts": F.greatest(F.lit(1), F.ceil("_share")).cast("int")})
    rows = rows.withColumn("_end", F.col("at") + F.col("parts") - 1)
    # Sizes of a factor of 100 / percent lie within a fixed reach of their logarithms, rounded outwards.
    scale = 1 << 30
    near = Window.partitionBy("comp").orderBy("_log")
    reach = math.ceil(math.log(100 / percent) * scale) + 2
    rows = rows.withColumn("_log", F.floor(F.log("n") * scale).cast("long"))
    low, high = F.min("at").over(near.rangeBetween(-reach, reach)), F.max("_end").over(near.rangeBetween(-reach, reach))
    blocks = F.max("_end").over(Window.partitionBy("comp")) + 1
    return rows.select("comp", "n", "at", "parts", blocks.cast("int").alias("blocks"), low.cast("int").alias("low"), high.cast("int").alias("high"))


def _cut() -> Column:
    """How many blocks or batches hold the classes of a group."""
    return F.greatest(F.ceil(F.count("*") / BLOCK_CLASSES), F.ceil(F.sum("n") / BLOCK_GRAMS)).cast("int")


def _visits(own: DataFrame, outside: DataFrame, reach: DataFrame, percent: int, later: bool = False) -> DataFrame:
    """(comp, block, batch, cls): the blocks that each class of `outside` has to visit, if `later` only
    those after its own. `reach` has (cls, low, high): no other blocks hold classes of a size near enough. Signatures of a component's guests, in batches of a block's size, meet those of
    each block."""
    columns = ["comp", "block", "batch", "cls", "n", "root", "bits", "guest"]
    outside = saved(outside.join(reach, "cls"), "outside")
    batches = outside.groupBy("comp").agg(_cut().alias("batches"))
    batches = saved(batches, "batches")
    dealt = outside.withColumnRenamed("block", "_own").join(batches, "comp").withColumn("batch", F.pmod(F.xxhash64(F.lit("guest"), "cls"), F.col("batches")).cast("int"))
    first = F.greatest(F.col("low"), F.col("_own") + 1) if later else F.col("low")
    dealt = dealt.where(first <= F.col("high")).withColumn("block", F.explode(F.sequence(first, F.col("high")))).withColumn("guest", F.lit(True))
    hosts = own.join(batches, "comp").withColumn("batch", F.explode(F.sequence(F.lit(0), F.col("batches") - 1))).withColumn("guest", F.lit(False))
    both = hosts.select(columns).unionByName(dealt.select(columns)).repartition("comp", "block", "batch")
    return both.groupBy("comp", "block", "batch").applyInPandas(_possible(percent), "comp bigint, block int, batch int, cls bigint")


def _meet(own: DataFrame, guests: DataFrame, size: int, percent: int) -> DataFrame:
    """Links of guests with the blocks they visit, but those between classes already connected."""
    return _meeting(own, guests).groupBy("comp", "block", "batch").applyInPandas(_against(size, percent), "u bigint, v bigint")


def _meeting(own: DataFrame, guests: DataFrame) -> DataFrame:
    """Guests, which name the blocks they visit and their batch, and the rows of those blocks."""
    columns = ["comp", "block", "batch", "cls", "root", "copies", "text", "guest"]
    hosts = own.join(guests.select("comp", "block", "batch").distinct(), ["comp", "block"]).withColumn("guest", F.lit(False))
    return hosts.select(columns).unionByName(guests.withColumn("guest", F.lit(True)).select(columns)).repartition("comp", "block", "batch")
