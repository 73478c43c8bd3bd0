"""Ranked lexical search: the k best rows of a table of texts for each of a set of queries.

Windowed bucket scoring. Rows are numbered in the order in which tasks read them, and every `WINDOW`
numbers are a window, whose postings (for each term of the queries: the places in the window that hold it, and how
often) are written as one row of a table. Queries are scored window by window: each of a query's terms
scatter-adds its postings into one array of scores of cache size, a bitset a term marks the places that it
touches, and the bitset of a query, the union of its terms', says where to harvest. What is harvested goes into
a heap of k a query, which lasts for all windows of a task; a window in which a query's terms can't add
up to the least of its full heap is passed over. Tasks hand out their heaps and Spark ranks those.

No text is shuffled; counts (rows with a term, terms in all, rows a term) are sums over the written
windows. Queries come in blocks of about `BLOCK` bytes of text, so neither the driver nor a task ever holds more
than a block of them; a block is one pass over the texts.

A term is a run of ASCII letters and digits and of characters beyond ASCII; A to Z count as a to z. A
term that df of N rows hold weighs w = floor(1000 ln((2 N + 2) / (2 df + 1))); a row of n terms of which tf are
the term gains w * (1000000000 tf div (1000 tf + 12 m)) for it, with m = 75 + (25 n N) div L, L being all
rows' terms; a term repeated in the query counts as often.

Defined cases: a null text has no terms; a query without terms, or whose terms no row holds, has no rows
in the result; rows of score 0 are none; equal scores are ordered by key, null first; every row of either table
stands for itself, so repeated keys are ranked each; extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewell.llm.common import saved

WINDOW = 2048  # rows of a window, 65,536 at most: 16 KiB of scores
BLOCK = 8 << 20  # bytes of queries handled at once, about
POSTINGS = 1 << 22  # occurrences counted at once within a window
_SPLIT = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))  # letters to lower case, separators to blanks


def terms(text: str) -> list[bytes]:
    """The terms of a text, in order, in UTF-8."""
    return text.encode().translate(_SPLIT).split()


def postings(docs: DataFrame, vocabulary: dict[bytes, int], key: str, text: str, window: int) -> DataFrame:
    """One row a window: its rows' keys and numbers of terms, the terms of `vocabulary` found (ascending),
    where the postings of each begin (and, last, the end), and the postings' places and counts."""
    kind = dict(docs.dtypes)[key]
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)  # a block of queries at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        keys: list[pa.Array] = []
        sizes: list[int] = []
        found: list[np.ndarray] = []  # counted occurrences: term * window + place, times
        times: list[np.ndarray] = []
        fresh: list[np.ndarray] = []  # not yet counted
        waiting = 0

        def count() -> None:
            nonlocal waiting
            if fresh:
                k, n = np.unique(np.concatenate(fresh), return_counts=True)
                found.append(k)
                times.append(n)
                fresh.clear()
                waiting = 0

        def close() -> pa.RecordBatch:
            count()
            k, n = np.concatenate([np.zeros(0, np.int64), *found]), np.concatenate([np.zeros(0, np.int64), *times])
            k, at = np.unique(k, return_inverse=True)
            total = np.zeros(len(k), np.int64)
            np.add.at(total, at, n)
            term, place = k // window, k % window
            starts = np.flatnonzero(np.append(True, term[1:] != term[:-1])) if len(k) else np.zeros(0, np.int64)
            row = {"keys": pa.concat_arrays(keys), "sizes": pa.array(sizes, pa.int64()), "terms": pa.array(term[starts], pa.int32()), "starts": pa.array(np.append(starts, len(k)), pa.int64())}
            lists = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for v in row.values()]
            cells = [pa.array([place.astype("<u2").tobytes()], pa.binary()), pa.array([total.astype("<u4").tobytes()], pa.binary())]
            for held in (keys, sizes, found, times):
                held.clear()
            return pa.RecordBatch.from_arrays([*lists, *cells], names=[*row, "places", "times"])

        for b in batches:
            at = 0
            while at < len(b):
                part = b.slice(at, window - len(sizes))
                at += len(part)
                keys.append(part.column(0))
                for t in part.column(1).to_pylist():
                    words = terms(t) if t else []
                    ids = np.array([known.get(w, -1) for w in words], np.int64)
                    fresh.append(ids[ids >= 0] * window + len(sizes))
                    sizes.append(len(words))
                    waiting += len(fresh[-1])
                    if waiting > POSTINGS:
                        count()
                if len(sizes) == window:
                    yield close()
        if sizes:
            yield close()

    return docs.select(key, text).mapInArrow(run, f"keys array<{kind}>, sizes array<bigint>, terms array<int>, starts array<bigint>, places binary, times binary")


def weight(rows: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * rows + 2) / (2 * holding + 1)))


class _Best:
    """The k best of a query: the largest score first, then the smallest key, null before all."""

    def __init__(self, k: int) -> None:
        self.k, self.heap = k, []  # (score, reversed key, number of its own)
        self.least = 1  # no lower score can enter

    def add(self, score: int, key: object, number: int) -> None:
        entry = (score, _Last(key), -number)
        if len(self.heap) < self.k:
            heapq.heappush(self.heap, entry)
        elif self.heap[0] < entry:
            heapq.heapreplace(self.heap, entry)
        if len(self.heap) == self.k:
            self.least = self.heap[0][0]


class _Last:
    """A key that sorts the other way round; null is the greatest."""

    __slots__ = ("key",)

    def __init__(self, key: object) -> None:
        self.key = key

    def __eq__(self, other: object) -> bool:
        return self.key == other.key

    def __lt__(self, other: _Last) -> bool:
        return self.key is not None and (other.key is None or other.key < self.key)


def scored(windows: DataFrame, queries: list[list[tuple[int, int]]], weights: dict[int, int], rows: int, total: int, kind: str, k: int, window: int) -> DataFrame:
    """(query, key, score): the k best of each task's windows for each query, a list of (term, times)."""
    shared = windows.sparkSession.sparkContext.broadcast((queries, weights))  # a block of queries at most

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        queries, weights = shared.value
        best = [_Best(k) for _ in queries]
        scores = np.zeros(window, np.int64)
        number = 0  # of the window's first row
        for b in batches:
            kinds = b.schema.field("keys").type.value_type
            for i in range(len(b)):
                keys, sizes, found, starts = (b.column(c)[i].as_py() for c in range(4))
                places, times = (np.frombuffer(b.column(c)[i].as_py(), t).astype(np.int64) for c, t in ((4, "<u2"), (5, "<u4")))
                if found:
                    gains, bits = _gains(sizes, found, starts, places, times, weights, rows, total, window)
                    most = np.maximum.reduceat(gains, starts[:-1]).tolist()
                    at = {t: j for j, t in enumerate(found)}
                    for query, heap in zip(queries, best, strict=True):
                        here = [(at[t], n) for t, n in query if t in at]
                        if sum([most[j] * n for j, n in here]) < heap.least:
                            continue
                        for j, n in here:
                            a, z = starts[j], starts[j + 1]
                            scores[places[a:z]] += gains[a:z] * n  # a term has a place once
                        occupied = np.bitwise_or.reduce(bits[[j for j, _ in here]])
                        touched = np.flatnonzero(np.unpackbits(occupied))
                        got = scores[touched]
                        scores[touched] = 0
                        for score, p in _harvest(got, touched, keys, heap.least, k):
                            heap.add(score, keys[p], number + p)
                number += len(keys)
        out = [(q, -n, score, key.key) for q, heap in enumerate(best) for score, key, n in heap.heap]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[3] for r in out], kinds), pa.array([r[2] for r in out], pa.int64())], names=["query", "key", "score"])

    return windows.mapInArrow(run, f"query int, key {kind}, score bigint")


def _gains(sizes: list[int], found: list[int], starts: list[int], places: np.ndarray, times: np.ndarray, weights: dict[int, int], rows: int, total: int, window: int) -> tuple[np.ndarray, np.ndarray]:
    """What each posting adds to its place, and the bitset of places of each term."""
    m = np.array([75 + 25 * n * rows // total for n in sizes], np.int64)
    term = np.repeat(np.arange(len(found)), np.diff(starts))
    gains = np.array([weights[t] for t in found], np.int64)[term] * (1_000_000_000 * times // (1000 * times + 12 * m[places]))
    seen = np.zeros((len(found), window), bool)
    seen[term, places] = True
    return gains, np.packbits(seen, axis=1)


def _harvest(got: np.ndarray, touched: np.ndarray, keys: list, least: int, k: int) -> list[tuple[int, int]]:
    """(score, place) of the places that may enter a heap: at most k, the best of a window."""
    good = np.flatnonzero(got >= least)
    if len(good) > k:
        good = good[got[good] >= np.partition(got[good], -k)[-k]]
    out = [(int(x), int(p)) for x, p in zip(got[good], touched[good], strict=True)]
    return heapq.nsmallest(k, out, key=lambda e: (-e[0], keys[e[1]] is not None, keys[e[1]])) if len(out) > k else out


def _queries(items: DataFrame, key: str, text: str, block: int) -> Iterator[list[tuple[object, str]]]:
    """The queries in blocks of about `block` bytes, by a hash of their rows."""
    rows = items.select(F.col(key).alias("key"), F.col(text).alias("text")).where("text is not null")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-size // block)
    rows = saved(rows.withColumn("block", F.pmod(F.xxhash64("key", "text", F.monotonically_increasing_id()), F.lit(max(blocks, 1)))), "queries") if blocks > 1 else rows.withColumn("block", F.lit(0))
    for n in range(blocks):
        yield [(r["key"], r["text"]) for r in rows.where(F.col("block") == n).collect()]


def search(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """(item, rank, key, score): the k rows of `docs` with the highest scores for each row of `items`, rank 1
    the best. `key` and `item` keep their names."""
    spark, kind, item_kind = docs.sparkSession, dict(docs.dtypes)[key], dict(items.dtypes)[item]
    out = None
    for queries in _queries(items, item, item_text, block):
        counted = [Counter(terms(t)) for _, t in queries]
        vocabulary = {t: n for n, t in enumerate(sorted({t for c in counted for t in c}))}
        windows = saved(postings(docs, vocabulary, key, text, window), "windows")
        rows, total = windows.select(F.explode("sizes").alias("n")).agg(F.count_if(F.col("n") > 0), F.sum("n")).first()
        pairs = F.explode(F.expr("transform(terms, (t, i) -> struct(t as term, starts[i + 1] - starts[i] as n))")).alias("p")
        holding = windows.select(pairs).groupBy("p.term").agg(F.sum("p.n").alias("df")).collect()  # a row a term of the block
        weights = {r["term"]: weight(rows, r["df"]) for r in holding}
        asked = [[(vocabulary[t], n) for t, n in c.items()] for c in counted]
        names = spark.createDataFrame([(n, q[0]) for n, q in enumerate(queries)], f"query int, item {item_kind}")
        found = scored(windows, asked, weights, rows, total or 1, kind, k, window)
        best = Window.partitionBy("query").orderBy(F.desc("score"), F.col("key").asc_nulls_first())
        found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).join(F.broadcast(names), "query")  # a block of queries
        found = found.select(F.col("item").alias(item), "rank", F.col("key").alias(key), "score")
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], f"`{item}` {item_kind}, rank int, `{key}` {kind}, score bigint")
