"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Bulk-synchronous best-fit decreasing. Pieces are range-sorted by length. As lengths are whole
numbers of at most `capacity`, that order is a list of at most `capacity` runs of equal lengths,
and so are the gaps of open sequences; a superstep sweeps runs, not rows:

1. every run of pending pieces, from the longest down, looks up its successor among the gap runs,
   the smallest gap that holds it (a sorted search for all runs at once);
2. where several runs want one gap run, the longest goes first (its rank decides), each taking as
   many gaps as it can fill with as many pieces as fit; the others wait for the next superstep;
3. gaps shrink, equal gaps merge into one run, and the sweep repeats; only when the longest pending
   run has no successor does it open new sequences.

The supersteps see counts by length, so what the driver holds is bounded by `capacity`, whatever
the input. All rows stay in Spark: a piece's rank within its length is its row number in a bucket of
that length (none holds more than a small share of all pieces) plus the bucket's start, and one join on (length, rank range)
against the bounded plan gives it its sequence and offset. Pieces as long as a sequence fill one each,
without a shuffle.

Defined cases: a null text is empty and holds only the end id; repeated rows are packed each; ties
in length are ranked by the number of their row in the written table; an empty table gives no rows;
extra columns are ignored.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewell.llm import tokens
from tracewell.llm.common import release, saved

CAPACITY = 2048
TEXTS = 256  # held as Python strings at once
RUN, LEAST, SHARES = 100_000, 256, 1024  # pieces of a length ranked together: one in SHARES of all, within LEAST and RUN, about


def pieces(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = 0, vocabulary: str = tokens.WORD_FILE, with_ids: bool = False, memo: int | None = None) -> DataFrame:
    """(key, piece, start, length, ids_crc32[, ids]) of every document's ids and its end id; only
    documents longer than `capacity` are cut. `memo`: bytes of parts of texts that a task remembers, and
    forgets when it ends; None: as many as `tokens.MEMO`, kept for the worker's next task."""
    end = np.array([end_id], "<u4").tobytes()
    step = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.word_tokens(vocabulary)
        release()  # a worker that has done other work first may hold its memory
        try:
            yield from cut(coder, batches)
        finally:
            if memo is not None:
                coder.forget()
                release()

    def cut(coder: tokens.WordTokens, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            at: list[int] = []
            # Texts are taken from the batch a few at a time, and ids are kept only where they are asked for.
            parts = (b.column(1).slice(a, TEXTS).to_pylist() for a in range(0, b.num_rows, TEXTS))
            for k, ids in enumerate(chain.from_iterable(coder.encode(p, most=memo) for p in parts)):
                ids += end
                for i, a in enumerate(range(0, len(ids), step)):
                    part = ids[a : a + step]
                    at.append(k)
                    rows.append((i, a // 4, len(part) // 4, zlib.crc32(part), part if with_ids else None))
            cols = [b.column(0).take(pa.array(at, pa.int64()))]
            cols += [pa.array([r[j] for r in rows], t) for j, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            if with_ids:
                cols.append(pa.array([r[4] for r in rows], pa.binary()))
            yield pa.RecordBatch.from_arrays(cols, names=[key, "piece", "start", "length", "ids_crc32", "ids"][: len(cols)])

    schema = f"{key} {dict(docs.dtypes)[key]}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids binary" * with_ids
    return docs.select(key, text).mapInArrow(run, schema)


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """The supersteps over runs. Returns rows (length, first rank, pieces, pieces a sequence, first
    sequence, offset): of a length's pieces, those from `first rank` on fill sequences from `first
    sequence` on, `pieces a sequence` each, the first at `offset`."""
    pending = {n: [0, c] for n, c in counts.items() if c}  # length: next rank, pieces left
    gaps: list[int] = []  # sorted sizes of gaps
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (first sequence, sequences)
    out: list[tuple[int, int, int, int, int, int]] = []
    opened = 0

    def gap(size: int, first: int, n: int) -> None:
        if size and n:
            if not runs[size]:
                insort(gaps, size)
            runs[size].append((first, n))

    def fill(length: int, first: int, n: int, size: int) -> int:
        """Put pieces of a length into `n` sequences from `first` on with gaps of `size`; returns
        the sequences used."""
        rank, left = pending[length]
        each = size // length
        whole = min(n, left // each)
        if whole:
            out.append((length, rank, whole * each, each, first, capacity - size))
            gap(size - each * length, first, whole)
            rank, left = rank + whole * each, left - whole * each
        if left and whole < n:  # the last pieces don't fill a sequence
            out.append((length, rank, left, left, first + whole, capacity - size))
            gap(size - left * length, first + whole, 1)
            rank, left, whole = rank + left, 0, whole + 1
        pending[length] = [rank, left]
        return whole

    lengths = sorted(pending, reverse=True)
    while lengths:
        # One superstep. A gap run wanted by several runs of pieces goes to the longest; no run
        # longer than the winner can use that gap, as its successor is larger.
        won: dict[int, int] = {}
        stuck = []
        for n in lengths:
            i = bisect_left(gaps, n)
            if i < len(gaps):
                won.setdefault(gaps[i], n)
            else:
                stuck.append(n)
        for size, n in won.items():
            todo, runs[size] = runs[size], []
            gaps.remove(size)
            for first, count in todo:
                used = fill(n, first, count, size) if pending[n][1] else 0
                gap(size, first + used, count - used)
        if stuck and stuck[0] == lengths[0]:
            n = -(-pending[stuck[0]][1] // (capacity // stuck[0]))
            fill(stuck[0], opened, n, capacity)
            opened += n
        lengths = [n for n in lengths if pending[n][1]]
    return out


def packed(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """`rows` with sequence_id and offset, from their `length` and `_row`, a number of its own for
    each row; read three times. Sequences of full pieces have negative numbers."""
    spark = rows.sparkSession
    columns = [c for c in rows.columns if c != "_row"]
    full = rows.where(F.col("length") == capacity).select(*columns, (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    rows = rows.where(F.col("length") < capacity)
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    run = max(LEAST, min(RUN, sum(counts.values()) // SHARES))
    buckets = spark.createDataFrame([(n, -(-c // run)) for n, c in counts.items()] or [(0, 1)], "length bigint, _buckets int")
    rows = rows.join(F.broadcast(buckets), "length").withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.col("_buckets")).cast("int"))
    ranked = rows.withColumn("_in", F.row_number().over(Window.partitionBy("length", "_bucket").orderBy("_row")) - 1)
    sizes = rows.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.withColumn("_from", F.coalesce(F.sum("_n").over(before), F.lit(0)))  # a row a bucket
    steps = spark.createDataFrame(plan(counts, capacity) or [(0, 0, 0, 1, 0, 0)], "_length bigint, _first bigint, _pieces bigint, _each bigint, _sequence bigint, _offset bigint")
    placed = ranked.join(starts.select("length", "_bucket", "_from"), ["length", "_bucket"]).withColumn("_rank", F.col("_from") + F.col("_in"))
    met = (F.col("length") == F.col("_length")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_first") + F.col("_pieces"))
    placed = placed.join(F.broadcast(steps), met)  # the plan's size follows capacity, not the input
    at = F.col("_rank") - F.col("_first")
    placed = placed.withColumn("sequence_id", F.expr("_sequence + (_rank - _first) div _each"))
    placed = placed.withColumn("offset", F.col("_offset") + at % F.col("_each") * F.col("length"))
    return full.unionByName(placed.select(full.columns))


def pack(docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = 0, vocabulary: str = tokens.WORD_FILE, with_ids: bool = False, memo: int | None = None) -> DataFrame:
    """Tokenise and pack. The pieces, without ids some tens of bytes each, are written once in the
    shared folder and read for the counts and for the placing."""
    rows = pieces(docs, key, text, capacity, end_id, vocabulary, with_ids, memo).withColumn("_row", F.monotonically_increasing_id())
    return packed(saved(rows, "pieces"), capacity)
