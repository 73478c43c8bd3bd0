"""Token ids in shard files of raw payload, each with a minimal perfect hash index over its keys.

Documents are range-partitioned and sorted by key; partition k writes shard k:

* `tokens-k.bin`: the ids of its documents end to end, little-endian unsigned numbers of the narrowest
  width, 16 or 32 bits, that holds the vocabulary's ids;
* `tokens-k.idx`: a header, the keys in order, and the index: levels of bit arrays in which each key
  owns one bit (a key that collides with another goes on to the next level), so that the number of
  bits set before a key's own is its slot, and per slot a 32-bit fingerprint, offset and count.

A lookup takes one bit test a level (under two on average), one count and one fingerprint compare,
whatever the number of keys. A key that isn't there fails the fingerprint but for one in 2**32.

Defined cases: a null text is an empty one (only its end id, if any); a null key sorts first and is
kept; rows that repeat a key are told apart by their number, in the order of a hash of their texts,
and a lookup by key alone finds the first; an empty table writes no shard and reads back no row.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tracewell.llm import tokens
from tracewell.llm.common import get, put, saved, shared_dir, store
from tracewell.llm.wordhash import mix

MAGIC = b"TIDX0001"
GAMMA = 1.6  # bits a key has at each level
LEVELS = 64
SHARD_BYTES, SHARD_ROWS = 256 << 20, 1 << 20  # text and rows of a shard, about
READ, GAP = 8 << 20, 1 << 14  # bytes read at once; ids not asked for that a lookup reads over
_ODD = np.uint64(0x9E3779B97F4A7C15)


def key_hash(key: object, number: int = 0) -> int:
    return xxhash.xxh3_64_intdigest(f"{number}\0{key!r}")


def id_type(vocabulary: int) -> str:
    """The numpy type of the narrowest ids below `vocabulary`."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


class PerfectHash:
    """A minimal perfect hash of distinct 64-bit numbers to 0 .. n - 1."""

    def __init__(self, sizes: list[int], words: np.ndarray) -> None:
        self.sizes, self.words = sizes, words
        self.bases = np.concatenate([[0], np.cumsum([-(-s // 64) for s in sizes])]).astype(np.int64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(words).astype(np.int64))])

    @classmethod
    def build(cls, hashes: np.ndarray) -> PerfectHash:
        left, sizes, parts = hashes, [], []
        while len(left):
            if len(sizes) == LEVELS:
                raise ValueError("two keys of a shard have the same 64-bit hash")
            size = max(64, int(GAMMA * len(left)))
            at = cls._place(left, len(sizes), size)
            taken = np.bincount(at, minlength=size)
            bits = np.zeros(-(-size // 64), np.uint64)
            alone = np.flatnonzero(taken == 1)
            np.bitwise_or.at(bits, alone >> 6, np.uint64(1) << (alone & 63).astype(np.uint64))
            sizes.append(size)
            parts.append(bits)
            left = left[taken[at] > 1]
        return cls(sizes, np.concatenate(parts) if parts else np.zeros(0, np.uint64))

    @staticmethod
    def _place(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
        return (mix(hashes + np.uint64((int(_ODD) * (level + 1)) & (2**64 - 1))) % np.uint64(size)).astype(np.int64)

    def slots(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each number; -1 for some that weren't there."""
        out = np.full(len(hashes), -1, np.int64)
        todo = np.arange(len(hashes))
        for level, size in enumerate(self.sizes):
            if not len(todo):
                break
            at = self._place(hashes[todo], level, size)
            word, bit = self.bases[level] + (at >> 6), (at & 63).astype(np.uint64)
            hit = (self.words[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[hit]] = (self.before[word] + below)[hit]
            todo = todo[~hit]
        return out


def fingerprints(hashes: np.ndarray) -> np.ndarray:
    return (mix(hashes ^ _ODD) >> np.uint64(32)).astype(np.uint32)


class Index:
    """The index of one shard."""

    def __init__(self, perfect: PerfectHash, prints: np.ndarray, offsets: np.ndarray, counts: np.ndarray, keys: list) -> None:
        self.perfect, self.prints, self.offsets, self.counts, self.keys = perfect, prints, offsets, counts, keys

    @classmethod
    def build(cls, keys: list, counts: np.ndarray) -> Index:
        hashes = np.array([key_hash(k, n) for k, n in numbered(keys)], np.uint64)
        perfect = PerfectHash.build(hashes)
        slot = perfect.slots(hashes)
        prints, offsets, by_slot = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        prints[slot] = fingerprints(hashes)
        offsets[slot] = np.concatenate([[0], np.cumsum(counts)[:-1]]) if len(keys) else 0
        by_slot[slot] = counts
        return cls(perfect, prints, offsets, by_slot, keys)

    def find(self, keys: list[tuple[object, int]]) -> tuple[np.ndarray, np.ndarray]:
        """Offset and count of each (key, number); -1 where the fingerprint says it isn't there."""
        hashes = np.array([key_hash(k, n) for k, n in keys], np.uint64)
        slot = self.perfect.slots(hashes)
        there = slot >= 0
        there[there] = self.prints[slot[there]] == fingerprints(hashes[there])
        offsets, counts = np.full(len(keys), -1, np.int64), np.full(len(keys), -1, np.int64)
        offsets[there], counts[there] = self.offsets[slot[there]], self.counts[slot[there]]
        return offsets, counts

    def to_bytes(self) -> bytes:
        table = pa.table({"key": pa.array(self.keys)})
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, table.schema) as out:
            out.write_table(table)
        keys = sink.getvalue().to_pybytes()
        p = self.perfect
        head = struct.pack(f"<8sQQQ{len(p.sizes)}Q", MAGIC, len(self.keys), len(p.sizes), len(keys), *p.sizes)
        return b"".join([head, keys, p.words.astype("<u8").tobytes(), self.prints.astype("<u4").tobytes(), self.offsets.astype("<i8").tobytes(), self.counts.astype("<i8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> Index:
        magic, n, levels, size = struct.unpack_from("<8sQQQ", data)
        if magic != MAGIC:
            raise ValueError("no token index")
        sizes = list(struct.unpack_from(f"<{levels}Q", data, 32))
        at = 32 + 8 * levels
        keys = pa.ipc.open_stream(data[at : at + size]).read_all()["key"].to_pylist()
        at += size
        words = np.frombuffer(data, "<u8", sum(-(-s // 64) for s in sizes), at)
        prints = np.frombuffer(data, "<u4", n, at + words.nbytes)
        offsets = np.frombuffer(data, "<i8", n, at + words.nbytes + prints.nbytes)
        counts = np.frombuffer(data, "<i8", n, at + words.nbytes + prints.nbytes + offsets.nbytes)
        return cls(PerfectHash(sizes, words), prints, offsets, counts, keys)


def numbered(keys: list) -> list[tuple[object, int]]:
    """Each key with how many equal ones stand before it."""
    seen: dict = {}
    out = []
    for k in keys:
        out.append((k, seen.get(k, 0)))
        seen[k] = out[-1][1] + 1
    return out


def shard_count(docs: DataFrame, text: str) -> int:
    """So many shards that one holds about SHARD_BYTES of text and SHARD_ROWS rows at most, and that no
    partition of a shuffle is idle."""
    size, rows = docs.agg(F.sum(F.octet_length(text)), F.count("*")).first()
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(partitions, -(-(size or 0) // SHARD_BYTES), -(-rows // SHARD_ROWS))


def write(docs: DataFrame, key: str = "doc_id", text: str = "text", folder: str | None = None, end_id: int | None = 2, shards: int | None = None, vocabulary: str = tokens.WORD_FILE) -> DataFrame:
    """Write the shards; returns their list (folder, shard, docs, ids, kind, first, last, start), one
    row a shard: kind is the type of the ids, first and last are its least and largest keys (null keys
    don't count), start is the number of ids in all shards before."""
    spark = docs.sparkSession
    folder = folder or shared_dir(spark, "token-files")
    shards = shards or shard_count(docs, text)
    tail = [] if end_id is None else [end_id]
    key_type = dict(docs.dtypes)[key]
    key_arrow = _arrow(key_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, shard = tokens.word_tokens(vocabulary), TaskContext.get().partitionId()
        files, root = store(folder)
        out, keys, counts = None, [], []
        kind = id_type(max(coder.library.get_vocab_size(), *[t + 1 for t in tail], 1))
        part = f"{root}/.tokens-{shard}.{uuid.uuid4().hex}"
        for b in batches:
            if b.num_rows and out is None:
                files.create_dir(root, recursive=True)
                out = files.open_output_stream(part)
            keys += b.column(0).to_pylist()
            for ids in coder.encode(b.column(1).to_pylist()):
                row = np.append(np.frombuffer(ids, "<u4"), tail).astype(kind)
                counts.append(len(row))
                out.write(row.tobytes())
        if out is None:
            return
        out.close()
        files.move(part, f"{root}/tokens-{shard}.bin")
        put(folder, f"tokens-{shard}.idx", Index.build(keys, np.array(counts, np.int64)).to_bytes())
        named = [k for k in keys if k is not None]
        ends = [(k, key_arrow) for k in ((named[0], named[-1]) if named else (None, None))]
        yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in ((folder, pa.string()), (shard, pa.int32()), (len(keys), pa.int64()), (sum(counts), pa.int64()), (kind, pa.string()), *ends)], names=["folder", "shard", "docs", "ids", "kind", "first", "last"])

    order = [F.col(key), F.xxhash64(text)]
    rows = docs.select(key, text).repartitionByRange(shards, *order).sortWithinPartitions(*order)
    written = saved(rows.mapInArrow(run, f"folder string, shard int, docs bigint, ids bigint, kind string, first {key_type}, last {key_type}"), "token-shards")
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return written.withColumn("start", F.coalesce(F.sum("ids").over(before), F.lit(0)))


def _payload(folder: str, shard: int, size: int) -> pa.NativeFile:
    """A shard's open payload of `size` bytes."""
    files, root = store(folder)
    data = files.open_input_file(f"{root}/tokens-{shard}.bin")
    if data.size() != size:
        raise ValueError(f"shard {shard}: payload of {data.size()} bytes, not {size}")
    return data


def _spans(offsets: np.ndarray, counts: np.ndarray, size: int, gap: int = 0) -> Iterator[tuple[int, int]]:
    """Runs of documents [i, j) whose ids, in ascending places, lie at most `gap` ids apart and take up to READ
    bytes together, or that are one document: what one read of the payload brings."""
    i = 0
    for j in range(1, len(offsets) + 1):
        if j == len(offsets) or not 0 <= offsets[j] - offsets[j - 1] - counts[j - 1] <= gap or (offsets[j] + counts[j] - offsets[i]) * size > READ:
            yield i, j
            i = j


def _ids(data: pa.NativeFile, offsets: np.ndarray, counts: np.ndarray, kind: str) -> list[bytes]:
    """The ids of a run of documents, as little-endian unsigned 32-bit numbers."""
    size, first = np.dtype(kind).itemsize, int(offsets[0])
    held = np.frombuffer(data.read_at(size * (int(offsets[-1] + counts[-1]) - first), size * first), kind).astype("<u4")
    return [held[o : o + n].tobytes() for o, n in zip((offsets - first).tolist(), counts.tolist(), strict=True)]


def _arrow(key_type: str) -> pa.DataType:
    return pa.int64() if key_type in ("bigint", "long") else pa.int32() if key_type == "int" else pa.string()


def read(shards: DataFrame, key_type: str, key: str = "doc_id", with_ids: bool = False) -> DataFrame:
    """(key, start, n_tokens, ids_crc32[, ids]) of every document, each found through its shard's
    index; start counts the ids of all documents before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                index = Index.from_bytes(get(r["folder"], f"tokens-{r['shard']}.idx"))
                offsets, counts = index.find(numbered(index.keys))
                if len(offsets) and (offsets < 0).any():
                    raise ValueError(f"shard {r['shard']}: a key of the list isn't in its index")
                size = np.dtype(r["kind"]).itemsize
                with _payload(r["folder"], r["shard"], size * r["ids"]) as data:
                    for a, z in _spans(offsets, counts, size):
                        part = _ids(data, offsets[a:z], counts[a:z], r["kind"])
                        cols = [index.keys[a:z], (offsets[a:z] + r["start"]).tolist(), counts[a:z].tolist(), [zlib.crc32(p) for p in part], part]
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (keys, pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)][: 4 + with_ids], names=[key, "start", "n_tokens", "ids_crc32", "ids"][: 4 + with_ids])

    keys = _arrow(key_type)
    n = int(shards.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return shards.repartitionByRange(n, "shard").mapInArrow(run, f"{key} {key_type}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids binary" * with_ids)


def lookup(shards: DataFrame, asked: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids) of the distinct keys of `asked` that the shards hold, the ids as
    little-endian unsigned 32-bit numbers; of rows that repeat a key, the first. Null keys find
    nothing. Keys meet the list of shards, one row each and as many as `write` was asked for, by
    range; then each task opens the index of its shard and reads only what it finds."""
    key_type = dict(asked.dtypes)[key]
    keys = asked.where(F.col(key).isNotNull()).select(F.col(key).alias("_key")).distinct()
    near = keys.join(F.broadcast(shards), F.col("_key").between(F.col("first"), F.col("last")))
    # A key that ends one shard and starts the next is looked up in the first of them.
    near = near.groupBy("_key").agg(F.min(F.struct("shard", "folder", "ids", "kind", "start")).alias("_at")).select("_key", "_at.*")
    near = near.repartition("shard", F.pmod(F.xxhash64("_key"), F.lit(8))).sortWithinPartitions("shard", "_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, index = None, None
        for b in batches:
            shard = b.column(1).to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]])[: len(shard)]).tolist()
            for i, j in zip(cuts, [*cuts[1:], len(shard)], strict=True):
                r = b.slice(i, 1).to_pylist()[0]
                if held != r["shard"]:
                    held, index = r["shard"], Index.from_bytes(get(r["folder"], f"tokens-{r['shard']}.idx"))
                some = b.column(0).slice(i, j - i).to_pylist()
                offsets, counts = index.find([(k, 0) for k in some])
                size = np.dtype(r["kind"]).itemsize
                there = np.flatnonzero(offsets >= 0)
                there = there[np.argsort(offsets[there], kind="stable")]
                rows = []
                with _payload(r["folder"], r["shard"], size * r["ids"]) as data:
                    for a, z in _spans(offsets[there], counts[there], size, GAP):
                        part = there[a:z]
                        rows += [(some[k], int(offsets[k]) + r["start"], int(counts[k]), ids) for k, ids in zip(part.tolist(), _ids(data, offsets[part], counts[part], r["kind"]), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([x[c] for x in rows], t) for c, t in enumerate((_arrow(key_type), pa.int64(), pa.int64(), pa.binary()))], names=[key, "start", "n_tokens", "ids"])

    return near.mapInArrow(run, f"{key} {key_type}, start bigint, n_tokens bigint, ids binary")
