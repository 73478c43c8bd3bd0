"""Byte-level BPE over whole columns of texts: encode, decode, and their digests.

Defined cases: a null text is an empty one, with no ids; ids outside the table fail the job; repeated
rows are encoded each on their own; extra columns stay out of the results. Bytes that are no UTF-8
after decoding become U+FFFD in `decoded`, and are kept as they are in digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tracewell.llm import tokens


def encoded(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = tokens.BYTE_FILE, offsets: bool = False) -> DataFrame:
    """(key, ids array<int>) of every row; with `offsets` also byte_starts and char_starts, each one
    longer than ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.byte_tokens(vocabulary)
        for b in batches:
            ids = [np.frombuffer(x, "<u4") for x in coder.encode(b.column(1).to_pylist())]
            cols = [pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))]
            if offsets:
                both = [coder.offsets(x) for x in ids]
                cols += [pa.array([o[k] for o in both], pa.list_(pa.int64())) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cols], names=[key, "ids", "byte_starts", "char_starts"][: 1 + len(cols)])

    more = ", byte_starts array<bigint>, char_starts array<bigint>" if offsets else ""
    return docs.select(key, text).mapInArrow(run, f"{key} {dict(docs.dtypes)[key]}, ids array<int>{more}")


def decoded(rows: DataFrame, key: str = "doc_id", ids: str = "ids", vocabulary: str = tokens.BYTE_FILE) -> DataFrame:
    """(key, text) from (key, ids); a null list is an empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.byte_tokens(vocabulary)
        for b in batches:
            texts = ["".join(coder.texts(iter([np.asarray(x or [], np.int64)]))) for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=[key, "text"])

    return rows.select(key, ids).mapInArrow(run, f"{key} {dict(rows.dtypes)[key]}, text string")


def round_trip(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = tokens.BYTE_FILE) -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256, n_chars): each text is encoded and its ids are decoded
    in the same task, so the ids themselves never leave it; n_chars is where the offsets end."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = tokens.byte_tokens(vocabulary)
        for b in batches:
            n, of_ids, of_bytes, chars = [], [], [], []
            for ids in coder.encode(b.column(1).to_pylist()):
                n.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                numbers = np.frombuffer(ids, "<u4")
                data = coder.decode(numbers)
                of_bytes.append(hashlib.sha256(data).hexdigest())
                chars.append(int(coder.offsets(numbers, data)[1][-1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string()), pa.array(chars, pa.int64())], names=[key, "n_tokens", "ids_sha256", "decoded_sha256", "n_chars"])

    return docs.select(key, text).mapInArrow(run, f"{key} {dict(docs.dtypes)[key]}, n_tokens bigint, ids_sha256 string, decoded_sha256 string, n_chars bigint")
