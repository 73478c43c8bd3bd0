"""64-bit hashes of words and shingles, vectorised over the UTF-8 bytes of many texts.

A word is a run of bytes other than 0x20 and 0x09-0x0D. A word's hash is a polynomial over its
bytes (each byte replaced by a fixed random number), taken as the difference of two prefix sums,
so that hashing costs a few array operations a byte whatever the words are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK = 1 << 18  # bytes hashed at once
_R = np.uint64(0x9E3779B97F4A7C15)
_R_INV = np.uint64(pow(int(_R), -1, 1 << 64))
_BYTES = np.random.default_rng(20_240_601).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, CHUNK + 1)
        up, down = (np.full(size, r, dtype=np.uint64) for r in (_R, _R_INV))
        up[0] = down[0] = 1
        _POWERS[:] = [np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)]
    return _POWERS[0], _POWERS[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts end to end and the n + 1 offsets; a null text is empty."""
    texts = texts.combine_chunks() if isinstance(texts, pa.ChunkedArray) else texts
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data, offsets


def spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words; no word crosses one of `bounds`."""
    word = ~_SPACE[data]
    n = len(data)
    before = np.empty(n + 1, bool)
    before[0] = False
    before[1:] = word
    before[bounds[bounds <= n]] = False
    starts = np.flatnonzero(word & ~before[:-1])
    after = np.empty(n + 1, bool)
    after[:n] = word
    after[n] = False
    after[bounds[bounds <= n]] = False
    ends = np.flatnonzero(word & ~after[1:]) + 1
    return starts, ends


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cut [offsets[0], offsets[-1]) in stretches of about CHUNK bytes that end between words."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = min(at + CHUNK, end)
        if to < end:
            k = int(np.searchsorted(offsets, to, side="right")) - 1
            if offsets[k] > at:
                to = int(offsets[k])
            else:
                while to < end and not _SPACE[data[to]]:
                    to += 1
        yield at, to
        at = to


def word_hashes(data: np.ndarray, offsets: np.ndarray, lower: bool = True, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, list[np.ndarray]]:
    """Document number of each word, and its hashes: of the whole word, then of its first k bytes
    for each k of `prefixes` (0 for shorter words). Words are in the order of the text."""
    docs, found = [], [[] for _ in range(1 + len(prefixes))]
    for a, b in _pieces(data, offsets):
        part = data[a:b]
        part = _LOWER[part] if lower else part
        inner = offsets[(offsets >= a) & (offsets <= b)] - a
        starts, ends = spans(part, inner)
        if not len(starts):
            continue
        up, down = _powers(len(part) + 1)
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(_BYTES[part] * up[: len(part)], out=sums[1:])
        docs.append(np.searchsorted(offsets, starts + a, side="right") - 1)
        first, unit = sums[starts], down[starts]
        found[0].append(mix((sums[ends] - first) * unit))
        for k, out in zip(prefixes, found[1:], strict=True):
            long = ends - starts >= k
            to = np.where(long, starts + k, starts)
            out.append(np.where(long, mix((sums[to] - first) * unit + np.uint64(k)), np.uint64(0)))
    if not docs:
        return np.zeros(0, np.int64), [np.zeros(0, np.uint64) for _ in found]
    return np.concatenate(docs), [np.concatenate(x) for x in found]


_STEP = [np.uint64(x) for x in (0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3, 0x589965CC75374CC3, 0x1D8E4E27C47D124F)]


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Sorted distinct hashes of the `size`-word shingles of one text; fewer words make one shingle
    of the whole sequence, no word none."""
    n = len(words)
    if n == 0:
        return words
    if n < size:
        h = np.uint64(n)
        with np.errstate(over="ignore"):
            for w in words:
                h = mix(np.array([h * _STEP[0] + w], np.uint64))[0]
        return np.array([h], np.uint64)
    total = words[: n - size + 1] * _STEP[0]
    for k in range(1, size):
        total = total * _STEP[1] + (words[k : n - size + 1 + k] ^ _STEP[k % len(_STEP)]) * _STEP[(k + 1) % len(_STEP)]
        total ^= total >> np.uint64(29)
    return np.unique(mix(total))
