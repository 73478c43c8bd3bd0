"""Token counts of whole texts under a byte-level BPE file, by rank-synchronous merging of arrays.

A text is cut where a special token's string stands (one token each, as the library's default has it)
and in between in pre-tokens by the published pattern. Distinct pre-tokens of a batch of texts that
the worker doesn't remember are laid end to end as one array of symbols with the number of their
sequence: ragged rows. In each round every sequence's lowest-ranked pair is found for all sequences
at once (`minimum.reduceat`) and applied wherever it stands in its sequence; sequences without a
ranked pair leave with the count of their symbols. A sequence longer than `LONG` bytes takes the
same steps by itself over linked positions kept by rank, so that a step costs the places that it
changes and not the whole sequence.

Applying a pair everywhere at once is right where no merge can make a symbol that a pair of a lower
rank waits for; `MergeRanks` checks that of its file. The pattern's character classes are those of
the library up to code points that its tables and `regex`'s may hold in different versions: texts
with any outside of `KNOWN` are cut by the library's own pre-tokenizer.

Defined cases: a null text is an empty one, of no bytes and no tokens; null and repeated ids keep a
row each; an empty table gives no rows; extra columns are ignored. Texts of any length are cut in runs
of `PARTS` pre-tokens, so that what a task holds doesn't grow with them.
"""

from __future__ import annotations

import heapq
import json
import os
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from tracewell.llm.tokens import byte_letters, path

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
VOCABULARY, LIMIT = "byte_bpe_50k.json", 1024
PARTS, LONG = 1 << 16, 96  # pre-tokens looked up together; bytes of a sequence merged with others
MEMO, KEPT = 1 << 19, 64  # pre-tokens that a worker remembers, at most; characters of one that is remembered, at most
#: The pattern of byte-level pre-tokens, and characters that every Unicode table since version 12 classes alike.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
KNOWN = r"\x00-\u0557\u0900-\u0963\u1E00-\u1EFF\u2000-\u206F\u20A0-\u20BF\u2100-\u2BFF\u3000-\u3029\u3041-\u3096\u30A0-\u30FF\u3400-\u4DB5\u4E00-\u9FEF\uAC00-\uD7A3\uFF01-\uFF5E\U0001F300-\U0001F64F"
NONE = np.int64(1) << 40
_LOADED: dict[str, MergeRanks] = {}


def merge_ranks(name: str = VOCABULARY) -> MergeRanks:
    if name not in _LOADED:
        _LOADED[name] = MergeRanks(name)
    return _LOADED[name]


class MergeRanks:
    """A byte-level BPE file as arrays: sorted keys of pairs, their ranks and what they make."""

    def __init__(self, name: str = VOCABULARY) -> None:
        import regex
        from tokenizers import Tokenizer, pre_tokenizers

        with open(path(name), encoding="utf-8") as f:
            chain = json.load(f)
        model, first = chain["model"], chain["pre_tokenizer"] or {}
        plain = model["type"] == "BPE" and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges"))
        if not plain or chain["normalizer"] or first.get("type") != "ByteLevel" or first.get("add_prefix_space") or not first.get("use_regex", True) or chain["truncation"] or chain["padding"]:
            raise ValueError(f"{name} isn't a plain byte-level BPE file")
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in chain["added_tokens"]):
            raise ValueError(f"{name} has special tokens that take neighbouring characters")
        vocabulary = model["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = np.array([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges], np.int64).reshape(-1, 3)
        ranks = np.arange(len(pairs), dtype=np.int64)
        self.size = np.int64(max(vocabulary.values()) + 1)
        made_at = np.full(int(self.size), -1, np.int64)
        np.maximum.at(made_at, pairs[:, 2], ranks)
        if (made_at[pairs[:, :2]] >= ranks[:, None]).any():
            raise ValueError(f"{name} has a merge that comes before one of its parts")
        key = pairs[:, 0] * self.size + pairs[:, 1]
        order = np.argsort(key)
        self.keys, self.ranks, self.made = np.append(key[order], np.iinfo(np.int64).max), np.append(ranks[order], NONE), pairs[:, 2]
        self.letters = np.array([vocabulary[c] for c in byte_letters()], np.int64)
        special = sorted((t["content"] for t in chain["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.pattern, self.odd = regex.compile(PATTERN), regex.compile(f"[^{KNOWN}]")
        self.library = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.known: dict[str, int] = {}
        Tokenizer.from_file(path(name))  # a file that the library can't read is an error here too

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; NONE where there is none."""
        key = left * self.size + right
        at = np.searchsorted(self.keys, key)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def symbols(self, words: list[bytes]) -> np.ndarray:
        """Number of symbols that each of some sequences of bytes ends as."""
        out = np.zeros(len(words), np.int64)
        short = [k for k, w in enumerate(words) if 0 < len(w) <= LONG]
        if short:
            out[short] = self._together([words[k] for k in short])
        for k, w in enumerate(words):
            if len(w) > LONG:
                out[k] = self._alone(w)
        return out

    def _together(self, words: list[bytes]) -> np.ndarray:
        out = np.array([len(w) for w in words], np.int64)
        ids = self.letters[np.frombuffer(b"".join(words), np.uint8)]
        row = np.repeat(np.arange(len(words)), out)  # the sequence of each symbol
        while len(ids):
            starts = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
            ranks = np.full(len(ids), NONE)  # of the pair that begins at each symbol
            ranks[:-1] = np.where(row[1:] == row[:-1], self.rank(ids[:-1], ids[1:]), NONE)
            lengths = np.diff(np.append(starts, len(ids)))
            lowest = np.repeat(np.minimum.reduceat(ranks, starts), lengths)
            out[row[starts]] = lengths
            hit = every_second(np.flatnonzero((ranks == lowest) & (ranks < NONE)))
            ids[hit] = self.made[ranks[hit]]
            stay = lowest < NONE
            stay[hit + 1] = False
            ids, row = ids[stay], row[stay]
        return out

    def _alone(self, word: bytes) -> int:
        ids = self.letters[np.frombuffer(word, np.uint8)]
        n = len(ids)
        ids = np.append(ids, -1)
        after, before = np.arange(1, n + 2), np.arange(-1, n)  # neighbours; n is the end
        there = np.ones(n + 1, bool)
        waiting: dict[int, list[np.ndarray]] = {}
        queue: list[int] = []

        def wait(at: np.ndarray) -> None:
            at = at[after[at] < n]
            ranks = self.rank(ids[at], ids[after[at]])
            at, ranks = at[ranks < NONE], ranks[ranks < NONE]
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cuts = np.flatnonzero(np.append(True, ranks[1:] != ranks[:-1])) if len(at) else []
            for places, r in zip(np.split(at, cuts[1:]), ranks[cuts].tolist(), strict=True) if len(at) else ():
                if r not in waiting:
                    waiting[r] = []
                    heapq.heappush(queue, r)
                waiting[r].append(places)

        wait(np.arange(n))
        while queue:
            r = heapq.heappop(queue)
            at = np.unique(np.concatenate(waiting.pop(r)))
            at = at[there[at] & (after[at] < n)]
            at = at[self.rank(ids[at], ids[after[at]]) == r]
            at = every_second(at, after)
            gone = after[at]
            ids[at], there[gone] = self.made[r], False
            after[at] = after[gone]
            before[after[at]] = at
            wait(np.unique(np.concatenate([at, before[at][before[at] >= 0]])))
        return int(there[:n].sum())

    def cut(self, text: str) -> Iterator[str | None]:
        """Pre-tokens of a text; None stands for a special token."""
        at = 0
        for m in self.special.finditer(text) if self.special else ():
            yield from self._cut(text[at : m.start()])
            yield None
            at = m.end()
        yield from self._cut(text[at:] if at else text)

    def _cut(self, text: str) -> Iterator[str]:
        if self.odd.search(text):
            return (text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text))
        return iter(self.pattern.findall(text)) if len(text) < 4 * PARTS else (m[0] for m in self.pattern.finditer(text))

    def count(self, texts: list[str | None]) -> np.ndarray:
        """Tokens of each text."""
        out = np.zeros(len(texts), np.int64)
        held: list[tuple[int, list[str | None]]] = []
        room = PARTS
        for k, text in enumerate(texts):
            parts = self.cut(text) if text else iter(())
            while run := list(islice(parts, room)):
                held.append((k, run))
                room -= len(run)
                if not room:
                    self._look_up(held, out)
                    held, room = [], PARTS
        self._look_up(held, out)
        return out

    def _look_up(self, held: list[tuple[int, list[str | None]]], out: np.ndarray) -> None:
        known = self.known
        found = [list(map(known.get, run)) for _, run in held]
        missing = list({p for (_, run), got in zip(held, found, strict=True) if None in got for p, x in zip(run, got, strict=True) if x is None and p is not None})
        new = dict(zip(missing, self.symbols([p.encode() for p in missing]).tolist(), strict=True))
        new[None] = 1
        for (k, run), got in zip(held, found, strict=True):
            out[k] += sum(got) if None not in got else sum([new[p] if x is None else x for p, x in zip(run, got, strict=True)])
        del new[None]
        if len(known) + len(new) > MEMO:  # the older half stays: frequent parts come early
            self.known = known = dict(islice(known.items(), MEMO // 2))
        known.update((p, x) for p, x in new.items() if len(p) <= KEPT)


def every_second(hits: np.ndarray, after: np.ndarray | None = None) -> np.ndarray:
    """Of hits in a row, where each one's right symbol is the next one's left, the first, third and so
    on; `after` gives a symbol's right neighbour where that isn't the next place."""
    if len(hits) < 2:
        return hits
    chained = np.append(False, hits[1:] == (hits[:-1] + 1 if after is None else after[hits[:-1]]))
    place = np.arange(len(hits))
    began = np.maximum.accumulate(np.where(chained, 0, place))
    return hits[(place - began) % 2 == 0]


def counted(docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: str = VOCABULARY, limit: int = LIMIT) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit) of every row: bytes in UTF-8, tokens, and whether there are
    more than `limit`. A scan without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = merge_ranks(vocabulary)
        for b in batches:
            n = coder.count(b.column(1).to_pylist())
            size = pc.fill_null(pc.binary_length(b.column(1)), 0).cast(pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), size, pa.array(n), pa.array(n > limit)], names=[key, "n_bytes", "n_tokens", "over_limit"])

    kind = dict(docs.dtypes)[key]
    return docs.select(key, text).mapInArrow(run, f"`{key}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean")
