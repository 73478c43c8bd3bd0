"""Token ids of whole texts with the `tokenizers` library, and byte-level decoding.

Both encoders cut a text in parts that the tokenizer treats one by one anyway, keep each part's ids
in a bounded memo of the worker process, and hand parts not yet seen to the library in one batch.

* `WordTokens` (a tokenizer file): a tokenizer that drops white space, as `word_bpe_49k.json` does, gets
  the stretches between blanks as parts; whether a file is one of those is read from its chain
  (`DROPS_SPACE`), and any other gets whole texts. Strings of special tokens within a text become
  those tokens, as in the library's own call.
* `ByteTokens` (a table of byte-level ranks): parts are the matches of the public pattern. A BPE
  model is built from the ranks: a token's rank is the priority of every pair that makes it. The
  ranks leave one thing open: which of two equal tokens is made first. A part in which no pair of
  bytes repeats holds no token twice; any other is held against the `tiktoken` library, which wins.

A null text is an empty one; an empty text has no ids (an end id, if asked for, is still added).
"""

from __future__ import annotations

import base64
import codecs
import json
import os
import re
import sys
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
MEMO, LONG = 240 << 20, 256  # bytes, at most, of the parts that a worker remembers; longer parts are not kept
#: The chain of a tokenizer whose parts between blanks can be encoded one by one.
DROPS_SPACE = {
    "normalizer": {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
WORD_FILE = "word_bpe_49k.json"
BYTE_FILE = "byte_bpe_multi_50k.tiktoken"
_LOADED: dict[tuple[str, str], object] = {}


def path(name: str) -> str:
    """A vocabulary's place: a path as it is, or a name among the public tokenizers."""
    import public_tokenizers

    return name if os.sep in name else public_tokenizers.path(name)


def word_tokens(name: str = WORD_FILE) -> WordTokens:
    if ("word", name) not in _LOADED:
        _LOADED["word", name] = WordTokens(name)
    return _LOADED["word", name]


def byte_tokens(name: str = BYTE_FILE) -> ByteTokens:
    if ("byte", name) not in _LOADED:
        _LOADED["byte", name] = ByteTokens(name)
    return _LOADED["byte", name]


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class _Memo:
    """Ids, as little-endian unsigned 32-bit numbers, of parts of texts."""

    def __init__(self) -> None:
        self.known: dict[str, bytes] = {"": b""}
        self.held = 0  # bytes of the parts known, at most

    def parts(self, text: str) -> list[str]:
        raise NotImplementedError

    def new(self, parts: list[str]) -> list[bytes]:
        raise NotImplementedError

    def forget(self) -> None:
        self.known, self.held = {"": b""}, 0

    def encode(self, texts: list[str | None], group: int = 64, most: int | None = None) -> Iterator[bytes]:
        """Ids of each text. `most`: bytes of parts that are remembered, MEMO unless told."""
        for a in range(0, len(texts), group):
            if self.held > (MEMO if most is None else most):  # the older half stays: frequent parts come early
                self.known = dict(islice(self.known.items(), len(self.known) // 2))
                self.held = sum(200 + 4 * len(p) + len(x) for p, x in self.known.items())
            known = self.known
            cut = [self.parts(t) if t else [] for t in texts[a : a + group]]
            found = [list(map(known.get, parts)) for parts in cut]
            missing = list({p for parts, got in zip(cut, found, strict=True) if None in got for p, x in zip(parts, got, strict=True) if x is None})
            known.update(zip(missing, self.new(missing), strict=True))
            for parts, got in zip(cut, found, strict=True):
                yield b"".join([known[p] if x is None else x for p, x in zip(parts, got, strict=True)] if None in got else got)
            for p in missing:
                if len(p) > LONG:
                    del known[p]
            self.held += sum(200 + 4 * len(p) + len(known[p]) for p in missing if len(p) <= LONG)


class WordTokens(_Memo):
    def __init__(self, name: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.library = Tokenizer.from_file(path(name))
        chain = json.loads(self.library.to_str())
        self.by_blanks = all(chain.get(k) == v for k, v in DROPS_SPACE.items()) and not any(re.search(r"\s", t["content"]) or t["lstrip"] or t["rstrip"] for t in chain["added_tokens"])
        # A plain word, of letters that need no normalising but lower case, and a mark after it.
        self._plain = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]?)").fullmatch
        self._bytes = dict(enumerate(byte_letters()))
        self._marks: dict[str, bytes] = {}

    def parts(self, text: str) -> list[str]:
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") if self.by_blanks else [text]

    def new(self, parts: list[str]) -> list[bytes]:
        """Plain words go straight to the library's model, or to the memo where their form in lower case
        and without the mark is known; other parts go through the library's whole chain."""
        out, rest = [], []
        tokenize, known, fresh = self.library.model.tokenize, self.known, {}
        for i, p in enumerate(parts):
            if not self.by_blanks or (m := self._plain(p)) is None:
                rest.append(i)
                out.append(b"")
                continue
            word, mark = m[1].lower(), m[2]
            ids = known.get(word) or fresh.get(word)
            if ids is None:
                ids = fresh[word] = _packed([t.id for t in tokenize(word if word.isascii() else word.encode().decode("latin-1").translate(self._bytes))])
            if mark:
                if mark not in self._marks:
                    self._marks[mark] = _packed([t.id for t in tokenize(mark)])
                ids += self._marks[mark]
            out.append(ids)
        for i, e in zip(rest, self.library.encode_batch_fast([parts[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = _packed(e.ids)
        return out


def read_ranks(name: str) -> dict[bytes, int]:
    with open(path(name), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes stand for
    themselves, the others for the letters from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, more = [], 0
    for b in range(256):
        out.append(chr(b) if b in shown else chr(256 + more))
        more += b not in shown
    return out


class ByteTokens(_Memo):
    def __init__(self, name: str) -> None:
        import public_tokenizers
        import regex
        import tiktoken
        from tokenizers import Tokenizer, models, pre_tokenizers

        super().__init__()
        ranks = read_ranks(name)
        self.table: list[bytes] = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.table[rank] = token
        letters = byte_letters()
        spelled = {t: "".join(letters[b] for b in t) for t in ranks}
        merges = [(spelled[t[:k]], spelled[t[k:]]) for t in self.table if len(t) > 1 for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
        self.library = Tokenizer(models.BPE(vocab={spelled[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True))
        self.library.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.parts = regex.compile(public_tokenizers.PATTERN).findall
        self.reference = tiktoken.Encoding("parts", pat_str=r"[\s\S]+", mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        self.lengths = np.array([len(t) for t in self.table], np.int64)

    def new(self, parts: list[str]) -> list[bytes]:
        out = []
        for p, e in zip(parts, self.library.encode_batch(parts, add_special_tokens=False), strict=True):
            data = p.encode()
            once = len({data[k : k + 2] for k in range(len(data) - 1)}) == len(data) - 1
            out.append(_packed(e.ids if once or not data else self.reference(p)))
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for; a character may be split between tokens."""
        table = self.table
        return b"".join([table[i] for i in ids.tolist()])

    def offsets(self, ids: np.ndarray, data: bytes | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Start of each token in bytes and in characters, each with the end as a last number. A
        token that starts inside a character has the place of that character. `data`: the bytes of
        the ids, where they are known."""
        ends = np.concatenate([[0], np.cumsum(self.lengths[ids])])
        data = np.frombuffer(self.decode(ids) if data is None else data, np.uint8)
        heads = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        inside = np.append((data & 0xC0) == 0x80, False)
        return ends, heads[ends] - inside[ends]

    def texts(self, runs: Iterator[np.ndarray]) -> Iterator[str]:
        """Text of ids that come in runs; a character split between runs is held back till whole,
        bytes that are no UTF-8 become U+FFFD."""
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        for ids in runs:
            yield decoder.decode(self.decode(ids))
        yield decoder.decode(b"", True)
