"""Toxicity: a logistic classifier with a counterfactual penalty, over hashed word features.

A document's features are its distinct words and the first bytes of its words (compounds of a
slur share them), each hashed to a slot, valued 1 where present. Three passes:

1. document frequencies of every slot by label over the training rows: all labelled ones, or a
   sample of a documented bound (each task sums its rows to arrays of fixed size);
2. the slots that tell the classes apart best, and the same rows narrowed to them, on which the
   weights are fitted on the driver;
3. scores of every document.

Counterfactual regularisation: wherever a sentence of a training row names a group (`identities`),
the name is swapped for every other name of its kind, in the sentence or, if that is longer, the `NEAR`
words on both sides, and the squared change of the score's logit is penalised. A slot of a name
therefore ends with a weight near that of its counterparts, and near zero when the swapped sentences
are neutral. Equal changes count once a row.

Defined cases: a null text is an empty one and scores as the prior; null labels are no labels, and
a document with both labels counts under neither; with no labels or one class only, the score is
the smoothed share of toxic labels. Repeated ids are scored row by row. Extra columns stay out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracewell.llm import wordhash
from tracewell.llm.common import saved

SLOTS = 1 << 18
PREFIXES = (4, 5, 6, 7, 8)  # bytes
NEAR = 20  # words on each side of a name that a swap looks at
_END = re.compile(r"(?<=[.!?])\s+|\n")
_EDGE = ".,;:!?\"'()[]“”„«»…"
#: Names of groups by kind: within a kind one name can stand for another.
IDENTITIES = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "catholic", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "catholics", "atheists"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("frauen", "männer"),
    ("femmes", "hommes"),
    ("mujeres", "hombres"),
    ("musulmans", "chrétiens", "juifs"),
    ("muslime", "christen", "juden"),
    ("musulmanes", "cristianos", "judíos"),
)


@dataclass(frozen=True)
class Model:
    """Weights by slot (zero but for the chosen ones) and the intercept."""

    weights: np.ndarray
    bias: float


def _slots(hashes: list[np.ndarray]) -> np.ndarray:
    """Slots of every word and kind of feature, shaped (kinds, words); -1: no feature. Slot 0 of a
    short word's missing prefix is told apart by its zero hash."""
    out = np.empty((len(hashes), len(hashes[0])), np.int32)
    for k, h in enumerate(hashes):
        out[k] = ((h ^ np.uint64(k * 0x51ED270B)) >> np.uint64(17)).astype(np.int64) & (SLOTS - 1)
        out[k][h == 0] = -1
    return out


def features(texts: pa.Array) -> Iterator[np.ndarray]:
    """Distinct sorted slots of each text."""
    data, offsets = wordhash.text_bytes(texts)
    step = 128
    for a in range(0, len(texts), step):
        part = offsets[a : a + step + 1]
        docs, hashes = wordhash.word_hashes(data, part, True, PREFIXES)
        slots = _slots(hashes)
        cut = np.searchsorted(docs, np.arange(len(part)))
        for i in range(len(part) - 1):
            found = np.unique(slots[:, cut[i] : cut[i + 1]])
            yield found[1:] if len(found) and found[0] < 0 else found


def _names(identities: tuple[tuple[str, ...], ...]) -> dict[str, tuple[str, ...]]:
    return {x.lower(): tuple(y for y in kind if y != x) for kind in identities for x in kind}


def training_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", folds: int = 5, sample: int = 20_000) -> DataFrame:
    """(key, text, y) of labelled documents whose crc32(key as text) mod `folds` isn't 0: all of
    them, or about `sample` taken by a hash of the key where there are more. The taken keys are
    broadcast, which `sample` bounds, so no text is shuffled."""
    known = labels.where(F.col(label).isin(0, 1) & (F.crc32(F.col(key).cast("string")) % folds != 0))
    known = known.groupBy(key).agg(F.min(label).alias("y"), F.max(label).alias("_y2")).where("y = _y2").select(key, F.col("y").cast("int"))
    share = min(1.0, sample / max(1, known.count()))
    taken = known.where(F.pmod(F.xxhash64(F.lit("fit"), F.col(key)), F.lit(1_000_000)) < round(share * 1_000_000))
    return docs.select(key, "text").join(F.broadcast(taken), key)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "toxic", sample: int = 20_000, chosen: int = 2048, penalty: float = 1.0, counterfactual: float = 10.0, identities: tuple[tuple[str, ...], ...] = IDENTITIES) -> Model:
    """Learn a model. `sample` bounds the labelled rows that it is fitted on, taken by a hash of the
    key; scoring has no bound. `identities` are groups of single words that can stand for each other."""
    rows = saved(training_rows(docs, labels, key, label, sample=sample), "toxicity-sample")
    counts = rows.select("y", "text").mapInArrow(_counted, "y int, part int, n binary, docs long").groupBy("y", "part").agg(F.collect_list("n").alias("n"), F.sum("docs").alias("docs"))
    counts = counts.mapInArrow(_summed, "y int, part int, n binary, docs long").collect()  # two labels x PARTS arrays of fixed size
    df, n = np.zeros((2, SLOTS)), [0, 0]
    for r in counts:
        df[r["y"], r["part"] * (SLOTS // PARTS) : (r["part"] + 1) * (SLOTS // PARTS)] = np.frombuffer(r["n"], np.int64)
        n[r["y"]] = r["docs"]
    prior = float(np.log((n[1] + 0.5) / (n[0] + 0.5)))
    if not n[0] or not n[1]:
        return Model(np.zeros(SLOTS), prior if n[0] + n[1] else -3.0)
    odds = np.log((df[1] + 0.5) / (n[1] + 1)) - np.log((df[0] + 0.5) / (n[0] + 1))
    spread = np.sqrt(1 / (df[1] + 0.5) + 1 / (df[0] + 0.5))
    z = odds / spread
    strength = np.where(df.sum(0) >= 5, np.abs(z), 0)
    slots = np.argsort(-strength, kind="stable")[:chosen]
    slots = np.sort(slots[strength[slots] >= 2.5])
    narrowed = rows.select("y", "text").mapInArrow(_narrowed(slots, identities), "y int, slots binary, pairs binary").collect()  # at most `sample` short rows
    return _train(slots, narrowed, prior, penalty, counterfactual)


PARTS = 64


def _swapped(text: str, names: dict[str, tuple[str, ...]]) -> set[tuple[str, str]]:
    """Parts of sentences that name a group, each with a counterpart."""
    out = set()
    for sentence in _END.split(text):
        words = sentence.split()
        for i, w in enumerate(words):
            bare = w.strip(_EDGE)
            for other in names.get(bare.lower(), ()):
                near = words[max(0, i - NEAR) : i + NEAR + 1]
                swap = [*words[max(0, i - NEAR) : i], w.replace(bare, other), *words[i + 1 : i + NEAR + 1]]
                out.add((" ".join(near), " ".join(swap)))
    return out


def _swaps(text: str, names: dict[str, tuple[str, ...]]) -> list[int]:
    """The counterfactuals of a text as pairs (slot, -1 gone | 1 new), each ended by (-1, 0)."""
    pairs = sorted(_swapped(text, names))
    found = [np.asarray(x) for x in features(pa.array([s for p in pairs for s in p], pa.string()))]
    changes = {(tuple(np.setdiff1d(a, b).tolist()), tuple(np.setdiff1d(b, a).tolist())) for a, b in zip(found[::2], found[1::2], strict=True)}
    return [x for gone, new in sorted(changes) for x in [*(y for s in gone for y in (s, -1)), *(y for s in new for y in (s, 1)), -1, 0]]


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, docs = np.zeros((2, SLOTS), np.int64), [0, 0]
    for b in batches:
        for y, found in zip(b.column(0).to_pylist(), features(b.column(1)), strict=True):
            n[y, found] += 1
            docs[y] += 1
    rows = [(y, p, n[y, p * (SLOTS // PARTS) : (p + 1) * (SLOTS // PARTS)].tobytes(), docs[y]) for y in (0, 1) if docs[y] for p in range(PARTS)]
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int32(), pa.binary(), pa.int64()))], names=["y", "part", "n", "docs"])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sums = [np.sum([np.frombuffer(x, np.int64) for x in xs], axis=0).tobytes() for xs in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(sums, pa.binary()), b.column(3)], names=["y", "part", "n", "docs"])


def _narrowed(slots: np.ndarray, identities: tuple[tuple[str, ...], ...]):
    place = np.full(SLOTS, -1, np.int32)
    place[slots] = np.arange(len(slots), dtype=np.int32)

    def narrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = _names(identities)
        for b in batches:
            kept, pairs = [], []
            for text, found in zip(b.column(1), features(b.column(1)), strict=True):
                k = place[found]
                kept.append(k[k >= 0].tobytes())
                q = np.array(_swaps(text.as_py() or "", names), np.int32).reshape(-1, 2)
                ends = q[:, 0] < 0
                q[~ends, 0] = place[q[~ends, 0]]
                pairs.append(q[ends | (q[:, 0] >= 0)].tobytes())
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(kept, pa.binary()), pa.array(pairs, pa.binary())], names=["y", "slots", "pairs"])

    return narrow


def _train(slots: np.ndarray, rows: list, prior: float, penalty: float, counterfactual: float, steps: int = 400) -> Model:
    """Weights by gradient steps with momentum on log loss + L2 + the counterfactual penalty."""
    k, n = len(slots), len(rows)
    if not n or not k:
        return Model(np.zeros(SLOTS), prior)
    y = np.array([r["y"] for r in rows], float)
    cols = [np.frombuffer(r["slots"], np.int32) for r in rows]
    at = np.repeat(np.arange(n), [len(c) for c in cols])
    col = np.concatenate(cols) if n else np.zeros(0, np.int32)
    swaps = [np.frombuffer(r["pairs"], np.int32).reshape(-1, 2) for r in rows]
    swap = np.concatenate(swaps) if swaps else np.zeros((0, 2), np.int32)
    ends = swap[:, 0] < 0
    group = (np.cumsum(ends) - ends)[~ends]
    s_col, s_val, n_swaps = swap[~ends, 0], swap[~ends, 1].astype(float), max(1, int(ends.sum()))
    w, b = np.zeros(k), prior
    vw, vb, gw2, gb2 = np.zeros(k), 0.0, np.zeros(k), 0.0
    for t in range(1, steps + 1):
        z = np.bincount(at, w[col], n) + b
        e = 1 / (1 + np.exp(-np.clip(z, -30, 30))) - y
        g = np.bincount(col, e[at], k) / n + penalty * w / n
        if len(s_col):
            change = np.bincount(group, w[s_col] * s_val, n_swaps)
            g = g + counterfactual * np.bincount(s_col, change[group] * s_val, k) / n_swaps
        gb = e.mean()
        vw, vb = 0.9 * vw + 0.1 * g, 0.9 * vb + 0.1 * gb
        gw2, gb2 = 0.99 * gw2 + 0.01 * g * g, 0.99 * gb2 + 0.01 * gb * gb
        rate = 0.1 if t < steps * 0.7 else 0.02
        w = w - rate * (vw / (1 - 0.9**t)) / (np.sqrt(gw2 / (1 - 0.99**t)) + 1e-6)
        b = b - rate * (vb / (1 - 0.9**t)) / (np.sqrt(gb2 / (1 - 0.99**t)) + 1e-6)
    full = np.zeros(SLOTS)
    full[slots] = w
    return Model(full, float(b))


def score(docs: DataFrame, model: Model, text: str = "text") -> Column:
    """The score of a row's whole text, as a column of `docs`."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # SLOTS numbers, whatever the input

    @F.arrow_udf("double")
    def scores(texts: pa.Array) -> pa.Array:
        w, bias = shared.value.weights, shared.value.bias
        used = w != 0
        data, offsets = wordhash.text_bytes(texts)
        z = np.full(len(texts), bias)
        step = 128
        for a in range(0, len(texts), step):
            part = offsets[a : a + step + 1]
            of, hashes = wordhash.word_hashes(data, part, True, PREFIXES)
            slots = _slots(hashes)
            kind, word = np.nonzero(used[slots] & (slots >= 0))
            pairs = np.unique(of[word].astype(np.int64) * SLOTS + slots[kind, word])
            z[a : a + len(part) - 1] += np.bincount(pairs // SLOTS, w[pairs % SLOTS], len(part) - 1)
        return pa.array(1 / (1 + np.exp(-np.clip(z, -700, 700))))

    return scores(F.col(text))


def scored(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score, predicted) of every row, from its whole text."""
    out = docs.select(key, score(docs, model, text).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
