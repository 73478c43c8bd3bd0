"""Quality rules: a decision list learned from labelled statistics, all in native expressions.

`statistics` computes a row of numbers a document with built-in functions only. `learn` covers the
low-quality labelled documents one rule at a time: a rule is grown on two thirds of the labelled rows
by the thresholds that most raise its FOIL gain, pruned on the last third, and the rows it catches are
set aside before the next one. Every step is one small grouped count over all labelled rows, so
nothing but counts by (statistic, bin) reaches the driver. `verdict` turns the ordered list into
one `CASE WHEN` expression.

Defined cases: a null text has no words; an empty text likewise; a null or contradictory label is
no label; with no label, or none of either class, the list is empty and only the base rules decide.
Repeated rows are scored each on their own. Extra columns of `docs` are ignored by `statistics`.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACES = r"[\x20\x09-\x0D]+"
NOT_SYMBOL = r"[^#*$%&|<>]+"
WINDOW = 5
#: Statistics that rules may test, as SQL over the base counts.
RATIOS = {
    "words": "CAST(n_words AS DOUBLE)",
    "mean_word": "try_divide(word_chars, n_words)",
    "symbol_share": "try_divide(n_symbols, n_words)",
    "dup_line_share": "try_divide(n_dup_lines, n_lines)",
    "repeat_share": "try_divide(n_repeat_words, n_words)",
    "words_a_line": "try_divide(n_words, n_lines)",
    "distinct_share": "try_divide(n_distinct, n_words)",
}
BINS = 24


def _let(value: Column, body) -> Column:
    """`body(value)` with `value` computed once: a one-element transform binds it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _covered(places: Column) -> Column:
    """Words in the union of the windows that start at the sorted `places`."""
    start = F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last"))
    return F.aggregate(
        places,
        start,
        lambda s, p: F.struct((s["n"] + F.least(F.lit(WINDOW), p - s["last"])).alias("n"), p.alias("last")),
        lambda s: s["n"],
    )


def _repeat_words(words: Column) -> Column:
    """Words (given as hashes) that lie in a five-word window found twice or more, the first
    included. Windows are compared by a 64-bit hash, built up from pairs; documents without a
    repeated window, nearly all, stop there."""

    def in_sorted(grams: Column) -> Column:
        placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))

        def places(rows: Column) -> Column:
            last = F.size(rows)
            same = F.filter(
                rows,
                lambda r, i: (F.when(i > 0, F.element_at(rows, F.greatest(i, F.lit(1)))["g"] == r["g"]).otherwise(False))
                | (F.when(i + 1 < last, F.element_at(rows, F.least(i + 2, last))["g"] == r["g"]).otherwise(False)),
            )
            return _covered(F.sort_array(F.transform(same, lambda r: r["i"])))

        return _let(placed, places)

    def joined(left: Column, right: Column) -> Column:
        return F.zip_with(left, right, lambda a, b: F.xxhash64(a, b))

    def grams(pairs: Column) -> Column:
        fours = joined(pairs, F.slice(pairs, F.lit(3), F.size(pairs)))
        return F.slice(joined(fours, F.slice(words, F.lit(5), F.size(words))), F.lit(1), F.size(words) - (WINDOW - 1))

    pairs = joined(words, F.slice(words, F.lit(2), F.size(words)))
    repeated = _let(_let(pairs, grams), lambda g: F.when(F.size(F.array_distinct(g)) < F.size(g), in_sorted(g)).otherwise(0))
    return F.when(F.size(words) > WINDOW, repeated).otherwise(0)


def statistics(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Counts of every whole text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (all
    long) and the helper counts n_lines and n_distinct."""
    whole = F.coalesce(F.col(text), F.lit(""))

    def measured(words: Column) -> Column:
        return F.struct(
            F.size(words).cast("long").alias("n_words"),
            F.length(F.array_join(words, "")).cast("long").alias("word_chars"),
            _let(
                F.transform(words, lambda w: F.xxhash64(w)),
                lambda h: F.struct(_repeat_words(h).cast("long").alias("n_repeat_words"), F.size(F.array_distinct(h)).cast("long").alias("n_distinct")),
            ).alias("h"),
        )

    def lined(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    lines = F.filter(F.split(whole, "\n"), lambda x: x.rlike(WORD))
    found = docs.select(
        *[F.col(k) for k in keep],
        _let(F.array_remove(F.split(whole, SPACES), ""), measured).alias("_w"),
        _let(lines, lined).alias("_l"),
        F.length(F.regexp_replace(whole, NOT_SYMBOL, "")).cast("long").alias("n_symbols"),
    )
    return found.select(*keep, "_w.n_words", "_w.word_chars", "n_symbols", "_l.n_dup_lines", "_w.h.n_repeat_words", "_l.n_lines", "_w.h.n_distinct")


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


@dataclass(frozen=True)
class Test:
    """`stat >= at`, or `stat < at` where `above` is false."""

    stat: str
    above: bool
    at: float

    def column(self) -> Column:
        value = F.coalesce(F.expr(RATIOS[self.stat]), F.lit(0.0))
        return value >= self.at if self.above else value < self.at

    def __str__(self) -> str:
        return f"{self.stat} {'>=' if self.above else '<'} {self.at:.6g}"


@dataclass(frozen=True)
class Rule:
    """Documents that meet every test are rejected (`keep` false) or kept."""

    tests: tuple[Test, ...]
    keep: bool = False

    def column(self) -> Column:
        met = F.lit(True)
        for t in self.tests:
            met = met & t.column()
        return met

    def __str__(self) -> str:
        return " and ".join(map(str, self.tests)) + f" -> {'keep' if self.keep else 'reject'}"


def _entropy_gain(p: float, n: float, p0: float, n0: float) -> float:
    """FOIL gain of narrowing (p0 hits, n0 misses) to (p, n)."""
    if p <= 0:
        return -math.inf
    return p * (math.log2(p / (p + n)) - math.log2(p0 / (p0 + n0)))


def learn(stats: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", max_rules: int = 6, max_tests: int = 3, min_hits: int = 10, min_precision: float = 0.9) -> list[Rule]:
    """Learn an ordered list of rejecting rules from `labels` (1: good, 0: bad) over `stats`.

    Two thirds of the labelled rows grow rules, the rest prune them; both parts together are all
    labelled rows, dealt by a hash of the key. `min_precision` is the least share of bad documents that a
    rule must catch among those it rejects, on the pruning rows as well."""
    known = labels.where(F.col(label).isin(0, 1)).groupBy(key).agg(F.min(label).alias("_low"), F.max(label).alias("_high"))
    known = known.where(F.col("_low") == F.col("_high")).select(F.col(key), (F.col("_low") == 0).alias("_bad"))
    rows = stats.join(known, key).where(~base_failed())
    rows = rows.select("_bad", (F.pmod(F.xxhash64(F.lit("grow"), F.col(key)), F.lit(3)) < 2).alias("_grow"), *[F.coalesce(F.expr(v), F.lit(0.0)).alias(k) for k, v in RATIOS.items()])
    rows = rows.persist()
    try:
        return _cover(rows, max_rules, max_tests, min_hits, min_precision)
    finally:
        rows.unpersist()


def _plain(t: Test) -> Column:
    return F.col(t.stat) >= t.at if t.above else F.col(t.stat) < t.at


def _met(tests: list[Test]) -> Column:
    met = F.lit(True)
    for t in tests:
        met = met & _plain(t)
    return met


def _cover(rows: DataFrame, max_rules: int, max_tests: int, min_hits: int, min_precision: float) -> list[Rule]:
    names = list(RATIOS)
    bad_only = rows.where("_bad")
    asked = [i / BINS for i in range(1, BINS)]
    cuts: dict[str, list[float]] = {}
    for part in (bad_only, rows):  # bounds that follow both the rare bad documents and the rest
        found = part.agg(*[F.percentile_approx(k, asked, 10_000).alias(k) for k in names]).first()
        for k in names:
            cuts[k] = sorted(set(cuts.get(k, [])) | set((found[k] if found else None) or []))
    rules: list[Rule] = []
    while len(rules) < max_rules:
        left = rows
        for r in rules:
            left = left.where(~_met(list(r.tests)))
        tests: list[Test] = []
        while len(tests) < max_tests:
            best = _best_test(left.where(F.col("_grow") & _met(tests)), cuts, min_hits)
            if best is None:
                break
            tests.append(best)
        tests = _pruned(left.where(~F.col("_grow")), tests, min_precision)
        if not tests:
            break
        rules.append(Rule(tuple(tests)))
    return rules


def _best_test(rows: DataFrame, cuts: dict[str, list[float]], min_hits: int) -> Test | None:
    """The threshold with the largest FOIL gain, from counts by statistic and bin of all rows."""
    names = [k for k in cuts if cuts[k]]
    if not names:
        return None
    bins = F.explode(F.array(*[F.struct(F.lit(k).alias("stat"), _bin(F.col(k), cuts[k]).alias("bin")) for k in names]))
    counted = rows.select("_bad", bins.alias("_b")).groupBy("_b.stat", "_b.bin").agg(F.count_if("_bad").alias("p"), F.count_if(~F.col("_bad")).alias("n"))
    found: dict[str, dict[int, tuple[int, int]]] = {}
    for r in counted.collect():  # at most len(RATIOS) * (2 * BINS) rows
        found.setdefault(r["stat"], {})[r["bin"]] = (r["p"], r["n"])
    best, gain = None, 1e-9
    for k in names:
        by = found.get(k, {})
        p0, n0 = sum(x[0] for x in by.values()), sum(x[1] for x in by.values())
        if p0 < min_hits or n0 == 0:
            continue
        p = n = 0
        for i, at in enumerate(cuts[k]):  # bin i holds values below cuts[i] and not below cuts[i - 1]
            p, n = p + by.get(i, (0, 0))[0], n + by.get(i, (0, 0))[1]
            for above, hits, misses in ((False, p, n), (True, p0 - p, n0 - n)):
                if hits >= min_hits and (g := _entropy_gain(hits, misses, p0, n0)) > gain:
                    best, gain = Test(k, above, at), g
    return best


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many of the sorted cuts are at or below the value."""
    total = F.lit(0)
    for at in cuts:
        total = total + (value >= at).cast("int")
    return total


def _pruned(rows: DataFrame, tests: list[Test], min_precision: float) -> list[Test]:
    """The prefix-free subset of tests, found by dropping last ones, with the best (p - n) / (p + n)
    on the pruning rows; none if it isn't precise enough."""
    if not tests:
        return []
    options = [tests[:k] for k in range(1, len(tests) + 1)]
    options += [tests[k:] for k in range(1, len(tests))]
    counts = rows.agg(*[F.count_if(_met(o) & F.col("_bad")).alias(f"p{i}") for i, o in enumerate(options)], *[F.count_if(_met(o) & ~F.col("_bad")).alias(f"n{i}") for i, o in enumerate(options)]).first()
    best, most = [], -2.0
    for i, o in enumerate(options):
        p, n = counts[f"p{i}"], counts[f"n{i}"]
        if p == 0 or p / (p + n) < min_precision:
            continue
        worth = (p - n) / (p + n)
        if (worth, p) > (most, -1) and (worth > most + 1e-12):
            best, most = o, worth
    return best


def verdict(rules: list[Rule]) -> Column:
    """The ordered list as one conditional expression: the first rule met decides, else keep."""
    out = None
    for r in rules:
        out = F.when(r.column(), F.lit(r.keep)) if out is None else out.when(r.column(), F.lit(r.keep))
    return F.lit(True) if out is None else out.otherwise(True)


def judged(stats: DataFrame, rules: list[Rule]) -> DataFrame:
    """`stats` with base_failed and kept (false for a base failure, else the list's verdict)."""
    return stats.withColumn("base_failed", base_failed()).withColumn("kept", ~F.col("base_failed") & verdict(rules))
