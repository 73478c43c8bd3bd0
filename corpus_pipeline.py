"""A corpus pipeline: toxic and poor documents go, one of each group of near duplicates stays, and
what is left is packed into training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracewell.llm import ngram_join, packing, quality_rules, toxicity
from tracewell.llm.common import saved, table


ROW = "_tracewell_row"
MEMO = 48 << 20  # bytes of parts of texts that a packing task remembers, beside the workers of other stages


def _with_row(docs: DataFrame) -> DataFrame:
    """The key, the text and the whole row."""
    return docs.select("doc_id", "text", F.struct("*").alias(ROW))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below one half, by a model fitted on the labelled ones."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(docs, model) < 0.5)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the learned decision list. Texts and their statistics
    are written once, for learning and for the verdict; whole rows travel as one column, so that no
    name of theirs clashes with a statistic."""
    stats = saved(quality_rules.statistics(_with_row(docs), keep=("doc_id", ROW)), "documents-statistics")
    rules = quality_rules.learn(stats, table(spark, sf_dir, "labels"))
    return quality_rules.judged(stats, rules).where("kept").select(f"{ROW}.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by five-word shingles at 0.8; of rows
    that repeat an id and its text, one. Documents without an id stay."""
    found = ngram_join.joined(docs, size=5, percent=80)
    stay = found.where("doc_id = component_id").select("doc_id").distinct()
    rows = _with_row(docs)
    kept = rows.join(stay, "doc_id", "left_semi").groupBy("doc_id", F.xxhash64("text")).agg(F.first(ROW).alias(ROW))
    return kept.select(f"{ROW}.*").unionByName(docs.where("doc_id is null"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their sequence and offset."""
    return packing.pack(docs, memo=MEMO)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("quality rules", keep_good),
    ("n-gram Jaccard join", one_of_each),
    ("best-fit packing", pack),
]

#: SQL can't express the learned stages; tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
