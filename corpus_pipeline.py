"""A training corpus from documents: junk, near copies, repeated passages and benchmark leaks go, and the rest is encoded.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from turnwright.llm import op1_bpe, op2_decontaminate, op6_join, op8_substrings, op9_classifier
from turnwright.llm.clusterio import Shelf, table
from turnwright.session import reachable

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _bounded(stage: Stage) -> Stage:
    """The stage in a session whose workers find this package, and whose Arrow batches are bounded, also where it is called by itself."""
    return wraps(stage)(lambda spark, docs, sf_dir: stage(reachable(spark), docs, sf_dir))


@_bounded
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labelled ones, doesn't reject."""
    return op9_classifier.accepted(docs, table(spark, sf_dir, "labels"))


@_bounded
def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group that the n-gram Jaccard join links."""
    return op6_join.dedup(docs)


@_bounded
def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that stand earlier in another place."""
    return op8_substrings.dedup(docs)


@_bounded
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any item of the benchmark."""
    return op2_decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


@_bounded
def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids and n_tokens of every document."""
    return op1_bpe.encode(docs.select("doc_id", "lang", "source", "text")).selectExpr("doc_id", "lang", "source", "ids", "cast(size(ids) AS bigint) AS n_tokens")


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("substrings", substrings),
    ("decontamination", decontamination),
    ("encoding", encoding),
]

#: A trained classifier decides which rows there are, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents; what each returns is written to the shared checkpoint folder, and read again by the next."""
    docs, before = table(spark, sf_dir, "documents"), Shelf(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            own = Shelf(spark)
            docs = own.put(docs)
            before.clear()
            before = own
    return docs
