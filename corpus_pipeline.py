"""From raw documents to packed training sequences, in five stages.

Each stage is written as Parquet and read again before the next one starts, so a lost executor costs a
stage's tasks and a lost driver the stage at work. All but the last return the columns of documents.

Rows without ``doc_id`` are never dropped, since no decision can name them. Rows that repeat a ``doc_id``
share the decisions about it. Null and empty texts are scored like others, are exact copies of each other
and near duplicates of nothing. Extra columns pass through all stages but the last. An empty table gives
an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import stored, table
from millrace.llm.exact_dedup import exact_duplicates
from millrace.llm.minhash import near_duplicates
from millrace.llm.mixing import in_mixed_order, mixed_places
from millrace.llm.packing import packed
from millrace.llm.quality import quality_scores

WORDS, PERCENT = 5, 80


BROADCAST_IDS = 500_000  # dropped ids that every task may hold; with more of them both sides are shuffled


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Documents whose id is not among ``dropped``. Texts are moved only where the ids are too many to broadcast."""
    ids = stored(dropped.where("doc_id IS NOT NULL").select("doc_id").distinct(), "dropped")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash")
    return docs.join(ids, "doc_id", "left_anti").select(docs.columns)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, doesn't reject."""
    return _without(docs, quality_scores(docs, table(spark, sf_dir, "labels")).where("predicted = 0"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of equal texts."""
    return _without(docs, exact_duplicates(docs).where("NOT kept"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each group of near duplicates."""
    return _without(docs, near_duplicates(docs, WORDS, PERCENT).where("NOT kept"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order in which sources interleave by their target weights."""
    return in_mixed_order(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their places in training sequences, which follow the order of the mix."""
    return packed(docs, places=mixed_places(docs))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("pack", pack)]
ORACLE_SQL = None  # models, hashed signatures and token ids are beyond SQL; tests/llm checks every stage


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
