"""Exact duplicates by content-defined chunk recipes, in DataFrame functions only.

A text is cut where its own content says so, every chunk gets an identifier, and texts are
compared as ordered lists of identifiers. The identifier is a 64-bit hash, verified: chunks
are brought together once, without repeats, and where one identifier stands for two different
chunks these get numbers that extend the lists of the texts concerned. Long texts are not moved again.

Null text counts as empty; all empty texts are equal. A row without ``doc_id`` counts in its
group and is kept only where no row of the group has an id. Rows that repeat a ``doc_id`` are all
reported. Other columns of the input are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.llm.common import stored, table, with_group_facts

WHITE = r"[\x20\x09-\x0D]+"
# A chunk ends at the first place after 512 characters where the text shows one of these endings,
# at the latest after 8192.
CHUNK = "(?s).{512,8192}?(?<=[dgmrsDGMRS.,;:] |[。、।])|.{1,8192}"


def normalised(text: str) -> Column:
    return F.regexp_replace(F.coalesce(F.col(text), F.lit("")), WHITE, " ")


def _chunks(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(CHUNK), F.lit(0))


def recipes(docs: DataFrame, text: str = "text", chunk_id: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """``row`` (doc_id as a struct), ``text_sha256`` and ``recipe`` of every document, verified."""
    texts = docs.select(F.struct("doc_id").alias("row"), normalised(text).alias("t"))
    lists = stored(texts.select("row", F.sha2("t", 256).alias("text_sha256"),
                                F.transform(_chunks(F.col("t")), lambda c: chunk_id(c)).alias("recipe")), "recipes")
    different = (texts.select(F.explode(_chunks(F.col("t"))).alias("chunk"))
                 .select(chunk_id(F.col("chunk")).alias("id"), "chunk").distinct())
    clashes = stored(different.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "clashes")
    if clashes.isEmpty():
        return lists
    places = (texts.select("row", F.sha2("t", 256).alias("text_sha256"), F.posexplode(_chunks(F.col("t"))).alias("pos", "chunk"))
              .withColumn("id", chunk_id(F.col("chunk"))).join(clashes, "id"))
    numbers = (places.select("id", "chunk").distinct()
               .withColumn("number", F.dense_rank().over(Window.partitionBy("id").orderBy("chunk")).cast("long")))
    extension = (places.join(numbers, ["id", "chunk"]).groupBy("row", "text_sha256")
                 .agg(F.sort_array(F.collect_set(F.struct("pos", "number"))).alias("more")))
    return stored(lists.join(extension, ["row", "text_sha256"], "left").select(
        "row", "text_sha256",
        F.concat("recipe", F.coalesce(F.col("more.number"), F.array().cast("array<bigint>"))).alias("recipe")), "recipes")


def exact_duplicates(docs: DataFrame, text: str = "text",
                     chunk_id: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Only the lists are shuffled to form groups; a group with a third of all rows is spread.
    """
    found = with_group_facts(recipes(docs, text, chunk_id), ["recipe"],
                             {"keep_id": F.min("row.doc_id"), "group_size": F.count(F.lit(1))}, ["row", "text_sha256"])
    return found.select("row.doc_id", "keep_id", "group_size",
                        F.col("row.doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP2_SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM n WINDOW same AS (PARTITION BY t)
"""
